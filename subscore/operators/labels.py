"""Labels for supervised learning."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from subscore.functions.months import add_shifted_month, month_slice
from subscore.schemas import LABEL_TO_PROFILE_MONTHS


def label_bad_debtors(loans: DataFrame, as_of: date, lag: int = 1) -> DataFrame:
    """Borrowers of the label month with ``bad_flag`` and their profile month.

    Bad is a negative balance without a recharge. An unknown balance or
    recharge count leaves the flag unknown unless the other already decides it.
    """
    bad = (F.col("remain_balance_p1") < 0) & (F.col("recharge_count") == 0)
    labelled = month_slice(loans, as_of, lag, snapshot=True).withColumn(
        "bad_flag", F.when(bad, F.lit(1)).when(~bad, F.lit(0))
    )
    return add_shifted_month(labelled, LABEL_TO_PROFILE_MONTHS)


def drop_duplicated_subscribers(labelled: DataFrame, keep_unknown: bool = True) -> DataFrame:
    """Remove every row of a subscriber that occurs more than once.

    One aggregation instead of a count and an anti join: where a subscriber
    has a single row, ``any_value`` over the group is that row. It combines on
    the map side, so a subscriber with very many rows reaches the shuffle as
    one row per map task. A null id equals no other, so such rows all stay;
    ``keep_unknown=False`` drops them, for callers that do so later anyway.
    """
    others = [c for c in labelled.columns if c != "analytic_id"]
    single = (
        labelled.filter(F.col("analytic_id").isNotNull())
        .groupBy("analytic_id")
        .agg(F.count(F.lit(1)).alias("_rows"), *[F.any_value(c).alias(c) for c in others])
        .filter(F.col("_rows") == 1)
        .select(*labelled.columns)
    )
    if not keep_unknown:
        return single
    return single.unionByName(labelled.filter(F.col("analytic_id").isNull()))
