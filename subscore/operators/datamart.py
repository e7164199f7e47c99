"""Monthly usage datamart from daily facts.

``months`` > 1 aggregates that many months, ending at ``month``, in one pass over
the daily facts; the key then includes the month end ``ddate``.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from subscore.functions.months import month_end, month_slice
from subscore.schemas import TOPUP, USAGE, USAGE_SOURCES


def _month_key(months: int) -> list[str]:
    return ["ddate"] if months > 1 else []


def _sliced(daily: DataFrame, month: date, months: int) -> DataFrame:
    return month_slice(daily, month, lag=0, months=months).withColumn("ddate", F.last_day("ddate"))


def topup_monthly(topup_daily: DataFrame, month: date, months: int = 1) -> DataFrame:
    """Top-up count and value statistics per subscription in the month of ``month``.

    The deviation is the sample one, null for a single top-up. All aggregates
    combine on the map side, so a busy subscription costs one row per map task
    in the shuffle.
    """
    aggregates = []
    for source, total, suffix in (
        ("top_up_tran", "sum_monthly_tran_topup", "tran"),
        ("top_up_value", "sum_monthly_topup_value", "value"),
    ):
        aggregates += [
            F.sum(source).alias(total),
            F.avg(source).alias(f"mean_monthly_topup_{suffix}"),
            F.stddev_samp(source).alias(f"sd_monthly_topup_{suffix}"),
            F.min(source).alias(f"min_monthly_topup_{suffix}"),
            F.max(source).alias(f"max_monthly_topup_{suffix}"),
        ]
    return (
        _sliced(topup_daily, month, months)
        .withColumn("register_date", F.to_date("register_date"))
        .groupBy("analytic_id", "register_date", *_month_key(months))
        .agg(*aggregates)
    )


def usage_monthly_sums(usage_daily: DataFrame, month: date, months: int = 1) -> DataFrame:
    """Data, voice and SMS totals per subscriber (not subscription) in the month of ``month``."""
    return (
        _sliced(usage_daily, month, months)
        .groupBy("analytic_id", *_month_key(months))
        .agg(*[F.sum(source).alias(name) for name, source in USAGE_SOURCES.items()])
    )


def usage_datamart(topup_daily: DataFrame, usage_daily: DataFrame, month: date, months: int = 1) -> DataFrame:
    """Top-ups and usage of a month side by side, one row per subscription.

    Usage is known per subscriber only: it repeats for each subscription that
    topped up, and a subscriber without top-up gets a null ``register_date``.
    """
    topup = topup_monthly(topup_daily, month, months)
    usage = usage_monthly_sums(usage_daily, month, months)
    both = topup.join(usage, ["analytic_id", *_month_key(months)], "full")
    if months == 1:
        both = both.withColumn("ddate", F.lit(month_end(month)))
    return both.select("analytic_id", "register_date", *TOPUP, *USAGE, "ddate")
