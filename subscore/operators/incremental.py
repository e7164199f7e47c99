"""Monthly tables kept up by what arrives: late days, and history carried from month to month.

Neither reads a month's daily facts, or older months, again.
"""

from __future__ import annotations

import re
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from subscore.functions.months import month_end
from subscore.schemas import (
    MEASURES,
    REVENUE,
    SUBSCRIPTION_KEY,
    TOPUP,
    TOPUP_DAILY_SCHEMA,
    USAGE,
    USAGE_DAILY_SCHEMA,
    USAGE_HISTORY,
    USAGE_SOURCES,
    lag_name,
)
from subscore.session import shared_folder
from subscore.sources.tables import is_path, latest_month, read_table, replace_month, write_feature_set

TOPUP_SOURCES = {"tran": "top_up_tran", "value": "top_up_value"}
TOTALS = {"tran": "sum_monthly_tran_topup", "value": "sum_monthly_topup_value"}
MONTH = "ddate"
STATE_MONTH = "state_month"


# --- Late days ---------------------------------------------------------------


def topup_states(topup_daily: DataFrame) -> DataFrame:
    """Per subscription and month of the given days what its statistics are merged from.

    For the count and the value of top-ups each: number, sum, mean, sum of squared
    deviations from the mean, extremes. All combine on the map side.
    """
    states = []
    for name, source in TOPUP_SOURCES.items():
        states += [
            F.count(source).alias(f"n_{name}"),
            F.sum(source).alias(f"sum_{name}"),
            F.avg(source).alias(f"mean_{name}"),
            (F.var_pop(source) * F.count(source)).alias(f"m2_{name}"),
            F.min(source).alias(f"min_{name}"),
            F.max(source).alias(f"max_{name}"),
        ]
    types = {f.name: f.dataType for f in TOPUP_DAILY_SCHEMA}
    days = topup_daily.withColumns({c: F.col(c).cast(types[c]) for c in TOPUP_SOURCES.values()})
    days = days.withColumns({"register_date": F.to_date("register_date"), MONTH: F.last_day(MONTH)})
    return days.groupBy(*SUBSCRIPTION_KEY, MONTH).agg(*states)


def usage_states(usage_daily: DataFrame) -> DataFrame:
    """Per subscriber and month of the given days the sums of its usage."""
    types = {f.name: f.dataType for f in USAGE_DAILY_SCHEMA}
    days = usage_daily.withColumns({c: F.col(c).cast(types[c]) for c in USAGE_SOURCES.values()}).withColumn(MONTH, F.last_day(MONTH))
    return days.groupBy("analytic_id", MONTH).agg(*[F.sum(source).alias(name) for name, source in USAGE_SOURCES.items()])


def _merged_moment(name: str) -> Column:
    """Number, mean and squared deviations of all parts, merged two at a time, which loses no digits to large means."""
    part = F.struct(F.col(f"n_{name}").alias("n"), F.col(f"mean_{name}").alias("mean"), F.col(f"m2_{name}").alias("m2"))
    parts = F.sort_array(F.collect_list(F.when(F.col(f"n_{name}") > 0, part)))
    zero = F.struct(F.lit(0).cast("bigint").alias("n"), F.lit(0.0).alias("mean"), F.lit(0.0).alias("m2"))

    def merge(a: Column, b: Column) -> Column:
        n, apart = a["n"] + b["n"], b["mean"] - a["mean"]
        return F.struct(
            n.alias("n"),
            (a["mean"] + apart * b["n"] / n).alias("mean"),
            (a["m2"] + b["m2"] + apart * apart * a["n"] * b["n"] / n).alias("m2"),
        )

    return F.aggregate(parts, zero, merge).alias(f"moment_{name}")


def merged_topups(states: DataFrame) -> DataFrame:
    """Monthly statistics of each subscription from all of its states: a row for each batch that had days of the month."""
    merged = states.groupBy(*SUBSCRIPTION_KEY, MONTH).agg(
        *[_merged_moment(name) for name in TOPUP_SOURCES],
        *[f(f"{kind}_{name}").alias(f"{kind}_{name}") for name in TOPUP_SOURCES for kind, f in (("sum", F.sum), ("min", F.min), ("max", F.max))],
    )
    out = []
    for name, total in TOTALS.items():
        n, m2 = F.col(f"moment_{name}.n"), F.col(f"moment_{name}.m2")
        out += [
            F.col(f"sum_{name}").alias(total),
            F.try_divide(F.col(f"sum_{name}"), n).alias(f"mean_monthly_topup_{name}"),
            F.when(n > 1, F.sqrt(m2 / (n - 1))).alias(f"sd_monthly_topup_{name}"),
            F.col(f"min_{name}").alias(f"min_monthly_topup_{name}"),
            F.col(f"max_{name}").alias(f"max_monthly_topup_{name}"),
        ]
    return merged.select(*SUBSCRIPTION_KEY, MONTH, *out)


def merged_usage(states: DataFrame) -> DataFrame:
    return states.groupBy("analytic_id", MONTH).agg(*[F.sum(c).alias(c) for c in USAGE])


def add_days(topup_daily: DataFrame, usage_daily: DataFrame, folder: str, batch: str) -> list[date]:
    """Add the days of one delivery to the states below ``folder``; returns the months that it touches.

    Any days of any months may come, in any order and in any number of deliveries;
    each day's rows come once. The states of a delivery are partitions of its own, so
    that one that failed, or comes again under its name, replaces what it had written.
    """
    if not re.fullmatch(r"[\w-]+", batch):
        raise ValueError("a batch is named by letters, digits, - and _")
    months = set()
    for name, states in (("topup", topup_states(topup_daily)), ("usage", usage_states(usage_daily))):
        path = f"{folder}/{name}/batch={batch}"
        states.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy(MONTH).parquet(path)
        written = topup_daily.sparkSession.read.schema(states.schema).parquet(path)
        months |= {r[0] for r in written.select(MONTH).distinct().collect() if r[0]}
    return sorted(months)


def datamart_of_states(spark: SparkSession, folder: str, months: list[date]) -> DataFrame:
    """The usage datamart of ``months`` from the states of all deliveries; other months' partitions aren't read.

    Equals ``usage_datamart`` of all days delivered. A subscription's month takes as
    many rows as deliveries had days of it, all merged under one key.
    """
    wanted = F.col(MONTH).isin(months)
    # Types come from the declared tables: a delivery may have written no file.
    empty = {"topup": topup_states(spark.createDataFrame([], TOPUP_DAILY_SCHEMA)), "usage": usage_states(spark.createDataFrame([], USAGE_DAILY_SCHEMA))}
    topup, usage = (spark.read.schema(df.schema).parquet(f"{folder}/{name}").filter(wanted) for name, df in empty.items())
    topup, usage = merged_topups(topup), merged_usage(usage)
    return topup.join(usage, ["analytic_id", MONTH], "full").select(*SUBSCRIPTION_KEY, *TOPUP, *USAGE, MONTH)


def refresh_datamart(topup_daily: DataFrame, usage_daily: DataFrame, folder: str, target: str, batch: str, buckets: int = 0) -> list[date]:
    """Add a delivery and replace the datamart's months that it touches, late ones too; returns them."""
    months = add_days(topup_daily, usage_daily, folder, batch)
    mart = datamart_of_states(topup_daily.sparkSession, folder, months)
    if is_path(target) and months:
        mart.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(MONTH).parquet(target)
    elif months:
        for month in months:
            replace_month(mart.filter(F.col(MONTH) == F.lit(month)), target, MONTH, month, buckets)
    return months


# --- History carried forward -------------------------------------------------


def month_measures(profile: DataFrame, usage_monthly: DataFrame, month: date) -> DataFrame:
    """All twelve measures of a month per known subscription."""
    known = F.col("analytic_id").isNotNull() & F.col("register_date").isNotNull()
    this = F.col(MONTH) == F.lit(month)
    revenue = profile.filter(this).withColumn("register_date", F.to_date("activation_date")).filter(known)
    usage = usage_monthly.filter(this & known)
    # The largest value if a subscription repeats, as history has it.
    one = revenue.groupBy(*SUBSCRIPTION_KEY).agg(*[F.max(c).alias(c) for c in REVENUE])
    two = usage.groupBy(*SUBSCRIPTION_KEY).agg(*[F.max(c).alias(c) for c in USAGE_HISTORY])
    return one.join(two, SUBSCRIPTION_KEY, "full").select(*SUBSCRIPTION_KEY, *MEASURES)


def empty_history(spark: SparkSession, measures: DataFrame) -> DataFrame:
    types = {f.name: f.dataType.simpleString() for f in measures.schema}
    fields = [f"{c} {types[c]}" for c in SUBSCRIPTION_KEY] + [f"{_held(m, k)} {types[m]}" for k in (0, 1) for m in MEASURES]
    return spark.createDataFrame([], ", ".join(fields))


def _held(measure: str, back: int) -> str:
    return f"{measure}_m{back}"


def carried_forward(state: DataFrame, measures: DataFrame, gap: int = 1) -> DataFrame:
    """The state one month on: what was this month's becomes last month's, what was last month's goes.

    ``gap`` is the number of months since ``state``; with two, its newest values are
    two months back, with more, nothing of it is left. One full join on the
    subscription, by which the state is bucketed; a subscription without a value in
    either month leaves.
    """
    old = state.select(*SUBSCRIPTION_KEY, *[F.col(_held(m, 0)).alias(_held(m, 1)) for m in MEASURES])
    old = old if gap == 1 else old.filter("false")
    new = measures.select(*SUBSCRIPTION_KEY, *[F.col(m).alias(_held(m, 0)) for m in MEASURES])
    columns = [_held(m, k) for k in (0, 1) for m in MEASURES]
    return new.join(old, SUBSCRIPTION_KEY, "full").select(*SUBSCRIPTION_KEY, *columns).dropna("all", subset=columns)


def advance_history(profile: DataFrame, usage_monthly: DataFrame, target: str, month: date, buckets: int = 0) -> bool:
    """Carry the stored history to ``month``, unless it is there already; returns whether it moved.

    Reads one month of the profile and the datamart, and the newest state. States are
    partitions by month, so that a month can be repeated by going on from the one before.
    """
    spark = profile.sparkSession
    latest = latest_month(spark, target, STATE_MONTH)
    if latest is not None and latest >= month:
        return False
    measures = month_measures(profile, usage_monthly, month)
    state, gap = empty_history(spark, measures), 1
    if latest is not None:
        state = read_table(spark, target).filter(F.col(STATE_MONTH) == F.lit(latest)).drop(STATE_MONTH)
        gap = (month.year - latest.year) * 12 + month.month - latest.month
    moved = carried_forward(state, measures, gap).withColumn(STATE_MONTH, F.lit(month))
    if latest is not None and not is_path(target):
        # A statement can't replace a part of a catalog table that it reads.
        moved = write_feature_set(moved, f"{shared_folder(spark, 'history')}/moved")
    replace_month(moved, target, STATE_MONTH, month, buckets)
    return True


def attach_carried(base: DataFrame, history: DataFrame, month: date) -> DataFrame:
    """``attach_lags`` from the stored history: ``_p1`` and ``_p2`` from the state of the month before ``month``.

    The state is read by the key by which it is joined; no older month is looked at.
    """
    before = month_end(month, 1)
    lags = [F.col(_held(m, lag - 1)).alias(lag_name(m, lag)) for lag in (1, 2) for m in MEASURES]
    state = history.filter(F.col(STATE_MONTH) == F.lit(before)).select(*SUBSCRIPTION_KEY, *lags)
    renamed = state.withColumnsRenamed({k: f"_right_{k}" for k in SUBSCRIPTION_KEY})
    same = [F.col(k) == F.col(f"_right_{k}") for k in SUBSCRIPTION_KEY]
    match = same[0] & same[1] & (F.col("prof_month") == F.lit(month))
    return base.join(renamed, match, "left").drop(*[f"_right_{k}" for k in SUBSCRIPTION_KEY])
