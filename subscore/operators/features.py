"""Wide feature table: month snapshots, their joins, and two months of history."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from subscore.functions.months import month_end, month_slice
from subscore.schemas import (
    MEASURES,
    PROFILE_COLUMNS,
    REVENUE,
    SUBSCRIPTION_KEY,
    USAGE_HISTORY,
    lag_name,
)

HISTORY_MONTHS = 2


def profile_snapshot(profile: DataFrame, month: date) -> DataFrame:
    """Active prepaid subscriptions at a month end."""
    return (
        month_slice(profile, month, 0, snapshot=True)
        .filter((F.col("charge_type") == "Pre-paid") & (F.col("mobile_status") == "SA"))
        .withColumn("register_date", F.to_date("activation_date"))
        .select(*PROFILE_COLUMNS)
    )


def usage_snapshot(usage_monthly: DataFrame, month: date) -> DataFrame:
    return month_slice(usage_monthly, month, 0, snapshot=True)


def with_registrations(usage_monthly: DataFrame, profile: DataFrame) -> DataFrame:
    """Give usage without a top-up the registration that holds at its month end.

    Usage is known per subscriber only; without a top-up in its month it has no
    ``register_date`` and reaches no subscription. Here it gets, as of the month end, the
    subscriber's newest registration in that month's profile, active or not. Usage rows
    with a registration stay as they are, and rows are never multiplied: the profile
    is reduced to one date for each subscriber and month first, on the map side.
    Subscribers without a profile, or without an id, keep their null.
    """
    columns = usage_monthly.columns
    starts = F.to_date("activation_date")
    newest = (
        profile.filter(F.col("analytic_id").isNotNull() & (starts <= F.col("ddate")))
        .groupBy("analytic_id", "ddate")
        .agg(F.max(starts).alias("_registered"))
    )
    open_rows = usage_monthly.filter(F.col("register_date").isNull() & F.col("analytic_id").isNotNull())
    found = open_rows.join(newest, ["analytic_id", "ddate"], "left").withColumn("register_date", F.col("_registered"))
    others = usage_monthly.filter(F.col("register_date").isNotNull() | F.col("analytic_id").isNull())
    return others.select(*columns).unionByName(found.select(*columns))


def usage_by(key: str, usage_monthly: DataFrame, profile: DataFrame) -> DataFrame:
    """The datamart as features see it: by ``subscription``, or with ``with_registrations`` by ``subscriber``."""
    if key not in ("subscription", "subscriber"):
        raise ValueError(f"usage is keyed by subscription or subscriber, not by {key}")
    return usage_monthly if key == "subscription" else with_registrations(usage_monthly, profile)


def unique_keys(df: DataFrame) -> DataFrame:
    """``df``, which fails when it is run if a known subscription occurs in two rows.

    The count is over the key by which the joins before have dealt out and sorted the
    rows, so nothing is shuffled for it. A key that repeats in the spine or in any
    joined month repeats here.
    """
    rows = F.count(F.lit(1)).over(Window.partitionBy(*SUBSCRIPTION_KEY))
    known = F.col("analytic_id").isNotNull() & F.col("register_date").isNotNull()
    message = F.concat(F.lit("a subscription repeats: "), F.concat_ws(", ", *SUBSCRIPTION_KEY))
    checked = F.when((F.col("_same_key") > 1) & known, F.raise_error(message).cast("string")).otherwise(F.col("analytic_id"))
    return df.withColumn("_same_key", rows).withColumn("analytic_id", checked).drop("_same_key")


def survey_snapshot(topup_survey: DataFrame, month: date) -> DataFrame:
    return (
        month_slice(topup_survey, month, 0, column="month_id", snapshot=True)
        .withColumn("register_date", F.to_date("register_date"))
        .drop("mobile_status")
    )


def validity_snapshot(validity: DataFrame, month: date) -> DataFrame:
    return (
        month_slice(validity, month, 0, snapshot=True)
        .withColumn("register_date", F.to_date("register_date"))
        .drop("date_id", "crm_subscription_id")
    )


def _attach(spine: DataFrame, right: DataFrame, month: date, right_month: str | None, spine_month: str) -> DataFrame:
    """Left join one snapshot on the subscription key.

    Both sides hold a single month, so the month is checked on the spine's side
    instead of being a join key. All joins then share one hash partitioning of
    the spine on (``analytic_id``, ``register_date``): it is shuffled once.
    """
    if right_month:
        right = right.drop(right_month)
    clash = (set(spine.columns) & set(right.columns)) - set(SUBSCRIPTION_KEY)
    if clash:
        raise ValueError(f"columns occur on both sides of the join: {sorted(clash)}")
    renamed = right.withColumnsRenamed({k: f"_right_{k}" for k in SUBSCRIPTION_KEY})
    same_key = reduce(and_, [F.col(k) == F.col(f"_right_{k}") for k in SUBSCRIPTION_KEY])
    match = same_key & (F.col(spine_month) == F.lit(month))
    return spine.join(renamed, match, "left").drop(*[f"_right_{k}" for k in SUBSCRIPTION_KEY])


def label_spine_with_profile(labels: DataFrame, profile: DataFrame, month: date) -> DataFrame:
    """Labelled subscribers with their profile of ``month``."""
    spine = labels.select("analytic_id", "register_date", "bad_flag", "prof_month")
    return _attach(spine, profile_snapshot(profile, month), month, "ddate", "prof_month")


def profile_spine(profile: DataFrame, month: date) -> DataFrame:
    """The profile of ``month`` as the list of subscriptions to score."""
    return profile_snapshot(profile, month).withColumnRenamed("ddate", "prof_month")


def attach_snapshots(
    spine: DataFrame, usage_monthly: DataFrame, topup_survey: DataFrame, validity: DataFrame, month: date
) -> DataFrame:
    """Usage, survey and validity of ``month`` next to the spine."""
    out = _attach(spine, usage_snapshot(usage_monthly, month), month, "ddate", "prof_month")
    out = _attach(out, survey_snapshot(topup_survey, month), month, "month_id", "prof_month")
    return _attach(out, validity_snapshot(validity, month), month, "ddate", "prof_month")


def assemble_training_features(
    labels: DataFrame,
    profile: DataFrame,
    usage_monthly: DataFrame,
    topup_survey: DataFrame,
    validity: DataFrame,
    month: date,
    usage_key: str = "subscription",
) -> DataFrame:
    spine = label_spine_with_profile(labels, profile, month)
    usage = usage_by(usage_key, usage_monthly, profile)
    return attach_snapshots(spine, usage, topup_survey, validity, month)


def assemble_scoring_features(
    profile: DataFrame,
    usage_monthly: DataFrame,
    topup_survey: DataFrame,
    validity: DataFrame,
    month: date,
    usage_key: str = "subscription",
) -> DataFrame:
    usage = usage_by(usage_key, usage_monthly, profile)
    return attach_snapshots(profile_spine(profile, month), usage, topup_survey, validity, month)


def _history(table: DataFrame, month: date) -> DataFrame:
    return month_slice(table, month, lag=1, months=HISTORY_MONTHS)


def profile_history(profile: DataFrame, month: date) -> DataFrame:
    """Revenue of the two months before ``month``; any charge type or status."""
    return (
        _history(profile, month)
        .withColumn("register_date", F.to_date("activation_date"))
        .select(*SUBSCRIPTION_KEY, "ddate", *REVENUE)
    )


def usage_history(usage_monthly: DataFrame, month: date) -> DataFrame:
    """Top-up and usage totals of the two months before ``month``."""
    return _history(usage_monthly, month).select(*SUBSCRIPTION_KEY, "ddate", *USAGE_HISTORY)


def history_window(history: DataFrame, base: DataFrame) -> DataFrame:
    """History rows of subscribers that occur in ``base``.

    The key is the subscriber alone. It only thins out the history: the lag
    columns are the same without it, as ``attach_lags`` ignores other rows.
    """
    return history.join(base.select("analytic_id"), "analytic_id", "left_semi").select(*history.columns)


def history_union_frame(profile_months: DataFrame, usage_months: DataFrame) -> DataFrame:
    """All twelve measures per subscription and history month."""
    return profile_months.join(usage_months, [*SUBSCRIPTION_KEY, "ddate"], "full").select(
        *SUBSCRIPTION_KEY, "ddate", *MEASURES
    )


def lag_columns(history: DataFrame, month: date, measures: Sequence[str]) -> DataFrame:
    """One row per subscription with each measure one and two months back.

    A conditional aggregate over both months: one shuffle on the key the join
    needs anyway. It takes the largest value if a (subscription, month) pair
    repeats; in these tables it does not.
    """
    pivoted = [
        F.max(F.when(F.col("ddate") == F.lit(month_end(month, lag)), F.col(m))).alias(lag_name(m, lag))
        for lag in (1, 2)
        for m in measures
    ]
    known = F.col("analytic_id").isNotNull() & F.col("register_date").isNotNull()
    return history.filter(known).groupBy(*SUBSCRIPTION_KEY).agg(*pivoted)


def attach_lags(base: DataFrame, history: DataFrame, month: date, measures: Sequence[str] = MEASURES) -> DataFrame:
    """Add ``_p1`` and ``_p2`` columns; a month without history gives nulls.

    May be applied once to the united history or once per source: every
    subscription has at most one row per source and month.
    """
    return _attach(base, lag_columns(history, month, measures), month, None, "prof_month")


def duplicated_keys(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their counts."""
    return df.groupBy(*key).agg(F.count(F.lit(1)).alias("n_rows")).filter(F.col("n_rows") > 1)
