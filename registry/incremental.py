"""Queries of what is kept up from month to month, and their SQL."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from registry import oracle as o
from registry import views as v
from subscore.functions.months import month_end
from subscore.operators import features, incremental
from subscore.schemas import MEASURES, SUBSCRIPTION_KEY, TOPUP, USAGE, lag_name
from subscore.session import shared_folder
from subscore.plans import jobs

DELIVERIES = 4


def late_days_datamart(spark: SparkSession, folder: str) -> DataFrame:
    """Three months whose days come in four deliveries in mixed order, one of them twice."""
    target = shared_folder(spark, "late")
    topup, usage = (f(spark, folder, v.LABEL_MONTH, 3) for f in (v.topup_daily, v.usage_daily))
    delivery = (F.dayofmonth("ddate") * 7 + F.month("ddate")) % DELIVERIES
    for k in (2, 0, 3, 2, 1):
        days = [df.filter(delivery == k) for df in (topup, usage)]
        incremental.refresh_datamart(*days, f"{target}/states", f"{target}/usage_monthly", f"day-{k}")
    return spark.read.parquet(f"{target}/usage_monthly").select(*SUBSCRIPTION_KEY, *TOPUP, *USAGE, "ddate")


def carried_history(spark: SparkSession, folder: str) -> DataFrame:
    """Three months in a row, each with its lags from a history carried through five months."""
    target = f"{shared_folder(spark, 'carried')}/history"
    profile = v.profile(spark, folder, v.SCORING_MONTH, 5)
    usage = v.usage_monthly(spark, folder, v.SCORING_MONTH, 5)
    out = []
    for lag in range(4, 0, -1):
        incremental.advance_history(profile, usage, target, month_end(v.SCORING_MONTH, lag))
        if lag <= 3:
            month = month_end(v.SCORING_MONTH, lag - 1)
            spine = features.profile_spine(profile, month).select(*SUBSCRIPTION_KEY, "prof_month")
            out.append(incremental.attach_carried(spine, spark.read.parquet(target), month))
    return reduce(DataFrame.unionByName, out)


def usage_by_subscriber(spark: SparkSession, folder: str) -> DataFrame:
    """The datamart of three months; usage without a top-up has the registration of its month end."""
    usage, profile = (f(spark, folder, v.SCORING_MONTH) for f in (v.usage_monthly, v.profile))
    return features.with_registrations(usage, profile).select(*SUBSCRIPTION_KEY, *TOPUP, *USAGE, "ddate")


def scoring_set_by_subscriber(spark: SparkSession, folder: str) -> DataFrame:
    """The scoring features when usage without a top-up counts."""
    return jobs.build_scoring_set(v.monthly_tables(spark, folder, v.SCORING_MONTH), v.AS_OF, usage_key="subscriber")


def all_queries() -> dict:
    return {f.__name__: f for f in (late_days_datamart, carried_history, usage_by_subscriber, scoring_set_by_subscriber)}


# --- SQL ---------------------------------------------------------------------

# As of the month end, hence the newest date of the month's profile.
_BY_SUBSCRIBER = """
    SELECT u.* REPLACE (coalesce(u.register_date, (
      SELECT max(CAST(p.activation_date AS DATE)) FROM profile p
      WHERE p.analytic_id = u.analytic_id AND p.ddate = u.ddate AND CAST(p.activation_date AS DATE) <= u.ddate)) AS register_date)
    FROM usage_only_key u"""


def _by_subscriber(steps: dict[str, str]) -> dict[str, str]:
    """``steps`` in which the datamart's rows without a registration have that of the profile."""
    out: dict[str, str] = {}
    waiting = {}
    for name, sql in steps.items():
        if name == "usage_monthly":
            waiting = {"usage_only_key": sql, name: _BY_SUBSCRIBER}
            continue
        out[name] = sql
        if name == "profile":
            out |= waiting
    return out


def _carried() -> str:
    months = ["1998-06-30", "1998-05-31", "1998-04-30", "1998-03-31", "1998-02-28"]
    steps = o._usage_tables(months) | o._profile_tables(months)
    active = "charge_type = 'Pre-paid' AND mobile_status = 'SA'"
    steps["spine"] = f"""
    SELECT analytic_id, CAST(activation_date AS DATE) AS register_date, ddate AS prof_month FROM profile
    WHERE {active} AND ddate >= DATE '1998-04-30'"""
    steps["past"] = """
    SELECT * FROM (SELECT analytic_id, CAST(activation_date AS DATE) AS register_date, ddate, COLUMNS('^norms_.*') FROM profile)
    FULL JOIN (SELECT * FROM usage_monthly WHERE register_date IS NOT NULL) USING (analytic_id, register_date, ddate)"""
    steps["lagged"] = o._lagged("spine")
    lags = [lag_name(m, k) for k in (1, 2) for m in MEASURES]
    return o._statement(steps, o._select(["analytic_id", "register_date", "prof_month", *o._usage(lags)], "lagged"))


def all_statements() -> dict[str, str]:
    mart = ["analytic_id", "register_date", *o._usage(TOPUP), *o._usage(USAGE), "ddate"]
    return {
        "late_days_datamart": o._statement(o._usage_tables(o.SCORING), o._select(mart, "usage_monthly")),
        "carried_history": _carried(),
        "usage_by_subscriber": o._statement(
            _by_subscriber(o._usage_tables(o.SCORING) | o._profile_tables(o.SCORING)), o._select(mart, "usage_monthly")
        ),
        "scoring_set_by_subscriber": o._statement(
            _by_subscriber(o._feature_steps(False)), o._feature_rows(False, "with_slope")
        ),
    }
