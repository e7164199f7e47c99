from __future__ import annotations

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from subscore.functions.months import month_end
from subscore.operators import features
from subscore.plans.jobs import MonthlyTables, check_keys
from subscore.schemas import MEASURES, PROFILE_SCHEMA, REVENUE, USAGE_HISTORY, USAGE_MONTHLY_SCHEMA, lag_name
from tests.conftest import rows

MONTH = date(2019, 6, 30)
R = datetime(2015, 1, 1)


def _profile(spark, entries):
    """Entries: id, month, revenue, then overrides by column name."""
    made = []
    for subscriber, month, revenue, *more in entries:
        row = dict.fromkeys(PROFILE_SCHEMA.fieldNames()) | {
            "analytic_id": subscriber,
            "activation_date": R,
            "ddate": month,
            "charge_type": "Pre-paid",
            "mobile_status": "SA",
            "crm_sub_id": f"C{subscriber}",
        }
        row |= dict.fromkeys(REVENUE, revenue)
        for changes in more:
            row |= changes
        made.append(tuple(row[c] for c in PROFILE_SCHEMA.fieldNames()))
    return spark.createDataFrame(made, PROFILE_SCHEMA)


def _usage(spark, entries):
    made = []
    for subscriber, registered, month, value in entries:
        row = dict.fromkeys(USAGE_MONTHLY_SCHEMA.fieldNames()) | {
            "analytic_id": subscriber,
            "register_date": registered,
            "ddate": month,
            "sum_monthly_tran_topup": int(value),
            "sum_monthly_data_kb": float(value),
        }
        made.append(tuple(row[c] for c in USAGE_MONTHLY_SCHEMA.fieldNames()))
    return spark.createDataFrame(made, USAGE_MONTHLY_SCHEMA)


def _survey(spark, ids):
    return spark.createDataFrame(
        [(i, R, MONTH, "SA", 7) for i in ids],
        "analytic_id string, register_date timestamp, month_id date, mobile_status string, answer long",
    )


def _validity(spark, ids):
    return spark.createDataFrame(
        [(i, R, MONTH, "20190630", f"C{i}", 3.0) for i in ids],
        "analytic_id string, register_date timestamp, ddate date, date_id string, crm_subscription_id string,"
        " vald_res_10 double",
    )


def test_profile_snapshot_keeps_active_prepaid_of_the_month(spark):
    profile = _profile(
        spark,
        [
            ("a", MONTH, 1.0),
            ("b", MONTH, 1.0, {"charge_type": "Post-paid"}),
            ("c", MONTH, 1.0, {"mobile_status": "SP"}),
            ("d", month_end(MONTH, 1), 1.0),
        ],
    )
    assert [r.analytic_id for r in features.profile_snapshot(profile, MONTH).collect()] == ["a"]


def test_training_features_match_on_key_and_month(spark):
    labels = spark.createDataFrame(
        [("a", R.date(), 1, MONTH), ("b", date(2016, 1, 1), 0, MONTH), ("c", R.date(), 0, month_end(MONTH, 1))],
        "analytic_id string, register_date date, bad_flag int, prof_month date",
    )
    profile = _profile(spark, [(i, MONTH, 5.0) for i in "abc"])
    usage = _usage(spark, [("a", R.date(), MONTH, 4), ("a", None, MONTH, 9)])
    wide = features.assemble_training_features(
        labels, profile, usage, _survey(spark, "abc"), _validity(spark, "abc"), MONTH
    )
    got = rows(wide.select("analytic_id", "norms_net_revenue_gprs", "sum_monthly_data_kb", "answer", "vald_res_10"))
    assert got == [("a", 5.0, 4.0, 7, 3.0), ("b", None, None, None, None), ("c", None, None, None, None)]


def test_scoring_features_start_from_the_profile(spark):
    wide = features.assemble_scoring_features(
        _profile(spark, [("a", MONTH, 5.0), ("b", MONTH, 6.0)]),
        _usage(spark, [("b", R.date(), MONTH, 4), ("z", R.date(), MONTH, 4)]),
        _survey(spark, "a"),
        _validity(spark, "b"),
        MONTH,
    )
    got = rows(wide.select("analytic_id", "prof_month", "sum_monthly_data_kb", "answer", "vald_res_10"))
    assert got == [("a", MONTH, None, 7, None), ("b", MONTH, 4.0, None, 3.0)]


def test_a_column_on_both_sides_is_refused(spark):
    survey = _survey(spark, "a").withColumn("age", F.lit(1))
    with pytest.raises(ValueError, match="age"):
        features.assemble_scoring_features(
            _profile(spark, [("a", MONTH, 5.0)]), _usage(spark, []), survey, _validity(spark, "a"), MONTH
        )


def _history_case(spark):
    one, two, three = (month_end(MONTH, k) for k in (1, 2, 3))
    profile = _profile(
        spark,
        [
            ("a", one, 1.0),
            ("a", two, 2.0),
            ("a", three, 3.0),
            ("b", two, 4.0, {"charge_type": "Post-paid"}),
            ("gone", one, 5.0),
        ],
    )
    usage = _usage(spark, [("a", R.date(), two, 8), ("b", None, one, 9), ("c", R.date(), one, 6)])
    base = spark.createDataFrame(
        [(i, R.date(), MONTH) for i in "abcd"], "analytic_id string, register_date date, prof_month date"
    )
    return profile, usage, base


def test_lags_are_by_month_and_missing_months_are_null(spark):
    profile, usage, base = _history_case(spark)
    history = features.history_union_frame(
        features.history_window(features.profile_history(profile, MONTH), base),
        features.history_window(features.usage_history(usage, MONTH), base),
    )
    assert "gone" not in [r.analytic_id for r in history.collect()]
    lagged = features.attach_lags(base, history, MONTH)
    assert lagged.columns == [*base.columns, *[lag_name(m, k) for k in (1, 2) for m in MEASURES]]
    got = rows(
        lagged.select(
            "analytic_id",
            "norms_net_revenue_vas_p1",
            "norms_net_revenue_vas_p2",
            "sum_monthly_data_kb_p1",
            "sum_monthly_data_kb_p2",
        )
    )
    assert got == [
        ("a", 1.0, 2.0, None, 8.0),
        ("b", None, 4.0, None, None),
        ("c", None, None, 6.0, None),
        ("d", None, None, None, None),
    ]


def test_pivot_equals_two_joins_and_source_by_source(spark):
    profile, usage, base = _history_case(spark)
    history = features.history_union_frame(
        features.profile_history(profile, MONTH), features.usage_history(usage, MONTH)
    )
    expected = base
    for lag in (1, 2):
        month = history.filter(F.col("ddate") == F.lit(month_end(MONTH, lag))).drop("ddate")
        month = month.withColumnsRenamed({m: lag_name(m, lag) for m in MEASURES})
        expected = expected.join(month, ["analytic_id", "register_date"], "left")
    united = features.attach_lags(base, history, MONTH)
    assert rows(united) == rows(expected.select(*united.columns))
    by_source = features.attach_lags(base, features.profile_history(profile, MONTH), MONTH, REVENUE)
    by_source = features.attach_lags(by_source, features.usage_history(usage, MONTH), MONTH, USAGE_HISTORY)
    assert rows(by_source.select(*united.columns)) == rows(united)


def test_repeated_keys_are_reported(spark):
    tables = MonthlyTables(
        profile=_profile(spark, [("a", MONTH, 5.0), ("b", MONTH, 5.0)]),
        usage_monthly=_usage(spark, [("a", R.date(), MONTH, 4), ("z", None, MONTH, 4), ("z", None, MONTH, 4)]),
        topup_survey=_survey(spark, "ab"),
        validity=_validity(spark, "ab"),
    )
    check_keys(tables, MONTH)
    with pytest.raises(ValueError, match="topup_survey repeats"):
        check_keys(MonthlyTables(tables.profile, tables.usage_monthly, _survey(spark, "aa"), tables.validity), MONTH)
    last = month_end(MONTH, 1)
    twice = tables.profile.unionByName(_profile(spark, [("c", last, 1.0), ("c", last, 2.0)]))
    with pytest.raises(ValueError, match=f"profile history repeats a subscription in {last}"):
        check_keys(MonthlyTables(twice, tables.usage_monthly, tables.topup_survey, tables.validity), MONTH)
