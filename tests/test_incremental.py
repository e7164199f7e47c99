"""Late days, carried history, usage by subscriber, keys checked within the pass."""

from __future__ import annotations

import random
from dataclasses import replace
from datetime import date, datetime, timedelta

import pytest
from conftest import rows
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from registry import views as v
from subscore.functions.months import month_end
from subscore.operators import datamart, features, incremental
from subscore.plans import jobs
from subscore.schemas import MEASURES, SUBSCRIPTION_KEY, TOPUP, USAGE, lag_name

TOPUP_COLUMNS = "analytic_id string, register_date timestamp, ddate date, top_up_tran bigint, top_up_value double"
USAGE_COLUMNS = (
    "analytic_id string, ddate date, data_vol_kb double, voice_out_minute double, voice_out_cnt bigint, "
    "voice_in_minute double, voice_in_cnt bigint, sms_in_cnt bigint"
)
MONTHS = [date(2019, 6, 30), date(2019, 7, 31), date(2019, 8, 31)]


def _days(seed=1):
    """Hot and rare subscribers, null ids, values and registrations, large means with small deviations."""
    rng = random.Random(seed)
    topup, usage = [], []
    for _ in range(600):
        who = rng.choice(["hot", "hot", "hot", None, *(f"s{k}" for k in range(30))])
        day = date(2019, 6, 1) + timedelta(days=rng.randrange(92))
        registered = rng.choice([None, datetime(2018, 1, 1), datetime(2019, 1, 1, 5)])
        value = rng.choice([None, 1e9 + rng.randrange(3), 20.0, 0.1])
        topup.append((who, registered, day, rng.choice([None, 1, 2, 3]), value))
        if rng.random() < 0.7:
            usage.append((who if rng.random() < 0.5 else f"u{rng.randrange(9)}", day, 1.5, None, 2, 0.25, rng.randrange(5), 1))
    return topup, usage


def _rounded(df):
    doubles = {c for c, kind in df.dtypes if kind == "double"}
    return rows(df.select(*[F.round(c, 4).alias(c) if c in doubles else c for c in [*SUBSCRIPTION_KEY, *TOPUP, *USAGE, "ddate"]]))


def test_deliveries_in_any_order_give_the_whole_datamart(spark, tmp_path):
    topup, usage = (spark.createDataFrame(r, c) for r, c in zip(_days(), (TOPUP_COLUMNS, USAGE_COLUMNS)))
    expected = _rounded(datamart.usage_datamart(topup, usage, MONTHS[-1], months=3))
    for k, order in enumerate(([0, 1, 2], [2, 0, 2, 1])):
        states, target = (str(tmp_path / f"{n}{k}") for n in ("states", "mart"))
        for batch in order:
            part = F.pmod(F.dayofyear("ddate") * 5, F.lit(3)) == batch
            touched = incremental.refresh_datamart(topup.filter(part), usage.filter(part), states, target, f"b{batch}")
            assert touched == MONTHS
        assert _rounded(spark.read.parquet(target)) == expected
    one = incremental.datamart_of_states(spark, states, MONTHS[1:2])
    assert _rounded(one) == [r for r in expected if r[-1] == MONTHS[1]]


def test_a_late_day_changes_its_month_only(spark, tmp_path):
    topup, usage = (spark.createDataFrame(r, c) for r, c in zip(_days(2), (TOPUP_COLUMNS, USAGE_COLUMNS)))
    states, target = str(tmp_path / "states"), str(tmp_path / "mart")
    late = F.col("ddate") == F.lit(date(2019, 6, 12))
    incremental.refresh_datamart(topup.filter(~late), usage.filter(~late), states, target, "first")
    files = {f for f in spark.read.parquet(target).inputFiles() if "2019-06-30" not in f}
    assert incremental.refresh_datamart(topup.filter(late), usage.filter(late), states, target, "late") == MONTHS[:1]
    assert {f for f in spark.read.parquet(target).inputFiles() if "2019-06-30" not in f} == files
    assert _rounded(spark.read.parquet(target)) == _rounded(datamart.usage_datamart(topup, usage, MONTHS[-1], months=3))
    nothing = incremental.refresh_datamart(topup.filter("false"), usage.filter("false"), states, target, "none")
    assert nothing == []
    with pytest.raises(ValueError):
        incremental.add_days(topup, usage, states, "a/b")


def test_large_means_keep_their_deviation(spark, tmp_path):
    values = [1e9 + k % 3 for k in range(60)]
    topup = spark.createDataFrame([("a", None, date(2019, 6, 1 + k % 30), 1, x) for k, x in enumerate(values)], TOPUP_COLUMNS)
    usage = spark.createDataFrame([], USAGE_COLUMNS)
    for k in range(3):
        incremental.add_days(topup.filter(F.dayofmonth("ddate") % 3 == k), usage, str(tmp_path / "s"), f"b{k}")
    found = incremental.datamart_of_states(spark, str(tmp_path / "s"), MONTHS[:1]).first()
    mean = sum(values) / 60
    assert abs(found.sd_monthly_topup_value - (sum((x - mean) ** 2 for x in values) / 59) ** 0.5) < 1e-6


@pytest.mark.parametrize("kind", ["folder", "table"])
def test_carried_history_equals_lags(spark, data_folder, tmp_path, kind):
    target = str(tmp_path / "history") if kind == "folder" else "carried_history_test"
    profile = v.profile(spark, data_folder, v.SCORING_MONTH, 6).cache()
    usage = v.usage_monthly(spark, data_folder, v.SCORING_MONTH, 6).cache()
    skipped = 3  # this many months back nothing was carried
    moved = []
    for lag in range(5, 0, -1):
        month = month_end(v.SCORING_MONTH, lag)
        if lag != skipped:
            moved.append(incremental.advance_history(profile, usage, target, month, buckets=4 if kind == "table" else 0))
            assert not incremental.advance_history(profile, usage, target, month)
    assert all(moved)
    history = spark.read.parquet(target) if kind == "folder" else spark.table(target)
    for lag in (3, 1, 0):
        month = month_end(v.SCORING_MONTH, lag)
        base = features.profile_spine(profile, month).select(*SUBSCRIPTION_KEY, "prof_month")
        got = incremental.attach_carried(base, history, month)
        past = features.history_union_frame(features.profile_history(profile, month), features.usage_history(usage, month))
        if lag == 1:  # the month before the last one carried is the skipped one
            gone = {lag_name(m, 2): F.lit(None) for m in MEASURES}
            expected = features.attach_lags(base, past, month).withColumns(gone)
        else:
            expected = features.attach_lags(base, past, month)
        assert rows(got) == rows(expected.select(*got.columns))
    assert history.filter(F.col("state_month") == F.lit(month_end(v.SCORING_MONTH, skipped))).count() == 0


def test_usage_takes_the_registration_of_its_month_end(spark):
    mart = [("a", date(2018, 1, 1), 1.0, MONTHS[0]), ("b", None, 2.0, MONTHS[0]), ("c", None, 3.0, MONTHS[0]), ("d", None, 4.0, MONTHS[0]),
            ("b", None, 5.0, MONTHS[1]), (None, None, 6.0, MONTHS[0]), ("e", None, 7.0, MONTHS[0])]
    usage = spark.createDataFrame(mart, "analytic_id string, register_date date, sum_monthly_data_kb double, ddate date")
    known = [("a", datetime(2019, 1, 1), MONTHS[0]), ("b", datetime(2018, 5, 5), MONTHS[0]), ("b", datetime(2019, 5, 5), MONTHS[0]),
             ("b", datetime(2019, 7, 5), MONTHS[0]), ("b", datetime(2019, 7, 5), MONTHS[1]), ("c", None, MONTHS[0]), (None, datetime(2018, 1, 1), MONTHS[0]),
             ("e", datetime(2019, 6, 30, 23), MONTHS[0]), ("e", datetime(2019, 6, 30, 23), MONTHS[0])]
    profile = spark.createDataFrame(known, "analytic_id string, activation_date timestamp, ddate date")
    got = {(r.analytic_id, r.sum_monthly_data_kb): r.register_date for r in features.with_registrations(usage, profile).collect()}
    assert got == {("a", 1.0): date(2018, 1, 1), ("b", 2.0): date(2019, 5, 5), ("c", 3.0): None, ("d", 4.0): None,
                   ("b", 5.0): date(2019, 7, 5), (None, 6.0): None, ("e", 7.0): date(2019, 6, 30)}
    with pytest.raises(ValueError):
        features.usage_by("analytic_id", usage, profile)


@pytest.mark.parametrize("name", ["profile", "usage_monthly", "topup_survey", "validity"])
def test_a_repeated_key_fails_the_job_that_meets_it(spark, data_folder, tmp_path, name):
    good = v.monthly_tables(spark, data_folder, v.SCORING_MONTH)
    table = getattr(good, name)
    bad = replace(good, **{name: table.unionByName(table)})
    with pytest.raises(PySparkException, match="a subscription repeats"):
        jobs.build_scoring_set(bad, v.AS_OF).write.parquet(str(tmp_path / "s"))
    if name != "profile":  # the labels join one row of each
        return
    good = v.monthly_tables(spark, data_folder, v.TRAINING_MONTH)
    bad = replace(good, profile=good.profile.unionByName(good.profile))
    with pytest.raises(PySparkException, match="a subscription repeats"):
        jobs.build_training_set(v.loans(spark, data_folder), bad, v.AS_OF).write.parquet(str(tmp_path / "t"))


def test_keys_are_checked_without_another_shuffle(spark, data_folder, monkeypatch):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    tables = v.monthly_tables(spark, data_folder, v.SCORING_MONTH)

    def plan():
        return jobs.build_scoring_set(tables, v.AS_OF)._jdf.queryExecution().executedPlan().toString()

    try:
        checked = plan()
        monkeypatch.setattr(jobs, "unique_keys", lambda df: df)
        assert "Window" in checked and "Window" not in plan()
        assert checked.count("Exchange") == plan().count("Exchange")
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
