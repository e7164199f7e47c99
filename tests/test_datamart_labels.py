from __future__ import annotations

import math
import statistics
from datetime import date, datetime

from pyspark.sql import functions as F

from subscore.operators import datamart, labels
from subscore.schemas import LOANS_SCHEMA, TOPUP_DAILY_SCHEMA, USAGE_DAILY_SCHEMA
from tests.conftest import rows

MONTH = date(2019, 6, 30)
R1, R2 = datetime(2015, 1, 1), datetime(2016, 1, 1)


def _topup(spark):
    return spark.createDataFrame(
        [
            ("a", R1, date(2019, 6, 1), 1, 10.0),
            ("a", R1, date(2019, 6, 30), 3, 30.0),
            ("a", R2, date(2019, 6, 2), 5, 50.0),
            ("b", R1, date(2019, 6, 2), 2, 20.0),
            ("b", R1, date(2019, 7, 1), 9, 90.0),
        ],
        TOPUP_DAILY_SCHEMA,
    )


def _usage(spark):
    return spark.createDataFrame(
        [
            ("a", date(2019, 6, 1), 1.0, 2.0, 3, 4.0, 5, 6),
            ("a", date(2019, 6, 5), 1.0, 2.0, 3, 4.0, 5, 6),
            ("c", date(2019, 6, 30), 7.0, 7.0, 7, 7.0, 7, 7),
            ("c", date(2019, 5, 31), 9.0, 9.0, 9, 9.0, 9, 9),
        ],
        USAGE_DAILY_SCHEMA,
    )


def test_topup_statistics(spark):
    result = {(r.analytic_id, r.register_date): r for r in datamart.topup_monthly(_topup(spark), MONTH).collect()}
    assert len(result) == 3
    two = result["a", R1.date()]
    assert (two.sum_monthly_tran_topup, two.mean_monthly_topup_tran) == (4, 2.0)
    assert (two.min_monthly_topup_value, two.max_monthly_topup_value) == (10.0, 30.0)
    assert math.isclose(two.sd_monthly_topup_value, math.sqrt(200))
    assert result["b", R1.date()].sd_monthly_topup_tran is None
    assert result["b", R1.date()].sum_monthly_topup_value == 20.0


def test_datamart_keeps_both_outer_sides(spark):
    mart = datamart.usage_datamart(_topup(spark), _usage(spark), MONTH)
    got = rows(mart.select("analytic_id", "register_date", "sum_monthly_tran_topup", "sum_monthly_data_kb", "ddate"))
    assert got == [
        ("a", R1.date(), 4, 2.0, MONTH),
        ("a", R2.date(), 5, 2.0, MONTH),
        ("b", R1.date(), 2, None, MONTH),
        ("c", None, None, 7.0, MONTH),
    ]


def test_a_subscriber_with_a_third_of_the_daily_rows(spark):
    daily = spark.range(6000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise((F.col("id") % 500).cast("string")).alias("analytic_id"),
        F.lit(R1).alias("register_date"),
        F.date_add(F.lit(date(2019, 6, 1)), (F.col("id") % 30).cast("int")).alias("ddate"),
        (F.col("id") % 5).alias("top_up_tran"),
        (F.col("id") % 7).cast("double").alias("top_up_value"),
    )
    monthly = datamart.topup_monthly(daily, MONTH)
    (hot,) = monthly.filter("analytic_id = 'hot'").collect()
    ids = range(0, 6000, 3)
    assert hot.sum_monthly_tran_topup == sum(i % 5 for i in ids)
    assert hot.sum_monthly_topup_value == sum(i % 7 for i in ids)
    assert math.isclose(hot.sd_monthly_topup_value, statistics.stdev(i % 7 for i in ids))
    plan = monthly._jdf.queryExecution().executedPlan().toString()
    assert plan.index("partial_sum") > plan.index("Exchange hashpartitioning")


def test_several_months_in_one_pass(spark):
    topup, usage = _topup(spark), _usage(spark)
    july = date(2019, 7, 31)
    together = datamart.usage_datamart(topup, usage, july, months=3)
    apart = [datamart.usage_datamart(topup, usage, m) for m in (date(2019, 5, 31), MONTH, july)]
    assert rows(together) == rows(apart[0].unionByName(apart[1]).unionByName(apart[2]))


def _loans(spark):
    return spark.createDataFrame(
        [
            ("bad", date(2015, 1, 1), MONTH, -1.0, 0),
            ("recharged", date(2015, 1, 1), MONTH, -1.0, 3),
            ("zero", date(2015, 1, 1), MONTH, 0.0, 0),
            ("unknown", date(2015, 1, 1), MONTH, None, 0),
            ("decided", date(2015, 1, 1), MONTH, None, 2),
            ("twice", date(2015, 1, 1), MONTH, -1.0, 0),
            ("twice", date(2016, 1, 1), MONTH, 5.0, 0),
            (None, date(2015, 1, 1), MONTH, 5.0, 0),
            (None, date(2015, 1, 1), MONTH, 5.0, 0),
            ("old", date(2015, 1, 1), date(2019, 5, 31), -1.0, 0),
        ],
        LOANS_SCHEMA,
    )


def test_bad_flag_and_profile_month(spark):
    labelled = labels.label_bad_debtors(_loans(spark), date(2019, 7, 15))
    flags = {r.analytic_id: r.bad_flag for r in labelled.collect()}
    assert flags["bad"] == 1
    assert flags["recharged"] == flags["zero"] == flags["decided"] == 0
    assert flags["unknown"] is None
    assert "old" not in flags
    assert [r.prof_month for r in labelled.select("prof_month").distinct().collect()] == [date(2019, 3, 31)]


def test_repeated_subscribers_lose_all_rows_and_null_ids_stay(spark):
    labelled = labels.label_bad_debtors(_loans(spark), date(2019, 7, 15))
    kept = labels.drop_duplicated_subscribers(labelled)
    assert kept.columns == labelled.columns
    ids = [r.analytic_id for r in kept.collect()]
    assert sorted(i for i in ids if i) == ["bad", "decided", "recharged", "unknown", "zero"]
    assert ids.count(None) == 2
    assert rows(labels.drop_duplicated_subscribers(labelled, keep_unknown=False)) == rows(
        kept.filter("analytic_id IS NOT NULL")
    )


def test_a_subscriber_with_a_third_of_all_rows(spark):
    """Equal to the count-and-anti-join form, and no task receives the hot rows."""
    hot = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("analytic_id"),
        F.lit(date(2015, 1, 1)).alias("register_date"),
        F.col("id").alias("payload"),
    )
    kept = labels.drop_duplicated_subscribers(hot)
    repeated = hot.groupBy("analytic_id").count().filter("count > 1")
    assert rows(kept) == rows(hot.join(repeated, "analytic_id", "left_anti"))
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "partial_count" in plan
    assert "Join" not in plan
