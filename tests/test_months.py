from __future__ import annotations

from datetime import date, timedelta

import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from subscore.functions import months
from tests.conftest import rows


@pytest.mark.parametrize(
    ("as_of", "lag", "begin", "end"),
    [
        (date(2019, 3, 31), 1, date(2019, 2, 1), date(2019, 2, 28)),
        (date(2020, 3, 31), 1, date(2020, 2, 1), date(2020, 2, 29)),
        (date(2019, 1, 1), 1, date(2018, 12, 1), date(2018, 12, 31)),
        (date(2019, 1, 31), 0, date(2019, 1, 1), date(2019, 1, 31)),
        (date(2019, 6, 30), 14, date(2018, 4, 1), date(2018, 4, 30)),
    ],
)
def test_month_bounds(as_of, lag, begin, end):
    assert months.month_begin(as_of, lag) == begin
    assert months.month_end(as_of, lag) == end


@given(st.dates(date(1990, 1, 1), date(2100, 1, 1)), st.integers(0, 400))
def test_month_end_is_a_last_day_the_right_number_of_months_back(as_of, lag):
    end = months.month_end(as_of, lag)
    assert (end + timedelta(days=1)).day == 1
    assert (as_of.year - end.year) * 12 + as_of.month - end.month == lag


def test_slices(spark):
    days = [date(2019, 4, 30), date(2019, 5, 1), date(2019, 5, 31), date(2019, 6, 1), date(2019, 6, 30), date(2019, 7, 1)]
    df = spark.createDataFrame([(d,) for d in days], "ddate date")
    as_of = date(2019, 7, 15)
    assert rows(months.month_slice(df, as_of, 1)) == [(days[3],), (days[4],)]
    assert rows(months.month_slice(df, as_of, 1, months=2)) == [(d,) for d in days[1:5]]
    assert rows(months.month_slice(df, as_of, 1, snapshot=True)) == [(days[4],)]
    with pytest.raises(ValueError, match="one month"):
        months.month_slice(df, as_of, 1, months=2, snapshot=True)


def test_shifted_month_ends_are_month_ends(spark):
    ends = [date(2019, 1, 31), date(2019, 2, 28), date(2019, 3, 31), date(2019, 6, 30), date(2020, 2, 29)]
    df = spark.createDataFrame([(d,) for d in ends], "ddate date")
    for k in (1, 2, 3):
        shifted = months.add_shifted_month(df, k)
        assert rows(shifted, "ddate") == [(d, months.month_end(d, k)) for d in ends]


def test_month_filter_reaches_the_scan(spark, tmp_path):
    path = str(tmp_path / "monthly")
    df = spark.range(24).select(F.add_months(F.lit(date(2018, 1, 31)), F.col("id").cast("int")).alias("ddate"), "id")
    df.write.partitionBy("ddate").parquet(path)
    plan = months.month_slice(spark.read.parquet(path), date(2019, 7, 1), 1, snapshot=True)
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(ddate" in text
    assert plan.count() == 1
