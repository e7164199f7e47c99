"""Intervals, hulls, deliveries and sketches against plain computations."""

from __future__ import annotations

import random
from datetime import date

import numpy as np
import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from subscore.operators import envelope, hull, profit, stage_profile
from subscore.schemas import LIFT_SCHEMA, SCORES_SCHEMA
from subscore.sources.delivered import read_delivered
from tests.conftest import rows

MONTHS = [date(2019, 5, 31), date(2019, 6, 30)]


def _lift(spark):
    rng = random.Random(3)
    table = [
        (d, rng.uniform(1, 3), 100, 100 * d, 1 - d / 10, 0.2, 20 * d, rng.uniform(0.1, 0.5), 0.1, 0.02 * d + rng.random() / 50, 1.0, m)
        for m in MONTHS
        for d in range(1, 11)
    ]
    return spark.createDataFrame(table, LIFT_SCHEMA)


@pytest.mark.parametrize("varied, low, high", [("fee", 0, 30), ("loan", 0, 150), ("takeup", 0, 100)])
def test_intervals_hold_the_best_decile_of_a_grid(spark, varied, low, high):
    lift = _lift(spark)
    found = rows(envelope.best_decile_intervals(lift, varied, low, high), "prof_date")
    grid = [low + (high - low) * (k + 0.5) / 40 for k in range(40)]
    best = profit.best_decile(profit.profit_loss(profit.with_scenarios(lift, **({"takeup": [20]} | {varied: grid}))))
    for r in best.collect():
        inside = [f for f in found if f[0] == r.prof_date and f[3] <= r[varied] < f[4]]
        assert [f[2] for f in inside] == [r.decile]
        (_, _, _, a, b, p, q) = inside[0]
        assert r.p_l == pytest.approx(p + (q - p) * (r[varied] - a) / (b - a))
    for month in MONTHS:
        pieces = sorted(f[3:5] for f in found if f[0] == month)
        assert (pieces[0][0], pieces[-1][1]) == (low, high)
        assert [a for a, _ in pieces[1:]] == pytest.approx([b for _, b in pieces[:-1]])


def test_envelope_of_equal_parallel_and_unknown_lines(spark):
    lines = [("a", 3, 1.0, 0.0), ("a", 2, 1.0, 0.0), ("a", 1, 1.0, -1.0), ("a", 4, None, 9.0), ("a", 5, 0.5, 0.0),
             ("b", 1, 0.0, 5.0), (None, 7, 2.0, 1.0)]
    df = spark.createDataFrame(lines, "g string, k int, slope double, intercept double")
    found = envelope.upper_envelope(df, 0, 10, "g", "k").select("g", "k", "from_value", "to_value")
    # The line 0.5 x meets x at 0 only; a null group is a group.
    assert rows(found) == [("a", 2, 0.0, 10.0), ("b", 1, 0.0, 10.0), (None, 7, 0.0, 10.0)]
    assert envelope.upper_envelope(df.limit(0), 0, 10, "g", "k").count() == 0
    with pytest.raises(ValueError):
        envelope.profit_lines(_lift(spark), "decile")


def _plain_hull(points):
    out = []
    for p in sorted(points):
        while len(out) > 1:
            (ax, ay), (bx, by) = out[-2:]
            if (bx - ax) * (p[1] - by) < (by - ay) * (p[0] - bx):
                break
            out.pop()
        out.append(p)
    return out


@given(st.sets(st.tuples(st.integers(0, 30), st.integers(0, 30)), min_size=1, max_size=60))
def test_hull_equals_a_scan(points):
    some = list(points)
    x, y = np.array(some).T
    assert [some[k] for k in hull.upper_hull(x, y)] == _plain_hull(points)


def test_hull_of_very_large_counts_is_exact():
    n = 3_000_000_000
    x, y = np.array([0, n // 2, n]), np.array([0, n // 2 + 1, n])
    assert hull.upper_hull(x, y).tolist() == [0, 1, 2]
    assert hull.upper_hull(x, np.array([0, n // 2, n])).tolist() == [0, 2]


def test_roc_hull_by_any_partitions(spark):
    rng = random.Random(5)
    table = [(rng.randrange(60) / 60, rng.choice([0, 1, 1, None, 2])) for _ in range(900)]
    table += [(None, 1), (0.5, None)]
    labelled = [(s, b) for s, b in table if b in (0, 1) and s is not None]
    points = {(0, 0)} | {
        (sum(b == 0 for s, b in labelled if s >= t), sum(b == 1 for s, b in labelled if s >= t)) for t in {s for s, _ in labelled}
    }
    df = spark.createDataFrame(table, "score double, bad int")
    for parts in (1, 7):
        got = hull.roc_hull(df.repartition(parts), "score", "bad").orderBy("false_positives", "true_positives").collect()
        assert [(r.false_positives, r.true_positives) for r in got] == _plain_hull(points)
        assert got[0].threshold is None
        assert (got[-1].false_positive_rate, got[-1].true_positive_rate) == (1.0, 1.0)
    assert hull.roc_hull(df.limit(0), "score", "bad").count() == 0
    # A single class has no rate on the other axis.
    one = hull.roc_hull(df.filter("bad = 1"), "score", "bad").orderBy("true_positives").collect()
    assert [(r.false_positives, r.false_positive_rate) for r in one] == [(0, None)] * 2


def _deliver(folder, **files):
    folder.mkdir()
    for name, text in files.items():
        (folder / f"{name}.csv").write_text(text)
    return str(folder)


HEADER = "crm_sub_id,analytic_id,register_date,p0\n"


def test_bad_rows_go_to_quarantine(spark, tmp_path):
    path = _deliver(
        tmp_path / "in",
        one=HEADER + "007,1,2019-01-01,0.5\nC2,2,2019-13-01,0.5\nC3,3,2019-01-01\nC4,4,2019-01-01,0.5,x\n\n",
        two=HEADER + "C5,5,2019-01-01,high\n,6,2019-01-01,0.5\nC7,7,,0.1\n\"C,8\",8,2019-01-01,\n",
        three=HEADER,
    )
    for _ in range(2):  # running it again replaces both tables
        read = read_delivered(spark, path, SCORES_SCHEMA, str(tmp_path / "out"), ["crm_sub_id", "register_date"])
        assert rows(read.good) == [("007", "1", date(2019, 1, 1), 0.5), ("C,8", "8", date(2019, 1, 1), None)]
        faults = {(r.record, r.fault, r.source.rsplit("/", 1)[1]) for r in read.quarantine.collect()}
        assert faults == {
            ("C2,2,2019-13-01,0.5", "malformed", "one.csv"),
            ("C3,3,2019-01-01", "malformed", "one.csv"),
            ("C4,4,2019-01-01,0.5,x", "malformed", "one.csv"),
            ("C5,5,2019-01-01,high", "malformed", "two.csv"),
            (",6,2019-01-01,0.5", "missing crm_sub_id", "two.csv"),
            ("C7,7,,0.1", "missing register_date", "two.csv"),
        }
        counted = {(r.source.rsplit("/", 1)[1], r.fault): r.n_rows for r in read.counts().collect()}
        assert counted[("one.csv", "malformed")] == 3
        # A column by itself is read as well as all of them.
        assert read.good.agg(F.count("p0")).first()[0] == 1


def test_deliveries_without_rows_or_with_another_header(spark, tmp_path):
    empty = read_delivered(spark, _deliver(tmp_path / "a", one=HEADER), SCORES_SCHEMA, str(tmp_path / "x"))
    assert (empty.good.count(), empty.quarantine.count()) == (0, 0)
    other = _deliver(tmp_path / "b", one="analytic_id,crm_sub_id,register_date,p0\n1,2,2019-01-01,0.5\n")
    with pytest.raises(Exception, match="header"):
        read_delivered(spark, other, SCORES_SCHEMA, str(tmp_path / "y"))
    with pytest.raises(ValueError):
        read_delivered(spark, other, SCORES_SCHEMA, str(tmp_path / "y"), ["no_column"])


def test_profiles_merge_to_that_of_all_rows(spark, tmp_path):
    df = spark.range(20_000).select(
        F.when(F.col("id") % 2 == 0, F.lit(MONTHS[0])).otherwise(F.lit(MONTHS[1])).alias("month_id"),
        (F.col("id") % 1000 - 500).cast("double").alias("x"),
        F.when(F.col("id") % 4 == 0, F.col("id")).alias("some id"),
        F.lit(None).cast("double").alias("nothing"),
        F.when(F.col("id") < 100, F.lit(float("nan"))).otherwise(-0.0).alias("odd"),
        F.lit("text").alias("text"),
    )
    target = str(tmp_path / "states")
    for month in [*MONTHS, MONTHS[0]]:  # the month that comes again replaces itself
        part = df.filter(F.col("month_id") == F.lit(month))
        stage_profile.store_states(stage_profile.profile_states(part, "base", "month_id"), target)
    stage_profile.store_states(stage_profile.profile_states(df.limit(0), "none", "month_id"), target)
    states = spark.read.parquet(target)
    merged = {r.column_name: r for r in stage_profile.merged_profile(states, ["stage"]).collect()}
    assert set(merged) == {"x", "some id", "nothing", "odd"}
    x, some, nothing, odd = (merged[c] for c in ("x", "some id", "nothing", "odd"))
    assert (x.n_rows, x.n_null, x.least, x.largest) == (20_000, 0, -500, 499)
    assert abs(x.n_distinct - 1000) <= 50
    for got, wanted in zip(x.quantiles, (0.25, 0.5, 0.75)):
        assert abs((got + 500) / 1000 - wanted) <= stage_profile.RANK_ERROR + 0.001
    assert (some.n_null, some.least, some.largest) == (15_000, 0, 19_996)
    assert abs(some.n_distinct - 5000) <= 250
    assert (nothing.n_rows, nothing.n_values, nothing.n_distinct, nothing.quantiles, nothing.least) == (20_000, 0, 0, None, None)
    assert (odd.n_null, odd.n_distinct, odd.largest) == (100, 1, 0.0)
    per_month = stage_profile.merged_profile(states, ["month"]).filter("column_name = 'some id'")
    assert {(r.month, r.n_values) for r in per_month.collect()} == {(MONTHS[0], 5000), (MONTHS[1], 0)}


def test_profile_is_one_shuffle_with_partial_sums(spark):
    df = spark.range(10).select(F.lit(MONTHS[0]).alias("m"), F.col("id").alias("x"))
    plan = stage_profile.profile_states(df, "s", "m")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "partial_kll" in plan.lower()
