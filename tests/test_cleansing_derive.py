from __future__ import annotations

import math
from functools import reduce

import numpy as np
import pytest
from pyspark.ml.feature import Imputer
from pyspark.sql import functions as F

from subscore.operators import cleansing, derive
from subscore.schemas import LAG_COLUMNS, MEASURES, lag_name
from tests.conftest import rows


def test_eligibility(spark):
    df = spark.createDataFrame(
        [
            ("ok", "SA", 4, 40.0, "33"),
            ("text", "SA", 9, 40.0, "n/a"),
            ("status", "SP", 9, 90.0, "1"),
            ("young", "SA", 3, 90.0, "1"),
            ("poor", "SA", 9, 39.99, "1"),
            ("unknown", "SA", None, 90.0, "1"),
            ("norev", "SA", 9, None, "1"),
            (None, "SA", 9, 90.0, "1"),
        ],
        "analytic_id string, mobile_status string, service_month long, norms_net_revenue_avg_3mth_p0_p2 double,"
        " age string",
    )
    got = rows(cleansing.eligible_base(df).select("analytic_id", "age"))
    assert got == [("ok", 33.0), ("text", None)]


def test_mean_imputation_equals_the_library_imputer(spark):
    df = spark.createDataFrame(
        [(1.0, 10.0), (None, 20.0), (float("nan"), None), (4.0, float("nan"))], "age double, credit_limit double"
    )
    columns = ["age", "credit_limit"]
    expected = Imputer(inputCols=columns, outputCols=columns).fit(df).transform(df)
    assert rows(cleansing.impute_mean(df, columns)) == rows(expected)
    given = cleansing.impute_mean(df, columns, means={"age": -1, "credit_limit": -2})
    assert rows(given) == [(-1.0, -2.0), (-1.0, 20.0), (1.0, 10.0), (4.0, -2.0)]


def test_mean_is_a_subquery_and_no_join(spark):
    df = spark.range(10).select(F.col("id").cast("double").alias("age"))
    plan = cleansing.impute_mean(df, ["age"])._jdf.queryExecution().executedPlan().toString()
    assert "Subquery" in plan
    assert "Join" not in plan


def test_zero_and_unknown_imputation(spark):
    df = spark.createDataFrame([(None, None), (float("nan"), "x"), (float("inf"), "y")], "v double, gender string")
    filled = cleansing.impute_unknown(cleansing.impute_zero(df, ["v"]), ["gender"])
    assert rows(filled) == [(0.0, "unknown"), (0.0, "x"), (float("inf"), "y")]


@pytest.mark.parametrize(
    ("segment", "group"),
    [
        (None, "Classic"),
        ("NA", "Classic"),
        ("Prospect Emerald", "Classic"),
        ("Platinum Plus", "Platinum"),
        ("Prospect Plat Plus", "Platinum"),
        ("Prospect Platinum", "Gold"),
        ("Prospect Gold", "Emerald"),
        ("Standard", "Classic"),
        ("Gold", "Gold"),
    ],
)
def test_segments(spark, segment, group):
    df = spark.createDataFrame([(segment,)], "master_segment_id string")
    assert rows(cleansing.regroup_segment(df)) == [(group,)]


def test_imputed_handset_system_counts_as_other(spark):
    df = spark.createDataFrame([("Android",), ("Unknown",), (None,), ("Symbian",)], "handset_os string")
    got = rows(cleansing.bucket_handset_os(cleansing.impute_unknown(df, ["handset_os"])))
    assert got == [("Android",), ("Unknown",), ("others",), ("others",)]


def test_default_flag(spark):
    df = spark.createDataFrame([("Y",), (None,)], "mnp_flag string")
    assert rows(cleansing.default_flag(df)) == [("N",), ("Y",)]


def _triples(spark, triples):
    """One row per triple, every measure holding it."""
    df = spark.createDataFrame(
        [(i, *t) for i, t in enumerate(triples)], "id long, p0 double, p1 double, p2 double"
    )
    named = {m: F.col("p0") for m in MEASURES}
    for lag in (1, 2):
        named |= {lag_name(m, lag): F.col(f"p{lag}") for m in MEASURES}
    return df.withColumns(named).withColumn("national_id", F.lit("n"))


def test_derived_features_of_special_triples(spark):
    df = _triples(spark, [(4.0, 2.0, 2.0), (0.0, 0.0, 0.0), (5.0, 0.0, 0.0), (-1.0, 1.0, -1.0)])
    final = derive.derive_features(df)
    m = MEASURES[0]
    got = {r.id: (r[f"avg_{m}"], r[f"sd_{m}"], r[f"slope_{m}_p1"]) for r in final.collect()}
    assert got[0] == pytest.approx((8 / 3, math.sqrt(8 / 9), 1.0))
    assert got[1] == (0.0, 0.0, 0.0)
    assert got[2][2] == 0.0
    assert got[3][2] == 0.0
    assert not set(final.columns) & {*LAG_COLUMNS, "national_id"}


def test_derived_features_against_numpy(spark):
    values = np.random.default_rng(7).normal(100, 30, (200, 3))
    df = _triples(spark, [tuple(map(float, v)) for v in values])
    final = derive.derive_features(df).orderBy("id").toPandas()
    for m in (MEASURES[0], MEASURES[-1]):
        np.testing.assert_allclose(final[f"avg_{m}"], values.mean(axis=1))
        np.testing.assert_allclose(final[f"sd_{m}"], values.std(axis=1))
        np.testing.assert_allclose(final[f"slope_{m}_p1"], values[:, 0] / values[:, 1:].mean(axis=1) - 1)


def test_unknown_label_counts_as_good(spark):
    df = _triples(spark, [(1.0, 1.0, 1.0)]).withColumn("bad_flag", F.lit(None).cast("int"))
    assert derive.derive_features(df).first().bad_flag == 0


def test_projection_has_no_shuffle(spark):
    df = reduce(lambda d, f: f(d), [derive.derive_features], _triples(spark, [(1.0, 1.0, 1.0)]))
    assert "Exchange" not in df._jdf.queryExecution().executedPlan().toString()
