from __future__ import annotations

import hashlib
from datetime import date

import numpy as np
import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import Window
from pyspark.sql import functions as F

from subscore.functions import hashing
from subscore.functions.positions import with_positions
from subscore.operators import metrics, ranking
from subscore.schemas import SCORES_SCHEMA, SUBSCRIPTION_KEY
from tests.conftest import rows


def _scored(spark, scores):
    data = [(f"s{i:05d}", date(2015, 1, 1), s) for i, s in enumerate(scores)]
    return spark.createDataFrame(data, "analytic_id string, register_date date, score double")


def _brute_force(scores, buckets, descending=False):
    """Bucket per row: sort, then hand out ceil and floor shares."""
    keys = [f"s{i:05d}|2015-01-01" for i in range(len(scores))]
    known = [i for i, s in enumerate(scores) if s is not None]
    sign = -1 if descending else 1
    order = sorted(known, key=lambda i: (sign * scores[i], hashlib.md5(keys[i].encode()).hexdigest()))
    sizes = [len(known) // buckets + (b < len(known) % buckets) for b in range(buckets)]
    assigned = dict(zip(order, np.repeat(np.arange(1, buckets + 1), sizes).tolist(), strict=True))
    return [assigned.get(i) for i in range(len(scores))]


CASES = {
    "fewer rows than buckets": [0.3, 0.1, 0.2],
    "all equal": [0.5] * 37,
    "a third of the rows share a score": [0.5 if i % 3 == 0 else (i % 101) / 100 for i in range(1000)],
    "not divisible": [((i * 7919) % 10007) / 10007 for i in range(503)],
    "outside the usual range": [-5.0, 3.0, 2.5, 7.0, -9.0, 0.0, -0.0, 1.0, 1.00001] * 5,
    "hot score among close ones": [0.5 if i % 3 == 0 else 0.49996 + i / 1e7 for i in range(600)],
    "some missing": [None if i % 4 == 0 else i / 100 for i in range(90)],
    "single": [0.4],
    "points from 300 to 850": [300 + (i * 7919) % 551 for i in range(400)],
    "unrounded, one of them hot": [1 / 3 if i % 3 == 0 else i / 997 for i in range(700)],
}


@pytest.mark.parametrize("case", CASES)
@pytest.mark.parametrize("descending", [False, True])
def test_ntile_equals_brute_force(spark, case, descending):
    scores = [s if s is None else float(s) for s in CASES[case]]
    ranked = ranking.ntile_exact(_scored(spark, scores), "score", {"k7": 7, "k10": 10}, descending=descending)
    got = {r.analytic_id: (r.k7, r.k10) for r in ranked.collect()}
    expected = zip(_brute_force(scores, 7, descending), _brute_force(scores, 10, descending), strict=True)
    assert got == {f"s{i:05d}": pair for i, pair in enumerate(expected)}


@pytest.mark.parametrize("groups", [2, 1000])
def test_ntile_per_group_equals_the_window_function(spark, groups):
    rng = np.random.default_rng(3)
    group = F.pmod(F.xxhash64("analytic_id"), F.lit(groups + 1))
    df = _scored(spark, np.round(rng.random(2000), 2).tolist())
    df = df.withColumn("month", F.when(group < groups, group.cast("string")))
    ranked = ranking.ntile_exact(df, "score", {"k": 10, "k100": 100}, by=["month"])
    assert ranked.count() == 2000 and ranked.filter("k IS NULL").count() == 0
    text = hashing.key_text(SUBSCRIPTION_KEY)
    window = Window.partitionBy("month").orderBy("score", F.md5(text), text)
    checked = ranked.withColumns({"e": F.ntile(10).over(window), "e100": F.ntile(100).over(window)})
    assert checked.filter("NOT (k <=> e AND k100 <=> e100)").count() == 0


def test_a_hot_score_is_dealt_over_tasks_and_no_task_gets_all_rows(spark, tmp_path):
    path, ranked_path = str(tmp_path / "scores"), str(tmp_path / "ranked")
    _scored(spark, [0.5] * 30000).write.parquet(path)
    df = spark.read.parquet(path)
    with_positions(df, [], [F.asc("score"), F.md5("analytic_id")], ranked_path)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        again = with_positions(df, [], [F.asc("score"), F.md5("analytic_id")], ranked_path)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    files = spark.read.parquet(ranked_path).groupBy(F.input_file_name()).count()
    assert files.count() == 4 and files.filter("count > 12000").count() == 0
    ranked = ranking.ntile_exact(df, "score", {"k": 10})
    assert ranked.groupBy("k").count().filter("count <> 3000").count() == 0
    plan = again._jdf.queryExecution().executedPlan().toString()
    for part in plan.split("Exchange SinglePartition")[1:]:  # counts per partition only
        assert "HashAggregate" in part.splitlines()[1] or "HashAggregate" in part.splitlines()[2]


def test_campaign_list(spark):
    scores = [(f"C{i}", f"s{i}", date(2015, 1, 1), i / 1000) for i in range(200)]
    listed = ranking.rank_scores(spark.createDataFrame(scores, SCORES_SCHEMA), date(2019, 6, 30))
    best = listed.orderBy(F.desc("ea_score")).first()
    worst = listed.orderBy("ea_score").first()
    assert (best.ea_decile, best.ea_percentile, worst.ea_decile, worst.ea_percentile) == (1, 1, 10, 100)
    assert (best.charge_type, best.prof_date) == ("Pre-paid", date(2019, 6, 30))


def _labelled(spark, n=2000, seed=11):
    rng = np.random.default_rng(seed)
    score = np.round(rng.random(n), 2)
    bad = (rng.random(n) < score**2).astype(int)
    data = [
        (f"s{i:05d}", date(2015, 1, 1), float(s), None if i % 50 == 0 else int(b))
        for i, (s, b) in enumerate(zip(score, bad, strict=True))
    ]
    return spark.createDataFrame(data, "analytic_id string, register_date date, score double, bad int")


def test_auc_equals_the_library_evaluator(spark):
    df = _labelled(spark)
    ours = metrics.auc(df, "score", "bad").first()
    evaluator = BinaryClassificationEvaluator(rawPredictionCol="score", labelCol="label", numBins=0)
    expected = evaluator.evaluate(df.filter("bad IS NOT NULL").withColumn("label", F.col("bad").cast("double")))
    assert ours.auc == pytest.approx(expected)
    assert ours.n_events + ours.n_nonevents == df.filter("bad IS NOT NULL").count()


def test_auc_without_events_is_null(spark):
    assert metrics.auc(_labelled(spark).withColumn("bad", F.lit(0)), "score", "bad").first().auc is None


def test_scores_of_any_range_and_fineness_keep_their_order(spark):
    df = _labelled(spark)
    expected = metrics.auc(df, "score", "bad").first().auc
    for other in (F.col("score") * 550 + 300, F.col("score") / 1e9 - 5):
        assert metrics.auc(df.withColumn("score", other), "score", "bad").first().auc == pytest.approx(expected)
    fine = df.withColumn("score", F.col("score") + F.monotonically_increasing_id() / 1e12)
    assert metrics.roc_points(fine, "score", "bad").count() == df.filter("bad IS NOT NULL").count()


def test_roc_points(spark):
    points = metrics.roc_points(_labelled(spark), "score", "bad").orderBy(F.desc("threshold")).collect()
    tpr = [p.true_positive_rate for p in points]
    fpr = [p.false_positive_rate for p in points]
    assert tpr == sorted(tpr) and fpr == sorted(fpr)
    assert (tpr[-1], fpr[-1]) == (1.0, 1.0)
    area = np.trapezoid([0.0, *tpr], [0.0, *fpr])
    assert area == pytest.approx(metrics.auc(_labelled(spark), "score", "bad").first().auc)


def test_gains(spark):
    gains = metrics.gains_lift(_labelled(spark), "score", "bad").orderBy("group").collect()
    assert [g.group for g in gains] == list(range(1, 17))
    last = gains[-1]
    assert last.cumulative_data_fraction == last.cumulative_capture_rate == 1.0
    assert (last.cumulative_lift, last.cumulative_gain, last.kolmogorov_smirnov) == pytest.approx((1.0, 0.0, 0.0))
    assert gains[0].lift == gains[0].cumulative_lift > 1.5
    assert sum(g.capture_rate for g in gains) == pytest.approx(1.0)
    thresholds = [g.lower_threshold for g in gains]
    assert thresholds == sorted(thresholds, reverse=True)


def test_hash_sample_and_split(spark):
    df = _scored(spark, [0.0] * 5000)
    sample = hashing.down_sample(df, 0.1, SUBSCRIPTION_KEY)
    assert 400 < sample.count() < 600
    assert rows(sample) == rows(hashing.down_sample(df.repartition(7), 0.1, SUBSCRIPTION_KEY))
    train, test = hashing.train_test_split(df, 0.75, SUBSCRIPTION_KEY)
    assert train.count() + test.count() == 5000
    assert train.join(test, "analytic_id").count() == 0
    assert 3600 < train.count() < 3900
    # The split must cut the sample as it cuts the whole.
    assert 0.65 < hashing.train_test_split(sample, 0.75, SUBSCRIPTION_KEY)[0].count() / sample.count() < 0.85
