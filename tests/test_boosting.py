"""Second-order trees against plain Python."""

from __future__ import annotations

import math
import random
from dataclasses import replace

import numpy as np
import pytest
from conftest import rows as listed

from subscore.operators import boosting, metrics, model
from subscore.operators.boosting import BoostSettings

SMALL = BoostSettings(trees=3, rate=0.5, depth=3, row_sample=1.0, column_sample=1.0, bins=8, refresh=2, features=["age", "days_active", "gender"])
COLUMNS = "analytic_id string, register_date string, bad_flag int, age double, days_active bigint, gender string, _margin string, p9 int"


def _table(n=220, seed=1):
    rng = random.Random(seed)
    out = []
    for k in range(n):
        age = None if rng.random() < 0.15 else float("nan") if rng.random() < 0.05 else float(rng.randrange(18, 80))
        days, gender = rng.randrange(4), rng.choice(["M", "F", None])
        risk = 0.7 * (age is None or age < 35) + 0.2 * (gender == "M") + 0.1 * days / 3
        out.append((str(k), "2019-01-01", int(rng.random() < risk) if k % 17 else None, age, days, gender, "kept", k))
    return out


def _known(x):
    return x is not None and not (isinstance(x, float) and math.isnan(x))


def _plain_trees(rows, settings):
    """Trees as nested tuples by trying every cut of every predictor."""
    rows = [r for r in rows if r[2] is not None]
    predictors = []
    for place, name in ((3, "age"), (4, "days_active")):
        values = sorted(r[place] for r in rows if _known(r[place]))
        cuts = {values[math.ceil(k / settings.bins * len(values)) - 1] for k in range(1, settings.bins)} - {values[0]}
        predictors.append((name, lambda r, p=place: r[p] if _known(r[p]) else None, sorted(cuts)))
    for level in sorted({r[5] for r in rows if r[5]}):
        predictors.append((f"gender={level}", lambda r, v=level: None if r[5] is None else float(r[5] == v), [1.0]))
    margin = [0.0] * len(rows)

    def best(at, g, h):
        G, H = sum(g[k] for k in at), sum(h[k] for k in at)
        found = (1e-9,)
        for name, value, cuts in predictors:
            for cut in cuts:
                for missing_left in (False, True):
                    left = [k for k in at if (missing_left if value(rows[k]) is None else value(rows[k]) < cut)]
                    gl, hl = sum(g[k] for k in left), sum(h[k] for k in left)
                    if min(hl, H - hl) < settings.least_cover:
                        continue
                    gain = (gl * gl / (hl + 1) + (G - gl) ** 2 / (H - hl + 1) - G * G / (H + 1)) / 2
                    if gain > found[0] + 1e-9:
                        found = (gain, name, cut, missing_left, left)
        return found, -settings.rate * G / (H + 1)

    def grow(at, depth, g, h):
        found, value = best(at, g, h)
        if depth == 0 or len(found) == 1:
            for k in at:
                margin[k] += value
            return ("leaf", round(value, 6))
        _, name, cut, missing_left, left = found
        right = [k for k in at if k not in set(left)]
        return (name, float(cut), missing_left, grow(left, depth - 1, g, h), grow(right, depth - 1, g, h))

    out = []
    for _ in range(settings.trees):
        chance = [1 / (1 + math.exp(-m)) for m in margin]
        g, h = [p - r[2] for p, r in zip(chance, rows)], [p * (1 - p) for p in chance]
        out.append(grow(list(range(len(rows))), settings.depth, g, h))
    return out, {r[0]: 1 / (1 + math.exp(-m)) for r, m in zip(rows, margin)}


def _nested(fitted, tree, node=0):
    f = int(tree.feature[node])
    if f < 0:
        return ("leaf", round(float(tree.value[node]), 6))
    p = fitted.predictors[f]
    below = (_nested(fitted, tree, 2 * node + k) for k in (1, 2))
    return (p.name, float(p.cuts[tree.cut[node] - 1]), bool(tree.missing_left[node]), *below)


@pytest.fixture(scope="module")
def data(spark):
    return spark.createDataFrame(_table(), COLUMNS).repartition(3).cache()


@pytest.fixture(scope="module")
def fitted(data):
    return boosting.train_boosted(data, SMALL)


def test_trees_equal_trying_every_split(data, fitted):
    plain, chances = _plain_trees(_table(), SMALL)
    assert [_nested(fitted, t) for t in fitted.trees] == plain
    got = {r.analytic_id: r.p1 for r in model.predict(fitted, data).collect()}
    assert all(abs(got[k] - p) < 1e-9 for k, p in chances.items())


def test_same_trees_however_rows_are_dealt_out(spark, data, fitted):
    settings = replace(SMALL, row_sample=0.6, column_sample=0.5, trees=5)
    one, many = (boosting.train_boosted(data.repartition(n), settings) for n in (1, 6))
    for a, b in zip(one.trees, many.trees):
        assert all(np.array_equal(x, y) for x, y in zip(vars(a).values(), vars(b).values()))
    shares = [boosting.sampled_rows(np.arange(20_000), t, settings).mean() for t in range(3)]
    assert all(abs(s - 0.6) < 0.02 for s in shares) and len(set(shares)) == 3
    assert {len(boosting.sampled_columns(50, 1, level, settings)) for level in range(4)} == {25}


def test_stages_are_the_prefixes(data, fitted):
    stages = boosting.staged_measures(fitted, data).orderBy("trees").collect()
    assert [s.trees for s in stages] == [1, 2, 3]
    for s in stages:
        scored = model.predict(fitted.prefix(s.trees), data)
        whole = metrics.auc(scored, "p1", "bad_flag").first()
        assert (s.n_events, s.n_nonevents) == (whole.n_events, whole.n_nonevents) and abs(s.auc - whole.auc) < 1e-12
        p = [(r.bad_flag, r.p1) for r in scored.collect() if r.bad_flag is not None]
        assert abs(s.log_loss + sum(math.log(x if y else 1 - x) for y, x in p) / len(p)) < 1e-9
    assert [r.trees for r in boosting.staged_measures(fitted, data, every=2).orderBy("trees").collect()] == [2, 3]


def test_stopping_point(spark):
    def table(losses):
        return spark.createDataFrame([(k, float(x)) for k, x in enumerate(losses, 1)], "trees bigint, log_loss double")

    assert boosting.stopping_point(table([9, 8, 7, 6, 5]), 2) is None
    assert boosting.stopping_point(table([9, 8, 7, 7.1, 7.2, 6]), 2) == 5
    assert boosting.stopping_point(table([9, 8.999, 8.998]), 2, 0.01) == 3


def test_model_survives_storing(spark, data, fitted, tmp_path):
    boosting.save_boosted(fitted, spark, str(tmp_path / "model"))
    again = model.load_model(str(tmp_path / "model"))
    assert again.settings == fitted.settings and again.predictors == fitted.predictors
    assert listed(model.predict(again, data).drop("age")) == listed(model.predict(fitted, data).drop("age"))
    assert model.predict(fitted, data).columns == [*data.columns, "p0", "p1"]


def test_importance_is_the_gain_by_column(spark, fitted):
    found = {r.variable: r for r in boosting.boosted_importance(fitted).collect()}
    assert set(found) == set(SMALL.features)
    gains = {r.predictor: 0.0 for r in boosting.tree_table(fitted).filter("predictor is not null").collect()}
    for r in boosting.tree_table(fitted).filter("predictor is not null").collect():
        gains[r.predictor] += r.gain
    assert abs(found["age"].relative_importance - gains["age"]) < 1e-9
    assert abs(sum(r.percentage for r in found.values()) - 1) < 1e-9


def test_rows_from_which_nothing_can_be_learnt(spark, data):
    none = boosting.train_boosted(data.filter("false"), SMALL)
    assert all(t.feature[0] == -1 and t.value[0] == 0 for t in none.trees)
    assert {r.p1 for r in model.predict(none, data).collect()} == {0.5}
    good = boosting.train_boosted(data.filter("bad_flag = 0"), SMALL)
    assert all(t.feature[0] == -1 for t in good.trees)
    assert model.predict(good, data).filter("p1 < 0.5").count() == data.count()
    assert boosting.staged_measures(good, data.filter("false")).collect() == []


def test_unknown_categories_and_bounds(spark, data, fitted):
    odd = data.limit(3).selectExpr("* except (gender)", "'X' gender").select(*data.columns)
    assert model.predict(fitted, odd).filter("p1 between 0 and 1").count() == 3
    with pytest.raises(ValueError):
        boosting.train_boosted(data, replace(SMALL, bins=255))


def test_many_blocks_and_partitions_grow_the_same_trees(data, monkeypatch):
    settings = replace(SMALL, row_sample=0.6, column_sample=0.5, trees=5)
    whole = boosting.train_boosted(data, settings)
    monkeypatch.setattr(boosting, "BLOCK_ROWS", 7)
    monkeypatch.setattr(boosting, "TASK_ROWS", 60)
    for summed_by_driver in (64, 1):
        monkeypatch.setattr(boosting, "SUMMED_BY_DRIVER", summed_by_driver)
        dealt = boosting.train_boosted(data, settings)
        for a, b in zip(whole.trees, dealt.trees, strict=True):
            assert all(np.array_equal(x, y) for x, y in zip(vars(a).values(), vars(b).values()))


def test_a_level_of_the_classifier_is_one_job_of_one_stage(spark, data):
    context = spark.sparkContext

    def jobs_and_stages(trees):
        group = f"trees {trees}"
        context.setJobGroup(group, group)
        settings = model.ModelSettings(trees=trees, depth=3, row_sample=1.0, column_sample=1.0, features=SMALL.features)
        assert len(model.train_classifier(data, settings).trees) == trees
        context.setJobGroup("", "")
        found = [context.statusTracker().getJobInfo(k) for k in context.statusTracker().getJobIdsForGroup(group)]
        return len(found), sum(len(j.stageIds) for j in found)

    (few, few_stages), (more, more_stages) = jobs_and_stages(1), jobs_and_stages(5)
    # A later stage may list the shuffle before it, which isn't run again.
    assert 0 < more - few <= 4 * 3 and more_stages - few_stages <= 2 * 4 * 3
