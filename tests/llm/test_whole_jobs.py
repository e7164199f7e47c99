"""Cases in which an operator once did less than its whole job."""

from __future__ import annotations

import os
import random
import sys
from collections import Counter
from fractions import Fraction

import pandas as pd
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from subscore.llm import common, decontamination, mixing, near_dedup, sharding, suffix_dedup

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
from conftest import rows  # noqa: E402

FILES = "spark.sql.files.minPartitionNum"


def _passages(spark, documents, folder):
    return suffix_dedup.repeated_passages(documents).select("doc_id", "n_bytes", "n_removed")


JOBS = {"op7_suffix_dedup": _passages} | {k: f for k, f in corpus_pipeline.STAGES if k in ("near_dedup", "decontamination", "mixing")}


@pytest.mark.parametrize("job", JOBS)
def test_results_hold_if_later_scans_are_split_otherwise(spark, documents, tmp_path, monkeypatch, job):
    documents.filter("n_chars > 300").limit(9).selectExpr("doc_id item_id", "text").write.parquet(str(tmp_path / "benchmark.parquet"))
    expected = rows(JOBS[job](spark, documents, str(tmp_path)))
    assert expected

    def stored(df, name, store=near_dedup.stored):
        out = store(df, name)
        if name != "windows":  # of the benchmark, before the documents are scanned
            spark.conf.set(FILES, "16")
        return out

    for module in (corpus_pipeline, decontamination, mixing, near_dedup, suffix_dedup):
        monkeypatch.setattr(module, "stored", stored, raising=False)
    try:
        spark.conf.set(FILES, "1")
        assert documents.rdd.getNumPartitions() == 1
        assert rows(JOBS[job](spark, documents, str(tmp_path))) == expected
    finally:
        spark.conf.unset(FILES)


def _plain_turns(blocks, weights):
    left, out = list(blocks), []
    while any(left):
        active = [k for k, n in enumerate(left) if n]
        exact = {k: Fraction(weights[k]) / sum(Fraction(weights[i]) for i in active) for k in active}
        done, t = dict.fromkeys(active, 0), 0
        while all(left[k] for k in active):
            k = min((-(-(done[k] + 1) // exact[k]), k) for k in active if done[k] // exact[k] <= t)[1]
            out.append(k)
            left[k], done[k], t = left[k] - 1, done[k] + 1, t + 1
    return out


def test_turns_equal_a_plain_schedule():
    rng = random.Random(2)
    for _ in range(60):
        n = rng.randrange(1, 14)
        weights = [rng.choice([1.0, 2.0, 0.1, 3**0.5, rng.random() + 0.01]) for _ in range(n)]
        blocks = [rng.choice([0, 1, 1, 2, rng.randrange(30)]) for _ in range(n)]
        assert list(mixing.turns(blocks, weights)) == _plain_turns(blocks, weights)


@pytest.mark.parametrize("sources, share", [(20, 0.5), (20, 0.01), (500, 0.5), (3000, 0.9)])
def test_no_source_is_a_block_away_from_its_true_target(sources, share):
    weights = [share] + [(1 - share) / (sources - 1)] * (sources - 1)
    total = sum(map(Fraction, weights))
    got = mixing.turns([12_000] * sources if sources < 30 else [12_000] + [30] * (sources - 1), weights)
    had, last = Counter(), 12_000  # within the first phase
    for t, k in enumerate(got[:last], 1):
        had[k] += 1
        for i in (0, k):
            assert abs(had[i] - t * Fraction(weights[i]) / total) < 1


def test_any_number_of_sources(spark, tmp_path):
    # Hundreds of names and null; s0 has every third row.
    source = "case when id % 3 = 0 then 's0' when id % 100 > 1 then concat('s', id % 1000) end source"
    spark.range(4000).selectExpr("id doc_id", "'x' text", source).write.parquet(str(tmp_path / "d"))
    documents = spark.read.parquet(str(tmp_path / "d"))
    sizes = Counter(r.source for r in documents.collect())
    assert len(sizes) > 500 and None in sizes
    names = sorted(sizes, key=lambda n: (n is not None, n))
    got = mixing.schedule(documents, block=2).collect()
    assert sorted(r.doc_id for r in got) == list(range(4000))
    turns = mixing.turns([-(-sizes[n] // 2) for n in names], [sizes[n] ** 0.5 for n in names])
    assert {(r.slot, r.source) for r in got} == {(t, names[k]) for t, k in enumerate(turns)}
    with pytest.raises(KeyError):
        mixing.schedule(documents, dict.fromkeys(names[:-1], 1.0))


def test_very_many_sources_are_planned():
    sizes = [1 + k % 40 for k in range(100_000)] + [10**6]
    blocks = [-(-n // 16) for n in sizes]
    assert Counter(mixing.turns(blocks, [n**0.5 for n in sizes])) == Counter(dict(enumerate(blocks)))


def test_a_passage_in_very_many_texts_is_in_no_task_as_a_whole(spark, tmp_path, monkeypatch):
    rng = random.Random(4)
    passage = rng.randbytes(450).hex()
    texts = [rng.randbytes(rng.randrange(300)).hex() + passage + rng.randbytes(rng.randrange(300)).hex() for _ in range(60)]
    texts += [t[100:] for t in texts[:5]] + [texts[7]]
    spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").write.parquet(str(tmp_path / "d"))
    seen = Counter(t[k : k + 400] for t in texts for k in range(len(t) - 399))
    expected = []
    for doc, t in enumerate(texts):
        covered = {x for k in range(len(t) - 399) if seen[t[k : k + 400]] > 1 for x in range(k, k + 400)}
        expected.append((doc, "".join(c for k, c in enumerate(t) if k not in covered)))
    compare = suffix_dedup._compare

    def checked(batches):
        some = pd.concat(list(batches) or [pd.DataFrame({"key": []})])
        assert some.empty or some.groupby("key").size().max() <= 10
        yield from compare(iter([some]))

    monkeypatch.setattr(suffix_dedup, "MANY", 10, raising=False)
    monkeypatch.setattr(suffix_dedup, "_compare", checked)
    got = suffix_dedup.repeated_passages(spark.read.parquet(str(tmp_path / "d"))).collect()
    assert sorted((r.doc_id, bytes(r.kept).decode()) for r in got) == expected


def test_rows_that_are_not_dropped_are_not_shuffled(spark, tmp_path):
    rows_ = [(k if k % 7 else None, "x" * 20) for k in range(3000)]
    spark.createDataFrame(rows_, "key long, text string").write.parquet(str(tmp_path / "rows"))
    spark.range(0, 3000, 11).selectExpr("id key").write.parquet(str(tmp_path / "dropped"))
    table, dropped = (spark.read.parquet(str(tmp_path / n)) for n in ("rows", "dropped"))
    expected = sorted(map(str, table.join(dropped, "key", "left_anti").collect()))
    for bits in (24, 16):  # the fuller bitmap lets more rows through to the join
        kept = common.without(table, dropped, "key", bits)
        assert sorted(map(str, kept.collect())) == expected
    sure, joined = kept._jdf.queryExecution().optimizedPlan().toString().split("Join LeftAnti")
    assert "Filter" in sure and "Repartition" not in joined


def test_dealt_in_turn_until_shards_are_full(spark):
    room = [3, 0, 5, 1]
    n = sum(room)
    got = [r.s for r in spark.range(n).orderBy("id").select(sharding.dealt(room, F.col("id")).alias("s")).collect()]
    assert got == [0, 2, 3, 0, 2, 0, 2, 2, 2]
    assert spark.range(2).select(sharding.dealt([0, 0], F.col("id"))).count() == 2


def test_shards_run_through_the_mixture(spark, documents, tmp_path):
    corpus_pipeline.mixing(spark, documents, str(tmp_path)).write.parquet(str(tmp_path / "mixed"))
    mixed = spark.read.parquet(str(tmp_path / "mixed"))
    order = [r["_mix"] for r in mixed.select("_mix").collect()]
    assert len(set(order)) == len(order) == documents.count()
    sizes = Counter()
    placed = sharding.assign_shards(mixed.withColumn("doc_id", F.col("_mix")), shards=4, order="_mix").collect()
    for shard in range(4):
        slots = sorted((r.slot, r.doc_id) for r in placed if r.shard == shard)
        assert [s for s, _ in slots] == list(range(len(slots)))
        assert [m for _, m in slots] == sorted(m for _, m in slots)
        sizes[len(slots)] += 1
    assert max(sizes) - min(sizes) <= 1
    # Another mixture of the same rows gives other shards.
    turned = mixed.withColumn("_mix", -F.col("_mix"))
    here, there = (rows(corpus_pipeline.sharding(spark, d, str(tmp_path))) for d in (mixed, turned))
    assert len(here) == len(there) == len(order) and here != there


def test_mixing_stores_no_copy_of_texts_from_files(spark, documents, monkeypatch):
    kept = []

    def stored(df, name, store=mixing.stored):
        kept.append(df.columns)
        return store(df, name)

    monkeypatch.setattr(mixing, "stored", stored)
    whole = documents.select(*sorted(documents.columns))
    same_rows = rows(whole)
    assert rows(mixing.mixed_documents(whole)) == same_rows
    assert kept and not any("text" in columns for columns in kept)
    # Rows that were multiplied since they were read, or that no file has, are still all there.
    twice = whole.withColumn("_k", F.explode(F.array(F.lit(1), F.lit(2)))).drop("_k")
    assert mixing.mixed_documents(twice).count() == 2 * len(same_rows)
    made = spark.createDataFrame(whole.collect(), whole.schema)
    assert rows(mixing.mixed_documents(made)) == same_rows
