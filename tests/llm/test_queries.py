"""The document queries against their SQL, and the pipeline against its stages' operators."""

from __future__ import annotations

import os
from collections import Counter

import duckdb
import pytest

import corpus_pipeline
from subscore.llm import near_dedup, oracle, queries
from tests.conftest import TESTDATA


@pytest.fixture(scope="module")
def duck(data_folder):
    connection = duckdb.connect()
    for name in os.listdir(data_folder):
        connection.execute(f"CREATE VIEW {os.path.splitext(name)[0]} AS SELECT * FROM '{data_folder}/{name}'")
    yield connection
    connection.close()


@pytest.mark.parametrize("name", sorted(oracle.all_statements()))
def test_query_equals_sql(spark, duck, name):
    theirs = duck.execute(oracle.all_statements()[name])
    columns = [d[0] for d in theirs.description]
    ours = queries.all_queries()[name](spark, TESTDATA).select(*columns)
    assert sorted(map(tuple, ours.collect())) == sorted(theirs.fetchall())


def test_every_operator_has_a_query():
    assert {n.split("_")[0] for n in queries.all_queries()} == {f"op{k}" for k in range(1, 14)}


def test_near_dedup_query_keeps_one_class_per_component(spark, data_folder):
    found = queries.op9_near_dedup(spark, data_folder)
    assert found.filter("kept").count() == found.select("component_id").distinct().count()


def test_stages_take_effect_one_after_the_other(spark, data_folder, tmp_path):
    docs = spark.read.parquet(f"{data_folder}/documents.parquet")
    columns, counts = docs.columns, [docs.count()]
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, data_folder).write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        counts.append(docs.count())
        if name != "sharding":
            assert docs.columns == columns
        if name == "near_dedup":
            again = near_dedup.near_duplicates(docs)
            assert again.select("component_id").distinct().count() == docs.count()
    # So few documents have too few toxic labels to learn from; test_operators has that stage's accuracy.
    assert counts[0] >= counts[1] > counts[2] > counts[3] == counts[4] == counts[5]
    sizes = Counter(r.shard for r in docs.select("shard").collect())
    assert max(sizes.values()) - min(sizes.values()) <= 1
    run = corpus_pipeline.run(spark, data_folder)
    assert sorted(map(tuple, run.select("doc_id", "size").collect())) == sorted(map(tuple, docs.select("doc_id", "size").collect()))
