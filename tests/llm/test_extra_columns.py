"""Columns of the caller's that are named as an operator's own."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from subscore.llm import mixing, near_dedup, sharding

EXTRA = {"_row": 3, "score": "mine", "predicted": "mine", "slot": "mine", "block": 1, "n": 2, "size": "x"}


@pytest.fixture(scope="module")
def marked(documents):
    return documents.withColumns({k: F.lit(x) for k, x in EXTRA.items()})


def test_row_numbers_are_not_the_callers(documents, marked):
    assert sharding.assign_shards(marked).count() == documents.count()
    assert near_dedup.near_duplicates(marked).count() == documents.count()
    mixed = mixing.mixed_documents(marked)
    assert mixed.columns == marked.columns
    assert sorted(map(repr, mixed.collect())) == sorted(map(repr, marked.collect()))


def test_toxicity_stage_returns_the_callers_columns(spark, documents, marked, tmp_path):
    labels = "doc_id long, quality int, toxic int"
    spark.createDataFrame([(r.doc_id, 1, k % 2) for k, r in enumerate(documents.collect())], labels).write.parquet(str(tmp_path / "labels.parquet"))
    kept = corpus_pipeline.toxicity(spark, marked, str(tmp_path))
    assert kept.columns == marked.columns and kept.filter("score <> 'mine' or predicted <> 'mine'").count() == 0
    assert kept.count() > 0
