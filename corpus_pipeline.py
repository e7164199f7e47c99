"""A training corpus from ``documents``, stage by stage.

Each stage takes (spark, docs, sf_dir), works on all that the stage before kept, and
returns documents; its result is written as Parquet and read again as the next one's
``docs``. The last one returns where each document goes.

Null, empty and repeated rows pass as each operator states; columns besides those of
``documents`` stay, unless their name starts with an underscore.

What a stage has kept in the shared folder goes when the next stage begins: by then its
result is written. Tables that the next stage's ``docs`` still reads stay, so that a
stage whose result was not written keeps working.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from subscore.llm.common import ROW, numbered, stored, table, without
from subscore.llm.decontamination import find_contamination
from subscore.llm.mixing import mixed_documents
from subscore.llm.near_dedup import near_duplicates
from subscore.llm.sharding import assign_shards
from subscore.llm.toxicity import fit_toxicity, score_toxicity
from subscore.session import folders_made, remove_folders, shared_folder

MIX = "_mix"  # a row's place in the mixture, from mixing to sharding

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def tidy(stage: Stage) -> Stage:
    """A stage that first removes the tables of the stage before, unless ``docs`` reads them."""

    @wraps(stage)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        context = spark.sparkContext
        read = docs.inputFiles()
        left = [f for f in getattr(context, "_pipeline_folders", []) if f in folders_made(spark)]
        done = [f for f in left if not any(f.rsplit("/", 1)[-1] in file for file in read)]
        remove_folders(spark, done)
        before = set(folders_made(spark))
        found = stage(spark, docs, sf_dir)
        context._pipeline_folders = [f for f in folders_made(spark) if f not in before] + [f for f in left if f not in done]
        return found

    return run_stage


@tidy
def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score as toxic go."""
    model = fit_toxicity(docs, table(spark, sf_dir, "labels"))
    held = docs.select(F.struct(*docs.columns).alias("_document"), "text")  # columns that the score's names would replace
    return score_toxicity(held, model).filter("predicted = 0").select("_document.*")


@tidy
def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates (five-word shingles, 0.8) the row with the smallest id stays.

    Rows without words have no near duplicates and stay. Of rows that repeat the
    smallest id of their group, the first stays.
    """
    rows = stored(numbered(docs), "rows")
    found = near_duplicates(rows)
    first = F.min_by(ROW, F.struct(F.col("doc_id").isNull(), "doc_id", ROW)).alias(ROW)
    found = found.filter("n_shingles > 0")
    first_of = found.groupBy("component").agg(first).select(ROW)
    dropped = stored(found.select(ROW).join(first_of, ROW, "left_anti"), "dropped")
    return without(rows, dropped, ROW).select(*docs.columns)


@tidy
def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a word inside a benchmark window go.

    That follows from the text alone, so a text's digest stands for it; no copy is stored.
    """
    digest = F.sha2(F.col("text").cast("binary"), 256)
    found = find_contamination(docs.select(digest.alias("doc_id"), "text"), table(spark, sf_dir, "benchmark"))
    dirty = stored(found.filter("n_hit > 0").select(F.col("doc_id").alias("_digest")).distinct(), "dirty")
    return without(docs.withColumn("_digest", digest), dirty, "_digest").select(*docs.columns)


@tidy
def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, in the order in which the sources' target weights interleave them: ``_mix`` is a row's place."""
    return mixed_documents(docs, order=MIX)


@tidy
def sharding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each document goes: ``shard`` and ``slot``, which runs through the mixture if there is one."""
    return assign_shards(docs, order=MIX if MIX in docs.columns else None).select("doc_id", "size", "text_crc32", "shard", "slot")


STAGES = [
    ("toxicity", toxicity),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("mixing", mixing),
    ("sharding", sharding),
]

# A fitted classifier decides in the first stage.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = f"{shared_folder(spark, 'pipeline')}/{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
