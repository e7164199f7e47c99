"""Exact deduplication by content-defined chunk recipes, in DataFrame operations only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from subscore.llm.common import ROW, numbered, stored

# A chunk ends at the first sentence end after its 1,024th character, or with its
# 8,192nd: where it ends depends on content near by, not on the place in the text.
CHUNK = r"(?s).{1,1024}(?:\z|.{0,7166}?(?:[.!?][ \n]|\z)|.{7168})"
WHITE = r"[\x20\x09-\x0D]+"


def recipes(documents: DataFrame) -> DataFrame:
    """Each row's normalised text as an ordered list of chunks."""
    normal = F.regexp_replace(F.coalesce("text", F.lit("")), WHITE, " ")
    return numbered(documents.select("doc_id", normal.alias("text"))).withColumn(
        "chunks", F.regexp_extract_all("text", F.lit(CHUNK), F.lit(0))
    )


def exact_duplicates(documents: DataFrame) -> DataFrame:
    """Groups of texts that are equal once each run of white space is one space.

    Returns a row per document row: ``doc_id``, ``keep_id`` (the group's smallest
    id), ``group_size``, ``kept``, ``text_sha256``.

    1. Each text becomes a recipe: the 64-bit hashes of its chunks, in order.
    2. Chunks are shuffled once, combined on the map side, to verify that a hash
       stands for one content. Those that don't get numbers by content.
    3. Documents are grouped by recipe: short lists of identifiers, whatever the
       length of the texts. Group sizes combine on the map side, so a group of a
       third of all rows is no burden.

    Null counts as empty. If the smallest id is on several rows, the first of
    them stays; a group with null ids only keeps its first row. Rows with a null
    id come last otherwise.
    """
    chunked = recipes(documents)
    listed = stored(
        chunked.select(
            ROW,
            "doc_id",
            F.sha2(F.col("text").cast("binary"), 256).alias("text_sha256"),
            F.transform("chunks", lambda c: F.xxhash64(c)).alias("recipe"),
        ),
        "recipes",
    )
    contents = chunked.select(F.explode("chunks").alias("chunk")).select(F.xxhash64("chunk").alias("h"), "chunk").distinct()
    ambiguous = stored(contents.groupBy("h").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("h"), "ambiguous")
    if ambiguous.isEmpty():
        named = listed.withColumn("key", F.transform("recipe", lambda h: h.cast("string")))
    else:
        # Hashes of several contents: the content itself takes their place.
        pairs = chunked.select(ROW, F.posexplode("chunks").alias("at", "chunk")).withColumn("h", F.xxhash64("chunk"))
        resolved = (
            pairs.join(ambiguous.withColumn("_twice", F.lit(True)), "h", "left")
            .select(ROW, "at", F.when(F.col("_twice"), F.concat(F.lit("="), "chunk")).otherwise(F.col("h").cast("string")).alias("id"))
            .groupBy(ROW)
            .agg(F.transform(F.array_sort(F.collect_list(F.struct("at", "id"))), lambda x: x["id"]).alias("key"))
        )
        named = listed.join(resolved, ROW, "left").withColumn("key", F.coalesce("key", F.array().cast("array<string>")))
    named = named.withColumn("key", F.concat_ws(",", "key"))
    first = F.min_by(F.struct("doc_id", ROW), F.struct(F.col("doc_id").isNull(), "doc_id", ROW))
    groups = (
        named.groupBy("key").agg(F.count(F.lit(1)).alias("group_size"), first.alias("first")).filter("group_size > 1")
    )
    return named.join(groups, "key", "left").select(
        "doc_id",
        F.when(F.col("first").isNull(), F.col("doc_id")).otherwise(F.col("first.doc_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).alias("group_size"),
        F.coalesce(F.col(f"first.{ROW}") == F.col(ROW), F.lit(True)).alias("kept"),
        "text_sha256",
    )
