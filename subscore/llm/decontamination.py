"""Benchmark decontamination by winnowing."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from subscore.llm.common import ROW, bitmap, bounded_batches, in_bitmap, mixed, numbered, plain_words, stored, word_hashes

WINDOW = 10  # words that an item and a document must share in a row
GRAM = 5  # words of a fingerprint
BITMAP_BITS = 24  # 2 MB
HOT = 1000  # no part of a fingerprint's places has more than one in so many of all places

# A place of a fingerprint: its words, and those before and behind it, nearest first.
_PLACE = "size int, print bigint, words string, before string, behind string"
_FOUND = f"array<struct<start:int,{_PLACE.replace(' ', ':').replace(',:', ',')}>>"


def winnowed(hashes: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Where the fingerprints of a text are, and their hashes.

    Of the k-grams in each window of ``size`` words, the one with the least hash is
    kept, the last one of several. Neighbouring windows mostly keep the same, so
    there are far fewer fingerprints than windows. A window depends on its words
    alone: wherever two texts have one in common, both keep the same k-gram of it.
    """
    gram = min(GRAM, size)
    n = len(hashes) - size + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    with np.errstate(over="ignore"):
        grams = np.zeros(len(hashes) - gram + 1, np.uint64)
        for k in range(gram):
            grams = mixed(grams ^ hashes[k : len(hashes) - gram + 1 + k])
    least, at = grams[:n].copy(), np.arange(n)
    for k in range(1, size - gram + 1):
        later = grams[k : k + n]
        at = np.where(later <= least, np.arange(k, k + n), at)
        least = np.minimum(least, later)
    kept = np.zeros(len(grams), bool)
    kept[at] = True
    kept = np.flatnonzero(kept)
    return kept, grams[kept]


def place(words: list[bytes], at: int, size: int, fingerprint: int) -> tuple[int, int, str, str, str]:
    """The fingerprint at a word, with as many words around it as a window can reach."""
    gram = min(GRAM, size)
    reach = size - gram
    before, behind = words[max(0, at - reach) : at][::-1], words[at + gram : at + size]
    texts = (b" ".join(w).decode("utf-8", "replace") for w in (words[at : at + gram], before, behind))
    return size, fingerprint, *texts


def _item_places(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        rows = []
        for item, text in zip(batch["item_id"], batch["text"]):
            words = plain_words(text)
            size = min(WINDOW, len(words))
            if words:
                kept, prints = winnowed(word_hashes(words), size)
                rows += [(item, *place(words, at, size, p)) for at, p in zip(kept.tolist(), prints.view(np.int64).tolist())]
        out = pd.DataFrame(rows, columns=["item_id", "size", "print", "words", "before", "behind"])
        yield out.drop_duplicates() if rows else out.astype({"size": "int32", "print": "int64"})


def benchmark_places(benchmark: DataFrame) -> DataFrame:
    """The distinct fingerprints of the items with the words around them, and whose they are.

    An item of fewer words than a window, but not none, is one window. Where an
    item's place differs from another's beyond a window's reach only, they are one.
    """
    kind = benchmark.schema["item_id"].dataType.simpleString()
    places = benchmark.select("item_id", "text").mapInPandas(_item_places, f"item_id {kind}, {_PLACE}")
    return places.groupBy("size", "print", "words", "before", "behind").agg(F.array_sort(F.collect_set("item_id")).alias("items"))


def shared_words(one: Column, other: Column, most: int) -> Column:
    """How many words two texts have in common from their first on, at most ``most``."""
    a, b = (F.split(F.nullif(x, F.lit("")), " ") for x in (one, other))
    same = [F.coalesce(F.get(a, F.lit(k)) == F.get(b, F.lit(k)), F.lit(False)) for k in range(most)]
    found = F.lit(most)
    for k in reversed(range(most)):
        found = F.when(same[k], found).otherwise(F.lit(k))
    return found


def dealt_out(found: DataFrame, places: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Both sides with a salt: a fingerprint that very many texts have is met in parts.

    The more of all places it has, the more parts; those of the benchmark go to each.
    At most ``HOT`` fingerprints have a share that needs more than one part, which
    bounds what is broadcast.
    """
    spark = found.sparkSession
    key = ["size", "print"]
    counts = stored(found.groupBy(*key).agg(F.count(F.lit(1)).alias("_n")), "counts")
    share = max((counts.agg(F.sum("_n")).first()[0] or 0) / HOT, 1)
    hot = counts.filter(F.col("_n") > share).select(*key, F.ceil(F.col("_n") / share).cast("int").alias("_parts"))
    parts = F.coalesce("_parts", F.lit(1))
    left = found.join(F.broadcast(hot), key, "left").withColumn("_salt", F.pmod(F.hash(ROW, "start"), parts)).drop("_parts")
    right = places.join(F.broadcast(hot), key, "left").withColumn("_salt", F.explode(F.sequence(F.lit(0), parts - 1))).drop("_parts")
    return left, right


def find_contamination(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Words of documents inside any occurrence of a benchmark window.

    Returns a row per document row: ``_subscore_row``, ``doc_id``, ``n_words``, ``n_hit``,
    ``items`` (sorted as strings). The fingerprints that winnowing keeps of documents
    and items are joined; where two are equal, so must be their words, and the hit
    is extended to both sides word by word, as far as a window around it reaches.
    It counts if it is as long as a window. A shared window always has a kept
    fingerprint in common, so none is missed, and a longer span is the union of
    its windows.

    Null and empty texts have no words; null items and items without words match
    nothing. Rows that repeat a document or an item count for themselves.
    An empty benchmark leaves every document clean.
    """
    spark = documents.sparkSession
    bounded_batches(spark)
    places = stored(benchmark_places(benchmark.filter("item_id is not null")), "places")
    sizes = sorted(r[0] for r in places.select("size").distinct().collect())  # at most WINDOW values
    known = spark.sparkContext.broadcast(bitmap(places, "print", BITMAP_BITS))
    names = ["size", "print", "words", "before", "behind"]

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            counts, found = [], []
            for text in batch.pop("text"):
                words = plain_words(text)
                hashes = word_hashes(words)
                hits = []
                for size in sizes:
                    kept, prints = winnowed(hashes, size)
                    may = in_bitmap(known.value, prints)
                    for at, p in zip(kept[may].tolist(), prints[may].view(np.int64).tolist()):
                        hits.append({"start": at, **dict(zip(names, place(words, at, size, p)))})
                counts.append(len(words))
                found.append(hits)
            yield batch.assign(n_words=np.array(counts, np.int64), found=found)

    rows = numbered(documents.select("doc_id", "text"))
    shape = f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, {ROW} bigint, n_words bigint, found {_FOUND}"
    scanned = stored(rows.mapInPandas(scan, shape), "scanned")

    left, right = dealt_out(scanned.select(ROW, F.inline("found")), places)
    met = left.alias("d").join(right.alias("b"), ["size", "print", "words", "_salt"])
    gram = F.least("size", F.lit(GRAM))
    hits = (
        met.withColumns(
            {
                "_back": shared_words(F.col("d.before"), F.col("b.before"), WINDOW - GRAM),
                "_on": shared_words(F.col("d.behind"), F.col("b.behind"), WINDOW - GRAM),
            }
        )
        .filter(F.col("_back") + gram + F.col("_on") >= F.col("size"))
        .select(ROW, (F.col("start") - F.col("_back")).alias("start"), (F.col("start") + gram + F.col("_on")).alias("end"), "items")
    )
    # Spans by start; each adds what reaches beyond the spans before it.
    first = F.struct(F.lit(0).alias("end"), F.lit(0).cast("bigint").alias("hit"))
    covered = F.aggregate(
        F.array_sort(F.collect_set(F.struct("start", "end"))),
        first,
        lambda a, x: F.struct(
            F.greatest(a["end"], x["end"]).alias("end"),
            (a["hit"] + F.greatest(F.lit(0), x["end"] - F.greatest(a["end"], x["start"]))).alias("hit"),
        ),
    )
    per_document = hits.groupBy(ROW).agg(
        covered["hit"].alias("n_hit"),
        F.array_sort(F.transform(F.array_distinct(F.flatten(F.collect_set("items"))), lambda x: x.cast("string"))).alias("items"),
    )
    return scanned.select(ROW, "doc_id", "n_words").join(per_document, ROW, "left").withColumns(
        {
            "n_hit": F.coalesce("n_hit", F.lit(0)),
            "items": F.coalesce("items", F.array().cast("array<string>")),
        }
    )
