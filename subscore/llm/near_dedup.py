"""Near duplicates by fast similarity sketching, banding and exact verification."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce
from operator import add

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from subscore.llm.common import ROW, bitmap, bounded_batches, in_bitmap, mixed, numbered, spaced_words, stored, word_hashes

BANDS, BAND_SIZE = 42, 6
SHARED = 0.8
LEADER_ROUNDS = 3
PARITIES = 16  # words of 64 bits
BITMAP_BITS = 24  # 2 MB
_LOW = np.uint64((1 << 44) - 1)


def shingles(text: str | None, size: int) -> np.ndarray:
    """Hashes of the distinct runs of ``size`` words; with fewer words, of all of them as one."""
    words = spaced_words(text)
    if not words:
        return np.zeros(0, np.uint64)
    hashes = word_hashes(words)
    n = max(1, len(hashes) - size + 1)
    out = np.full(n, min(size, len(hashes)), np.uint64)
    for k in range(min(size, len(hashes))):
        out = mixed(out ^ hashes[k : k + n])
    return np.unique(out)


def sketch(items: np.ndarray, bins: int) -> np.ndarray:
    """Fast similarity sketch of a set of 64-bit hashes, ``bins`` coordinates, each filled.

    In each of the first ``bins`` rounds, every item goes to a bin by a hash of
    its own; in round ``bins`` + b, all go to bin b. A bin keeps the least
    (round, hash) it gets, and a set is done after the first round at whose end
    no bin is empty: after ``bins`` * ln(``bins``) placements or so, whatever the
    set's size. Coordinates of two sets agree with the chance of their similarity.
    """
    least = np.full(bins, ~np.uint64(0))
    step = max(1, 2048 // len(items))
    # Nearly always few rounds are needed; a batch of them costs the same result,
    # since later rounds only add larger values.
    for first in range(0, bins, step):
        rounds = np.arange(first, min(first + step, bins), dtype=np.uint64)[:, None]
        h = mixed(items[None, :] ^ mixed(rounds + np.uint64(1)))
        at = ((h >> np.uint64(44)) * np.uint64(bins)) >> np.uint64(20)
        np.minimum.at(least, at.ravel().astype(np.int64), ((rounds << np.uint64(44)) | (h & _LOW)).ravel())
        if least.max() != ~np.uint64(0):
            return least
    for b in np.flatnonzero(least == ~np.uint64(0)):
        h = mixed(items ^ mixed(np.array([bins + b + 1], np.uint64)))
        least[b] = (np.uint64(bins + b) << np.uint64(44)) | (h & _LOW).min()
    return least


def band_keys(coordinates: np.ndarray, band_size: int) -> np.ndarray:
    parts = coordinates.reshape(-1, band_size)
    keys = np.arange(len(parts), dtype=np.uint64)
    for k in range(band_size):
        keys = mixed(keys ^ parts[:, k])
    return keys


def _digest(items: np.ndarray) -> bytes:
    return hashlib.blake2b(items.tobytes(), digest_size=16).digest()


def _head(digest: bytes) -> int:
    return int.from_bytes(digest[:4], "little")


def parities(items: np.ndarray) -> np.ndarray:
    odd = np.bincount((mixed(items) % np.uint64(64 * PARITIES)).astype(np.int64), minlength=64 * PARITIES) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def _sets(documents: DataFrame, size: int) -> DataFrame:
    """A row per document row: size and digest of its shingle set, and its band keys."""

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [shingles(t, size) for t in batch.pop("text")]
            yield batch.assign(
                n_shingles=np.array([len(x) for x in found], np.int64),
                digest=[_digest(x) for x in found],
                keys=[band_keys(sketch(x, BANDS * BAND_SIZE), BAND_SIZE).view(np.int64) if len(x) else [] for x in found],
            )

    rows = numbered(documents).select(ROW, "doc_id", "text")
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInPandas(scan, f"doc_id {kind}, {ROW} bigint, n_shingles bigint, digest binary, keys array<bigint>")


def _contents(documents: DataFrame, size: int, wanted: np.ndarray) -> DataFrame:
    """Full sets, once each, of the digests whose bit is set in ``wanted``."""
    shared = documents.sparkSession.sparkContext.broadcast(wanted)

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows, seen = [], set()
            for text in batch["text"]:
                items = shingles(text, size)
                digest = _digest(items)
                if len(items) and digest not in seen and in_bitmap(shared.value, np.array([_head(digest)], np.uint64))[0]:
                    seen.add(digest)
                    rows.append((digest, items.view(np.int64), parities(items)))
            yield pd.DataFrame(rows, columns=["digest", "items", "parity"])

    return documents.select("text").mapInPandas(scan, "digest binary, items array<bigint>, parity array<bigint>")


def components(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """The least ``id`` that each node reaches over ``edges`` (``a``, ``b``), as ``component``.

    In each round a node takes the least label among its own, its neighbours'
    and that of its label; a round is stored, and sums only come to the driver.
    """
    both = stored(edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))), "both")
    labels = stored(nodes.select("id", F.col("id").alias("component")), "labels")
    while True:
        near = (
            both.join(labels, F.col("b") == F.col("id")).groupBy("a").agg(F.min("component").alias("near"))
        )
        least = labels.join(near, F.col("id") == F.col("a"), "left").select(
            "id", "component", F.least("component", F.coalesce("near", F.col("component"))).alias("label")
        )
        least = stored(least, "least")
        up = least.select(F.col("id").alias("up"), F.col("label").alias("up_label"))
        after = least.join(up, F.col("label") == F.col("up"), "left").select(
            "id", F.least("label", "up_label").alias("label"), "component"
        )
        after = stored(after, "after")
        changed = after.filter("label <> component").limit(1).count()
        labels = after.select("id", F.col("label").alias("component"))
        if not changed:
            return labels


def joined(labels: DataFrame, links: DataFrame) -> DataFrame:
    """``labels`` after further ``links`` (``a``, ``b``): only the components they touch are gone through again."""
    ends = [labels.select(F.col("id").alias(c), F.col("component").alias(f"c_{c}")) for c in ("a", "b")]
    between = links.join(ends[0], "a").join(ends[1], "b").filter("c_a <> c_b")
    between = stored(between.select(F.col("c_a").alias("a"), F.col("c_b").alias("b")).distinct(), "between")
    touched = between.select(F.col("a").alias("id")).unionByName(between.select(F.col("b").alias("id"))).distinct()
    named = components(touched, between).select(F.col("id").alias("_old"), F.col("component").alias("_new"))
    after = labels.join(named, F.col("component") == F.col("_old"), "left")
    return stored(after.select("id", F.coalesce("_new", "component").alias("component")), "joined")


def _verified(pairs: DataFrame, contents: DataFrame, similarity: float) -> DataFrame:
    """Those of the pairs whose full sets share enough: in whole hundredths, so that a tie counts."""
    a = contents.select(F.col("id").alias("a"), F.col("items").alias("of_a"))
    b = contents.select(F.col("id").alias("b"), F.col("items").alias("of_b"))
    both = F.size(F.array_intersect("of_a", "of_b"))
    union = F.size("of_a") + F.size("of_b") - both
    share = round(similarity * 100)
    return pairs.join(b, "b").join(a, "a").filter(100 * both.cast("bigint") >= share * union).select("a", "b")


def near_duplicates(documents: DataFrame, shingle: int = 5, similarity: float = SHARED) -> DataFrame:
    """Connected groups of documents whose shingle sets have Jaccard similarity ``similarity`` or more.

    Returns a row per document row: ``_subscore_row``, ``doc_id``, ``n_shingles``,
    ``component``, a number of the group (null without shingles), and
    ``component_id``, the least id reachable.

    1. Rows with equal sets are one class, so copies are never paired.
    2. Classes are sketched; ``BANDS`` bands of ``BAND_SIZE`` coordinates become keys.
       A pair at 0.8 shares none with a chance of 3 in a million.
    3. In each bucket of a key, members are checked against one leader on full
       sets, and linked ones joined to components; ``LEADER_ROUNDS`` times with
       leaders chosen anew among those that meet most others, for members that
       aren't in the leader's component yet.
    4. Pairs of a bucket that are still in different components, not yet checked
       and not ruled out by a bound are checked. The bound: each bit of
       ``parity`` says whether a set has an odd number of shingles there, so sets
       differ in as many shingles as bits at least. No link between components
       is lost, and a large group of near copies costs a few checks a member, not
       all its pairs.

    Null and empty texts have no shingles and are linked with nothing. Rows that
    repeat an id share a component if their texts do; a null id is never a
    ``component_id``, unless nothing else is reachable.
    """
    spark = documents.sparkSession
    bounded_batches(spark)
    scanned = stored(_sets(documents, shingle), "sets")
    # The keys follow from the set, so that they come along with the class, in one shuffle.
    classes = stored(
        scanned.filter("n_shingles > 0")
        .groupBy("digest", "n_shingles")
        .agg(F.min(ROW).alias("id"), F.min("doc_id").alias("first"), F.any_value("keys").alias("keys")),
        "classes",
    )
    keys = classes.select("id", F.col("n_shingles").alias("n"), F.explode("keys").alias("key"))
    classes = classes.drop("keys")
    shared_keys = keys.groupBy("key").agg(F.count(F.lit(1)).alias("rows")).filter("rows > 1")
    buckets = stored(keys.join(shared_keys, "key"), "buckets")
    ids = buckets.select("id").distinct()
    wanted = stored(classes.join(ids, "id", "left_semi").select("id", "digest"), "wanted")
    # The digest's first four bytes as a number, the least first.
    low = F.conv(
        F.concat(*[F.substring(F.hex("digest"), 2 * k + 1, 2) for k in range(3, -1, -1)]), 16, 10
    ).cast("bigint")
    bits = bitmap(wanted.select(low.alias("h")), "h", BITMAP_BITS)
    contents = _contents(documents, shingle, bits).dropDuplicates(["digest"]).join(wanted, "digest").select("id", "items", "parity")
    contents = stored(contents, "contents")

    share = round(similarity * 100)
    sizes_allow = (100 * F.least("n", "n_b") >= share * F.greatest("n", "n_b"))
    labels = stored(ids.select("id", F.col("id").alias("component")), "first")
    checked = None

    def check(pairs: DataFrame) -> None:
        nonlocal checked, labels
        pairs = pairs.distinct()
        if checked is not None:
            pairs = pairs.join(checked, ["a", "b"], "left_anti")
        pairs = stored(pairs, "pairs")
        found = stored(_verified(pairs, contents, similarity), "links")
        checked = pairs if checked is None else checked.unionByName(pairs)
        if not found.isEmpty():
            labels = joined(labels, found)

    # Who meets many others is close to the middle of a group.
    met = stored(buckets.groupBy("id").agg(F.sum("rows").alias("met"), F.collect_list("key").alias("keys")), "met")
    for k in range(LEADER_ROUNDS):
        labelled = buckets.join(labels, "id").join(met.select("id", "met"), "id")
        lot = F.pmod(F.xxhash64("id", F.lit(k)), F.lit(4)) if k else F.lit(0).cast("bigint")
        order = F.struct(lot.alias("lot"), (-F.col("met")).alias("met"), F.col("id").alias("b"), F.col("n").alias("n_b"), F.col("component").alias("c_b"))
        leaders = labelled.groupBy("key").agg(F.min(order).alias("l")).select("key", "l.b", "l.n_b", "l.c_b")
        pairs = labelled.join(leaders, "key").filter((F.col("component") != F.col("c_b")) & sizes_allow)
        check(pairs.select(F.least("id", "b").alias("a"), F.greatest("id", "b").alias("b")))

    labelled = buckets.join(labels, "id")
    mixed_keys = (
        labelled.groupBy("key").agg(F.min("component").alias("c1"), F.max("component").alias("c2")).filter("c1 <> c2").select("key")
    )
    open_ = stored(labelled.join(mixed_keys, "key").select("key", "id", "n", "component"), "open")
    parity = contents.select("id", "parity").join(met.select("id", "keys"), "id")
    left = stored(open_.join(parity, "id"), "left")
    right = left.select("key", *[F.col(c).alias(f"{c}_b") for c in ("id", "n", "component", "parity", "keys")])
    apart = reduce(add, [F.bit_count(F.get("parity", F.lit(k)).bitwiseXOR(F.get("parity_b", F.lit(k)))) for k in range(PARITIES)])
    rest = left.join(right, "key").filter(
        (F.col("id") < F.col("id_b"))
        & (F.col("component") != F.col("component_b"))
        & sizes_allow
        & ((100 + share) * apart <= (100 - share) * (F.col("n") + F.col("n_b")))
        # A pair is taken from the first of the buckets that it shares.
        & (F.array_min(F.array_intersect("keys", "keys_b")) == F.col("key"))
    )
    check(rest.select(F.col("id").alias("a"), F.col("id_b").alias("b")))

    of_class = classes.join(labels, "id", "left").withColumn("component", F.coalesce("component", F.col("id")))
    least = of_class.groupBy("component").agg(F.min("first").alias("component_id"))
    named = of_class.join(least, "component").select("digest", "component", "component_id")
    return scanned.join(named, "digest", "left").select(
        ROW,
        "doc_id",
        "n_shingles",
        "component",
        F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"),
    )
