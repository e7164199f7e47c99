"""Mixing sources to target weights by Pfair scheduling of blocks."""

from __future__ import annotations

import heapq
import math
from array import array
from collections.abc import Iterator, Mapping

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from subscore.functions.positions import with_positions
from subscore.llm.common import ROW, bounded_batches, located, numbered, stored
from subscore.session import shared_folder

BLOCK = 16  # documents
PERIOD = 1000  # slots in which ``shares`` are whole numbers
PIECE = 1 << 16  # slots of the plan that go to executors as one row


def shares(weights: list[float], period: int = PERIOD) -> list[int]:
    """Whole numbers in proportion to the weights, at least 1 each, that add up to the period.

    For a short period that can be looked at; the schedule goes by exact weights.
    """
    total = sum(weights)
    exact = [1 + (period - len(weights)) * w / total for w in weights]
    parts = [int(x) for x in exact]
    order = sorted(range(len(parts)), key=lambda k: (parts[k] - exact[k], k))
    for k in order[: period - sum(parts)]:
        parts[k] += 1
    return parts


def period_slots(parts: list[int]) -> list[list[int]]:
    """The slots of each source's blocks within one period.

    Block j of a source with share w of a period P is released at floor(jP/w) and
    due by ceil((j+1)P/w). In each slot, the released block that is due first
    goes; so every block meets its deadline, and at no time is a source a whole
    block away from its share.
    """
    period = sum(parts)
    released: dict[int, list[int]] = {}
    for k, w in enumerate(parts):
        for j in range(w):
            released.setdefault(j * period // w, []).append((k, j))
    slots: list[list[int]] = [[] for _ in parts]
    ready: list[tuple[int, int, int]] = []
    for t in range(period):
        for k, j in released.get(t, ()):
            heapq.heappush(ready, (-(-(j + 1) * period // parts[k]), k, j))
        due, k, _ = heapq.heappop(ready)
        assert due > t
        slots[k].append(t)
    return slots


def whole_weights(weights: list[float]) -> list[int]:
    """Whole numbers in exactly the proportion of the weights."""
    ratios = [w.as_integer_ratio() for w in weights]
    common = math.lcm(*{d for _, d in ratios})
    return [n * (common // d) for n, d in ratios]


def turns(blocks: list[int], weights: list[float]) -> array:
    """The source of each slot, in order, until no source has blocks left.

    A phase lasts until a source has no blocks left; then the others share anew.
    Within it, block j of a source whose weight is w of a total of W is released at
    floor(jW/w) and due by ceil((j+1)W/w), as in ``period_slots``, but by the exact
    weights; so at no time is a source a whole block away from its target.

    Sources that haven't had a turn in a phase wait in line with those of the same
    weight, and only the first of a line is looked at: a phase costs what its turns
    cost, however many sources there are.
    """
    exact, left, out = whole_weights(weights), list(blocks), array("q")
    lines: dict[int, list[int]] = {}
    for k in range(len(left) - 1, -1, -1):
        if left[k]:
            lines.setdefault(exact[k], []).append(k)  # the first is at the end
    order = sorted(lines, reverse=True)
    total = sum(w * len(line) for w, line in lines.items())
    while order:
        ready: list[tuple[int, int, int, int]] = []
        waiting: list[tuple[int, int, int, int, int]] = []
        opened, t = 0, 0
        while True:
            while waiting and waiting[0][0] <= t:
                heapq.heappush(ready, heapq.heappop(waiting)[1:])
            while opened < len(order) and (not ready or -(-total // order[opened]) <= ready[0][0]):
                w = order[opened]
                heapq.heappush(ready, (-(-total // w), lines[w][-1], 0, len(lines[w]) - 1))
                opened += 1
            due, k, j, at = heapq.heappop(ready)
            assert due > t
            w = exact[k]
            if not j and at:
                heapq.heappush(ready, (due, lines[w][at - 1], 0, at - 1))
            out.append(k)
            left[k] -= 1
            if not left[k]:
                break
            heapq.heappush(waiting, ((j + 1) * total // w, -(-(j + 2) * total // w), k, j + 1, at))
            t += 1
        total -= w
        del lines[w][at]
        if not lines[w]:
            order.remove(w)
    return out


def stored_plan(spark: SparkSession, sources: array, n: int) -> DataFrame:
    """The slot of each block (``_source``, ``block``) as a table in the shared folder."""
    who = np.frombuffer(sources, np.int64) if len(sources) else np.zeros(0, np.int64)
    by_source = np.argsort(who, kind="stable")
    first = np.r_[0, np.cumsum(np.bincount(who, minlength=n))]
    block = np.empty(len(who), np.int64)
    block[by_source] = np.arange(len(who)) - first[who[by_source]]
    pieces = [(a, who[a : a + PIECE].tobytes(), block[a : a + PIECE].tobytes()) for a in range(0, len(who), PIECE)]

    def spread(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for begin, source, number in zip(batch["begin"], batch["source"], batch["number"]):
                source = np.frombuffer(source, np.int64)
                yield pd.DataFrame({"_source": source, "block": np.frombuffer(number, np.int64), "slot": begin + np.arange(len(source))})

    packed = spark.createDataFrame(pieces, "begin bigint, source binary, number binary")
    return stored(packed.mapInPandas(spread, "_source bigint, block bigint, slot bigint"), "plan")


def _named() -> dict[str, Column]:
    """What joins sources by equality, a null one too."""
    return {"_null": F.col("source").isNull(), "_name": F.coalesce("source", F.lit(""))}


def _numbered_sources(counts: DataFrame, weights: Mapping[str | None, float] | None) -> DataFrame:
    """The sources by name, null first, as ``_source``, with their rows and weights; names stay with Spark."""
    spark = counts.sparkSession
    path = f"{shared_folder(spark, 'mix')}/sources"
    sources = with_positions(counts, [], [F.col("source").asc_nulls_first()], path, "_source").withColumns(_named())
    if weights is None:
        return stored(sources.withColumn("weight", F.sqrt("n")), "sources")
    given = spark.createDataFrame([(n is None, n or "", float(w)) for n, w in weights.items()], "_null boolean, _name string, weight double")
    sources = stored(sources.join(given, ["_null", "_name"], "left"), "sources")
    for missing in sources.filter("weight is null").select("source").take(1):
        raise KeyError(missing["source"])
    return sources


def schedule(documents: DataFrame, weights: Mapping[str | None, float] | None = None, block: int = BLOCK) -> DataFrame:
    """Every row's place in the mixture: ``block`` of its source, ``slot``, ``place`` within the slot.

    Returns ``_subscore_row``, ``doc_id``, ``source``, ``source_rank``, ``block``, ``slot``,
    ``place``; reading by (slot, place) gives the mixture. Rows of a source are
    ordered by a hash of the id; every ``block`` of them is a block, the last
    one may be smaller. Weights default to the square root of a source's rows,
    and are taken as they are. No row is left out: when a source has no blocks
    left, the others share its slots. The driver gets two numbers for each source
    and plans the blocks, some 20 bytes each; the plan is stored and joined by
    source and block.

    A null source is a source. Sources without a weight in a given mapping, and
    weights that aren't positive, are errors. There may be any number of sources.
    """
    spark = documents.sparkSession
    bounded_batches(spark)
    base = stored(numbered(documents).select(ROW, "doc_id", F.col("source").cast("string").alias("source")), "base")
    counts = stored(base.groupBy("source").agg(F.count(F.lit(1)).alias("n")), "counts")
    sources = _numbered_sources(counts, weights)
    table = sources.select("_source", "n", "weight").toPandas().sort_values("_source")
    targets = table["weight"].tolist()
    if any(not 0 < w < math.inf for w in targets):
        raise ValueError("weights must be positive")
    plan = stored_plan(spark, turns([-(-n // block) for n in table["n"].tolist()], targets), len(targets))
    plan = plan.join(sources.select("_source", "_null", "_name"), "_source")
    order = [F.xxhash64("doc_id"), F.col(ROW)]
    ranked = with_positions(base, ["source"], order, f"{shared_folder(spark, 'mix')}/ranked", "source_rank")
    ranked = ranked.withColumns(
        {
            "block": F.floor(F.col("source_rank") / block),
            "place": (F.col("source_rank") % block).cast("int"),
            **_named(),
        }
    )
    # Some ``block`` rows to a key, however many rows a source has.
    return ranked.join(plan, ["_null", "_name", "block"]).select(ROW, "doc_id", "source", "source_rank", "block", "slot", "place")


def mixed_documents(
    documents: DataFrame, weights: Mapping[str | None, float] | None = None, block: int = BLOCK, order: str | None = None
) -> DataFrame:
    """All documents in the order of the mixture: file by file, row by row.

    With ``order`` a column of that name gives a row's place in the mixture, since a
    reader may take the files in any order.

    Slots are numbered without gaps, so that equal ranges of them are the files: no
    sample of the texts is taken to find the ranges. Rows of Parquet files are known by
    their places there; of others, a numbered copy is stored.
    """
    rows, ids, key = located(documents), None, ["_file", "_index"]
    if rows is not None:
        ids = stored(numbered(rows.select(*key, "doc_id", "source")), "ids")
        if not ids.groupBy(*key).count().filter("count > 1").isEmpty():
            rows = None
    if rows is None:
        rows = ids = stored(numbered(documents), "rows")
        key = [ROW]
    slot = schedule(ids, weights, block).select(F.col(ROW), F.col("slot").alias("_slot"), F.col("place").alias("_place"))
    places = stored(ids.select(ROW, *[k for k in key if k != ROW]).join(slot, ROW).drop(*({ROW} - {*key})), "places")
    slots = (places.agg(F.max("_slot")).first()[0] or 0) + 1
    files = int(documents.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = rows.join(places, key).repartitionById(files, F.floor(F.col("_slot") * files / slots).cast("int"))
    place = [(F.col("_slot") * block + F.col("_place")).alias(order)] if order else []
    return dealt.sortWithinPartitions("_slot", "_place").select(*documents.columns, *place)
