"""Shards of documents by balanced label propagation."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from subscore.functions.positions import with_positions
from subscore.llm.common import ROW, numbered, stored
from subscore.session import shared_folder

SHARDS = 24
ROUNDS = 4


def linked_documents(base: DataFrame, shards: int) -> DataFrame:
    """Rows of ``base`` (``_subscore_row``, ``group``) that share their group, with a first shard by hash."""
    groups = base.groupBy("group").agg(F.count(F.lit(1)).alias("members")).filter("members > 1")
    first = F.pmod(F.xxhash64(ROW), F.lit(shards)).cast("int")
    return base.select(ROW, "group").join(groups, "group").withColumn("label", first)


def propagate(linked: DataFrame, capacity: int, shards: int, round_: int) -> DataFrame:
    """One round: each document asks for the shard where most of its neighbours are.

    Neighbours are the members of the same group. A group with more members than
    a shard's ``capacity`` has several such shards, and its other members are
    dealt over them. Shards take in what they have room for and half of what
    they would exchange; a group is let in as a whole, unless it has several
    shards. What is collected are sums per shard.
    """
    counts = linked.groupBy("group", "members", "label").agg(F.count(F.lit(1)).alias("n"))
    by_size = F.array_sort(F.collect_list(F.struct((-F.col("n")).alias("n"), "label")))  # one per shard at most
    places = F.ceil(F.col("members") / max(capacity, 1)).cast("int")
    homes = counts.groupBy("group", "members").agg(by_size.alias("all")).select(
        "group", F.transform(F.slice("all", F.lit(1), places), lambda x: x["label"]).alias("homes")
    )
    dealt = F.pmod(F.xxhash64(ROW, F.lit(round_)), F.size("homes").cast("bigint")).cast("int")
    asked = linked.join(homes, "group").withColumn(
        "target", F.when(F.array_contains("homes", F.col("label")), F.col("label")).otherwise(F.get("homes", dealt))
    )
    asked = stored(asked, "asked")
    flows = asked.groupBy("label", "target").agg(F.count(F.lit(1)).alias("n")).collect()
    rates = []
    for s in range(shards):
        here = sum(r["n"] for r in flows if r["label"] == s)
        leave = sum(r["n"] for r in flows if r["label"] == s != r["target"])
        enter = sum(r["n"] for r in flows if r["target"] == s != r["label"])
        room = max(0, capacity - here) + min(enter, leave) / 2
        rates.append(min(1.0, room / enter) if enter else 0.0)
    rate = F.get(F.array(*[F.lit(r) for r in rates]), F.col("target"))
    lot = F.xxhash64(F.when(F.size("homes") > 1, F.col(ROW).cast("string")).otherwise(F.col("group")), F.lit(round_))
    moves = F.pmod(lot, F.lit(1_000_000)) < rate * 1_000_000
    return asked.select(ROW, "group", "members", F.when(moves, F.col("target")).otherwise(F.col("label")).alias("label"))


def dealt(room: list[int], position: Column) -> Column:
    """The shard that the row at ``position`` of all goes to.

    Rows are dealt out one by one to the shards in turn; a shard that has got its ``room``
    is passed over from then on.
    """
    shard = F.lit(0)
    begin = low = 0
    for high in sorted({n for n in room if n}):
        takers = [s for s, n in enumerate(room) if n >= high]
        taker = F.get(F.array(*[F.lit(s) for s in takers]), ((position - begin) % len(takers)).cast("int"))
        shard = F.when(position >= begin, taker).otherwise(shard)
        begin += (high - low) * len(takers)
        low = high
    return shard


def assign_shards(
    documents: DataFrame, shards: int = SHARDS, rounds: int = ROUNDS, links: str | None = None, order: str | None = None
) -> DataFrame:
    """Add ``shard`` and ``slot`` to every row; row counts of shards differ by one at most.

    Documents with the same ``links`` value, by default those with equal texts,
    are linked and brought together; each round is stored. Then a shard keeps
    linked documents up to its exact size, and all others, with those that had no
    place, fill up the rest in one order. ``slot`` numbers the rows of a shard
    from 0 without gaps.

    With an ``order``, the name of a column, a shard's slots follow it, and the rows that
    fill up are dealt to the shards in turn by it: each shard runs through the whole
    order evenly, and so do shards that are read side by side.

    Null texts count as empty, and null ``links`` values as no link. Repeated
    rows are documents of their own. With fewer rows than shards, some shards
    stay empty.
    """
    spark = documents.sparkSession
    if "doc_id" not in documents.columns:
        raise ValueError("no doc_id")
    group = F.col(links).cast("string") if links else F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256)
    base = stored(
        numbered(documents).select(
            ROW,
            "doc_id",
            (F.coalesce(F.octet_length("text"), F.lit(0)) + 8).cast("bigint").alias("size"),
            F.coalesce(F.crc32(F.col("text").cast("binary")), F.lit(0)).alias("text_crc32"),
            group.alias("group"),
            *([F.col(order).alias("_order")] if order else []),
        ),
        "base",
    )
    total = base.count()
    linked = stored(linked_documents(base, shards), "linked")
    for k in range(rounds):
        linked = stored(propagate(linked, total // shards, shards, k), f"round{k}")

    # Exact sizes: the first shards have one row more.
    sizes = [total // shards + (s < total % shards) for s in range(shards)]
    full = F.get(F.array(*[F.lit(n) for n in sizes]), F.col("label"))
    by_group = [F.col("group"), F.col(ROW)]
    in_order = [F.col("_order"), F.col(ROW)] if order else by_group
    placed = with_positions(linked, ["label"], by_group, f"{shared_folder(spark, 'shards')}/linked")
    placed = stored(placed.filter(F.col("_position") < full).select(ROW, "label", "_position"), "placed")
    held = {r["label"]: r["n"] for r in placed.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    rest = stored(base.join(placed, ROW, "left_anti").drop("doc_id", "size", "text_crc32"), "rest")
    rest = with_positions(rest, [], in_order, f"{shared_folder(spark, 'shards')}/rest")
    if order:
        shard = dealt([n - held.get(s, 0) for s, n in enumerate(sizes)], F.col("_position"))
        rest = rest.select(ROW, shard.alias("shard"))
        every = placed.select(ROW, F.col("label").alias("shard")).unionByName(rest)
        every = stored(every.join(base.select(ROW, "_order"), ROW), "every")
        every = with_positions(every, ["shard"], in_order, f"{shared_folder(spark, 'shards')}/every", "slot")
        every = every.select(ROW, "shard", "slot")
        return base.join(every, ROW).select("doc_id", "size", "text_crc32", "group", "shard", "slot")
    begin, begins = 0, []
    for s in range(shards):
        begins.append(begin)
        begin += sizes[s] - held.get(s, 0)
    shard = reduce(
        lambda found, s: F.when(F.col("_position") >= begins[s], F.lit(s)).otherwise(found), range(1, shards), F.lit(0)
    )
    # A shard without room begins where the next one does and gets nothing.
    shift = F.get(F.array(*[F.lit(held.get(s, 0) - begins[s]).cast("bigint") for s in range(shards)]), F.col("shard"))
    rest = rest.withColumn("shard", shard).select(ROW, "shard", (F.col("_position") + shift).alias("slot"))
    every = placed.select(ROW, F.col("label").alias("shard"), F.col("_position").alias("slot")).unionByName(rest)
    return base.join(every, ROW).select("doc_id", "size", "text_crc32", "group", "shard", "slot")
