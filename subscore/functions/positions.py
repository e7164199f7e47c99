"""Exact positions in an order over very many rows, without sorting them in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

PART_BITS = 33  # monotonically_increasing_id: the partition above, the row within below


def with_positions(
    df: DataFrame,
    groups: Sequence[str],
    order: Sequence[Column],
    path: str,
    position: str = "_position",
    rows: str = "_rows",
) -> DataFrame:
    """Add each row's zero-based position within its group, and the group's number of rows.

    Rows are dealt out by ranges of (groups, order), sorted within partitions,
    numbered there and written to ``path``; so counts and rows come from the same
    partitions. A group's partitions are counted, and the counts before each are
    added: a table of as many rows as there are groups and partitions. The rows
    are shuffled once; any number of groups and any hot group spreads evenly, as
    long as ``order`` leaves few ties. A null group is a group. ``df`` is read
    twice: it should be a written table.
    """
    keys = [*[F.col(c) for c in groups], *order]
    ranged = df.repartitionByRange(*keys).sortWithinPartitions(*keys) if keys else df
    ranged.withColumn("_at", F.monotonically_increasing_id()).write.mode("overwrite").parquet(path)
    numbered = df.sparkSession.read.parquet(path).withColumn("_part", F.shiftright("_at", PART_BITS))
    whole = Window.partitionBy(*groups)
    before = whole.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    # One name for each group that also a null has, so that the join stays an equality.
    named = F.to_json(F.struct(*groups)) if groups else F.lit("")
    offsets = (
        numbered.groupBy(*groups, "_part")
        .agg(F.count(F.lit(1)).alias("_count"), F.min("_at").alias("_first"))
        .select(
            named.alias("_group"),
            F.col("_part"),
            (F.coalesce(F.sum("_count").over(before), F.lit(0)) - F.col("_first")).alias("_offset"),
            F.sum("_count").over(whole).alias(rows),
        )
    )
    return (
        numbered.withColumn("_group", named)
        .join(offsets, ["_group", "_part"])
        .withColumn(position, F.col("_at") + F.col("_offset"))
        .select(*df.columns, position, rows)
    )


def with_running_sums(df: DataFrame, order: Sequence[Column], sums: Sequence[str], path: str) -> DataFrame:
    """Add, for each column of ``sums``, its sum over the rows before (``before_``) and over all (``total_``).

    As ``with_positions``: ranges, sums within a partition, and the sums of the
    partitions before it. No row number is bounded, and no task sees all rows.
    """
    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order)
    ranged.withColumn("_at", F.monotonically_increasing_id()).write.mode("overwrite").parquet(path)
    numbered = df.sparkSession.read.parquet(path).withColumn("_part", F.shiftright("_at", PART_BITS))
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    parts = numbered.groupBy("_part").agg(*[F.sum(c).alias(c) for c in sums])
    parts = parts.select(
        "_part",
        *[F.coalesce(F.sum(c).over(earlier), F.lit(0)).alias(f"_part_{c}") for c in sums],
        *[F.sum(c).over(everything).alias(f"total_{c}") for c in sums],
    )
    inside = Window.partitionBy("_part").orderBy("_at").rowsBetween(Window.unboundedPreceding, -1)
    within = numbered.withColumns({f"_in_{c}": F.coalesce(F.sum(c).over(inside), F.lit(0)) for c in sums})
    return within.join(parts, "_part").select(
        *df.columns,
        *[(F.col(f"_in_{c}") + F.col(f"_part_{c}")).alias(f"before_{c}") for c in sums],
        *[f"total_{c}" for c in sums],
    )
