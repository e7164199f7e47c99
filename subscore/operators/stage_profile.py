"""A profile of each stage's table that is stored by month and merged without its rows.

Counts, extremes, and two sketches per numeric column: one of distinct values (HLL) and one
of quantiles (KLL). Sketches are a few kB however many rows they stand for, so months and
stages are compared, and months put together, from the stored table alone.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DISTINCT_BITS = 12  # relative standard error of 1.04 / sqrt(2^12), some 1.6 %
DISTINCT_ERROR = 0.05  # three of those
QUANTILE_SIZE = 800  # rank error of about 0.35 % at 99 % confidence
RANK_ERROR = 0.01
NUMERIC = ("double", "float", "int", "bigint", "smallint", "tinyint", "decimal")

STATES = ["stage", "month", "column_name", "n_rows", "n_values", "least", "largest", "distinct_sketch", "quantile_sketch"]


def numeric_columns(df: DataFrame) -> list[str]:
    return [c for c, t in df.dtypes if t.startswith(NUMERIC)]


def profile_states(df: DataFrame, stage: str, month_column: str, columns: Sequence[str] | None = None) -> DataFrame:
    """A row per month and column of ``STATES``, from one pass that combines on the map side.

    ``n_values`` counts neither nulls nor NaN, and the sketches and extremes hold neither. A column
    without a value in a month has null extremes and sketches. The month may be null.
    """
    columns = list(columns or [c for c in numeric_columns(df) if c != month_column])
    taken = [F.col(f"`{c}`").cast("double") for c in columns]
    taken = [F.when(~F.isnan(c), c) for c in taken]
    values = df.select(F.col(f"`{month_column}`").alias("month"), *[c.alias(f"_v{i}") for i, c in enumerate(taken)])
    aggregates: list[Column] = [F.count(F.lit(1)).alias("n_rows")]
    for i in range(len(columns)):
        v = F.col(f"_v{i}")
        aggregates.append(
            F.struct(
                F.count(v).alias("n_values"),
                F.min(v).alias("least"),
                F.max(v).alias("largest"),
                # The distinct sketch takes no doubles; -0.0 and 0.0 are the same value.
                F.hll_sketch_agg((v + 0.0).cast("string"), DISTINCT_BITS).alias("distinct_sketch"),
                F.kll_sketch_agg_double(v, QUANTILE_SIZE).alias("quantile_sketch"),
            ).alias(f"_s{i}")
        )
    grouped = values.groupBy("month").agg(*aggregates)
    described = [
        F.struct(F.lit(c).alias("column_name"), F.col("n_rows").alias("_n"), F.col(f"_s{i}").alias("_s")) for i, c in enumerate(columns)
    ]
    parts = grouped.select("month", F.inline(F.array(*described)))
    empty = F.col("_s.n_values") == 0
    sketches = [F.when(~empty, F.col(f"_s.{s}")).alias(s) for s in ("distinct_sketch", "quantile_sketch")]
    return parts.select(
        F.lit(stage).alias("stage"),
        "month",
        "column_name",
        F.col("_n").alias("n_rows"),
        *[F.col(f"_s.{c}").alias(c) for c in ("n_values", "least", "largest")],
        *sketches,
    )


def store_states(states: DataFrame, target: str) -> None:
    """Add states to the stored table; a stage's month that comes again replaces itself."""
    partitioned = states.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    partitioned.partitionBy("stage", "month").parquet(target)


def merged_profile(states: DataFrame, by: Sequence[str], quantiles: Sequence[float] = (0.25, 0.5, 0.75)) -> DataFrame:
    """States put together per ``by`` and column: counts, extremes, estimated distinct values and quantiles.

    ``quantiles`` names an array of estimates in the order given; each has a rank within
    ``RANK_ERROR`` of the wanted one, and ``n_distinct`` is within ``DISTINCT_ERROR``, nearly surely. Only states are read, never rows.
    """
    merged = states.groupBy(*by, "column_name").agg(
        F.sum("n_rows").alias("n_rows"),
        F.sum("n_values").alias("n_values"),
        F.min("least").alias("least"),
        F.max("largest").alias("largest"),
        F.hll_union_agg(F.when(F.col("n_values") > 0, F.col("distinct_sketch"))).alias("_distinct"),
        F.kll_merge_agg_double("quantile_sketch").alias("_quantiles"),
    )
    some = F.col("n_values") > 0
    wanted = F.array(*[F.lit(float(q)) for q in quantiles])
    return merged.select(
        *by,
        "column_name",
        "n_rows",
        "n_values",
        (F.col("n_rows") - F.col("n_values")).alias("n_null"),
        "least",
        "largest",
        F.when(some, F.hll_sketch_estimate("_distinct")).otherwise(F.lit(0)).alias("n_distinct"),
        F.when(some, F.kll_sketch_get_quantile_double("_quantiles", wanted)).alias("quantiles"),
    )
