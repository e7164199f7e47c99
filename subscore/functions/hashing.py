"""Repeatable choices from a row's key, independent of partitioning."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

HASH_RANGE = 2**32


def key_text(key: Sequence[str]) -> Column:
    return F.concat_ws("|", *[F.col(c).cast("string") for c in key])


def key_hash(key: Sequence[str], salt: str) -> Column:
    """Integer in [0, 2^32) that depends on the key and the salt only."""
    digest = F.md5(F.concat_ws("|", key_text(key), F.lit(salt)))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("long")


def down_sample(df: DataFrame, fraction: float, key: Sequence[str], salt: str = "sample") -> DataFrame:
    """Sample without replacement: each key is kept with probability ``fraction``."""
    return df.filter(key_hash(key, salt) < F.lit(int(fraction * HASH_RANGE)))


def with_split(df: DataFrame, ratio: float, key: Sequence[str], salt: str = "split-567", column: str = "split") -> DataFrame:
    """Mark each row ``train`` (share ``ratio``) or ``test``."""
    in_train = key_hash(key, salt) < F.lit(int(ratio * HASH_RANGE))
    return df.withColumn(column, F.when(in_train, F.lit("train")).otherwise(F.lit("test")))


def train_test_split(
    df: DataFrame, ratio: float, key: Sequence[str], salt: str = "split-567"
) -> tuple[DataFrame, DataFrame]:
    marked = with_split(df, ratio, key, salt)
    return (
        marked.filter(F.col("split") == "train").drop("split"),
        marked.filter(F.col("split") == "test").drop("split"),
    )
