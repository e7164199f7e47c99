"""Exact ranks over very many rows, without sorting them in one task."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from subscore.functions.hashing import key_text
from subscore.functions.positions import with_positions
from subscore.schemas import CAMPAIGN_SCHEMA, SUBSCRIPTION_KEY
from subscore.session import shared_folder

def _div(dividend: Column, divisor: Column) -> Column:
    """Whole-number division."""
    return F.call_function("div", dividend, divisor)


def _bucket(position: Column, rows: Column, buckets: int) -> Column:
    """Bucket of a zero-based position among ``rows`` rows, larger buckets first."""
    size = _div(rows, F.lit(buckets))
    rest = rows - size * buckets
    in_large = rest * (size + 1)
    return (
        F.when(position < in_large, _div(position, size + 1) + 1)
        .otherwise(rest + _div(position - in_large, F.greatest(size, F.lit(1))) + 1)
        .cast("int")
    )


def ntile_exact(
    df: DataFrame,
    score: str,
    buckets: Mapping[str, int],
    tie_break: Sequence[str] = SUBSCRIPTION_KEY,
    by: Sequence[str] = (),
    descending: bool = False,
) -> DataFrame:
    """Equal-count buckets by score: ``ntile`` over all rows, or per ``by`` group.

    ``buckets`` names each new column and its number of buckets. Ties are
    ordered by the MD5 of the ``tie_break`` text, then by that text. Rows without
    a score get no bucket; a null group is a group, as in SQL.

    A global ``ntile`` window would bring all rows to one task. Instead, rows are
    dealt out by ranges of (group, score, tie order) and numbered there, see
    ``with_positions``: one shuffle of the rows whatever their scores, groups and
    ties, since the tie order cuts a score that very many rows share. ``df`` is
    read twice or more: it should be a written table.
    """
    text = key_text(tie_break)
    by_score = F.desc(score) if descending else F.asc(score)
    known = df.filter(F.col(score).isNotNull())
    path = f"{shared_folder(df.sparkSession, 'ranks')}/ranked"
    ranked = with_positions(known, by, [by_score, F.md5(text), text], path)
    ranked = ranked.select(
        *df.columns, *[_bucket(F.col("_position"), F.col("_rows"), k).alias(name) for name, k in buckets.items()]
    )
    without = df.filter(F.col(score).isNull())
    return ranked.unionByName(without.select("*", *[F.lit(None).cast("int").alias(name) for name in buckets]))


def rank_scores(scores: DataFrame, prof_date: date) -> DataFrame:
    """Campaign list: decile and percentile per subscription, 1 = best score."""
    renamed = scores.withColumnRenamed("p0", "ea_score").withColumn("register_date", F.to_date("register_date"))
    ranked = ntile_exact(renamed, "ea_score", {"_ntile10": 10, "_ntile100": 100})
    return ranked.withColumns(
        {
            "ea_decile": 11 - F.col("_ntile10"),
            "ea_percentile": 101 - F.col("_ntile100"),
            "charge_type": F.lit("Pre-paid"),
            "prof_date": F.lit(prof_date),
        }
    ).select(*CAMPAIGN_SCHEMA.fieldNames())
