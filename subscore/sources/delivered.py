"""Delivered text files, read by a declared schema; rows that don't fit go to a quarantine."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

RECORD, FAULT, SOURCE = "_record", "_fault", "_source"
MALFORMED, MISSING = "malformed", "missing "


@dataclass(frozen=True)
class Delivery:
    """``good``: rows of the declared schema. ``quarantine``: ``record`` (the line), ``fault``, ``source`` (file)."""

    good: DataFrame
    quarantine: DataFrame

    def counts(self) -> DataFrame:
        """Rows in quarantine per file and fault."""
        return self.quarantine.groupBy("source", "fault").agg(F.count(F.lit(1)).alias("n_rows"))


def read_delivered(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    target: str,
    required: Sequence[str] = (),
    sep: str = ",",
) -> Delivery:
    """Read CSV files with a header below ``path`` and store them below ``target``, good and bad rows apart.

    Types are declared, never guessed. A row with too few or too many fields, or with a value that
    isn't one of its column's type, is ``malformed``; one without a value in a column of ``required``
    is ``missing`` that column (the first of them). A file whose header doesn't name the schema's
    columns in their order stops the whole delivery. The files are parsed once, in a pass without a shuffle;
    running it again replaces both tables. No line is dropped but blank ones, which hold no row.
    """
    if clashing := {RECORD, FAULT, SOURCE} & set(schema.fieldNames()):
        raise ValueError(f"columns with names used here: {', '.join(sorted(clashing))}")
    unknown = [c for c in required if c not in schema.fieldNames()]
    if unknown:
        raise ValueError(f"not in the schema: {', '.join(unknown)}")
    parsed = (
        spark.read.schema(T.StructType([*schema.fields, T.StructField(RECORD, T.StringType())]))
        .option("header", True)
        .option("enforceSchema", False)
        .option("sep", sep)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", RECORD)
        .csv(path)
    )
    # The line of a row that parses but lacks a key is written again from its fields.
    line = F.to_csv(F.struct(*[F.col(f"`{c}`") for c in schema.fieldNames()]), {"sep": sep})
    lacking = [F.when(F.col(f"`{c}`").isNull(), F.lit(MISSING + c)) for c in required]
    fault = F.coalesce(F.when(F.col(RECORD).isNotNull(), F.lit(MALFORMED)), *lacking, F.lit(""))
    marked = parsed.withColumn(SOURCE, F.input_file_name()).withColumn(FAULT, fault)
    (
        marked.withColumn(RECORD, F.when(F.col(FAULT) != "", F.coalesce(RECORD, line)))
        .withColumn("_bad", F.col(FAULT) != "")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "static")
        .partitionBy("_bad")
        .parquet(target)
    )
    shape = T.StructType(
        [*schema.fields, *[T.StructField(c, T.StringType()) for c in (RECORD, SOURCE, FAULT)], T.StructField("_bad", T.BooleanType())]
    )
    stored = spark.read.schema(shape).parquet(target)
    good = stored.filter(~F.col("_bad")).select(*[F.col(f"`{c}`") for c in schema.fieldNames()])
    bad = stored.filter("_bad").select(
        F.col(RECORD).alias("record"), F.col(FAULT).alias("fault"), F.col(SOURCE).alias("source")
    )
    return Delivery(good, bad)
