"""Readers and writers of the tables that the jobs exchange."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from subscore.functions.months import month_end
from subscore.operators.datamart import usage_datamart
from subscore.schemas import CAMPAIGN_SCHEMA, LIFT_SCHEMA, SCORES_SCHEMA, SUBSCRIPTION_KEY


def is_path(target: str) -> bool:
    """A target with a slash is a Parquet folder, any other a catalog table."""
    return "/" in target


def read_table(spark: SparkSession, target: str, schema: T.StructType | None = None) -> DataFrame:
    if not is_path(target):
        return spark.table(target)
    reader = spark.read.schema(schema) if schema else spark.read
    return reader.parquet(target)


def write_feature_set(df: DataFrame, target: str) -> DataFrame:
    """Replace the feature table and read it back, which ends the lineage."""
    writer = df.write.mode("overwrite").format("parquet")
    if is_path(target):
        writer.save(target)
    else:
        writer.saveAsTable(target)
    return read_table(df.sparkSession, target, df.schema)


def replace_month(df: DataFrame, target: str, month_column: str, month: date, buckets: int = 0) -> None:
    """Write one month of a table partitioned by month, in place of that month's rows.

    The month appears as a whole once all its files are written, so a failed
    job leaves no half month behind and can simply run again.

    ``buckets`` > 0 creates a catalog table bucketed and sorted by subscription:
    later joins and aggregates on that key then read it without a shuffle,
    provided there are at least as many buckets as shuffle partitions. Each
    month needs the same number; one task writes one bucket.
    """
    spark = df.sparkSession
    if is_path(target):
        if buckets:
            raise ValueError("only a catalog table can be bucketed")
        partitioned = df.write.mode("overwrite").partitionBy(month_column)
        partitioned.option("partitionOverwriteMode", "dynamic").parquet(target)
        return
    if buckets:
        df = df.repartition(buckets, *SUBSCRIPTION_KEY)
    if not spark.catalog.tableExists(target):
        writer = df.write.partitionBy(month_column).format("parquet")
        if buckets:
            writer = writer.bucketBy(buckets, *SUBSCRIPTION_KEY).sortBy(*SUBSCRIPTION_KEY)
        writer.saveAsTable(target)
        return
    columns = [c for c in spark.table(target).columns if c != month_column]
    spark.sql(
        f"INSERT OVERWRITE TABLE {target} PARTITION ({month_column} = DATE '{month}') SELECT * FROM {{rows}}",
        rows=df.select(*columns),
    )


# Fixed value: the name of a partition without a value.
NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"


def latest_month(spark: SparkSession, target: str, month_column: str = "ddate") -> date | None:
    """Newest month of a table, None if it is empty or missing.

    Lists partitions, in the catalog or in the folder, and opens no file.
    """
    if "/" in target:
        folder = spark._jvm.org.apache.hadoop.fs.Path(target)
        system = folder.getFileSystem(spark._jsc.hadoopConfiguration())
        if not system.exists(folder):
            return None
        names = [status.getPath().getName() for status in system.listStatus(folder)]
        names = [n for n in names if not n.startswith((".", "_"))]
        if names and not any(n.startswith(f"{month_column}=") for n in names):
            raise ValueError(f"{target} is not partitioned by {month_column}")
    else:
        if not spark.catalog.tableExists(target):
            return None
        names = [r[0] for r in spark.sql(f"SHOW PARTITIONS {target}").collect()]
    prefix = f"{month_column}="
    months = [n.removeprefix(prefix) for n in names if n.startswith(prefix)]
    return max((date.fromisoformat(m) for m in months if m != NULL_PARTITION), default=None)


def append_if_newer(
    topup_daily: DataFrame, usage_daily: DataFrame, target: str, as_of: date, lag: int = 1, buckets: int = 0
) -> bool:
    """Add a month to the usage datamart unless the table has it or a later one.

    Returns whether the month was added. An empty target takes any month; a
    missing older month is not filled in.
    """
    month = month_end(as_of, lag)
    latest = latest_month(topup_daily.sparkSession, target)
    if latest is not None and month <= latest:
        return False
    replace_month(usage_datamart(topup_daily, usage_daily, month), target, "ddate", month, buckets)
    return True


def write_scores(scores: DataFrame, path: str, text: bool = False) -> DataFrame:
    """Replace the score folder and read it back: Parquet parts, or CSV if ``text``."""
    writer = scores.select(*SCORES_SCHEMA.fieldNames()).write.mode("overwrite")
    if text:
        writer.option("header", True).csv(path)
    else:
        writer.parquet(path)
    return read_scores(scores.sparkSession, path, text)


def read_scores(spark: SparkSession, path: str, text: bool = False) -> DataFrame:
    reader = spark.read.schema(SCORES_SCHEMA)
    return reader.option("header", True).csv(path) if text else reader.parquet(path)


def campaign_folder(folder: str, run_date: date) -> str:
    return f"{folder.rstrip('/')}/EA_pre_{run_date:%Y%m}_SCORE.txt"


def export_campaign_list(campaign: DataFrame, folder: str, run_date: date) -> str:
    """Write the pipe-delimited list of a run month and return its folder.

    The list is a folder of parts, each with a header. A single file would
    pass all subscribers through one task.
    """
    target = campaign_folder(folder, run_date)
    campaign.write.mode("overwrite").option("sep", "|").option("header", True).csv(target)
    return target


def read_campaign_list(spark: SparkSession, target: str) -> DataFrame:
    return spark.read.schema(CAMPAIGN_SCHEMA).option("sep", "|").option("header", True).csv(target)


def append_score_table(campaign: DataFrame, target: str, prof_date: date) -> DataFrame:
    """Create the score table or add the month; running a month again replaces it."""
    replace_month(campaign, target, "prof_date", prof_date)
    return read_table(campaign.sparkSession, target, CAMPAIGN_SCHEMA)


def write_report(df: DataFrame, path: str) -> None:
    """Replace a small report (importance, gains, curve, predictor list) as CSV."""
    df.write.mode("overwrite").option("header", True).csv(path)


def read_lift_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(LIFT_SCHEMA).option("header", True).csv(path)


def table_profile(df: DataFrame) -> DataFrame:
    """One row per column: position, name, type, rows of the table, nulls.

    All counts come from a single pass that combines on the map side.
    """
    counts = df.agg(
        F.count(F.lit(1)).alias("_rows"), *[F.count(F.col(f"`{c}`")).alias(f"_n{i}") for i, c in enumerate(df.columns)]
    )
    described = [
        F.struct(
            F.lit(i + 1).alias("position"),
            F.lit(name).alias("column_name"),
            F.lit(kind).alias("data_type"),
            F.col("_rows").alias("n_rows"),
            F.lit(len(df.columns)).alias("n_columns"),
            (F.col("_rows") - F.col(f"_n{i}")).alias("n_null"),
        )
        for i, (name, kind) in enumerate(df.dtypes)
    ]
    return counts.select(F.inline(F.array(*described)))


def preview(df: DataFrame, rows: int = 10) -> DataFrame:
    return df.limit(rows)
