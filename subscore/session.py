"""Session settings and the shared folder for intermediate tables."""

from __future__ import annotations

import uuid
import zipfile
from pathlib import Path
from urllib.parse import unquote, urlparse

from pyspark.sql import SparkSession

# Settings the plans are written for. Adaptive execution sizes reduce tasks,
# turns a join into a broadcast only after measuring the side, and splits
# skewed join partitions; none of that depends on table statistics. A join
# whose measured partitions all stay below the hash threshold is not sorted.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64m",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.files.maxPartitionBytes": "128m",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.ui.enabled": "false",
}


def build_session(
    app_name: str = "subscore",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    **extra: str,
) -> SparkSession:
    """A session with ``SETTINGS``.

    ``shuffle_partitions`` is the upper number of reduce tasks; adaptive
    execution merges small ones. Leave it unset to keep the cluster's value.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = dict(SETTINGS)
    if shuffle_partitions:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    settings.update(extra)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder for one run's tables, below the cluster's shared folder.

    The shared folder is whatever ``spark.checkpoint.dir`` names, or else the
    session's warehouse, which executors share as well. Folders are not removed
    here: what was returned may be read until the session ends. ``folders_made`` lists
    them, for a caller that knows when they have been read.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    folder = f"{base.rstrip('/')}/subscore-{name}-{uuid.uuid4().hex}"
    folders_made(spark).append(folder)
    return folder


def folders_made(spark: SparkSession) -> list[str]:
    """The folders that ``shared_folder`` has named in this session, in order."""
    context = spark.sparkContext
    if not hasattr(context, "_subscore_folders"):
        context._subscore_folders = []
    return context._subscore_folders


def remove_folders(spark: SparkSession, folders: list[str]) -> None:
    """Remove folders of this session's own; those without files are passed over."""
    made = folders_made(spark)
    for folder in folders:
        if folder not in made:
            raise ValueError(f"{folder} was not made here")
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
        made.remove(folder)


def ship_package(spark: SparkSession) -> None:
    """Give Python workers this package, once a session, through the shared folder.

    A folder that isn't mounted can't take it; then it must be installed on all machines.
    """
    context = spark.sparkContext
    if getattr(context, "_subscore_shipped", False):
        return
    target = shared_folder(spark, "package")
    folders_made(spark).remove(target)  # it stays as long as the session
    url = urlparse(target)
    if url.scheme not in ("", "file"):
        return
    context._subscore_shipped = True
    package = Path(__file__).resolve().parent
    folder = Path(unquote(url.path))
    folder.mkdir(parents=True, exist_ok=True)
    with zipfile.ZipFile(folder / "subscore.zip", "w", zipfile.ZIP_DEFLATED) as out:
        for source in sorted(package.rglob("*.py")):
            out.write(source, source.relative_to(package.parent))
    context.addPyFile(str(folder / "subscore.zip"))
