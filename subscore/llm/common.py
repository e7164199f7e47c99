"""What several of the document operators need.

``documents`` has ``doc_id`` and ``text``; other columns may follow and may have any
name but those that start with an underscore. A null text counts as empty.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import xxhash
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from subscore.session import shared_folder, ship_package

ROW = "_subscore_row"  # a name that no table has by chance
MASK = np.uint64(0xFFFFFFFFFFFFFFFF)
ODD = np.uint64(0x9E3779B97F4A7C15)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def bounded_batches(spark: SparkSession, rows: int = 1000) -> None:
    """Few rows in each batch that goes to Python, since a text can be very long."""
    ship_package(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(32 << 20))


def numbered(df: DataFrame) -> DataFrame:
    """``df`` with a number of its own per row; use it on a scan and store what comes of it.

    A second scan may be split otherwise and number the rows otherwise. What is joined
    by numbers must be numbered once and stored; such a table keeps its numbers here.
    """
    return df if ROW in df.columns else df.withColumn(ROW, F.monotonically_increasing_id())


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table in the shared folder: lineage is cut, rows and numbers are settled."""
    return stored_in(shared_folder(df.sparkSession, name), df, name)


def stored_in(folder: str, df: DataFrame, name: str) -> DataFrame:
    """As ``stored``, in a folder of ``shared_folder`` for several tables that the caller removes together."""
    path = f"{folder}/{name}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def located(df: DataFrame) -> DataFrame | None:
    """``df`` with each row's place in its Parquet files (``_file``, ``_index``), or None if it isn't read from such.

    Unlike a row number, the place doesn't depend on how a scan is split, so that no copy
    need be stored to join by it. ``_file`` is a hash, and what is done to rows after
    they are read may repeat them: the caller must see that no place occurs twice.
    """
    try:
        return df.select("*", F.xxhash64("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_index"))
    except AnalysisException:
        return None


def crc_of_id() -> Column:
    """Checksum of the id's digits; 0 for a null id."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(0))


def bitmap(df: DataFrame, column: str, bits: int) -> np.ndarray:
    """Which low ``bits`` of a hash occur, a bit each: 2**bits / 8 bytes however many rows.

    A filter before a shuffle. The fuller it is the less it holds back; the join
    behind it decides, so that results never depend on it.
    """
    place = (F.col(column).bitwiseAND(F.lit((1 << bits) - 1)) + 1).alias("_place")
    parts = (
        df.select(place)
        .groupBy(F.bitmap_bucket_number("_place").alias("_part"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position("_place")).alias("_bits"))
        .collect()
    )
    whole = np.zeros((1 << bits) // 8, np.uint8)
    for part, piece in parts:
        begin = (part - 1) * 4096
        piece = np.frombuffer(bytes(piece), np.uint8)[: len(whole) - begin]
        whole[begin : begin + len(piece)] = piece
    return whole


def in_bitmap(whole: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    place = hashes & np.uint64(len(whole) * 8 - 1)
    return (whole[place >> np.uint64(3)] >> (place & np.uint64(7)).astype(np.uint8)) & 1 == 1


def without(df: DataFrame, dropped: DataFrame, column: str, bits: int = 24) -> DataFrame:
    """Rows of ``df`` whose ``column`` isn't in ``dropped``, which is stored; only those that may be are shuffled.

    The bitmap of 2**bits / 8 bytes says for which rows that is sure; a join decides for
    the others. A null is in no table. ``df`` is read twice: it should be a written table.
    """
    ship_package(df.sparkSession)
    whole = df.sparkSession.sparkContext.broadcast(bitmap(dropped.select(F.xxhash64(column).alias("_hash")), "_hash", bits))

    def may(hashes: pd.Series) -> pd.Series:
        return pd.Series(in_bitmap(whole.value, hashes.to_numpy().view(np.uint64)))

    marked = F.pandas_udf(may, "boolean")(F.xxhash64(column))
    open_ = df.withColumn("_may", marked)
    sure = open_.filter("not _may").drop("_may")
    return sure.unionByName(open_.filter("_may").drop("_may").join(dropped, column, "left_anti"))


def mixed(x: np.ndarray) -> np.ndarray:
    """Spreads 64-bit values evenly (the finaliser of splitmix64)."""
    with np.errstate(over="ignore"):
        x = x + ODD
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


class WordHashes(dict):
    """64-bit hash of a word, kept for the words seen first, up to ``limit``."""

    limit = 300_000

    def __missing__(self, word: bytes) -> int:
        value = xxhash.xxh3_64_intdigest(word)
        if len(self) < self.limit:
            self[word] = value
        return value


_HASHES = WordHashes()


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(_HASHES.__getitem__, words), np.uint64, len(words))


def utf8(text: str | None) -> bytes:
    return (text or "").encode("utf-8", "surrogatepass")


def spaced_words(text: str | None) -> list[bytes]:
    """Words between ASCII white space, A-Z lower-cased, in UTF-8."""
    return utf8(text).lower().split()


# All of ASCII but digits and lower-case letters separates words.
_SEPARATORS = bytes(b for b in range(128) if not (0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A))
_TO_SPACE = bytes.maketrans(_SEPARATORS, b" " * len(_SEPARATORS))


def plain_words(text: str | None) -> list[bytes]:
    """Runs of digits, letters and other characters beyond ASCII, A-Z lower-cased."""
    return utf8(text).lower().translate(_TO_SPACE).split()
