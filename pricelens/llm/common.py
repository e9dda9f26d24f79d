"""Column expressions and small table helpers shared by the operators of this subpackage."""

from __future__ import annotations

import contextlib
import ctypes
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pricelens.session import materialise

#: The white space of every contract: blank, tab, line feed, vertical tab, form feed, carriage return.
SPACES = " \t\n\x0b\f\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once per row: a lambda variable is never inlined again."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def ascii_lower(text: Column) -> Column:
    """Lower case of A-Z only; texts without other characters take the fast built-in."""
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def split_words(text: Column) -> Column:
    """The words ``[^\\x20\\x09-\\x0D]+`` of a text; none for null."""
    spaced = F.regexp_replace(F.coalesce(text, F.lit("")), "[\\t\\n\\x0B\\f\\r]+", " ")
    return F.filter(F.split(spaced, " "), lambda w: w != "")


def text_print(text: Column) -> Column:
    """128 bits that stand for a text; with ``doc_id`` they name a row, and equal rows share their results."""
    return F.struct(F.xxhash64(text).alias("a"), F.xxhash64(F.lit(7), text).alias("b"))


def fold(doc_id: Column, parts: int) -> Column:
    """crc32 of the id written as text, modulo ``parts``; a null id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % parts


def trim() -> None:
    """Gives freed memory back to the system: a worker outlives its task, and its executor's next tasks need the room."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(AttributeError, OSError):  # another C library has its own ways
        ctypes.CDLL(None).malloc_trim(0)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/documents.parquet")


def laid_out(df: DataFrame, keys: list[Column], name: str) -> DataFrame:
    """``df`` range-partitioned and sorted by ``keys``, written once, with the partition in ``__part``.

    The keys should tell rows apart, so that no value of the leading key fills a partition alone.
    """
    ranged = df.repartitionByRange(partitions(df.sparkSession), *keys).sortWithinPartitions(*keys)
    return materialise(ranged.withColumn("__part", F.spark_partition_id()), name)


def slots(df: DataFrame, by: str, keys: list[Column], slot: str) -> DataFrame:
    """Gapless position from 0 of each row in its ``by`` value; a value may span many partitions."""
    laid = laid_out(df, [F.col(by), *keys], "slots")
    before = Window.partitionBy(by).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        laid.groupBy(by, "__part").count()
        .select(by, "__part", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("__start"))
    )
    within = Window.partitionBy(by, "__part").orderBy(*keys)
    placed = laid.withColumn("__n", F.row_number().over(within))
    return placed.join(starts, [by, "__part"]).withColumn(slot, (F.col("__n") - 1 + F.col("__start")).cast("long")).drop("__n", "__start", "__part")
