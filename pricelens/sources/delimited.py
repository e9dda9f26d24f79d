"""Delimited text: every column is text, types are given later."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

Paths = str | Sequence[str]


def text_schema(columns: Sequence[str]) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType()) for c in columns])


def _read(spark: SparkSession, paths: Paths, sep: str, columns: Sequence[str] | None, **options) -> DataFrame:
    reader = spark.read.options(
        sep=sep, header=True, encoding="utf-8", escape='"', inferSchema=False, enforceSchema=False, **options
    )
    if columns is not None:
        reader = reader.schema(text_schema(columns))
    return reader.csv(paths if isinstance(paths, str) else list(paths))


def read_semicolon(spark: SparkSession, paths: Paths, columns: Sequence[str] | None = None) -> DataFrame:
    """``;``-separated files whose quoted texts may hold line breaks.

    Such files cannot be split, so their number is the parallelism: one file per competitor and
    date. Without ``columns`` the header of the files is taken.
    """
    return _read(spark, paths, ";", columns, multiLine=True)


def read_tabs(spark: SparkSession, paths: Paths, columns: Sequence[str] | None = None) -> DataFrame:
    """Tab-separated files with one line per row."""
    return _read(spark, paths, "\t", columns)
