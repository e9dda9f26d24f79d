"""Finding files: listing, choice by name, folder and snapshot date, and the newest snapshot.

Files are chosen from the listing alone: it is a table of paths, ``newest_per_folder`` and its like pick rows of it, and
``chosen`` turns the rows into the literal paths that a reader is given. What is not chosen is never opened.
"""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pricelens.functions.nulls import col
from pricelens.functions.text import company_of, file_stem
from pricelens.operators.joins import skew_join
from pricelens.settings import Names, as_names

FILE_PATH = "_metadata.file_path"
DATE_IN_PATH = r"/(?:[A-Za-z_]+=)?(\d{4}-\d{2}-\d{2})/"
#: A text writer turns a file name into a folder of part files.
PART_FILE = r"(\.[A-Za-z0-9]+)/part-[^/]*$"


def list_files(spark: SparkSession, path: str, suffix: str) -> DataFrame:
    """Files below a folder with the given suffix: ``path, folder, name, length, modificationTime``.

    The content is not read. The part files of a folder that has a suffix itself have the folder's name.
    """
    files = (
        spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
        .select("path", "length", "modificationTime")
    )
    whole = F.regexp_replace("path", PART_FILE, "$1")
    return files.where(whole.endswith(suffix)).select(
        "path", F.regexp_replace(whole, "/[^/]*$", "").alias("folder"), F.element_at(F.split(whole, "/"), -1).alias("name"),
        "length", "modificationTime",
    )


def newest_per_folder(files: DataFrame) -> DataFrame:
    """Of each folder the file with the last name; names begin with or hold a sortable date."""
    last = files.groupBy("folder").agg(F.max("name").alias("name"))
    return skew_join(files, last, ["folder", "name"], "inner").select(files.columns)


def newest_folder(files: DataFrame, root: str, pattern: str) -> DataFrame:
    """The files below the folder with the last name, of the folders in ``root`` whose names match the pattern from their start."""
    below = F.split(F.concat("folder", F.lit("/")), f"\\Q/{root.strip('/')}/\\E", 2)
    name = F.substring_index(F.get(below, F.lit(1)), "/", 1)
    named = files.withColumn("__name", F.when(name.rlike(f"^(?:{pattern})"), name))
    return named.where(F.col("__name") == named.agg(F.max("__name")).scalar()).select(files.columns)


def newest_file(files: DataFrame) -> DataFrame:
    """The file with the last name of all."""
    return files.where(F.col("name") == files.agg(F.max("name")).scalar())


def chosen(files: DataFrame) -> list[str]:
    """The paths of the listing, for a reader; signs that a reader takes for a pattern are escaped.

    The list is as long as the number of files chosen: the reader's plan holds each of them anyway.
    """
    paths = [re.sub(r"([\[\]{}*?\\])", r"\\\1", row.path) for row in files.select("path").orderBy("path").toLocalIterator()]
    if not paths:
        raise ValueError("no file was chosen")
    return paths


def name_matches(
    names: Iterable[str], path: str | Column = FILE_PATH, excluded: str | None = "badmoebel"
) -> Column:
    """File names that contain one of the names and, behind it, not the excluded word; any case."""
    stem = F.lower(file_stem(F.col(path) if isinstance(path, str) else path))
    wanted = "|".join(n.lower() for n in names)
    behind = f"(?!.*{excluded.lower()})" if excluded else ""
    return stem.rlike(f"({wanted}){behind}")


def not_named(word: str, path: str | Column = FILE_PATH) -> Column:
    return ~F.contains(F.col(path) if isinstance(path, str) else path, F.lit(word))


def with_origin(df: DataFrame, path: Column | None = None) -> DataFrame:
    """Competitor and snapshot date of the file a row came from. Call it on a file scan, or with the path of a listing."""
    path = F.col(FILE_PATH) if path is None else F.replace(path, F.lit("%"), F.lit("%25"))  # a scan's paths are encoded
    return df.select(
        "*",
        F.regexp_replace(company_of(F.regexp_replace(path, PART_FILE, "$1")), "^[A-Za-z_]+=", "").alias("Company"),
        F.regexp_extract(path, DATE_IN_PATH, 1).try_cast("date").alias("Snapshotdate"),
    )


def newest_snapshot(df: DataFrame, date: str = "Snapshotdate", by: Names = ()) -> DataFrame:
    """Rows of the latest date, over all rows or per group.

    Where the dates are known beforehand, filter on the literal date instead: on a partition column
    that reads one folder only.
    """
    keys = as_names(by)
    if not keys:
        return df.where(col(date) == df.agg(F.max(col(date))).scalar())
    latest = df.groupBy(*(col(k) for k in keys)).agg(F.max(col(date)).alias(date))
    return skew_join(df, latest, [*keys, date], "inner").select(*(col(c) for c in df.columns))
