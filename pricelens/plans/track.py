"""Prices over dated snapshots."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pricelens.functions.nulls import col
from pricelens.functions.text import has_server_text, one_line, server_text, snapshot_label, unique_id
from pricelens.operators.reshape import price_change
from pricelens.plans.prepare import NO_COLOUR
from pricelens.plans.sales import EXCLUDED_SUPPLIER
from pricelens.sources.delimited import read_semicolon
from pricelens.sources.files import chosen, list_files, with_origin

# The article columns of the tracker file.
TRACKER_COLUMNS = (
    "ArtikelId", "FarbId", "AusführungsId", "Art_Txt_Lang", "Preis",
    "Category_Level_1", "Category_Level_2", "Category_Level_3", "Category_Level_4",
)


def read_archive(
    spark: SparkSession,
    path: str,
    columns: Iterable[str] | None = None,
    dates: Iterable[str] | None = None,
    companies: Iterable[str] | None = None,
) -> DataFrame:
    """Snapshots of competitors below ``<path>/<date>/<company>-….csv`` in one scan.

    Date and competitor stand in the path, so ``dates`` and ``companies`` choose files before anything is read.
    """
    files = list_files(spark, path, ".csv")
    origin = with_origin(files, F.col("path"))
    if dates is not None:
        origin = origin.where(F.col("Snapshotdate").isin([F.lit(d).cast("date") for d in dates]))
    if companies is not None:
        origin = origin.where(F.col("Company").isin(list(companies)))
    names = list(columns) if columns is not None else None
    return with_origin(read_semicolon(spark, chosen(origin), names))


def price_tracker(archive: DataFrame, companies: Iterable[str]) -> DataFrame:
    """The tracker table: article, price, categories, date, date label and competitor. A competitor
    that lacks a snapshot keeps its other ones."""
    texts = {c: F.coalesce(col(c).cast("string"), F.lit("")) for c in TRACKER_COLUMNS if c != "Preis"}
    return (
        archive.where(col("Company").isin(list(companies)))
        .select(*TRACKER_COLUMNS, "Snapshotdate", "Company")
        .withColumns(texts)
        .withColumns(
            {
                "Preis": col("Preis").try_cast("double"),
                "Art_Txt_Lang": one_line("Art_Txt_Lang"),
                "Snapshotdate_String": snapshot_label("Snapshotdate"),
            }
        )
        .select(*TRACKER_COLUMNS, "Snapshotdate", "Snapshotdate_String", "Company")
    )


def change_report(
    archive: DataFrame, company: str, earlier: str, later: str, sales: DataFrame | None = None
) -> DataFrame:
    """Price change between two dates for one competitor, beside the article's sales, by sales.

    ``sales`` has a column ``SGVSB`` with the unique id and ``Umsatz``; the sort is the report's
    order, so write it as it is."""
    rows = archive.where((col("Company") == company) & col("Snapshotdate").isin(earlier, later))
    colour = F.when(F.coalesce("FarbId", F.lit("")) == "", F.lit(NO_COLOUR)).otherwise(col("FarbId"))
    variant = F.coalesce("AusführungsId", F.lit(""))
    keyed = rows.select(
        unique_id("ArtikelId", colour, variant).alias("UID"),
        col("Snapshotdate").cast("string").alias("Timestamp"),
        "Preis_Pos",
    )
    change = price_change(keyed, earlier, later)
    if sales is None:
        return change
    return change.join(sales.withColumnRenamed("SGVSB", "UID"), "UID", "left").orderBy(
        F.col("Umsatz").desc_nulls_last(), "UID"
    )


def article_conditions(
    master: DataFrame, conditions: DataFrame, sales: DataFrame, excluded_supplier: str = EXCLUDED_SUPPLIER
) -> DataFrame:
    """Article master with the highest price conditions per article and the year's sales.

    ``master``: ``Artikel, SGVSB, Lieferant``; ``conditions``: ``Artikel`` and price columns;
    ``sales``: ``iditemOrigin, Sales``. Articles without a unique id, without a supplier or of the
    excluded supplier are left out. Ids match whatever their case, accents and trailing blanks.
    """
    master = master.where(has_server_text("SGVSB") & (server_text("Lieferant") != excluded_supplier))
    prices = [c for c in conditions.columns if c != "Artikel"]
    highest = conditions.groupBy("Artikel").agg(*(F.max(col(p)).alias(p) for p in prices))
    turnover = sales.groupBy("iditemOrigin").agg(F.sum("Sales").alias("Umsatz"))
    return (
        master.join(highest, "Artikel", "left")
        .join(turnover, server_text("Artikel") == server_text("iditemOrigin"), "left")
        .drop("iditemOrigin")
    )
