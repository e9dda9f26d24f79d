"""Article and category tables from catalogue XML, reference tables from fixed-width files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pricelens.functions.nulls import as_number, col, normalise_nulls
from pricelens.functions.text import compact, path_level, repair_dos_text
from pricelens.operators.ranking import last_write_wins
from pricelens.sources.catalogue_xml import (
    REGISTER_DEPTH, attribute_below, below, read_articles, read_register, record_attribute, texts_below,
)
from pricelens.sources.fixed_width import Layout, read_fixed_width

# The columns of an article file.
ARTICLE_COLUMNS = (
    "ArtikelId", "FarbId", "AusführungsId", "Preis_Pos", "Preis_EAN", "Art_Nr_Hersteller",
    "Art_Nr_Hersteller_Firma", "Art_Nr_EAN", "Art_Nr_Nachfolge", "Art_Nr_Synonym",
    "Art_Nr_Synonym_Firma", "Art_Valid_Von", "Art_Valid_Bis", "Art_Txt_Kurz", "Art_Txt_Lang",
    "Art_Menge", "BM_Einheit_Code", "BM_Einheit_Code_BM_Einheit", "AF_Nr", "AF_Txt", "AFZ_Txt",
    "AFZ_Nr", "Preis",
)

PRICE_ROW = (
    "struct<AF_Nr: string, AF_Txt: string, AFZ_Nr: string, AFZ_Txt: string, Preis: string, Preis_EAN: string>"
)


def price_row(**values: Column) -> Column:
    names = ("AF_Nr", "AF_Txt", "AFZ_Nr", "AFZ_Txt", "Preis", "Preis_EAN")
    return F.struct(*(values.get(n, F.lit(None)).cast("string").alias(n) for n in names))


def price_rows() -> Column:
    """The price rows of an article as one array, by the shape of its prices.

    Plain prices, prices per colour, or prices per colour and variant; each part may lie at any depth. An article that
    has both colour shapes has no rows.
    """
    none = F.array().cast(f"array<{PRICE_ROW}>")
    colours, variants = below("Preis_AF"), below("Preis_AF_Zusatz")
    plain = F.transform(
        below("Preis"), lambda p: price_row(Preis=texts_below("Preis_Pos", p), Preis_EAN=texts_below("Preis_EAN", p))
    )

    def of_colour(a: Column) -> Column:
        return price_row(
            AF_Nr=texts_below("AF_Nr", a), AF_Txt=texts_below("AF_Txt", a),
            Preis=texts_below("Preis_Pos", a), Preis_EAN=texts_below("EAN", a),
        )

    def of_variants(a: Column) -> Column:
        return F.transform(
            below("AFZ_Nr", a),
            lambda v: price_row(
                AF_Nr=texts_below("AF_Nr", a), AF_Txt=texts_below("AF_Txt", a), AFZ_Nr=v["text"],
                AFZ_Txt=v["attributes"]["Txt"], Preis=v["attributes"]["Preis"], Preis_EAN=v["attributes"]["EAN"],
            ),
        )

    per_colour = F.flatten(F.transform(colours, lambda c: F.transform(below("AF", c), of_colour)))
    per_variant = F.flatten(F.flatten(F.transform(variants, lambda z: F.transform(below("AFZ", z), of_variants))))
    has_colours, has_variants = F.size(colours) > 0, F.size(variants) > 0
    return (
        F.when(has_colours & has_variants, none)
        .when(has_colours, per_colour)
        .when(has_variants, per_variant)
        .otherwise(F.coalesce(plain, none))
    )


def shape_conflicts(articles: DataFrame) -> DataFrame:
    """Articles that give no row because they have both colour price shapes."""
    both = (F.size(below("Preis_AF")) > 0) & (F.size(below("Preis_AF_Zusatz")) > 0)
    return articles.where(both).select("file", record_attribute("Art_Nr_Anbieter").alias("ArtikelId"))


def article_rows(articles: DataFrame) -> DataFrame:
    """The 23-column article table. Of rows with the same article, colour and variant in a file the
    last one stays."""
    attributes = {
        "ArtikelId": record_attribute("Art_Nr_Anbieter"),
        "Art_Nr_Hersteller_Firma": attribute_below("Art_Nr_Hersteller_Firma", "Firma"),
        "BM_Einheit_Code_BM_Einheit": texts_below("BM_Einheit_Code"),
    }
    lists = (
        "Art_Nr_Hersteller", "Art_Nr_EAN", "Art_Nr_Nachfolge", "Art_Nr_Synonym", "Art_Nr_Synonym_Firma", "Art_Valid_Von",
        "Art_Valid_Bis", "Art_Txt_Kurz", "Art_Txt_Lang", "Art_Menge", "BM_Einheit_Code",
    )
    rows = articles.select(
        "file",
        "block",
        "position",
        *(c.alias(n) for n, c in attributes.items()),
        *(texts_below(n).alias(n) for n in lists),
        F.posexplode(price_rows()).alias("row", "p"),
    ).select("*", "p.*").drop("p")
    keyed = rows.withColumns({"FarbId": F.col("AF_Nr"), "AusführungsId": F.col("AFZ_Nr")})
    unique = last_write_wins(
        keyed, ("file", "ArtikelId", "FarbId", "AusführungsId"), ("block", "position", "row")
    )
    clean = normalise_nulls(unique, [c for c in ARTICLE_COLUMNS if c != "Preis_Pos"])
    return clean.withColumn("Preis_Pos", as_number("Preis")).select("file", *ARTICLE_COLUMNS)


def category_paths(register: DataFrame) -> DataFrame:
    """The category path of each article, root first. An article listed several times has the path of its last listing:
    in the last top element, of the highest kind there, the last in the document."""
    place = F.struct("block", "position", "e.kind", "e.pos", "e.path")
    return (
        register.select("file", "block", "position", F.explode("listings").alias("e"))
        .groupBy("file", F.col("e.article").alias("ArtikelId"))
        .agg(F.max(place).alias("last"))
        .select("file", "ArtikelId", compact(F.col("last.path")).alias("path"))
    )


def deeper_paths(paths: DataFrame, levels: int = REGISTER_DEPTH) -> DataFrame:
    """Articles whose category path has more levels than a category table of ``levels`` can hold."""
    return paths.where(F.size("path") > levels)


def category_levels(paths: DataFrame, levels: int = REGISTER_DEPTH) -> DataFrame:
    """The path as ``Category_Level_1 … n``; a short path is filled with its last entry. A match result has the first four.

    A path with more than ``levels`` entries is an error that names the article; ``deeper_paths`` lists them all.
    """
    too_deep = F.raise_error(F.concat(F.lit("more category levels than asked for: "), F.col("ArtikelId")))
    whole = paths.withColumn("path", F.when(F.size("path") > levels, too_deep.cast("array<string>")).otherwise(F.col("path")))
    names = [path_level("path", i + 1).alias(f"Category_Level_{i + 1}") for i in range(levels)]
    return whole.select(*(col(c) for c in paths.columns if c != "path"), *names)


def with_categories(articles: DataFrame, categories: DataFrame) -> DataFrame:
    return articles.join(categories, [c for c in ("file", "ArtikelId") if c in articles.columns], "left")


def articles_from_xml(spark: SparkSession, paths: str | list[str], levels: int = REGISTER_DEPTH) -> DataFrame:
    """All catalogues at once: article rows with categories and the file they come from."""
    categories = category_levels(category_paths(read_register(spark, paths)), levels)
    return with_categories(article_rows(read_articles(spark, paths)), categories)


def reference_rows(sliced: DataFrame) -> DataFrame:
    """Missing values, copies and empty rows removed, umlauts repaired."""
    clean = normalise_nulls(sliced, spellings=("", "\x1a")).distinct().dropna("all")
    return clean.select(*(repair_dos_text(c).alias(c) for c in clean.columns))


def reference_from_fixed_width(spark: SparkSession, paths: str | list[str], layout: Layout) -> DataFrame:
    return reference_rows(read_fixed_width(spark, paths, layout))
