"""The prepared catalogue: typed prices and the identifiers articles are matched on."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricelens.functions.nulls import as_number, blank_to_null, is_missing, null_to_blank
from pricelens.functions.text import clean_number, null_if_shorter, unique_id
from pricelens.operators.joins import drop_suffixed, left_join_present

NO_COLOUR = "000"


def prepare_catalogue(df: DataFrame) -> DataFrame:
    """Distinct rows with ``Farbe``, ``Ausführung``, ``Preis``, ``UID``, ``Art_Nr_Hersteller_UID``
    and ``EAN``. Maker numbers shorter than five characters are dropped."""
    parts = {
        "FarbId": F.when(is_missing("FarbId"), F.lit(NO_COLOUR)).otherwise(F.col("FarbId")),
        "AusführungsId": null_to_blank("AusführungsId"),
        "Art_Nr_Hersteller": null_to_blank("Art_Nr_Hersteller"),
        "Farbe": null_to_blank("AF_Txt"),
        "Ausführung": null_to_blank("AFZ_Txt"),
        "Preis": as_number("Preis_Pos"),
        "EAN": F.coalesce("Preis_EAN", "Art_Nr_EAN"),
    }
    ids = {
        "UID": unique_id("ArtikelId", "FarbId", "AusführungsId"),
        "Art_Nr_Hersteller_UID": null_if_shorter(
            blank_to_null(unique_id("Art_Nr_Hersteller", "FarbId", "AusführungsId"))
        ),
    }
    return (
        df.distinct()
        .withColumns(parts)
        .withColumns(ids)
        .withColumn("Art_Nr_Hersteller", null_if_shorter(blank_to_null("Art_Nr_Hersteller")))
    )


def join_reference(
    df: DataFrame, reference: DataFrame, left_on: str = "ArtikelId", right_on: str = "Artikelnummer"
) -> DataFrame:
    """Reference columns by article number, with the competitor's number cleaned to six digits.

    Columns the catalogue has already keep the catalogue's values, except ``Konkurrenznummer``.
    """
    cleaned = reference.withColumn("Konkurrenznummer", clean_number("Konkurrenznummer"))
    joined = left_join_present(df, cleaned, left_on, right_on)
    fresh = [c for c in cleaned.columns if c not in df.columns or c == "Konkurrenznummer"]
    return drop_suffixed(joined.withColumns({c: F.col(f"`{c}___y`") for c in fresh}))
