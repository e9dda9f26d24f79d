"""Fixed-width reference files."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from itertools import accumulate

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Layout:
    widths: tuple[int, ...]
    columns: tuple[str, ...]

    @property
    def slices(self) -> list[tuple[str, int, int]]:
        starts = [1, *(1 + end for end in accumulate(self.widths))]
        return list(zip(self.columns, starts, self.widths))


# Record layouts of the reference files.
LAYOUTS = {
    "KOMART0": Layout(
        (6, 8, 8, 1, 8, 6, 20, 1, 3, 1, 6, 6, 6, 6, 6, 1),
        (
            "Artikelnummer", "Lieferantennummer", "Matchcode", "Mutationscode", "Herstellernummer",
            "NPK-Nummer", "Konkurrenznummer", "Termincode", "Warengruppe", "Stücklisten-Code",
            "Länge", "Tiefe", "Höhe", "Breite", "Durchmesser", "Masseinheit",
        ),
    ),
    "KOMPRS": Layout(
        (6, 2, 9, 2, 9, 9, 9, 1, 3, 8),
        (
            "Artikelnummer", "Preiskategorie", "Einkaufspreis in FW", "Währungscode",
            "Einkaufspreis in SFR", "SK-Preis", "HV-Preis", "Mutationscode", "Warenumsatzkategorie",
            "Preis gültig ab Datum",
        ),
    ),
    "KOMFAK": Layout(
        (6, 2, 3, 1), ("Artikelnummer", "Preiskategorie", "Farbnummer", "Mutationscode")
    ),
    "KOMAUP": Layout(
        (6, 2, 3, 7, 9, 2, 9, 9, 9, 8, 1),
        (
            "Artikelnummer", "Preiskategorie", "Ausführungsnummer", "Prozentzuschlag",
            "Einkaufs-Zuschlag in FW", "Währungscode", "Einkaufszuschlag", "SK-Zuschlag",
            "HV-Zuschlag", "Zuschlag gültig ab Datum", "Mutationscode",
        ),
    ),
    "KOMWGR": Layout(
        (3, 30, 30, 30, 1),
        ("Warengruppe", "Text deutsch", "Text französisch", "Text italienisch", "Mutationscode"),
    ),
}


def read_lines(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """Whole lines of ISO-8859-1 files, which any byte can be read as."""
    return (
        spark.read.schema("line string")
        .options(
            sep="\u0001", quote="", encoding="iso-8859-1",
            ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False,
        )
        .csv(paths if isinstance(paths, str) else list(paths))
    )


def slice_lines(lines: DataFrame, layout: Layout, line: str = "line") -> DataFrame:
    return lines.select(
        *(F.trim(F.substring(line, start, width)).alias(name) for name, start, width in layout.slices)
    )


def read_fixed_width(spark: SparkSession, paths: str | Sequence[str], layout: Layout) -> DataFrame:
    return slice_lines(read_lines(spark, paths), layout)
