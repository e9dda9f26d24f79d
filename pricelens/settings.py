"""Typed job settings: competitors, their ordered join keys, thresholds and output columns."""

from __future__ import annotations

import json
from collections.abc import Iterable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

Names = str | Iterable[str]


def as_names(value: Names) -> list[str]:
    """One name or a sequence of names, always as a list."""
    return [value] if isinstance(value, str) else list(value)


@dataclass(frozen=True)
class JoinKey:
    """One step of a match cascade: the left columns that must equal the right columns."""

    left: tuple[str, ...]
    right: tuple[str, ...]

    @classmethod
    def of(cls, left: Names, right: Names | None = None) -> JoinKey:
        left_names = tuple(as_names(left))
        right_names = tuple(as_names(right)) if right is not None else left_names
        if len(left_names) != len(right_names):
            raise ValueError(f"key parts differ in number: {left_names} and {right_names}")
        return cls(left_names, right_names)

    @property
    def label(self) -> str:
        """The tag written to ``Joined_on``."""
        return " ".join(self.left)


@dataclass(frozen=True)
class Settings:
    main_file: str
    companies: Mapping[str, tuple[JoinKey, ...]]
    max_text_distance: float = 0.3
    max_price_difference: float = 0.5
    outlier_threshold: float = 2.5
    output_columns: tuple[str, ...] = field(default_factory=tuple)

    @property
    def company_names(self) -> list[str]:
        return list(self.companies)

    def to_frame(self, spark: SparkSession) -> DataFrame:
        """The key configuration as a table ``(company, prio, left_cols, right_cols)``."""
        rows = [
            (company, prio, list(key.left), list(key.right))
            for company, keys in self.companies.items()
            for prio, key in enumerate(keys)
        ]
        return spark.createDataFrame(
            rows, "company string, prio int, left_cols array<string>, right_cols array<string>"
        )


# Competitor names, join keys and result columns users of the result files rely on.
COMPANIES = ("Sanitas", "Sabag", "Saneo", "TeamSaniDusch", "TeamHug", "TeamKappeler", "TeamMaga")
SHARED_KEYS = ("EAN", "Art_Nr_Hersteller_UID", "Art_Nr_Hersteller")
ARTICLE_COLUMNS = (
    "ArtikelId", "UID", "Art_Txt_Lang", "Preis",
    "Category_Level_1", "Category_Level_2", "Category_Level_3", "Category_Level_4",
)
SALES_COLUMNS = (
    "Article_group", "Discount_group", "Suppliername", "Creation_Date", "Brand Name", "Purchaseprice",
    "GrossSales_LTM", "Sales_LTM", "Margin_LTM", "Quantity_LTM", "ObjectRate", "CountOfOrders",
    "CountOfCustomers", "Discount_perc", "Margin_perc",
)
BASKET_COLUMNS = (
    "Consequents", "Consequents_Art_Txt_Lang", "SalesConsequents_LTM", "Support", "Confidence",
)
CLUSTER_COLUMNS = (
    "Cluster_Margin_perc_&_Sales_LTM_Log",
    "Cluster_Quantity_LTM_Log_&_Sales_LTM_Log",
    "Cluster_ObjectRate_&_Sales_LTM_Log",
    "Cluster_SalesConsequents_LTM_Log_&_Sales_LTM_Log",
)
GROUP_COLUMNS = ("Warengruppe", "Warengruppe_Bezeichnung")


def output_columns(companies: Iterable[str]) -> tuple[str, ...]:
    """Columns of the analysis table; per-competitor columns follow the competitors' sort order."""
    names = sorted(companies)

    def per_company(prefix: str) -> tuple[str, ...]:
        return tuple(f"{prefix}_{name}" for name in names)

    return (
        *ARTICLE_COLUMNS,
        *per_company("Preis_Konkurrenz"),
        *per_company("Txt_Lang_Konkurrenz"),
        *per_company("Joined_on"),
        *SALES_COLUMNS,
        "GrossSales_Calculated",
        *per_company("GrossSales_Calculated"),
        "ProCasa",
        *per_company("Outlier"),
        *BASKET_COLUMNS,
        *CLUSTER_COLUMNS,
        *GROUP_COLUMNS,
    )


def default_settings() -> Settings:
    by_uid = (JoinKey.of("UID"), *(JoinKey.of(name) for name in SHARED_KEYS))
    by_competitor_number = (
        JoinKey.of(("Konkurrenznummer", "Farbe"), ("ArtikelId", "Farbe")),
        *(JoinKey.of(name) for name in SHARED_KEYS),
    )
    companies = {name: by_competitor_number if name == "Sanitas" else by_uid for name in COMPANIES}
    return Settings("Richner", companies, output_columns=output_columns(COMPANIES))


def parse_settings(document: Mapping, section: str = "Sanitary", **limits: float) -> Settings:
    """Settings from the JSON layout ``{section: {"Main File", "Companies": {name: {"Join Keys"}}}}``.

    A missing section or key gives an error that names it. The limits for text distance, price
    difference and outliers are job parameters: pass them as keywords to change the defaults.
    """
    body = require(document, section)
    companies = {
        company: tuple(JoinKey.of(*pair) for pair in require(entry, "Join Keys"))
        for company, entry in require(body, "Companies").items()
    }
    return Settings(
        main_file=require(body, "Main File"),
        companies=companies,
        output_columns=tuple(body.get("Output Columns", output_columns(companies))),
        **limits,
    )


def require(mapping: Mapping, key: str):
    if key not in mapping:
        raise KeyError(f"settings entry {key!r} is missing")
    return mapping[key]


def has_entry(mapping: Mapping, key: str, entry: str) -> bool:
    """Whether ``mapping[key][entry]`` is there and true."""
    return bool(mapping.get(key, {}).get(entry, False))


def load_settings(spark: SparkSession, path: str, section: str = "Sanitary", **limits: float) -> Settings:
    """Read the settings file through Spark, so that any storage the session knows can hold it."""
    text = spark.read.text(path, wholetext=True).head()
    if text is None:
        raise ValueError(f"settings file {path} is empty")
    return parse_settings(json.loads(text.value), section, **limits)
