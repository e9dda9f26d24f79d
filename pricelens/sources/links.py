"""Links of web pages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pricelens.functions.nulls import col

ANCHOR = r"(?is)(<a\s[^>]*>.*?</a>)"


def attribute(tag: Column, name: str) -> Column:
    return F.regexp_extract(tag, rf'(?is)^<a\s[^>]*?\b{name}\s*=\s*"([^"]*)"', 1)


def page_links(
    pages: DataFrame,
    html: str = "html",
    base: str | Column = "",
    name: str = "title",
    value: str | None = "Download Katalog",
) -> DataFrame:
    """One row per link: ``title`` and absolute ``url``. With ``value`` only links whose attribute
    ``name`` has that value count, otherwise all links with an address; a link without the attribute
    is titled by its text."""
    start = F.lit(base) if isinstance(base, str) else base
    found = pages.withColumns(
        {"__base": start, "__a": F.explode(F.regexp_extract_all(col(html), F.lit(ANCHOR), 1))}
    )
    href, title = attribute(F.col("__a"), "href"), attribute(F.col("__a"), name)
    text = F.regexp_replace(F.regexp_replace("__a", r"(?is)^<a\s[^>]*>", ""), r"(?is)</a>$", "")
    wanted = href != "" if value is None else (title == value) & (href != "")
    absolute = F.when(href.rlike("(?i)^[a-z][a-z0-9+.-]*:"), href).otherwise(F.concat("__base", href))
    return found.where(wanted).select(
        *(col(c) for c in pages.columns),
        F.when(title != "", title).otherwise(text).alias("title"),
        absolute.alias("link"),
    )
