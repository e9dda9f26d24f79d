"""Catalogue XML: articles and the category register, read record by record.

A file is scanned as text whose lines end with the closing tag of a record, so a large file is many tasks. A record is
parsed once into its elements in document order, each with the position of its last descendant; what lies at any depth
below an element is then a filter over positions, and the rules of the catalogue are column expressions.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from xml.etree import ElementTree

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# the functions that run in the tasks travel with their job, so the executors need no copy of the package
cloudpickle.register_pickle_by_value(sys.modules[__name__])

ARTICLE, REGISTER = "Artikel", "Register_Element_1"
#: Levels of a category table unless it is asked for more.
REGISTER_DEPTH = 10
TEXTS = "array<string>"
ELEMENTS = "array<struct<pos: int, last: int, name: string, text: string, attributes: map<string, string>>>"
LISTINGS = "array<struct<kind: int, pos: int, path: array<string>, article: string>>"
#: Kinds of listings: ``Element0_Nr`` to ``Element9_Nr``.
LISTING = {f"Element{n}_Nr": n for n in range(10)}


def read_records(spark: SparkSession, paths: str | list[str], tag: str, encoding: str = "utf-8") -> DataFrame:
    """``file, block, position, xml``: one row per element ``tag`` that has a closing tag (``<tag/>`` is empty and left out).

    ``block`` and ``position`` order the records of a file: the place where the split begins, and the place in the scan.
    Records of one name must not contain each other.
    """
    lines = spark.read.option("lineSep", f"</{tag}>").text(paths).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("position"), F.decode(F.col("value").cast("binary"), encoding).alias("value"),
    )
    start = F.regexp_extract("value", f"(?s)^.*(<{tag}(?=[\\s>])(?![^>]*/>).*)$", 1)
    return lines.withColumn("xml", F.when(start != "", F.concat(start, F.lit(f"</{tag}>")))).where("xml IS NOT NULL").drop("value")


def elements_of(xml: str) -> list[dict] | None:
    """The elements of a record in document order, the record itself first; None if it is not well-formed."""
    try:
        found = list(ElementTree.fromstring(xml).iter())
    except ElementTree.ParseError:
        return None
    number = {element: i for i, element in enumerate(found)}
    last = list(range(len(found)))
    for i in reversed(range(len(found))):
        for child in found[i]:
            last[i] = max(last[i], last[number[child]])
    return [
        {"pos": i, "last": last[i], "name": e.tag, "text": e.text, "attributes": list(e.attrib.items())} for i, e in enumerate(found)
    ]


def listings_of(xml: str) -> list[dict] | None:
    """The articles that a register element lists, with the texts of the elements above; None if it is not well-formed."""
    out: list[dict] = []
    try:
        todo = [(ElementTree.fromstring(xml), [])]
    except ElementTree.ParseError:
        return None
    pos = 0
    while todo:  # in document order, at any depth
        element, above = todo.pop()
        if element.tag in LISTING and element.text is not None:
            out.append({"kind": LISTING[element.tag], "pos": pos, "path": above, "article": element.text})
        here = [*above, element.attrib["Txt"]] if "Txt" in element.attrib else above
        todo.extend((child, here) for child in reversed(element))
        pos += 1
    return out


def _parsed(records: DataFrame, parse, name: str, kind: str, arrow: pa.DataType) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = pa.array([parse(xml) for xml in batch.column("xml").to_pylist()], arrow)
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("file", "block", "position")), values], names=["file", "block", "position", name])

    return records.mapInArrow(run, f"file string, block bigint, position bigint, {name} {kind}")


_ELEMENTS = pa.list_(pa.struct([("pos", pa.int32()), ("last", pa.int32()), ("name", pa.string()), ("text", pa.string()), ("attributes", pa.map_(pa.string(), pa.string()))]))
_LISTINGS = pa.list_(pa.struct([("kind", pa.int32()), ("pos", pa.int32()), ("path", pa.list_(pa.string())), ("article", pa.string())]))


def read_articles(spark: SparkSession, paths: str | list[str], encoding: str = "utf-8") -> DataFrame:
    """``file, block, position, elements``: one row per article; ``elements`` is null if the article is not well-formed."""
    return _parsed(read_records(spark, paths, ARTICLE, encoding), elements_of, "elements", ELEMENTS, _ELEMENTS)


def read_register(spark: SparkSession, paths: str | list[str], encoding: str = "utf-8") -> DataFrame:
    """``file, block, position, listings``: one row per top register element, with its listings at any depth."""
    return _parsed(read_records(spark, paths, REGISTER, encoding), listings_of, "listings", LISTINGS, _LISTINGS)


def broken_records(records: DataFrame) -> DataFrame:
    """Records of ``read_articles`` or ``read_register`` that are not well-formed XML; they give no rows."""
    return records.where(F.col(records.columns[-1]).isNull()).select("file", "block", "position")


def below(name: str, element: Column | None = None) -> Column:
    """The elements called ``name`` at any depth below an element, by default below the record."""
    def wanted(e: Column) -> Column:
        inside = e["pos"] > 0 if element is None else (e["pos"] > element["pos"]) & (e["pos"] <= element["last"])
        return (e["name"] == name) & inside

    return F.filter("elements", wanted)


def joined(texts: Column) -> Column:
    """Repeated texts as one text; null if there is none."""
    present = F.filter(texts, lambda x: x.isNotNull())
    return F.when(F.size(present) > 0, F.array_join(present, " "))


def texts_below(name: str, element: Column | None = None) -> Column:
    """The texts of the elements called ``name`` at any depth, as one text."""
    return joined(F.transform(below(name, element), lambda e: e["text"]))


def attribute_below(name: str, attribute: str) -> Column:
    """An attribute of the elements called ``name``, as one text; null if one of them lacks it."""
    values = F.transform(below(name), lambda e: e["attributes"][attribute])
    return F.when(F.forall(values, lambda x: x.isNotNull()), joined(values))


def record_attribute(attribute: str) -> Column:
    return F.get("elements", F.lit(0))["attributes"][attribute]
