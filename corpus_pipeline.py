"""The corpus pipeline: quality rules, line dedup, near-duplicate join, mixing, BPE encoding.

Every stage takes ``(spark, docs, sf_dir)`` and works on all rows its predecessor kept; the result is written as Parquet
and read again for the next one. All stages but the last return the columns of ``documents``; where a stage changes
``text`` it sets ``n_chars`` anew. Null texts fail the quality rules and go there.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pricelens.llm.bpe import decode, encode
from pricelens.llm.common import documents, text_print
from pricelens.llm.jaccard import near_duplicates
from pricelens.llm.lines import kept_text, with_bitmaps
from pricelens.llm.mixing import mix
from pricelens.llm.quality import line_quality
from pricelens.session import configure, materialise


def _with_text(docs: DataFrame, text) -> DataFrame:
    changed = docs.withColumn("text", text)
    if "n_chars" in docs.columns:
        changed = changed.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))
    return changed


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass, without their failing lines."""
    judged = line_quality(docs, keep_columns=True).where("__kept")
    return _with_text(judged, F.col("__cleaned")).select(docs.columns)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the lines that a later document holds too."""
    mapped = with_bitmaps(docs)
    return _with_text(mapped, kept_text(F.col("text"), F.col("__gaps"))).select(docs.columns)


def near_duplicate_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, the one with the smallest id; texts without words all stay."""
    rows = near_duplicates(docs, n=5, per_cent=80).where("keeper").select(
        F.col("doc_id").alias("__id"), F.col("pa").alias("__pa"), F.col("pb").alias("__pb"), (F.col("n_shingles") > 0).alias("__words")
    ).distinct()
    mark = text_print(docs["text"])
    same = docs["doc_id"].eqNullSafe(rows["__id"]) & (mark["a"] == rows["__pa"]) & (mark["b"] == rows["__pb"])
    kept = docs.join(rows, same)
    once = kept.where("__words").dropDuplicates(["__id", "__pa", "__pb"])
    return once.unionByName(kept.where("NOT __words")).select(docs.columns)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A sample whose expected tokens follow the raked targets of sources, languages and topics."""
    return mix(docs).where("__kept").select(docs.columns)


def bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id, n_tokens, ids, decoded``: token ids as decimals joined by commas, and the text they decode to."""
    vocabulary = public_tokenizers.path("byte_bpe_50k.json")
    return decode(encode(docs, vocabulary), vocabulary)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", quality), ("line_dedup", line_dedup), ("jaccard_join", near_duplicate_join), ("mixing", mixing), ("bpe", bpe),
]
#: The raking loop and byte-pair merges have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(configure(spark), sf_dir)
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
