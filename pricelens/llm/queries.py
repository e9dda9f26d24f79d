"""Check queries of the operators: whole tables, production parameters, digest columns from real outputs."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pricelens.llm.alignment import align
from pricelens.llm.bpe import decode, encode
from pricelens.llm.common import documents, fold
from pricelens.llm.jaccard import near_duplicates
from pricelens.llm.langid import identify_corpus
from pricelens.llm.lines import kept_text, with_bitmaps
from pricelens.llm.mixing import mix
from pricelens.llm.oracle import LINE_DEDUP, QUALITY, RANKED
from pricelens.llm.pitman_yor import score_texts
from pricelens.llm.quality import line_quality
from pricelens.llm.ranked import rank
from pricelens.llm.shards import kd_shards
from pricelens.llm.suffixes import without_repeats
from pricelens.llm.token_files import read_ids, write_ids
from pricelens.llm.vectors import near_vectors
from pricelens.session import configure

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        QUERIES[name] = lambda spark, folder: fn(configure(spark), folder)
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return register


@query("op6_line_dedup", LINE_DEDUP)
def line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    text = F.coalesce(F.col("text"), F.lit(""))
    return with_bitmaps(documents(spark, folder).select("doc_id", "text")).select(
        "doc_id", F.size(F.split(text, "\n", -1)).cast("long").alias("n_lines"),
        F.coalesce(F.size("__gaps"), F.lit(0)).cast("long").alias("n_dropped"),
        F.sha2(kept_text(text, F.col("__gaps")).cast("binary"), 256).alias("kept_sha256"),
    )


@query("op7_quality_rules", QUALITY)
def quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    return line_quality(documents(spark, folder)).drop("lost_share", "cleaned")


@query("op5_bpe_round_trip")
def bpe_round_trip(spark: SparkSession, folder: str) -> DataFrame:
    vocabulary = public_tokenizers.path("byte_bpe_50k.json")
    return decode(encode(documents(spark, folder), vocabulary), vocabulary).select(
        "doc_id", "n_tokens", F.sha2(F.col("ids").cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


@query("op1_kd_tree_shards")
def kd_tree_shards(spark: SparkSession, folder: str) -> DataFrame:
    return kd_shards(documents(spark, folder), shards=24).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


@query("op8_mixing")
def mixing(spark: SparkSession, folder: str) -> DataFrame:
    return mix(documents(spark, folder)).select(
        "doc_id", F.col("__source").alias("source"), F.col("__lang").alias("lang"), F.col("__topic").alias("topic"),
        F.col("__tokens").alias("n_tokens"), F.col("__probability").alias("probability"), F.col("__kept").alias("kept"),
    )


@query("op9_embedding_near_dedup")
def embedding_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return near_vectors(spark.read.parquet(f"{folder}/embeddings.parquet"))


@query("op10_jaccard_join")
def jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    return near_duplicates(documents(spark, folder), n=4, per_cent=85).select("doc_id", "n_shingles", "component_id")


@query("op3_language_id")
def language_id(spark: SparkSession, folder: str) -> DataFrame:
    docs = documents(spark, folder)
    held_out = fold(F.col("doc_id"), 5) == 0
    return identify_corpus(docs, ~held_out, {"held_out": held_out}).select("doc_id", "held_out", "lang_pred", F.round("score", 9).alias("score"), "rejected")


@query("op4_suffix_dedup")
def suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return without_repeats(documents(spark, folder)).select(
        "doc_id", "n_bytes", removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256")
    )


@query("op2_pitman_yor")
def pitman_yor(spark: SparkSession, folder: str) -> DataFrame:
    return score_texts(documents(spark, folder), fold(F.col("doc_id"), 10) == 0)


@query("op13_token_files")
def token_files(spark: SparkSession, folder: str) -> DataFrame:
    docs = documents(spark, folder)
    manifest = write_ids(docs, public_tokenizers.path("byte_bpe_50k.json"), end_id=2)
    return read_ids(spark, manifest, docs.schema["doc_id"].dataType.simpleString()).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


@query("op12_token_alignment")
def token_alignment(spark: SparkSession, folder: str) -> DataFrame:
    vocabulary, model = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
    return align(documents(spark, folder), vocabulary, model).select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"
    )


@query("op11_ranked_search", RANKED)
def ranked_search(spark: SparkSession, folder: str) -> DataFrame:
    return rank(documents(spark, folder), spark.read.parquet(f"{folder}/benchmark.parquet"))
