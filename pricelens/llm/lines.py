"""Line dedup: range-partitioned line hashes, first occurrences by document and position, keep bitmaps.

Lines are compared by 128-bit hashes of their keys. The hashes are range-partitioned together with document and
position, so a line that a third of all documents hold lies in many partitions; each partition streams through its
sorted rows and leaves one summary per line, and the summaries settle which document holds the first occurrence.

A null or empty text is one empty line. Rows with equal ``doc_id`` are one document for the counts, and each keeps
its own lines; a null ``doc_id`` is a document of its own that sorts below all others. Only ``doc_id`` and ``text``
are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pricelens.llm.common import SPACES, ascii_lower, laid_out, let, text_print


def line_key(line: Column) -> Column:
    return ascii_lower(F.btrim(line, F.lit(SPACES)))


def keep_bitmaps(docs: DataFrame, min_chars: int = 20, min_docs: int = 3) -> DataFrame:
    """``doc_id, print, gaps``: the gap-coded bitmap of each row that loses lines; rows without an entry keep all.

    ``gaps[k]`` is the number of kept lines before the k-th dropped one, so runs cost one number a dropped line.
    A key of at least ``min_chars`` code points in at least ``min_docs`` documents survives in the greatest
    ``doc_id`` only.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    lines = docs.select("doc_id", text_print(F.col("text")).alias("print"), F.posexplode(F.transform(F.split(text, "\n", -1), line_key)).alias("pos", "key"))
    marks = lines.where(F.char_length("key") >= min_chars).select(
        F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(1), "key").alias("h2"), "doc_id", "print", "pos"
    )
    order = [F.col("h1"), F.col("h2"), F.col("doc_id").desc_nulls_last(), F.col("print.a"), F.col("print.b"), F.col("pos")]
    laid = laid_out(marks, order, "line-marks")
    stream = Window.partitionBy("__part", "h1", "h2").orderBy(*order[2:])
    first_here = F.row_number().over(stream) == 1
    new_doc = first_here | ~F.lag("doc_id").over(stream).eqNullSafe(F.col("doc_id"))
    parts = (
        laid.withColumn("first", first_here).withColumn("new", new_doc).groupBy("h1", "h2", "__part")
        .agg(
            F.sum(F.col("new").cast("long")).alias("n"), F.max(F.struct(F.col("doc_id").isNotNull().alias("some"), "doc_id")).alias("top"),
            F.min(F.struct(F.col("doc_id").isNotNull().alias("some"), "doc_id")).alias("low"),
        )
    )
    over_parts = Window.partitionBy("h1", "h2").orderBy("__part")
    split_doc = F.coalesce((F.lag("low").over(over_parts) == F.col("top")).cast("long"), F.lit(0))
    whole = Window.partitionBy("h1", "h2")
    repeated = (
        parts.withColumn("n", F.col("n") - split_doc)
        .select("h1", "h2", "__part", F.sum("n").over(whole).alias("n"), F.max("top").over(whole).alias("keeper"))
        .where(F.col("n") >= min_docs).select("h1", "h2", "__part", F.col("keeper.doc_id").alias("keeper"))
    )
    dropped = laid.join(repeated, ["h1", "h2", "__part"]).where(~F.col("doc_id").eqNullSafe(F.col("keeper")))
    return dropped.groupBy("doc_id", "print").agg(F.array_sort(F.collect_set("pos")).alias("at")).select(
        "doc_id", "print", F.transform("at", lambda p, i: p - F.when(i == 0, -1).otherwise(F.get(F.col("at"), i - 1)) - 1).alias("gaps")
    )


def kept_text(text: Column, gaps: Column) -> Column:
    """The lines that a bitmap keeps, joined by line feeds; null bitmap: the text as it is."""
    def pick(lines: Column) -> Column:
        mask = F.flatten(F.transform(gaps, lambda g: F.concat(F.array_repeat(F.lit(True), g), F.array(F.lit(False)))))
        return let(mask, lambda m: F.array_join(F.filter(lines, lambda x, i: F.coalesce(F.get(m, i), F.lit(True))), "\n"))

    return F.when(gaps.isNull(), text).otherwise(let(F.split(text, "\n", -1), pick))


def with_bitmaps(docs: DataFrame, min_chars: int = 20, min_docs: int = 3) -> DataFrame:
    """All rows and columns of ``docs``, with the bitmap in ``__gaps`` (null where nothing is dropped)."""
    maps = keep_bitmaps(docs, min_chars, min_docs).select(F.col("doc_id").alias("__id"), F.col("print").alias("__print"), F.col("gaps").alias("__gaps"))
    same = docs["doc_id"].eqNullSafe(maps["__id"]) & (text_print(docs["text"])["a"] == maps["__print.a"]) & (text_print(docs["text"])["b"] == maps["__print.b"])
    return docs.join(maps, same, "left").drop("__id", "__print")
