"""Line-first cleaning: rules per line, failing lines go, documents that lose too much are rejected.

Null and empty texts have no words and are rejected by the base rule. Rows are judged one by one, so repeated
rows get equal verdicts, and columns other than ``doc_id`` and ``text`` are never looked at.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pricelens.llm.common import SPACES, let, split_words

ENDINGS = "[.!?:;…\"'”»)\\]]$"
TWO_SEPARATORS = "(?s)[|»›•·].*[|»›•·]"
SYMBOLS = "[^#*$%&|<>]+"
PHRASES = (
    "all rights reserved", "copyright", "licensed under", "licenced under", "released under the", "public license",
    "cookie", "privacy policy", "terms of use", "terms of service", "enable javascript", "subscribe", "sign in",
    "sign up", "login", "log in", "click here", "lorem ipsum", "{", "}",
)
MAX_LOSS = 0.3


def line_fails(line: Column) -> Column:
    """Whether a line that has a word breaks a rule: ending, navigation, boilerplate, shouting or symbols.

    A line shouts if it has as many characters in ``!!`` and ``??`` as words, or more.
    """
    def judge(core: Column, n_words: Column) -> Column:
        without = lambda mark: F.length(core) - F.length(F.replace(core, F.lit(mark), F.lit("")))
        punctuation = ~core.rlike(ENDINGS) | (without("!!") + without("??") >= n_words)
        boilerplate = let(F.lower(core), lambda low: reduce(or_, (F.contains(low, F.lit(p)) for p in PHRASES)))
        symbols = F.length(F.regexp_replace(core, SYMBOLS, "")) > n_words
        return (core != "") & (punctuation | core.rlike(TWO_SEPARATORS) | boilerplate | symbols)

    blanks = lambda core: F.length(F.regexp_replace(core, "[^\\x20\\x09-\\x0D]+", ""))
    return let(F.btrim(line, F.lit(SPACES)), lambda core: let(blanks(core) + 1, lambda n: judge(core, n)))


def _repeat_words(words: Column) -> Column:
    """Words inside a 3-word window that the text holds at least twice (windows compared by 64-bit hash)."""
    def positions(hashes: Column) -> Column:
        ranked = F.array_sort(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        return let(ranked, lambda s: F.size(F.array_distinct(F.flatten(F.transform(
            F.filter(s, lambda x, j: F.coalesce(x["h"] == F.get(s, j - 1)["h"], F.lit(False)) | F.coalesce(x["h"] == F.get(s, j + 1)["h"], F.lit(False))),
            lambda x: F.array(x["i"], x["i"] + 1, x["i"] + 2),
        )))))

    def windows(w: Column) -> Column:
        hashes = F.transform(F.sequence(F.lit(0), F.size(w) - 3), lambda i: F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)))
        return let(hashes, lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), 0).otherwise(positions(h)))

    return F.when(F.size(words) < 3, 0).otherwise(windows(words))


def line_quality(docs: DataFrame, max_loss: float = MAX_LOSS, keep_columns: bool = False) -> DataFrame:
    """Counts, verdict and cleaned text per row.

    Returns ``doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, lost_share, kept,
    cleaned``; with ``keep_columns`` the columns of ``docs`` and only ``__kept, __cleaned``. ``lost_share`` is the
    share of characters (line ends trimmed) that lies in failing lines; blank lines pass and count nothing.
    """
    text = F.coalesce(F.col("text"), F.lit(""))

    def counts(w: Column) -> Column:
        return F.struct(
            F.size(w).cast("long").alias("n_words"),
            F.length(F.array_join(w, "")).cast("long").alias("word_chars"),
            _repeat_words(w).cast("long").alias("n_repeat_words"),
        )

    def lines(all_lines: Column) -> Column:
        filled = F.filter(all_lines, lambda x: F.btrim(x, F.lit(SPACES)) != "")
        chars = lambda a: F.aggregate(a, F.lit(0), lambda n, x: n + F.length(F.btrim(x, F.lit(SPACES))))
        passed = let(F.filter(all_lines, lambda x: ~line_fails(x)), lambda p: F.struct(chars(p).alias("chars"), F.array_join(p, "\n").alias("text")))
        return F.struct(
            let(filled, lambda f: F.size(f) - F.size(F.array_distinct(f))).cast("long").alias("n_dup_lines"),
            chars(all_lines).alias("chars"), passed.alias("passed"),
        )

    judged = docs.select(
        *([F.struct(*(docs[f"`{c}`"] for c in docs.columns)).alias("__row")] if keep_columns else ["doc_id"]),
        let(split_words(text), counts).alias("w"), let(F.split(text, "\n", -1), lines).alias("l"),
        F.length(F.regexp_replace(text, SYMBOLS, "")).cast("long").alias("n_symbols"),
    )
    base_failed = (F.col("w.n_words") < 50) | (100 * F.col("w.n_repeat_words") > 50 * F.col("w.n_words"))
    lost = F.when(F.col("l.chars") == 0, 0.0).otherwise(1 - F.col("l.passed.chars") / F.col("l.chars"))
    kept = ~base_failed & (F.col("l.passed.chars") >= (1 - max_loss) * F.col("l.chars"))
    if keep_columns:
        return judged.select("__row", kept.alias("__kept"), F.col("l.passed.text").alias("__cleaned")).select("__row.*", "__kept", "__cleaned")
    return judged.select(
        "doc_id", "w.n_words", "w.word_chars", "n_symbols", "l.n_dup_lines", "w.n_repeat_words",
        base_failed.alias("base_failed"), lost.alias("lost_share"), kept.alias("kept"), F.col("l.passed.text").alias("cleaned"),
    )
