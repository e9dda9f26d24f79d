"""Text, identifier and label expressions. Everything here is a built-in Spark expression."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from pricelens.functions.nulls import col, null_to_blank

# How DOS code page 850 bytes read as ISO-8859-1, and the letters they stand for.
DOS_BYTES = "\u0081\u0094\u0084"
DOS_LETTERS = "üöä"

# Answers that mean yes.
YES_ANSWERS = ("yes", "ja", "y", "j", "true")

# A word is a run of two or more letters, digits or underscores.
WORD_PATTERN = r"[\p{L}\p{N}_]{2,}"


def unique_id(head: str | Column, *tail: str | Column) -> Column:
    """Head followed by the tail parts; the head alone if a part is null; empty for no head."""
    whole = F.concat(col(head), *(col(t) for t in tail))
    return F.when(null_to_blank(head) == "", F.lit("")).otherwise(F.coalesce(whole, col(head)))


def join_list(c: str | Column, sep: str = " ") -> Column:
    """A list of texts as one text."""
    return F.array_join(col(c), sep)


def join_texts(*columns: str | Column, sep: str = " ") -> Column:
    """Texts joined in order; a missing text counts as empty and keeps its separator."""
    return F.concat_ws(sep, *(null_to_blank(c) for c in columns))


def null_if_shorter(c: str | Column, length: int = 5) -> Column:
    return F.when(F.length(col(c)) >= length, col(c))


def clean_number(c: str | Column, digits: int = 6) -> Column:
    """The first digits of a number written with separators or letters; empty for null."""
    return F.substring(F.regexp_replace(null_to_blank(c), "[^0-9]", ""), 1, digits)


def clean_text(c: str | Column) -> Column:
    """One-line text without carriage returns and double quotes, trimmed."""
    one_line = F.regexp_replace(F.regexp_replace(col(c), '[\r"]', ""), "\n", " ")
    return F.regexp_replace(one_line, r"^\s+|\s+$", "")


def one_line(c: str | Column) -> Column:
    """A line break as a blank. The CSV reader delivers CR LF inside a field as LF, so both count."""
    return F.regexp_replace(col(c), "\r?\n", " ")


def repair_dos_text(c: str | Column) -> Column:
    """Umlauts of a DOS text that was read as ISO-8859-1, and blanks around the ampersand."""
    return F.regexp_replace(F.translate(col(c), DOS_BYTES, DOS_LETTERS), "&", " & ")


def mentions(c: str | Column, word: str) -> Column:
    """Whether the text contains the word, whatever its case and blanks."""
    return F.contains(F.regexp_replace(F.lower(col(c)), " ", ""), F.lit(word))


def lacks(c: str | Column, word: str) -> Column:
    """Whether the text does not contain the word, whatever its case."""
    return ~F.contains(F.lower(col(c)), F.lit(word.lower()))


def words(c: str | Column) -> Column:
    """Lower-cased words in text order."""
    return F.regexp_extract_all(F.lower(col(c)), F.lit(f"({WORD_PATTERN})"), 1)


def server_text(c: str | Column) -> Column:
    """A text as the database server compares it: case, accents and trailing blanks do not count."""
    return F.collate(col(c), "UNICODE_CI_AI_RTRIM")


def has_server_text(c: str | Column) -> Column:
    """The server's ``> ''``: a text of blanks only is as empty as the empty one."""
    return F.rtrim(col(c)) > ""


def is_yes(c: str | Column) -> Column:
    """Yes/no text as boolean; anything that does not mean yes is false."""
    return F.coalesce(F.lower(col(c)).isin(list(YES_ANSWERS)), F.lit(False))


def snapshot_label(date: str | Column) -> Column:
    return F.concat(F.lit("Snapshotdate ("), F.date_format(col(date), "yyyy-MM-dd"), F.lit(")"))


def file_stem(path: str | Column) -> Column:
    """File name without folder and without a ``.xml`` or ``.csv`` ending."""
    name = F.element_at(F.split(col(path), "/"), -1)
    return F.regexp_replace(F.url_decode(F.replace(name, F.lit("+"), F.lit("%2B"))), r"\.(xml|XML|csv)$", "")


def base_name(path: str | Column, sep: str = "-") -> Column:
    """The first two parts of the file name; the whole name if it has one part."""
    stem = file_stem(path)
    parts = F.split(stem, "-")
    return F.when(F.size(parts) > 1, F.concat(parts[0], F.lit(sep), parts[1])).otherwise(stem)


def company_of(path: str | Column) -> Column:
    """The competitor's name: the file name up to the first dash."""
    return F.split(file_stem(path), "-")[0]


def compact(path: str | Column) -> Column:
    """A list without its missing entries."""
    return F.filter(col(path), lambda x: x.isNotNull() & (x != ""))


def path_level(path: str | Column, level: int) -> Column:
    """Entry ``level`` (from 1) of a compact path; behind its end the last entry is repeated."""
    size = F.size(col(path))
    return F.when(size > 0, F.element_at(col(path), F.least(F.lit(level), size)))


def cluster_label(first: Column, first_name: str, second: Column, second_name: str) -> Column:
    return F.format_string(f"%s {first_name}, %s {second_name}", first, second)


def log1p_or_null(c: str | Column) -> Column:
    """``ln(x + 1)``; NULL for x of -1 or less."""
    return F.when(col(c) > -1, F.log1p(col(c)))
