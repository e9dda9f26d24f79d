"""Missing values: one spelling (NULL), predicates on it and conditional removal."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pricelens.settings import Names, as_names

# Texts that stand for a missing value in the input files.
NULL_SPELLINGS = ("", "None", "[None]", "\x1a")


def col(c: str | Column) -> Column:
    return F.col(f"`{c}`") if isinstance(c, str) else c


def is_missing(c: str | Column) -> Column:
    """Null or empty text."""
    return col(c).isNull() | (col(c).cast("string") == "")


def missing(columns: Names | Column, how: str = "all") -> Column:
    """Whether all (or any) of the columns are null or empty."""
    parts = [columns] if isinstance(columns, Column) else as_names(columns)
    folds = {"all": and_, "any": or_}
    return reduce(folds[how.lower()], (is_missing(c) for c in parts))


def blank_to_null(c: str | Column) -> Column:
    return F.when(col(c) != "", col(c))


def null_to_blank(c: str | Column) -> Column:
    return F.coalesce(col(c), F.lit(""))


def normalise_nulls(
    df: DataFrame, columns: Names | None = None, spellings: Iterable[str] = NULL_SPELLINGS
) -> DataFrame:
    """Replace every spelling of a missing value in the string columns by NULL."""
    names = (
        as_names(columns)
        if columns is not None
        else [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    )
    texts = list(spellings)
    return df.withColumns({n: F.when(~col(n).isin(texts), col(n)) for n in names})


def as_number(c: str | Column) -> Column:
    """Number from text; text that is no number gives NULL."""
    return col(c).try_cast("double")


def null_if_far(x: str | Column, y: str | Column, threshold: float) -> Column:
    """``x``, or NULL where it is more than ``threshold`` away from ``y``."""
    return F.when(F.abs(col(x) - col(y)) > threshold, None).otherwise(col(x))


def exceeds_share(difference: str | Column, base: str | Column, threshold: float) -> Column:
    """Whether ``|difference / base|`` exceeds the threshold. A zero base is exceeded by any
    difference but zero; a missing value never exceeds."""
    share = F.abs(F.try_divide(col(difference), col(base)))
    return F.coalesce(
        F.when(col(base) == 0, col(difference) != 0).otherwise(share > threshold), F.lit(False)
    )


def null_where_far(
    df: DataFrame,
    columns: Names,
    threshold: float = 0.5,
    difference: str = "Preisdifferenz",
    base: str = "Preis",
) -> DataFrame:
    """Null the given columns in rows whose price difference exceeds the share of the price."""
    far = exceeds_share(difference, base, threshold)
    return df.withColumns({n: F.when(~far, col(n)) for n in as_names(columns)})
