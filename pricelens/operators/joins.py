"""Joins that treat missing keys and missing values in a defined way."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pricelens.functions.nulls import blank_to_null, col, is_missing, missing
from pricelens.settings import Names, as_names

SPREAD = 4096
#: Rows of a key that one task takes, and the share of all rows that a hot key has at least: one in so many. So there
#: are fewer hot keys than that, whatever the table, and their list can be broadcast.
TASK_ROWS, HOT_PARTS = 1_000_000, 100_000
#: Keys are first counted by hash bucket; one by one only in the buckets that hold enough rows for a hot key.
KEY_BUCKETS = 65_536


def _row_hash(df: DataFrame) -> Column:
    return F.xxhash64(*(col(f.name) for f in df.schema.fields if not isinstance(f.dataType, T.MapType)))


def salt_table(big: DataFrame, on: Names, task_rows: int = TASK_ROWS, buckets: int = KEY_BUCKETS) -> DataFrame:
    """The hot keys of ``big`` and the tasks their rows need: ``on, __salts``. Keys with a null match nothing and are left out.

    A hot key's bucket has at least its rows, so keys of the other buckets need no shuffle to be known as not hot.
    """
    names = as_names(on)
    keys = big.dropna("any", subset=names).select(*(col(n) for n in names))
    keys = keys.withColumn("__bucket", F.pmod(F.xxhash64(*(col(n) for n in names)), F.lit(buckets)))
    everything = big.agg(F.count(F.lit(1))).scalar()
    enough = F.col("__rows") > F.greatest(F.lit(task_rows), everything / HOT_PARTS)
    full = keys.groupBy("__bucket").agg(F.count(F.lit(1)).alias("__rows")).where(enough).select("__bucket")
    counts = (
        keys.join(F.broadcast(full), "__bucket", "left_semi")
        .groupBy(*(col(n) for n in names)).agg(F.count(F.lit(1)).alias("__rows"))
    )
    return counts.where(enough).select(*(col(n) for n in names), F.ceil(F.col("__rows") / task_rows).cast("int").alias("__salts"))


def skew_join(
    big: DataFrame, lookup: DataFrame, on: Names, how: str = "left", task_rows: int = TASK_ROWS
) -> DataFrame:
    """Join ``big`` to a lookup table of any size, when keys of ``big`` may be hot. ``how`` is left or inner.

    ``salt_table`` counts the rows of ``big``, with a small shuffle where no key is hot. The rows of a hot key are
    spread over as many tasks as they need, and only its lookup rows are repeated. Rows without a key can't match: an
    inner join leaves them out, a left join spreads them.
    """
    names = as_names(on)
    hot = F.broadcast(salt_table(big, names, task_rows))
    salts = F.coalesce(F.col("__salts"), F.lit(1))
    if how == "inner":
        big, loose = big.dropna("any", subset=names), F.lit(False)
    else:
        loose = reduce(or_, [col(n).isNull() for n in names])
    spread = (
        big.withColumn("__hash", _row_hash(big)).join(hot, names, "left")
        .withColumn("__salt", F.pmod(F.col("__hash"), F.when(loose, F.lit(SPREAD)).otherwise(salts)).cast("int"))
        .drop("__salts", "__hash")
    )
    repeated = lookup.join(hot, names, "left").withColumn("__salt", F.explode(F.sequence(F.lit(0), salts - 1))).drop("__salts")
    return spread.join(repeated, [*names, "__salt"], how).drop("__salt")


def _text_type(df: DataFrame, name: str) -> bool:
    return isinstance(df.schema[name].dataType, T.StringType)


def _key(df: DataFrame, name: str) -> Column:
    """A key part with empty text as null."""
    return blank_to_null(name) if _text_type(df, name) else col(name)


def left_join_present(
    left: DataFrame,
    right: DataFrame,
    left_on: Names,
    right_on: Names,
    active: Column | None = None,
    suffix: str = "___y",
) -> DataFrame:
    """Left equi-join that ignores right rows without a key.

    A composite key is missing only if all its parts are; apart from that a missing part equals a
    missing part. Right columns come out with ``suffix``. Left rows that cannot match (no key, or
    not ``active``) get a lane by row hash, so that they do not meet in the task of their key; live
    rows and all right rows have lane 0. Keys are compared in their own types.
    """
    left_names, right_names = as_names(left_on), as_names(right_on)
    # a literal 0 would be folded into a condition on the left side, and the lane would leave the join keys
    lane = F.pmod(F.xxhash64(col(right_names[0])), F.lit(1)).cast("int")
    renamed = right.where(~missing(right_names)).select(
        lane.alias("__lane"),
        *(_key(right, n).alias(f"__key{i}") for i, n in enumerate(right_names)),
        *(col(n).alias(n + suffix) for n in right.columns),
    )
    live = ~missing(left_names)
    if active is not None:
        live = live & active
    spread = F.pmod(F.xxhash64(*(col(n) for n in left.columns)), F.lit(SPREAD)).cast("int") + 1
    keyed = left.withColumns(
        {
            "__lane_l": F.when(live, F.lit(0)).otherwise(spread),
            **{f"__key_l{i}": _key(left, n) for i, n in enumerate(left_names)},
        }
    )
    if len(left_names) == 1:
        same = [F.col("__key_l0") == F.col("__key0")]
    else:
        same = [F.col(f"__key_l{i}").eqNullSafe(F.col(f"__key{i}")) for i in range(len(left_names))]
    condition = reduce(and_, [F.col("__lane_l") == F.col("__lane"), *same])
    helpers = ["__lane", "__lane_l", *(f"__key{i}" for i in range(len(left_names)))]
    helpers += [f"__key_l{i}" for i in range(len(left_names))]
    return keyed.join(renamed, condition, "left").drop(*helpers)


def mark_present(
    left: DataFrame, right: DataFrame, left_on: Names, right_on: Names, mark: str, active: Column | None = None
) -> DataFrame:
    """``mark``: true for left rows whose key the right side holds, as ``left_join_present`` compares keys; else null.
    Each left row comes out once, with empty text in its key as null."""
    left_names, right_names = as_names(left_on), as_names(right_on)
    left = left.withColumns({n: _key(left, n) for n in left_names})
    held = right.select(*(_key(right, n).alias(n) for n in right_names)).distinct().withColumn("present", F.lit(True))
    joined = left_join_present(left, held, left_names, right_names, active, suffix="__held")
    return joined.withColumn(mark, F.col("present__held")).select(*(col(n) for n in left.columns), mark)


def drop_suffixed(df: DataFrame, suffix: str = "___y") -> DataFrame:
    return df.select(*(col(n) for n in df.columns if not n.endswith(suffix)))


def fill_missing_join(
    left: DataFrame,
    right: DataFrame,
    left_on: Names,
    right_on: Names,
    left_update: Names,
    right_update: Names,
    joined_on: Names = "",
    suffix: str = "___y",
) -> DataFrame:
    """Fill the update columns of left rows that have none yet from the matching right rows.

    A row takes part if its first update column is missing. Where a right row with a value is
    found, all update columns are copied and ``Joined_on`` names the key; several right matches
    give several rows. Rows that are filled already pass unchanged, in the same single join.
    """
    targets, sources = as_names(left_update), as_names(right_update)
    if len(targets) != len(sources):
        raise ValueError("left_update and right_update differ in number")
    label = " ".join(as_names(joined_on))
    if "Joined_on" not in left.columns:
        left = left.withColumn("Joined_on", F.lit(None).cast("string"))
    left = left.withColumns({n: _key(left, n) for n in as_names(left_on)})
    needed = list(dict.fromkeys([*as_names(right_on), *sources]))
    joined = left_join_present(
        left, right.select(*(col(n) for n in needed)), left_on, right_on,
        active=is_missing(targets[0]), suffix=suffix,
    )
    hit = is_missing(targets[0]) & ~is_missing(sources[0] + suffix)
    updated = joined.withColumns(
        {
            "Joined_on": F.when(hit, F.lit(label)).otherwise(F.col("Joined_on")),
            **{t: F.when(hit, col(s + suffix)).otherwise(col(t)) for t, s in zip(targets, sources)},
        }
    )
    return drop_suffixed(updated, suffix)


def aligned_update(left: DataFrame, right: DataFrame, on: Names, columns: Names) -> DataFrame:
    """Overwrite left cells with the non-null cells of the right row with the same key."""
    names, targets = as_names(on), as_names(columns)
    renamed = right.select(*(col(n) for n in names), *(col(c).alias(f"__new_{c}") for c in targets))
    joined = left.join(renamed, names, "left")
    return joined.withColumns({c: F.coalesce(col(f"__new_{c}"), col(c)) for c in targets}).select(
        *(col(n) for n in left.columns)
    )


def row_digest(columns: Sequence[str]) -> Column:
    """A row identity made of the row's values: the same on every run, whatever the partitioning."""
    return F.sha2(F.to_json(F.struct(*(col(n) for n in columns))), 256)
