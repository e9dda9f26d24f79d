"""Price differences and the choice of the best candidate."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pricelens.functions.nulls import col
from pricelens.session import materialise
from pricelens.settings import Names, as_names


def price_difference(df: DataFrame) -> DataFrame:
    return df.withColumn("Preisdifferenz", F.col("Preis") - F.col("Preis_Konkurrenz"))


def numbered(df: DataFrame, by: Names, order: Names, name: str) -> DataFrame:
    """Row number within each group, for groups of any size.

    The rows are range-partitioned by group and order, so a large group lies in several partitions;
    a row's number is its number in the partition plus the group's rows in the partitions before.
    The partitioned table is written once, which fixes the partition of every row.
    """
    by, order = as_names(by), as_names(order)
    keys = [col(c) for c in (*by, *order)]
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    laid_out = materialise(
        df.repartitionByRange(parts, *keys).withColumn("__part", F.spark_partition_id()), "numbered"
    )
    before = Window.partitionBy(*by).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        laid_out.groupBy(*(col(c) for c in by), "__part")
        .agg(F.count(F.lit(1)).alias("__rows"))
        .withColumn("__before", F.coalesce(F.sum("__rows").over(before), F.lit(0)))
        .drop("__rows")
    )
    within = Window.partitionBy(*by, "__part").orderBy(*(col(c) for c in order))
    placed = laid_out.withColumn("__n", F.row_number().over(within))
    same = F.lit(True)
    for c in (*by, "__part"):
        same = same & placed[f"`{c}`"].eqNullSafe(offsets[f"`{c}`"])
    return placed.join(offsets, same).select(
        *(placed[f"`{c}`"] for c in df.columns), (F.col("__n") + F.col("__before")).cast("int").alias(name)
    )


def rank_candidates(df: DataFrame, by: Names = ("Konkurrenz", "UID"), tie: Names = ()) -> DataFrame:
    """Number the candidates of a group by absolute price difference; no difference, no rank."""
    gap = df.withColumn("Preisdifferenz_absolut", F.abs(F.col("Preisdifferenz")))
    known = F.col("Preisdifferenz_absolut").isNotNull()
    ranked = numbered(gap.where(known), by, ["Preisdifferenz_absolut", *as_names(tie)], "Rank")
    return ranked.unionByName(gap.where(~known), allowMissingColumns=True)


def keep_best(df: DataFrame, by: Names = ("Konkurrenz", "UID"), tie: Names = ()) -> DataFrame:
    """Only the first-ranked candidate per group.

    The rows without a difference go before the ranking, so Spark can cut each group to its first
    row before the shuffle (``WindowGroupLimit``), and a hot group stays harmless.
    """
    order = Window.partitionBy(*as_names(by)).orderBy(
        F.abs(F.col("Preisdifferenz")), *(col(t) for t in as_names(tie))
    )
    return (
        df.where(F.col("Preisdifferenz").isNotNull())
        .withColumn("Rank", F.row_number().over(order))
        .where(F.col("Rank") == 1)
    )


def last_write_wins(df: DataFrame, key: Names, position: Names) -> DataFrame:
    """One row per key: the one at the highest position."""
    order = Window.partitionBy(*as_names(key)).orderBy(*(col(p).desc() for p in as_names(position)))
    return df.withColumn("__n", F.row_number().over(order)).where(F.col("__n") == 1).drop("__n")


def average_rank(df: DataFrame, column: str, name: str) -> DataFrame:
    """Rank with ties at their mean rank. Meant for a handful of rows, such as cluster means."""
    order, ties = Window.orderBy(column), Window.partitionBy(column)
    return df.withColumn(
        name, F.rank().over(order) + (F.count(F.lit(1)).over(ties) - 1) / F.lit(2.0)
    )


def first_name_per_group(df: DataFrame, group: str, name: str) -> DataFrame:
    """The alphabetically first name of each group; groups without any name are left out."""
    return df.where(col(name).isNotNull()).groupBy(col(group)).agg(F.min(col(name)).alias(name))
