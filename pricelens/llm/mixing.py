"""Mixing sources to target weights by iterative proportional fitting.

Tokens are summed per cell (source, language, topic), so everything after that works on cells, not documents. Each
round scales the cells to the targets of one marginal after the other; documents are then drawn with probabilities
calibrated so that the expected tokens meet the budget. A draw depends on ``doc_id``, text and seed only, so it can
be repeated and rows that are equal in both are kept or left together. A null source, language or missing column is
a value of its own; null and empty texts have one token, the end of the text.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pricelens.llm.common import split_words
from pricelens.session import materialise, release_shuffles

MARGINALS = ("source", "lang", "topic")
TEMPER, BUDGET = 0.7, 0.8
#: Raking ends when every marginal is met to ``EXACT``, or when a round takes less than the share ``SLOW`` off the largest deviation.
EXACT, SLOW = 1e-6, 1e-2


def topic(text: Column) -> Column:
    """A topic from the form of the text, the same for every corpus."""
    low = F.lower(F.coalesce(text, F.lit("")))
    return (
        F.when(low.rlike("licen[sc]e|rights reserved|copyright"), "legal").when(F.contains(low, F.lit(" | ")), "table")
        .when(F.contains(low, F.lit("!!")), "shout").when(low.rlike("[#*$%&]{3}"), "markup")
        .when(F.length(low) < 1_000, "note").when(F.length(low) < 5_000, "article").otherwise("book")
    )


def tempered_targets(cells: DataFrame, marginal: str, temper: float = TEMPER) -> DataFrame:
    """``marginal, goal``: shares in proportion to tokens to the power ``temper``."""
    sums = cells.groupBy(marginal).agg(F.pow(F.sum("tokens"), F.lit(temper)).alias("g"))
    return sums.crossJoin(F.broadcast(sums.agg(F.sum("g").alias("all")))).select(marginal, (F.col("g") / F.col("all")).alias("goal"))  # one row


def goals_of(cells: DataFrame, marginal: str, goals: DataFrame) -> DataFrame:
    """``marginal, goal`` for the values that the cells have: a value without a goal has 0, and the others sum to 1."""
    known = cells.select(marginal).distinct().join(goals, marginal, "left").withColumn("goal", F.coalesce(F.col("goal").cast("double"), F.lit(0.0)))
    total = known.agg(F.sum("goal").alias("all"))  # one row
    return known.crossJoin(F.broadcast(total)).select(marginal, F.when(F.col("all") > 0, F.col("goal") / F.col("all")).otherwise(0.0).alias("goal"))


def marginal_shares(raked: DataFrame, targets: dict[str, DataFrame]) -> DataFrame:
    """``marginal, value, goal, share``: what the raked weights give to each value, beside its goal."""
    parts = []
    for m, goals in targets.items():
        shares = raked.groupBy(m).agg(F.sum("weight").alias("share")).join(goals_of(raked, m, goals), m)
        parts.append(shares.select(F.lit(m).alias("marginal"), F.col(m).alias("value"), "goal", "share"))
    return reduce(DataFrame.unionByName, parts)


def rake(cells: DataFrame, targets: dict[str, DataFrame]) -> DataFrame:
    """``cells`` with ``weight``: shares that meet the goals of every marginal.

    Goals that can't be met together (a source with one language only) are approached until a round brings next to
    nothing; ``marginal_shares`` shows what is left. Cells of a value without a goal have weight 0.
    """
    cells = cells.withColumn("weight", F.col("tokens").cast("double"))
    for m, goals in targets.items():
        cells = cells.join(materialise(goals_of(cells, m, goals).withColumnRenamed("goal", f"goal_{m}"), "goals"), m)
    cells, before = materialise(cells, "cells-with-goals"), math.inf
    while True:
        for m in targets:
            total = F.sum("weight")
            sums = cells.groupBy(m).agg(F.when(total > 0, F.first(f"goal_{m}") / total).otherwise(0.0).alias("__factor"))
            cells = cells.join(sums, m).withColumn("weight", F.col("weight") * F.col("__factor")).drop("__factor")
        cells = materialise(cells, "raked")
        # the largest deviation of all marginals in one pass over the cells
        listed = cells.select(F.explode(F.array(*(F.struct(F.lit(m).alias("m"), F.col(m).alias("v"), F.col(f"goal_{m}").alias("goal"), "weight") for m in targets))).alias("x")).select("x.*")
        goal = F.first("goal")
        sums = listed.groupBy("m", "v").agg(F.when(goal > 0, F.abs(F.sum("weight") / goal - 1)).alias("off"))
        off = sums.agg(F.max("off")).first()[0] or 0.0
        if off < EXACT or off > before * (1 - SLOW):
            break
        before = off
    release_shuffles(cells.sparkSession)
    return cells.drop(*(f"goal_{m}" for m in targets))


def calibrated(cells: DataFrame, budget: float) -> DataFrame:
    """``probability`` per cell, in proportion to ``weight / tokens``, at most 1, so that ``budget`` of all tokens is expected."""
    total = cells.agg(F.sum("tokens")).first()[0]
    scale, fill = 0.0, budget * (total or 0)
    while total:  # a cell that reaches probability 1 leaves its share to the others
        full = F.lit(scale) * F.col("weight") >= F.col("tokens")
        taken, rest = cells.agg(
            F.coalesce(F.sum(F.when(full, F.col("tokens"))), F.lit(0)), F.coalesce(F.sum(F.when(~full, F.col("weight"))), F.lit(0.0))
        ).first()
        new = (fill - taken) / rest if rest else scale
        if new <= scale * (1 + 1e-12):
            break
        scale = new
    return cells.withColumn("probability", F.round(F.least(F.lit(1.0), F.lit(scale) * F.col("weight") / F.col("tokens")), 9))


def mix(docs: DataFrame, targets: dict[str, DataFrame] | None = None, budget: float = BUDGET, seed: int = 11) -> DataFrame:
    """The columns of ``docs`` with ``__source, __lang, __topic, __tokens, __probability, __kept``.

    ``targets``: for each marginal a table of its values (written ``=value``, or ``null``) and goals; goals count relative to
    those of the values there are, and documents of a value without a goal have probability 0. Without it the tempered
    shares of ``docs`` itself.
    """
    value = lambda c: F.coalesce(F.concat(F.lit("="), F.col(c).cast("string")), F.lit("null")) if c in docs.columns else F.lit("null")
    u = F.pmod(F.xxhash64(F.lit(seed), "doc_id", "text"), F.lit(1 << 53)) / F.lit(float(1 << 53))
    keyed = docs.withColumns({
        "__source": value("source"), "__lang": value("lang"), "__topic": topic(F.col("text")),
        "__tokens": (F.size(split_words(F.col("text"))) + 1).cast("long"), "__u": u,
    })
    named = [F.col(f"__{m}").alias(m) for m in MARGINALS]
    cells = materialise(keyed.groupBy(*named).agg(F.sum("__tokens").alias("tokens")), "cells")
    targets = targets or {m: tempered_targets(cells, m) for m in MARGINALS}
    drawn = materialise(calibrated(rake(cells, targets), budget), "drawn").select(*(F.col(m).alias(f"__{m}") for m in MARGINALS), F.col("probability").alias("__probability"))
    placed = keyed.join(drawn, [f"__{m}" for m in MARGINALS], "left").withColumn("__kept", F.coalesce(F.col("__u") < F.col("__probability"), F.lit(False)))
    return placed.select(*(f"`{c}`" for c in docs.columns), *(f"__{m}" for m in MARGINALS), "__tokens", "__probability", "__kept")
