"""Sharding by a k-d tree over document metadata.

Each level splits every node along its widest dimension at the weighted median (or at the share that the leaf counts
ask for). Medians come from histograms that Spark sums per node and refines inside the bin of the median, so rows
never move; where many rows share the median value the split goes on inside that value by a hash of the row, then by
row number. What reaches the driver is bounded by nodes times bins.

Null texts weigh only the 8 bytes of a row; null metadata count as one value below all others. Equal rows may lie in
different shards, since a hot group of copies could not be balanced otherwise. Other columns are not read.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pricelens.llm.common import slots
from pricelens.session import materialise

ROW_BYTES = 8
BINS = 256
#: A median is good enough when the bin around it weighs at most this share of the node.
TOLERANCE = 1e-5


def metadata(docs: DataFrame) -> dict[str, Column]:
    """The dimensions that the columns of ``docs`` allow, each as a double.

    The length of a text is none of them: leaves of long texts only could not be balanced.
    """
    hashed = lambda c: F.coalesce(F.crc32(F.col(c).cast("string").cast("binary")), F.lit(-1)).cast("double")
    dims = {c: hashed(c) for c in ("source", "lang") if c in docs.columns}
    return dims | {"doc_id": F.coalesce(F.col("doc_id").cast("double"), F.lit(-1.0))}


def _halves(meta: DataFrame, nodes: dict[int, int], dims: list[str], spans: dict[str, float]) -> dict[int, tuple]:
    """For each splittable node the cut: ``(dimension, value, tie, row)``; rows up to it go left."""
    spark = meta.sparkSession
    stats = meta.groupBy("__node").agg(F.sum("size").alias("w"), *(F.min(d).alias(f"lo_{d}") for d in dims), *(F.max(d).alias(f"hi_{d}") for d in dims))
    state = {}
    for r in stats.where(F.col("__node").isin(list(nodes))).collect():
        widest = max(dims, key=lambda d: (r[f"hi_{d}"] - r[f"lo_{d}"]) / spans[d])
        share = nodes[r["__node"]] // 2 / nodes[r["__node"]]
        state[r["__node"]] = {"dim": widest, "phase": 0, "lo": r[f"lo_{widest}"], "hi": r[f"hi_{widest}"], "need": r["w"] * share, "all": r["w"], "fix": [None, None]}
    open_nodes, cuts = dict(state), {}
    while open_nodes:
        rows = [(n, s["dim"], s["phase"], float(s["lo"]), float(s["hi"]), s["fix"][0], s["fix"][1]) for n, s in open_nodes.items()]
        ask = F.broadcast(spark.createDataFrame(rows, "__node int, dim string, phase int, lo double, hi double, v double, t double"))  # one row a node
        value = F.element_at(F.create_map(*(x for d in dims for x in (F.lit(d), F.col(d)))), F.col("dim"))
        joined = meta.join(ask, "__node").withColumn("__v", value)
        key = F.when(F.col("phase") == 0, F.col("__v")).when(F.col("phase") == 1, F.col("__tie")).otherwise(F.col("__row"))
        inside = ((F.col("phase") == 0) | (F.col("__v") == F.col("v"))) & ((F.col("phase") < 2) | (F.col("__tie") == F.col("t")))
        step = F.when(F.col("hi") > F.col("lo"), (F.col("hi") - F.col("lo")) / BINS).otherwise(1.0)
        bins = (
            joined.where(inside).withColumn("__k", key).where(F.col("__k").between(F.col("lo"), F.col("hi")))
            .groupBy("__node", F.least(F.floor((F.col("__k") - F.col("lo")) / step), F.lit(BINS - 1)).alias("bin"))
            .agg(F.sum("size").alias("w"), F.min("__k").alias("least"), F.max("__k").alias("most")).collect()
        )
        by_node: dict[int, list] = {n: [] for n in open_nodes}
        for b in sorted(bins, key=lambda b: b["bin"]):
            by_node[b["__node"]].append(b)
        for n, found in by_node.items():
            s, low, below = open_nodes[n], 0, None
            for b in found:
                if low + b["w"] >= s["need"] or b is found[-1]:
                    break
                low, below = low + b["w"], b["most"]
            single = b["least"] == b["most"]
            if b["w"] <= TOLERANCE * s["all"] or (single and s["phase"] == 2):
                nearer_below = below is not None and s["need"] - low < low + b["w"] - s["need"]
                edge = below if nearer_below else b["most"]
                fix = [*s["fix"][: s["phase"]], edge, math.inf, math.inf][:3]
                cuts[n] = (s["dim"], *fix)
                del open_nodes[n]
            elif single:
                s["fix"][s["phase"]] = b["least"]
                s |= {"phase": s["phase"] + 1, "need": s["need"] - low, "lo": -(2.0**63) if s["phase"] == 0 else 0.0, "hi": 2.0**63}
            else:
                s |= {"lo": b["least"], "hi": b["most"], "need": s["need"] - low}
    return cuts


def kd_shards(docs: DataFrame, shards: int | None = None, target_bytes: int | None = None) -> DataFrame:
    """``doc_id, size, text_crc32, shard, slot`` for every row; leaves are numbered from the left.

    Give the number of leaves, or the bytes that a leaf should hold at most on average.
    """
    dims = metadata(docs)
    meta = materialise(docs.select(
        "doc_id", (F.coalesce(F.octet_length("text"), F.lit(0)) + ROW_BYTES).cast("long").alias("size"),
        F.crc32(F.coalesce(F.col("text"), F.lit("")).cast("binary")).alias("text_crc32"),
        *(c.alias(f"__{d}") for d, c in dims.items()),
        F.xxhash64("doc_id", "text").cast("double").alias("__tie"), F.monotonically_increasing_id().cast("double").alias("__row"),
    ), "shard-rows")
    names = [f"__{d}" for d in dims]
    whole = meta.agg(F.sum("size").alias("w"), *(F.min(d).alias(f"lo_{d}") for d in names), *(F.max(d).alias(f"hi_{d}") for d in names)).first()
    leaves = shards or max(1, math.ceil((whole["w"] or 0) / target_bytes))
    placed, nodes = meta.withColumn("__node", F.lit(0)), {0: leaves}
    spans = {d: (whole[f"hi_{d}"] or 0) - (whole[f"lo_{d}"] or 0) or 1.0 for d in names}
    while any(k > 1 for k in nodes.values()):  # nodes: first leaf -> number of leaves
        cuts = _halves(placed, {n: k for n, k in nodes.items() if k > 1}, names, spans)
        rows = [(n, nodes[n] // 2, *cut) for n, cut in cuts.items()]
        table = F.broadcast(meta.sparkSession.createDataFrame(rows, "__node int, __left int, __dim string, __cv double, __ct double, __cr double"))
        value = F.element_at(F.create_map(*(x for d in names for x in (F.lit(d), F.col(d)))), F.col("__dim"))
        right = (value > F.col("__cv")) | ((value == F.col("__cv")) & ((F.col("__tie") > F.col("__ct")) | ((F.col("__tie") == F.col("__ct")) & (F.col("__row") > F.col("__cr")))))
        placed = placed.join(table, "__node", "left").withColumn("__node", F.col("__node") + F.when(right, F.col("__left")).otherwise(0)).select(meta.columns + ["__node"])
        nodes = {m: c for n, k in nodes.items() for m, c in ([(n, k // 2), (n + k // 2, k - k // 2)] if k > 1 else [(n, k)])}
    rows = placed.select("doc_id", "size", "text_crc32", F.col("__node").alias("shard"), "__row")
    return slots(rows, "shard", [F.col("doc_id"), F.col("text_crc32"), F.col("__row")], "slot").drop("__row")
