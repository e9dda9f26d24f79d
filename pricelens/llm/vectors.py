"""Embedding near-dedup by an epsilon grid order join.

Vectors are scaled to length 1, so a cosine of at least ``c`` is a distance of at most ``eps = sqrt(2 - 2 c)``. They are
turned to principal axes, sorted by their grid cells (side ``eps``) on the leading axes, and cut into sequence
intervals. Pairs of intervals are joined recursively: a pair of interval groups whose boxes are further apart than
``eps`` is skipped with all it contains, the others are replaced by the pairs of their parts. Surviving pairs meet in a
task, which goes on recursively with smaller blocks and checks what is left by cosine in double precision.

Equal vectors are one class, so a group of copies costs one vector. Vectors that are null, empty, zero, or hold null
or non-finite components link with nothing; vectors of different length never link. Rows with equal ``vec_id`` and
different vectors stay rows of their own and share the smaller component. A null ``vec_id`` counts as greater than all
others, so it names a component only if it holds nothing else. Only ``vec_id`` and the vector are read, so other columns
may have any name.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricelens.llm.common import partitions
from pricelens.llm.components import components
from pricelens.session import materialise

#: Leading axes of the grid, vectors of an interval, parts of an interval group, vectors of a block inside a task.
AXES, INTERVAL, FAN, BLOCK = 6, 4096, 8, 128
SLACK = 1e-9


def _matrix(values) -> np.ndarray:
    return np.stack([np.asarray(v, dtype=np.float64) for v in values])


def principal_axes(vectors: DataFrame) -> dict[int, np.ndarray]:
    """For each vector length the axes of greatest variance first; only sums of products leave the tasks."""
    def sums(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total: dict[int, list] = {}
        for frame in frames:
            for n, part in frame.groupby("n"):
                x = _matrix(part["v"])
                x /= np.linalg.norm(x, axis=1, keepdims=True)
                t = total.setdefault(n, [0, np.zeros(n), np.zeros((n, n))])
                t[0], t[1], t[2] = t[0] + len(x), t[1] + x.sum(0), t[2] + x.T @ x
        yield pd.DataFrame([(n, c, s.tobytes(), p.tobytes()) for n, (c, s, p) in total.items()], columns=["n", "c", "s", "p"])

    axes: dict[int, list] = {}
    for r in vectors.select("n", "v").mapInPandas(sums, "n int, c long, s binary, p binary").toLocalIterator():  # one row a task and length
        t = axes.setdefault(r.n, [0, 0.0, 0.0])
        t[0], t[1], t[2] = t[0] + r.c, t[1] + np.frombuffer(r.s), t[2] + np.frombuffer(r.p).reshape(r.n, r.n)
    return {n: np.linalg.eigh(p / c - np.outer(s / c, s / c))[1][:, ::-1].copy() for n, (c, s, p) in axes.items()}


def _intervals(classes: DataFrame, axes: dict[int, np.ndarray], eps: float) -> DataFrame:
    """Sequence intervals of the grid order: number, bounding box on all axes, and the vectors as bytes."""
    turn = classes.sparkSession.sparkContext.broadcast(axes)  # one matrix for each vector length

    def cells(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for n, part in frame.groupby("n"):
                x = _matrix(part["v"])
                x = (x / np.linalg.norm(x, axis=1, keepdims=True)) @ turn.value[n][:, :AXES]
                grid = np.zeros((len(x), AXES), dtype=np.int32)
                grid[:, : x.shape[1]] = np.floor(x / eps)
                yield part.assign(cell=list(grid))

    def cut(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        number, rest = TaskContext.get().partitionId() << 32, None
        for frame in frames:
            for n, part in frame.groupby("n"):  # rows come sorted by length
                if rest is not None and rest["n"].iloc[0] != n:
                    yield interval(number, rest)
                    number, rest = number + 1, None
                rest = part if rest is None else pd.concat([rest, part])
                while len(rest) >= 2 * INTERVAL:
                    yield interval(number, rest[:INTERVAL])
                    number, rest = number + 1, rest[INTERVAL:]
        if rest is not None:
            yield interval(number, rest)

    def interval(number: int, part: pd.DataFrame) -> pd.DataFrame:
        n = int(part["n"].iloc[0])
        x = _matrix(part["v"])
        y = (x / np.linalg.norm(x, axis=1, keepdims=True)) @ turn.value[n]
        row = (number, n, len(part), y.min(0).tolist(), y.max(0).tolist(), x.tobytes(), part["cid"].to_numpy().tobytes(), part["m"].to_numpy().tobytes())
        return pd.DataFrame([row], columns=["number", "n", "rows", "lo", "hi", "x", "cids", "ms"])

    placed = classes.mapInPandas(cells, "cid long, m long, v array<double>, n int, cell array<int>")
    ordered = placed.repartitionByRange(partitions(classes.sparkSession), "n", "cell", "cid").sortWithinPartitions("n", "cell", "cid")
    schema = "number long, n int, rows int, lo array<double>, hi array<double>, x binary, cids binary, ms binary"
    return materialise(ordered.select("cid", "m", "v", "n").mapInPandas(cut, schema), "intervals")


def _interval_pairs(intervals: DataFrame, eps: float) -> DataFrame:
    """Pairs of intervals that may hold links: from the pair of all with all down to single intervals."""
    boxes = intervals.select("n", "number", "lo", "hi")
    order = boxes.select("n", "number").orderBy("n", "number")
    ranked = order.rdd.zipWithIndex().map(lambda r: (r[0][0], r[0][1], r[1])).toDF("n int, number long, i long")
    level = [materialise(boxes.join(ranked, ["n", "number"]).select("n", "number", "i", "lo", "hi"), "boxes")]
    count = level[0].count()
    while count > 1:
        below = level[-1].withColumn("i", F.floor(F.col("i") / FAN))
        sides = below.select("n", "i", F.posexplode(F.arrays_zip("lo", "hi")).alias("axis", "side"))
        merged = sides.groupBy("n", "i", "axis").agg(F.min("side.lo").alias("lo"), F.max("side.hi").alias("hi"))
        whole = merged.groupBy("n", "i").agg(F.array_sort(F.collect_list(F.struct("axis", "lo", "hi"))).alias("s"))
        level.append(materialise(whole.select("n", "i", F.col("s.lo").alias("lo"), F.col("s.hi").alias("hi")), "boxes"))
        count = math.ceil(count / FAN)
    pairs = level[-1].select("n", F.col("i").alias("a"), F.col("i").alias("b"))
    gap = F.aggregate(
        F.zip_with(F.zip_with("lo_b", "hi_a", lambda p, q: p - q), F.zip_with("lo_a", "hi_b", lambda p, q: p - q), lambda p, q: F.greatest(p, q, F.lit(0.0))),
        F.lit(0.0), lambda s, d: s + d * d,
    )
    for depth in range(len(level) - 1, -1, -1):
        if depth < len(level) - 1:
            part = level[depth].withColumn("up", F.floor(F.col("i") / FAN))
            pairs = (
                pairs.join(part.select("n", F.col("up").alias("a"), F.col("i").alias("a_")), ["n", "a"])
                .join(part.select("n", F.col("up").alias("b"), F.col("i").alias("b_")), ["n", "b"])
                .where("a_ <= b_").select("n", F.col("a_").alias("a"), F.col("b_").alias("b"))
            )
        box = level[depth]
        pairs = (
            pairs.join(box.select("n", F.col("i").alias("a"), F.col("lo").alias("lo_a"), F.col("hi").alias("hi_a")), ["n", "a"])
            .join(box.select("n", F.col("i").alias("b"), F.col("lo").alias("lo_b"), F.col("hi").alias("hi_b")), ["n", "b"])
            .where(gap <= eps * eps + SLACK).select("n", "a", "b")
        )
        pairs = materialise(pairs, "interval-pairs")
    number = level[0].select("n", "i", "number")
    return (
        pairs.join(number.select("n", F.col("i").alias("a"), F.col("number").alias("left")), ["n", "a"])
        .join(number.select("n", F.col("i").alias("b"), F.col("number").alias("right")), ["n", "b"]).select("left", "right")
    )


def _forest(a: np.ndarray, b: np.ndarray, labels: np.ndarray) -> None:
    """Give both ends of every link the smaller label until nothing changes."""
    while True:
        low = np.minimum(labels[a], labels[b])
        before = labels.copy()
        np.minimum.at(labels, a, low)
        np.minimum.at(labels, b, low)
        if np.array_equal(before, labels):
            return


def _join_blocks(x: np.ndarray, y: np.ndarray, own: bool, axes: np.ndarray, eps: float, cosine: float) -> tuple[np.ndarray, np.ndarray]:
    """Linked pairs of rows of ``x`` and ``y`` (``own``: the same rows, each pair once)."""
    ux, uy = (v / np.linalg.norm(v, axis=1, keepdims=True) for v in (x, y))
    px, py = ux @ axes, uy @ axes
    limit, head, out_a, out_b = eps * eps + SLACK, min(16, x.shape[1]), [], []
    cuts = lambda p: [(s, min(s + BLOCK, len(p)), p[s : s + BLOCK].min(0), p[s : s + BLOCK].max(0)) for s in range(0, len(p), BLOCK)]
    norms_x, norms_y = (px[:, :head] ** 2).sum(1), (py[:, :head] ** 2).sum(1)
    for s, e, lo, hi in cuts(px):
        for t, f, lo2, hi2 in cuts(py):
            if own and f <= s:
                continue
            if (np.maximum(np.maximum(lo2 - hi, lo - hi2), 0.0) ** 2).sum() > limit:
                continue
            near = norms_x[s:e, None] + norms_y[None, t:f] - 2.0 * (px[s:e, :head] @ py[t:f, :head].T) <= limit
            i, j = np.nonzero(near)
            if own:
                above = i + s < j + t
                i, j = i[above], j[above]
            good = np.einsum("ij,ij->i", ux[s + i], uy[t + j]) >= cosine
            out_a.append(s + i[good])
            out_b.append(t + j[good])
    none = [np.zeros(0, dtype=np.int64)]
    return np.concatenate(out_a or none), np.concatenate(out_b or none)


def near_vectors(embeddings: DataFrame, cosine: float = 0.95, vector: str = "embedding") -> DataFrame:
    """``vec_id, n_links, component_id, kept`` for every row."""
    eps = math.sqrt(2 - 2 * cosine)
    v = F.transform(F.col(vector), lambda x: x.cast("double"))
    whole = F.size("v") > 0
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))) & F.exists("v", lambda x: x != 0)
    rows = embeddings.select("vec_id", v.alias("v")).withColumn("ok", F.coalesce(whole & finite, F.lit(False)))
    good = rows.where("ok").select("vec_id", "v", F.xxhash64("v").alias("h1"), F.xxhash64(F.lit(1), "v").alias("h2"))
    classes = materialise(
        good.groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("m"), F.min("vec_id").alias("first"), F.first("v").alias("v"))
        .select("*", F.size("v").alias("n"), F.monotonically_increasing_id().alias("cid")), "vector-classes",
    )
    axes = principal_axes(classes)
    intervals = _intervals(classes.select("cid", "m", "v", "n"), axes, eps)
    pairs = materialise(_interval_pairs(intervals, eps), "near-intervals")
    turn = embeddings.sparkSession.sparkContext.broadcast(axes)

    def links(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        left, right = key
        parts = {r.number: r for r in frame.itertuples()}
        one, two = parts[left], parts[right]
        read = lambda r: (np.frombuffer(r.x).reshape(r.rows, r.n), np.frombuffer(r.cids, dtype=np.int64), np.frombuffer(r.ms, dtype=np.int64))
        (x, cx, mx), (y, cy, my) = read(one), read(two)
        a, b = _join_blocks(x, y, left == right, turn.value[one.n], eps, cosine)
        if left == right:
            ids, ms = cx, mx
        else:
            ids, ms, b = np.concatenate([cx, cy]), np.concatenate([mx, my]), b + len(cx)
        found = np.bincount(a, weights=ms[b], minlength=len(ids)) + np.bincount(b, weights=ms[a], minlength=len(ids))
        labels = ids.copy()
        _forest(a, b, labels)
        hit = found > 0
        return pd.DataFrame({"cid": ids[hit], "links": found[hit].astype(np.int64), "label": labels[hit]})

    sides = pairs.select("left", "right", F.col("left").alias("number")).unionByName(pairs.where("left <> right").select("left", "right", F.col("right").alias("number")))
    found = materialise(
        sides.join(intervals.select("number", "n", "rows", "x", "cids", "ms"), "number")
        .groupBy("left", "right").applyInPandas(links, "cid long, links long, label long"), "vector-links",
    )
    counts = found.groupBy("cid").agg(F.sum("links").alias("links"))
    parts = components(found.select(F.col("cid").alias("a"), F.col("label").alias("b")))
    settled = classes.select("h1", "h2", "m", "first", "cid").join(counts, "cid", "left").join(parts.withColumnRenamed("id", "cid"), "cid", "left")
    settled = settled.withColumn("component", F.coalesce("component", "cid"))
    names = settled.groupBy("component").agg(F.min("first").alias("component_id"))
    by_class = settled.join(names, "component").select("h1", "h2", (F.coalesce("links", F.lit(0)) + F.col("m") - 1).alias("n_links"), "component_id")
    linked = good.select("vec_id", "h1", "h2").join(by_class, ["h1", "h2"]).select("vec_id", "n_links", "component_id")
    alone = rows.where("not ok").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.unionByName(alone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
