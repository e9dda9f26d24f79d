"""N-gram Jaccard join by grouped prefixes.

Shingles are ordered by the number of documents that hold them, rarest first. The counts come from an exchange by
chunks: documents are dealt to chunks of bounded size, a chunk asks once for each of its distinct shingles, and gets
the counts back in the same order, so a shingle that every document holds costs one entry a chunk. Two sets of the
wanted similarity share a shingle of their prefixes; documents with too few shared shingles leave at once.

Documents with equal sets are one class, classes with equal prefix and size one group. Groups that share a prefix
shingle form a list. A long list is not expanded into pairs at once: its groups are first compared with one of them, in a few
rounds, and only groups that did not get into one component are then compared with each other: first by one class of each
component, at last by all their classes. Group pairs are cut by size and by the place of the shingle in both sets, expanded
to classes, and verified on the whole sets.

Sets are compared by 64-bit hashes of their shingles. Texts that are null or without words have an empty set and link
with nothing; fewer words than a shingle needs are one shingle. Rows with equal ``doc_id`` are rows of their own; a
null ``doc_id`` counts as greater than all others. Only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

import math
from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pricelens.llm import hashing as H
from pricelens.llm.common import text_print, trim
from pricelens.llm.components import components
from pricelens.session import materialise, release_shuffles

CHUNK_BYTES = 8 << 20
#: Bits of a shingle hash beyond those of the number of shingles that tell shingles apart when documents are counted.
SPARE_BITS = 14
#: Rounds in which the groups of long lists meet one of them each, and pairs per entry from which a list is long.
PIVOT_ROUNDS, PAIRS_PER_ENTRY = 3, 4


def in_chunks(docs: DataFrame, chunk_bytes: int, **more: Column) -> tuple[DataFrame, int, int]:
    """``doc_id, text, pa, pb, chunk`` and the columns ``more``, the number of chunks, and the bytes of text.

    A row's chunk follows from its id, text and place in the scan, so that copies of a row spread too. The result is read
    several times: ``docs`` should be a stored table, or anything else that gives its rows in the same places each time.
    """
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    chunks = max(1, math.ceil(total / chunk_bytes))
    mark = text_print(F.col("text"))
    chunk = F.pmod(F.xxhash64("doc_id", "text", F.monotonically_increasing_id()), F.lit(chunks)).cast("int")
    return docs.select("doc_id", "text", mark["a"].alias("pa"), mark["b"].alias("pb"), chunk.alias("chunk"), *(c.alias(n) for n, c in more.items())), chunks, total


def exchange_counts(chunked: DataFrame, keys: Callable, chunks: int, bits: int) -> DataFrame:
    """``chunk, part, counts``: for the sorted distinct keys of each chunk, cut by their leading bits into parts, the
    packed sums over all chunks. ``keys(frame)`` gives a chunk's sorted keys of ``bits`` bits and their own counts."""
    shift = np.uint64(bits - max(1, math.ceil(math.log2(2 * chunks))))

    def ask(frame: pd.DataFrame) -> pd.DataFrame:
        found, own = keys(frame)
        part = (found >> shift).astype(np.int64)
        cuts = np.flatnonzero(np.diff(part, prepend=-1, append=-2))
        rows = [(int(part[s]), int(frame["chunk"].iloc[0]), H.pack(found[s:e]), H.pack_counts(own[s:e])) for s, e in zip(cuts[:-1], cuts[1:], strict=True)]
        del found, own
        trim()
        return pd.DataFrame(rows, columns=["part", "chunk", "keys", "own"])

    def answer(frame: pd.DataFrame) -> pd.DataFrame:
        lists = [H.unpack(k) for k in frame["keys"]]
        _, place = np.unique(np.concatenate(lists), return_inverse=True)
        sums = np.bincount(place, weights=np.concatenate([H.unpack_counts(c) for c in frame["own"]])).astype(np.int64)
        ends = np.cumsum([len(x) for x in lists])
        replies = [H.pack_counts(np.minimum(sums[place[e - len(x) : e]], 2**32 - 1)) for e, x in zip(ends, lists, strict=True)]
        del lists, place, sums
        trim()
        return pd.DataFrame({"chunk": frame["chunk"], "part": frame["part"], "counts": replies})

    asked = chunked.groupBy("chunk").applyInPandas(ask, "part int, chunk int, keys binary, own binary")
    return asked.groupBy("part").applyInPandas(answer, "chunk int, part int, counts binary")


def _sets(docs: DataFrame, n: int, per_cent: int) -> DataFrame:
    """Per row its print, set size and set hash; for rows that may have a partner also prefix and shared shingles."""
    chunked, chunks, total = in_chunks(docs, CHUNK_BYTES)
    bits = min(64, SPARE_BITS + max(20, math.ceil(math.log2(total + 1))))
    drop = np.uint64(64 - bits)
    kind = docs.schema["doc_id"].dataType.simpleString()

    def of_chunk(frame: pd.DataFrame) -> list[np.ndarray]:
        words, starts = H.word_hashes(frame["text"])
        return [H.shingles(words[s:e], n) for s, e in zip(starts[:-1], starts[1:], strict=True)]

    def keys(frame: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
        found = [np.unique(s >> drop) for s in of_chunk(frame)]
        return np.unique(np.concatenate(found), return_counts=True)

    def choose(_: tuple, frame: pd.DataFrame, replies: pd.DataFrame) -> pd.DataFrame:
        sets = of_chunk(frame)
        short = np.concatenate([s >> drop for s in sets] or [np.zeros(0, dtype=np.uint64)])
        _, place = np.unique(short, return_inverse=True)
        counts = [H.unpack_counts(c) for c in replies.sort_values("part")["counts"]]
        counts = np.concatenate(counts)[place] if counts else np.zeros(0, dtype=np.int64)
        rows, at = [], 0
        for s in sets:
            often, at = counts[at : at + len(s)], at + len(s)
            need = -(-per_cent * len(s) // 100)
            shared = s[often > 1]
            row = [len(s), int(s.sum().view(np.int64)) if len(s) else 0, int(H.mix(s ^ np.uint64(H.BASE)).sum().view(np.int64)) if len(s) else 0, None, None]
            if len(s) and len(shared) >= need:
                order = np.lexsort((shared, often[often > 1]))
                first = len(s) - need + 1 - (len(s) - len(shared))
                row[3:] = [shared[order[:first]].view(np.int64).tolist(), shared.view(np.int64).tolist()]
            rows.append(row)
        out = pd.DataFrame(rows, columns=["n_shingles", "sa", "sb", "prefix", "shared"])
        del rows, sets, short, place, counts
        trim()
        return pd.concat([frame[["doc_id", "pa", "pb"]].reset_index(drop=True), out], axis=1)

    replies = exchange_counts(chunked, keys, chunks, bits)
    schema = f"doc_id {kind}, pa long, pb long, n_shingles long, sa long, sb long, prefix array<long>, shared array<long>"
    return materialise(chunked.groupBy("chunk").cogroup(replies.groupBy("chunk")).applyInPandas(choose, schema), "shingle-sets")


def _verified(pairs: DataFrame, sets: DataFrame, per_cent: int) -> DataFrame:
    """The pairs of classes ``a, b`` that are similar enough, compared on their whole sets."""
    left = sets.select(F.col("cid").alias("a"), F.col("size").alias("size_a"), F.col("shared").alias("set_a"))
    right = sets.select(F.col("cid").alias("b"), F.col("size").alias("size_b"), F.col("shared").alias("set_b"))
    both = pairs.join(left, "a").join(right, "b")
    common = F.size(F.array_intersect("set_a", "set_b"))
    return both.select("a", "b", "size_a", "size_b", common.alias("common")).where(
        100 * F.col("common") >= per_cent * (F.col("size_a") + F.col("size_b") - F.col("common"))
    ).select("a", "b")


def near_duplicates(docs: DataFrame, n: int = 5, per_cent: int = 80) -> DataFrame:
    """``doc_id, pa, pb, n_shingles, component_id, keeper`` per row.

    ``pa, pb`` is the print of the text; the keeper of a component is its row with the smallest id, then print.
    """
    rows = _sets(docs, n, per_cent)
    found = rows.where("prefix IS NOT NULL")
    size = F.col("n_shingles").alias("size")
    row = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "pa", "pb")
    classes = materialise(
        found.groupBy("sa", "sb", size).agg(F.min(row).alias("first"), F.first("prefix").alias("prefix"))
        .select("*", F.monotonically_increasing_id().alias("cid"), F.xxhash64("prefix", "size").alias("ga"), F.xxhash64(F.lit(1), "prefix", "size").alias("gb")),
        "set-classes",
    )
    named = classes.select("size", "cid", "first.doc_id", "first.pa", "first.pb")
    same = named["doc_id"].eqNullSafe(found["doc_id"]) & (named["pa"] == found["pa"]) & (named["pb"] == found["pb"])
    sets = materialise(found.join(named, same).select("cid", "size", "shared").dropDuplicates(["cid"]), "class-sets")
    groups = materialise(classes.groupBy("ga", "gb", "size").agg(F.min("cid").alias("gid"), F.first("prefix").alias("prefix")), "groups")
    members = materialise(classes.select("ga", "gb", "size", "cid").join(groups.select("ga", "gb", "size", "gid"), ["ga", "gb", "size"]).select("gid", "cid"), "members")
    # shared shingles from a prefix place on, its own included: no more can be common if the first common one stands there
    need = F.ceil(F.lit(per_cent) * F.col("size") / 100).cast("int")
    listed = groups.select("gid", "size", (F.size("prefix") + need - 1).alias("n"), F.posexplode("prefix").alias("place", "token"))
    lists = materialise(listed.select("gid", "size", "token", (F.col("n") - F.col("place")).alias("rest")), "prefix-lists")
    alone = lists.groupBy("token").count().where("count > 1").select("token")
    lists = materialise(lists.join(alone, "token"), "prefix-lists")

    fits = F.lit(100) * F.least("size_a", "size_b") >= F.lit(per_cent) * F.greatest("size_a", "size_b")
    fits &= F.lit(100 + per_cent) * F.least("rest_a", "rest_b") >= F.lit(per_cent) * (F.col("size_a") + F.col("size_b"))
    within = members.where("gid <> cid").select(F.col("gid").alias("a"), F.col("cid").alias("b"))
    edges = materialise(_verified(within, sets, per_cent), "similar")
    turn, whole = 0, False  # whole: all classes of groups stand for themselves
    while True:
        parts = components(edges)
        placed = members.join(parts.withColumnRenamed("id", "cid"), "cid", "left").withColumn("component", F.coalesce("component", "cid"))
        placed = materialise(placed, "placed")
        # a group whose classes lie in several components counts as none of them
        groups_in = placed.groupBy("gid").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).select("gid", F.when(F.col("lo") == F.col("hi"), F.col("lo")).otherwise(-1 - F.col("gid")).alias("component"))
        entries = materialise(lists.join(groups_in, "gid"), "open-lists")
        by_part = entries.groupBy("token", "component").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct(F.xxhash64(F.lit(turn), "gid").alias("draw"), "gid", "size", "rest")).alias("g"))
        per_list = by_part.groupBy("token").agg(
            F.count(F.lit(1)).alias("parts"), F.sum("n").alias("n"), F.sum(F.col("n") * F.col("n")).alias("squares"), F.min(F.struct("g", "component")).alias("p"),
        ).where("parts > 1").withColumn("long", (F.col("n") * F.col("n") - F.col("squares")) / 2 > F.lit(PAIRS_PER_ENTRY) * F.col("n"))
        per_list = materialise(per_list, "open-lists")
        every = whole or turn >= PIVOT_ROUNDS or per_list.where("long").isEmpty()
        if every:  # all that is left between components
            sides = entries.join(per_list.select("token"), "token")
            b = sides.select("token", F.col("gid").alias("gb_"), F.col("size").alias("size_b"), F.col("rest").alias("rest_b"), F.col("component").alias("cb_"))
            pairs = sides.withColumnsRenamed({"size": "size_a", "rest": "rest_a"}).join(b, "token").where((F.col("gid") < F.col("gb_")) & (F.col("component") != F.col("cb_")) & fits)
            pairs = pairs.select(F.col("gid").alias("g1"), F.col("gb_").alias("g2")).distinct()
        else:  # the groups of a long list with one of them
            pivots = per_list.where("long").select("token", F.col("p.g.gid").alias("g1"), F.col("p.g.size").alias("size_b"), F.col("p.g.rest").alias("rest_b"), F.col("p.component").alias("cb_"))
            pairs = entries.withColumnsRenamed({"size": "size_a", "rest": "rest_a"}).join(pivots, "token").where((F.col("gid") != F.col("g1")) & (F.col("component") != F.col("cb_")) & fits)
            pairs = pairs.select("g1", F.col("gid").alias("g2")).distinct()
        # before the last round one class stands for all of a group that lie in one component; the last round leaves out
        # pairs of groups of one class each, which have been tried so
        kinds = F.count(F.lit(1)).alias("kinds")
        tried = placed.join(placed.groupBy("gid").agg(kinds), "gid") if whole else placed.groupBy("gid", "component").agg(F.min("cid").alias("cid")).withColumn("kinds", F.lit(2))
        one = tried.select(F.col("gid").alias("g1"), F.col("cid").alias("a"), F.col("component").alias("pa"), F.col("kinds").alias("ka"))
        two = tried.select(F.col("gid").alias("g2"), F.col("cid").alias("b"), F.col("component").alias("pb"), F.col("kinds").alias("kb"))
        expanded = pairs.join(one, "g1").join(two, "g2").where("pa <> pb AND (ka > 1 OR kb > 1)").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
        edges = materialise(edges.unionByName(_verified(expanded, sets, per_cent)), "similar")
        release_shuffles(docs.sparkSession)
        if whole:
            break
        turn, whole = turn + 1, every
    split = placed.groupBy("gid").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo <> hi").select("gid")
    rest = placed.join(split, "gid")
    other = rest.select("gid", F.col("cid").alias("b"), F.col("component").alias("cb_"))
    pairs = rest.withColumnRenamed("cid", "a").join(other, "gid").where("a < b AND component <> cb_").select("a", "b")
    edges = materialise(edges.unionByName(_verified(pairs, sets, per_cent)), "similar")

    parts = components(edges)
    settled = classes.select("sa", "sb", "size", "first", "cid").join(parts.withColumnRenamed("id", "cid"), "cid", "left").withColumn("component", F.coalesce("component", "cid"))
    names = settled.groupBy("component").agg(F.min("first").alias("named"))
    by_class = settled.join(names, "component").select("sa", "sb", F.col("size").alias("n_shingles"), "named")
    keeper = F.col("named.doc_id").eqNullSafe(F.col("doc_id")) & (F.col("named.pa") == F.col("pa")) & (F.col("named.pb") == F.col("pb"))
    linked = found.select("doc_id", "pa", "pb", "n_shingles", "sa", "sb").join(by_class, ["sa", "sb", "n_shingles"]).select(
        "doc_id", "pa", "pb", "n_shingles", F.col("named.doc_id").alias("component_id"), keeper.alias("keeper")
    )
    alone = rows.where("prefix IS NULL").select("doc_id", "pa", "pb", "n_shingles", F.col("doc_id").alias("component_id"), F.lit(True).alias("keeper"))
    return linked.unionByName(alone)
