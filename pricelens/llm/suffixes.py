"""Repeated byte strings by column-wise construction of collection BWTs and common prefixes.

Every string of ``length`` bytes is named by the smallest hash of the short strings in it; neighbours with one name form
a segment, so equal strings lie in segments of one name. Names that occur once, and segments that equal another one as
a whole, are settled by counts. The bytes of the remaining distinct segments go to buckets of bounded size, where the
BWT of the collection is built from the last symbol of each segment to the first: a round inserts one symbol of
``WIDTH`` bytes for each string and passes once, sequentially, through the BWT and the common prefixes. Strings whose common prefix with a
neighbour reaches ``length`` are repeated. Only the segments of a name that has too many for a bucket are named anew before
that, by longer short strings, which settles equal ones; if there are still too many, by whole strings.

A null text is empty. Texts shorter than ``length`` keep all their bytes. Rows with equal ``doc_id`` are documents of
their own, so a repeated row repeats its strings. Only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricelens.llm.common import text_print
from pricelens.llm.hashing import BYTE, _tables, distinct, mix
from pricelens.session import materialise

#: Bytes of the short strings that name, strings of a segment, bytes of a bucket, and segments of a name in a bucket.
SEED, SEGMENT, BUCKET_BYTES, NAME_SEGMENTS = 64, 400, 1 << 16, 2_000
#: Bytes of a symbol of the BWT (8, 16, 32, ...), and the least numbers of 1, 2, ... bytes: eight bytes agree above their difference.
WIDTH, BOUNDS = 16, np.uint64(1) << np.arange(0, 64, 8, dtype=np.uint64)


def segments_of(raw: bytes, length: int, seed: int) -> Iterator[tuple[int, int, int, bool]]:
    """Name, first string, number of strings of each segment, and whether its naming seed occurs in it twice.

    The name of a string is the smallest hash of its ``seed`` bytes long parts, by block-wise running minima.
    """
    data = np.frombuffer(raw, dtype=np.uint8)
    up, down = _tables(len(data))
    sums = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum(BYTE[data] * up[: len(data)], out=sums[1:])
    hashes = mix((sums[seed:] - sums[:-seed]) * down[: len(data) - seed + 1])
    width = length - seed + 1
    blocks = np.full((-(-len(hashes) // width), width), np.uint64(2**64 - 1))
    blocks.reshape(-1)[: len(hashes)] = hashes
    ahead = np.minimum.accumulate(blocks, axis=1).reshape(-1)
    back = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    n = len(data) - length + 1
    names = np.minimum(back[:n], ahead[width - 1 : width - 1 + n])
    cuts = np.concatenate([[0], np.flatnonzero(names[1:] != names[:-1]) + 1, [n]]).tolist()
    signed = names.view(np.int64)
    for s, e in zip(cuts[:-1], cuts[1:], strict=True):
        for at in range(s, e, SEGMENT):
            stop = min(at + SEGMENT, e)
            yield int(signed[s]), at, stop - at, bool(stop - at > 1 and np.count_nonzero(hashes[at : stop - 1 + width] == names[s]) > 1)


def _segments(docs: DataFrame, length: int, seed: int) -> DataFrame:
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows = []
            for doc, pa, pb, text in zip(frame["doc_id"], frame["pa"], frame["pb"], frame["text"], strict=True):
                raw = (text or "").encode()
                if len(raw) < length:
                    continue
                for name, at, n, own in segments_of(raw, length, seed):
                    digest = hashlib.blake2b(raw[at : at + n + length - 1], digest_size=16).digest()
                    rows.append((name, int.from_bytes(digest[:8], "little", signed=True), int.from_bytes(digest[8:], "little", signed=True), doc, pa, pb, at, n, own))
            yield pd.DataFrame(rows, columns=["name", "da", "db", "doc_id", "pa", "pb", "at", "n", "own"])

    return docs.mapInPandas(run, f"name long, da long, db long, doc_id {kind}, pa long, pb long, at int, n int, own boolean")


def _cells(segments: list[bytes], sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Eight bytes from every place of the segments as a number, a place of each symbol of ``WIDTH`` bytes, in their order,
    and for each string of the collection its symbols from the last to the first (from 1 on; 0: none left).

    A segment gives ``WIDTH`` strings, padded at their end by 0, 1, ... zeros. Symbols are numbered by halves.
    """
    flat = np.zeros(int(sizes.sum()) + WIDTH * (len(segments) + 1), dtype=np.uint8)
    ends = np.cumsum(sizes + WIDTH) - WIDTH
    for s, size, end in zip(segments, sizes.tolist(), ends.tolist(), strict=True):
        flat[end - size : end] = np.frombuffer(s, dtype=np.uint8) + np.uint8(1)  # UTF-8 has no byte 255
    eight = np.ascontiguousarray(np.lib.stride_tricks.sliding_window_view(flat, 8)).view(">u8").reshape(-1).astype(np.uint64)
    _, places, number = distinct(eight)
    width = 8
    while width < WIDTH:
        after = np.concatenate([number[width:], np.full(width, number[-1])])  # the last windows are zeros only
        _, places, number = distinct((number << 32) | after)
        width *= 2
    back = np.arange(WIDTH)[:, None] - WIDTH * np.arange(1, (int(sizes.max()) + WIDTH - 1) // WIDTH + 2)
    at = back[None] + ends[:, None, None]
    inside = sizes[:, None, None] + back[None] >= 0
    return eight, places, np.where(inside, number[np.maximum(at, 0)] + 1, 0).reshape(len(segments) * WIDTH, -1).astype(np.int32)


def bwt_repeats(segments: list[bytes], length: int) -> list[np.ndarray]:
    """For each segment, which of its strings of ``length`` bytes occur elsewhere in the collection.

    A symbol is ``WIDTH`` bytes, so a round passes over as many bytes of each segment; the strings padded by 1, 2, ... zeros
    hold the suffixes that begin between symbols. Zeros are no byte of a text, so they lengthen no common prefix of bytes.

    ``bwt`` and ``common`` list the suffixes inserted so far in order: the symbol before each (0: none left) and its
    common prefix with the suffix above, in bytes. ``key`` holds the first symbol of each and the row of what follows it, so the
    next suffix of a string belongs where the symbol before its last one and that row sort in.
    """
    sizes = np.fromiter(map(len, segments), dtype=np.int64, count=len(segments))
    eight, places, columns = _cells(segments, sizes)
    m, span = columns.shape
    pads = np.tile(np.arange(WIDTH), len(segments))
    cells = (np.repeat(sizes, WIDTH) + pads) // WIDTH
    bits = int(sizes.sum() + m).bit_length()
    rows = (1 << bits) - 1
    bwt, common = columns[:, 0].copy(), np.zeros(m, dtype=np.int16 if span * WIDTH < 1 << 15 else np.int32)
    key, row, live = np.arange(-m, 0), np.arange(m), np.arange(m)

    def leading(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Bytes that two different symbols begin with together; none if one of them is none (below 1)."""
        out, same = np.zeros(len(a), dtype=np.int64), (a > 0) & (b > 0)
        a, b = places[np.maximum(a, 1) - 1], places[np.maximum(b, 1) - 1]
        for k in range(0, WIDTH, 8):
            differ = eight[np.minimum(a + k, len(eight) - 1)] ^ eight[np.minimum(b + k, len(eight) - 1)]
            out += np.where(same, 8 - np.searchsorted(BOUNDS, differ, side="right"), 0)
            same &= differ == 0
        return out

    for step in range(1, span):
        live = live[cells[live] >= step]
        n, at = len(bwt), row[live]
        fresh = (bwt[at].astype(np.int64) << bits) + at
        order = np.argsort(fresh)
        fresh, at, live = fresh[order], at[order], live[order]
        place = np.searchsorted(key, fresh)
        first = fresh - at
        joined = np.append(place[1:] == place[:-1], False)  # the next new suffix comes directly below
        last = place == n
        last[:-1] &= ~joined[:-1]
        before, after = key[place - 1], key[np.minimum(place, n - 1)]
        before[1:][joined[:-1]], after[:-1][joined[:-1]] = fresh[:-1][joined[:-1]], fresh[1:][joined[:-1]]
        has, under = before >= first, (after <= first + rows) & ~last
        bounded = np.append(common, common.dtype.type(0))

        def shared(low: np.ndarray, high: np.ndarray, bounded: np.ndarray = bounded) -> np.ndarray:
            down = np.argsort(low)  # down the BWT, so that the common prefixes are passed through once
            out = np.empty(len(low), dtype=bounded.dtype)
            if len(low):
                out[down] = WIDTH + np.minimum.reduceat(bounded, np.stack([low[down] + 1, high[down] + 1], axis=1).reshape(-1))[::2]
            return out

        above, below = leading(before >> bits, first >> bits), leading(after >> bits, first >> bits)
        above[has] = shared((before - first)[has], at[has])
        below[under] = shared(at[under], (after - first)[under])
        new = place + np.arange(len(live))
        old = np.ones(n + len(live), dtype=bool)
        old[new] = False

        def inserted(values: np.ndarray, more: np.ndarray, old: np.ndarray = old, new: np.ndarray = new) -> np.ndarray:
            out = np.empty(len(old), dtype=values.dtype)
            out[old] = values
            out[new] = more
            return out

        moved = np.cumsum(np.bincount(place, minlength=n))  # rows inserted above each row
        key[m:] += moved[key[m:] & rows]
        key = inserted(key, first + at + moved[at])
        bwt, common = inserted(bwt, columns[live, step]), inserted(common, above)
        common[new[~last] + 1] = below[~last]
        row[live] = new
    reach = np.append(common, common.dtype.type(0))
    twice = (reach[:-1] >= length) | (reach[1:] >= length)
    longer = np.empty(len(key), dtype=np.int64)  # the row of the suffix that has one symbol more
    longer[key[m:] & rows] = np.arange(m, len(key))
    strings = np.maximum(0, sizes - length + 1)
    begins = np.repeat(np.cumsum(strings) - strings, WIDTH)
    out, at = np.zeros(int(strings.sum()), dtype=bool), np.arange(m)
    for size in range(1, span):
        live = np.flatnonzero(cells >= size)
        at[live] = longer[at[live]]
        hit = live[(size * WIDTH - pads[live] >= length) & twice[at[live]]]
        out[begins[hit] + np.repeat(sizes, WIDTH)[hit] + pads[hit] - size * WIDTH] = True
    return np.split(out, np.cumsum(strings)[:-1])


def _bytes_of(refs: DataFrame, docs: DataFrame, length: int) -> DataFrame:
    """``refs`` with the bytes of each segment in ``data``."""
    grouped = refs.groupBy("doc_id", "pa", "pb").agg(F.collect_list(F.struct("name", "rid", "at", "n", "once")).alias("refs"))
    texts = docs.withColumnsRenamed({"doc_id": "d_", "pa": "pa_", "pb": "pb_"}).dropDuplicates(["d_", "pa_", "pb_"])
    same = grouped["doc_id"].eqNullSafe(texts["d_"]) & (grouped["pa"] == texts["pa_"]) & (grouped["pb"] == texts["pb_"])
    return grouped.join(texts, same).select(F.col("text").cast("binary").alias("raw"), F.explode("refs").alias("r")).select(
        "r.*", F.substring("raw", F.col("r.at") + 1, F.col("r.n") + length - 1).alias("data")
    )


def _fit_buckets(pieces: DataFrame, length: int) -> DataFrame:
    """Name the segments of names that have too many anew by longer seeds, in the end by whole strings.

    ``pieces``: ``name, rid, off, n, once, data``. At the last seed a name is one string. Segments that become equal
    are settled by their count and come back with their ``n`` in ``settled``.
    """
    def rename(seed: int):
        def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for frame in frames:
                rows = [
                    (old, name, rid, off + at, n, own, once, data[at : at + n + length - 1])
                    for old, rid, off, once, data in zip(frame["name"], frame["rid"], frame["off"], frame["once"], frame["data"], strict=True)
                    for name, at, n, own in segments_of(data, length, seed)
                ]
                yield pd.DataFrame(rows, columns=["old", "name", "rid", "off", "n", "own", "once", "data"])

        return run

    done = None
    for seed in (length // 2, length * 3 // 4, length):
        big = materialise(pieces.groupBy("name").count().where(F.col("count") > NAME_SEGMENTS).select("name"), "big-names")
        if big.isEmpty():
            break
        renamed = pieces.join(big, "name").select("name", "rid", "off", "once", "data").mapInPandas(
            rename(seed), "old long, name long, rid long, off int, n int, own boolean, once boolean, data binary"
        )
        named = materialise(renamed.select(
            F.xxhash64("old", "name").alias("name"), "rid", "off", "n", "own", "once", "data",
            F.xxhash64("data").alias("x"), F.xxhash64(F.lit(1), "data").alias("y"),
        ), "renamed")
        same = named.groupBy("name", "x", "y").agg(
            F.count(F.lit(1)).alias("c"), F.min(F.struct("rid", "off", "n")).alias("p"), F.first("data").alias("data"),
            F.min("once").alias("once"), F.max("own").alias("own"),
        )
        twice = named.where("once").join(same.where("c > 1").select("name", "x", "y"), ["name", "x", "y"]).select("rid", "off", "n")
        done = materialise(twice if done is None else done.unionByName(twice), "settled")
        kept = same.select("name", "p.rid", "p.off", "p.n", (F.col("once") & (F.col("c") == 1)).alias("once"), "own", "data")
        alive = kept.groupBy("name").agg(F.count(F.lit(1)).alias("c"), F.max("once").alias("open"), F.max("own").alias("own")).where("open AND (c > 1 OR own)")
        kept = kept.drop("own").join(alive.select("name"), "name")
        pieces = materialise(pieces.join(big, "name", "left_anti").unionByName(kept), "pieces")
    settled = pieces.select("rid", "off", "n").limit(0) if done is None else done
    return pieces.select("*", F.lit(None).cast("int").alias("settled")).unionByName(
        settled.select("rid", "off", F.lit(0).alias("n"), F.col("n").alias("settled")), allowMissingColumns=True
    )


def repeated_spans(docs: DataFrame, length: int = 400) -> DataFrame:
    """``doc_id, pa, pb, spans``: for rows that lose bytes, the sorted maximal byte ranges ``[start, end)``."""
    mark = text_print(F.col("text"))
    rows = docs.select("doc_id", mark["a"].alias("pa"), mark["b"].alias("pb"), "text")
    segments = materialise(_segments(rows, length, min(SEED, length // 4 + 1)), "segments")
    names = segments.groupBy("name", "da", "db", "n").agg(
        F.count(F.lit(1)).alias("c"), F.min_by(F.struct("doc_id", "pa", "pb", "at"), F.struct("pa", "pb", "at")).alias("r"), F.max("own").alias("own")
    )
    shared = segments.groupBy("name").agg(F.count(F.lit(1)).alias("c"), F.max("own").alias("own")).where("c > 1 OR own").select("name")
    names = materialise(names.join(shared, "name").select("*", F.monotonically_increasing_id().alias("rid")), "distinct-segments")
    whole = segments.join(names.where("c > 1").select("name", "da", "db", "n"), ["name", "da", "db", "n"]).select("doc_id", "pa", "pb", F.col("at").alias("start"), (F.col("at") + F.col("n") + length - 1).alias("end"))
    open_names = names.groupBy("name").agg(F.count(F.lit(1)).alias("k"), F.min("c").alias("least"), F.max("own").alias("own")).where("least = 1 AND (k > 1 OR own)").select("name")
    refs = names.join(open_names, "name").select("name", "rid", "r.*", "n", (F.col("c") == 1).alias("once"))
    pieces = materialise(_bytes_of(refs, rows, length).select("name", "rid", F.lit(0).alias("off"), "n", "once", "data"), "pieces")
    fitted = materialise(_fit_buckets(pieces, length), "pieces")
    total = fitted.agg(F.sum(F.octet_length("data"))).first()[0] or 0
    buckets = max(1, math.ceil(total / BUCKET_BYTES))

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        out = []
        for rid, off, once, hit in zip(frame["rid"], frame["off"], frame["once"], bwt_repeats(frame["data"].tolist(), length), strict=True):
            if once:
                edges = np.flatnonzero(np.diff(np.concatenate([[0], hit.view(np.int8), [0]])))
                out += [(rid, off + s, off + e + length - 1) for s, e in zip(edges[::2], edges[1::2], strict=True)]
        return pd.DataFrame(out, columns=["rid", "s", "e"])

    bucketed = fitted.where("settled IS NULL").withColumn("bucket", F.pmod(F.xxhash64("name"), F.lit(buckets)))
    found = bucketed.groupBy("bucket").applyInPandas(run, "rid long, s int, e int").unionByName(
        fitted.where("settled IS NOT NULL").select("rid", F.col("off").alias("s"), (F.col("off") + F.col("settled") + length - 1).alias("e"))
    )
    parts = found.join(names.select("rid", "r"), "rid").select("r.doc_id", "r.pa", "r.pb", (F.col("r.at") + F.col("s")).alias("start"), (F.col("r.at") + F.col("e")).alias("end"))
    return whole.unionByName(parts).groupBy("doc_id", "pa", "pb").agg(F.array_sort(F.collect_set(F.struct("start", "end"))).alias("spans"))


def without_repeats(docs: DataFrame, length: int = 400) -> DataFrame:
    """``doc_id, n_bytes, spans, kept`` for every row: removed byte ranges, and the bytes that are left."""
    mark = text_print(F.col("text"))
    rows = docs.select("doc_id", "text", mark["a"].alias("pa"), mark["b"].alias("pb"))
    spans = repeated_spans(docs, length).withColumnsRenamed({"doc_id": "d_", "pa": "pa_", "pb": "pb_"})
    same = rows["doc_id"].eqNullSafe(spans["d_"]) & (rows["pa"] == spans["pa_"]) & (rows["pb"] == spans["pb_"])
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = []
            for doc, text, spans_ in zip(frame["doc_id"], frame["text"], frame["spans"], strict=True):
                raw, merged, kept, at = (text or "").encode(), [], [], 0
                for r in spans_ if spans_ is not None else []:
                    s, e = r["start"], r["end"]
                    if merged and s <= merged[-1][1]:
                        merged[-1][1] = max(merged[-1][1], e)
                    else:
                        merged.append([s, e])
                for s, e in merged:
                    kept.append(raw[at:s])
                    at = e
                out.append((doc, len(raw), [{"start": s, "end": e} for s, e in merged], b"".join([*kept, raw[at:]])))
            yield pd.DataFrame(out, columns=["doc_id", "n_bytes", "spans", "kept"])

    joined = rows.join(spans, same, "left").select(rows["doc_id"], "text", "spans")
    return joined.mapInPandas(run, f"doc_id {kind}, n_bytes long, spans array<struct<start:int,end:int>>, kept binary")
