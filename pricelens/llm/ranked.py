"""Ranked lexical search with per-term geometric blocks, exact.

Documents lie in shards of about ``SHARD_BYTES`` of text, as they come from the scan. In each shard every term has a
posting list. A list is clustered by document similarity (inner products of projected weighted vectors with centroids
drawn from the list), clusters are cut into blocks of at most ``BLOCK`` documents, and a block stores the greatest impact
of each term over its documents, rounded up to eight bits. The index is written once; a search reads it twice:

1. Seeds: the documents in an item's rarest lists are scored in each shard. The k-th best of all seeds is a lower bound
   of the k-th best score.
2. Search: terms whose greatest impacts together stay below the bound can't lift a document over it, so only the lists
   of the other terms are walked. A block is skipped only if the item's weights times its summary stay below the bound.
   All documents of the other blocks are scored on their whole vectors. The bound rises with what a task has found.

Weights are whole numbers, so bounds and scores are exact, and documents that reach the bound are never skipped. A task
returns its k best rows of each item, Spark ranks them. Items are taken in blocks of about ``ITEM_BYTES`` of text, which
are broadcast; the index holds the terms of such a block, all other terms count in the lengths only.

Texts without terms, null or empty, are never found; such items return nothing. Rows with equal ``doc_id`` and items
with equal ``item_id`` are rows of their own; a null ``doc_id`` comes last among equal scores. A long text is split
into terms slice by slice. Columns other than ``doc_id``, ``item_id`` and ``text`` are not read.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pricelens.llm import hashing as H
from pricelens.llm.common import ascii_lower, partitions, trim
from pricelens.llm.units import runs
from pricelens.session import materialise

SHARD_BYTES, ITEM_BYTES, SLICE_BYTES = 4 << 20, 4 << 20, 1 << 20
BLOCK, SEEDS, PROJECTIONS = 64, 64, 32
#: Impacts are at most a million; a summary keeps them in steps of this size, rounded up to one byte.
STEP = 4096
#: Terms of documents of posting lists that are summarised at a time.
EXPANDED = 1 << 20
SEPARATORS = "[\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+"
#: Bytes to terms: A-Z in lower case, separators as blanks, everything else as it is.
LETTERS = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))


def term_array(text: Column) -> Column:
    """The terms of a text in order; none for null."""
    return F.filter(F.split(F.regexp_replace(ascii_lower(F.coalesce(text, F.lit(""))), SEPARATORS, " "), " "), lambda t: t != "")


def terms_of(text: str) -> Iterator[list[bytes]]:
    """The terms of a text in order, slice by slice."""
    data, start = text.encode().translate(LETTERS), 0
    while start < len(data):
        stop = data.find(b" ", start + SLICE_BYTES)
        stop = len(data) if stop < 0 else stop
        yield data[start:stop].split()
        start = stop


def impacts(tf: np.ndarray, n: np.ndarray, n_texts: int, n_terms: int) -> np.ndarray:
    """What a term counts in a document of ``n`` terms, before its weight."""
    m = 50 + 50 * n * n_texts // max(n_terms, 1)
    return 1_000_000_000 * tf // (1000 * tf + 20 * m)


def weight(df: int, n_texts: int) -> int:
    return math.floor(1000 * math.log((2 * n_texts + 2) / (2 * df + 1)))


def _stored(numbers: np.ndarray) -> bytes:
    return H.pack_counts(numbers)


def _loaded(data: bytes) -> np.ndarray:
    return H.unpack_counts(data).astype(np.int64)


def cluster(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """An order of the rows in which similar ones are neighbours, and the sizes of blocks of at most ``BLOCK`` rows."""
    n = len(vectors)
    if n <= BLOCK:
        return np.arange(n), np.array([n])
    count = -(-n // BLOCK)
    likeness = vectors @ vectors[np.arange(count) * n // count].T
    own = likeness.argmax(axis=1)
    order = np.lexsort((-likeness[np.arange(n), own], own))
    sizes = []
    for size in np.bincount(own, minlength=count).tolist():
        sizes += [BLOCK] * (size // BLOCK) + ([size % BLOCK] if size % BLOCK else [])
    return order, np.array(sizes)


def summaries(members: np.ndarray, sizes: np.ndarray, starts: np.ndarray, lens: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each block the number of its terms, the terms in order, and their greatest steps.

    ``entries`` has ``term << 8 | step`` of each term of each document.
    """
    block = np.repeat(np.arange(len(sizes)), sizes)
    cost = np.cumsum(np.add.reduceat(lens[members], np.cumsum(sizes) - sizes)) if len(sizes) else np.zeros(0)
    counts, out = [], [np.zeros(0, dtype=np.int64)]
    first = 0
    while first < len(sizes):
        last = max(first + 1, int(np.searchsorted(cost, (cost[first - 1] if first else 0) + EXPANDED, side="right")))
        here = slice(*np.searchsorted(block, [first, last]))
        docs = members[here]
        keys = np.repeat(block[here] - first << 40, lens[docs])
        keys |= entries[runs(starts[docs], lens[docs])]
        keys.sort()
        keys = keys[np.append(keys[1:] >> 8 != keys[:-1] >> 8, True)]  # the greatest step of each block and term
        counts.append(np.bincount(keys >> 40, minlength=last - first))
        out.append(keys & (1 << 40) - 1)
        first = last
    tops = np.concatenate(out)
    return np.concatenate(counts or out), tops >> 8, (tops & 0xFF).astype(np.uint8)


class Shard:
    """Vectors, posting lists and summaries of a shard."""

    def __init__(self, row: dict) -> None:
        self.number, self.doc_ids = row["shard"], row["doc_ids"]
        self.lens, self.terms, self.impacts = (_loaded(row[c]) for c in ("lens", "terms", "impacts"))
        self.starts = np.cumsum(self.lens) - self.lens
        self.list_terms, self.list_max, list_blocks = (_loaded(row[c]) for c in ("list_terms", "list_max", "list_blocks"))
        self.members, self.sizes = _loaded(row["members"]), _loaded(row["sizes"])
        self.block_starts = np.cumsum(self.sizes) - self.sizes
        self.first_block = np.concatenate([[0], np.cumsum(list_blocks)])
        if "sum_terms" in row:
            self.sum_lens = _loaded(row["sum_lens"])
            self.sum_starts = np.cumsum(self.sum_lens) - self.sum_lens
            self.sum_terms = np.cumsum(H.unpack_counts(row["sum_terms"]), dtype=np.uint32)  # differences modulo 2**32
            self.sum_steps = np.frombuffer(zstandard.decompress(row["sum_steps"]), np.uint8)

    @staticmethod
    def built(row: dict, n_texts: int, n_terms: int, weights: np.ndarray) -> dict:
        """The index row of a shard of term counts."""
        lens, terms, tf, n = (_loaded(row[c]) for c in ("lens", "terms", "tf", "n"))
        starts = np.cumsum(lens) - lens
        owner = np.repeat(np.arange(len(lens)), lens)
        impact = impacts(tf, n[owner], n_texts, n_terms)
        draw = np.random.default_rng(len(weights)).choice(np.array([-1, 1], dtype=np.float32), (len(weights), PROJECTIONS))
        vectors = np.zeros((len(lens), PROJECTIONS), dtype=np.float32)
        if len(lens):
            vectors = np.add.reduceat(draw[terms] * (weights[terms] * (impact / 1e9)).astype(np.float32)[:, None], starts)
        vectors /= np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1e-9)
        order = np.lexsort((owner, terms))
        by_term, docs = terms[order], owner[order]
        cuts = np.flatnonzero(np.append(np.diff(by_term, prepend=-1) != 0, True))
        members, sizes, blocks = [], [], []
        for s, e in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
            placed, cut = cluster(vectors[docs[s:e]])
            members.append(docs[s:e][placed])
            sizes.append(cut)
            blocks.append(len(cut))
        none = [np.zeros(0, dtype=np.int64)]
        members, sizes = np.concatenate(members or none), np.concatenate(sizes or none)
        sum_lens, sum_terms, sum_steps = summaries(members, sizes, starts, lens, terms << 8 | -(-impact // STEP))
        arrays = {
            "lens": lens, "terms": terms, "impacts": impact, "list_terms": by_term[cuts[:-1]], "list_blocks": np.array(blocks, dtype=np.int64),
            "list_max": np.maximum.reduceat(impact[order], cuts[:-1]) if len(order) else none[0], "members": members, "sizes": sizes,
            "sum_lens": sum_lens, "sum_terms": np.diff(sum_terms, prepend=0) & 0xFFFFFFFF,
        }
        packed = {name: _stored(a) for name, a in arrays.items()} | {"sum_steps": zstandard.compress(sum_steps.tobytes(), 1)}
        return {"shard": row["shard"], "doc_ids": row["doc_ids"], **{name: packed[name] for name in ARRAYS}}

    def scores(self, docs: np.ndarray, weights: np.ndarray) -> np.ndarray:
        at = runs(self.starts[docs], self.lens[docs])
        lens = self.lens[docs]
        return np.add.reduceat(weights[self.terms[at]] * self.impacts[at], np.cumsum(lens) - lens)

    def lists(self, terms: np.ndarray) -> np.ndarray:
        """The numbers of the lists of those terms that the shard holds."""
        at = np.searchsorted(self.list_terms, terms)
        at = at[at < len(self.list_terms)]
        return at[np.isin(self.list_terms[at], terms)]

    def seeds(self, lists: np.ndarray, weights: np.ndarray) -> np.ndarray:
        """Documents of the lists of the heaviest terms, list by list until there are ``SEEDS``."""
        found: list[np.ndarray] = []
        for number in lists[np.argsort(-weights[self.list_terms[lists]], kind="stable")].tolist():
            s, e = self.first_block[number], self.first_block[number + 1]
            found.append(self.members[self.block_starts[s] : self.block_starts[e - 1] + self.sizes[e - 1]])
            if sum(map(len, found)) >= SEEDS:
                break
        return np.unique(np.concatenate(found))

    def candidates(self, lists: np.ndarray, weights: np.ndarray, bound: int) -> tuple[np.ndarray, int, int]:
        """Documents of blocks that can reach the bound; the numbers of documents in the lists and in these blocks."""
        most = weights[self.list_terms[lists]] * self.list_max[lists]
        order = np.argsort(most, kind="stable")
        walked = lists[order[np.cumsum(most[order]) >= bound]]
        blocks = runs(self.first_block[walked], self.first_block[walked + 1] - self.first_block[walked])
        every = int(self.sizes[runs(self.first_block[lists], self.first_block[lists + 1] - self.first_block[lists])].sum())
        if not len(blocks):
            return np.zeros(0, dtype=np.int64), every, 0
        lens = self.sum_lens[blocks]
        at = runs(self.sum_starts[blocks], lens)
        tops = STEP * np.add.reduceat(weights[self.sum_terms[at]] * self.sum_steps[at], np.cumsum(lens) - lens)
        blocks = blocks[tops >= bound]
        docs = np.unique(self.members[runs(self.block_starts[blocks], self.sizes[blocks])])
        return docs, every, int(self.sizes[blocks].sum())


class Best:
    """The ``k`` best rows of each item seen by a task, best first: score, then id, then place."""

    def __init__(self, k: int) -> None:
        self.k, self.rows = k, {}

    def bound(self, item: int, least: int) -> int:
        rows = self.rows.get(item, ())
        return max(least, -rows[-1][0]) if len(rows) == self.k else least

    def add(self, item: int, shard: Shard, docs: np.ndarray, scores: np.ndarray, least: int) -> None:
        good = np.flatnonzero(scores >= max(1, self.bound(item, least)))
        ids = shard.doc_ids
        fresh = [(-s, ids[d] is None, 0 if ids[d] is None else ids[d], shard.number, d) for s, d in zip(scores[good].tolist(), docs[good].tolist(), strict=True)]
        if fresh:
            self.rows[item] = heapq.nsmallest(self.k, [*self.rows.get(item, ()), *fresh])


ARRAYS = ("lens", "terms", "impacts", "list_terms", "list_max", "list_blocks", "members", "sizes", "sum_lens", "sum_terms", "sum_steps")
SHARDS = "shard bigint, doc_ids array<{id}>, n binary, lens binary, terms binary, tf binary, n_texts bigint, n_terms bigint"
INDEX = "shard bigint, doc_ids array<{id}>, " + ", ".join(f"{a} binary" for a in ARRAYS)


def _rows_batch(rows: list[dict], id_type: pa.DataType) -> pa.RecordBatch:
    kinds = {"doc_ids": pa.list_(id_type)}
    return pa.RecordBatch.from_arrays([pa.array([r[c] for r in rows], kinds.get(c) or (pa.int64() if isinstance(rows[0][c], int) else pa.binary())) for c in rows[0]], names=list(rows[0]))


def term_counts(docs: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """Shards with the counts of the terms of ``vocabulary``, and the texts with a term and all terms of each shard."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, number = shared.value.get, TaskContext.get().partitionId() << 32
        ids, found, lengths, size, n_texts, n_terms, id_type = [], [], [], 0, 0, 0, None

        def shard() -> pa.RecordBatch:
            sizes = np.array([len(f) for f in found], dtype=np.int64)
            every = np.concatenate([np.zeros(0, dtype=np.int64), *found])
            keys, tf = np.unique(np.repeat(np.arange(len(found)), sizes) << 32 | every, return_counts=True)
            lens = np.bincount(keys >> 32, minlength=len(found))
            arrays = {"n": np.array(lengths, dtype=np.int64), "lens": lens, "terms": keys & 0xFFFFFFFF, "tf": tf}
            return _rows_batch([{"shard": number, "doc_ids": ids, **{c: _stored(a) for c, a in arrays.items()}, "n_texts": n_texts, "n_terms": n_terms}], id_type)

        for batch in batches:
            id_type = batch.schema.field("doc_id").type
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
                own, n = [], 0
                for words in terms_of(text or ""):
                    n += len(words)
                    own += [t for w in words if (t := known(w)) is not None]
                size += len(text or "")
                n_texts, n_terms = n_texts + (n > 0), n_terms + n
                if own:
                    ids.append(doc_id)
                    found.append(np.array(own, dtype=np.int64))
                    lengths.append(n)
                if size >= SHARD_BYTES:
                    yield shard()
                    ids, found, lengths, size, n_texts, n_terms, number = [], [], [], 0, 0, 0, number + 1
        if n_texts:
            yield shard()
        trim()

    kind = docs.schema["doc_id"].dataType.simpleString()
    return materialise(docs.select("doc_id", "text").mapInArrow(run, SHARDS.format(id=kind)), "term-counts")


def frequencies(shards: DataFrame) -> DataFrame:
    """``term, df``: documents that hold a term."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(0, dtype=np.int64)
        for batch in batches:
            for data in batch.column("terms").to_pylist():
                own = np.bincount(_loaded(data), minlength=len(total))
                own[: len(total)] += total
                total = own
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(total[held])], names=["term", "df"])

    return shards.select("terms").mapInArrow(run, "term bigint, df bigint").groupBy("term").agg(F.sum("df").alias("df"))


def build_index(shards: DataFrame, n_texts: int, n_terms: int, weights: np.ndarray) -> DataFrame:
    """One row a shard: vectors, clustered posting lists and block summaries."""
    shared = shards.sparkSession.sparkContext.broadcast(weights)
    field = shards.schema["doc_ids"].dataType.elementType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            id_type = batch.schema.field("doc_ids").type.value_type
            for row in batch.to_pylist():
                yield _rows_batch([Shard.built(row, n_texts, n_terms, shared.value)], id_type)
        trim()

    columns = ["shard", "doc_ids", "n", "lens", "terms", "tf"]
    # an index row is some hundred times a row of counts: few of them a task
    dealt = shards.select(columns).repartition(partitions(shards.sparkSession), "shard")
    return materialise(dealt.mapInArrow(run, INDEX.format(id=field)), "block-index")


def _search(index: DataFrame, items: dict[int, np.ndarray], weights: np.ndarray, k: int, bounds: dict[int, int] | None) -> DataFrame:
    """``item, score, doc_id, shard, place, held, scored`` of the best rows of each task; seeds only without ``bounds``.

    Rows without ``doc_id`` and a place of -1 carry how many documents the lists of an item hold and how many were scored.
    """
    shared = index.sparkSession.sparkContext.broadcast((items, weights, bounds))
    kind = index.schema["doc_ids"].dataType.elementType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own_items, all_weights, least = shared.value
        best, held, scored, id_type = Best(k), dict.fromkeys(own_items, 0), dict.fromkeys(own_items, 0), None
        now = np.zeros(len(all_weights), dtype=np.int64)
        for batch in batches:
            id_type = batch.schema.field("doc_ids").type.value_type
            for row in batch.to_pylist():
                shard = Shard(row)
                for item, terms in own_items.items():
                    lists = shard.lists(terms)
                    if not len(lists):
                        continue
                    now[terms] = all_weights[terms]
                    if least is None:
                        docs, bound = shard.seeds(lists, now), 1
                    else:
                        bound = best.bound(item, least.get(item, 1))
                        docs, every, some = shard.candidates(lists, now, bound)
                        held[item] += every
                        scored[item] += some
                    if len(docs):
                        best.add(item, shard, docs, shard.scores(docs, now), bound)
                    now[terms] = 0
        rows = [(i, -s, None if none else d, n, at, 0, 0) for i, found in best.rows.items() for s, none, d, n, at in found]
        rows += [(i, 0, None, 0, -1, held[i], scored[i]) for i in held if held[i]]
        trim()
        if id_type is not None:
            kinds = [pa.int64(), pa.int64(), id_type, pa.int64(), pa.int64(), pa.int64(), pa.int64()]
            names = ["item", "score", "doc_id", "shard", "place", "held", "scored"]
            columns = list(zip(*rows, strict=True)) or [[]] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=names)

    wanted = index.drop("sum_lens", "sum_terms", "sum_steps") if bounds is None else index
    return wanted.mapInArrow(run, f"item bigint, score bigint, doc_id {kind}, shard bigint, place bigint, held bigint, scored bigint")


def _item_blocks(items: DataFrame) -> Iterator[list]:
    """Items with their distinct terms, in lists of about ``ITEM_BYTES`` of text, and of less than twice that unless an
    item alone is longer."""
    size = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long")
    numbered = materialise(
        items.select("item_id", size.alias("size"), F.array_distinct(term_array(F.col("text"))).alias("terms"), F.monotonically_increasing_id().alias("item"))
        .where(F.size("terms") > 0), "items",
    )
    facts = numbered.agg(F.sum("size"), F.max("size")).first()
    count = max(1, math.ceil((facts[0] or 0) / ITEM_BYTES))
    while True:
        block = F.pmod(F.xxhash64("item"), F.lit(count))
        most = numbered.groupBy(block.alias("block")).agg(F.sum("size").alias("size"), F.count(F.lit(1)).alias("n")).where("n > 1").agg(F.max("size")).first()[0] or 0
        if most < 2 * ITEM_BYTES + (facts[1] or 0):
            break
        count *= 2
    for i in range(count):
        rows = numbered.where(block == i).select("item", "item_id", "terms").collect()  # bounded, see above
        if rows:
            yield rows


def rank(docs: DataFrame, items: DataFrame, k: int = 50, work: bool = False) -> DataFrame:
    """``item_id, rank, doc_id, score``: the ``k`` best documents of each item with a score above 0.

    With ``work`` instead ``item_id, held, scored``: documents in the posting lists of the item's terms, summed over the
    lists, and those in blocks that were scored.
    """
    spark = docs.sparkSession
    kind, id_kind = items.schema["item_id"].dataType.simpleString(), docs.schema["doc_id"].dataType.simpleString()
    out = []
    for rows in _item_blocks(items):
        vocabulary = {t.encode(): i for i, t in enumerate(sorted({t for r in rows for t in r.terms}))}
        own = {r.item: np.array(sorted(vocabulary[t.encode()] for t in r.terms), dtype=np.int64) for r in rows}
        shards = term_counts(docs, vocabulary)
        facts = shards.agg(F.sum("n_texts"), F.sum("n_terms")).first()
        n_texts, n_terms = facts[0] or 0, facts[1] or 0
        weights = np.zeros(len(vocabulary), dtype=np.int64)
        for term, df in frequencies(shards).collect():  # a row a term of the block of items
            weights[term] = weight(df, n_texts)
        index = build_index(shards, n_texts, n_terms, weights)
        seeds = _search(index, own, weights, k, None).where("place >= 0")
        nth = F.row_number().over(Window.partitionBy("item").orderBy(F.desc("score")))
        bounds = dict(seeds.select("item", "score", nth.alias("nth")).where(F.col("nth") == k).select("item", "score").collect())
        found = materialise(_search(index, own, weights, k, bounds), "ranked")
        names = spark.createDataFrame([(r.item, r.item_id) for r in rows], f"item long, item_id {kind}")
        if work:
            sums = found.where("place < 0").groupBy("item").agg(F.sum("held").alias("held"), F.sum("scored").alias("scored"))
            out.append(sums.join(F.broadcast(names), "item").select("item_id", "held", "scored"))
            continue
        order = Window.partitionBy("item").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last(), "shard", "place")
        ranked = found.where("place >= 0").withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
        out.append(ranked.join(F.broadcast(names), "item").select("item_id", "rank", "doc_id", "score"))
    if not out:
        more = "held long, scored long" if work else f"rank int, doc_id {id_kind}, score long"
        return spark.createDataFrame([], f"item_id {kind}, {more}")
    result = out[0]
    for one in out[1:]:
        result = result.unionByName(one)
    return result
