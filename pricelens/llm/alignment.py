"""Alignment of the tokens of two tokenizers by byte offsets: byte-level BPE (A) against BPE pieces with byte fallback (B).

Spans of the libraries are the coarse cuts: character offsets of the tokenizers library, byte spans of the pieces in
sentencepiece's proto (its current name for the immutable proto). They can't part the tokens of one character, and have
no length for some byte-fallback pieces and for the blank that B adds; such runs of tokens are refined by the decoded
bytes of each token. Offsets where tokens of both end cut a text into groups; an A and a B token are linked if they share
a byte.

A takes a text with a blank before it, B adds that blank itself, so both cover the same bytes. Both always end a token
before a blank that follows a letter, digit or printable ASCII sign (checked on the vocabularies; else texts are not
cut), so units of a text that recur are aligned once a task. Counts of linked id pairs go over all documents: a
task sums them per chunk of about ``CHUNK_CHARS`` characters, Spark sums the chunks, and each chunk gets back one row for
each of its pairs. The highest count of each B id is broadcast: a row an id at most.

Texts that are null or empty, or whose joined token bytes differ from the blank and the text (a U+2581 in the text),
have no tokens: zeros and no groups. Rows with equal ``doc_id`` are rows of their own. A long text is one task's work; it
is aligned unit by unit. Only ``doc_id`` and ``text`` are read, so other columns may have any name.
"""

from __future__ import annotations

import functools
import hashlib
import json
import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricelens.llm.bpe import byte_letters
from pricelens.llm.units import BATCH, UnitMemo, can_be_cut
from pricelens.session import materialise

#: Characters of a chunk, and learned units from which a task forgets them between chunks.
CHUNK_CHARS, UNITS_HELD = 8 << 20, 250_000
BLANK = "▁"
DOC, UNITS, PAIR = 0, 1, 2


def refined(starts: np.ndarray, ends: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Byte ends of tokens. A span is kept where it has the size of the token's bytes; other tokens are placed by their
    sizes behind the last kept span."""
    total = np.cumsum(sizes)
    kept = ends - starts == sizes
    anchor = np.maximum.accumulate(np.where(kept, np.arange(len(sizes)), -1))
    moved = np.where(anchor >= 0, ends[anchor] - total[anchor], 0)
    return total + moved


class Aligner:
    """Aligns units with two vocabularies and keeps what it has learned, by unit number."""

    def __init__(self, source: str, model: bytes) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2
        from tokenizers import Tokenizer

        spec = json.loads(source)
        self.a = Tokenizer.from_str(source)
        self.a.no_truncation()
        self.a.no_padding()
        self.a.encode_special_tokens = True
        letter = {c: b for b, c in enumerate(byte_letters())}
        self.bytes_a = {i: bytes(letter[c] for c in t) for t, i in spec["model"]["vocab"].items()}
        self.b = sentencepiece.SentencePieceProcessor(model_proto=model)
        names = [self.b.id_to_piece(i) for i in range(len(self.b))]
        self.bytes_b = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace(BLANK, " ").encode() for i, p in enumerate(names)]
        self.size_a = np.zeros(max(self.bytes_a) + 1, dtype=np.int64)
        self.size_a[list(self.bytes_a)] = [len(t) for t in self.bytes_a.values()]
        self.size_b = np.array([len(t) for t in self.bytes_b])
        proto = sentencepiece_model_pb2.ModelProto.FromString(model)
        rules = proto.normalizer_spec
        exact = not rules.precompiled_charsmap and rules.add_dummy_prefix and not rules.remove_extra_whitespaces
        inner = any(BLANK in p.lstrip(BLANK) for p in names)
        self.cut = can_be_cut(spec) and exact and not inner and not proto.trainer_spec.treat_whitespace_as_suffix
        self.forget()

    def forget(self) -> None:
        self.memo = UnitMemo(self._words, self._strings, self._settle, np.concatenate, lead=True)
        #: By unit: groups as text (None: bytes differ), tokens of A and of B, groups, and linked pairs as ``b << 32 | a``.
        self.groups: list[bytes | None] = []
        self.counts: list[tuple[int, int, int]] = []
        self.pairs: list[bytes] = []

    def _spans(self, text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray] | None:
        """Ids and byte ends of A and B in a blank and ``text``; None if the bytes differ."""
        whole = " " + text
        data = whole.encode()
        done = self.a.encode(whole, add_special_tokens=False)
        ids = np.array(done.ids, dtype=np.int64)
        spans = np.array(done.offsets, dtype=np.int64).reshape(-1, 2)
        if len(data) > len(whole):  # characters to bytes
            points = np.frombuffer(whole.encode("utf-32-le"), dtype=np.uint32)
            at = np.concatenate([[0], np.cumsum(1 + (points > 0x7F) + (points > 0x7FF) + (points > 0xFFFF))])
            spans = at[spans]
        ends_a = refined(spans[:, 0], spans[:, 1], self.size_a[ids])
        found = self.b.encode(text, return_type="proto", num_threads=1).pieces
        pieces = np.array([(p.id, p.begin, p.end) for p in found], dtype=np.int64).reshape(-1, 3)
        begins = pieces[:, 1] + 1
        begins[:1] = 0  # the blank that B adds
        ends_b = refined(begins, pieces[:, 2] + 1, self.size_b[pieces[:, 0]])
        same = b"".join(map(self.bytes_a.__getitem__, ids.tolist())) == data == b"".join(map(self.bytes_b.__getitem__, pieces[:, 0].tolist()))
        return (ids, ends_a, pieces[:, 0], ends_b) if same else None

    def _learn(self, text: str, sizes: np.ndarray) -> list[int] | None:
        """Aligns a text that consists of units of so many bytes, the first blank included, and numbers the units."""
        spans = self._spans(text)
        if spans is None:
            return None
        a, ends_a, b, ends_b = spans
        unit_ends = np.cumsum(sizes)
        shared = np.intersect1d(ends_a, ends_b, assume_unique=True)
        groups_a, groups_b = np.searchsorted(ends_a, shared) + 1, np.searchsorted(ends_b, shared) + 1
        names_a, names_b = list(map(str, a.tolist())), list(map(str, b.tolist()))
        groups, from_a, from_b = [], 0, 0
        for to_a, to_b in zip(groups_a.tolist(), groups_b.tolist(), strict=True):
            groups.append(f"{','.join(names_a[from_a:to_a])}|{','.join(names_b[from_b:to_b])}")
            from_a, from_b = to_a, to_b
        every = np.union1d(ends_a, ends_b)  # bytes between two neighbours belong to one token of each: one link
        linked = (b[np.searchsorted(ends_b, every)] << 32 | a[np.searchsorted(ends_a, every)]).astype("<u8").tobytes()
        cuts = np.concatenate([[[0, 0, 0, 0]], np.stack([np.searchsorted(e, unit_ends) + 1 for e in (shared, every, ends_a, ends_b)], axis=1)])
        first = len(self.groups)
        for (g0, l0, a0, b0), (g1, l1, a1, b1) in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
            self.groups.append(";".join(groups[g0:g1]).encode())
            self.counts.append((a1 - a0, b1 - b0, g1 - g0))
            self.pairs.append(linked[8 * l0 : 8 * l1])
        return list(range(first, len(self.groups)))

    def _strings(self, strings: list[str]) -> list[int]:
        """Units of any kind, each of which begins with its blank."""
        out = []
        for unit in strings:
            number = self._learn(unit[1:], np.array([len(unit.encode())]))
            if number is None:
                number = [len(self.groups)]
                self.groups.append(None)
                self.counts.append((0, 0, 0))
                self.pairs.append(b"")
            out += number
        return out

    def _words(self, words: list[str]) -> list[int]:
        out = []
        for at in range(0, len(words), BATCH):
            part = words[at : at + BATCH]
            numbers = self._learn(" ".join(part), np.array([len(w.encode()) + 1 for w in part]))
            out += self._strings([" " + w for w in part]) if numbers is None else numbers
        return out

    @staticmethod
    def _settle(values: list[int], codes: np.ndarray, starts: np.ndarray) -> list[np.ndarray]:
        return np.split(np.array([-1 if v is None else v for v in values], dtype=np.int64)[codes], starts[1:-1])

    def units_of(self, texts: list[str]) -> Iterator[np.ndarray]:
        """The unit numbers of each text; none for an empty one."""
        none = np.zeros(0, dtype=np.int64)
        if not self.cut:
            return iter([np.array(self._strings([" " + t]), dtype=np.int64) if t else none for t in texts])
        values = self.memo.of([t for t in texts if t])
        return (next(values) if t else none for t in texts)


@functools.lru_cache(maxsize=1)
def _aligner(source: str, model: bytes) -> Aligner:
    return Aligner(source, model)


def _packed(numbers: np.ndarray) -> bytes:
    return zstandard.compress(numbers.astype("<u4").tobytes(), 1)


def _unpacked(data: bytes) -> np.ndarray:
    return np.frombuffer(zstandard.decompress(data), "<u4").astype(np.int64)


FIELDS = [
    ("chunk", "bigint", pa.int64()), ("kind", "int", pa.int32()), ("doc_id", None, None), ("n_a", "bigint", pa.int64()), ("n_b", "bigint", pa.int64()),
    ("n_groups", "bigint", pa.int64()), ("n_links", "bigint", pa.int64()), ("groups_sha256", "string", pa.string()), ("groups", "string", pa.string()),
    ("units", "binary", pa.binary()), ("places", "binary", pa.binary()), ("place", "bigint", pa.int64()), ("pair", "bigint", pa.int64()), ("links", "bigint", pa.int64()),
]


def _batch(id_type: pa.DataType, n: int, **columns) -> pa.RecordBatch:
    arrays = []
    for name, _, kind in FIELDS:
        kind = kind or id_type
        arrays.append(pa.array(columns[name], kind) if name in columns else pa.nulls(n, kind))
    return pa.RecordBatch.from_arrays(arrays, names=[f[0] for f in FIELDS])


def _chunk_rows(work: Aligner, chunk: int, doc_ids: list, found: list[np.ndarray], id_type: pa.DataType, keep_groups: bool) -> Iterator[pa.RecordBatch]:
    """The rows of a chunk: its documents, its units with their pairs, and its pairs with their links."""
    sizes = np.array([len(f) for f in found])
    numbers, place = np.unique(np.concatenate(found), return_inverse=True)
    owner = np.repeat(np.arange(len(found)), sizes)
    bad_unit = np.array([work.groups[u] is None for u in numbers.tolist()], dtype=bool)
    bad = np.bincount(owner, weights=bad_unit[place], minlength=len(found)) > 0
    good = ~bad[owner]
    counts = np.array([work.counts[u] for u in numbers.tolist()], dtype=np.int64).reshape(-1, 3)
    n_pairs = np.array([len(work.pairs[u]) // 8 for u in numbers.tolist()], dtype=np.int64)
    totals = {
        name: np.bincount(owner[good], weights=c[place[good]], minlength=len(found)).astype(np.int64)
        for name, c in zip(("n_a", "n_b", "n_groups", "n_links"), (*counts.T, n_pairs), strict=True)
    }
    pairs, at = np.unique(np.frombuffer(b"".join(work.pairs[u] for u in numbers.tolist()), "<u8"), return_inverse=True)
    times = np.bincount(place[good], minlength=len(numbers))
    links = np.bincount(at, weights=np.repeat(times, n_pairs), minlength=len(pairs)).astype(np.int64)
    ends = np.cumsum(sizes)
    for s in range(0, len(found), 500):
        shas, texts, own = [], [], []
        for i in range(s, min(s + 500, len(found))):
            empty = bad[i] or not sizes[i]
            text = b"" if empty else b";".join([work.groups[u] for u in found[i].tolist()])
            shas.append("" if empty else hashlib.sha256(text).hexdigest())
            texts.append(text.decode() if keep_groups else None)
            own.append(_packed(np.zeros(0) if empty else place[ends[i] - sizes[i] : ends[i]]))
        n = len(own)
        yield _batch(
            id_type, n, chunk=np.full(n, chunk), kind=np.full(n, DOC, dtype=np.int32), doc_id=doc_ids[s : s + n], groups_sha256=shas,
            groups=texts, units=own, **{name: t[s : s + n] for name, t in totals.items()},
        )
    yield _batch(id_type, 1, chunk=[chunk], kind=[UNITS], units=[_packed(n_pairs)], places=[_packed(at)])
    used = np.flatnonzero(links)
    for s in range(0, len(used), 1 << 16):
        here = used[s : s + (1 << 16)]
        n = len(here)
        yield _batch(id_type, n, chunk=np.full(n, chunk), kind=np.full(n, PAIR, dtype=np.int32), place=here, pair=pairs[here].astype(np.int64), links=links[here])


def align(docs: DataFrame, vocabulary: str, model: str, keep_groups: bool = False) -> DataFrame:
    """``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256`` of every row; with ``keep_groups`` also
    ``groups``, the text ``a1,a2|b1;a3|b2`` of ids.

    ``vocabulary`` is a file of the tokenizers library, ``model`` one of sentencepiece, both on the driver; their
    content (a few MB) is broadcast.
    """
    spark = docs.sparkSession
    with open(vocabulary, encoding="utf-8") as one, open(model, "rb") as two:
        files = spark.sparkContext.broadcast((one.read(), two.read()))
    id_kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work, first, seq = _aligner(*files.value), TaskContext.get().partitionId() << 32, 0
        doc_ids, found, size, id_type = [], [], 0, None
        for batch in batches:
            id_type = batch.schema.field("doc_id").type
            texts = [t or "" for t in batch.column("text").to_pylist()]
            doc_ids += batch.column("doc_id").to_pylist()
            found += work.units_of(texts)
            size += sum(map(len, texts))
            if size >= CHUNK_CHARS:
                yield from _chunk_rows(work, first + seq, doc_ids, found, id_type, keep_groups)
                doc_ids, found, size, seq = [], [], 0, seq + 1
                if len(work.groups) > UNITS_HELD:
                    work.forget()
        if found:
            yield from _chunk_rows(work, first + seq, doc_ids, found, id_type, keep_groups)
        work.forget()

    fields = ", ".join(f"{name} {kind or id_kind}" for name, kind, _ in FIELDS)
    rows = materialise(docs.select("doc_id", "text").mapInArrow(run, fields), "alignment")
    pairs = rows.where(F.col("kind") == PAIR).select("chunk", "place", "pair", "links")
    counts = pairs.groupBy("pair").agg(F.sum("links").alias("count")).withColumn("b", F.shiftright("pair", 32))
    counts = materialise(counts, "pair-counts")
    highest = counts.groupBy("b").agg(F.max("count").alias("highest"))
    rated = counts.join(F.broadcast(highest), "b").select("pair", "count", (F.col("count") == F.col("highest")).alias("best"))
    told = pairs.drop("links").join(rated, "pair").select("chunk", "place", "count", "best")

    kept = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", *(["groups"] if keep_groups else [])]

    def rate(left: pa.Table, right: pa.Table) -> pa.Table:
        kinds = left.column("kind").to_numpy()
        tables, own = left.filter(pa.array(kinds == UNITS)), left.filter(pa.array(kinds == DOC))
        n_pairs, at = _unpacked(tables.column("units")[0].as_py()), _unpacked(tables.column("places")[0].as_py())
        found = [_unpacked(u) for u in own.column("units").to_pylist()]
        place = right.column("place").to_numpy()
        sums = {}
        for name, source in (("n_best", "best"), ("count_sum", "count")):
            value = np.zeros(int(at.max(initial=-1)) + 1, dtype=np.int64)
            value[place] = right.column(source).to_numpy()
            total = np.concatenate([[0], np.cumsum(value[at])])
            ends = np.cumsum(n_pairs)
            by_unit = total[ends] - total[ends - n_pairs]
            sums[name] = pa.array([int(by_unit[f].sum()) for f in found], pa.int64())
        out = own.select(kept)
        for name, values in sums.items():
            out = out.append_column(name, values)
        return out

    schema = ", ".join(f"{name} {kind or id_kind}" for name, kind, _ in FIELDS if name in kept) + ", n_best bigint, count_sum bigint"
    left = rows.where(F.col("kind") != PAIR).select(F.col("chunk").alias("chunk"), "kind", "units", "places", *kept)
    return left.groupBy("chunk").cogroup(told.groupBy("chunk")).applyInArrow(rate, schema)
