"""Token ids in files of patched frame-of-reference blocks.

A file holds the ids of consecutive documents, one after the other, each followed by the end id. Ids are cut into
blocks of ``BLOCK``. A block keeps its minimum and the differences to it, packed at the width that ``PERCENTILE`` per
cent of them need; the high bits of the others stand in an exception list of positions and values. Layout, all numbers
little-endian::

    "PFR1" | blocks | starts of the blocks (u64 each) | documents (Arrow stream of doc_id, n_tokens) | trailer
    block:   HEAD (minimum, width, exceptions, ids in it) | 8 * width words of 64 bits | positions u16 | high bits u32
    trailer: number of ids, of blocks, place of the starts, place of the documents (u64 each) | "PFR1"

so that any run of documents is read with the trailer, the two indexes and its own blocks.

Writing sorts rows by ``doc_id`` over range partitions; a task writes files of about ``file_ids`` ids to the shared
folder under a name of its own and returns a manifest row for each. Only the manifest, committed by Spark, names the
files that count: what a lost or repeated task left behind is never read. Paths go through Arrow's file systems
(local and mounted folders, hdfs, s3, gs).

A null ``doc_id`` comes first. Rows with equal ``doc_id`` follow each other by text, equal rows by their place in the
input. Null and empty texts have the end id only. Only ``doc_id`` and ``text`` are read, so other columns may have any
name. A long text is encoded in one task and lies in one file; reading gives its ids in one row.
"""

from __future__ import annotations

import functools
import io
import posixpath
import struct
import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pricelens.llm.common import partitions, text_print
from pricelens.llm.units import UnitIds, runs
from pricelens.session import materialise, scratch_path

MAGIC = b"PFR1"
BLOCK, LANES = 512, 8
PERCENTILE = 95
HEAD = np.dtype([("low", "<u4"), ("width", "u1"), ("patched", "<u2"), ("count", "<u2")])
TRAILER = struct.Struct("<4Q4s")
#: Blocks packed or unpacked at a time, ids of a file, and ids that a reading task takes at least.
STEP, FILE_IDS, RUN_IDS = 256, 1 << 26, 1 << 22
#: Bytes of ids in a batch of rows.
BATCH_BYTES = 4 << 20
MANIFEST = "part int, seq int, path string, n_ids long, n_docs long, n_bytes long"


def _pack_rows(rows: np.ndarray, width: int) -> np.ndarray:
    """Rows of ``BLOCK`` numbers at ``width`` bits: slot by slot over lanes of 64-bit words."""
    slots = rows.reshape(len(rows), -1, LANES)
    words = np.zeros((len(rows), width, LANES), dtype="<u8")
    for s in range(slots.shape[1] if width else 0):
        k, shift = divmod(s * width, 64)
        words[:, k] |= slots[:, s] << np.uint64(shift)
        if shift + width > 64:
            words[:, k + 1] |= slots[:, s] >> np.uint64(64 - shift)
    return words


def _unpack_rows(words: np.ndarray, width: int) -> np.ndarray:
    slots = np.zeros((len(words), BLOCK // LANES, LANES), dtype=np.uint64)
    mask = np.uint64((1 << width) - 1)
    for s in range(slots.shape[1] if width else 0):
        k, shift = divmod(s * width, 64)
        value = words[:, k] >> np.uint64(shift)
        if shift + width > 64:
            value |= words[:, k + 1] << np.uint64(64 - shift)
        slots[:, s] = value & mask
    return slots.reshape(len(words), BLOCK)


def pack_blocks(ids: np.ndarray) -> tuple[bytes, np.ndarray]:
    """The blocks of some ids, the last one possibly short, and the size of each block in bytes."""
    n = -(-len(ids) // BLOCK)
    rows = np.zeros(n * BLOCK, dtype=np.uint64)
    rows[: len(ids)] = ids
    rows[len(ids) :] = ids[-1] if len(ids) else 0
    rows = rows.reshape(n, BLOCK)
    low = rows.min(axis=1, keepdims=True)
    rows -= low
    usual = np.partition(rows, -(-PERCENTILE * BLOCK // 100) - 1, axis=1)[:, -(-PERCENTILE * BLOCK // 100) - 1]
    width = np.frexp(usual.astype(np.float64))[1].astype(np.int64)  # bits of a whole number below 2**53
    high = rows >> width[:, None].astype(np.uint64)
    head = np.zeros(n, dtype=HEAD)
    head["low"], head["width"], head["patched"] = low[:, 0], width, (high > 0).sum(axis=1)
    head["count"] = np.minimum(BLOCK, len(ids) - BLOCK * np.arange(n))
    rows &= (np.uint64(1) << width.astype(np.uint64))[:, None] - np.uint64(1)
    patched = head["patched"].astype(np.int64)
    sizes = HEAD.itemsize + 8 * LANES * width + 6 * patched
    starts = np.cumsum(sizes) - sizes
    out = np.zeros(int(sizes.sum()), dtype=np.uint8)
    out[starts[:, None] + np.arange(HEAD.itemsize)] = head.view(np.uint8).reshape(n, -1)
    for w in np.unique(width):
        at = np.flatnonzero(width == w)
        packed = _pack_rows(rows[at], int(w)).reshape(len(at), -1).view(np.uint8)
        out[(starts[at] + HEAD.itemsize)[:, None] + np.arange(packed.shape[1])] = packed
    block, places = np.nonzero(high)
    lists = starts + HEAD.itemsize + 8 * LANES * width
    out[runs(lists, 2 * patched)] = places.astype("<u2").view(np.uint8)
    out[runs(lists + 2 * patched, 4 * patched)] = high[block, places].astype("<u4").view(np.uint8)
    return out.tobytes(), sizes


def unpack_blocks(data: bytes, starts: np.ndarray) -> np.ndarray:
    """The ids of consecutive blocks that begin at ``starts`` in ``data``."""
    raw = np.frombuffer(data, np.uint8)
    heads = raw[starts[:, None] + np.arange(HEAD.itemsize)].reshape(-1).view(HEAD)
    width, patched = heads["width"].astype(np.int64), heads["patched"].astype(np.int64)
    rows = np.zeros((len(starts), BLOCK), dtype=np.uint64)
    for w in np.unique(width):
        at, size = np.flatnonzero(width == w), 8 * LANES * int(w)
        words = raw[(starts[at] + HEAD.itemsize)[:, None] + np.arange(size)]
        rows[at] = _unpack_rows(words.reshape(-1).view("<u8").reshape(len(at), int(w), LANES), int(w))
    lists = starts + HEAD.itemsize + 8 * LANES * width
    block = np.repeat(np.arange(len(starts)), patched)
    places = raw[runs(lists, 2 * patched)].view("<u2")
    high = raw[runs(lists + 2 * patched, 4 * patched)].view("<u4")
    rows[block, places] |= high.astype(np.uint64) << width[block].astype(np.uint64)
    rows += heads["low"][:, None].astype(np.uint64)
    return rows[np.arange(BLOCK) < heads["count"][:, None].astype(np.int64)].astype("<u4")


class IdFileWriter:
    """Writes one file; whole steps of blocks leave at once, so memory does not grow with the file."""

    def __init__(self, sink, id_type: pa.DataType) -> None:
        self.sink, self.at = sink, sink.write(MAGIC) or len(MAGIC)
        self.id_type, self.docs, self.counts = id_type, [], []
        self.wait, self.waiting, self.sizes = [], 0, []
        self.n_ids = 0

    def add(self, doc_id, ids: bytes) -> None:
        """A document: its ids, the end id included, as 32-bit numbers."""
        self.docs.append(doc_id)
        self.counts.append(len(ids) // 4)
        self.n_ids += len(ids) // 4
        self.wait.append(ids)
        self.waiting += len(ids) // 4
        if self.waiting >= STEP * BLOCK:
            self._flush(self.waiting // BLOCK * BLOCK)

    def _flush(self, n: int) -> None:
        ids = np.frombuffer(b"".join(self.wait), "<u4")
        for at in range(0, n, STEP * BLOCK):
            data, sizes = pack_blocks(ids[at : min(n, at + STEP * BLOCK)])
            self.sink.write(data)
            self.sizes.append(sizes)
        self.wait, self.waiting = [ids[n:].tobytes()], len(ids) - n

    def close(self) -> int:
        """Writes the indexes and the trailer; the size of the file in bytes."""
        self._flush(self.waiting)
        sizes = np.concatenate([np.array([len(MAGIC)]), *self.sizes])
        starts = np.cumsum(sizes)
        self.sink.write(starts[:-1].astype("<u8").tobytes())
        table = pa.table({"doc_id": pa.array(self.docs, self.id_type), "n_tokens": pa.array(self.counts, pa.int64())})
        out = io.BytesIO()
        with pa.ipc.new_stream(out, table.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as stream:
            stream.write_table(table, max_chunksize=1 << 16)
        self.sink.write(out.getvalue())
        n, place = len(starts) - 1, int(starts[-1])
        self.sink.write(TRAILER.pack(self.n_ids, n, place, place + 8 * n, MAGIC))
        return place + 8 * n + len(out.getvalue()) + TRAILER.size


class IdFile:
    """Reads parts of one file."""

    def __init__(self, source) -> None:
        self.source, size = source, source.size()
        self.n_ids, self.n_blocks, self.place, self.docs_at, magic = TRAILER.unpack(self._bytes(size - TRAILER.size, size))
        if magic != MAGIC:
            raise ValueError("not a file of token ids")
        self.end = size - TRAILER.size

    def _bytes(self, start: int, end: int) -> bytes:
        self.source.seek(start)
        return self.source.read(end - start)

    def documents(self) -> pa.Table:
        return pa.ipc.open_stream(self._bytes(self.docs_at, self.end)).read_all()

    def ids(self, start: int, end: int) -> Iterator[np.ndarray]:
        """The ids from position ``start`` to before ``end``, in pieces of at most ``STEP`` blocks."""
        first, last = start // BLOCK, -(-end // BLOCK)
        starts = np.frombuffer(self._bytes(self.place + 8 * first, min(self.place + 8 * (last + 1), self.docs_at)), "<u8").astype(np.int64)
        if last == self.n_blocks:
            starts = np.append(starts, self.place)
        for at in range(first, last, STEP):
            here = starts[at - first : min(at + STEP, last) - first + 1]
            ids = unpack_blocks(self._bytes(int(here[0]), int(here[-1])), here[:-1] - here[0])
            yield ids[max(0, start - at * BLOCK) : end - at * BLOCK]


def _opened(path: str) -> tuple[pa.fs.FileSystem, str]:
    return pa.fs.FileSystem.from_uri(path)


@functools.lru_cache(maxsize=2)
def _library(source: str) -> UnitIds:
    return UnitIds(source)


def write_ids(docs: DataFrame, vocabulary: str, end_id: int, folder: str | None = None, file_ids: int = FILE_IDS) -> DataFrame:
    """Encodes and writes all rows; the manifest: ``part, seq, path, n_ids, n_docs, n_bytes, start``, one row a file.

    ``vocabulary`` is a file of the tokenizers library on the driver; its content (a few MB) is broadcast. ``folder``
    is a shared folder, by default a fresh one of this application. ``start`` counts the ids of all files before.
    """
    spark = docs.sparkSession
    folder = folder or scratch_path(spark, "token-ids")
    with open(vocabulary, encoding="utf-8") as file:
        source = spark.sparkContext.broadcast(file.read())
    system, place = _opened(folder)
    system.create_dir(place, recursive=True)
    end = struct.pack("<I", end_id)
    mark = text_print(F.col("text"))
    rows = docs.select("doc_id", "text", mark["a"].alias("pa"), mark["b"].alias("pb"), F.monotonically_increasing_id().alias("place"))
    keys = [F.col("doc_id").asc_nulls_first(), "pa", "pb", "place"]
    ordered = rows.repartitionByRange(partitions(spark), *keys).sortWithinPartitions(*keys).select("doc_id", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work, out, writer, path, seq = _library(source.value), None, None, "", 0
        system, place = _opened(folder)
        part = TaskContext.get().partitionId()

        def closed() -> pa.RecordBatch:
            size = writer.close()
            out.close()
            row = {"part": part, "seq": seq, "path": path, "n_ids": writer.n_ids, "n_docs": len(writer.docs), "n_bytes": size}
            kinds = (pa.int32(), pa.int32(), pa.string(), pa.int64(), pa.int64(), pa.int64())
            return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(row.values(), kinds, strict=True)], names=list(row))

        for batch in batches:
            texts = [t or "" for t in batch.column("text").to_pylist()]
            for doc_id, ids in zip(batch.column("doc_id").to_pylist(), work.of(texts), strict=True):
                if writer is None:
                    name = f"ids-{part:06d}-{seq:04d}-{uuid.uuid4().hex}.pfr"
                    path = posixpath.join(folder, name)
                    out = system.open_output_stream(posixpath.join(place, name))
                    writer = IdFileWriter(out, batch.schema.field("doc_id").type)
                writer.add(doc_id, ids + end)
                if writer.n_ids >= file_ids:
                    yield closed()
                    writer, seq = None, seq + 1
        if writer is not None:
            yield closed()

    manifest = materialise(ordered.mapInArrow(run, MANIFEST), "token-manifest")
    before = Window.orderBy("part", "seq").rowsBetween(Window.unboundedPreceding, -1)  # a row a file
    return manifest.withColumn("start", F.coalesce(F.sum("n_ids").over(before), F.lit(0)))


def read_ids(spark: SparkSession, manifest: DataFrame, id_type: str = "bigint") -> DataFrame:
    """``doc_id, start, n_tokens, ids`` of every document of the files; ``ids`` are 32-bit little-endian numbers."""
    parts = F.sequence(F.lit(0), F.greatest(F.lit(0), ((F.col("n_ids") - 1) / RUN_IDS).cast("int")))
    tasks = manifest.select("path", "start", F.explode(parts).alias("run")).repartition(partitions(spark), "path", "run")

    def run(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for frame in frames:
            for row in frame.to_pylist():
                yield from of_run(row)

    def of_run(row: dict) -> Iterator[pa.RecordBatch]:
        system, place = _opened(row["path"])
        with system.open_input_file(place) as source:
            file = IdFile(source)
            docs = file.documents()
            counts = docs.column("n_tokens").to_numpy()
            ends = np.cumsum(counts)
            starts = ends - counts
            first, last = np.searchsorted(starts, [row["run"] * RUN_IDS, (row["run"] + 1) * RUN_IDS])
            while first < last:  # as many documents as fill a batch, one at least
                stop = max(first + 1, int(np.searchsorted(ends, starts[first] + BATCH_BYTES // 4, side="right")))
                stop = min(stop, int(last))
                data = b"".join(x.tobytes() for x in file.ids(int(starts[first]), int(ends[stop - 1])))
                cuts = (4 * (np.append(starts[first:stop], ends[stop - 1]) - starts[first])).astype(np.int32)
                ids = pa.Array.from_buffers(pa.binary(), stop - first, [None, pa.py_buffer(cuts), pa.py_buffer(data)])
                doc_ids = docs.column("doc_id").slice(first, stop - first).combine_chunks()
                yield pa.RecordBatch.from_arrays(
                    [doc_ids, pa.array(row["start"] + starts[first:stop]), pa.array(counts[first:stop]), ids],
                    names=["doc_id", "start", "n_tokens", "ids"],
                )
                first = stop

    return tasks.mapInArrow(run, f"doc_id {id_type}, start bigint, n_tokens bigint, ids binary")


def read_window(spark: SparkSession, manifest: DataFrame, start: int, length: int) -> DataFrame:
    """``start, ids``: the ids from position ``start`` of the whole token stream on, in the pieces that the files hold."""
    stop = start + length
    wanted = manifest.where((F.col("start") < stop) & (F.col("start") + F.col("n_ids") > start)).select("path", "start", "n_ids")

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for row in frame.itertuples():
                system, place = _opened(row.path)
                with system.open_input_file(place) as source:
                    at = max(0, start - row.start)
                    for ids in IdFile(source).ids(at, min(row.n_ids, stop - row.start)):
                        yield pd.DataFrame({"start": [row.start + at], "ids": [ids.tobytes()]})
                        at += len(ids)

    return wanted.mapInPandas(run, "start long, ids binary")
