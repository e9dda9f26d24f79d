import io
import random
import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from pricelens.llm import token_files as T
from pricelens.llm.queries import QUERIES
from pricelens.llm.units import UnitIds, units

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(VOCABULARY)


def expected(library, rows):
    """Rows in order of id (null first): id, start, tokens with the end id, crc32 of the ids."""
    out, at = [], 0
    for doc_id, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 2]
        out.append((doc_id, at, len(ids), zlib.crc32(np.array(ids, dtype="<u4").tobytes())))
        at += len(ids)
    return out


@pytest.mark.parametrize("n", [1, 511, 512, 513, 5_000])
def test_blocks_round_trip(n):
    draw = np.random.default_rng(n)
    for ids in (draw.integers(0, 50_257, n), np.full(n, 7), draw.integers(0, 2**32, n), np.where(draw.random(n) < 0.02, 2**32 - 1, draw.integers(5, 9, n))):
        data, sizes = T.pack_blocks(ids.astype("<u4"))
        assert sizes.sum() == len(data)
        assert (T.unpack_blocks(data, np.cumsum(sizes) - sizes) == ids).all()


def test_width_is_the_percentile_and_the_rest_are_exceptions():
    ids = np.full(T.BLOCK, 100, dtype="<u4")
    ids[:200] += 3
    ids[[5, 77]] = 50_000
    data, sizes = T.pack_blocks(ids)
    head = np.frombuffer(data, T.HEAD, 1)[0]
    assert (head["low"], head["width"], head["patched"], head["count"]) == (100, 2, 2, T.BLOCK)
    assert len(data) == T.HEAD.itemsize + T.BLOCK * 2 // 8 + 2 * 2 + 2 * 4


def test_any_part_of_a_file_is_read_by_its_index():
    draw = np.random.default_rng(3)
    out = io.BytesIO()
    writer, all_ids = T.IdFileWriter(out, pa.int64()), []
    for doc in range(40):
        ids = draw.integers(0, 60_000, int(draw.choice([1, 3, 700, 9_000]))).astype("<u4")
        writer.add(doc if doc else None, ids.tobytes())
        all_ids.append(ids)
    assert writer.close() == len(out.getvalue())
    whole, file = np.concatenate(all_ids), T.IdFile(pa.BufferReader(out.getvalue()))
    assert file.n_ids == len(whole) and file.documents().column("doc_id").to_pylist() == [None, *range(1, 40)]
    for _ in range(50):
        a, b = sorted(draw.integers(0, len(whole) + 1, 2))
        assert (np.concatenate([np.zeros(0, "<u4"), *file.ids(int(a), int(b))]) == whole[a:b]).all()
    with pytest.raises(ValueError):
        T.IdFile(pa.BufferReader(out.getvalue()[:-1] + b"x"))


def test_units_are_encoded_like_whole_texts(library, monkeypatch):
    monkeypatch.setattr("pricelens.llm.units.HELD", 40)
    draw, work = random.Random(2), UnitIds(open(VOCABULARY, encoding="utf-8").read())
    pool = ["a", "Zz", " ", "  ", "\n", "\t", "é", "漢", "\U0001f600", "1", ".", "'s", " ", "\x1f", "́", "<|endoftext|>", "​", "\x85"]
    texts = ["".join(draw.choice(pool) for _ in range(draw.randint(0, 30))) for _ in range(3_000)]
    texts += ["", "a" * 30_000, " " * 3_000 + "x", "word " * 4_000, "one two", "one two"]
    assert all("".join(units(t)) == t for t in texts)
    for text, ids in zip(texts, work.of(texts), strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == library.encode(text, add_special_tokens=False).ids


def test_odd_rows_and_clashing_columns(spark, library, monkeypatch):
    monkeypatch.setattr(T, "RUN_IDS", 1_000)
    rows = [(9, None), (3, ""), (None, "no id"), (4, "tie one"), (4, "tie two"), (7, "same"), (7, "same"), (1, "long text, " * 5_000), (2, "<|endoftext|> é\U0001f600"), (8, "x" * 20_000)]
    docs = spark.createDataFrame([(i, t, 1, "p", "i") for i, t in rows], "doc_id long, text string, start int, path string, ids string")
    manifest = T.write_ids(docs, VOCABULARY, end_id=2, file_ids=2_000)
    assert manifest.count() > 2
    got = T.read_ids(spark, manifest).toPandas().sort_values("start")
    mine = [(None if pd.isna(r.doc_id) else int(r.doc_id), r.start, r.n_tokens, zlib.crc32(r.ids)) for r in got.itertuples()]
    want, swapped = expected(library, rows), expected(library, [*rows[:3], rows[4], rows[3], *rows[5:]])
    assert mine in (want, swapped)  # the two texts of one id come in the order of their prints
    whole = b"".join(got.ids)
    for start, length in ((0, 10), (1_990, 9_000), (0, len(whole) // 4 + 50)):
        pieces = T.read_window(spark, manifest, start, length).toPandas().sort_values("start")
        assert b"".join(pieces.ids) == whole[4 * start : 4 * (start + length)]
    empty = T.write_ids(docs.limit(0), VOCABULARY, end_id=2)
    assert T.read_ids(spark, empty).count() == 0


def test_query_like_the_library(spark, library):
    docs = pd.read_parquet("/root/testdata/sf0.001/documents.parquet")
    got = QUERIES["op13_token_files"](spark, "/root/testdata/sf0.001").toPandas().sort_values("doc_id")
    assert list(got.itertuples(index=False, name=None)) == expected(library, list(zip(docs.doc_id, docs.text, strict=True)))
