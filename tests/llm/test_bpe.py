import random

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from pricelens.llm.bpe import Transducer, decode, encode

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(VOCABULARY)


@pytest.fixture(scope="module")
def work():
    return Transducer(open(VOCABULARY, encoding="utf-8").read())


def same(library, work, text):
    ids = library.encode(text, add_special_tokens=False).ids
    assert work.encode(text) == (",".join(map(str, ids)), len(ids))


def test_buffer_is_bounded_by_the_merge_list(work):
    assert 0 < work.ahead < 5_000


def test_long_pieces_stream_like_the_library(library, work):
    draw = random.Random(5)
    for alphabet in ("ab", "the", "-=", "aeiouthnsr", " ", "éa漢", "0123456789"):
        for _ in range(3):
            same(library, work, "".join(draw.choice(alphabet) for _ in range(work.buffer * 3)))
    same(library, work, "a" * 20_000)
    same(library, work, "=" * 9_999 + "\n" * 5_000 + "x")


def test_pieces_that_recur_are_not_merged_again(library, work, monkeypatch):
    from pricelens.llm import bpe

    monkeypatch.setattr(bpe, "MEMO_PIECES", 10)
    monkeypatch.setattr(work, "memo", {})
    monkeypatch.setattr(work, "older", {}, raising=False)
    merged, plain = [], work.merged
    monkeypatch.setattr(work, "merged", lambda data: (merged.append(data), plain(data))[1])
    for i in range(40):
        same(library, work, f" often{' often'.join(f' rare{chr(97 + i % 26)}{chr(97 + j)}' for j in range(4))}")
    assert merged.count(b" often") == 1 and len(work.memo) <= 10 and len(work.older) <= 10


def test_every_space_and_letter_class_splits_like_the_library(library, work):
    points = [*range(0xD800), *range(0xE000, 0x11000), *range(0x1F300, 0x1F700)]
    for start in range(0, len(points), 512):
        same(library, work, "".join(f"a{chr(p)}{chr(p)} b" for p in points[start : start + 512]))


def test_round_trip_of_nulls_empty_specials_and_extra_columns(spark, library):
    texts = [None, "", "a<|endoftext|>b", "  two  spaces \n\n x's", "é\U0001f600", "same", "same", "x" * 30_000]
    docs = spark.createDataFrame([(i, t, i, "z") for i, t in enumerate(texts)], "doc_id long, text string, ids int, decoded string")
    got = {r.doc_id: r for r in decode(encode(docs, VOCABULARY), VOCABULARY).collect()}
    for i, text in enumerate(texts):
        ids = library.encode(text or "", add_special_tokens=False).ids
        assert got[i].ids == ",".join(map(str, ids)) and got[i].n_tokens == len(ids)
        assert got[i].decoded == library.decode(ids, skip_special_tokens=False)
    assert decode(encode(docs.limit(0), VOCABULARY), VOCABULARY).count() == 0


def test_decoder_replaces_broken_bytes_like_the_library(spark, library):
    broken = [[172, 173, 100], [188, 5, 222], list(range(94, 260))]
    rows = spark.createDataFrame([(i, len(x), ",".join(map(str, x))) for i, x in enumerate(broken)], "doc_id long, n_tokens long, ids string")
    got = {r.doc_id: r.decoded for r in decode(rows, VOCABULARY).collect()}
    for i, ids in enumerate(broken):
        assert got[i] == library.decode(ids, skip_special_tokens=False)
