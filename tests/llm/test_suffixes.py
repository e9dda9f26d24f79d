import random
from collections import Counter

import pytest

from pricelens.llm import suffixes
from pricelens.llm.suffixes import bwt_repeats, without_repeats
from pricelens.session import materialise


def brute(texts, length):
    data = [(t or "").encode() for t in texts]
    seen = Counter(d[i : i + length] for d in data for i in range(len(d) - length + 1))
    out = []
    for d in data:
        gone = bytearray(len(d))
        for i in range(len(d) - length + 1):
            if seen[d[i : i + length]] > 1:
                gone[i : i + length] = b"\1" * length
        spans = sum(1 for i in range(len(d)) if gone[i] and (i == 0 or not gone[i - 1]))
        out.append((len(d), sum(gone), spans, bytes(b for b, g in zip(d, gone, strict=True) if not g)))
    return out


def texts():
    draw = random.Random(8)
    prose = lambda n: "".join(draw.choice("abcdé \n") for _ in range(n))
    passage, out = prose(300), [None, "", "short", "ab" * 900, "z" * 1000, prose(400)]
    for _ in range(60):
        body = prose(draw.randint(0, 400))
        out.append(body + (passage[draw.randint(0, 80) :] if draw.random() < 0.7 else "") + prose(draw.randint(0, 300)))
    near = list(prose(900))
    for _ in range(6):
        near[draw.randrange(900)] = "#"
        out.append("".join(near))
    return [*out, out[7], out[7], out[8]]


@pytest.mark.parametrize("most", [2_000, 3])
def test_removed_bytes_like_brute_force(spark, monkeypatch, most):
    monkeypatch.setattr(suffixes, "NAME_SEGMENTS", most)
    monkeypatch.setattr(suffixes, "BUCKET_BYTES", 4_000)
    rows = texts()
    df = spark.createDataFrame([(i if i % 9 else None, t, i) for i, t in enumerate(rows)], "doc_id long, text string, n int")
    got = without_repeats(df, length=60).collect()
    seen = sorted((r.n_bytes, sum(s.end - s.start for s in r.spans), len(r.spans), bytes(r.kept)) for r in got)
    assert seen == sorted(brute(rows, 60))
    assert without_repeats(df.limit(0), length=60).count() == 0


def test_column_wise_bwt_finds_all_repeats():
    draw = random.Random(2)
    segments = list({bytes(draw.choice(b"ab") for _ in range(draw.randint(5, 40))) for _ in range(50)})
    seen = Counter(s[i : i + 8] for s in segments for i in range(len(s) - 7))
    for s, hit in zip(segments, bwt_repeats(segments, 8), strict=True):
        assert hit.tolist() == [seen[s[i : i + 8]] > 1 for i in range(len(s) - 7)]


@pytest.mark.parametrize("width", [8, 16, 32])
def test_wide_symbols_find_all_repeats(monkeypatch, width):
    monkeypatch.setattr(suffixes, "WIDTH", width)
    draw = random.Random(width)
    for length in (1, 7, 16, 33):
        base = bytes(draw.choice(b"ab\0") for _ in range(90))
        segments = list({base[draw.randint(0, 40) : draw.randint(41, 90)] + bytes(draw.choice(b"abc\0") for _ in range(draw.randint(length, length + 40))) for _ in range(40)})
        seen = Counter(s[i : i + length] for s in segments for i in range(len(s) - length + 1))
        for s, hit in zip(segments, bwt_repeats(segments, length), strict=True):
            assert hit.tolist() == [seen[s[i : i + length]] > 1 for i in range(len(s) - length + 1)]


def test_a_round_passes_over_several_bytes(monkeypatch):
    rounds, plain = [], suffixes.np.bincount
    monkeypatch.setattr(suffixes.np, "bincount", lambda *a, **k: (rounds.append(1), plain(*a, **k))[1])
    draw = random.Random(6)
    text = bytes(draw.choice(b"abcd") for _ in range(799))
    assert [h.sum() for h in bwt_repeats([text, b"x" + text[100:700]], 400)] == [201, 201]
    assert len(rounds) <= 799 // 8 + 2


def test_only_names_with_too_many_segments_are_named_anew(spark, monkeypatch):
    asked = []
    monkeypatch.setattr(suffixes, "materialise", lambda df, name: (asked.append(name), materialise(df, name))[1])
    df = spark.createDataFrame(list(enumerate(texts())), "doc_id long, text string")
    assert without_repeats(df, length=60).count() == len(texts())
    assert "renamed" not in asked
