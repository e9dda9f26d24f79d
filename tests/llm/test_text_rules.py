import hashlib
import re

import pytest

from pricelens.llm.lines import kept_text, with_bitmaps
from pricelens.llm.quality import PHRASES, line_quality
from tests.llm.brute import LOWER, WORD

SPACES = " \t\n\x0b\f\r"
PROSE = "The river runs slowly past the old mill and the children play near the water every day."
TEXTS = [
    None, "", " \n \t\n", PROSE, "\n".join([PROSE.replace("river", f"river {i}") for i in range(6)]),
    "\n".join(["Home | About | Contact", *[PROSE.replace("mill", f"mill {i}") for i in range(4)], "All rights reserved."]),
    "\n".join([f"one {i} | two | three" for i in range(40)]), "The " * 200 + ".", "\n".join([PROSE] * 5), "a### b$$$ c*** " * 60,
    "WOW!! NOW!! BUY!! " * 30, "\n".join(f"w{i}a!! w{i}b." for i in range(40)), "\n".join(f"w{i}a!! w{i}b w{i}c." for i in range(40)), "wordé\U0001f600 " * 3 + ".", PROSE + "\n\n" + PROSE.lower() + "\r\n" + PROSE, "x" * 300_000, ("q w e r t y " * 30_000) + ".",
]


def quality_row(text, max_loss=0.3):
    text = text or ""
    words = WORD.findall(text)
    windows = {}
    for i in range(len(words) - 2):
        windows.setdefault(tuple(words[i : i + 3]), []).append(i)
    covered = {i + o for at in windows.values() if len(at) > 1 for i in at for o in (0, 1, 2)}
    lines = [x for x in text.split("\n") if x.strip(SPACES)]
    lost = total = 0
    for line in lines:
        core = line.strip(SPACES)
        n = len(re.sub("[^\x20\x09-\x0d]+", "", core)) + 1
        fails = (
            core[-1] not in ".!?:;…\"'”»)]" or 2 * (core.count("!!") + core.count("??")) >= n or sum(map(core.count, "|»›•·")) >= 2
            or any(p in core.lower() for p in PHRASES) or sum(map(core.count, "#*$%&|<>")) > n
        )
        total += len(core)
        lost += len(core) * fails
    base = len(words) < 50 or 100 * len(covered) > 50 * len(words)
    return (
        len(words), sum(map(len, words)), sum(map(text.count, "#*$%&|<>")), len(lines) - len(set(lines)), len(covered), base,
        not base and total - lost >= (1 - max_loss) * total,
    )


def test_quality_like_brute_force(spark):
    df = spark.createDataFrame([(None if i == 3 else i, t, True, "w") for i, t in enumerate([*TEXTS, TEXTS[4]])], "doc_id long, text string, kept boolean, w string")
    got = line_quality(df).select("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept").collect()
    assert [tuple(r) for r in got] == [quality_row(t) for t in [*TEXTS, TEXTS[4]]]
    assert line_quality(df, keep_columns=True).columns == [*df.columns, "__kept", "__cleaned"]
    assert "Home" not in line_quality(df).where("doc_id = 5").first().cleaned
    assert line_quality(df.limit(0)).count() == 0


def line_rows(rows, min_chars=20, min_docs=3):
    key = lambda line: line.strip(SPACES).translate(LOWER)
    holders = {}
    for doc, text in rows:
        for line in (text or "").split("\n"):
            if len(key(line)) >= min_chars:
                holders.setdefault(key(line), set()).add(-1 if doc is None else doc)
    out = []
    for doc, text in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if len(holders.get(key(x), ())) < min_docs or max(holders[key(x)]) == (-1 if doc is None else doc)]
        out.append((doc, len(lines) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest()))
    return sorted(out, key=str)


def test_line_dedup_like_brute_force(spark):
    common = "this is a line that many documents share"
    rows = [(i, f"head {i}\n  {common.upper() if i % 2 else common}\t\nshort\n{common}") for i in range(40)]
    rows += [(100, None), (101, ""), (102, "\n\n"), (None, common), (7, common), (7, common), (103, f"{common}É\n" * 3), (104, f"{common}é"), (105, f"{common}É"), (106, f"{common}É")]
    rows += [(107, "\n".join(f"a long enough line {i % 50}" for i in range(20_000))), (108, "\n".join(f"a long enough line {i}" for i in range(50))), (109, "a long enough line 7")]
    df = spark.createDataFrame([(d, t, "x") for d, t in rows], "doc_id long, text string, pos string")
    mapped = with_bitmaps(df)
    assert mapped.columns == [*df.columns, "__gaps"]
    got = mapped.selectExpr("doc_id", "text", "coalesce(size(__gaps), 0) AS n", "__gaps").withColumn("kept", kept_text(df["text"], mapped["__gaps"])).collect()
    seen = sorted(((r.doc_id, r.n, hashlib.sha256((r.kept or "").encode()).hexdigest()) for r in got), key=str)
    assert seen == line_rows(rows)
    assert with_bitmaps(df.limit(0)).count() == 0


@pytest.mark.parametrize("gaps,kept", [(None, "a\nb\nc"), ([0], "b\nc"), ([2], "a\nb"), ([0, 0, 0], ""), ([1], "a\nc")])
def test_bitmaps_decode(spark, gaps, kept):
    df = spark.createDataFrame([("a\nb\nc", gaps)], "text string, gaps array<int>")
    assert df.select(kept_text(df.text, df.gaps)).first()[0] == kept
