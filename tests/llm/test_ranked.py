import math
import random
import re
from collections import Counter

import numpy as np
import pandas as pd
import pytest

from pricelens.llm import ranked as R
from pricelens.llm.queries import QUERIES

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms(text):
    return TERM.findall((text or "").translate(LOWER))


def plain(docs, items, k):
    """Scores of every document for every item, by the formula."""
    counted = [(d, Counter(terms(t))) for d, t in docs]
    lengths = [sum(c.values()) for _, c in counted]
    n_texts, n_terms = sum(n > 0 for n in lengths), sum(lengths)
    df = Counter(t for _, c in counted for t in c)
    out = []
    for item_id, text in items:
        found = []
        for place, ((doc, c), n) in enumerate(zip(counted, lengths, strict=True)):
            m = 50 + (50 * n * n_texts // n_terms if n_terms else 0)
            score = sum(
                math.floor(1000 * math.log((2 * n_texts + 2) / (2 * df[t] + 1))) * (1_000_000_000 * c[t] // (1000 * c[t] + 20 * m))
                for t in set(terms(text)) if c[t]
            )
            if score > 0:
                found.append((-score, doc is None, doc or 0, place, doc))
        out += [(item_id, r, doc, -s) for r, (s, _, _, _, doc) in enumerate(sorted(found)[:k], 1)]
    return out


def order(rows):
    return sorted(rows, key=str)


def test_terms_are_maximal_runs(spark):
    texts = ["Ab-c d_E9", "über ÜBER\x7fx", "", None, "a\nb\tc漢字 漢", "x" * 50 + " y", "'", "\x00a\x00"]
    got = spark.createDataFrame([(t,) for t in texts], "text string").select(R.term_array("text")).collect()
    for text, row in zip(texts, got, strict=True):
        assert row[0] == terms(text) == [w.decode() for part in R.terms_of(text or "") for w in part]


def test_long_texts_are_split_slice_by_slice(monkeypatch):
    monkeypatch.setattr(R, "SLICE_BYTES", 7)
    text = " ".join(f"Wörd{i}" for i in range(200)) + "z" * 50
    assert [w.decode() for part in R.terms_of(text) for w in part] == terms(text)


def test_blocks_hold_similar_rows_and_every_row_once():
    draw = np.random.default_rng(1)
    centres = draw.normal(size=(5, 8)).astype(np.float32)
    kind = draw.integers(0, 5, 500)
    rows = centres[kind] + 0.01 * draw.normal(size=(500, 8)).astype(np.float32)
    placed, sizes = R.cluster(rows / np.linalg.norm(rows, axis=1, keepdims=True))
    assert sorted(placed) == list(range(500)) and sizes.sum() == 500 and sizes.max() <= R.BLOCK
    pure = [len(set(kind[part])) == 1 for part in np.split(placed, np.cumsum(sizes)[:-1])]
    assert np.mean(pure) >= 0.75


@pytest.fixture(scope="module")
def corpus():
    draw = random.Random(8)
    words = [f"w{i}" for i in range(300)]
    pick = lambda n: [words[int(draw.paretovariate(0.6)) % 300] for _ in range(n)]
    texts = [" ".join(pick(draw.randint(1, 60))) for _ in range(900)]
    texts += [texts[5]] * 90 + [texts[7] + " extra"] * 30 + [None, "", "- -", "the the " * 4_000, "ONE Two", "é É"]
    docs = [(i, t) for i, t in enumerate(texts)] + [(None, texts[5]), (3, "w1 w2 w3"), (3, "w1 w2 w3"), (2**60, "w299 w298")]
    items = [(i, " ".join(pick(draw.randint(1, 25)))) for i in range(25)] + [(100, None), (101, ""), (102, "unseen"), (103, texts[5]), (103, "w1"), (None, "W2, w2; w298"), (104, "é")]
    return docs, items


@pytest.mark.parametrize("blocks_of_items", [1, 4])
def test_like_brute_force(spark, monkeypatch, corpus, blocks_of_items):
    docs, items = corpus
    monkeypatch.setattr(R, "SHARD_BYTES", 20_000)
    monkeypatch.setattr(R, "EXPANDED", 5_000)
    monkeypatch.setattr(R, "ITEM_BYTES", max(1, sum(len(t or "") for _, t in items) // blocks_of_items))
    left = spark.createDataFrame([(d, t, 1, 2) for d, t in docs], "doc_id long, text string, shard int, score int").repartition(3)
    right = spark.createDataFrame([(i, t, 1) for i, t in items], "item_id int, text string, item int")
    got = R.rank(left, right, k=10).select("item_id", "rank", "doc_id", "score").collect()
    assert order(map(tuple, got)) == order(plain(docs, items, 10))


def test_empty_tables(spark, corpus):
    docs = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    items = spark.createDataFrame([(1, "a")], "item_id long, text string")
    assert R.rank(docs.limit(0), items).count() == 0 and R.rank(docs, items.limit(0)).count() == 0
    assert [tuple(r) for r in R.rank(docs, items).collect()] == plain([(1, "a b")], [(1, "a")], 50)


def test_blocks_are_skipped(spark, monkeypatch):
    monkeypatch.setattr(R, "SHARD_BYTES", 100_000)
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    items = spark.read.parquet("/root/testdata/sf0.01/benchmark.parquet")
    row = R.rank(docs, items, k=5, work=True).groupBy().sum("held", "scored").first()
    assert row[1] < 0.5 * row[0]


def test_query_like_brute_force(spark):
    folder = "/root/testdata/sf0.001"
    docs, items = (pd.read_parquet(f"{folder}/{t}.parquet") for t in ("documents", "benchmark"))
    got = QUERIES["op11_ranked_search"](spark, folder).select("item_id", "rank", "doc_id", "score").collect()
    want = plain(list(zip(docs.doc_id.tolist(), docs.text, strict=True)), list(zip(items.item_id.tolist(), items.text, strict=True)), 50)
    assert order(map(tuple, got)) == order(want)
