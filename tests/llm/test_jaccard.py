import random

import pandas as pd

from pricelens.llm.jaccard import near_duplicates
from tests.llm.brute import jaccard_components


def order(rows):
    return sorted(rows, key=str)


def test_components_like_brute_force(spark, monkeypatch):
    monkeypatch.setattr("pricelens.llm.jaccard.CHUNK_BYTES", 20_000)
    draw = random.Random(4)
    vocabulary = [f"w{i}" for i in range(400)]
    base = [[draw.choice(vocabulary) for _ in range(draw.randint(3, 120))] for _ in range(40)]
    passage = [draw.choice(vocabulary) for _ in range(40)]
    rows = []
    for i in range(300):
        words = list(base[min(draw.randrange(60), 39)])
        for _ in range(draw.randrange(4)):
            words[draw.randrange(len(words))] = draw.choice(vocabulary)
        if draw.random() < 0.3:
            words += passage
        rows.append((i, " ".join(w.upper() if draw.random() < 0.1 else w for w in words)))
    rows += [(1000, None), (1001, ""), (1002, " \n\t "), (1003, "one two"), (1004, "ONE\ttwo"), (5, rows[5][1]), (5, "other text here now"), (None, "lonely words of a row without id"), (1005, "x " * 5000)]
    rows += [(2000 + i, rows[9][1]) for i in range(50)]
    df = spark.createDataFrame([(i, t, "k") for i, t in rows], "doc_id long, text string, chunk string")
    got = near_duplicates(df, n=4, per_cent=85).select("doc_id", "n_shingles", "component_id").collect()
    assert order(map(tuple, got)) == order(jaccard_components(rows, 4, 85))
    assert near_duplicates(df.limit(0)).count() == 0


def test_test_documents_like_brute_force(spark):
    docs = pd.read_parquet("/root/testdata/sf0.001/documents.parquet")
    got = near_duplicates(spark.createDataFrame(docs[["doc_id", "text"]]), n=5, per_cent=80).select("doc_id", "n_shingles", "component_id").collect()
    assert order(map(tuple, got)) == order(jaccard_components(list(zip(docs.doc_id, docs.text, strict=True)), 5, 80))
