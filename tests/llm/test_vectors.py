import math

import numpy as np
from pyspark.sql import functions as F

from pricelens.llm.vectors import near_vectors


def brute(rows, cosine):
    ids = [i for i, _ in rows]
    good = [v is not None and len(v) > 0 and all(x is not None and math.isfinite(x) for x in v) and any(v) for _, v in rows]
    links = {k: set() for k in range(len(rows))}
    for p in range(len(rows)):
        for q in range(p):
            if good[p] and good[q] and len(rows[p][1]) == len(rows[q][1]):
                a, b = np.array(rows[p][1], float), np.array(rows[q][1], float)
                if a @ b / np.linalg.norm(a) / np.linalg.norm(b) >= cosine:
                    links[p].add(q)
                    links[q].add(p)
    out = []
    for p in range(len(rows)):
        seen, todo = {p}, [p]
        while todo:
            for q in links[todo.pop()] - seen:
                seen.add(q)
                todo.append(q)
        low = min(ids[q] for q in seen)
        out.append((ids[p], len(links[p]), low, ids[p] == low))
    return sorted(out)


def test_links_like_brute_force_with_copies_chains_and_bad_vectors(spark, monkeypatch):
    monkeypatch.setattr("pricelens.llm.vectors.INTERVAL", 40)
    monkeypatch.setattr("pricelens.llm.vectors.BLOCK", 16)
    draw = np.random.default_rng(3)
    centres = draw.normal(size=(12, 8))
    rows = [(i, [float(x) for x in np.float32(centres[i % 12] + draw.normal(size=8) * 0.25)]) for i in range(400)]
    rows += [(400 + i, rows[7][1]) for i in range(60)]
    rows += [(500, None), (501, [0.0] * 8), (502, [float("nan")] * 8), (503, [None] + [1.0] * 7), (504, []), (505, [1.0, 2.0]), (506, [2.0, 4.0]), (507, [float("inf")] * 8)]
    df = spark.createDataFrame([(i, v, "x") for i, v in rows], "vec_id long, embedding array<float>, n string")
    assert sorted(map(tuple, near_vectors(df).collect())) == brute(rows, 0.95)
    assert near_vectors(df.limit(0)).count() == 0


def test_rows_without_an_id_and_clashing_columns(spark):
    rows = [(None, [1.0, 0.0], 1), (None, [2.0, 0.0], 1), (5, [0.0, 1.0], 1), (None, [0.0, 3.0], 1), (6, [1.0, 1.0], 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, component_id int").withColumn("n_links", F.lit("x"))
    got = sorted(map(tuple, near_vectors(df).collect()), key=str)
    assert got == sorted([(None, 1, None, True), (None, 1, None, True), (5, 1, 5, True), (None, 1, 5, False), (6, 0, 6, True)], key=str)
