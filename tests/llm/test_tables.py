import random
import zlib

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from pricelens.llm.components import components
from pricelens.llm.mixing import MARGINALS, calibrated, marginal_shares, mix, rake, tempered_targets
from pricelens.llm.shards import ROW_BYTES, kd_shards, metadata


def test_shards_are_balanced_gapless_and_complete(spark):
    rows = [(i, "word " * (i % 50), "hot" if i % 3 else f"s{i % 7}", "en", 1) for i in range(3_000)]
    rows += [(5, "same text", "hot", None, 2)] * 500 + [(None, None, None, None, 3), (9_999, "é" * 10, "s1", "de", 4)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string, slot int")
    got = kd_shards(df, shards=7).toPandas()
    assert len(got) == len(rows) and sorted(got.shard.unique()) == list(range(7))
    assert sorted(got["size"]) == sorted(len((r[1] or "").encode()) + 8 for r in rows)
    assert sorted(got.text_crc32) == sorted(zlib.crc32((r[1] or "").encode()) for r in rows)
    sums = got.groupby("shard")["size"].sum()
    assert sums.max() - sums.min() <= 4 * 260
    assert all(sorted(x) == list(range(len(x))) for _, x in got.groupby("shard").slot)
    assert kd_shards(df, target_bytes=int(got["size"].sum()) + 1).select("shard").distinct().count() == 1
    assert kd_shards(df.limit(0), shards=4).count() == 0


def brute_rake(cells, goals, rounds=400):
    w = cells["tokens"].astype(float)
    for _ in range(rounds):
        for m in MARGINALS:
            w = w * (cells[m].map(goals[m]) / w.groupby(cells[m]).transform("sum"))
    return w


def test_raking_like_brute_force_and_calibration(spark):
    draw = np.random.default_rng(2)
    rows = [(f"=s{a}", f"=l{b}", f"=t{c}", int(draw.integers(1, 1000))) for a in range(5) for b in range(3) for c in range(3) if draw.random() < 0.9]
    cells = pd.DataFrame(rows, columns=[*MARGINALS, "tokens"])
    df = spark.createDataFrame(cells)
    tables = {m: tempered_targets(df, m) for m in MARGINALS}
    goals = {m: t.toPandas().set_index(m)["goal"] for m, t in tables.items()}
    assert all(g.sum() == pytest.approx(1) for g in goals.values())
    got = cells.merge(rake(df, tables).toPandas(), on=[*MARGINALS, "tokens"])
    assert np.allclose(got.weight, brute_rake(cells, goals), rtol=1e-4)
    for budget in (0.1, 0.8, 1.0):
        p = calibrated(spark.createDataFrame(got), budget).toPandas()
        assert p.probability.between(0, 1).all() and (p.probability * p.tokens).sum() == pytest.approx(budget * p.tokens.sum(), rel=1e-6)


def test_values_without_a_goal_and_goals_that_conflict(spark):
    rows = [(i, "one two three " * (1 + i % 9), ["a", "b", "c"][i % 3], "en" if i % 3 else "de") for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string")
    goals = lambda m, **g: spark.createDataFrame([(f"={k}", v) for k, v in g.items()], f"{m} string, goal double")
    targets = {"source": goals("source", a=3.0, b=1.0, absent=5.0), "lang": goals("lang", de=1.0, en=9.0)}
    got = mix(docs, targets).toPandas()
    assert len(got) == 300 and not got[got.source == "c"].__kept.any() and (got[got.source == "c"].__probability == 0).all()
    # all of source a is German: 3 to 1 and 1 to 9 can't both hold
    cells = got.groupby(["__source", "__lang", "__topic"], as_index=False).__tokens.sum().rename(columns=lambda c: c.removeprefix("__"))
    shares = marginal_shares(rake(spark.createDataFrame(cells), targets), targets).toPandas().set_index(["marginal", "value"])
    assert shares.loc[("source", "=c"), "share"] == 0 and abs(shares.loc[("lang", "=de"), "share"] - 0.1) < 1e-6
    assert abs(shares.loc[("source", "=a"), "share"] - shares.loc[("source", "=a"), "goal"]) > 0.1 and abs(shares.goal.sum() - 2) < 1e-9


def test_mixing_of_nulls_missing_columns_and_repeated_rows(spark):
    rows = [(i, "some words here" * (i % 9), "a" if i % 3 else None, None, "x") for i in range(300)] + [(None, None, "a", "en", "y")] + [(4, "", "b", "en", "y")] * 2
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string, topic string")
    got = mix(df)
    assert got.columns[:5] == df.columns and got.count() == len(rows)
    twins = got.where("doc_id IS NULL").collect()
    assert len(twins) == 1
    twins = got.where("doc_id = 4 AND text = ''").select("__kept").collect()
    assert len(twins) == 2 and twins[0] == twins[1]
    assert mix(df.drop("source", "lang")).count() == len(rows)
    assert mix(df.limit(0)).count() == 0


def test_components_of_chains_stars_and_cycles(spark):
    edges = [(i, i + 1) for i in range(50)] + [(100, 200 + i) for i in range(60)] + [(300, 301), (301, 302), (302, 300), (400, 400)]
    got = dict(tuple(r) for r in components(spark.createDataFrame(edges, "a long, b long")).collect())
    assert all(got[i] == 0 for i in range(51)) and all(got[200 + i] == 100 for i in range(60)) and {got[300], got[301], got[302]} == {300}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def plain_kd(rows, spans, leaves, first=0):
    """Leaf of each row by recursive splits of a list of ``(dimensions, tie, row, size)``; the row at the median goes left."""
    if leaves == 1:
        return {r[2]: first for r in rows}
    if not rows:
        return {}
    widest = max(range(len(spans)), key=lambda d: (max(r[0][d] for r in rows) - min(r[0][d] for r in rows)) / spans[d])
    ordered = sorted(rows, key=lambda r: (r[0][widest], r[1], r[2]))
    need, weight, cut = sum(r[3] for r in rows) * (leaves // 2 / leaves), 0, 0
    while cut < len(ordered) and weight < need:
        weight += ordered[cut][3]
        cut += 1
    return plain_kd(ordered[:cut], spans, leaves // 2, first) | plain_kd(ordered[cut:], spans, leaves - leaves // 2, first + leaves // 2)


def test_shards_like_a_recursive_split(spark):
    draw = random.Random(12)
    data = [(i * 3, "x" * draw.randint(0, 400), draw.choice(["web", "web", "book", None]), draw.choice("abc")) for i in range(250)]
    df = spark.createDataFrame(data, "doc_id long, text string, source string, lang string").coalesce(1)
    dims = metadata(df)
    numbered = df.select("doc_id", F.array(*dims.values()).alias("at"), F.xxhash64("doc_id", "text").cast("double").alias("tie"), F.length("text").alias("n")).collect()
    rows = [(r["at"], r["tie"], r["doc_id"], r["n"] + ROW_BYTES) for r in numbered]
    spans = [max(r[0][d] for r in rows) - min(r[0][d] for r in rows) for d in range(len(dims))]
    for leaves in (2, 5, 9):
        got = {r.doc_id: r.shard for r in kd_shards(df, shards=leaves).collect()}
        assert got == plain_kd(rows, spans, leaves)
