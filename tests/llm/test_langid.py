import math
from collections import Counter, defaultdict

import numpy as np
from pyspark.sql import functions as F

from pricelens.llm.langid import SPREADS, fit, identify, identify_corpus, train


def test_held_out_accuracy_and_undetermined_texts(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model, bounds = train(docs.where("doc_id % 5 <> 0"))
    got = identify(docs.where("doc_id % 5 = 0"), model, bounds, {"lang": F.col("lang")}).toPandas()
    assert (got.lang_pred == got.lang).mean() > 0.97
    assert got.score.between(0, 1).all() and got.rejected.mean() < 0.1
    odd = spark.createDataFrame([(1, None, "x"), (2, "", None), (3, "123 ... 55", "y"), (4, "z" * 200_000, "y"), (None, "und der die", None), (4, "die und", "q")], "doc_id long, text string, score string")
    rows = identify(odd, model, bounds).toPandas()
    assert (rows.lang_pred[:3] == "und").all() and rows.rejected[:3].all() and (rows.lang_pred[3:] != "und").all()
    assert identify(odd.limit(0), model, bounds).count() == 0


def test_nothing_to_learn(spark):
    empty = spark.createDataFrame([(1, "text", None), (2, None, "en")], "doc_id long, text string, lang string")
    model, bounds = train(empty)
    assert model is None and list(identify(empty, model, bounds).toPandas().lang_pred) == ["und", "und"]


def plain_kneser_ney(rows, order=5):
    """Interpolated Kneser-Ney over exact n-grams, with dictionaries: cross-entropy of a text in each language."""
    pad = " " * (order - 1)

    def grams(word, k):
        padded = pad + word + " "
        return [padded[i - k + 1 : i + 1] for i in range(order - 1, len(padded))]

    counts = defaultdict(Counter)  # by language and order
    for text, lang in rows:
        for word in text.lower().split():
            counts[lang, order].update(grams(word, order))
            for k in range(1, order):
                counts[lang, k].update(dict.fromkeys(grams(word, k), 0))
    langs = sorted({lang for _, lang in rows})
    seen = {key: set(c) for key, c in counts.items()}
    for lang in langs:
        longer = {order: seen[lang, order]}
        for k in range(order - 1, 0, -1):
            longer[k] = set()
            for _, word_text in ((0, t) for t, own in rows if own == lang):
                for word in word_text.lower().split():
                    longer[k].update(grams(word, k))
            left = Counter(g[1:] for g in longer[k + 1])
            counts[lang, k] = Counter({g: left[g] for g in longer[k] if left[g]})
    letters = len({g for lang in langs for g in counts[lang, 1]})

    def model(lang):
        tables = []
        for k in range(1, order + 1):
            own = counts[lang, k]
            ones, twos = sum(c == 1 for c in own.values()), sum(c == 2 for c in own.values())
            d = min(max(ones / max(ones + 2 * twos, 1), 0.1), 0.9)
            total, kinds = Counter(), Counter()
            for g, c in own.items():
                total[g[:-1]] += c
                kinds[g[:-1]] += 1
            tables.append((own, d, total, kinds))
        return tables

    models = {lang: model(lang) for lang in langs}

    def entropy(text, lang):
        bits, n = 0.0, 0
        for word in text.lower().split():
            for places in zip(*(grams(word, k) for k in range(1, order + 1))):
                p = 1 / (letters + 1)
                for g, (own, d, total, kinds) in zip(places, models[lang]):
                    ctx = g[:-1]
                    p = p * (d * kinds[ctx] / total[ctx] if total[ctx] else 1.0) + (max(own[g] - d, 0) / total[ctx] if own[g] else 0.0)
                bits -= math.log(p)
                n += 1
        return bits / max(n, 1)

    return langs, entropy


def test_cross_entropies_like_plain_kneser_ney(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").where("lang IS NOT NULL").orderBy("doc_id").limit(150).select("text", "lang").toPandas()
    rows = list(zip(docs.text.str[:600], docs.lang, strict=True))
    learned = rows[:110]
    model, _ = train(spark.createDataFrame(learned, "text string, lang string"), bits=31)  # n-grams do not meet
    langs, entropy = plain_kneser_ney(learned)
    assert model.langs == langs
    tested = [t for t, _ in rows[100:]] + ["", "zzz qqq", "word"]
    assert len(tested) > 40
    got = model.entropies(tested)
    want = np.array([[entropy(t, lang) for lang in langs] for t in tested])
    assert np.abs(got - want).max() < 1e-5
    assert (got.argmin(1) == want.argmin(1)).all()


def test_bounds_come_from_all_training_texts(spark):
    """More than 500 different texts of a language: every one counts, once, and one pass gives what two give."""
    texts = [f"der hund {i} und die katze {chr(97 + i % 26) * (i % 9 + 1)}" for i in range(700)]
    rows = [(i, t, "de") for i, t in enumerate([*texts, *texts[:300]])] + [(2000, "the dog and cat", "en"), (2001, "12 34", "en"), (2002, None, "de"), (2003, "xx", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model, bounds = train(docs)
    own = fit(docs).entropies(texts)[:, model.langs.index("de")]
    assert abs(bounds["de"] - (own.mean() + SPREADS * max(own.std(ddof=1), 0.02))) < 1e-9
    got = identify_corpus(docs, F.lit(True)).toPandas().sort_values("doc_id", ignore_index=True)
    want = identify(docs, model, bounds).toPandas().sort_values("doc_id", ignore_index=True)
    assert got.equals(want[got.columns])


def test_words_and_n_grams_are_looked_up_once(monkeypatch):
    import pandas as pd

    from pricelens.llm import langid as L

    words = {"de": ["der", "hund", "und", "katze"], "en": ["the", "dog", "and", "cat"]}
    model = L.Model(pd.concat([f for lang, own in words.items() for f in L._gram_counts(lang, Counter(own), 22)]), 22)
    scored, sorts, plain, groups = [], [], model.word_entropies, L.sorted_groups
    monkeypatch.setattr(model, "word_entropies", lambda found: (scored.extend(found), plain(found))[1])
    monkeypatch.setattr(L, "sorted_groups", lambda keys: (sorts.append(len(keys)), groups(keys))[1])
    known = L.Known(2)
    texts = [" ".join(f"hund{i} Cat{i % 7}" for i in range(j, j + 900)) for j in range(0, 2700, 300)]  # more words than the first room
    first = model.entropies(texts, known)
    assert len(scored) == len(set(scored)) == len(known.number) > 2700 and len(sorts) == L.ORDER + 1
    assert (model.entropies(texts, known) == first).all() and len(sorts) == L.ORDER + 1
    for text, row in zip(texts, first, strict=True):
        own = text.lower().split()
        assert np.abs(plain(own).sum(0) / (sum(map(len, own)) + len(own)) - row).max() < 1e-12


def test_sorted_groups_like_numpy():
    from pricelens.llm.langid import sorted_groups

    draw = np.random.default_rng(2)
    for n in (1, 5, 3000):
        keys = draw.choice(draw.integers(0, 2**31, 1 + n // 3), n).astype(np.uint64)
        for got, want in zip(sorted_groups(keys), np.unique(keys, return_inverse=True), strict=True):
            assert (got == want).all()
