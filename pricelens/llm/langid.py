"""Language identification by interpolated Kneser-Ney character models.

Character n-grams of words (with blanks around them) are counted per language by Spark: raw counts at the highest
order, numbers of distinct left neighbours below it. N-grams are hashed to ``bits`` bits (at most 31), which bounds the model
whatever the corpus: at most ``2^bits`` entries an order and language, kept as sorted hash arrays. N-grams that meet in
one entry are counted together; more bits keep more of them apart, at the price of a larger model. A text goes to
the language with the lowest cross-entropy per character, on a tie to the first by name; the mean and the spread of the
cross-entropies of all different training texts with a letter, each in its own language, give the bound beyond which a
prediction is marked as rejected. ``identify_corpus`` takes them from the pass that predicts, so no text is scored twice.

Null texts and texts without a letter are ``und`` with score 0 and rejected, as is everything if there are no training
rows. Rows without a language are not learned from. Only ``text`` enters a prediction. A long text is one row's work: its
words are looked up block by block, its distinct words and their numbers are held. Equal rows get equal results. Columns
other than ``doc_id``, ``text`` and ``lang`` are not read, so they may have any name.
"""

from __future__ import annotations

import functools
import uuid
from collections import Counter
from collections.abc import Iterator
from itertools import chain, repeat

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pricelens.llm.hashing import mix
from pricelens.session import materialise

ORDER, HASH_BITS, SPREADS = 5, 22, 5.0
#: Scale of the differences of cross-entropy in the score, and characters beyond which a text is sure enough.
SHARPNESS, LONG_TEXT = 4.0, 40
#: Bounds of memory in a task: characters worked on at once, distinct words counted and known, and words looked up at once.
SLICE_CHARS, WORDS_COUNTED, WORDS_HELD, WORD_BLOCK = 1 << 20, 100_000, 300_000, 1 << 15
FACTOR = np.uint64(0x9E3779B97F4A7C15)


def gram_keys(words: list[str], bits: int = HASH_BITS) -> tuple[list[np.ndarray], np.ndarray]:
    """Keys of the n-grams of orders 0 to ``ORDER`` that end at each character, and the word of each predicted place (-1: none)."""
    pad = " " * (ORDER - 1)
    points = np.frombuffer((pad + pad.join(words) + pad).encode("utf-32-le", "replace"), dtype=np.uint32).astype(np.uint64)
    lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    owner = np.full(len(points), -1, dtype=np.int64)
    starts = np.cumsum(np.concatenate([[0], lengths[:-1] + ORDER - 1])) + ORDER - 1
    places = np.repeat(starts - np.cumsum(np.concatenate([[0], lengths[:-1] + 1])), lengths + 1) + np.arange((lengths + 1).sum())
    owner[places] = np.repeat(np.arange(len(words)), lengths + 1)
    total, keys, power = np.zeros(len(points), dtype=np.uint64), [np.zeros(len(points), dtype=np.uint64)], np.uint64(1)
    for k in range(ORDER):
        power = np.uint64(int(power) * int(FACTOR) % (1 << 64))
        total = total.copy()
        total[k:] += (points[: len(points) - k] + np.uint64(1)) * power
        keys.append(mix(total) >> np.uint64(64 - bits))
    return keys, owner


def slices(texts: list[str]) -> Iterator[list[str]]:
    """The texts in order, in lists of about ``SLICE_CHARS`` characters."""
    held, size = [], 0
    for text in texts:
        held.append(text)
        size += len(text)
        if size >= SLICE_CHARS:
            yield held
            held, size = [], 0
    if held:
        yield held


def sorted_groups(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct numbers of ``keys`` (of at most 31 bits) in order, and the place of each key among them."""
    packed = (keys.astype(np.int64) << 32) | np.arange(len(keys))
    packed.sort()  # much faster than to sort places by their keys
    ordered = packed >> 32
    new = np.append(True, ordered[1:] != ordered[:-1])
    place = np.empty(len(keys), dtype=np.int64)
    place[packed & 0xFFFFFFFF] = np.cumsum(new) - 1
    return ordered[new].astype(np.int32), place


class Known:
    """Words that are known, and for each its cross-entropies by language and its places (letters and the end)."""

    def __init__(self, langs: int) -> None:
        self.number: dict[str, int] = {}
        self.rows, self.places = np.empty((1 << 10, langs)), np.empty(1 << 10, dtype=np.int64)

    def add(self, words: list[str], rows: np.ndarray) -> None:
        start, stop = len(self.number), len(self.number) + len(words)
        if stop > len(self.rows):
            more = max(stop, 3 * len(self.rows) // 2) - start
            self.rows = np.concatenate([self.rows[:start], np.empty((more, self.rows.shape[1]))])
            self.places = np.concatenate([self.places[:start], np.empty(more, dtype=np.int64)])
        self.rows[start:stop] = rows
        self.places[start:stop] = np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 1
        self.number.update(zip(words, range(start, stop), strict=True))

    def numbers(self, words: list[str]) -> np.ndarray:
        """The number of each word, -1 if it is not known."""
        return np.fromiter(map(self.number.get, words, repeat(-1)), dtype=np.int64, count=len(words))


def _gram_counts(lang: str, seen: Counter, bits: int) -> Iterator[pd.DataFrame]:
    words, times = list(seen), np.fromiter(seen.values(), dtype=np.int64, count=len(seen))
    keys, owner = gram_keys(words, bits)
    at = np.flatnonzero(owner >= 0)
    weight = times[owner[at]]
    for k in range(1, ORDER + 1):
        packed = (keys[k][at] << np.uint64(bits)) | keys[k - 1][at - 1]
        order = np.argsort(packed)
        ordered = packed[order]
        starts = np.flatnonzero(np.append(True, ordered[1:] != ordered[:-1]))
        found, first = ordered[starts], order[starts]
        yield pd.DataFrame({
            "lang": lang, "k": k, "key": (found >> np.uint64(bits)).astype(np.int32), "suffix": keys[k - 1][at[first]].astype(np.int32),
            "ctx": keys[k - 1][at[first] - 1].astype(np.int32), "c": np.add.reduceat(weight[order], starts),
        })


def _counts(train: DataFrame, bits: int) -> DataFrame:
    """``lang, k, key, suffix, ctx, c``: raw counts of the n-grams of every order."""
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: dict[str, Counter] = {}
        for frame in frames:
            for lang, text in zip(frame["lang"], frame["text"], strict=True):
                own = seen.setdefault(lang, Counter())
                own.update(text.lower().split())
                if len(own) >= WORDS_COUNTED:
                    yield from _gram_counts(lang, seen.pop(lang), bits)
        for lang, own in seen.items():
            if own:
                yield from _gram_counts(lang, own, bits)

    counted = train.select("lang", "text").mapInPandas(run, "lang string, k int, key int, suffix int, ctx int, c long")
    return counted.groupBy("lang", "k", "key").agg(F.min("suffix").alias("suffix"), F.min("ctx").alias("ctx"), F.sum("c").alias("c"))


class Model:
    """Sorted hash arrays: per order keys with discounted shares, and contexts with the share left to lower orders."""

    def __init__(self, counts: pd.DataFrame, bits: int) -> None:
        self.bits = bits
        self.langs = sorted(counts["lang"].unique())
        size = len(self.langs)
        code = {name: i for i, name in enumerate(self.langs)}
        self.keys, self.share, self.contexts, self.left = [], [], [], []
        letters = counts[counts["k"] == 1]["key"].nunique()
        self.floor = 1.0 / (letters + 1)
        for k in range(1, ORDER + 1):
            own = counts[counts["k"] == k][["lang", "key", "ctx", "c"]]
            if k < ORDER:  # distinct left neighbours instead of occurrences
                longer = counts[counts["k"] == k + 1].groupby(["lang", "suffix"]).size().rename("n").reset_index()
                own = own.merge(longer, left_on=["lang", "key"], right_on=["lang", "suffix"])
                own["c"] = own["n"]
            lang, c = own["lang"].map(code).to_numpy(dtype=np.int64), own["c"].to_numpy(dtype=np.float64)
            ones, twos = np.bincount(lang[c == 1], minlength=size), np.bincount(lang[c == 2], minlength=size)
            discount = np.clip(ones / np.maximum(ones + 2 * twos, 1), 0.1, 0.9)
            contexts, ctx = np.unique(own["ctx"].to_numpy(), return_inverse=True)
            total, kinds = np.zeros((len(contexts), size)), np.zeros((len(contexts), size))
            np.add.at(total, (ctx, lang), c)
            np.add.at(kinds, (ctx, lang), 1)
            keys, key = np.unique(own["key"].to_numpy(), return_inverse=True)
            share = np.zeros((len(keys), size), dtype=np.float32)
            share[key, lang] = np.maximum(c - discount[lang], 0) / total[ctx, lang]
            self.keys.append(keys)
            self.share.append(share)
            self.contexts.append(contexts)
            self.left.append(np.where(total > 0, discount * kinds / np.maximum(total, 1), 1.0).astype(np.float32))

    def word_entropies(self, words: list[str]) -> np.ndarray:
        """Minus natural log probability of each word, by language."""
        keys, owner = gram_keys(words, self.bits)
        at = np.flatnonzero(owner >= 0)
        used = owner >= 0
        used[at - 1] = True
        index = np.cumsum(used) - 1
        here, before = index[at], index[at - 1]
        p = np.full((len(at), len(self.langs)), self.floor)
        for k in range(ORDER + 1):  # the n-grams of an order are the contexts of the next one
            wanted, place = sorted_groups(keys[k][used])
            if k:
                p += self._rows(self.keys[k - 1], self.share[k - 1], wanted, 0.0)[place[here]]
            if k < ORDER:
                p *= self._rows(self.contexts[k], self.left[k], wanted, 1.0)[place[before]]
        out = np.zeros((len(words), len(self.langs)))
        for lang in range(len(self.langs)):
            out[:, lang] = np.bincount(owner[at], weights=-np.log(p[:, lang]), minlength=len(words))
        return out

    @staticmethod
    def _rows(table: np.ndarray, values: np.ndarray, wanted: np.ndarray, missing: float) -> np.ndarray:
        at = np.minimum(np.searchsorted(table, wanted), len(table) - 1)  # in order, the search stays in the cache
        return np.where((table[at] == wanted)[:, None], values[at], np.float32(missing))

    def entropies(self, texts: list[str], known: Known | None = None) -> np.ndarray:
        """Cross-entropy per character of each text, by language. ``known`` keeps the words of a task, up to ``WORDS_HELD``."""
        known = Known(len(self.langs)) if known is None else known
        return np.concatenate([self._of_slice(part, known) for part in slices(texts)] or [np.zeros((0, len(self.langs)))])

    def _of_slice(self, texts: list[str], known: Known) -> np.ndarray:
        split = [t.lower().split() for t in texts]
        words = list(chain.from_iterable(split))
        out = np.zeros((len(texts), len(self.langs)))
        if not words:
            return out
        if len(known.number) >= WORDS_HELD:
            known.number.clear()
        codes = known.numbers(words)
        missing = np.flatnonzero(codes < 0)
        fresh = list(dict.fromkeys(words[i] for i in missing.tolist()))
        for at in range(0, len(fresh), WORD_BLOCK):
            block = fresh[at : at + WORD_BLOCK]
            known.add(block, self.word_entropies(block))
        codes[missing] = known.numbers([words[i] for i in missing.tolist()])
        text = np.repeat(np.arange(len(texts)), np.fromiter(map(len, split), dtype=np.int64, count=len(split)))
        n = np.maximum(np.bincount(text, weights=known.places[codes], minlength=len(texts)), 1)
        by_word = known.rows[codes]
        for lang in range(len(self.langs)):
            out[:, lang] = np.bincount(text, weights=by_word[:, lang], minlength=len(texts)) / n
        return out


def fit(docs: DataFrame, bits: int = HASH_BITS) -> Model | None:
    """The model of ``docs`` (``text, lang``)."""
    rows = docs.where(F.col("text").isNotNull() & F.col("lang").isNotNull()).select("text", F.col("lang").cast("string").alias("lang"))
    counts = _counts(rows, bits).toPandas()  # bounded by the hash range, orders and languages
    return None if counts.empty else Model(counts, bits)


def entropy_bounds(scored: DataFrame) -> dict[str, float]:
    """For each language the highest cross-entropy that is not rejected, from all different texts of ``lang, h, own``."""
    texts = scored.where(F.col("own").isNotNull()).groupBy("lang", "h").agg(F.min("own").alias("own"))
    stats = texts.groupBy("lang").agg(F.avg("own").alias("mean"), F.coalesce(F.stddev_samp("own"), F.lit(0.5)).alias("std"))
    return {r.lang: r["mean"] + SPREADS * max(r["std"], 0.02) for r in stats.collect()}


def train(docs: DataFrame, bits: int = HASH_BITS) -> tuple[Model | None, dict[str, float]]:
    """The model of ``docs`` (``text, lang``) and, for each language, the highest cross-entropy that is not rejected."""
    model = fit(docs, bits)
    return model, {} if model is None else entropy_bounds(_scored(docs, model, {}, F.col("lang")))


@functools.lru_cache(maxsize=1)
def _known(model: str, langs: int) -> Known:
    """The words that a worker knows of a model, from one task to the next."""
    return Known(langs)


def _scored(docs: DataFrame, model: Model | None, extra: dict[str, Column], lang: Column | None = None) -> DataFrame:
    """The columns of ``extra``, ``lang_pred, score, entropy`` and, if a language to learn is given, ``lang``, the cross-entropy
    ``own`` of a text in it and the text's hash ``h``. Without a letter all cross-entropies are null."""
    # hashes are never null: with nulls they would become floating-point numbers in the tasks
    added = {} if lang is None else {"lang": lang.cast("string"), "h": F.xxhash64("text")}
    kept = docs.select(*(c.alias(n) for n, c in {**extra, **added}.items()), "text")
    name, learning = uuid.uuid4().hex, lang is not None
    shared = docs.sparkSession.sparkContext.broadcast(model)  # bounded, see the module's docstring

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = shared.value
        known = _known(name, len(model.langs) if model else 0)
        place = {} if model is None else {n: i for i, n in enumerate(model.langs)}
        for frame in frames:
            texts = frame["text"].tolist()
            spoken = np.array([model is not None and t is not None and any(map(str.isalpha, t)) for t in texts], dtype=bool)
            pred, score, entropy, own = np.full(len(texts), "und", dtype=object), np.zeros(len(texts)), np.full(len(texts), np.nan), np.full(len(texts), np.nan)
            if spoken.any():
                h = model.entropies([t for t, s in zip(texts, spoken, strict=True) if s], known)
                best = h.argmin(1)
                length = np.minimum([len(t) for t, s in zip(texts, spoken, strict=True) if s], LONG_TEXT)
                pred[spoken] = np.array(model.langs, dtype=object)[best]
                score[spoken] = 1.0 / np.exp(-(h - h.min(1, keepdims=True)) * SHARPNESS * length[:, None] / LONG_TEXT * 4).sum(1)
                entropy[spoken] = h.min(1)
                if learning:
                    at = np.array([place.get(n, -1) for n in frame["lang"][spoken]])
                    own[spoken] = np.where(at >= 0, h[np.arange(len(h)), at], np.nan)
            out = frame.drop(columns="text").assign(lang_pred=pred, score=score, entropy=entropy)
            yield out.assign(own=own) if learning else out

    fields = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in kept.drop("text").schema)
    own = ", own double" if learning else ""
    return kept.mapInPandas(run, f"{fields}lang_pred string, score double, entropy double{own}")


def _judged(scored: DataFrame, bounds: dict[str, float]) -> DataFrame:
    """``entropy`` 0 without a letter, and ``rejected``."""
    limit = F.lit(None).cast("double")
    for name, bound in bounds.items():
        limit = F.when(F.col("lang_pred") == name, F.lit(bound)).otherwise(limit)
    over = F.col("entropy").isNull() | F.coalesce(F.col("entropy") > limit, F.lit(False))
    return scored.withColumn("rejected", over).withColumn("entropy", F.coalesce("entropy", F.lit(0.0)))


def identify(docs: DataFrame, model: Model | None, bounds: dict[str, float], extra: dict[str, Column] | None = None) -> DataFrame:
    """``doc_id``, the columns of ``extra``, ``lang_pred, score, entropy, rejected`` for every row."""
    return _judged(_scored(docs, model, {"doc_id": F.col("doc_id"), **(extra or {})}), bounds)


def identify_corpus(docs: DataFrame, learned: Column, extra: dict[str, Column] | None = None, bits: int = HASH_BITS) -> DataFrame:
    """``identify`` for all ``docs``, after learning from those where ``learned`` holds.

    Each text is scored once: the numbers of the training texts give the bounds, which are applied to the stored numbers.
    """
    own = F.when(learned, F.col("lang"))
    scored = materialise(_scored(docs, fit(docs.where(learned), bits), {"doc_id": F.col("doc_id"), **(extra or {})}, own), "languages")
    return _judged(scored, entropy_bounds(scored)).drop("lang", "h", "own")
