"""Texts cut at blanks where a byte-level tokenizer always ends a token, so that units that recur are encoded once.

A blank after a letter, digit or printable ASCII sign begins a new piece of the usual byte-level pattern, whatever
follows. A text is therefore the sequence of its units (a blank and what comes up to the next such blank). A text
without blanks is one unit, however long.
"""

from __future__ import annotations

import json
import os
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Units of a task that are remembered: at most so many, of at most so many characters. Characters worked on at once.
HELD, HELD_CHARS, SLICE_CHARS = 1_200_000, 64, 1 << 22
BATCH = 1024


def ends_safely(unit: str) -> bool:
    return unit != "" and (unit[-1].isalnum() or "!" <= unit[-1] <= "~")


def units(text: str) -> Iterator[str]:
    """The units of ``text`` in order; joined they are the text. A blank that ends the text is no unit of its own."""
    head, *rest = text.split(" ")
    for place, word in enumerate(rest, 1 - len(rest)):
        if ends_safely(head) and (word or place):
            yield head
            head = " " + word
        else:
            head += " " + word
    yield head


def pieces(text: str) -> Iterator[str]:
    """A text cut at such blanks into pieces of about ``SLICE_CHARS`` characters; all but the first begin with theirs."""
    start = 0
    while start + SLICE_CHARS < len(text):
        at = text.find(" ", start + SLICE_CHARS)
        while at >= 0 and not ends_safely(text[at - 1]):
            at = text.find(" ", at + 1)
        if at < 0 or at + 1 == len(text):
            break
        yield text[start:at]
        start = at
    yield text[start:]


def runs(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The places ``start, start + 1, ...`` of all runs, one run after the other."""
    ends = np.cumsum(sizes)
    return np.repeat(starts - ends + sizes, sizes) + np.arange(int(sizes.sum()))


class UnitMemo:
    """Results of texts from the values of their units, which are learned once.

    ``words`` gives the values of units that are a blank and a word without blanks (the words come without that blank),
    ``strings`` those of any other units. ``settle(values, codes, starts)`` makes the results of texts: ``codes`` are the
    numbers of the values of all their units in order, ``starts`` where each text begins and where the last one ends.
    ``join`` makes one result from those of the pieces of a long text. With ``lead`` every text counts as if a blank stood
    before it.
    """

    def __init__(self, words: Callable, strings: Callable, settle: Callable, join: Callable, lead: bool = False) -> None:
        self.words, self.strings, self.settle, self.join, self.lead = words, strings, settle, join, lead
        self.held: dict[str, object] = {}
        self.older: dict[str, object] = {}  # units go here first, and are forgotten unless they recur

    def _odd(self, text: str) -> list:
        found = list(units(text))
        known = [self.held.get(u[1:]) if u[:1] == " " else None for u in found]
        rest = [u for u, k in zip(found, known, strict=True) if k is None]
        told = iter(self.strings(rest))
        return [next(told) if k is None else k for k in known]

    def _values(self, words: list[str]) -> list:
        """The values of different words; None where a word ends so that no unit may end there."""
        if 2 * len(self.held) > HELD:
            self.held, self.older = {}, self.held
        held, older = self.held, self.older
        values = list(map(held.get, words))
        fresh, places = [], []
        for i in [i for i, v in enumerate(values) if v is None]:
            word = words[i]
            if word in older:
                held[word] = values[i] = older[word]
            elif ends_safely(word):
                fresh.append(word)
                places.append(i)
        for i, word, value in zip(places, fresh, self.words(fresh), strict=True):
            values[i] = value
            if len(word) <= HELD_CHARS:
                held[word] = value
        return values

    def _slice(self, texts: list[str], lead: bool) -> list:
        if not texts:
            return []
        split = pc.split_pattern(pa.array(texts, pa.large_string()), " ")
        starts = split.offsets.to_numpy().astype(np.int64)
        coded = split.values.dictionary_encode()
        codes = coded.indices.to_numpy().astype(np.int64)
        values = self._values(coded.dictionary.to_numpy(zero_copy_only=False).tolist())
        unsafe = np.array([v is None for v in values], dtype=bool)
        odd = np.add.reduceat(unsafe[codes], starts[:-1]) > 0
        if not lead:
            plain = np.flatnonzero(~odd)
            heads = self.strings([texts[i].split(" ", 1)[0] for i in plain.tolist()])
            codes[starts[plain]] = len(values) + np.arange(len(plain))
            values += heads
        if odd.any():
            parts = []
            for i, text in enumerate(texts):
                part = codes[starts[i] : starts[i + 1]]
                if odd[i]:
                    own = self._odd(" " + text if lead else text)
                    part = len(values) + np.arange(len(own))
                    values += own
                parts.append(part)
            codes = np.concatenate(parts)
            starts = np.concatenate([[0], np.cumsum([len(p) for p in parts])])
        return self.settle(values, codes, starts)

    def of(self, texts: list[str]) -> Iterator:
        """The result of each text, in order; memory is bounded by a slice and by the result of one text."""
        waiting, size = [], 0
        for text in texts:
            if len(text) > SLICE_CHARS:
                yield from self._slice(waiting, self.lead)
                waiting, size, out = [], 0, []
                for i, piece in enumerate(pieces(text)):
                    out += self._slice([piece[1:] if i else piece], self.lead or i > 0)
                yield self.join(out)
                continue
            waiting.append(text)
            size += len(text)
            if size >= SLICE_CHARS:
                yield from self._slice(waiting, self.lead)
                waiting, size = [], 0
        yield from self._slice(waiting, self.lead)


def can_be_cut(spec: dict) -> bool:
    """Whether a tokenizer file has the usual byte-level pattern and no special token or normaliser that spans blanks."""
    split = spec.get("pre_tokenizer") or {}
    plain = all(" " not in t["content"] and not (t["lstrip"] or t["rstrip"] or t["single_word"]) for t in spec["added_tokens"])
    usual = split.get("type") == "ByteLevel" and split.get("use_regex") and not split.get("add_prefix_space")
    return bool(plain and usual and spec.get("normalizer") is None)


class UnitIds:
    """Ids of whole texts by the tokenizers library, as little-endian 32-bit numbers; truncation and padding are off."""

    def __init__(self, source: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_str(source)
        self.library.no_truncation()
        self.library.no_padding()
        spec = json.loads(source)
        self.memo = UnitMemo(self._words, self._strings, self._settle, b"".join) if can_be_cut(spec) else None
        self.blank = np.zeros(self.library.get_vocab_size(), dtype=bool)
        self.blank[[i for t, i in spec["model"]["vocab"].items() if t[0] == "Ġ"]] = True

    def _strings(self, strings: list[str]) -> list[bytes]:
        out = []
        for at in range(0, len(strings), BATCH):
            out += [np.array(e.ids, dtype="<u4").tobytes() for e in self.library.encode_batch_fast(strings[at : at + BATCH], add_special_tokens=False)]
        return out

    def _words(self, words: list[str]) -> list[bytes]:
        out = []
        for at in range(0, len(words), BATCH):
            done = self.library.encode_batch_fast([" " + " ".join(words[at : at + BATCH])], add_special_tokens=False)
            ids = np.array(done[0].ids, dtype="<u4")
            starts = (4 * np.flatnonzero(self.blank[ids])).tolist()  # a unit has its blank in front and no other
            data = ids.tobytes()
            out += [data[s:e] for s, e in zip(starts, [*starts[1:], len(data)], strict=True)]
        return out

    def of(self, texts: list[str]) -> Iterator[bytes]:
        if self.memo is None:
            return iter(self._strings(texts))
        return self.memo.of(texts)

    @staticmethod
    def _settle(values: list[bytes], codes: np.ndarray, starts: np.ndarray) -> list[bytes]:
        sizes = np.array([0 if v is None else len(v) for v in values], dtype=np.int64) // 4
        begins = np.cumsum(sizes) - sizes
        ids = np.frombuffer(b"".join([v or b"" for v in values]), "<u4")[runs(begins[codes], sizes[codes])].tobytes()
        ends = np.concatenate([[0], np.cumsum(sizes[codes])])
        cuts = (4 * ends[starts]).tolist()
        return [ids[s:e] for s, e in zip(cuts[:-1], cuts[1:], strict=True)]
