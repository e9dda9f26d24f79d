"""Byte-pair encoding as a bounded-lookahead transducer, decoding as a byte-to-text state machine.

The merge list fixes how many bytes beyond a token end can still change it (``lookahead``). A piece is therefore read
through a buffer of fixed length: tokens that end at least that many bytes before the end of the buffer are stable
and leave, the rest waits for more bytes. The pieces of one text are held together, and its ids are one cell, so memory
grows with the longest text but not with their number. A null text counts as the empty text, and the empty text has no
tokens. Equal rows are encoded alike.
Rows are independent; columns other than ``doc_id`` and ``text`` are not read.
"""

from __future__ import annotations

import codecs
import functools
import heapq
import json
from collections.abc import Iterator

import pandas as pd
import regex
from pyspark.sql import DataFrame

from pricelens.llm.common import trim

PIECES = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
#: Memoised pieces of a task: at most twice so many, of at most so many characters.
MEMO_PIECES, MEMO_CHARS = 200_000, 64
#: Tokens that the decoder takes at a time.
DECODE_BLOCK = 65_536


def byte_letters() -> list[str]:
    """The printable letter by which a byte-level vocabulary writes each byte."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(others)) for b in range(256)]


def lookahead(pairs: list[tuple[int, int]], made: list[int], length: dict[int, int]) -> int:
    """Bytes beyond a token end that can still change it.

    A merge can only be prevented by an earlier rule that takes its right operand, or the last part of it, together
    with what follows; that rule in turn only by a still earlier one. The longest such chain, in bytes, is found in
    one pass through the list.
    """
    reach: dict[int, int] = {}
    last: dict[int, int] = {}
    for (left, right), token in zip(pairs, made, strict=True):
        part, chain = right, 0
        while part is not None:
            chain = max(chain, reach.get(part, 0))
            part = last.get(part)
        reach[left] = max(reach.get(left, 0), length[right] + chain)
        last.setdefault(token, right)
    return max(reach.values(), default=0) + max(length.values())


def token_bytes(spec: dict) -> dict[int, bytes]:
    """The bytes of every id of a tokenizer file, special tokens included."""
    byte_of = {letter: b for b, letter in enumerate(byte_letters())}
    plain = {i: bytes(byte_of[c] for c in token) for token, i in spec["model"]["vocab"].items()}
    return plain | {t["id"]: t["content"].encode() for t in spec["added_tokens"]}


class Transducer:
    """Encoder of one vocabulary; holds the merge table and a bounded memo of pieces."""

    def __init__(self, source: str) -> None:
        spec = json.loads(source)
        model = spec["model"]
        vocab = model["vocab"]
        self.text_of = token_bytes(spec)
        self.of_byte = [vocab[letter] for letter in byte_letters()]
        self.added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        pairs = [(vocab[a], vocab[b]) for a, b in merges]
        made = [vocab[a + b] for a, b in merges]
        self.rules = {pair: (rank, token) for rank, (pair, token) in enumerate(zip(pairs, made, strict=True))}
        self.name_of = {i: str(i) for i in self.text_of}
        self.ahead = lookahead(pairs, made, {i: len(t) for i, t in self.text_of.items()})
        self.buffer = 4 * self.ahead
        self.split_added = regex.compile("(" + "|".join(map(regex.escape, sorted(self.added, key=len, reverse=True))) + ")") if self.added else None
        self.memo: dict[str, str] = {}
        self.older: dict[str, str] = {}  # the memo before, so that pieces that recur are not forgotten

    def merged(self, data: bytes) -> list[int]:
        """The tokens of a byte string that ends here: rules in order of rank, leftmost first."""
        tokens: list[int | None] = [self.of_byte[b] for b in data]
        n = len(tokens)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        rules, heap = self.rules, []
        for i in range(n - 1):
            if rule := rules.get((tokens[i], tokens[i + 1])):
                heap.append((rule[0], i, tokens[i], tokens[i + 1], rule[1]))
        heapq.heapify(heap)
        while heap:
            _, i, left, right, token = heapq.heappop(heap)
            j = after[i]
            if tokens[i] != left or j >= n or tokens[j] != right:
                continue
            tokens[i], tokens[j] = token, None
            after[i] = k = after[j]
            if k < n:
                before[k] = i
                if rule := rules.get((token, tokens[k])):
                    heapq.heappush(heap, (rule[0], i, token, tokens[k], rule[1]))
            if (h := before[i]) >= 0 and (rule := rules.get((tokens[h], token))):
                heapq.heappush(heap, (rule[0], h, tokens[h], token, rule[1]))
        return [t for t in tokens if t is not None]

    def stream(self, data: bytes) -> Iterator[int]:
        """Tokens of one piece of any length, through a buffer of fixed length."""
        at = 0
        while len(data) - at > self.buffer:
            stable = at + self.buffer - self.ahead
            for token in self.merged(data[at : at + self.buffer]):
                if at + len(self.text_of[token]) > stable:
                    break
                yield token
                at += len(self.text_of[token])
        yield from self.merged(data[at:])

    def piece(self, piece: str) -> str:
        out = self.memo.get(piece) or self.older.get(piece)
        if out is None:
            out = ",".join(map(self.name_of.__getitem__, self.stream(piece.encode())))
        if len(piece) <= MEMO_CHARS:
            if len(self.memo) >= MEMO_PIECES:
                self.memo, self.older = {}, self.memo
            self.memo[piece] = out
        return out

    def encode(self, text: str) -> tuple[str, int]:
        """Decimal ids joined by commas, and their number."""
        parts = []
        for i, run in enumerate(self.split_added.split(text) if self.split_added else [text]):
            if i % 2:
                parts.append(self.name_of[self.added[run]])
                continue
            pieces = PIECES.findall(run)
            parts += [ids or self.piece(piece) for ids, piece in zip(map(self.memo.get, pieces), pieces)]
        ids = ",".join(parts)
        return ids, ids.count(",") + 1 if ids else 0


class TextMachine:
    """Turns ids into text step by step; bytes of an unfinished character wait for the next step."""

    def __init__(self, text_of: dict[int, bytes]) -> None:
        self.bytes_of = {str(i): t for i, t in text_of.items()}

    def decode(self, ids: str) -> str:
        state, out, at = codecs.getincrementaldecoder("utf-8")("replace"), [], 0
        while at < len(ids):
            end = ids.find(",", at + DECODE_BLOCK)
            end = len(ids) if end < 0 else end
            out.append(state.decode(b"".join(map(self.bytes_of.__getitem__, ids[at:end].split(",")))))
            at = end + 1
        return "".join([*out, state.decode(b"", final=True)])


@functools.lru_cache(maxsize=2)
def transducer(source: str) -> Transducer:
    return Transducer(source)


@functools.lru_cache(maxsize=2)
def text_machine(source: str) -> TextMachine:
    return TextMachine(token_bytes(json.loads(source)))  # without the merge rules, which take most of the memory


def encode(docs: DataFrame, vocabulary: str) -> DataFrame:
    """``doc_id, n_tokens, ids`` of every row; ``vocabulary`` is the path of a byte-level BPE file on the driver.

    The file's content (a few MB whatever the corpus) is broadcast; ``ids`` are decimal, joined by commas.
    """
    with open(vocabulary, encoding="utf-8") as file:
        source = docs.sparkSession.sparkContext.broadcast(file.read())

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        work = transducer(source.value)
        for frame in frames:
            done = [work.encode(text or "") for text in frame["text"]]
            yield pd.DataFrame({"doc_id": frame["doc_id"], "n_tokens": [n for _, n in done], "ids": [ids for ids, _ in done]})
        trim()

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInPandas(run, f"doc_id {kind}, n_tokens long, ids string")


def decode(encoded: DataFrame, vocabulary: str) -> DataFrame:
    """``encoded`` with the column ``decoded``, the text of ``ids``; null ids count as none."""
    with open(vocabulary, encoding="utf-8") as file:
        source = encoded.sparkSession.sparkContext.broadcast(file.read())

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        work = text_machine(source.value)
        for frame in frames:
            yield frame.assign(decoded=[work.decode(ids or "") for ids in frame["ids"]])
        trim()

    return encoded.mapInPandas(run, f"{', '.join(f'`{f.name}` {f.dataType.simpleString()}' for f in encoded.schema)}, decoded string")
