import hashlib
import random
from collections import Counter

import numpy as np
import pandas as pd
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from pricelens.llm import alignment as A
from pricelens.llm.bpe import byte_letters
from pricelens.llm.queries import QUERIES

VOCABULARY, MODEL = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def plain():
    """Whole texts, decoded token bytes and loops only."""
    a = Tokenizer.from_file(VOCABULARY)
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    letter = {c: i for i, c in enumerate(byte_letters())}

    def tokens(text):
        ids = a.encode(" " + text, add_special_tokens=False).ids
        of_a = [(i, bytes(letter[c] for c in a.id_to_token(i))) for i in ids]
        of_b = [(i, bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode()) for i in b.encode(text)]
        return of_a, of_b

    def places(found):
        out, at = [], 0
        for i, data in found:
            out.append((i, at, at + len(data)))
            at += len(data)
        return out

    def run(rows):
        done, counts = [], Counter()
        for doc_id, text in rows:
            of_a, of_b = tokens(text) if text else ([], [])
            whole = (" " + (text or "")).encode()
            if not text or b"".join(d for _, d in of_a) != whole or b"".join(d for _, d in of_b) != whole:
                done.append((doc_id, 0, 0, 0, [], ""))
                continue
            pa, pb = places(of_a), places(of_b)
            links, j0 = [], 0
            for i, s, e in pa:
                while pb[j0][2] <= s:
                    j0 += 1
                j = j0
                while j < len(pb) and pb[j][1] < e:
                    links.append((i, pb[j][0]))
                    j += 1
            cuts = sorted({e for *_, e in pa} & {e for *_, e in pb})
            groups, before = [], 0
            for cut in cuts:
                groups.append("|".join(",".join(str(i) for i, s, e in p if before <= s and e <= cut) for p in (pa, pb)))
                before = cut
            counts.update(links)
            done.append((doc_id, len(pa), len(pb), len(cuts), links, ";".join(groups)))
        best = Counter()
        for (_, j), n in counts.items():
            best[j] = max(best[j], n)
        return [
            (d, na, nb, ng, len(ln), sum(counts[x] == best[x[1]] for x in ln), sum(counts[x] for x in ln), hashlib.sha256(g.encode()).hexdigest() if g else "", g)
            for d, na, nb, ng, ln, g in done
        ]

    return run


COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def order(rows):
    return sorted(rows, key=str)


def test_spans_are_refined_by_bytes():
    starts, ends, sizes = np.array([0, 2, 2, 2, 5]), np.array([2, 5, 5, 5, 7]), np.array([2, 1, 1, 1, 2])
    assert A.refined(starts, ends, sizes).tolist() == [2, 3, 4, 5, 7]
    assert A.refined(np.array([0, 0]), np.array([0, 4]), np.array([1, 3])).tolist() == [1, 4]


def test_odd_rows_like_loops(spark, plain, monkeypatch):
    monkeypatch.setattr(A, "CHUNK_CHARS", 3_000)
    monkeypatch.setattr("pricelens.llm.units.SLICE_CHARS", 2_000)
    draw = random.Random(6)
    pool = ["a", "Zz", " ", "  ", "\n", "\t", "é", "漢", "\U0001f600", "\U00012000", "1", ".", "'s", "\xa0", "\x00", "́", "<|endoftext|>", "<s>", "<0x41>", "​", "ﬁ", "½", "word", " the"]
    texts = [None, "", " ", "\n", "same text", "same text", "broken ▁ text", "▁", "  lead and trail  ", "x" * 5_000, "many words of a long text, " * 700, "no blank", "tail "]
    texts += ["".join(draw.choice(pool) for _ in range(draw.randint(1, 40))) for _ in range(400)]
    rows = [(None if i == 3 else 2**60 + i // 2, t) for i, t in enumerate(texts)]
    docs = spark.createDataFrame([(i, t, 1, "u", "p") for i, t in rows], "doc_id long, text string, chunk int, units string, pair string").repartition(3)
    got = A.align(docs, VOCABULARY, MODEL, keep_groups=True).select(*COLUMNS, "groups").collect()
    assert order(map(tuple, got)) == order(plain(rows))
    assert A.align(docs.limit(0), VOCABULARY, MODEL).count() == 0


def test_texts_are_not_cut_where_the_vocabularies_forbid_it(spark, plain, monkeypatch):
    rows = [(1, "two words here"), (2, "two  words"), (3, None), (4, "")]
    monkeypatch.setattr(A, "can_be_cut", lambda spec: False)
    work = A.Aligner(open(VOCABULARY, encoding="utf-8").read(), open(MODEL, "rb").read())
    assert [len(u) for u in work.units_of([t or "" for _, t in rows])] == [1, 1, 0, 0]
    assert work.groups[0].decode() == plain(rows)[0][-1]


def test_query_like_loops(spark, plain):
    docs = pd.read_parquet("/root/testdata/sf0.001/documents.parquet")
    got = QUERIES["op12_token_alignment"](spark, "/root/testdata/sf0.001").select(*COLUMNS).collect()
    assert order(map(tuple, got)) == order(r[:-1] for r in plain(list(zip(docs.doc_id.tolist(), docs.text.tolist(), strict=True))))
