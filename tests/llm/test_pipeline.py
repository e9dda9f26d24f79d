import pandas as pd
import public_tokenizers
from tokenizers import Tokenizer

import corpus_pipeline
from pricelens.llm.common import documents
from pricelens.llm.quality import line_quality
from tests.llm.brute import jaccard_components
from tests.llm.test_text_rules import line_rows, quality_row

SMALL = "/root/testdata/sf0.001"


def test_each_stage_like_brute_force_on_its_own_input(spark, tmp_path):
    docs, seen = documents(spark, SMALL), {}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SMALL)
        if name != "bpe":
            assert out.columns == docs.columns and out.dtypes == docs.dtypes
        out.write.parquet(str(tmp_path / name))
        seen[name] = (docs.toPandas(), spark.read.parquet(str(tmp_path / name)).toPandas())
        docs = spark.read.parquet(str(tmp_path / name))
    before, after = seen["quality_rules"]
    assert set(after.doc_id) == {i for i, t in zip(before.doc_id, before.text, strict=True) if quality_row(t)[-1]}
    cleaned = {r.doc_id: r.cleaned for r in line_quality(documents(spark, SMALL)).collect()}
    assert all(cleaned[i] == t and len(t) == n for i, t, n in zip(after.doc_id, after.text, after.n_chars, strict=True))
    before, after = seen["line_dedup"]
    rows = line_rows(list(zip(before.doc_id, before.text, strict=True)))
    import hashlib
    assert [(i, h) for i, _, h in rows] == sorted(((i, hashlib.sha256(t.encode()).hexdigest()) for i, t in zip(after.doc_id, after.text, strict=True)), key=str)
    before, after = seen["jaccard_join"]
    assert set(after.doc_id) == {i for i, _, c in jaccard_components(list(zip(before.doc_id, before.text, strict=True)), 5, 80) if i == c}
    before, after = seen["mixing"]
    assert 0 < len(after) <= len(before) and set(after.doc_id) <= set(before.doc_id)
    before, after = seen["bpe"]
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    ids = {i: library.encode(t, add_special_tokens=False).ids for i, t in zip(before.doc_id, before.text, strict=True)}
    assert {r.doc_id: r.ids for r in after.itertuples()} == {i: ",".join(map(str, x)) for i, x in ids.items()}
    assert after.set_index("doc_id").decoded.to_dict() == before.set_index("doc_id").text.to_dict()
    whole = corpus_pipeline.run(spark, SMALL).toPandas()
    pd.testing.assert_frame_equal(whole.sort_values("doc_id").reset_index(drop=True), after.sort_values("doc_id").reset_index(drop=True))


def test_odd_rows_pass_through_all_stages(spark):
    text = " ".join(f"word{i % 97}x{i % 13}" for i in range(200)) + "."
    rows = [(1, text, None, None, 5, "a"), (1, text, None, None, 5, "b"), (None, text + " more.", "en", None, 1, None), (2, None, None, None, None, None), (3, "", "x", "y", 0, "c")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, slot string")
    for kept in (docs, docs.limit(0)):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, kept, SMALL)
            if name != "bpe":
                assert out.columns == docs.columns
                kept = out
        assert out.count() <= 2
