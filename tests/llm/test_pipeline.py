"""The corpus pipeline: stages take effect, columns stay, and the result packs what the mix took."""

import zlib

import numpy as np

import corpus_pipeline

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, seen = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = docs
        docs = corpus_pipeline.cut(spark, stage(spark, docs, SF), f"test-{name}")
        assert docs.columns == columns
        seen[name] = (before, docs)
    assert seen["quality"][1].count() < seen["quality"][0].count()
    texts = [r.text for r in seen["near_dedup"][1].collect()]
    assert len(texts) == len(set(texts)) < seen["near_dedup"][0].count()
    assert all("password=" not in r.text or "[secret]" in r.text for r in seen["secrets"][1].collect())
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, SF).collect()
    assert len({(r.sequence_id, r.offset) for r in packed}) == len(packed)
    encode = corpus_pipeline.pack.__globals__["make_encoder"]()
    want = sorted(zlib.crc32(np.append(encode(r.text), [0]).astype("<u4")[:1024].tobytes()) for r in docs.collect())
    assert sorted(r.ids_crc32 for r in packed if r.start == 0) == want


def test_odd_documents(spark):
    rows = [(1, "good text " * 60, None, None, 5), (1, "good text " * 60, None, None, 5), (None, None, "en", "a", None), (2, "", "en", "a", 0), (None, "t " * 80, "en", "b", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    out = corpus_pipeline.near_dedup(spark, docs, SF)
    assert sorted(str(r.doc_id) for r in out.collect()) == ["1", "2", "None", "None"]
    for stage in (corpus_pipeline.secrets, corpus_pipeline.mixing, corpus_pipeline.quality):
        assert stage(spark, docs, SF).columns == docs.columns
    assert corpus_pipeline.near_dedup(spark, docs.limit(0), SF).count() == 0
