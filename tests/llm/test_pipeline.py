"""The stages one by one, and the whole against plain versions of each."""

import re

import corpus_pipeline
from tabprep.llm import mixing, quality_rules
from tests.llm.test_text import plain_components, plain_fingerprint

SMALL = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_stages(spark, tmp_path, library=None):
    import public_tokenizers
    from tokenizers import Tokenizer

    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert len(names) == 5
    tables = [docs]
    for n, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, tables[-1], SMALL)
        out.write.parquet(str(tmp_path / str(n)))
        tables.append(spark.read.parquet(str(tmp_path / str(n))))
        if n < 4:
            assert tables[-1].columns == COLUMNS and tables[-1].dtypes == docs.dtypes, name
    raw, good, single, clean, mixed, ids = tables

    judged = {r.doc_id: r for r in quality_rules.judge(raw).collect()}
    assert {r.doc_id: r.text for r in good.collect()} == {i: r.clean_text for i, r in judged.items() if r.kept}

    rows = sorted((r.doc_id, plain_fingerprint(r.text)) for r in good.collect())
    assert sorted(r.doc_id for r in single.collect()) == sorted(set(plain_components(rows)))

    assert sorted(r.doc_id for r in clean.collect()) == sorted(r.doc_id for r in single.collect())
    assert not any(re.search(r"(?i)token = \"?[0-9a-f]{30}", r.text) for r in clean.collect())
    assert all(r.n_chars == len(r.text) for r in clean.collect())

    copies = {r.doc_id: r.copies for r in mixing.plan(clean).collect()}
    counts = {r.doc_id: r["count"] for r in mixed.groupBy("doc_id").count().collect()}
    assert counts == {i: n for i, n in copies.items() if n}

    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    texts = {r.doc_id: r.text for r in mixed.collect()}
    found = ids.collect()
    assert len(found) == mixed.count()
    for r in found:
        assert r.ids == library.encode(texts[r.doc_id], add_special_tokens=False).ids and r.n_tokens == len(r.ids)

    assert sorted(map(repr, corpus_pipeline.run(spark, SMALL).collect())) == sorted(map(repr, found))


def test_empty_documents(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SMALL)
    assert docs.count() == 0
