"""The pipeline against a brute-force version of each stage."""

from __future__ import annotations

import pytest

corpus_pipeline = pytest.importorskip("corpus_pipeline")

from stratile.llm import mixing, near_dups, pii, quality  # noqa: E402

SF = "/root/testdata/sf0.001"


def test_stages(spark, tmp_path):
    import sentencepiece

    from stratile.llm.pieces import MODEL

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    kept = []
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, SF).write.parquet(str(tmp_path / str(i)))
        docs = spark.read.parquet(str(tmp_path / str(i)))
        kept.append(docs)
        if i < 4:
            assert docs.columns == list(corpus_pipeline.COLUMNS)
    source = spark.read.parquet(f"{SF}/documents.parquet")
    scored = quality.scored_documents(source, spark.read.parquet(f"{SF}/labels.parquet"))
    good = {r.doc_id for r in scored.filter("predicted = 1").collect()}
    assert {r.doc_id for r in kept[0].collect()} == good
    single = {r.doc_id for r in near_dups.duplicate_groups(kept[0]).filter("kept").collect()}
    assert {r.doc_id for r in kept[1].collect()} == single
    assert kept[1].count() == len(single)
    assert sum(r.n_email + r.n_ip + r.n_card + r.n_phone for r in pii.contract(kept[2]).collect()) == 0
    copies = {r.doc_id: r.copies for r in mixing.mix(kept[2]).collect() if r.copies}
    mixed = [r.doc_id for r in kept[3].collect()]
    assert {i: mixed.count(i) for i in set(mixed)} == copies
    library = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    texts = {r.doc_id: r.text for r in kept[3].collect()}
    for r in kept[4].collect():
        assert r.ids == library.encode(texts[r.doc_id])


def test_run(spark):
    out = corpus_pipeline.run(spark, SF)
    assert out.columns == ["doc_id", "ids", "n_tokens", "decoded_ok"]
    assert out.count() > 0


def test_stages_on_odd_rows(spark):
    """Null columns, empty and long texts, equal rows, shared and null ids, clashing columns, an empty table: no stage fails, none drops what it should keep."""
    good = spark.read.parquet(f"{SF}/documents.parquet").select("text").filter("length(text) > 200").orderBy("doc_id").limit(6).collect()
    a, b, c, d = (r.text for r in good[:4])
    rows = [(1, a, "en", "s", 1), (1, a, "en", "s", 1), (1, b, None, "s", 1), (None, c, "en", None, None), (None, d, "en", None, None), (2, None, "en", "s", 0), (3, "", "en", "s", 0), (4, (a + " ") * 300, "en", "s", 9)]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    docs = spark.createDataFrame([(*r, "x", 0.5) for r in rows], schema + ", value string, score double")
    stages = dict(corpus_pipeline.STAGES)
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF)
        kept = out.collect()
        assert stage(spark, docs.limit(0), SF).count() == 0
        if name != "sentencepiece":
            assert out.columns == list(corpus_pipeline.COLUMNS)
        else:
            assert len(kept) == len(rows) and all(r.decoded_ok for r in kept if r.decoded_ok is not None)
    single = sorted((r.doc_id or 0, r.text or "") for r in stages["minhash near-dedup"](spark, docs, SF).collect())
    assert [t for i, t in single if i in (0, 1)] == [*sorted((c, d)), *sorted((a, b))]
    clean = stages["personal data"](spark, docs, SF).collect()
    assert len(clean) == len(rows) and all(r.n_chars == (None if r.text is None else len(r.text)) for r in clean)
    mixed = stages["source mixing"](spark, docs, SF)
    assert {r.doc_id for r in mixed.collect()} <= {None, 1, 4}
