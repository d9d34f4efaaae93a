"""SentencePiece lattice and token counts against brute force and the public library."""

from __future__ import annotations

import itertools
from pathlib import Path

import pyarrow as pa
import pytest

from stratile.llm import pieces, tokens

pytestmark = pytest.mark.skipif(not Path(pieces.MODEL).exists(), reason="vocabulary files are absent")

TEXTS = [None, "", " ", "  a  b\n c\tx", "Hello, world!", "naïve café 日本語 😀", "x" * 200, "aaaa bbbb " * 300, "THBLE!!%%% a_b-c", "▁meta", "ab" * 40 + "日本"]


def docs_of(spark, texts):
    return spark.createDataFrame([(i, t, "clash") for i, t in enumerate(texts)], "doc_id long, text string, ids string")


def test_encoding_equals_the_library(spark):
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=pieces.MODEL)
    texts = TEXTS + [TEXTS[4], TEXTS[4]]
    got = {r.doc_id: r for r in pieces.encode(docs_of(spark, texts)).collect()}
    assert len(got) == len(texts)
    for i, t in enumerate(texts):
        assert got[i].ids == library.encode(t or ""), t
        assert got[i].n_tokens == len(got[i].ids)
        assert got[i].decoded_ok
    back = {r.doc_id: r.text for r in pieces.decode(pieces.encode(docs_of(spark, texts))).collect()}
    assert all(back[i] == (t or "").replace("▁", " ") for i, t in enumerate(texts))


def test_empty_table(spark):
    assert pieces.encode(docs_of(spark, [])).count() == 0
    assert tokens.section_token_counts(docs_of(spark, [])).count() == 0


def test_cutting_equals_brute_force():
    vocabulary = pieces.Vocabulary.load()
    cutter = pieces.Cutter(vocabulary)
    neighbours = {p[k : k + 2] for p in vocabulary.table() for k in range(len(p) - 1)}
    texts = [t or "" for t in TEXTS] + [" first", "last ", "two  spaces", "a b"]
    words, bounds = cutter.words(pa.array(texts, pa.string()))
    for t, a, b in zip(texts, bounds[:-1], bounds[1:], strict=True):
        whole = "  " in t or "▁" in t or t != t.strip(" ")
        assert words[a:b].to_pylist() == ([t] if whole else t.split(" ") if t else [])
    seen = []
    for block in pieces.word_blocks(words, 40):
        units, ends = cutter.units(block)
        seen += block.to_pylist()
        for w, a, b in zip(block.to_pylist(), ends[:-1], ends[1:], strict=True):
            whole, found = "▁" + w.replace(" ", "▁"), units[a:b].to_pylist()
            assert "".join(found) == whole
            assert [*itertools.accumulate(map(len, found))] == [j for j in range(1, len(whole) + 1) if whole[j - 1 : j + 1] not in neighbours]
    assert seen == words.to_pylist()


def test_known_units_take_little_memory():
    """Units are held as arrays: an object for each took some hundred bytes a unit in every worker."""
    n = 20_000
    cache = pieces.Cache(pa.table({"unit": [f"▁unit{i}" for i in range(n)], "ids": pa.array([[i, i + 1] for i in range(n)], pa.list_(pa.int32()))}))
    units, sizes, ids = cache.known
    assert units.nbytes + sizes.nbytes + ids.nbytes < 50 * n
    assert units[7].as_py() == "▁unit7" and sizes[7] == 2 and ids[14:16].tolist() == [7, 8]


def test_texts_that_do_not_decode(spark):
    got = {r.doc_id: r for r in pieces.encode(docs_of(spark, ["ab", "aé b", "ab ab", "é", " ab", ""]), toy(pieces.BPE)).collect()}
    assert [got[i].decoded_ok for i in range(6)] == [True, False, True, False, True, True]
    assert got[1].n_tokens == 4 and got[5].ids == []


def toy(kind):
    scores = {"a": -2.0, "b": -2.5, "c": -3.0, "ab": -3.1, "bc": -4.2, "abc": -6.0, "▁": -2.0, "▁a": -2.2, "ca": -4.1}
    return pieces.Vocabulary(("<unk>", *scores), (0.0, *scores.values()), (2, *([1] * len(scores))), kind, True)


def test_viterbi_is_the_best_path(spark):
    vocabulary = toy(pieces.UNIGRAM)
    table = vocabulary.table()
    units = ["".join(p) for n in (1, 2, 3, 4, 5) for p in itertools.product("abc▁", repeat=n) if "▁" not in p[1:]]
    got = {r.unit: r.ids for r in pieces.encode_units(spark.createDataFrame([(u,) for u in units], "unit string"), vocabulary).collect()}

    def paths(u):
        if not u:
            yield ()
        for k in range(1, len(u) + 1):
            if u[:k] in table:
                for rest in paths(u[k:]):
                    yield (table[u[:k]], *rest)

    for u in units:
        best = max(sum(s for _, s in p) for p in paths(u))
        assert sum(vocabulary.scores[i] for i in got[u]) == pytest.approx(best), u
        assert "".join(vocabulary.pieces[i] for i in got[u]) == u


def test_merge_fold_equals_heap_merges(spark):
    vocabulary = toy(pieces.BPE)
    units = ["".join(p) for n in (1, 3, 6) for p in itertools.product("abz", repeat=n)]
    got = {r.unit: r.ids for r in pieces.encode_units(spark.createDataFrame([(u,) for u in units], "unit string"), vocabulary).collect()}
    assert all(got[u] == pieces.merge_parts(u, vocabulary.table(), vocabulary.unknown_ids) for u in units)


@pytest.mark.parametrize("rule", tokens.RULES)
def test_token_counts(spark, rule):
    texts = [None, "", "one two\nthree\n\nfour", "\n\n", "日本\n語😀 text " * 5, " " * 500, "a" * 3000 + "\nb"]
    rows = tokens.section_token_counts(docs_of(spark, texts), rule=rule).collect()
    with open(tokens.VOCABULARY, "rb") as f:
        encoding, lengths = tokens.load_encoding(f.read())
    for i, t in enumerate(texts):
        own = [r for r in rows if r.doc_id == i]
        assert sum(r.n_tokens for r in own) == pytest.approx(len(encoding.encode_ordinary(t or "")))
        assert {r.doc_tokens for r in own} == {len(encoding.encode_ordinary(t or ""))}
        assert "".join((t or "")[r.span_start : r.span_end] for r in sorted(own, key=lambda r: r.section)) == (t or "")
        for r in own:  # brute force by characters
            first, last = tokens.token_spans(t or "", encoding, lengths)
            held = 0.0
            for a, b in zip(first.tolist(), last.tolist(), strict=True):
                inside = max(0, min(b, r.span_end) - max(a, r.span_start))
                if rule == "share":
                    held += inside / (b - a)
                elif rule == "first":
                    held += r.span_start <= a < r.span_end
                else:
                    others = [max(0, min(b, o.span_end) - max(a, o.span_start)) for o in own]
                    held += inside > 0 and inside == max(others) and min(o.section for o, n in zip(own, others, strict=True) if n == max(others)) == r.section
            assert r.n_tokens == pytest.approx(held)


def test_given_spans(spark):
    df = spark.createDataFrame([(1, "alpha beta gamma", [(0, 5), (11, 16)])], "doc_id long, text string, spans array<struct<start: long, end: long>>")
    rows = {r.section: r.n_tokens for r in tokens.section_token_counts(df, spans_col="spans").collect()}
    assert set(rows) == {0, 1, -1}
    with pytest.raises(ValueError, match="rule"):
        tokens.section_token_counts(df, rule="none")
