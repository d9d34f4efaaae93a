"""Near-duplicate documents and vectors, components and media columns against brute force."""

from __future__ import annotations

import hashlib
import io
import random
import re
import wave
import zlib

import numpy as np
import pyarrow as pa
import pytest

from stratile.llm import components, media, near_dups, vectors
from stratile.llm.shingles import shingle_sets


def groups(n, links):
    parent = list(range(n))

    def find(a):
        while parent[a] != a:
            parent[a] = parent[parent[a]]
            a = parent[a]
        return a

    for a, b in links:
        x, y = find(a), find(b)
        parent[max(x, y)] = min(x, y)
    return [find(a) for a in range(n)]


def shingles(t):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()


def test_shingle_sets():
    texts = ["", "a b", "A  b\n", "a b c d e f a b c d e", "É é Ü", "w" * 9000 + " x y z v", "a b c d e"]
    sets = shingle_sets(texts)
    assert [len(s) for s in sets] == [len(shingles(t)) for t in texts]
    assert sets[1].tolist() == sets[2].tolist()
    assert set(sets[6].tolist()) < set(sets[3].tolist())


def corpus():
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(4))
    passage = " ".join(word() for _ in range(60))
    texts = [None, "", " \n", "one two", "One  two", "one two three"]
    for _ in range(30):
        base = [word() for _ in range(rng.randint(8, 160))]
        texts.append(" ".join(base))
        for _ in range(rng.randint(0, 6)):
            copy = [w if rng.random() > 0.02 else word() for w in base]
            texts.append(" ".join(copy).upper() if rng.random() < 0.3 else " ".join(copy))
    texts += [passage + " " + " ".join(word() for _ in range(rng.randint(1, 60))) for _ in range(60)]
    star = [word() for _ in range(120)]
    texts += [" ".join(w if rng.random() > 0.025 else word() for w in star) for _ in range(80)]
    return texts + texts[10:14]


def test_near_duplicates_equal_brute_force(spark):
    texts = corpus()
    sets = [shingles(t) for t in texts]
    links = [(i, j) for i in range(len(texts)) for j in range(i) if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j])]
    want = groups(len(texts), links)
    df = spark.createDataFrame([(i, t, "clash") for i, t in enumerate(texts)], "doc_id long, text string, set_key string")
    got = {r.doc_id: r for r in near_dups.duplicate_groups(df).collect()}
    assert len(got) == len(texts)
    for i, r in got.items():
        assert (r.n_shingles, r.component_id, r.kept) == (len(sets[i]), want[i], want[i] == i)
    assert near_dups.duplicate_groups(df.limit(0)).count() == 0


def test_near_duplicates_of_sets_on_both_sides_of_the_sketch_size(spark):
    rng = random.Random(8)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(8))
    texts = []
    for small, large in ((64, 85), (64, 83), (63, 84), (62, 82), (61, 81), (60, 80), (58, 77), (49, 65), (66, 85)):
        for _ in range(25):  # pairs that share nothing with others
            words = [word() for _ in range(large + 4)]
            texts += [" ".join(words[: small + 4]), " ".join(words)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: (r.component_id, r.kept) for r in near_dups.duplicate_groups(df).collect()}
    assert [i for i in range(len(texts)) if got[i] != (i - i % 2, i % 2 == 0)] == []


def test_near_duplicates_null_and_repeated_ids(spark):
    rng = random.Random(3)
    a, b, c = (" ".join(f"w{rng.randrange(10**6)}" for _ in range(40)) for _ in range(3))
    rows = [(7, a), (7, a), (None, a), (None, None), (9, a.upper()), (1, a + " x"), (7, b), (2, b + " x"), (None, c), (None, c + " x"), (None, c), (5, ""), (5, "")]
    df = spark.createDataFrame([(*r, "clash") for r in rows], "doc_id long, text string, __row string")
    got = sorted((str(r.doc_id), r.n_shingles, str(r.component_id), r.kept) for r in near_dups.duplicate_groups(df.drop("__row")).collect())
    want = [("7", 36, "1", False)] * 2 + [("None", 36, "1", False), ("9", 36, "1", False), ("1", 37, "1", True), ("7", 36, "2", False), ("2", 37, "2", True)]
    want += [("None", 36, "None", True)] * 2 + [("None", 37, "None", True), ("None", 0, "None", True), ("5", 0, "5", True), ("5", 0, "5", True)]
    assert got == sorted(want)
    kept = [(r.doc_id, r.text) for r in near_dups.deduplicated(df.drop("__row")).collect()]
    assert sorted(t for i, t in kept if i is not None) == sorted([a + " x", b + " x", "", ""])
    assert sorted(str(t) for i, t in kept if i is None)[0] == "None"
    assert [t for i, t in kept if i is None and t is not None] in ([c], [c + " x"])
    assert near_dups.deduplicated(df.drop("__row").limit(0)).count() == 0


def test_near_duplicates_of_templates(spark):
    rng = random.Random(11)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(6))
    form = [word() for _ in range(100)]
    texts = [" ".join(form + [word() for _ in range(rng.choice([5, 20, 25, 60]))]) for _ in range(120)]
    sets = [shingles(t) for t in texts]
    links = [(i, j) for i in range(len(texts)) for j in range(i) if 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j])]
    want = groups(len(texts), links)
    got = {r.doc_id: r.component_id for r in near_dups.duplicate_groups(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    assert [got[i] for i in range(len(texts))] == want
    assert len(set(want)) > 10


@pytest.mark.parametrize("local", [0, 30, 10**6])
def test_components(spark, monkeypatch, local):
    monkeypatch.setattr(components, "LOCAL_LINKS", local)
    rng = random.Random(1)
    links = [(rng.randrange(200), rng.randrange(200)) for _ in range(120)] + [(i, i + 1) for i in range(300, 340)] + [(400, k) for k in range(401, 480)] + [(5, 5)]
    got = {r.node: r.component for r in components.components(spark.createDataFrame(links, "a long, b long")).collect()}
    want = groups(500, links)
    touched = {x for a, b in links if a != b for x in (a, b)}
    assert got == {x: want[x] for x in touched}
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_vectors_equal_brute_force(spark):
    rng = np.random.default_rng(2)
    base = rng.normal(size=(150, 16))
    rows = [v for v in base]
    for k in range(40):
        rows += [base[k] + rng.normal(size=16) * s for s in (0.05, 0.2, 0.3)]
    rows += [base[3] + rng.normal(size=16) * 0.02 for _ in range(150)]
    rows += [base[4] * 3, base[5], base[5]]
    x = np.array(rows, np.float32)
    unit = x.astype(float) / np.linalg.norm(x.astype(float), axis=1, keepdims=True)
    near = unit @ unit.T >= 0.95
    np.fill_diagonal(near, False)
    want = groups(len(x), zip(*map(list, np.nonzero(near)), strict=True))
    bad = [None, [0.0] * 16, [float("nan")] + [1.0] * 15, [float("inf")] + [1.0] * 15, [None] + [1.0] * 15, [], [1.0, 2.0], [2.0, 4.0]]
    data = [(i, v.tolist(), 1, "clash") for i, v in enumerate(x)] + [(1000 + i, v, 1, "clash") for i, v in enumerate(bad)] + [(None, x[0].tolist(), 0, "clash")]
    df = spark.createDataFrame(data, "vec_id long, embedding array<float>, label int, component_id string")
    got = {r.vec_id: r for r in vectors.vector_groups(df).collect()}
    assert len(got) == len(data)
    for i in range(len(x)):
        assert (got[i].n_links, got[i].component_id) == (near[i].sum(), want[i])
        assert got[i].kept == (want[i] == i)
    assert [(got[1000 + i].n_links, got[1000 + i].component_id) for i in range(8)] == [(0, 1000 + i) for i in range(6)] + [(1, 1006), (1, 1006)]
    assert got[None].n_links == 0
    assert vectors.vector_groups(df.limit(0)).count() == 0


def test_blocks_keep_bridges_between_dense_groups(spark):
    rng = np.random.default_rng(4)
    at = np.eye(32)[0], np.cos(0.5) * np.eye(32)[0] + np.sin(0.5) * np.eye(32)[1]
    ends = [np.cos(a) * np.eye(32)[0] + np.sin(a) * np.eye(32)[1] for a in (0.12, 0.38)]
    x = np.array([a + rng.normal(size=32) * 0.001 for a in at for _ in range(20)] + ends)
    rows = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "id long, v array<double>")
    one = rows.selectExpr("1L as key", "id", "true as new")
    met = vectors.local_join(one, vectors.group_sizes(one), rows, 2).filter("sim >= 0.95").collect()
    assert len(met) <= 5 * len(x)
    assert groups(len(x), [(r.u, r.v) for r in met]) == [0] * len(x)


def test_rounds_compare_new_members_alone(spark):
    edges = [(1, 2, 0), (1, 3, 0), (1, 4, 1), (3, 4, 1), (5, 6, 0)]
    graph = spark.createDataFrame([(u, v, 0.5, s) for u, v, s in edges], "u long, v long, sim double, since int")
    made = vectors.neighbour_groups(graph, 1)
    assert {(r.key, r.id): r.new for r in made.collect() if r.key in (1, 5)} == {(1, 1): False, (1, 2): False, (1, 3): False, (1, 4): True, (5, 5): False, (5, 6): False}
    sizes = vectors.group_sizes(made)
    assert {r.key for r in sizes.collect()} == {1, 3, 4}
    rows = spark.createDataFrame([(i, [float(i), 1.0, 2.0]) for i in range(1, 7)], "id long, v array<double>")
    met = vectors.local_join(made.filter("key = 1"), sizes, rows, 2).collect()
    assert {(r.u, r.v) for r in met} >= {(4, 1), (4, 2), (4, 3), (1, 4), (2, 4), (3, 4)}
    assert all(4 in (r.u, r.v) for r in met)
    last = spark.createDataFrame([(5, vectors.BLOCK + 1, True), (2, vectors.BLOCK, True)], "key long, n long, whole boolean")
    assert {r.key: r.whole for r in vectors.group_sizes(made, last).collect()} == {1: False, 3: False, 4: False, 5: True}


def test_many_vectors_equal_brute_force(spark):
    rng = np.random.default_rng(11)
    x = rng.normal(size=(3000, 6))
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    near = unit @ unit.T >= 0.95
    np.fill_diagonal(near, False)
    want = groups(len(x), zip(*map(list, np.nonzero(near)), strict=True))
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    got = {r.vec_id: r for r in vectors.vector_groups(df).collect()}
    assert [(got[i].n_links, got[i].component_id) for i in range(len(x))] == [(near[i].sum(), want[i]) for i in range(len(x))]


def test_media(spark):
    texts = [None, "", "abc", "é" * 288, "é" * 289, "long text " * 3000, "abc"]
    df = spark.createDataFrame([(i, t, b"clash") for i, t in enumerate(texts)], "doc_id long, text string, media binary")
    got = {r.doc_id: r for r in media.media_digests(df).collect()}
    for i, t in enumerate(texts):
        raw = (t or "").encode()
        payload = raw + b"\xff" * (max(576, -(-len(raw) // 576) * 576) - len(raw))
        r = got[i]
        assert (r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32) == (len(raw), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-32:]))
        stored = media.write_wav(payload)
        assert (r.media_bytes, r.media_sha256) == (len(stored), hashlib.sha256(stored).hexdigest())
        with wave.open(io.BytesIO(stored)) as w:
            assert w.readframes(w.getnframes()) == payload
    assert got[2].feature == got[6].feature
    assert got[0].feature == got[1].feature
    row = media.audio_columns(df.filter("doc_id = 5")).first()
    table = pa.ipc.open_stream(row.tensors).read_all()
    assert table.schema.field("tensor").type.shape == [media.TENSOR_FRAMES, media.MELS]
    assert all(a < b for a, b in zip(table["start_ms"].to_pylist(), table["end_ms"].to_pylist(), strict=True))
    assert media.audio_columns(df.limit(0)).count() == 0


def test_resampling_keeps_a_tone():
    t = np.arange(12_000) / media.RATE
    y = media.resample(np.sin(2 * np.pi * 500 * t).astype(np.float32))
    peak = np.abs(np.fft.rfft(y * np.hanning(len(y)))).argmax() * media.TARGET_RATE / len(y)
    assert len(y) == 8_000
    assert abs(peak - 500) < 2
    high = media.resample(np.sin(2 * np.pi * 5500 * t).astype(np.float32))
    assert np.abs(high[100:-100]).max() < 0.2
