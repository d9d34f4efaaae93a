"""Quality classifier: supervised subword embeddings.

A document is the average of learned vectors of its hashed character n-grams (3 to 5 code points), words and word pairs
(a word said twice running is one shared pair); a softmax
layer on that average gives the class. Vectors and layer are trained by numpy stochastic gradient descent on a
bounded sample of labelled rows (SAMPLE_ROWS expected at most, chosen by a hash of the id). The softmax over two
classes needs only the projected difference of each vector, so scoring gathers one number per feature.

Inputs of a score are the text alone. Defined results: null and empty texts score by the layer's bias; repeated
rows score alike; an empty table gives no rows; with no labelled row, or one class only, the score is the
constant share of label 1 (0.5 without any). Columns of the input other than id and text are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._text import fold_of, sample_key, segment_sums, slices

BITS = 17
DIM = 8
EPOCHS = 12
RATE = 2.0
SAMPLE_ROWS = 1_200
HELD_OUT = 2
THRESHOLD = 0.7
#: Zeros after each text, so that no n-gram of it reaches the next one.
GAP = 8
SPREAD = np.uint32(2654435761)


def _mixed(h: np.ndarray) -> np.ndarray:
    return ((h * SPREAD) >> np.uint32(32 - BITS)).astype(np.uint32)


def feature_streams(texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(buckets, starts, ends) by kind of feature: text i has buckets[starts[i]:ends[i]]."""
    sizes = np.array([len(t) for t in texts], np.int64)
    gap = "\0" * GAP
    buf = np.frombuffer("".join(t.replace("\0", " ") + gap for t in [*texts, ""]).encode("utf-32-le", "surrogatepass"), np.uint32)
    ends = np.cumsum(sizes + GAP) - GAP
    starts = ends - sizes
    n = len(buf) - GAP
    h = buf[:n]
    for k in range(1, 5):
        h = h * np.uint32(0x01000193) + buf[k : n + k]
        if k >= 2:
            yield _mixed(h ^ np.uint32(k << 24)), starts, ends
    space = (buf == 32) | ((buf >= 9) & (buf <= 13)) | (buf == 0)
    edge = np.flatnonzero(np.diff(np.concatenate([[True], space])))
    first, last = edge[::2], edge[1::2]
    if not len(first):
        return
    at = np.arange(len(buf), dtype=np.int64)
    at = at - np.repeat(np.concatenate([[0], first]), np.diff(np.concatenate([[0], first, [len(buf)]])))
    weight = np.array([pow(0x9E3779B1, i + 1, 1 << 32) for i in range(64)], np.uint32)[at % 64]
    total = np.zeros(len(buf) + 1, np.uint64)
    np.cumsum((buf + np.uint32(1)) * weight, dtype=np.uint64, out=total[1:])
    word = ((total[last] - total[first]) & np.uint64(0xFFFFFFFF)).astype(np.uint32)
    lo, hi = np.searchsorted(first, starts), np.searchsorted(first, ends)
    yield _mixed(word ^ np.uint32(0x11111111)), lo, hi
    pair = np.where(word[:-1] == word[1:], np.uint32(1), word[:-1] * np.uint32(0x85EBCA6B) + word[1:])  # a repeated word is one pair, whichever word it is
    yield _mixed(pair ^ np.uint32(0x22222222)), np.minimum(lo, len(pair)), np.maximum(np.minimum(lo, len(pair)), hi - 1)


@dataclass(frozen=True)
class Model:
    """scores[b]: layer difference times the vector of bucket b; bias: the layer's bias difference."""

    scores: np.ndarray
    bias: float

    def score(self, texts: list[str]) -> np.ndarray:
        total, n = np.zeros(len(texts)), np.zeros(len(texts))
        for buckets, lo, hi in feature_streams(texts):
            total += segment_sums(self.scores[buckets], lo, hi)
            n += hi - lo
        return 1 / (1 + np.exp(-np.clip(total / np.maximum(n, 1) + self.bias, -30, 30)))


def counted(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Distinct buckets of one text and their shares."""
    parts = [b[lo[0] : hi[0]] for b, lo, hi in feature_streams([text])]
    found, n = np.unique(np.concatenate(parts) if parts else np.zeros(0, np.uint32), return_counts=True)
    return found.astype(np.int32), (n / max(1, n.sum())).astype(np.float32)


def train(rows: list[tuple[np.ndarray, np.ndarray, int]], seed: int = 7) -> Model:
    """Stochastic gradient descent, one document a step, with a rate that falls linearly to zero."""
    size, labels = 1 << BITS, np.array([y for *_, y in rows], np.int64)
    if not len(rows) or labels.min() == labels.max():
        share = float(labels.mean()) if len(rows) else 0.5
        return Model(np.zeros(size, np.float32), float(np.log((share + 1e-3) / (1 - share + 1e-3))))
    rng = np.random.default_rng(seed)
    vectors = rng.uniform(-1 / DIM, 1 / DIM, (size, DIM)).astype(np.float32)
    layer, bias = np.zeros((2, DIM), np.float32), np.log(np.bincount(labels, minlength=2) / len(labels)).astype(np.float32)
    steps, done = EPOCHS * len(rows), 0
    for _ in range(EPOCHS):
        for i in rng.permutation(len(rows)):
            buckets, share, y = rows[i]
            mean = share @ vectors[buckets]
            z = layer @ mean + bias
            p = np.exp(z - z.max())
            p /= p.sum()
            p[y] -= 1
            rate = np.float32(RATE * (1 - done / steps))
            back = p @ layer
            layer -= rate * np.outer(p, mean)
            bias -= np.float32(0.02) * rate * p
            vectors[buckets] -= (rate * 20) * share[:, None] * back
            done += 1
    return Model((vectors @ (layer[1] - layer[0])).astype(np.float32), float(bias[1] - bias[0]))


def fit(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> Model:
    """Train on labelled documents outside the held-out fold; at most about sample_rows of them, by a hash of the id."""
    usable = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("y")).filter("doc_id is not null and y in (0, 1)").filter(fold_of(F.col("doc_id")) != HELD_OUT)
    share = sample_rows / max(1, usable.count())
    chosen = usable.filter(sample_key(F.col("doc_id")) < share).limit(2 * sample_rows)  # the limit is a proven bound for the broadcast

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in slices(batch, "text"):
                found = [counted(t) for t in texts]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(2), pa.array([b.tobytes() for b, _ in found]), pa.array([s.tobytes() for _, s in found])], names=["doc_id", "y", "buckets", "shares"])

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = []
        for batch in batches:
            view = lambda name, kind: [np.frombuffer(x.as_buffer(), kind) for x in batch.column(name)]  # noqa: B023, E731  no copies
            rows += zip(batch.column("doc_id").to_pylist(), batch.column("y").to_pylist(), view("buckets", np.int32), view("shares", np.float32), strict=True)
        model = train([(b, s, y) for _, y, b, s in sorted(rows, key=lambda r: (r[0], r[1]))])
        yield pa.RecordBatch.from_arrays([pa.array([model.scores.tobytes()]), pa.array([model.bias])], names=["scores", "bias"])

    # The sample is bounded, so one task trains on it and the driver sees the model alone.
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    sample = texts.join(F.broadcast(chosen), "doc_id").select("doc_id", "text", "y").mapInArrow(run, "doc_id long, y int, buckets binary, shares binary")
    found = sample.repartition(1).mapInArrow(learn, "scores binary, bias double").collect()
    return Model(np.frombuffer(found[0].scores, np.float32), found[0].bias) if found else train([])


def quality_scores(docs: DataFrame, model: Model, text_col: str = "text", score_col: str = "score") -> DataFrame:
    """The input with a score of every whole text; other columns stay."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in slices(batch, text_col):
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(shared.value.score(texts))], names=[*part.schema.names, score_col])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    return docs.mapInArrow(run, f"{fields}, `{score_col}` double")


def scored_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted of every document."""
    kept = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    scored = quality_scores(kept, fit(docs, labels)).drop("text")
    return scored.select("doc_id", F.coalesce(fold_of(F.col("doc_id")) == HELD_OUT, F.lit(False)).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
