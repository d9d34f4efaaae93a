"""Language identification of mixed texts: script ranges, word scores and a Viterbi path over words.

Words are runs of letters. A word's scripts narrow the candidates to languages that use one of them in the
training texts; hashed character n-grams (1 to 4, with word borders) give each candidate a log-likelihood; a
Viterbi path with a switching penalty labels the words, so spans of one language come out whole. The document's
language is the one that covers most letters, its score the share of letters covered.

The model is counted over a bounded sample of training rows (SAMPLE_ROWS of a language expected at most, chosen by a hash
of the id, so that a rare language is learned from all its rows); the counting is done by the executors. Defined results: null texts and texts without letters give `und` with
score 0; ties go to the first language by code point; with no training row everything is `und`; repeated rows give
equal results; an empty table gives no rows; other columns of the input are ignored.
"""

from __future__ import annotations

import sys
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._text import fold_of, sample_key, segment_sums, slices

BITS = 16
ORDERS = (1, 2, 3, 4)
#: Training rows of a language, about, at most.
SAMPLE_ROWS = 2_000
#: Characters that are labelled at a time (a longer text stands alone): the more texts advance together, the fewer steps.
LABEL_CHARS = 4_000_000
#: Numbers that scoring distinct words holds at a time, about.
SCORE_CELLS = 8_000_000
STEP = np.uint64(0x9E3779B97F4A7C15)
PENALTY = 12.0
HELD_OUT = 2
#: A language uses a script that makes up this share of its letters at least.
SCRIPT_SHARE = 0.02
UNKNOWN = "und"
#: First code points of script ranges (fixed values); a letter belongs to the last range that starts at or before it.
SCRIPTS = {
    "latin": (0x0041, 0x1E00, 0x2C60, 0xA720, 0xFF21),
    "greek": (0x0370, 0x1F00),
    "cyrillic": (0x0400, 0x1C80, 0x2DE0, 0xA640),
    "armenian": (0x0530,),
    "hebrew": (0x0590, 0xFB1D),
    "arabic": (0x0600, 0x0750, 0x08A0, 0xFB50, 0xFE70),
    "indic": (0x0900,),
    "thai": (0x0E00,),
    "georgian": (0x10A0, 0x2D00),
    "hangul": (0x1100, 0xAC00),
    "kana": (0x3040, 0x31F0),
    "han": (0x2E80, 0x3400, 0xF900, 0x20000),
    "other": (0x0000, 0x0700, 0x0780, 0x0E80, 0x1200, 0x2000, 0x3100, 0xA000, 0xA800, 0xFB00, 0x10000),
}
NAMES = tuple(SCRIPTS)


@cache
def tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """By code point: is a letter, lower case, script."""
    n = sys.maxunicode + 1
    letter = np.fromiter((unicodedata.category(chr(i))[0] == "L" for i in range(n)), bool, n)
    lower = np.arange(n, dtype=np.uint32)
    for i in np.flatnonzero(letter):
        if len(x := chr(i).lower()) == 1:
            lower[i] = ord(x)
    ranges = sorted((start, NAMES.index(name)) for name, starts in SCRIPTS.items() for start in starts)
    script = np.zeros(n, np.int8)
    for start, name in ranges:
        script[start:] = name
    return letter, lower, script


def words_of(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Lower-cased code points with a gap after each text; each text's first place; firsts and lasts of words; each word's text."""
    letter, lower, _ = tables()
    sizes = np.array([len(t) for t in texts], np.int64)
    points = np.frombuffer("\0\0\0\0".join([*texts, ""]).encode("utf-32-le", "surrogatepass"), np.uint32)
    begins = np.cumsum(sizes + 4) - sizes - 4
    edge = np.flatnonzero(np.diff(np.concatenate([[False], letter[points], [False]])))
    first, last = edge[::2], edge[1::2]
    return lower[points], begins, first, last, np.searchsorted(begins, first, "right") - 1


def distinct_words(points: np.ndarray, first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A place of each distinct word among the words, and for every word the number of its distinct one (by 64-bit hashes)."""
    sizes = last - first
    starts = np.cumsum(sizes) - sizes
    place = np.arange(int(sizes.sum())) - np.repeat(starts, sizes)
    power = np.cumprod(np.full(int(sizes.max()), STEP, np.uint64))
    letters = points[np.repeat(first, sizes) + place].astype(np.uint64)
    h = np.add.reduceat((letters + np.uint64(1)) * power[place], starts)
    h = (h ^ (h >> np.uint64(29))) * STEP + sizes.astype(np.uint64)
    _, index, inverse = np.unique(h, return_index=True, return_inverse=True)
    return index, inverse


def gram_streams(points: np.ndarray, first: np.ndarray, last: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(buckets, starts, ends) by order: word i has buckets[starts[i]:ends[i]] of n-grams of its bordered letters."""
    sizes = last - first + 2
    ends = np.cumsum(sizes)
    starts = ends - sizes
    letters = np.full(int(ends[-1]) if len(ends) else 0, 1, np.uint32)
    inner = np.ones(len(letters), bool)
    inner[starts], inner[ends - 1] = False, False
    letters[inner] = points[(np.repeat(first - starts - 1, sizes) + np.arange(len(letters)))[inner]]
    h = np.zeros(len(letters), np.uint32)
    for k in ORDERS:
        h = h[: len(letters) - k + 1] * np.uint32(0x01000193) + letters[k - 1 :] if len(letters) >= k else h[:0]
        yield ((h * np.uint32(2654435761)) ^ np.uint32(k * 0x9E3779B1 & 0xFFFFFFFF)) >> np.uint32(32 - BITS), starts, np.maximum(starts, ends - k + 1)


@dataclass(frozen=True)
class Model:
    """langs in code point order; logp[bucket, lang]; scripts[script, lang]: the language uses the script."""

    langs: tuple[str, ...]
    logp: np.ndarray
    scripts: np.ndarray

    def word_scores(self, points: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
        """Log-likelihoods of words by language, 0 for the best of all; languages that don't use a word's script are out."""
        value = np.zeros((len(first), len(self.langs)))
        parts = np.cumsum(last - first + 2) * len(self.langs) // SCORE_CELLS
        for a in np.flatnonzero(np.diff(parts, prepend=-1)).tolist():
            b = int(np.searchsorted(parts, parts[a], "right"))
            for buckets, lo, hi in gram_streams(points, first[a:b], last[a:b]):
                value[a:b] += segment_sums(self.logp[buckets], lo, hi)
        allowed = self.scripts[tables()[2][points[first]]]
        allowed |= ~allowed.any(axis=1, keepdims=True)  # a script that no language uses narrows nothing
        return np.where(allowed, value - value.max(axis=1, keepdims=True), -1e6)

    def label(self, texts: list[str]) -> tuple[list[str], np.ndarray, list[list[tuple[int, int, str]]]]:
        """Language, score and spans (start, end, language in characters) of each text. A word is scored once, however often it is said."""
        points, begins, first, last, owner = words_of(texts)
        langs, n = [UNKNOWN] * len(texts), len(self.langs)
        score, spans = np.zeros(len(texts)), [[] for _ in texts]
        if not len(first) or not n:
            return langs, score, spans
        index, inverse = distinct_words(points, first, last)
        path = viterbi(self.word_scores(points, first[index], last[index]), inverse, owner, len(texts))
        size = (last - first).astype(np.float64)
        cover = np.bincount(owner * n + path, size, len(texts) * n).reshape(len(texts), n)
        has = cover.sum(axis=1) > 0
        best = cover.argmax(axis=1)
        score[has] = cover[has, best[has]] / cover[has].sum(axis=1)
        for i in np.flatnonzero(has):
            langs[i] = self.langs[best[i]]
        cut = np.flatnonzero(np.concatenate([[True], (np.diff(owner) != 0) | (np.diff(path) != 0)]))
        for a, b in zip(cut.tolist(), [*cut[1:].tolist(), len(first)], strict=True):
            i = int(owner[a])
            spans[i].append((int(first[a] - begins[i]), int(last[b - 1] - begins[i]), self.langs[path[a]]))
        return langs, score, spans


def viterbi(value: np.ndarray, word: np.ndarray, owner: np.ndarray, n_texts: int) -> np.ndarray:
    """Best state of every word (word i scores value[word[i]]); texts advance together, longest first, so the loop is over word positions.

    What a step keeps is a bit for each state (it was switched to) and the state that a switch comes from.
    """
    counts = np.bincount(owner, minlength=n_texts)
    order = np.argsort(-counts, kind="stable")
    start = (np.cumsum(counts) - counts)[order]
    counts = counts[order]
    longest, states = int(counts[0]), value.shape[1]
    active = np.searchsorted(-counts, -np.arange(longest), "left").tolist()  # texts with more than t words
    switched = np.zeros((len(word), -(-states // 8)), np.uint8)
    origin = np.zeros(len(word), np.int32)
    best = value[word[start[: active[0]]]]
    for t in range(1, longest):
        final = best[: active[t]]
        at = start[: active[t]] + t
        top = final.argmax(axis=1)
        jump = final[np.arange(len(top)), top][:, None] - PENALTY
        origin[at] = top
        switched[at] = np.packbits(jump > final, axis=1)
        np.maximum(final, jump, out=final)
        final += value[word[at]]
    path = np.empty(len(word), np.int64)
    state = best.argmax(axis=1)
    for t in range(longest - 1, -1, -1):
        own = state[: active[t]]
        at = start[: active[t]] + t
        path[at] = own
        if t:
            moved = (switched[at, own >> 3] >> (7 - (own & 7))) & 1
            state[: active[t]] = np.where(moved == 1, origin[at], own)
    return path


def fit(docs: DataFrame, sample_rows: int = SAMPLE_ROWS) -> Model:
    """Count n-grams and scripts by language over training rows: text and lang known, outside the held-out fold.

    A language has about sample_rows of them at most, chosen by a hash of the id; a rarer one has all of its rows.
    """
    usable = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang")).filter("text is not null and lang is not null").filter(fold_of(F.col("doc_id")) != HELD_OUT)
    # One row a language, as in the model itself, which every executor holds.
    shares = [(r.lang, sample_rows / r.n) for r in usable.groupBy("lang").agg(F.count("*").alias("n")).collect()]
    share = F.broadcast(docs.sparkSession.createDataFrame(shares, "lang string, share double"))
    chosen = usable.join(share, "lang").filter(sample_key(F.col("doc_id")) < F.col("share")).select("text", "lang")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams: dict[str, np.ndarray] = {}
        scripts: dict[str, np.ndarray] = {}
        for batch in batches:
            for part, texts in slices(batch, "text"):
                names = part.column("lang").to_pylist()
                for lang in set(names):
                    points, _, first, last, _ = words_of([t for t, x in zip(texts, names, strict=True) if x == lang])
                    g = grams.setdefault(lang, np.zeros(1 << BITS, np.int64))
                    s = scripts.setdefault(lang, np.zeros(len(NAMES), np.int64))
                    if len(first):
                        s += np.bincount(tables()[2][points[first]], minlength=len(NAMES))
                    for buckets, lo, hi in gram_streams(points, first, last):
                        mark = np.bincount(lo, minlength=len(buckets) + 1)[: len(buckets) + 1] - np.bincount(hi, minlength=len(buckets) + 1)[: len(buckets) + 1]
                        g += np.bincount(buckets[np.cumsum(mark[:-1]) > 0], minlength=1 << BITS)
        for lang, g in grams.items():
            at = np.flatnonzero(g)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at), pa.string()), pa.array(at), pa.array(g[at])], names=["lang", "slot", "n"])
            at = np.flatnonzero(scripts[lang])
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at), pa.string()), pa.array(-1 - at), pa.array(scripts[lang][at])], names=["lang", "slot", "n"])

    found = chosen.mapInArrow(run, "lang string, slot long, n long").groupBy("lang", "slot").agg(F.sum("n").alias("n")).toPandas()
    langs = tuple(sorted(found.lang.unique()))
    grams, scripts = np.zeros((1 << BITS, len(langs))), np.zeros((len(NAMES), len(langs)))
    column = found.lang.map({x: i for i, x in enumerate(langs)}).to_numpy(np.int64) if len(found) else np.zeros(0, np.int64)
    slot, n = found.slot.to_numpy(np.int64), found.n.to_numpy(float)
    grams[slot[slot >= 0], column[slot >= 0]] = n[slot >= 0]
    scripts[-1 - slot[slot < 0], column[slot < 0]] = n[slot < 0]
    logp = np.log((grams + 0.5) / (grams.sum(axis=0) + 0.5 * (1 << BITS))).astype(np.float32)
    return Model(langs, logp, scripts > SCRIPT_SHARE * scripts.sum(axis=0))


def language_spans(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, lang_pred, score, spans array<struct<start, end, lang>> of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("lang", pa.string())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in slices(batch, "__text", LABEL_CHARS):
                langs, score, spans = shared.value.label(texts)
                rows = [[{"start": a, "end": b, "lang": x} for a, b, x in s] for s in spans]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(langs, pa.string()), pa.array(score), pa.array(rows, span)], names=[id_col, "lang_pred", "score", "spans"])

    kept = docs.select(F.col(id_col).cast("long").alias(id_col), F.col(text_col).cast("string").alias("__text"))
    return kept.mapInArrow(run, f"`{id_col}` long, lang_pred string, score double, spans array<struct<start: bigint, end: bigint, lang: string>>")


def predicted_languages(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score, n_spans of every document."""
    found = language_spans(docs, fit(docs))
    return found.select("doc_id", F.coalesce(fold_of(F.col("doc_id")) == HELD_OUT, F.lit(False)).alias("held_out"), "lang_pred", "score", F.size("spans").alias("n_spans"))
