"""Token counts by section: whole documents are encoded once, and token spans are attributed to sections.

A byte-level BPE vocabulary encodes each whole text; the bytes of its tokens tile the text, so character spans
follow from cumulative lengths. Spans are interval-joined to the sections (lines, with their line end, or spans
given in a column) by binary search. A token that crosses a boundary is allocated by RULE:

- majority: to the section that holds most of its characters, on ties the earlier one;
- first: to the section that holds its first character;
- share: to every section it touches, in proportion to its characters (counts become fractions).

A token inside one character (part of a multi-byte sequence) belongs to the character it starts in. Characters
outside all given sections are counted under section -1.

Defined results: a null or empty text gives one row, section 0 with 0 tokens; repeated rows are counted each;
an empty table gives no rows; other columns of the input are ignored. Nothing is shuffled.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._text import slices

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: The vocabulary's splitting pattern (a fixed value of the public tokenizer).
PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}++| ?\p{N}++| ?[^\s\p{L}\p{N}]++|\s++$|\s+(?!\S)|\s"
RULES = ("majority", "first", "share")


def load_encoding(data: bytes):
    """The encoding and the byte length of every id."""
    import tiktoken

    ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in data.splitlines() if line)}
    lengths = np.zeros(max(ranks.values()) + 1, np.int64)
    for piece, i in ranks.items():
        lengths[i] = len(piece)
    return tiktoken.Encoding("bytes", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}), lengths


def token_spans(text: str, encoding, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Character starts and ends of the tokens: a token ends after the last character it has a first byte of."""
    ids = np.asarray(encoding.encode_ordinary(text), np.int64)
    raw = np.frombuffer(text.encode("utf-8"), np.uint8)
    chars = np.concatenate([[0], np.cumsum((raw & 0xC0) != 0x80)])  # characters begun before each byte
    ends = np.cumsum(lengths[ids])
    starts = ends - lengths[ids]
    inside = (raw[starts] & 0xC0) == 0x80 if len(ids) else np.zeros(0, bool)
    first = chars[starts] - inside
    return first, np.maximum(chars[ends], first + 1)


def line_bounds(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of lines, line feeds with the line they end."""
    at = np.flatnonzero(np.frombuffer(text.encode("utf-32-le"), np.uint32) == 10) + 1
    edges = np.unique(np.concatenate([[0], at, [len(text)]]))
    return (edges[:-1], edges[1:]) if len(edges) > 1 else (np.array([0]), np.array([0]))


def attribute(first: np.ndarray, last: np.ndarray, starts: np.ndarray, ends: np.ndarray, rule: str) -> tuple[np.ndarray, float]:
    """Token counts of sorted disjoint sections, and what falls outside them."""
    counts = np.zeros(len(starts))
    if not len(first):
        return counts, 0.0
    lo = np.searchsorted(ends, first, "right")  # first section that ends after the token's start
    hi = np.searchsorted(starts, last, "left")  # sections before hi start before the token's end
    touched = np.maximum(hi - lo, 0)
    if rule == "first":
        ok = (lo < len(starts)) & (starts[np.minimum(lo, len(starts) - 1)] <= first)
        np.add.at(counts, lo[ok], 1)
        return counts, float((~ok).sum())
    token = np.repeat(np.arange(len(first)), touched)
    section = np.arange(len(token)) - np.repeat(np.cumsum(touched) - touched, touched) + lo[token]
    overlap = np.minimum(last[token], ends[section]) - np.maximum(first[token], starts[section])
    keep = overlap > 0
    token, section, overlap = token[keep], section[keep], overlap[keep]
    if rule == "share":
        np.add.at(counts, section, overlap / (last - first)[token])
        return counts, float(len(first) - counts.sum())
    order = np.lexsort((section, -overlap, token))
    best = order[np.unique(token[order], return_index=True)[1]]
    outside = (last - first).copy()
    np.subtract.at(outside, token, overlap)
    best = best[overlap[best] >= outside[token[best]]]
    np.add.at(counts, section[best], 1)
    return counts, float(len(first) - len(best))


def section_token_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", spans_col: str | None = None, rule: str = "majority", vocabulary: str = VOCABULARY) -> DataFrame:
    """id, section, span_start, span_end, n_tokens (double under rule share, else whole), doc_tokens.

    spans_col: array<struct<start, end>> of disjoint character spans, or None for lines. The vocabulary (a file of
    fixed size) is read by the driver and broadcast, so executors need no local copy.
    """
    if rule not in RULES:
        raise ValueError(f"rule must be one of {RULES}")
    with open(vocabulary, "rb") as f:
        shared = docs.sparkSession.sparkContext.broadcast(f.read())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoding, lengths = load_encoding(shared.value)
        for batch in batches:
            for part, texts in slices(batch, "__text"):
                keys, given = part.column(0).to_pylist(), part.column(2).to_pylist() if spans_col else [None] * len(texts)
                out: list[list] = [[], [], [], [], [], []]
                for key, text, spans in zip(keys, texts, given, strict=True):
                    if spans_col:
                        pairs = np.array(sorted((s["start"], s["end"]) for s in spans or ()), np.int64).reshape(-1, 2)
                        starts, ends = pairs[:, 0], pairs[:, 1]
                    else:
                        starts, ends = line_bounds(text)
                    first, last = token_spans(text, encoding, lengths)
                    counts, rest = attribute(first, last, starts, ends, rule) if len(starts) else (np.zeros(0), float(len(first)))
                    rows = [(i, s, e, c) for i, (s, e, c) in enumerate(zip(starts.tolist(), ends.tolist(), counts.tolist(), strict=True))]
                    if rest > 1e-9:
                        rows.append((-1, None, None, rest))
                    for column, values in zip(out, zip(*((key, *r, len(first)) for r in rows), strict=True) if rows else (), strict=False):
                        column.extend(values)
                if out[0]:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, schema.types, strict=True)], schema=schema)

    schema = pa.schema([(id_col, pa.int64()), ("section", pa.int64()), ("span_start", pa.int64()), ("span_end", pa.int64()), ("n_tokens", pa.float64()), ("doc_tokens", pa.int64())])
    kept = docs.select(F.col(id_col).cast("long").alias(id_col), F.col(text_col).cast("string").alias("__text"), *([F.col(spans_col)] if spans_col else []))
    found = kept.mapInArrow(run, f"`{id_col}` long, section long, span_start long, span_end long, n_tokens double, doc_tokens long")
    return found if rule == "share" else found.withColumn("n_tokens", F.col("n_tokens").cast("long"))
