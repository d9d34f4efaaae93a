"""Helpers shared by the training-data operators: Arrow block iteration and fold expressions."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Characters that one numpy block holds at most, unless a single text is longer.
BLOCK_CHARS = 1_000_000

#: White space of the word contracts: a word is a run of anything else.
WORD_PATTERN = r"[^\x20\x09-\x0D]+"


def fold_of(doc_id: Column) -> Column:
    """crc32 of the id's decimal text modulo 4; rows with remainder 2 are held out. NULL ids give NULL."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 4


def sample_key(*cols: Column) -> Column:
    """A uniform number in [0, 1) that depends on the given columns alone."""
    return F.pmod(F.xxhash64(*cols), F.lit(1 << 40)) / F.lit(float(1 << 40))


def blocks(texts: list[str], limit: int = BLOCK_CHARS) -> Iterator[tuple[int, int]]:
    """(start, end) runs of texts whose total length stays within limit; a longer text stands alone."""
    start, total = 0, 0
    for i, t in enumerate(texts):
        if total and total + len(t) > limit:
            yield start, i
            start, total = i, 0
        total += len(t)
    if start < len(texts):
        yield start, len(texts)


def slices(batch: pa.RecordBatch, text: str, limit: int = BLOCK_CHARS) -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    """Parts of an Arrow batch with their texts (null: empty), each part within limit characters where it can."""
    texts = [t or "" for t in batch.column(text).to_pylist()]
    for a, b in blocks(texts, limit):
        yield batch.slice(a, b - a), texts[a:b]


def segment_sums(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Sums of values[starts:ends] along the first axis in double precision; empty segments give 0."""
    total = np.zeros((len(values) + 1, *values.shape[1:]))
    np.cumsum(values, axis=0, dtype=np.float64, out=total[1:])
    return total[ends] - total[starts]
