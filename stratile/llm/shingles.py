"""Hashed word shingles of whole texts, computed for many texts at a time with numpy.

Words are runs of bytes other than ASCII white space, A-Z lower-cased. A shingle is WORDS words in a row; a text with
fewer words has its whole sequence as its one shingle; a text without words has none. Shingles are 64-bit hashes.
"""

from __future__ import annotations

import numpy as np

WORDS = 5
_BYTES = np.random.default_rng(20240229).integers(1, 1 << 63, 256, dtype=np.int64).astype(np.uint64) * np.uint64(2) + np.uint64(1)
_STEP = 0x9E3779B97F4A7C15
_POWERS = np.array([pow(_STEP, i, 1 << 64) for i in range(4096)], np.uint64)
_PLACES = np.array([pow(0xD6E8FEB86659FD93, i + 1, 1 << 64) for i in range(WORDS)], np.uint64)


def mixed(h: np.ndarray) -> np.ndarray:
    """A bijection that spreads every input bit over the word."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def word_hashes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words, and for each text the place of its first word, with the total at the end."""
    raw = [t.encode("utf-8", "surrogatepass") for t in texts]
    sizes = np.array([len(r) + 1 for r in raw], np.int64)
    buf = np.frombuffer(b" ".join([*raw, b""]), np.uint8)
    space = (buf == 32) | ((buf >= 9) & (buf <= 13))
    edge = np.flatnonzero(np.diff(np.concatenate([[True], space])))
    first, last = edge[::2], edge[1::2]
    buf = np.where((buf >= 65) & (buf <= 90), buf + np.uint8(32), buf)
    place = np.arange(len(buf), dtype=np.int64)
    base = np.zeros(len(buf), np.int64)
    base[first] = first
    place -= np.maximum.accumulate(base)
    total = np.zeros(len(buf) + 1, np.uint64)
    far = place >= len(_POWERS)
    power = _POWERS[np.where(far, place % len(_POWERS), place)]
    if far.any():  # very long words: another odd factor for each further block
        power[far] *= _POWERS[(place[far] // len(_POWERS)) % len(_POWERS)] * np.uint64(3)
    np.cumsum(_BYTES[buf] * power, out=total[1:])
    words = mixed(total[last] - total[first] + (last - first).astype(np.uint64))
    bounds = np.concatenate([[0], np.searchsorted(first, np.cumsum(sizes), "left")])
    return words, bounds


def shingle_hashes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all shingles (with repeats) in text order, and their bounds by text."""
    words, bounds = word_hashes(texts)
    n = np.diff(bounds)
    counts = np.where(n >= WORDS, n - WORDS + 1, np.minimum(n, 1))
    out = np.concatenate([[0], np.cumsum(counts)])
    rows = np.zeros(max(0, len(words) - WORDS + 1), np.uint64)
    for i in range(WORDS):
        rows += words[i : i + len(rows)] * _PLACES[i]
    owner = np.repeat(np.arange(len(texts)), counts)
    at = bounds[owner] + np.arange(len(owner)) - out[owner]
    short = (n < WORDS)[owner]
    found = np.empty(len(owner), np.uint64)
    found[~short] = rows[at[~short]]
    for k in np.flatnonzero(short):
        part = words[bounds[owner[k]] : bounds[owner[k] + 1]]
        found[k] = (part * _PLACES[: len(part)]).sum(dtype=np.uint64) ^ np.uint64(len(part))
    return mixed(found), out


def shingle_sets(texts: list[str]) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    found, bounds = shingle_hashes(texts)
    owner = np.repeat(np.arange(len(texts)), np.diff(bounds))
    order = np.lexsort((found, owner))
    found, owner = found[order], owner[order]
    keep = np.ones(len(found), bool)
    keep[1:] = (found[1:] != found[:-1]) | (owner[1:] != owner[:-1])
    return np.split(found[keep], np.cumsum(np.bincount(owner[keep], minlength=len(texts)))[:-1]) if texts else []
