"""Media columns: texts' bytes kept as 8-bit PCM audio, with log-mel feature tensors and time spans.

The payload (UTF-8 bytes, padded with 255 to a positive multiple of 576) becomes the samples of a mono WAV
file. Features come from the samples read back out of that file: polyphase resampling, overlapped log-mel
filterbanks, hysteresis segmentation by energy. Segments are cut into fixed-shape tensors kept as an Arrow
IPC stream with a FixedShapeTensor column and the time span of each tensor.

Defined results: a null text counts as empty (576 bytes of 255); repeated rows give equal values; an empty
table gives an empty table; further columns of the input are ignored, so their names can't clash. Each text is
computed on its own, in frame blocks, so equal texts give equal values wherever they stand.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

UNIT = 576
PAD = 255
HEADER = 44
RATE, TARGET_RATE = 12_000, 8_000
UP, DOWN, PHASE_TAPS = 2, 3, 8
FRAME, HOP, MELS = 256, 128, 32
TENSOR_FRAMES = 32
FRAME_BLOCK = 4096
#: Output rows are handed to Spark when their bytes pass this.
FLUSH_BYTES = 4_000_000


def payload_of(text: str | None) -> bytes:
    raw = (text or "").encode("utf-8", "surrogatepass")
    return raw + bytes([PAD]) * (max(1, -(-len(raw) // UNIT)) * UNIT - len(raw))


def write_wav(payload: bytes, rate: int = RATE) -> bytes:
    """A canonical mono 8-bit PCM WAV file."""
    n = len(payload)
    return struct.pack("<4sI4s4sIHHIIHH4sI", b"RIFF", 36 + n, b"WAVE", b"fmt ", 16, 1, 1, rate, rate, 1, 8, b"data", n) + payload


def read_wav(media: bytes) -> bytes:
    """The samples of the data chunk."""
    at = 12
    while media[at : at + 4] != b"data":
        at += 8 + struct.unpack_from("<I", media, at + 4)[0]
    return media[at + 8 : at + 8 + struct.unpack_from("<I", media, at + 4)[0]]


@cache
def _low_pass() -> np.ndarray:
    """Windowed-sinc prototype as (phase, tap)."""
    n = UP * PHASE_TAPS
    t = np.arange(n) - (n - 1) / 2
    h = np.sinc(t / max(UP, DOWN)) * np.hamming(n)
    return (h / h.sum() * UP).reshape(PHASE_TAPS, UP).T.astype(np.float32)


def resample(x: np.ndarray) -> np.ndarray:
    """Polyphase rate change by UP / DOWN: only the taps of an output's phase are ever multiplied."""
    taps, n = _low_pass(), len(x) * UP // DOWN
    padded = np.concatenate([np.zeros(PHASE_TAPS, np.float32), x, np.zeros(PHASE_TAPS, np.float32)])
    out = np.zeros(n, np.float32)
    for first in range(min(UP, n)):  # outputs first, first + UP, ... share one phase
        phase, start = first * DOWN % UP, first * DOWN // UP
        count = (n - first + UP - 1) // UP
        acc = np.zeros(count, np.float32)
        for k in range(PHASE_TAPS):
            at = start - k + PHASE_TAPS + PHASE_TAPS // 2
            acc += taps[phase, k] * padded[at : at + (count - 1) * DOWN + 1 : DOWN]
        out[first::UP] = acc
    return out


@cache
def _mel() -> np.ndarray:
    """Triangular filters, equally wide in mel, as (bin, band)."""
    mel = np.linspace(0, 2595 * np.log10(1 + TARGET_RATE / 2 / 700), MELS + 2)
    hz = 700 * (10 ** (mel / 2595) - 1)
    f = np.arange(FRAME // 2 + 1)[:, None] * TARGET_RATE / FRAME
    rise, fall = (f - hz[:-2]) / (hz[1:-1] - hz[:-2]), (hz[2:] - f) / (hz[2:] - hz[1:-1])
    return np.clip(np.minimum(rise, fall), 0, None).astype(np.float32)


def log_mel(y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(frames, MELS) log energies and the frames' energies in dB; at least one frame, zero-padded."""
    n = max(1, 1 + -(-(len(y) - FRAME) // HOP))
    y = np.pad(y, (0, max(0, FRAME + (n - 1) * HOP - len(y))))
    frames = np.lib.stride_tricks.sliding_window_view(y, FRAME)[::HOP]
    window = np.hanning(FRAME).astype(np.float32)
    mel, energy = np.empty((n, MELS), np.float32), np.empty(n, np.float32)
    for a in range(0, n, FRAME_BLOCK):
        power = np.abs(np.fft.rfft(frames[a : a + FRAME_BLOCK] * window)) ** 2
        mel[a : a + FRAME_BLOCK] = np.log(power.astype(np.float32) @ _mel() + 1e-6)
        energy[a : a + FRAME_BLOCK] = 10 * np.log10(power.sum(axis=1) + 1e-6)
    return mel, energy


def segments(energy: np.ndarray) -> np.ndarray:
    """(start, end) frame runs: one opens at mean + sd/2 and lasts until the energy falls under mean - sd/2."""
    mid, sd = float(energy.mean()), float(energy.std())
    mark = np.where(energy >= mid + sd / 2, 1, np.where(energy < mid - sd / 2, 0, -1))
    last = np.maximum.accumulate(np.where(mark >= 0, np.arange(len(mark)), -1))
    on = np.where(last >= 0, mark[last], 0) == 1
    edge = np.flatnonzero(np.diff(np.concatenate([[0], on.astype(np.int8), [0]])))
    return edge.reshape(-1, 2)


def tensors_of(mel: np.ndarray, runs: np.ndarray) -> bytes:
    """Arrow IPC stream: tensor fixed_shape_tensor[TENSOR_FRAMES, MELS] of float16, start_ms, end_ms."""
    spans = [(a, min(a + TENSOR_FRAMES, e)) for s, e in runs.tolist() for a in range(s, e, TENSOR_FRAMES)]
    block = np.full((len(spans), TENSOR_FRAMES, MELS), np.log(1e-6), np.float16)
    for i, (a, e) in enumerate(spans):
        block[i, : e - a] = mel[a:e]
    kind = pa.fixed_shape_tensor(pa.float16(), (TENSOR_FRAMES, MELS))
    storage = pa.FixedSizeListArray.from_arrays(pa.array(block.reshape(-1)), TENSOR_FRAMES * MELS)
    ms = lambda frame: frame * HOP * 1000 // TARGET_RATE
    table = pa.record_batch(
        [pa.ExtensionArray.from_storage(kind, storage), pa.array([ms(a) for a, _ in spans], pa.int64()), pa.array([ms(e) for _, e in spans], pa.int64())],
        names=["tensor", "start_ms", "end_ms"],
    )
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema) as out:
        out.write_batch(table)
    return sink.getvalue().to_pybytes()


def features_of(media: bytes) -> tuple[bytes, int, int]:
    """Tensors, frames and segments of a stored file."""
    x = (np.frombuffer(read_wav(media), np.uint8).astype(np.float32) - 128) / 128
    mel, energy = log_mel(resample(x))
    runs = segments(energy)
    return tensors_of(mel, runs), len(mel), len(runs)


def audio_columns(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, n_bytes, media (WAV), tensors (Arrow IPC), n_frames, n_segments: one row per input row, no shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([(id_col, pa.int64()), ("n_bytes", pa.int64()), ("media", pa.binary()), ("tensors", pa.binary()), ("n_frames", pa.int64()), ("n_segments", pa.int64())])
        for batch in batches:
            rows, held = [], 0
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                text = text.as_py()
                media = write_wav(payload_of(text))
                tensors, frames, runs = features_of(media)
                rows.append((key, len((text or "").encode("utf-8", "surrogatepass")), media, tensors, frames, runs))
                held += len(media) + len(tensors)
                if held > FLUSH_BYTES:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), schema.types, strict=True)], schema=schema)
                    rows, held = [], 0
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), schema.types, strict=True)], schema=schema)

    kept = docs.select(F.col(id_col).cast("long").alias(id_col), F.col(text_col).cast("string").alias("__text"))
    return kept.mapInArrow(run, f"`{id_col}` long, n_bytes long, media binary, tensors binary, n_frames long, n_segments long")


def media_digests(docs: DataFrame) -> DataFrame:
    """The contract's digest columns, derived from the stored media and tensors with Spark's own functions."""
    payload = F.expr(f"substring(media, {HEADER + 1})")
    return audio_columns(docs).select(
        "doc_id",
        "n_bytes",
        F.length(payload).cast("long").alias("payload_bytes"),
        F.sha2(payload, 256).alias("payload_sha256"),
        F.crc32(F.expr("substring(media, -32)")).alias("tail_crc32"),
        F.length("media").cast("long").alias("media_bytes"),
        F.sha2("media", 256).alias("media_sha256"),
        F.concat_ws(":", "n_frames", "n_segments", F.sha2("tensors", 256)).alias("feature"),
    )
