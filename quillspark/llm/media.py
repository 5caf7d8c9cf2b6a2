"""Media columns: WAV files of 8-bit samples, short-time Fourier transforms and spectral-peak pair fingerprints.

A text's UTF-8 bytes, with blanks appended up to a positive multiple of UNIT, are the samples of a mono WAV file
written by the wave module. Fingerprints are computed from the bytes read back: a Hann-windowed transform of
UNIT samples every UNIT / 2, the strongest bin of each band of each frame, those of them that are the largest of
their band within NEAR frames and above the band's mean, and each such peak paired with the next FAN peaks at
most REACH frames later. A pair is stored as its time code (frame of the first peak) and a hash of both bins and
the frames between.

Defined results: a null text is empty; empty text is one UNIT of blanks; equal texts get equal values; repeated
rows stay, a null doc_id stays null; other columns are not looked at; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import io
import wave
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

UNIT, RATE, NEAR, FAN, REACH, FRAMES = 192, 8000, 3, 3, 24, 8192
#: First and end bin of each band.
BANDS = ((1, 6), (6, 12), (12, 24), (24, 48), (48, 97))
_WINDOW = np.hanning(UNIT + 1)[:-1].astype(np.float32)


def to_wav(payload: bytes) -> bytes:
    with io.BytesIO() as out:
        with wave.open(out, "wb") as f:
            f.setnchannels(1)
            f.setsampwidth(1)
            f.setframerate(RATE)
            f.writeframes(payload)
        return out.getvalue()


def from_wav(media: bytes) -> bytes:
    with wave.open(io.BytesIO(media), "rb") as f:
        return f.readframes(f.getnframes())


def peaks(samples: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Frames and bins of the spectral peaks, in order."""
    padded = np.concatenate([samples.astype(np.float32) - 128, np.zeros(UNIT // 2, np.float32)])
    frames = np.lib.stride_tricks.sliding_window_view(padded, UNIT)[:: UNIT // 2]
    tops, bins = [], []
    for i in range(0, len(frames), FRAMES):
        power = np.abs(np.fft.rfft(frames[i : i + FRAMES] * _WINDOW, axis=1))
        best = np.stack([power[:, a:b].argmax(1) + a for a, b in BANDS], 1)
        bins.append(best)
        tops.append(np.take_along_axis(power, best, 1))
    top, best = np.concatenate(tops), np.concatenate(bins)
    fence = np.pad(top, ((NEAR, NEAR), (0, 0)), constant_values=-1)
    around = np.lib.stride_tricks.sliding_window_view(fence, 2 * NEAR + 1, axis=0).max(-1)
    frame, band = np.nonzero((top >= around) & (top > top.mean(0, dtype=np.float64)))
    return frame, best[frame, band]


def fingerprints(samples: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Time codes and hashes of the peak pairs, ordered by time code."""
    frame, bin_ = peaks(samples)
    times, hashes = [], []
    for k in range(1, FAN + 1):
        gap = frame[k:] - frame[:-k]
        near = (gap <= REACH) & (gap >= 0)
        times.append(frame[:-k][near])
        hashes.append(((bin_[:-k] << 14) | (bin_[k:] << 7) | gap)[near] if len(gap) else np.zeros(0, np.int64))
    t, h = np.concatenate(times), np.concatenate(hashes)
    order = np.lexsort((h, t))
    return t[order], h[order]


def with_media(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes and media, the WAV file of the text."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [(t.as_py() or "").encode() for t in batch.column(1)]
            media = [to_wav(t + b" " * (-len(t) % UNIT or UNIT * (not t))) for t in texts]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(map(len, texts), pa.int64()), pa.array(media, pa.binary())], ["doc_id", "n_bytes", "media"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(write, "doc_id long, n_bytes long, media binary")


_FEATURES = "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, times array<int>, hashes array<int>"


def with_fingerprints(media: DataFrame) -> DataFrame:
    """From doc_id, n_bytes, media: the payload's and the file's digests and the time-coded fingerprint arrays."""
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.list_(pa.int32()), pa.list_(pa.int32())]
    names = [c.split()[0] for c in _FEATURES.split(", ")]

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for doc_id, n, m in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                stored = m.as_py()
                payload = from_wav(stored)
                t, h = fingerprints(np.frombuffer(payload, np.uint8))
                rows.append((doc_id, n, len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-16:]), len(stored), hashlib.sha256(stored).hexdigest(), t.astype(np.int32), h.astype(np.int32)))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)

    return media.mapInArrow(compute, _FEATURES)


def op5_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = with_fingerprints(with_media(spark.read.parquet(f"{sf_dir}/documents.parquet")))
    digest = F.sha2(F.concat(F.array_join("times", ","), F.lit(";"), F.array_join("hashes", ",")), 256)
    return found.withColumn("feature", F.concat(F.size("times"), F.lit(":"), digest))
