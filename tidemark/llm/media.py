"""Media columns: texts kept as WAV audio, with spectral-peak fingerprints.

``to_wav`` writes the UTF-8 bytes of a text, zero-padded to a multiple of 64, as 8-bit mono samples through the wave
module; the query stores them as a Parquet column in the shared folder. ``fingerprints`` opens that stored form, takes a short-time Fourier transform of the samples in blocks of bounded
size, keeps the strongest peak of each band and frame that stands above its frame's mean, and codes pairs of peaks (bin, bin,
frames between) with the frame they start at, as two parallel arrays. No shuffle: rows stay where the input files put them.

Defined results: null text is empty, which pads to 64 zero bytes; equal texts have equal values; null ``doc_id``, repeated
rows and other columns do not matter; an empty table gives an empty result; a payload shorter than a frame is one frame.
"""

from __future__ import annotations

import hashlib
import io
import wave
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tidemark.llm.common import documents, staged, text_of

UNIT = 64
RATE = 8000
FRAME, HOP = 512, 256
BLOCK = 2048  # frames transformed at once
BANDS = np.array([4, 16, 40, 100, 257])  # bins; below the first is the drift of the mean
REACH = 2


def wav_bytes(payload: bytes) -> bytes:
    out = io.BytesIO()
    with wave.open(out, "wb") as w:
        w.setnchannels(1)
        w.setsampwidth(1)
        w.setframerate(RATE)
        w.writeframes(payload)
    return out.getvalue()


def wav_payload(media: bytes) -> bytes:
    with wave.open(io.BytesIO(media), "rb") as w:
        if (w.getnchannels(), w.getsampwidth()) != (1, 1):
            raise ValueError("expected 8-bit mono samples")
        return w.readframes(w.getnframes())


def pad(raw: bytes) -> bytes:
    return raw + bytes(-len(raw) % UNIT or (0 if raw else UNIT))


_HANN = np.hanning(FRAME).astype(np.float32)


def peaks(payload: bytes) -> np.ndarray:
    """Frames by bands: the bin of the band's peak, or -1."""
    samples = np.frombuffer(payload, np.uint8)
    frames = max(1, 1 + -(-(len(samples) - FRAME) // HOP))
    out = []
    for a in range(0, frames, BLOCK):
        n = min(BLOCK, frames - a)
        part = samples[a * HOP : (a + n - 1) * HOP + FRAME].astype(np.float32) - 128
        part = np.pad(part, (0, (n - 1) * HOP + FRAME - len(part)))
        framed = np.lib.stride_tricks.sliding_window_view(part, FRAME)[::HOP]
        power = np.abs(np.fft.rfft(framed * _HANN, axis=1))
        level = power[:, BANDS[0] :].mean(axis=1) * 1.5
        best = [power[:, lo:hi].argmax(axis=1) + lo for lo, hi in zip(BANDS[:-1], BANDS[1:], strict=True)]
        out.append(np.stack([np.where(power[np.arange(n), b] > level, b, -1) for b in best], axis=1))
    return np.concatenate(out).astype(np.int32)


def peak_pairs(peak: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(times, codes), in order of time and then code."""
    times, codes = [], []
    for step in range(1, REACH + 1):
        here, there = peak[:-step], peak[step:]
        for band in range(peak.shape[1]):
            other = (band + 1) % peak.shape[1]
            both = np.flatnonzero((here[:, band] >= 0) & (there[:, other] >= 0))
            times.append(both)
            codes.append(here[both, band] << 13 | there[both, other] << 4 | step)
    t, c = np.concatenate(times).astype(np.int32), np.concatenate(codes).astype(np.int32)
    order = np.argsort(t.astype(np.int64) << 32 | c, kind="stable")
    return t[order], c[order]


def to_wav(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, media: the stored form of every text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw = [t.as_py().encode() for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array([len(r) for r in raw], pa.int64()), pa.array([wav_bytes(pad(r)) for r in raw], pa.binary())], ["doc_id", "n_bytes", "media"])

    rows = docs.select("doc_id", text_of().alias("text"))
    return rows.mapInArrow(run, f"doc_id {dict(docs.dtypes)['doc_id']}, n_bytes bigint, media binary")


def fingerprints(media: DataFrame) -> DataFrame:
    """What the stored bytes give: payload and media digests, the peak pairs (times, codes) and their digest."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, times, codes, ends = [], [], [], [0]
            for stored in batch.column("media"):
                whole = stored.as_py()
                payload = wav_payload(whole)
                t, c = peak_pairs(peaks(payload))
                times.append(t)
                codes.append(c)
                ends.append(ends[-1] + len(t))
                mark = hashlib.sha256(t.astype("<i4").tobytes() + c.astype("<i4").tobytes()).hexdigest()
                rows.append((len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-UNIT:]), len(whole), hashlib.sha256(whole).hexdigest(), f"{len(t)}:{mark[:32]}"))
            cols = list(zip(*rows, strict=True)) or [[]] * 6
            kinds = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string()]
            flat = [pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(x) if x else [], pa.int32())) for x in (times, codes)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("n_bytes"), *[pa.array(x, k) for x, k in zip(cols, kinds, strict=True)], *flat], NAMES)

    schema = f"doc_id {dict(media.dtypes)['doc_id']}, n_bytes bigint, payload_bytes bigint, payload_sha256 string, tail_crc32 bigint, media_bytes bigint, media_sha256 string, feature string, print_times array<int>, print_codes array<int>"
    return media.mapInArrow(run, schema)


NAMES = ["doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature", "print_times", "print_codes"]


def op3_media(spark, sf_dir: str) -> DataFrame:
    return fingerprints(staged(to_wav(documents(spark, sf_dir)), "media"))
