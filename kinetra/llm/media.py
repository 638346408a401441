"""Media columns: WAV bytes written and read by the wave module, and spectral fingerprints of them.

The features are those of audio matching: short-time Fourier transforms, local spectral peaks, and pairs
of a peak with the next ones, kept as time-coded arrays: the time of each pair and its code of two frequency bins
and their time difference.
"""

from __future__ import annotations

import hashlib
import io
import wave
import zlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinetra.llm.common import cut, text_bytes

#: A payload is filled with bytes 255 up to a positive multiple of this, which is also the frame length.
FRAME = 576
HOP = FRAME // 2
_HANN = np.hanning(FRAME).astype(np.float32)


def pad(data: bytes, unit: int = FRAME) -> bytes:
    return data + b"\xff" * (max(1, -(-len(data) // unit)) * unit - len(data))


def to_wav(samples: bytes, rate: int = 8000) -> bytes:
    """One channel of unsigned 8-bit samples."""
    out = io.BytesIO()
    with wave.open(out, "wb") as w:
        w.setnchannels(1)
        w.setsampwidth(1)
        w.setframerate(rate)
        w.writeframes(samples)
    return out.getvalue()


def from_wav(media: bytes) -> bytes:
    with wave.open(io.BytesIO(media), "rb") as w:
        return w.readframes(w.getnframes())


def _peaks(power: np.ndarray, first: int, last: int, per_frame: int) -> tuple[np.ndarray, np.ndarray]:
    """Frames and bins, between frames first and last, of the strongest bins that top all neighbours."""
    core = power[:, 1:-1]
    top = (core > power[:, :-2]) & (core >= power[:, 2:])
    top[1:] &= core[1:] > core[:-1]
    top[:-1] &= core[:-1] >= core[1:]
    strength = np.where(top, core, -1.0)[first:last]
    k = min(per_frame, strength.shape[1])
    best = np.sort(np.argpartition(-strength, k - 1, axis=1)[:, :k], axis=1)
    good = np.take_along_axis(strength, best, axis=1) > 0
    t, at = np.nonzero(good)
    return t + first, best[t, at] + 1


def fingerprint(samples: bytes, per_frame: int = 3, reach: int = 3, block: int = 2048) -> np.ndarray:
    """Rows (time, bin, later bin, time difference) of spectral-peak pairs, int32, in time order.

    Frames of 576 samples, half overlapping; per_frame peaks of each frame, each paired with all peaks of
    the next reach frames.  Frames are transformed block by block, with one frame more on either side, so that the
    blocks' borders don't show in the result; besides the samples only the peaks and pairs grow with the recording.
    """
    raw = np.frombuffer(samples, dtype=np.uint8)
    n = 1 + (raw.size - FRAME) // HOP
    times, bins = [], []
    for start in range(0, n, block):
        lo, hi = max(0, start - 1), min(n, start + block + 1)
        x = raw[lo * HOP : (hi - 1) * HOP + FRAME].astype(np.float32) - np.float32(128)
        spectrum = np.fft.rfft(np.lib.stride_tricks.sliding_window_view(x, FRAME)[::HOP] * _HANN)
        power = spectrum.real**2 + spectrum.imag**2
        t, f = _peaks(power, start - lo, min(n, start + block) - lo, per_frame)
        times.append(t + lo)
        bins.append(f)
    t, f = np.concatenate(times).astype(np.int32), np.concatenate(bins).astype(np.int32)
    pairs = []
    for ahead in range(1, per_frame * (reach + 1)):
        if ahead >= t.size:
            break
        dt = t[ahead:] - t[:-ahead]
        near = np.flatnonzero((dt >= 1) & (dt <= reach))
        pairs.append(np.stack([t[near], f[near], f[near + ahead], dt[near]], axis=1))
    out = np.concatenate(pairs) if pairs else np.zeros((0, 4), dtype=np.int32)
    return out[np.lexsort(out.T[::-1])]


def pack(pairs: np.ndarray) -> np.ndarray:
    """One int32 for each pair: bin * 2**13 + later bin * 2**4 + time difference."""
    return (pairs[:, 1] << 13) | (pairs[:, 2] << 4) | pairs[:, 3]


def unpack(code: np.ndarray) -> np.ndarray:
    """Rows (bin, later bin, time difference) of codes."""
    return np.stack([code >> 13, code >> 4 & 511, code & 15], axis=1)


def feature_text(pairs: np.ndarray) -> str:
    """Number of pairs, frames they span and SHA-256 of the rows as little-endian int32."""
    return f"pairs={len(pairs)};last={int(pairs[-1, 0]) if len(pairs) else -1};sha256={hashlib.sha256(pairs.astype('<i4').tobytes()).hexdigest()}"


def store_media(docs: DataFrame) -> DataFrame:
    """(doc_id, n_bytes, media) of documents, written to the shared folder and read back.

    Null or empty text: one frame of bytes 255.  Every row stays, repeated ones too.
    """

    def wav(batches):
        for data in batches:
            yield pd.Series([to_wav(pad(bytes(x))) for x in data])

    make = F.pandas_udf(wav, "binary", F.PandasUDFType.SCALAR_ITER)
    raw = text_bytes()
    return cut(docs.select("doc_id", F.octet_length(raw).cast("long").alias("n_bytes"), make(raw).alias("media")), "media")


def media_columns(stored: DataFrame) -> DataFrame:
    """Digests, features and fingerprints of stored media (doc_id, n_bytes, media), all from the bytes read back.

    doc_id, n_bytes, payload_bytes, payload_sha256, tail_crc32 (of the last 32 payload bytes), media_bytes, media_sha256,
    feature, and the fingerprints as codes: array of struct time, pair (see pack()), in order of time.  Null ids stay
    null, repeated rows stay, an empty table gives none; a recording of any length is read whole.
    """
    kinds = "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string, codes array<struct<time:int,pair:int>>"

    def read(batches):
        import pyarrow as pa

        names, types = [k.split()[0] for k in kinds.split(", ")], (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string())

        def emit(ids, rows, found):
            ends = np.cumsum([0, *map(len, found)])
            pairs = np.concatenate([np.zeros((0, 4), dtype=np.int32), *found])
            each = pa.StructArray.from_arrays([pa.array(x, type=pa.int32()) for x in (pairs[:, 0], pack(pairs))], ["time", "pair"])
            plain = [pa.array(x, type=t) for x, t in zip(zip(*rows, strict=True) if rows else [()] * 6, types, strict=True)]
            return pa.RecordBatch.from_arrays([*ids, *plain, pa.ListArray.from_arrays(pa.array(ends, type=pa.int32()), each)], names)

        for batch in batches:
            rows, found, start, size = [], [], 0, 0
            for i, cell in enumerate(batch.column("media")):
                media = cell.as_py()
                payload = from_wav(media)
                found.append(fingerprint(payload))
                rows.append((len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-32:]), len(media), hashlib.sha256(media).hexdigest(), feature_text(found[-1])))
                size += len(found[-1])
                if size > 1 << 20 or i == batch.num_rows - 1:  # a batch of long recordings goes on in parts
                    yield emit([batch.column(c).slice(start, i + 1 - start) for c in ("doc_id", "n_bytes")], rows, found)
                    rows, found, start, size = [], [], i + 1, 0

    return stored.select("doc_id", "n_bytes", "media").mapInArrow(read, kinds)
