"""PCM WAV files: probing, loading, converting, cutting and joining in Arrow batches."""

from __future__ import annotations

import io
import math
import wave
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

RATE = 16_000


def decode(blob: bytes) -> tuple[np.ndarray, int]:
    """(frames x channels in -1..1, rate) of 8-, 16-, 24- or 32-bit PCM; raises on anything else."""
    with wave.open(io.BytesIO(blob)) as w:
        width, channels, rate = w.getsampwidth(), w.getnchannels(), w.getframerate()
        raw = w.readframes(w.getnframes())
    if width == 1:
        x = (np.frombuffer(raw, np.uint8).astype(float) - 128) / 128
    elif width == 3:
        b = np.frombuffer(raw, np.uint8).reshape(-1, 3).astype(np.int32)
        x = ((b[:, 0] | b[:, 1] << 8 | b[:, 2] << 16) ^ 0x800000) - 0x800000
        x = x / float(1 << 23)
    elif width in (2, 4):
        x = np.frombuffer(raw, f"<i{width}") / float(1 << (8 * width - 1))
    else:
        raise wave.Error("unknown sample width")
    return x.reshape(-1, channels), rate


def encode(x: np.ndarray, rate: int = RATE) -> bytes:
    """16-bit PCM WAV of frames (x channels)."""
    x = np.atleast_2d(np.asarray(x, float).T).T
    out = io.BytesIO()
    with wave.open(out, "wb") as w:
        w.setnchannels(x.shape[1])
        w.setsampwidth(2)
        w.setframerate(rate)
        w.writeframes((np.clip(np.round(x * 32768), -32768, 32767)).astype("<i2").tobytes())
    return out.getvalue()


def low_pass(x: np.ndarray, cut: float, taps: int = 129) -> np.ndarray:
    """X-15: samples without what is above `cut`, a share of the rate, by a windowed sinc filter; no delay."""
    k = np.arange(taps) - taps // 2
    h = np.sinc(2 * cut * k) * np.blackman(taps)
    return np.convolve(x, h / h.sum(), "same") if len(x) >= taps else np.convolve(np.pad(x, taps), h / h.sum(), "same")[taps:-taps]


def high_pass(x: np.ndarray, cut: float, taps: int = 129) -> np.ndarray:
    """X-15: what low_pass() takes away."""
    return x - low_pass(x, cut, taps)


def mono(x: np.ndarray, rate: int, to: int = RATE) -> np.ndarray:
    """S-21, X-02: the mean of the channels at another rate; what a lower rate can't hold is filtered out first."""
    y = x.mean(1) if x.ndim == 2 else x
    if rate == to or not len(y):
        return y
    if to < rate:
        y = low_pass(y, 0.45 * to / rate)
    n = max(1, round(len(y) * to / rate))
    return np.interp(np.arange(n) * rate / to, np.arange(len(y)), y)


def mean_volume(x: np.ndarray) -> float | None:
    """S-24, A-15: dB of the root mean square, NULL of nothing or of silence."""
    power = float(np.mean(np.square(x))) if x.size else 0.0
    return 10 * math.log10(power) if power > 0 else None


def _files(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.[wW][aA][vV]").load(path).select("path", "content")


def probe(files: DataFrame) -> DataFrame:
    """S-20, S-23, S-24, D-03: sample_rate, channels, num_samples, duration_s, mean_volume_db of (path, content); what can't be read has _error."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows = []
            for p, blob in zip(frame["path"], frame["content"]):
                try:
                    x, rate = decode(blob)
                    rows.append((p, rate, x.shape[1], len(x), len(x) / rate, mean_volume(x), None if len(x) else "empty"))
                except (wave.Error, EOFError, ValueError) as e:
                    rows.append((p, None, None, None, None, None, str(e) or "unreadable"))
            out = pd.DataFrame(rows, columns=["path", "sample_rate", "channels", "num_samples", "duration_s", "mean_volume_db", "_error"])
            yield out.astype({"sample_rate": "Int32", "channels": "Int32", "num_samples": "Int64"})

    return files.mapInPandas(run, "path string, sample_rate int, channels int, num_samples bigint, duration_s double, mean_volume_db double, _error string")


def scan_audio(spark: SparkSession, path: str) -> DataFrame:
    """The probe of every WAV file below path."""
    return probe(_files(spark, path))


def converted(files: DataFrame, rate: int = RATE) -> DataFrame:
    """X-02: path, wav: 16-bit mono at the rate; files that can't be read are left out (probe() tells which)."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows = []
            for p, blob in zip(frame["path"], frame["content"]):
                try:
                    x, r = decode(blob)
                except (wave.Error, EOFError, ValueError):
                    continue
                rows.append((p, encode(mono(x, r, rate), rate)))
            yield pd.DataFrame(rows, columns=["path", "wav"])

    return files.mapInPandas(run, "path string, wav binary")


def cut(files: DataFrame, plan: DataFrame) -> DataFrame:
    """X-03, X-06, K-13: name, wav of the stretches [start_ms, end_ms) in source time; an open end is the file's.

    plan: path, name, start_ms, end_ms. Each file meets its own stretches; the files' bytes aren't copied per stretch.
    """
    stretches = plan.groupBy("path").agg(F.collect_list(F.struct("name", "start_ms", "end_ms")).alias("cuts"))
    met = files.join(stretches, "path")

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows = []
            for blob, cuts in zip(frame["content"], frame["cuts"]):
                x, rate = decode(blob)
                for c in cuts:
                    a = round(c["start_ms"] * rate / 1000)
                    b = len(x) if c["end_ms"] is None or c["end_ms"] != c["end_ms"] else round(c["end_ms"] * rate / 1000)
                    rows.append((c["name"], encode(x[a : max(a, b)], rate)))
            yield pd.DataFrame(rows, columns=["name", "wav"])

    return met.mapInPandas(run, "name string, wav binary")


def joined(clips: DataFrame, key: str, order: str) -> DataFrame:
    """X-04: key, wav: clips of one key in their order, at the rate of the first."""

    def run(k, frame: pd.DataFrame) -> pd.DataFrame:
        parts = [decode(b) for b in frame.sort_values(order)["wav"]]
        rate = parts[0][1]
        return pd.DataFrame({key: [k[0]], "wav": [encode(np.concatenate([x if r == rate and x.shape[1] == 1 else mono(x, r, rate)[:, None] for x, r in parts]), rate)]})

    return clips.groupBy(key).applyInPandas(run, f"{key} {clips.schema[key].dataType.simpleString()}, wav binary")


def rename_plan(files: DataFrame, prefix: str) -> DataFrame:
    """S-01, W-02, X-01: old and new names by order of name; nothing is renamed here."""
    # A folder's listing is small enough for one task.
    place = F.row_number().over(Window.partitionBy(F.lit(1)).orderBy("name", "ext"))
    return files.select("path", "name", "ext", F.concat(F.format_string(f"{prefix}_%03d", place), F.lit(".wav")).alias("new_name"))


def orphan_plan(files: DataFrame, keep: DataFrame) -> DataFrame:
    """F-09, X-05: files whose name isn't to be kept; nothing is deleted here."""
    return files.join(keep.select("name").distinct(), "name", "left_anti")


def gain(x: np.ndarray, db: float) -> np.ndarray:
    """X-15: samples louder by so many dB, clipped."""
    return np.clip(x * 10 ** (db / 20), -1, 1)
