"""Batched recognition with a pluggable model."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from typing import Protocol

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voxlattice.operators.batching import duration_batches
from voxlattice.sources.audio import RATE, decode, mono

# Names of number types that models are loaded with.
DTYPES = {"float32": "float32", "fp32": "float32", "float16": "float16", "fp16": "float16", "bfloat16": "bfloat16", "bf16": "bfloat16"}


@dataclass(frozen=True)
class Settings:
    """X-13: what all recognisers share; the defaults are those of their command lines."""

    model_id: str
    model_type: str
    language_code: str | None = None
    max_batch_size: int = 32
    max_batch_audio_s: float = 180.0
    dtype: str = "float16"
    limit: int | None = None

    def checked(self) -> Settings:
        """F-16, X-12."""
        if self.max_batch_size < 1 or self.max_batch_audio_s <= 0 or (self.limit is not None and self.limit < 1):
            raise ValueError("batch size, seconds and limit must be above 0")
        if self.dtype not in DTYPES:
            raise ValueError(f"unknown number type {self.dtype}")
        return self


class Recogniser(Protocol):
    """X-08 to X-10: texts of a padded batch (clips x samples) and its mask of real samples."""

    def __call__(self, batch: np.ndarray, mask: np.ndarray) -> list[str]: ...


class Loudness:
    """A stand-in that needs no model: it 'hears' the length and loudness of each clip."""

    def __call__(self, batch: np.ndarray, mask: np.ndarray) -> list[str]:
        return [f"{int(m.sum())} samples, {np.sqrt(np.square(x[m]).mean()) if m.any() else 0:.3f}" for x, m in zip(batch, mask)]


def collate(clips: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """L-02: clips padded with 0 to the longest, and the mask."""
    n = max((len(c) for c in clips), default=0)
    mask = np.arange(n) < np.array([[len(c)] for c in clips], int).reshape(-1, 1)
    return np.array([np.pad(c, (0, n - len(c))) for c in clips]).reshape(len(clips), n), mask


def recognise(clips: DataFrame, load: Callable[[], Recogniser], settings: Settings, shard_clips: int = 4096) -> DataFrame:
    """Predictions of clips (pos, path, duration_s, content): path, text, duration_s, model_id, model_type, language_code.

    Clips are batched by duration within shards of about shard_clips; a batch's clips are brought together, and each
    Python worker loads the model once.
    """
    settings.checked()
    shards = max(1, clips.count() // shard_clips)
    sharded = clips.withColumn("shard", F.pmod(F.xxhash64("path"), F.lit(shards)))
    batches = duration_batches(sharded, ["shard"], "pos", "duration_s", settings.max_batch_size, settings.max_batch_audio_s).select("shard", "pos", "batch_no", "place")
    batched = sharded.join(batches, ["shard", "pos"]).select("shard", "batch_no", "place", "path", "duration_s", "content").repartition("shard", "batch_no").sortWithinPartitions("shard", "batch_no", "place")

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = None
        held: list[pd.DataFrame] = []

        def heard(rows: pd.DataFrame) -> pd.DataFrame:
            nonlocal model
            model = model or load()
            x, mask = collate([mono(*decode(b)) for b in rows["content"]])
            return pd.DataFrame({"path": rows["path"].tolist(), "text": model(x, mask), "duration_s": rows["duration_s"].round(3).tolist(), "model_id": settings.model_id, "model_type": settings.model_type, "language_code": settings.language_code})

        now = None
        for frame in frames:
            for key, rows in frame.groupby(["shard", "batch_no"], sort=False):
                if now is not None and key != now:
                    yield heard(pd.concat(held))
                    held = []
                now = key
                held.append(rows)
        if held:
            yield heard(pd.concat(held))

    return batched.mapInPandas(run, "path string, text string, duration_s double, model_id string, model_type string, language_code string")


__all__ = ["DTYPES", "RATE", "Loudness", "Recogniser", "Settings", "collate", "recognise"]
