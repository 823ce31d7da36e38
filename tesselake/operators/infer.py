"""Pluggable model inference on decoded audio, with deterministic stand-ins for each kind of model."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .signal import rows_of, windowed

Model = Callable[[np.ndarray, int], np.ndarray | None]


@dataclass(frozen=True)
class Contract:
    """What a model accepts and how its output file is named."""

    name: str
    suffix: str
    rate: int | None = None
    channels: int | None = None
    mono: bool = False


# Input rules and file suffixes of the kinds of models.
CONTRACTS = {c.name: c for c in (
    Contract("stems", ".{stem}", 44100, 2),
    Contract("embedding", ".embedding.npy", 48000),
    Contract("classifier", ".{feature}.npy", 16000, mono=True),
    Contract("tempo", ".tempo.npy", 11250, mono=True),
    Contract("track", ".track.npy"),
    Contract("speech", ".speech.json"),
)}


def dummy(classes: int, frame_rate: int) -> Model:
    """Features from frame energies: (classes, int(duration * frame_rate)) float32, the same for the same audio."""

    def model(x: np.ndarray, rate: int) -> np.ndarray:
        n = int(x.shape[-1] / rate * frame_rate)
        edges = np.linspace(0, x.shape[-1], n + 1).astype(int)
        energy = np.array([np.abs(x[..., a:b]).mean() if b > a else 0.0 for a, b in zip(edges, edges[1:])])
        return (np.cos(np.arange(classes)[:, None]) * energy[None, :]).astype(np.float32)

    return model


def over_windows(model: Model, rate: int, window_s: float = 195, hop_s: float = 190, frame_rate: int = 30) -> Model:
    """A model run on overlapping windows; short enough signals are one window."""
    return lambda x, _: windowed(lambda part: model(part, rate), x, rate, window_s, hop_s, frame_rate)


def infer(audio: DataFrame, factory: Callable[[], Model], contract: Contract) -> DataFrame:
    """(path, status, error, shape, data) of each decoded file.  The model is made once per task.

    Files with another rate or number of channels than the contract's fail, mono models get the mean of the channels,
    None and not-a-number results drop the file."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = factory()
        schema = pa.schema([("path", pa.string()), ("status", pa.string()), ("error", pa.string()), ("shape", pa.list_(pa.int32())), ("data", pa.list_(pa.float32()))])
        for b in batches:
            for path, x, rate in rows_of(b, "path", "samples", "sr"):
                error, y = None, None
                try:
                    if contract.rate and rate != contract.rate:
                        raise ValueError(f"rate {rate}, not {contract.rate}")
                    if contract.channels and len(x) != contract.channels:
                        raise ValueError(f"{len(x)} channels, not {contract.channels}")
                    y = model(x.mean(0, keepdims=True) if contract.mono else x, rate)
                    if y is None or np.isnan(y).any():
                        continue
                except Exception as found:
                    error = str(found)
                shape, data = (None, None) if error else (list(y.shape), np.asarray(y, np.float32).ravel())
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([path]), pa.array(["failed" if error else "ok"]), pa.array([error], pa.string()),
                        pa.array([shape], schema.field("shape").type), pa.array([data], schema.field("data").type),
                    ],
                    schema=schema,
                )

    return audio.where("status = 'ok'").select("path", "sr", "samples").mapInArrow(
        run, "path string, status string, error string, shape array<int>, data array<float>",
    )
