"""Signal kernels in NumPy, and the DataFrame operators that run them on decoded audio."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import lru_cache
from math import ceil, gcd

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

AUDIO = "path string, status string, error string, sr int, n_channels int, n_samples bigint, samples array<array<float>>"
AUDIO_COLUMNS = [c.split()[0] for c in AUDIO.split(", ")]


@lru_cache(maxsize=64)
def kernel(source: int, target: int, zeros: int = 6, rolloff: float = 0.99) -> tuple[np.ndarray, int]:
    """Windowed-sinc filters, one per phase of the output, and their half width (rates already reduced).

    This is the textbook polyphase design: a sinc cut off below the lower Nyquist rate, under a squared-cosine window."""
    base = min(source, target) * rolloff
    width = ceil(zeros * source / base)
    at = np.arange(-width, width + source)[None, :] / source
    t = np.clip((at - np.arange(target)[:, None] / target) * base, -zeros, zeros)
    window = np.cos(t * np.pi / zeros / 2) ** 2
    return (np.sinc(t) * window * base / source).astype(np.float64), width


def resample(audio: np.ndarray, source: int, target: int) -> np.ndarray:
    """Band-limited resampling of channels x samples; the length is ceil(samples * target / source)."""
    audio = np.atleast_2d(np.asarray(audio))
    if audio.shape[0] > 128:
        raise ValueError("too many channels")
    if source == target:
        return audio
    g = gcd(source, target)
    a, b = source // g, target // g
    filters, width = kernel(a, b)
    n = audio.shape[1]
    length = ceil(n * b / a)
    padded = np.pad(audio.astype(np.float64), ((0, 0), (width, width + a)))
    steps = ceil(length / b)
    padded = np.pad(padded, ((0, 0), (0, max(0, steps * a + filters.shape[1] - padded.shape[1]))))
    views = np.lib.stride_tricks.sliding_window_view(padded, filters.shape[1], axis=1)[:, : steps * a : a]
    return (views @ filters.T).reshape(audio.shape[0], -1)[:, :length].astype(np.float32)


def frame_bounds(n: int, window: int, hop: int) -> np.ndarray:
    """(start, stop) of the windows over n samples: one for a short signal, else one each hop while there are samples;
    the last one goes if it is shorter than the overlap."""
    starts = np.arange(0, n if n >= window else 1, hop)
    stops = np.minimum(starts + window, n)
    keep = len(starts) - (len(starts) > 1 and stops[-1] - starts[-1] < window - hop)
    return np.stack([starts, stops], 1)[:keep]


def frames(audio: np.ndarray, window: int, hop: int) -> list[np.ndarray]:
    """Overlapping windows along the last axis."""
    return [audio[..., a:b] for a, b in frame_bounds(audio.shape[-1], window, hop)]


def fades(total: int, lengths: np.ndarray, overlap: int) -> np.ndarray:
    """The weights of all places of all frames (frames x longest): ramps over the overlap at inner edges; where a frame's two
    ramps meet, the one at its end holds."""
    place = np.arange(lengths.max())
    index, to_end = np.arange(total)[:, None], lengths[:, None] - 1 - place
    step = max(overlap - 1, 1)
    rising = np.where((index > 0) & (place < overlap), place / step, 1.0)
    return np.where((index < total - 1) & (to_end < overlap), to_end / step, rising)


def overlap_add(parts: list[np.ndarray], hop: int, total: int) -> np.ndarray:
    """The sum of weighted frames, cut off at ``total`` places; a single frame as it is."""
    if len(parts) == 1:
        return parts[0]
    lengths = np.array([x.shape[-1] for x in parts])
    weight = fades(len(parts), lengths, int(lengths[0]) - hop)
    out = np.zeros((*parts[0].shape[:-1], max(total, (len(parts) - 1) * hop + int(lengths.max()))))
    every = np.concatenate([np.arange(i * hop, i * hop + n) for i, n in enumerate(lengths)])
    flat = np.concatenate([x * w[:n] for x, w, n in zip(parts, weight, lengths)], axis=-1)
    np.add.at(out, (..., every), flat)
    return out[..., :total]


def windowed(
    model: Callable[[np.ndarray], np.ndarray], audio: np.ndarray, rate: int, window_s: float, hop_s: float,
    frame_rate: int,
) -> np.ndarray | None:
    """A model's features over windows, joined by overlap-add; None if any feature is not a number."""
    parts = [model(x) for x in frames(audio, ceil(window_s * rate), ceil(hop_s * rate))]
    out = overlap_add(parts, ceil(hop_s * frame_rate), int(audio.shape[-1] / rate * frame_rate)).astype(np.float32)
    return None if np.isnan(out).any() else out


def spectral_divergence(a: np.ndarray, b: np.ndarray, size: int = 1024) -> np.ndarray:
    """Per channel the relative distance of magnitude spectra of two equally long signals."""

    def spectrum(x: np.ndarray) -> np.ndarray:
        hop = size // 4
        x = np.pad(np.atleast_2d(x), ((0, 0), (0, max(0, size - np.atleast_2d(x).shape[1]))))
        return np.abs(np.fft.rfft(np.lib.stride_tricks.sliding_window_view(x, size, axis=1)[:, ::hop] * np.hanning(size)))

    x, y = spectrum(a), spectrum(b)
    norm = lambda s: np.sqrt((s**2).sum((1, 2)))
    return norm(x - y) / np.maximum(norm(x), 1e-30)


def signals(column: pa.ListArray) -> list[np.ndarray | None]:
    """The channels x samples arrays of a column of samples, read from its buffers."""
    out: list[np.ndarray | None] = []
    for i in range(len(column)):
        one = column[i]
        out.append(one.values.flatten().to_numpy(zero_copy_only=False).reshape(len(one.values), -1) if one.is_valid else None)
    return out


def as_column(arrays: list[np.ndarray | None]) -> pa.ListArray:
    """A column of samples of channels x samples arrays."""
    there = [np.atleast_2d(np.asarray(x, np.float32)) for x in arrays if x is not None]
    flat = np.concatenate([np.zeros(0, np.float32), *(x.ravel() for x in there)])
    inner = np.concatenate([[0], np.cumsum([n for x in there for n in [x.shape[1]] * x.shape[0]])]).astype(np.int32)
    outer = np.concatenate([[0], np.cumsum([0 if x is None else np.atleast_2d(x).shape[0] for x in arrays])]).astype(np.int32)
    missing = pa.array([x is None for x in arrays], pa.bool_())
    return pa.ListArray.from_arrays(pa.array(outer), pa.ListArray.from_arrays(pa.array(inner), pa.array(flat)), mask=missing)


def rows_of(batch: pa.RecordBatch, *names: str) -> Iterator[tuple]:
    """The named columns row by row, ``samples`` as arrays."""
    return zip(*(signals(batch.column(n)) if n == "samples" else batch.column(n).to_pylist() for n in names))


def audio_row(path: str, x: np.ndarray | None, rate: int | None, error: str | None = None, **more) -> pa.RecordBatch:
    """A decoded file (or a failed one), as a batch of its own: a signal may be large."""
    shape = (None, None) if x is None else x.shape
    columns = {
        "path": pa.array([path]), "status": pa.array(["ok" if error is None else "failed"]), "error": pa.array([error], pa.string()), "sr": pa.array([rate], pa.int32()),
        "n_channels": pa.array([shape[0]], pa.int32()), "n_samples": pa.array([shape[1]], pa.int64()), "samples": as_column([x]),
    }
    return pa.RecordBatch.from_pydict(columns | {k: pa.array([v], pa.string()) for k, v in more.items()})


def map_audio(audio: DataFrame, change: Callable[[str, np.ndarray, int], tuple[np.ndarray, int] | None], ok: str = "status = 'ok'") -> DataFrame:
    """Decoded audio changed file by file; None drops a file, an error marks it as failed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for path, x, rate in rows_of(b, "path", "samples", "sr"):
                try:
                    found = change(path, x, rate)
                except Exception as error:  # one file must not stop the others
                    yield audio_row(path, None, rate, str(error))
                    continue
                if found is not None:
                    yield audio_row(path, *found)

    return audio.where(ok).select(*AUDIO_COLUMNS).mapInArrow(run, AUDIO)


def spread_audio(
    audio: DataFrame, factory: Callable[[], Callable[[str, np.ndarray, int], dict[str, tuple[np.ndarray, int]] | None]],
    ok: str = "status = 'ok'",
) -> DataFrame:
    """Several signals of each decoded file, by ``kind``, made together.  ``factory`` is called once per task; its function
    gives None to drop a file, an error marks it as failed (with no kind)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        change = factory()
        for b in batches:
            for path, x, rate in rows_of(b, "path", "samples", "sr"):
                try:
                    found = change(path, x, rate)
                except Exception as error:
                    yield audio_row(path, None, rate, str(error), kind=None)
                    continue
                for kind, (y, own) in (found or {}).items():
                    yield audio_row(path, y, own, kind=kind)

    return audio.where(ok).select(*AUDIO_COLUMNS).mapInArrow(run, AUDIO + ", kind string")


def resampled(audio: DataFrame, rate: int) -> DataFrame:
    return map_audio(audio, lambda _, x, sr: (resample(x, sr, rate), rate))
