"""Readers: audio, arrays, JSON and manifests, from listings with contents."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.paths import uri_parts
from ..operators.listing import list_files
from ..operators.signal import AUDIO
from .codecs import DECODERS, read_npy, read_npz, read_wav_header

FEATURE = "path string, status string, error string, shape array<int>, data array<float>"


#: What a WAV header is looked for in.
HEAD = 1 << 16


def contents(found: DataFrame, first: int | None = None) -> DataFrame:
    """(path, length, content, error) of listed files: each is opened in the task that its path is dealt to, so contents are
    never in a shuffle.  With ``first`` only so many bytes are read.  A file that can't be read has null content."""
    from .sinks import filesystem

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for path in b.column("path").to_pylist():
                size, content, error = None, None, None
                try:
                    system, place = filesystem(path)
                    with system.open_input_file(place) as f:
                        size = f.size()
                        content = f.read(size if first is None else min(first, size))
                except OSError as found_:
                    error = f"{type(found_).__name__}: {found_}"
                yield pa.RecordBatch.from_arrays(
                    [pa.array([path], pa.string()), pa.array([size], pa.int64()), pa.array([content], pa.binary()), pa.array([error], pa.string())],
                    names=["path", "length", "content", "error"],
                )

    return found.select("path").mapInArrow(run, "path string, length bigint, content binary, error string")


def decode_audio(files: DataFrame, rate: int | None = None, mono: bool = False) -> DataFrame:
    """(path, content) decoded by extension: status is ok, or failed with the error and null samples."""
    decoders = dict(DECODERS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from ..operators.signal import audio_row, resample

        for b in batches:
            for path, content in zip(b.column("path").to_pylist(), b.column("content")):
                try:
                    x, sr = decoders[path.rpartition(".")[2].lower()](content.as_py() or b"")
                    x = x.mean(0, keepdims=True) if mono else x
                    x, sr = (resample(x, sr, rate), rate) if rate else (x, sr)
                except Exception as error:
                    yield audio_row(path, None, None, f"{type(error).__name__}: {error}")
                else:
                    yield audio_row(path, x, sr)

    return files.select("path", "content").mapInArrow(run, AUDIO)


def audio_headers(files: DataFrame) -> DataFrame:
    """Channels, samples and rate of WAV files (path, length, content) from their headers: the content may be the beginning
    alone."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("path", pa.string()), ("status", pa.string()), ("sr", pa.int32()), ("n_channels", pa.int32()), ("n_samples", pa.int64())])
        for b in batches:
            rows = []
            for path, length, content in zip(b.column("path").to_pylist(), b.column("length").to_pylist(), b.column("content")):
                try:
                    channels, n, rate = read_wav_header(content.as_py() or b"", length)
                    rows.append({"path": path, "status": "ok", "sr": rate, "n_channels": channels, "n_samples": n})
                except ValueError:
                    rows.append({"path": path, "status": "failed"})
            yield pa.RecordBatch.from_pylist(rows, schema)

    return files.select("path", "length", "content").mapInArrow(run, "path string, status string, sr int, n_channels int, n_samples bigint")


def load_arrays(files: DataFrame, name: str | None = None) -> DataFrame:
    """.npy files (or the array ``name`` of .npz files) as shape and flat float data, row-major."""
    return load_features(files, name).select("path", "status", "error", "shape", "data")


def load_features(files: DataFrame, name: str | None = None) -> DataFrame:
    """Features by extension, of (path, content): .npy, or the array ``name`` of .npz, as shape and flat float data; .json as
    its text.  Anything else fails, and so does a file that isn't there (null content), with its error."""
    known = files if "error" in files.columns else files.withColumn("error", F.lit(None).cast("string"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import json

        schema = pa.schema([("path", pa.string()), ("status", pa.string()), ("error", pa.string()), ("shape", pa.list_(pa.int32())), ("data", pa.list_(pa.float32())), ("json", pa.string())])
        for b in batches:
            rows = []
            for path, content, missing in zip(*(b.column(c).to_pylist() for c in ("path", "content", "error"))):
                row, kind = {"path": path, "status": "ok"}, path.rpartition(".")[2].lower()
                try:
                    if content is None:
                        raise FileNotFoundError(missing or path)
                    if kind == "json":
                        json.loads(content)
                        row["json"] = content.decode()
                    elif kind in ("npy", "npz"):
                        if kind == "npz" and name is None:
                            raise ValueError("name an array of the .npz file")
                        x = read_npz(content)[name] if kind == "npz" else read_npy(content)
                        row |= {"shape": list(x.shape), "data": np.asarray(x, np.float32).ravel()}
                    else:
                        raise ValueError(f"no loader for .{kind} files")
                except Exception as error:
                    row |= {"status": "failed", "error": f"{type(error).__name__}: {error}"}
                rows.append(row)
            yield pa.RecordBatch.from_pylist(rows, schema)

    return known.select("path", "content", "error").mapInArrow(run, FEATURE + ", json string")


def load_json(files: DataFrame, schema: str) -> DataFrame:
    """(path, value): each file parsed as one JSON value, null where it doesn't parse."""
    return files.select("path", F.from_json(F.col("content").cast("string"), schema).alias("value"))


def manifest(spark: SparkSession, path: str) -> DataFrame:
    """(group, name) of a manifest: one JSON object of lists of relative names."""
    raw = spark.read.text(path, wholetext=True).select(F.from_json("value", "map<string,array<string>>").alias("m"))
    return raw.select(F.explode("m").alias("group", "names")).select("group", F.explode("names").alias("name"))


def manifest_files(spark: SparkSession, path: str, root: str) -> DataFrame:
    """The listed files of a manifest that exist under root; names without a file vanish."""
    names = manifest(spark, path).select(F.concat(F.lit(root.rstrip("/") + "/"), "name").alias("path")).distinct()
    return list_files(spark, root.rstrip("/") + "/**").join(names, "path", "left_semi")


def track_directories(files: DataFrame, root: str) -> DataFrame:
    """Distinct shard-*/<track> directories of a listing below root."""
    found = F.regexp_extract(F.substr(F.col("path"), F.lit(len(root.rstrip("/")) + 2)), r"^(shard-[^/]+/[^/]+)/", 1)
    return files.select(found.alias("subdir")).where("subdir <> ''").distinct()


__all__ = [
    "audio_headers", "contents", "decode_audio", "load_arrays", "load_features", "load_json", "manifest",
    "manifest_files", "track_directories", "uri_parts",
]
