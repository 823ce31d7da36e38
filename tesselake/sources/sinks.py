"""Writers: one file per row, copies, sharded training sets, JSON lines."""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage


def filesystem(uri: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri) if "://" in uri or uri.startswith("file:") else (fs.LocalFileSystem(), uri)


def put(uri: str, data: bytes) -> None:
    """Write under a temporary name, then rename: a task that runs again leaves one whole file."""
    system, path = filesystem(uri)
    system.create_dir(path.rpartition("/")[0], recursive=True)
    with system.open_output_stream(part := f"{path}.{uuid.uuid4().hex}.part", compression=None) as out:
        out.write(data)
    system.move(part, path)


def write_files(rows: DataFrame, path: str = "out_path", content: str = "content") -> DataFrame:
    """Write each row's bytes to its path; (path, status, error) of each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for p, c in zip(b.column(path).to_pylist(), b.column(content).to_pylist()):
                try:
                    put(p, c or b"")
                    out.append((p, "ok", None))
                except OSError as error:
                    out.append((p, "failed", str(error)))
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.string()) for x in (zip(*out) if out else [()] * 3)], names=["path", "status", "error"])

    return rows.select(path, content).mapInArrow(run, "path string, status string, error string")


def copy_files(pairs: DataFrame, source: str = "src", target: str = "dst", block: int = 1 << 24) -> DataFrame:
    """Copy files in blocks; (src, dst, status) of each.  A missing source is reported, not raised."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for s, t in zip(b.column(source).to_pylist(), b.column(target).to_pylist()):
                try:
                    (a, p), (c, q) = filesystem(s), filesystem(t)
                    c.create_dir(q.rpartition("/")[0], recursive=True)
                    with a.open_input_stream(p, compression=None) as x, c.open_output_stream(part := f"{q}.{uuid.uuid4().hex}.part", compression=None) as y:
                        while data := x.read(block):
                            y.write(data)
                    c.move(part, q)
                    out.append((s, t, "ok"))
                except OSError:
                    out.append((s, t, "failed"))
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.string()) for x in (zip(*out) if out else [()] * 3)], names=["src", "dst", "status"])

    return pairs.select(source, target).mapInArrow(run, "src string, dst string, status string")


def encode_audio(audio: DataFrame, suffix: str, out_path: str = "out_path") -> DataFrame:
    """(out_path, content) of decoded audio, by the encoder registered for the suffix (npy always)."""
    from .codecs import ENCODERS, write_npy

    encoders = dict(ENCODERS) | {"npy": lambda x, _: write_npy(x)}
    kind = suffix.lstrip(".")
    if kind not in encoders:
        raise ValueError(f"no encoder for {suffix}")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from ..operators.signal import rows_of

        for b in batches:
            for path, x, rate in rows_of(b, out_path, "samples", "sr"):
                data = encoders[kind](x, rate)
                yield pa.RecordBatch.from_arrays([pa.array([path]), pa.array([data], pa.binary())], names=["out_path", "content"])

    return audio.where("status = 'ok'").select(out_path, "sr", "samples").mapInArrow(run, "out_path string, content binary")


class ShardedWriter(DataSourceArrowWriter):
    """Each task writes shards of bounded size, Arrow streams with the rows' own types (arrays keep theirs), compressed; the
    commit writes one index of the columns and of all shards with their rows, bytes and hashes."""

    def __init__(self, options: dict[str, str], schema):
        self.root, self.most, self.schema = options["path"], int(options.get("maxbytes", 1 << 28)), schema.json()

    def write(self, iterator: Iterator[pa.RecordBatch]) -> WriterCommitMessage:
        import hashlib

        shards, held, size, task = [], [], 0, uuid.uuid4().hex

        def close() -> None:
            nonlocal held, size
            if held:
                sink = pa.BufferOutputStream()
                with pa.ipc.new_stream(sink, held[0].schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
                    for b in held:
                        out.write_batch(b)
                put(f"{self.root}/{(name := f'{task}/shard.{len(shards):05d}.arrows')}", data := sink.getvalue().to_pybytes())
                shards.append({"name": name, "rows": sum(b.num_rows for b in held), "bytes": len(data), "raw_bytes": size, "sha256": hashlib.sha256(data).hexdigest()})
                held, size = [], 0

        for batch in iterator:
            each = max(1, batch.nbytes // max(1, batch.num_rows))
            at = 0
            while at < batch.num_rows:  # as many rows as the shard has room for, at least one of a new shard
                n = max((self.most - size) // each, 0 if held else 1)
                if n:
                    held.append(batch.slice(at, n))
                    size += each * held[-1].num_rows
                    at += n
                if at < batch.num_rows:
                    close()
        close()
        message = WriterCommitMessage()
        message.shards = shards
        return message

    def commit(self, messages) -> None:
        put(
            f"{self.root}/index.json",
            json.dumps({"schema": json.loads(self.schema), "shards": [s for m in messages if m for s in m.shards]}).encode(),
        )

    def abort(self, messages) -> None:
        system, path = filesystem(self.root)
        for m in messages:
            for s in m.shards if m else ():
                system.delete_file(f"{path}/{s['name']}")


class ShardedSource(DataSource):
    """``df.write.format("shards").mode("append").option("path", root).save()``"""

    @classmethod
    def name(cls) -> str:
        return "shards"

    def writer(self, schema, overwrite: bool) -> DataSourceArrowWriter:
        return ShardedWriter(self.options, schema)


def write_shards(rows: DataFrame, root: str, max_bytes: int = 1 << 28) -> None:
    rows.sparkSession.dataSource.register(ShardedSource)
    rows.write.format("shards").mode("append").option("path", root).option("maxbytes", str(max_bytes)).save()


def read_shards(spark: SparkSession, root: str) -> DataFrame:
    """The rows that ``write_shards`` wrote: only shards that a commit has listed, each checked against its hash."""
    from pyspark.sql import functions as F
    from pyspark.sql.types import StructType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import hashlib

        for b in batches:
            for name, digest in zip(b.column("name").to_pylist(), b.column("sha256").to_pylist()):
                system, path = filesystem(f"{root}/{name}")
                with system.open_input_stream(path, compression=None) as f:
                    raw = f.read()
                if hashlib.sha256(raw).hexdigest() != digest:
                    raise ValueError(f"{name} has changed")
                yield from pa.ipc.open_stream(raw)

    text = spark.read.text(f"{root}/index.json", wholetext=True)
    schema = StructType.fromJson(json.loads(text.first().value)["schema"])
    index = text.select(F.explode(F.from_json("value", "shards array<struct<name:string,sha256:string>>")["shards"]).alias("s"))
    return index.select("s.*").mapInArrow(run, schema)


def write_json_lines(rows: DataFrame, path: str) -> None:
    rows.write.mode("overwrite").json(path)
