"""WARC archives as seekable Zstandard bundles.

A bundle is a sequence of independent Zstandard frames, each holding whole WARC records up to ``frame_bytes``,
followed by the seek table of the public seekable format (a skippable frame with the compressed and
decompressed size of each frame, closed by a footer).  Writing returns an index that maps each record's id to its
bundle, frame and offset within the decompressed frame; a reader fetches the footer, then only the frames it needs.

Payloads of at least ``least`` bytes that occur more than once are stored once: the record with the smallest id is
the response, the others are revisits that name it and carry digest and length of the full payload.

A response holds an HTTP message with the payload; a record's WARC-Record-ID is made of its page id, its payload's digest
and, where a page comes again with the same payload, a number.

Bundles are written to the shared folder under deterministic names, through a temporary name that is renamed,
so a task that runs again replaces its own bundles; a task begins a new one after ``bundle_bytes`` of records.  Null payloads
count as empty.  Repeated ids keep a record each, and those with the smallest id of a payload are responses.  Records without id are written too, as
responses.  An empty table gives no bundle and no rows.
"""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from .common import new_path, partitions, sweep, written

# Fixed values of the seekable format.
SKIPPABLE, SEEKABLE = 0x184D2A5E, 0x8F92EAB1
LEAST = 100


def seek_table(sizes: list[tuple[int, int]]) -> bytes:
    entries = b"".join(struct.pack("<II", c, d) for c, d in sizes)
    return struct.pack("<II", SKIPPABLE, len(entries) + 9) + entries + struct.pack("<IBI", len(sizes), 0, SEEKABLE)


def read_seek_table(file, size: int) -> list[tuple[int, int, int]]:
    """(offset, compressed size, decompressed size) of each frame, from the end of the file."""
    file.seek(size - 9)
    n, _, magic = struct.unpack("<IBI", file.read(9))
    if magic != SEEKABLE:
        raise ValueError("no seek table")
    file.seek(size - 9 - 8 * n)
    raw, at, out = file.read(8 * n), 0, []
    for c, d in struct.iter_unpack("<II", raw):
        out.append((at, c, d))
        at += c
    return out


def record_id(page_id: int | None, digest: str, again: int = 0) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}:{digest[:32]}{f':{again}' if again else ''}>"


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, again: int = 0) -> bytes:
    """One WARC/1.1 record; a revisit has no block."""
    kind = "response" if refers_to is None else "revisit"
    clean = "".join(c for c in (url or "") if c >= " ")
    head = [
        "WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: {record_id(page_id, digest, again)}", f"WARC-Target-URI: {clean}",
        "WARC-Date: 1970-01-01T00:00:00Z", f"WARC-Payload-Digest: sha256:{digest}", f"X-Payload-Length: {len(payload)}",
    ]
    block = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode() + payload
    if refers_to is not None:
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: {record_id(refers_to, digest)}"]
        block = b""
    return ("\r\n".join([*head, "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]) + "\r\n\r\n").encode("utf-8", "surrogatepass") + block + b"\r\n\r\n"


def parse(raw: bytes) -> tuple[dict[str, str], bytes]:
    """Header fields and payload of one record."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode("utf-8", "surrogatepass").split("\r\n")[1:] if ": " in line)
    return fields, rest[: int(fields["Content-Length"])].partition(b"\r\n\r\n")[2]


def number(urn: str | None) -> int | None:
    page = urn.strip("<>").split(":")[2] if urn else ""
    return int(page) if page else None


class Bundle:
    """Writes frames of whole records; ``add`` returns (frame, offset, length)."""

    def __init__(self, file, frame_bytes: int, level: int = 3):
        self.file, self.most, self.pack = file, frame_bytes, zstandard.ZstdCompressor(level=level)
        self.sizes: list[tuple[int, int]] = []
        self.open: list[bytes] = []
        self.length = 0

    def add(self, raw: bytes) -> tuple[int, int, int]:
        if self.length and self.length + len(raw) > self.most:
            self.flush()
        place = len(self.sizes), self.length, len(raw)
        self.open.append(raw)
        self.length += len(raw)
        return place

    def flush(self) -> None:
        if self.length:
            self.file.write(out := self.pack.compress(b"".join(self.open)))
            self.sizes.append((len(out), self.length))
            self.open, self.length = [], 0

    def close(self) -> None:
        self.flush()
        self.file.write(seek_table(self.sizes))


INDEX = "id long, bundle string, frame int, at int, length int"


def classified(pages: DataFrame, id_col: str = "page_id", payload: str = "html", url: str = "url", least: int = LEAST) -> DataFrame:
    """(id, url, payload, digest, first): ``first`` is the id that a revisit refers to.

    Payloads move once, by id, which no page shares with many.  The smallest id of a digest is found with partial
    aggregation on digests alone, so a payload that a third of all pages share is one row per task in that
    shuffle; the join on digests has small rows on both sides and is open to Spark's skew splitting."""
    data = pages.select(
        F.col(id_col).alias("id"),
        F.col(url).alias("url") if url in pages.columns else F.lit(None).cast("string").alias("url"),
        F.coalesce(payload, F.lit("")).alias("payload"),
    )
    data = data.withColumn("digest", F.sha2("payload", 256))
    keyed = data.where((F.octet_length("payload") >= least) & F.col("id").isNotNull()).select("id", "digest")
    shared = keyed.groupBy("digest").agg(F.min("id").alias("first"), F.max("id").alias("last")).where("first < last").select("digest", "first")
    revisits = keyed.join(shared, "digest").where("id != first").distinct()
    return data.join(revisits, ["id", "digest"], "left")


def write_bundles(data: DataFrame, folder: str, bundles: int, frame_bytes: int = 1 << 18, bundle_bytes: int = 1 << 28) -> DataFrame:
    """Write (id, url, payload, digest, first) as bundles, by ``bundles`` tasks; the index of all records."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        context = TaskContext.get()
        system, path = fs.FileSystem.from_uri(folder)
        system.create_dir(path, recursive=True)
        kinds = (pa.int64(), pa.string(), pa.int32(), pa.int32(), pa.int32())
        out, count, before, again = None, 0, None, 0

        def close() -> None:
            bundle.close()
            out.close()
            system.move(part, f"{path}/{name}")

        for b in batches:
            rows = []
            for i, url, payload, digest, first in zip(*(b.column(c).to_pylist() for c in ("id", "url", "payload", "digest", "first"))):
                if out is None:
                    name = f"bundle-{context.partitionId():06d}-{count:04d}.warc.zst"
                    part = f"{path}/.{name}.{context.taskAttemptId()}"
                    out, size, count = system.open_output_stream(part, compression=None), 0, count + 1
                    bundle = Bundle(out, frame_bytes)
                before, again = (i, digest), again + 1 if before == (i, digest) else 0
                raw = record(i, url, payload.encode("utf-8", "surrogatepass"), digest, first, again)
                rows.append((i, f"{folder}/{name}", *bundle.add(raw)))
                size += len(raw)
                if size >= bundle_bytes:
                    close()
                    out = None
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(zip(*rows) if rows else [()] * 5, kinds)],
                names=["id", "bundle", "frame", "at", "length"],
            )
        if out is not None:
            close()

    # equal pages stand together, so that each can tell how many came before
    return data.repartition(bundles, "id", "digest").sortWithinPartitions("id", "digest").mapInArrow(run, INDEX)


def read_records(index: DataFrame) -> DataFrame:
    """The records that an index names: id, payload_bytes, payload_digest, record_type, refers_to, payload.

    Rows of a bundle are read together; a bundle's footer is fetched once per task, a frame once while its
    records follow each other."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        unpack, at, file, cached = zstandard.ZstdDecompressor(), None, None, (None, b"")
        for b in batches:
            out = []
            for r in b.to_pylist():
                if r["bundle"] != at:
                    system, path = fs.FileSystem.from_uri(r["bundle"])
                    file, at, cached = system.open_input_file(path), r["bundle"], (None, b"")
                    frames = read_seek_table(file, file.size())
                if cached[0] != r["frame"]:
                    place, packed, size = frames[r["frame"]]
                    file.seek(place)
                    cached = r["frame"], unpack.decompress(file.read(packed), max_output_size=size)
                fields, block = parse(cached[1][r["at"] : r["at"] + r["length"]])
                digest, kind = fields["WARC-Payload-Digest"].removeprefix("sha256:"), fields["WARC-Type"]
                if kind == "response" and (hashlib.sha256(block).hexdigest() != digest or len(block) != int(fields["X-Payload-Length"])):
                    raise ValueError(f"record {r['id']} is damaged")
                out.append((number(fields["WARC-Record-ID"]), int(fields["X-Payload-Length"]), digest, kind, number(fields.get("WARC-Refers-To")), block))
            kinds = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary())
            columns = list(zip(*out)) if out else [()] * 6
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds)],
                names=["id", "payload_bytes", "payload_digest", "record_type", "refers_to", "payload"],
            )

    return index.sortWithinPartitions("bundle", "frame", "at").mapInArrow(
        run, "id long, payload_bytes long, payload_digest string, record_type string, refers_to long, payload binary",
    )


def archive(pages: DataFrame, folder: str | None = None, bundles: int | None = None, **columns) -> tuple[DataFrame, str]:
    """Write all pages; the written index and the folder of the bundles."""
    sweep(pages)
    folder = folder or new_path(pages.sparkSession, "warc")
    index = write_bundles(classified(pages, **columns), folder, bundles or partitions(pages))
    return written(index, "warc-index"), folder


def round_trip(pages: DataFrame) -> DataFrame:
    """The query's columns, from records read back out of the archives."""
    index, _ = archive(pages)
    return read_records(index.repartition(partitions(pages), "bundle")).select(
        F.col("id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", "refers_to",
    )
