import hashlib
import io
from pathlib import Path
from urllib.parse import urlparse

import zstandard

from tesselake.llm import warc

LONG = "<html>" + "é" * 100
ROWS = [(5, "http://a", LONG), (3, "http://b\r\nX: y", LONG), (9, None, LONG), (1, "u", "short"), (2, "u", "short"), (4, "u", None), (6, "u", ""), (None, "u", LONG), (3, "again", LONG), (7, "u", "x" * 99), (8, "u", "x" * 99), (10, "u", "WARC/1.1\r\n\r\n" * 40)]


def test_round_trip(spark):
    out = sorted(map(tuple, warc.round_trip(spark.createDataFrame([(*r, 1) for r in ROWS], "page_id long, url string, html string, frame int")).collect()), key=str)
    want = []
    for i, _, html in ROWS:
        raw = (html or "").encode()
        same = [j for j, _, h in ROWS if j is not None and (h or "") == (html or "")]
        again = len(raw) >= 100 and i is not None and min(same) < i
        want.append((i, len(raw), hashlib.sha256(raw).hexdigest(), "revisit" if again else "response", min(same) if again else None))
    assert out == sorted(want, key=str)


def test_payloads_come_back_by_random_access(spark):
    pages = spark.createDataFrame([(i, f"http://{i}", f"{i} " * (i * 7)) for i in range(200)], "page_id long, url string, html string")
    index, folder = warc.archive(pages, bundles=3)
    got = {r.id: bytes(r.payload) for r in warc.read_records(index).collect()}
    first = {}
    for i in range(200):
        first.setdefault(f"{i} " * (i * 7), i)
    assert all(got[i] == (f"{i} " * (i * 7)).encode() for i in first.values())
    # a bundle is a plain sequence of frames to other readers, too
    files = list(Path(urlparse(folder).path).glob("bundle-*.warc.zst"))
    assert files and all(zstandard.ZstdDecompressor().stream_reader(io.BytesIO(f.read_bytes()), read_across_frames=True).read().startswith(b"WARC/1.1\r\n") for f in files)


def test_record_ids_are_unique_and_referred_to(spark):
    index, folder = warc.archive(spark.createDataFrame(ROWS * 3, "page_id long, url string, html string"), bundles=2)
    raw = b"".join(zstandard.ZstdDecompressor().stream_reader(io.BytesIO(f.read_bytes()), read_across_frames=True).read() for f in Path(urlparse(folder).path).glob("*.zst"))
    fields = [dict(line.split(": ", 1) for line in part.split("\r\n")[1:] if ": " in line) for part in raw.decode().split("WARC/1.1\r\nWARC-Type")[1:]]
    ids = [f["WARC-Record-ID"] for f in fields]
    assert len(ids) == len(set(ids)) == index.count() == 3 * len(ROWS)
    assert {f["WARC-Refers-To"] for f in fields if "WARC-Refers-To" in f} <= set(ids)


def test_long_payloads_and_several_bundles_of_a_task(spark):
    pages = [(i, "u", f"{i} " + "y" * (3_000_000 if i == 5 else 2000)) for i in range(60)]
    df = spark.createDataFrame(pages, "page_id long, url string, html string")
    folder = warc.new_path(spark, "warc")
    index = warc.written(warc.write_bundles(warc.classified(df), folder, 2, bundle_bytes=20_000), "index")
    assert index.select("bundle").distinct().count() > 4
    assert {r.id: bytes(r.payload) for r in warc.read_records(index).collect()} == {i: html.encode() for i, _, html in pages}


def test_seek_table():
    out = io.BytesIO()
    bundle = warc.Bundle(out, 100)
    places = [bundle.add(bytes([i]) * 60) for i in range(5)]
    bundle.close()
    frames = warc.read_seek_table(out, len(out.getvalue()))
    assert len(frames) == 5 and [p[0] for p in places] == list(range(5))
    at, packed, size = frames[3]
    assert zstandard.ZstdDecompressor().decompress(out.getvalue()[at : at + packed]) == bytes([3]) * size


def test_empty(spark):
    assert warc.round_trip(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0
