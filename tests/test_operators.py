"""Listing, incremental processing, statistics, sharding and framing on small inputs."""

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from tesselake.operators import assemble, framing, incremental, listing, sharding, signal, stats

OLD, NEW = dt.datetime(2024, 1, 1), dt.datetime(2024, 2, 1)


def files(spark, *rows):
    return spark.createDataFrame(list(rows), "path string, modificationTime timestamp")


def test_listing(spark, tmp_path):
    for d in ("00", "01"):
        for n in ("a.txt", "b.txt"):
            (tmp_path / d).mkdir(exist_ok=True)
            (tmp_path / d / n).write_text(d + n)
    found = listing.list_files(spark, f"{tmp_path}/**.txt")
    assert found.count() == 4 and "content" not in found.columns
    both = listing.match_all(found, [f"{tmp_path}/00/*.txt", f"{tmp_path}/*/a.txt"])
    assert sorted(r.path[-8:] for r in both.collect()) == ["00/a.txt", "00/a.txt", "00/b.txt", "01/a.txt"]
    assert listing.list_files(spark, f"{tmp_path}/*.none").count() == 0
    with pytest.raises(FileNotFoundError):
        listing.require(listing.list_files(spark, f"{tmp_path}/*.none"), "*.none")


def test_skip_completed(spark):
    src = files(spark, ("/s/1.wav", NEW), ("/s/2.wav", NEW), ("/s/3.wav", OLD), ("/s/4.wav", OLD))
    made = files(spark, ("/s/1.npy", OLD), ("/s/3.npy", NEW), ("/s/3.b", NEW), ("/s/4.npy", OLD))
    run = lambda *a, **k: sorted(r.path for r in incremental.skip_completed(src, made, ".wav", *a, **k).collect())
    assert run(".npy") == ["/s/2.wav"]
    assert run([".npy", ".b"]) == ["/s/1.wav", "/s/2.wav", "/s/4.wav"]
    assert run(".npy", check_timestamp=True) == ["/s/1.wav", "/s/2.wav"]
    assert len(run(".npy", overwrite=True)) == 4
    with pytest.raises(ValueError, match="both"):
        run(".npy", source_dir="/s")
    moved = files(spark, ("/t/1.npy", NEW))
    assert incremental.skip_completed(src, moved, ".wav", ".npy", "/s/", "/t").count() == 3


def test_totals_of_nothing(spark):
    empty = spark.createDataFrame([], "duration double")
    assert tuple(stats.totals(empty).first()) == (0, 0.0, 0.0, 0.0)
    assert stats.histogram(empty, "duration").count() == 0


def test_stats(spark):
    rows = spark.createDataFrame([(3.5, True, 44100), (2.0, False, 48000), (4.5, True, 44100), (5.0, False, 96000)], "duration double, stereo boolean, sr int")
    assert stats.totals(rows).first().seconds == 15.0
    kinds = stats.counts(rows, stats.channel_kind(F.when(F.col("stereo"), 2).otherwise(1)), "kind")
    assert {r.kind: r.n for r in kinds.collect()} == {"stereo": 2, "mono": 2}
    same = spark.createDataFrame([(1.0,)] * 3, "duration double")
    assert [tuple(r) for r in stats.histogram(same, "duration").collect()] == [(0, 3)]


@pytest.mark.parametrize("n", [0, 1, 7, 100])
def test_enumerate_and_shards(spark, n):
    df = spark.createDataFrame([(f"f{i:04d}",) for i in range(n)], "path string").repartition(3)
    got = sorted((r.path, r.idx) for r in sharding.enumerated(df, "path", 5, partitions=4).collect())
    assert got == [(f"f{i:04d}", i + 5) for i in range(n)]
    shards = sharding.chunked(sharding.sharded(df, "path", 30, first=2), 30, 10).groupBy("shard").count().orderBy("shard").collect()
    assert [r["count"] for r in shards] == [30] * (n // 30) + [n % 30] * (n % 30 > 0)
    assert sharding.sharded(df, "path", 30, limit=12).count() == min(n, 12)


@pytest.mark.parametrize(("n", "window", "hop"), [(19000, 4000, 3000), (19500, 4000, 3000), (10, 8, 6), (5, 8, 6), (8, 8, 6), (64, 20, 12), (50, 20, 5)])
def test_frames_and_constant_signal(spark, n, window, hop):
    ones = np.ones((1, n), np.float32)
    parts = signal.frames(ones, window, hop)
    df = spark.createDataFrame([(1, ones[0].tolist())], "k int, x array<float>")
    frames = framing.make_frames(df, "k", "x", window, hop)
    got = {r["index"]: (r.start, len(r.frame)) for r in frames.collect()}
    assert got == {i: (i * hop, p.shape[1]) for i, p in enumerate(parts)}
    if window < 2 * hop:
        out = signal.overlap_add(parts, hop, n)
        total = framing.overlap_add(frames, "k", window, hop).orderBy("at").collect()
        assert np.allclose([r.value for r in total], out[0][: len(total)])
        if parts[-1].shape[-1] + (len(parts) - 1) * hop == n:
            assert np.allclose(out, 1)


def test_resampling():
    t = np.arange(4410) / 44100
    x = np.sin(2 * np.pi * 1000 * t)[None].astype(np.float32)
    y = signal.resample(x, 44100, 48000)
    assert y.shape == (1, 4800) and np.abs(y[0, 200:-200] - np.sin(2 * np.pi * 1000 * np.arange(4800) / 48000)[200:-200]).max() < 0.02
    assert signal.resample(x, 44100, 44100) is not None and np.array_equal(signal.resample(x, 44100, 44100), x)
    assert signal.resample(np.zeros((2, 1000)), 1000, 10).shape == (2, 10)
    back = signal.resample(y, 48000, 44100)
    assert signal.spectral_divergence(x[:, 500:-500], back[:, 500:-500])[0] < 0.1
    with pytest.raises(ValueError, match="channels"):
        signal.resample(np.zeros((129, 10)), 10, 20)


def test_assembly(spark):
    k = lambda rows: spark.createDataFrame(rows, "k int, value int")
    out = assemble.assemble(spark.createDataFrame([(1,), (2,), (3,)], "k int"), "k", {"a": k([(1, 10), (2, 20)])}, {"b": (k([(2, 5)]), F.lit(-1))})
    assert sorted(map(tuple, out.collect())) == [(1, 10, -1), (2, 20, 5)]
    rows, seen = assemble.counted(out, lambda: F.col("b") > 0)
    rows.collect()
    assert seen.get == {"success": 1, "error": 1}
