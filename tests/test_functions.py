"""Hand-written expectations for paths, arrays and lyrics."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tesselake.functions import arrays, lyrics, paths


def one(spark, column, **values):
    return spark.range(1).select(*[F.lit(v).alias(k) for k, v in values.items()]).select(column.alias("x")).first().x


@pytest.mark.parametrize(
    ("file", "source", "target", "want"),
    [
        ("gs://b/audios/00/1.mp3", "gs://b/audios/", "/else/", "/else/00/1.mp3"),
        ("gs://b/audios/00/1.mp3", "gs://b/audios", "/else", "/else/00/1.mp3"),
        ("/a//b/c.wav", "/a/b", "s3://x/y", "s3://x/y/c.wav"),
        ("/a/b/c.wav", "/a//b//", "t/", "t/c.wav"),
    ],
)
def test_move(spark, file, source, target, want):
    assert one(spark, paths.move(F.col("p"), source, target), p=file) == want


def test_move_outside(spark):
    with pytest.raises(Exception, match="not in"):
        one(spark, paths.move(F.col("p"), "/a/b", "/c"), p="/a/bc/d.wav")


@pytest.mark.parametrize(("path", "suffix", "want"), [("a.source.mp3", ".source.mp3", "a"), ("a.mp3", ".wav", "a.mp3"), ("a.mp3", "", "a.mp3")])
def test_remove_suffix(spark, path, suffix, want):
    assert one(spark, paths.remove_suffix(F.col("p"), suffix), p=path) == want


@pytest.mark.parametrize(("path", "pattern", "want"), [("x.instrumental.stem.mp3", r"\.(instrumental|vocals)\.stem\.mp3", "x"), ("x.mp3.mp3", r"\.mp3", "x.mp3"), ("x.mp3.wav", r"\.mp3", "x.mp3.wav"), ("x", r"\.wav", "x")])
def test_remove_suffix_pattern(spark, path, pattern, want):
    assert one(spark, paths.remove_suffix_pattern(F.col("p"), pattern), p=path) == want


@pytest.mark.parametrize(("path", "want"), [("gs://b/1.0.source.stem.mp3", "gs://b/1.4.source.stem.mp3"), ("gs://b/1.9.source.mp3", "gs://b/1.13.source.mp3"), ("gs://b/1.source.mp3", "gs://b/1.source.mp3"), ("/d.1.e/a.b", "/d.1.e/a.b"), ("a.007.x.8.y", "a.11.x.8.y")])
def test_increment_index(spark, path, want):
    assert one(spark, paths.increment_index(F.col("p")), p=path) == want


@pytest.mark.parametrize(("glob", "path", "want"), [("/a/**.wav", "/a/b/c.wav", True), ("/a/*.wav", "/a/b/c.wav", False), ("/a/4**.ogg", "/a/4/x.ogg", True), ("/a/[0-3]?.txt", "/a/2x.txt", True), ("/a/[!0-3].txt", "/a/2.txt", False), ("/a/x.y", "/a/xzy", False)])
def test_glob(spark, glob, path, want):
    assert one(spark, F.col("p").rlike(paths.glob_regex(glob)), p=path) is want


def test_names(spark):
    p = "/root/shard-0001/t1/t1.voice.npy"
    assert one(spark, paths.file_stem(F.col("p")), p=p) == "t1"
    assert one(spark, paths.dir_name(F.col("p")), p=p) == "t1"
    assert one(spark, paths.dir_name(F.col("p")), p="x") is None
    assert one(spark, paths.wds_id(F.col("p")), p=p) == "/root/shard-0001/t1/t1"
    assert one(spark, paths.wds_ext(F.col("p")), p=p) == "voice.npy"
    assert one(spark, paths.shard_path(F.col("p"), "/src", "/dst", F.lit(12345)), p="/src/a/b.c.mp3") == "/dst/shard-12345/a/b.c.source.mp3"
    assert paths.literal_root("/a/b/c*.wav") == "/a/b/" and paths.literal_root("/a/b.wav") == "/a/b.wav"


@pytest.mark.parametrize(("probs", "want"), [([0.95] * 2 + [0.1] * 8, True), ([0.95] + [0.1] * 9, True), ([0.95] + [0.1] * 10, False), ([0.9] * 10, False), ([], False), ([float("nan")] * 3, False)])
def test_majority_vote(spark, probs, want):
    df = spark.createDataFrame([(probs,)], "x array<float>")
    assert df.select(arrays.majority_vote(F.col("x"))).first()[0] is want


def test_argmax_and_above(spark):
    df = spark.createDataFrame([([0.1, 0.9, 0.9, float("nan")],)], "x array<float>")
    assert df.select(arrays.above(F.col("x"), 0.5)).first()[0] == [1, 2]
    assert spark.createDataFrame([([1.0, 3.0, 3.0],)], "x array<float>").select(arrays.first_largest(F.col("x"))).first()[0] == 1


def test_fades():
    assert arrays.fade_in(1) == [0.0] and arrays.fade_in(3) == [0.0, 0.5, 1.0] and arrays.fade_in(0) == []


@pytest.mark.parametrize(("index", "total", "length", "overlap"), [(0, 3, 8, 3), (1, 3, 8, 3), (2, 3, 8, 3), (1, 3, 5, 3), (1, 3, 4, 4), (0, 1, 6, 2), (1, 2, 6, 1)])
def test_envelope_equals_kernel(spark, index, total, length, overlap):
    from tesselake.operators.signal import fades

    got = spark.range(length).select(arrays.envelope(F.col("id"), F.lit(index), F.lit(total), F.lit(length), overlap).alias("w")).orderBy("id").collect()
    assert np.allclose([r.w for r in got], fades(total, np.full(total, length), overlap)[index])


def test_crops(spark):
    df = spark.createDataFrame([([1.0] * 10,)], "x array<float>")
    assert df.select(F.size(arrays.crop_longer(F.col("x"), F.lit(4), 2.0))).first()[0] == 8
    assert df.select(F.size(arrays.crop_longer(F.col("x"), F.lit(4), 2.5))).first()[0] == 10
    assert df.select(arrays.crop_at(F.col("x"), F.lit(0), 10)).first()[0] is None


def test_lyrics(spark):
    import json

    w = lambda *x: {"words": [{"word": t, "start": float(i), "end": i + 0.5} for i, t in enumerate(x)], "start": 0.0, "end": 1.0}
    text = json.dumps({"lyrics": [w("Hello", "wörld"), w("Thank", "you."), w("Bye."), w("one", "two", "three", "four")]})
    df = spark.createDataFrame([(1, text)], "k int, j string").select("k", F.from_json("j", lyrics.LYRICS).alias("l"))
    found = lyrics.words(df, "k", "l").orderBy("segment", "at").collect()
    assert [r.word for r in found] == ["Hello", "wörld", "one", "two", "three", "four"]
    assert one(spark, lyrics.byte_tokens(F.col("t")), t="aé") == [100, 0xC3 + 3, 0xA9 + 3]
    with pytest.raises(Exception, match="must end"):
        one(spark, lyrics.require_suffix(F.col("p")), p="x.json")
