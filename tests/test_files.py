"""Codecs, readers, sinks, jobs and the stream on files made here."""

import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from tesselake.operators import infer, listing, signal
from tesselake.plans import jobs
from tesselake.sources import codecs, files, sinks
from tesselake.streaming.incremental import names_session, process_new


def sine(rate=8000, seconds=0.5, channels=2, hz=440):
    t = np.arange(int(rate * seconds)) / rate
    return np.stack([0.5 * np.sin(2 * np.pi * hz * (c + 1) * t) for c in range(channels)]).astype(np.float32)


@pytest.mark.parametrize(("bits", "error"), [(8, 2e-2), (16, 1e-4), (24, 1e-6), (32, 0), (64, 0)])
@pytest.mark.parametrize("channels", [1, 2, 4])
def test_wav(bits, error, channels):
    x = sine(channels=channels)
    raw = codecs.write_wav(x, 8000, bits)
    y, rate = codecs.read_wav(raw)
    assert rate == 8000 and y.shape == x.shape and np.abs(x - y).max() <= error
    assert codecs.read_wav_header(raw) == (channels, x.shape[1], 8000)
    with pytest.raises(ValueError, match="truncated"):
        codecs.read_wav(raw[:-10])


def test_other_codecs():
    assert np.array_equal(codecs.read_npy(codecs.write_npy(np.eye(3))), np.eye(3))
    assert set(codecs.read_npz(codecs.write_npz({"a": np.ones(2), "b": np.zeros(1)}))) == {"a", "b"}
    with pytest.raises(ValueError, match="bit depth"):
        codecs.write_wav(sine(), 8000, 12)
    assert codecs.convert(sine(channels=1), 8000, 4000, 2).shape == (2, 2000)
    assert codecs.convert(sine(), 8000, 8000, 1).shape == (1, 4000)


@pytest.fixture
def lake(tmp_path):
    root = tmp_path / "lake"
    for i in range(4):
        d = root / f"t{i}"
        d.mkdir(parents=True)
        (d / f"t{i}.wav").write_bytes(codecs.write_wav(sine(channels=1 + i % 2), 8000))
        (d / f"t{i}.probs.npy").write_bytes(codecs.write_npy(np.full((2, 10), i / 4, np.float32)))
    (root / "t0" / "bad.wav").write_bytes(b"RIFF no")
    return root


def test_decode(spark, lake):
    out = files.decode_audio(listing.list_files(spark, f"{lake}/**.wav", content=True))
    assert {r.status: r.n for r in out.groupBy("status").agg(F.count("*").alias("n")).collect()} == {"ok": 4, "failed": 1}
    assert tuple(jobs.example(spark, str(lake)).first()) == (4, 1, 2.0)
    found = jobs.dataset_stats(spark, str(lake))
    assert found["totals"].first().total_count == 4 and {r.kind: r.n for r in found["channels"].collect()} == {"mono": 2, "stereo": 2}
    shaped = files.load_arrays(listing.list_files(spark, f"{lake}/**.npy", content=True))
    assert all(r.shape == [2, 10] for r in shaped.collect())
    mono = files.decode_audio(listing.list_files(spark, f"{lake}/t1/t1.wav", content=True), rate=4000, mono=True).first()
    assert (mono.n_channels, mono.n_samples, mono.sr) == (1, 2000, 4000)


def test_json_and_manifest(spark, lake, tmp_path):
    (tmp_path / "m.json").write_text(json.dumps({"a": ["t0/t0.wav", "none.wav"], "b": ["t1/t1.wav"]}))
    assert sorted(r.path[-6:] for r in files.manifest_files(spark, str(tmp_path / "m.json"), str(lake)).collect()) == ["t0.wav", "t1.wav"]
    made = spark.createDataFrame([("p", b'{"x": 3}'), ("q", b"{")], "path string, content binary")
    assert [r.value.x if r.value else None for r in files.load_json(made, "x int").orderBy("path").collect()] == [3, None]
    dirs = spark.createDataFrame([("/r/shard-1/a/x",), ("/r/shard-1/a/y",), ("/r/other/a/x",)], "path string")
    assert [r.subdir for r in files.track_directories(dirs, "/r").collect()] == ["shard-1/a"]


def test_sinks(spark, tmp_path):
    rows = spark.createDataFrame([(f"{tmp_path}/out/{i}.bin", bytes([i])) for i in range(5)], "out_path string, content binary")
    assert sinks.write_files(rows).where("status = 'ok'").count() == 5
    pairs = spark.createDataFrame([(f"{tmp_path}/out/1.bin", f"{tmp_path}/copy/x/1.bin"), (f"{tmp_path}/none", f"{tmp_path}/copy/none")], "src string, dst string")
    assert sorted(r.status for r in sinks.copy_files(pairs).collect()) == ["failed", "ok"]
    assert (tmp_path / "copy/x/1.bin").read_bytes() == b"\1"
    data = spark.createDataFrame([(i, f"é{i}") for i in range(200)], "a int, b string")
    sinks.write_shards(data, f"{tmp_path}/mds", max_bytes=500)
    back = sinks.read_shards(spark, f"{tmp_path}/mds")
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, data.collect()))
    assert len(json.loads((tmp_path / "mds/index.json").read_text())["shards"]) > 4
    sinks.write_json_lines(data, f"{tmp_path}/lines")
    assert spark.read.json(f"{tmp_path}/lines").count() == 200


def test_model_job_and_rerun(spark, lake):
    contract = infer.Contract("embedding", ".emb.npy", 8000)
    make = lambda: infer.over_windows(infer.dummy(8, 30), 8000, 0.2, 0.15)
    glob = f"{lake}/**/t*.wav"
    assert jobs.run_model(spark, glob, ".wav", contract, make).where("status = 'ok'").count() == 4
    x = codecs.read_npy((lake / "t1/t1.emb.npy").read_bytes())
    assert x.shape == (8, 15) and x.dtype == np.float32
    assert jobs.run_model(spark, glob, ".wav", contract, make).count() == 0
    audio = files.decode_audio(listing.list_files(spark, glob, content=True))
    wrong = infer.infer(audio, lambda: infer.dummy(2, 10), infer.CONTRACTS["classifier"])
    assert {r.status for r in wrong.collect()} == {"failed"}


def test_separation_with_vocal_gate(spark, lake):
    probs = spark.createDataFrame([("t1", [0.95] * 10), ("t3", [0.1] * 10)], "stem string, probs array<float>")
    half = lambda: lambda x: np.stack([x * 0.5, x * 0.5])
    out = jobs.separate(spark, f"{lake}/**/t*.wav", ".wav", half, only_if_vocals=True, vocals=probs)
    assert sorted(r.path.rpartition("/")[2] for r in out.collect()) == ["t1.instrumental.wav", "t1.vocals.wav"]
    assert codecs.read_wav((lake / "t1/t1.vocals.wav").read_bytes())[1] == 44100


def test_transcode_shard_and_training_set(spark, lake, tmp_path):
    out = jobs.transcode(spark, f"{lake}/t1", ".wav", ".npy", 4000, crop_duration=0.25)
    assert out.where("status = 'ok'").count() == 1 and codecs.read_npy((lake / "t1/t1.npy").read_bytes()).shape == (2, 1000)
    copied = jobs.shard(spark, str(lake), f"{tmp_path}/sharded", ".probs.npy", [".wav", ".probs.npy", ".none"], num_files_per_shard=3)
    assert copied.where("status = 'ok'").count() == 8
    assert (tmp_path / "sharded/shard-0001/t3/t3.source.wav").exists()
    with pytest.raises(FileExistsError):
        jobs.shard(spark, str(lake), f"{tmp_path}/sharded", ".wav", [".wav"])
    tracks = spark.createDataFrame([(1,), (2,)], "k int")
    value = spark.createDataFrame([(1, [[0.0] * 5] * 2), (2, [[0.0] * 5] * 3)], "k int, value array<array<double>>")
    rows = jobs.training_set(tracks, "k", {"f": value}, {}, dims={"f": 2})
    assert [r.k for r in rows.collect()] == [1]


def test_byte_features(spark, tmp_path):
    words = [{"word": "hé", "start": 0.0, "end": 1.0}]
    (tmp_path / "a.whisper.json").write_text(json.dumps({"lyrics": [{"words": words, "start": 0, "end": 1}]}))
    (tmp_path / "b.whisper.json").write_text(json.dumps({"lyrics": [{"words": [{"word": "Bye.", "start": 0.0, "end": 1.0}], "start": 0, "end": 1}]}))
    out = jobs.byte_features(spark, f"{tmp_path}/*.whisper.json").collect()
    assert len(out) == 1 and out[0].tokens == [107, 198, 172] and out[0].ends == [1.0] * 3


def test_classifiers_speech_and_lyrics(spark, lake):
    heads = {"mood_sad": lambda x: x[:2], "timbre": lambda x: 1 / 0, "tempo": lambda x: x[:1]}
    embed = lambda x, rate: np.abs(x[: 16 * 10]).reshape(16, 10)
    out = jobs.classify(spark, f"{lake}/t1", ".wav", heads, embed)
    assert [r.path.rpartition("/")[2] for r in out.collect()] == ["t1.mood_sad.npy"]
    assert jobs.classify(spark, f"{lake}/t2", ".wav", heads, embed, ["tempo", "mood_sad"]).count() == 2
    with pytest.raises(ValueError, match="unknown"):
        jobs.classify(spark, str(lake), ".wav", heads, embed, ["none"])
    words = lambda: lambda x, sr: [] if x.shape[0] == 1 else [{"start": 0.0, "end": 1.0, "words": [{"word": "so", "start": 0.0, "end": 1.0}]}]
    said = jobs.transcribe(spark, f"{lake}/**/t*.wav", ".wav", words)
    assert sorted(r.path.rpartition("/")[2] for r in said.collect()) == ["t1.whisper.json", "t3.whisper.json"]
    made = jobs.embed_lyrics(spark, f"{lake}/**.whisper.json", lambda: lambda t: np.ones((4, len(t))))
    assert made.where("status = 'ok'").count() == 2
    found = codecs.read_npz((lake / "t1/t1.whisper-byt5.npz").read_bytes())
    assert found["embeds"].shape == (4, 2) and found["tokens"].tolist() == [ord("s") + 3, ord("o") + 3]


def test_stream(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "out").mkdir()
    for i in range(3):
        (tmp_path / f"in/{i}.txt").write_text("x")
    (tmp_path / "out/1.npy").write_text("y")
    seen = []
    run = lambda: process_new(spark, f"{tmp_path}/in/*.txt", f"{tmp_path}/out/**", ".txt", [".npy"], lambda df: seen.extend(r.path[-5:] for r in df.select("path").collect()), f"{tmp_path}/state", source_dir=f"{tmp_path}/in", target_dir=f"{tmp_path}/out").awaitTermination(60)
    run()
    assert sorted(seen) == ["0.txt", "2.txt"]
    (tmp_path / "in/7.txt").write_text("x")
    run()
    assert sorted(seen) == ["0.txt", "2.txt", "7.txt"]


def test_a_stream_of_names_takes_few_batches(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "out").mkdir()
    for i in range(1100):
        (tmp_path / f"in/{i}.txt").write_text("x")
    (tmp_path / "out/1.npy").write_text("y")
    lookup = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
    before, seen = spark.conf.get(lookup), []
    own = names_session(spark)
    assert own.conf.get(lookup) == "64" and own.conf.get("spark.sql.shuffle.partitions") == spark.conf.get("spark.sql.shuffle.partitions")
    process_new(
        spark, f"{tmp_path}/in/*.txt", f"{tmp_path}/out/**", ".txt", [".npy"], lambda df: seen.append((df.columns, {r.path.rpartition("/")[2] for r in df.collect()})),
        f"{tmp_path}/state", source_dir=f"{tmp_path}/in", target_dir=f"{tmp_path}/out", content=False,
    ).awaitTermination(60)
    assert len(seen) == 1 and seen[0][0] == ["path", "modificationTime", "length"]
    assert seen[0][1] == {f"{i}.txt" for i in range(1100) if i != 1}
    assert spark.conf.get(lookup) == before


def exchanges(df):
    """The columns of each shuffle of the plan."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    return [line for line in plan.splitlines() if "Exchange" in line], plan


def test_only_pending_files_are_opened_and_contents_are_not_shuffled(spark, lake):
    glob = f"{lake}/**/t*.wav"
    (lake / "t1/t1.npy").write_bytes(b"made")
    # a file that is done may not even be readable
    (lake / "t1/t1.wav").unlink()
    (lake / "t1/t1.wav").symlink_to(lake / "t1/t1.npy")
    todo = jobs.pending(spark, glob, ".wav", [".npy"])
    opened = jobs.open_files(spark, glob, todo)
    assert sorted(r.path[-6:] for r in opened.select("path").collect()) == ["t0.wav", "t2.wav", "t3.wav"]
    _, plan = exchanges(opened)
    above = plan[: plan.index("MapInArrow")] if "MapInArrow" in plan else plan
    assert "Exchange" not in above and "content" not in plan[plan.index("MapInArrow") :].partition("\n")[2]
    gone = files.contents(spark.createDataFrame([(f"{lake}/none.npy",)], "path string"))
    failed = files.load_features(gone).first()
    assert failed.status == "failed" and failed.error.startswith("FileNotFoundError")


def test_headers_of_beginnings(spark, lake):
    head = jobs.open_files(spark, f"{lake}/**/t*.wav", first=64)
    assert {len(r.content) for r in head.collect()} == {64}
    found = files.audio_headers(head).collect()
    assert {(r.status, r.n_samples, r.sr) for r in found} == {("ok", 4000, 8000)}
    raw = (lake / "t0/t0.wav").read_bytes()
    with pytest.raises(ValueError, match="truncated"):
        codecs.read_wav_header(raw[:64], len(raw) - 1)


def test_the_model_is_made_once_per_task(spark, lake):
    made, run = spark.sparkContext.accumulator(0), spark.sparkContext.accumulator(0)

    def factory():
        made.add(1)

        def model(x):
            run.add(1)
            return np.stack([x, x, x])

        return model

    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    try:
        out = jobs.separate(spark, f"{lake}/**/t*.wav", ".wav", factory, stems=("a", "b", "c")).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert len(out) == 6 and (made.value, run.value) == (1, 2)  # two stereo files, three stems each


def test_transcode_skips_what_is_done(spark, lake):
    out = lambda **k: sorted(r.path[-6:] for r in jobs.transcode(spark, str(lake), ".wav", ".npy", 4000, **k).where("status = 'ok'").collect())
    assert out() == ["t0.npy", "t1.npy", "t2.npy", "t3.npy"]
    (lake / "t2/t2.npy").unlink()
    assert out() == ["t2.npy"]
    assert len(out(overwrite=True)) == 4


def test_features_by_extension(spark, tmp_path):
    made = {"a.npy": codecs.write_npy(np.arange(6.0).reshape(2, 3)), "b.npz": codecs.write_npz({"x": np.ones(4)}), "c.json": b'{"k": 1}', "d.json": b"{", "e.bin": b"?"}
    for name, raw in made.items():
        (tmp_path / name).write_bytes(raw)
    rows = {r.path.rpartition("/")[2]: r for r in files.load_features(jobs.open_files(spark, f"{tmp_path}/*"), "x").collect()}
    assert rows["a.npy"].shape == [2, 3] and rows["a.npy"].data == [0, 1, 2, 3, 4, 5] and rows["b.npz"].shape == [4]
    assert rows["c.json"].json == '{"k": 1}' and {k for k, r in rows.items() if r.status == "failed"} == {"d.json", "e.bin"}


def test_typed_shards(spark, tmp_path):
    rows = spark.createDataFrame([(i, [[float(i)] * 3] * 2, bytes([i])) for i in range(50)], "k int, x array<array<float>>, raw binary").repartition(2)
    sinks.write_shards(rows, f"{tmp_path}/s", max_bytes=400)
    back = sinks.read_shards(spark, f"{tmp_path}/s")
    assert back.schema == rows.schema and sorted(map(tuple, back.collect())) == sorted(map(tuple, rows.collect()))
    index = json.loads((tmp_path / "s/index.json").read_text())
    assert sum(x["rows"] for x in index["shards"]) == 50 and all(x["raw_bytes"] <= 400 for x in index["shards"])
    one = tmp_path / "s" / index["shards"][0]["name"]
    one.write_bytes(one.read_bytes()[:-1] + b"x")
    with pytest.raises(Exception, match="has changed"):
        sinks.read_shards(spark, f"{tmp_path}/s").count()


def test_signals_cross_as_buffers():
    made = [np.arange(6, dtype=np.float32).reshape(2, 3), None, np.zeros((1, 0), np.float32), np.ones((3, 2), np.float32)]
    back = signal.signals(signal.as_column(made).slice(0))
    assert [None if x is None else x.tolist() for x in back] == [None if x is None else x.tolist() for x in made]
    assert np.array_equal(signal.signals(signal.as_column(made).slice(3))[0], made[3])


def test_music_statistics(spark, tmp_path):
    def put(name, rows):
        (tmp_path / name).write_bytes(codecs.write_npy(np.array(rows, np.float32)))

    put("a.music.npy", [[0.9, 0.8], [0.1, 0.2]])
    put("b.music.npy", [[0.1, 0.2], [0.9, 0.8]])
    put("c.music.npy", [[0.9, 0.9], [0.1, 0.1]])
    put("a.vocal.npy", [[0.0, 0.0], [0.95, 0.0]])
    put("a.genre.npy", [[0.9, 0.1], [0.2, 0.85], [0.1, 0.1]])
    put("b.genre.npy", [[0.9, 0.1], [0.2, 0.85], [0.1, 0.1]])
    (tmp_path / "e.genre.npy").write_bytes(codecs.write_npy(np.zeros((0, 5), np.float32)))
    found = jobs.music_stats(spark, str(tmp_path), ["jazz", "rock", "folk"])
    counts = {k: {tuple(r)[0]: r.n for r in v.collect()} for k, v in found.items()}
    assert counts == {"music": {True: 2, False: 1}, "vocal": {True: 1, False: 1}, "genres": {"jazz": 1, "rock": 1}}
    none = files.load_features(jobs.open_files(spark, f"{tmp_path}/e.genre.npy"))
    assert jobs.feature_stats(none, ["jazz"])["genres"].count() == 0


def test_codec_of_a_program():
    assert codecs.by_program("other", "no-such-program") is False and "other" not in codecs.DECODERS
    assert codecs.by_program("webm") == ("webm" in codecs.DECODERS)
    if not codecs.by_program("ogg"):
        pytest.skip("ffmpeg isn't installed")
    y, rate = codecs.DECODERS["ogg"](codecs.ENCODERS["ogg"](sine(rate=16000, seconds=1.0), 16000))
    assert rate == 16000 and abs(y.shape[1] - 16000) < 2000
