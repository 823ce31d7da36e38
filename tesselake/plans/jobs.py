"""The batch jobs, one function each: listing, skip-completed, decode, transform, encode or aggregate.

Each returns a lazy DataFrame; jobs that write return one row of status per file.  Model-running jobs take a factory
of the model (see operators.infer); rates and suffixes follow the model's contract.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions import arrays, lyrics, paths
from ..operators import assemble, infer, listing, sharding, signal, stats
from ..operators.incremental import skip_completed
from ..sources import files, sinks


def open_files(spark: SparkSession, glob: str, todo: DataFrame | None = None, first: int | None = None) -> DataFrame:
    """Files with contents (or their first bytes); with ``todo`` only those listed there.

    Paths are dealt out anew, and each file is opened in the task that has its path: contents are never shuffled, and of
    files that aren't asked for nothing is read."""
    found = listing.list_files(spark, glob) if todo is None else todo
    return files.contents(listing.rebalance(found.select("path"), int(spark.conf.get("spark.sql.shuffle.partitions"))), first)


def pending(spark: SparkSession, glob: str, suffix: str, new_suffixes: list[str], overwrite: bool = False, **options) -> DataFrame:
    """The files of a glob that miss a target beside them (or under target_dir)."""
    root = options.get("target_dir") or paths.literal_root(glob)
    targets = listing.list_files(spark, root.rstrip("/") + "/**")  # metadata alone
    return skip_completed(listing.list_files(spark, glob), targets, suffix, new_suffixes, overwrite=overwrite, **options)


def example(spark: SparkSession, source_audio_path: str, source_audio_suffix: str = ".wav") -> DataFrame:
    """Total duration, files decoded and files failed."""
    audio = files.decode_audio(open_files(spark, f"{source_audio_path.rstrip('/')}/**{source_audio_suffix}")).drop("samples")
    seconds = F.sum(F.when(F.col("status") == "ok", F.col("n_samples") / F.col("sr")))
    return audio.agg(
        F.count_if(F.col("status") == "ok").alias("audio_count"),
        F.count_if(F.col("status") == "failed").alias("failed_count"), F.coalesce(seconds, F.lit(0.0)).alias("seconds"),
    )


def dataset_stats(spark: SparkSession, source_audio_path: str, match_suffix: str = ".wav") -> dict[str, DataFrame]:
    """Count, duration, channel kinds and sample rates, from headers alone."""
    head = files.audio_headers(open_files(spark, f"{source_audio_path.rstrip('/')}/**{match_suffix}", first=files.HEAD)).where("status = 'ok'")
    head = head.withColumn("duration", F.col("n_samples") / F.col("sr"))
    return {
        "totals": stats.totals(head), "channels": stats.counts(head, stats.channel_kind(F.col("n_channels")), "kind"),
        "rates": head.select("sr").distinct(),
    }


def feature_stats(
    features: DataFrame, labels: list[str], threshold: float = 0.8, music_label: int = 0, music_threshold: float = 0.5,
) -> dict[str, DataFrame]:
    """Music and genre counts of (path, shape, data) features."""
    rows = features.where("status = 'ok'").withColumn(
        "rows",
        F.expr("transform(filter(sequence(0, shape[0]), i -> i < shape[0]), i -> slice(data, i * shape[1] + 1, shape[1]))"),
    )
    best = F.transform("rows", lambda r: F.array_max(r))
    mean = F.transform("rows", lambda r: arrays.mean_std(r)[0].cast("float"))
    genres = rows.select(F.explode(arrays.above(best, threshold)).alias("i")).select(F.element_at(F.array(*map(F.lit, labels)), F.col("i") + 1).alias("genre"))
    return {
        "music": stats.counts(rows, arrays.is_music(mean, music_label, music_threshold), "is_music"),
        "genres": stats.counts(genres, "genre", "genre"),
    }


def music_stats(
    spark: SparkSession, root: str, labels: list[str], music_suffix: str = ".music.npy",
    vocal_suffix: str = ".vocal.npy", genre_suffix: str = ".genre.npy", p_threshold: float = 0.9,
    n_threshold: float = 0.1, genre_threshold: float = 0.8, music_label: int = 0, music_threshold: float = 0.5,
) -> dict[str, DataFrame]:
    """Of the tracks with a music feature below root: how many are music and, of these, how many have vocals, and the genres of
    the music tracks.  Features are .npy files (classes x frames); a track without a vocal or genre feature counts for none."""

    def rows_of(suffix: str) -> DataFrame:
        found = files.load_features(open_files(spark, f"{root.rstrip('/')}/**{suffix}")).where("status = 'ok'")
        rows = F.expr("transform(filter(sequence(0, shape[0]), i -> i < shape[0]), i -> slice(data, i * shape[1] + 1, shape[1]))")
        return found.select(paths.remove_suffix(F.col("path"), suffix).alias("track"), rows.alias("rows"))

    music = rows_of(music_suffix).select(
        "track",
        arrays.is_music(F.transform("rows", lambda r: arrays.mean_std(r)[0].cast("float")), music_label, music_threshold).alias("is_music"),
    )
    vocal = rows_of(vocal_suffix).where(F.size("rows") > 1).select(
        "track", arrays.majority_vote(F.element_at("rows", 2), p_threshold, n_threshold).alias("is_vocal"),
    )
    kept = music.where("is_music").join(vocal, "track", "left").select("track", F.coalesce("is_vocal", F.lit(False)).alias("is_vocal"))
    best = F.transform("rows", lambda r: F.array_max(r))
    genre = rows_of(genre_suffix).join(music.where("is_music"), "track", "left_semi").select(F.explode(arrays.above(best, genre_threshold)).alias("i")).select(F.element_at(F.array(*map(F.lit, labels)), F.col("i") + 1).alias("genre"))
    return {
        "music": stats.counts(music, "is_music", "is_music"), "vocal": stats.counts(kept, "is_vocal", "is_vocal"),
        "genres": stats.counts(genre, "genre", "genre"),
    }


def run_model(
    spark: SparkSession, glob: str, audio_suffix: str, contract: infer.Contract, factory: Callable,
    overwrite: bool = False, max_duration: float | None = None, channels_first: bool = True,
) -> DataFrame:
    """List, skip completed, decode, crop, resample to the contract's rate, infer, write .npy beside each source."""
    suffix = contract.suffix
    todo = pending(spark, glob, audio_suffix, [suffix], overwrite)
    audio = files.decode_audio(open_files(spark, glob, todo))
    if max_duration:
        audio = signal.map_audio(audio, lambda _, x, sr: (x[:, : int(max_duration * sr)] if x.shape[1] / sr > max_duration else x, sr))
    if contract.rate:
        audio = signal.resampled(audio, contract.rate)
    found = infer.infer(audio, factory, contract).where("status = 'ok'")

    @F.pandas_udf("binary")
    def npy(shape, data):
        from ..sources.codecs import write_npy

        import pandas as pd

        return pd.Series([write_npy(np.asarray(d, np.float32).reshape(s)) for s, d in zip(shape, data)])

    return sinks.write_files(found.select(paths.output_path(F.col("path"), audio_suffix, suffix).alias("out_path"), npy("shape", "data").alias("content")))


def separate(
    spark: SparkSession, glob: str, audio_suffix: str, factory: Callable,
    stems: tuple[str, ...] = ("vocals", "instrumental"), only_if_vocals: bool = False, vocals: DataFrame | None = None,
    p_threshold: float = 0.9, n_threshold: float = 0.1, max_duration: float = 360, overwrite: bool = False,
) -> DataFrame:
    """Source separation: optional vocal gate (stem, probs), crop, 44.1 kHz, z-normal input, one file per stem.

    A file is decoded and separated once, the model made once per task; all its stems come from that."""
    todo = pending(spark, glob, audio_suffix, [f".{s}{audio_suffix}" for s in stems], overwrite)
    if only_if_vocals:
        todo = assemble.vocal_filter(
            todo.withColumn("stem", paths.file_stem(F.col("path"))), vocals, "stem",
            arrays.majority_vote(F.col("probs"), p_threshold, n_threshold),
        )
    def make():
        model = factory()

        def split(_, x, sr):
            if x.shape[0] != 2:
                return None
            x = signal.resample(x[:, : int(max_duration * sr)], sr, 44100)
            mono = x.mean(0)
            mean, std = mono.mean(), mono.std(ddof=1) or 1.0
            found = model((x - mean) / std)
            return {stem: ((found[i] * std + mean).astype(np.float32), 44100) for i, stem in enumerate(stems)}

        return split

    parts = signal.spread_audio(files.decode_audio(open_files(spark, glob, todo)), make)
    name = F.concat(paths.remove_suffix(F.col("path"), audio_suffix), F.lit("."), "kind", F.lit(audio_suffix))
    return sinks.write_files(sinks.encode_audio(parts.withColumn("out_path", name), audio_suffix))


def transcode(
    spark: SparkSession, src_dir: str, audio_suffix: str, target_audio_suffix: str, target_sample_rate: int = 48000,
    crop_duration: float | None = None, overwrite: bool = False,
) -> DataFrame:
    """Convert the files that have no target yet; with crop_duration a piece of that length from a place drawn by the path, shorter files go."""

    def change(path, x, sr):
        x = signal.resample(x, sr, target_sample_rate)
        if crop_duration is not None:
            n = int(crop_duration * target_sample_rate)
            if x.shape[1] <= n:
                return None
            from zlib import crc32

            start = crc32(path.encode()) % (x.shape[1] - n)
            x = x[:, start : start + n]
        return x, target_sample_rate

    glob = f"{src_dir.rstrip('/')}/**{audio_suffix}"
    audio = signal.map_audio(
        files.decode_audio(open_files(spark, glob, pending(spark, glob, audio_suffix, [target_audio_suffix], overwrite))),
        change,
    )
    return sinks.write_files(sinks.encode_audio(audio.withColumn("out_path", paths.output_path(F.col("path"), audio_suffix, target_audio_suffix)), target_audio_suffix))


def shard(
    spark: SparkSession, src_dir: str, dest_dir: str, audio_suffix: str, suffixes: list[str],
    num_files_per_shard: int = 100_000, max_dataset_size: int | None = None, min_shard_idx: int = 0,
) -> DataFrame:
    """Copy files and their features to shard directories.  The destination must be empty."""
    if not suffixes:
        raise ValueError("suffixes must not be empty")
    try:
        taken = not listing.list_files(spark, dest_dir.rstrip("/") + "/**").isEmpty()
    except Exception as error:
        if "PATH_NOT_FOUND" not in str(error):
            raise
        taken = False
    if taken:
        raise FileExistsError(dest_dir)
    root = src_dir.rstrip("/")
    found = listing.list_files(spark, f"{root}/**")
    anchors = sharding.sharded(listing.match(found, f"{root}/**{audio_suffix}").select("path"), "path", num_files_per_shard, max_dataset_size)
    anchors = sharding.chunked(anchors, num_files_per_shard)
    wanted = anchors.select("shard", "chunk", F.explode(F.array(*[paths.output_path(F.col("path"), audio_suffix, s) for s in suffixes])).alias("src"))
    there = wanted.join(found.select(F.col("path").alias("src")), "src", "left_semi")
    pairs = there.select("shard", "chunk", "src", paths.shard_path(F.col("src"), root, dest_dir, F.col("shard"), min_shard_idx).alias("dst"))
    return sinks.copy_files(pairs.repartition("shard", "chunk"))


# The classifier heads that the job knows.
FEATURES = (
    "genre_discogs400", "mtg_jamendo_genre", "approachability", "danceability", "engagement", "mood_aggressive", "mood_happy", "mood_party",
    "mood_relaxed", "mood_sad", "mtg_jamendo_moodtheme", "mtg_jamendo_instrument", "mood_acoustic", "mood_electronic", "voice_instrumental",
    "timbre", "nsynth_instrument", "nsynth_reverb", "tonal_atonal", "mtg_jamendo_top50tags", "mtt", "audioset_yamnet", "tempo",
)


def classify(
    spark: SparkSession, src_dir: str, audio_suffix: str, heads: dict[str, Callable], embed: Callable,
    features: list[str] | None = None, overwrite: bool = False, known: tuple[str, ...] = FEATURES,
) -> DataFrame:
    """Several classifier heads on one decoded and embedded file; one .npy per feature beside the source.

    ``heads`` maps a feature to a function of the embedding, ``embed`` makes the embedding of mono audio once per file.
    The first head that fails ends its file; features made before it are written."""
    wanted = list(heads) if features is None else features
    if unknown := set(wanted) - set(known):
        raise ValueError(f"unknown features: {sorted(unknown)}")
    glob, rate = f"{src_dir.rstrip('/')}/**{audio_suffix}", infer.CONTRACTS["classifier"].rate
    todo = pending(spark, glob, audio_suffix, [f".{f}.npy" for f in wanted], overwrite)
    audio = signal.resampled(files.decode_audio(open_files(spark, glob, todo)), rate)

    def run(batches):
        import pyarrow as pa

        from ..sources.codecs import write_npy

        for b in batches:
            for path, signal_ in signal.rows_of(b, "path", "samples"):
                made = []
                try:
                    x = embed(signal_.mean(0), rate)
                    for f in wanted:
                        made.append((f, write_npy(np.asarray(heads[f](x), np.float32))))
                except Exception:
                    pass
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([path] * len(made), pa.string()), pa.array([f for f, _ in made], pa.string()),
                        pa.array([c for _, c in made], pa.binary()),
                    ],
                    names=["path", "feature", "content"],
                )

    found = audio.where("status = 'ok'").select("path", "samples").mapInArrow(run, "path string, feature string, content binary")
    return sinks.write_files(found.select(F.concat(paths.remove_suffix(F.col("path"), audio_suffix), F.lit("."), "feature", F.lit(".npy")).alias("out_path"), "content"))


def transcribe(
    spark: SparkSession, match_pattern: str, audio_suffix: str, factory: Callable, overwrite: bool = False,
    suffix: str = ".whisper.json",
) -> DataFrame:
    """Speech to text: {"lyrics": segments} beside each file; files without a segment give no output.

    ``factory`` makes a function of (audio, rate) that returns segments, or raises: the file is then left out."""
    if not match_pattern.endswith(audio_suffix):
        raise ValueError(f"the pattern must end with {audio_suffix}")
    todo = pending(spark, match_pattern, audio_suffix, [suffix], overwrite)

    def run(batches):
        import json

        import pyarrow as pa

        model = factory()
        for b in batches:
            for path, x, sr in signal.rows_of(b, "path", "samples", "sr"):
                try:
                    segments = model(x, sr)
                except Exception:
                    continue
                if segments:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([path]), pa.array([json.dumps({"lyrics": segments}).encode()], pa.binary())],
                        names=["path", "content"],
                    )

    found = files.decode_audio(open_files(spark, match_pattern, todo)).where("status = 'ok'").select("path", "sr", "samples").mapInArrow(run, "path string, content binary")
    return sinks.write_files(found.select(paths.output_path(F.col("path"), audio_suffix, suffix).alias("out_path"), "content"))


def embed_lyrics(spark: SparkSession, match_pattern: str, factory: Callable, overwrite: bool = False) -> DataFrame:
    """Byte-token embeddings of timed lyrics: .npz of embeds (dim x tokens), tokens, starts and ends."""
    rows = byte_features(spark, match_pattern, overwrite)

    def run(batches):
        import pyarrow as pa

        from ..sources.codecs import write_npz

        model = factory()
        for b in batches:
            for r in b.to_pylist():
                tokens = np.array(r["tokens"], np.int32)
                arrays_ = {
                    "embeds": np.asarray(model(tokens), np.float32), "tokens": tokens,
                    "starts": np.array(r["starts"], np.float32), "ends": np.array(r["ends"], np.float32),
                }
                if len({a.shape[-1] for a in arrays_.values()}) != 1:
                    raise ValueError("embeddings, tokens and times differ in length")
                yield pa.RecordBatch.from_arrays([pa.array([r["path"]]), pa.array([write_npz(arrays_)], pa.binary())], names=["path", "content"])

    found = rows.mapInArrow(run, "path string, content binary")
    return sinks.write_files(found.select(paths.output_path(F.col("path"), ".whisper.json", ".whisper-byt5.npz").alias("out_path"), "content"))


def byte_features(spark: SparkSession, match_pattern: str, overwrite: bool = False) -> DataFrame:
    """(path, tokens, starts, ends) of timed lyrics that have words left after the filler filter."""
    todo = pending(spark, match_pattern, ".whisper.json", [".whisper-byt5.npz"], overwrite)
    parsed = files.load_json(open_files(spark, match_pattern, todo), lyrics.LYRICS)
    parsed = parsed.select(lyrics.require_suffix(F.col("path")).alias("path"), "value")
    word = lyrics.words(parsed, "path", "value").withColumn("tokens", lyrics.byte_tokens(F.col("word")))
    order = F.array_sort(F.collect_list(F.struct("segment", "at", "tokens", "start", "end")))
    grouped = word.groupBy("path").agg(order.alias("w"))
    spread = lambda name: F.flatten(F.transform("w", lambda w: F.transform(w["tokens"], lambda _: w[name])))
    return grouped.select(
        "path", F.flatten(F.transform("w", lambda w: w["tokens"])).alias("tokens"), spread("start").alias("starts"),
        spread("end").alias("ends"),
    )


def training_set(
    tracks: DataFrame, key: str, required: dict[str, DataFrame], optional: dict, dest_dir: str | None = None,
    dims: dict[str, int] | None = None, length_of: str | None = None, min_duration: float = 20, frame_rate: float = 30,
) -> DataFrame:
    """Assemble features per track, validate, drop short ones; with dest_dir write them as shards."""
    rows = assemble.assemble(tracks.select(key).distinct(), key, required, optional)
    for name, dim in (dims or {}).items():
        rows = assemble.validate_dim(rows, name, dim)
    if length_of:
        rows = assemble.long_enough(rows, length_of, min_duration, frame_rate)
    if dest_dir:
        sinks.write_shards(rows, dest_dir)
    return rows
