"""Queries that go through files: what a table's rows are written to, listed, opened and decoded, against SQL on the table.

Files are made in a folder of their own below the session's shared folder (spark.checkpoint.dir; with a local master a
temporary folder does where that is unset)."""

from __future__ import annotations

import tempfile
import uuid
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions import arrays, paths
from ..operators import assemble, infer, listing, signal, stats
from ..sources import codecs, files, sinks
from . import jobs
from .catalog import E, per_sample, query, rounded, table


def scratch(spark: SparkSession) -> str:
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        root = Path(tempfile.mkdtemp(prefix="tesselake-")).as_uri()
        spark.conf.set("spark.checkpoint.dir", root)
    root = "/" + root[5:].lstrip("/") if root.startswith("file:") else root
    return f"{root.rstrip('/')}/files-{uuid.uuid4().hex}"


#: Rows of a table that files are made of hold a signal of 1 to 64 samples, of one channel, or (odd labels) two halves.
LENGTH = "(1 + vec_id % 64)"
RATE = "(CASE WHEN vec_id % 3 = 0 THEN 44100 WHEN vec_id % 3 = 1 THEN 48000 ELSE 16000 END)"


def rate() -> Column:
    k = F.col("vec_id") % 3
    return F.when(k == 0, 44100).when(k == 1, 48000).otherwise(16000)


def audio(spark: SparkSession, d: str, whole: bool = False) -> DataFrame:
    """Decoded audio made of the embeddings: mono signals of different lengths and rates; whole: two channels of 32 samples."""
    rows = table(spark, d, "embeddings")
    x = F.slice(E(), F.lit(1), (F.col("vec_id") % 64 + 1).cast("int")) if not whole else E()
    channels = F.array(F.slice(x, 1, 32), F.slice(x, 33, 32)) if whole else F.array(x)
    return rows.select(
        F.format_string("v%d.wav", "vec_id").alias("path"), F.lit("ok").alias("status"), F.lit(None).cast("string").alias("error"),
        (F.lit(16) if whole else rate()).cast("int").alias("sr"), F.size(channels).alias("n_channels"), F.size(channels[0]).cast("bigint").alias("n_samples"),
        channels.cast("array<array<float>>").alias("samples"),
    )


def vec_id() -> Column:
    return F.regexp_extract("path", r"v(\d+)\.", 1).cast("bigint").alias("vec_id")


def placed(rows: DataFrame, root: str, column: str = "out_path") -> DataFrame:
    return rows.withColumn(column, F.concat(F.lit(root + "/"), F.col("path")))


def wave_files(spark: SparkSession, d: str) -> str:
    """Each embedding as a WAV file; the folder."""
    root = scratch(spark)
    failed = sinks.write_files(sinks.encode_audio(placed(audio(spark, d), root), ".wav")).where("status <> 'ok'")
    if not failed.isEmpty():
        raise OSError(failed.first().error)
    return root


# --- files written, listed, opened and decoded ------------------------------------------------------------------------

@query("wav_round_trip", f"SELECT vec_id, (unnest(range({LENGTH})))::INTEGER AS pos, trunc(unnest(embedding[1:{LENGTH}])::DOUBLE * 32767)::INTEGER AS x FROM embeddings")
def wav_round_trip(spark, d):
    found = files.decode_audio(jobs.open_files(spark, f"{wave_files(spark, d)}/*.wav")).where("status = 'ok'")
    return found.select(vec_id(), F.posexplode(F.col("samples")[0]).alias("pos", "x")).select(
        "vec_id", "pos", F.round(F.col("x").cast("double") * 32767).cast("int").alias("x"),
    )


@query("wav_headers", f"SELECT {RATE}::INTEGER AS sr, count(*) AS n, round(sum({LENGTH} / {RATE}::DOUBLE), 6) AS seconds FROM embeddings GROUP BY 1")
def wav_headers(spark, d):
    found = files.audio_headers(jobs.open_files(spark, f"{wave_files(spark, d)}/*.wav", first=files.HEAD)).where("status = 'ok'")
    return found.groupBy("sr").agg(F.count("*").alias("n"), F.round(F.sum(F.col("n_samples") / F.col("sr")), 6).alias("seconds"))


@query("example_job", f"SELECT count(*) AS audio_count, 0::BIGINT AS failed_count, round(sum({LENGTH} / {RATE}::DOUBLE), 6) AS seconds FROM embeddings")
def example_job(spark, d):
    return jobs.example(spark, wave_files(spark, d)).select("audio_count", "failed_count", F.round("seconds", 6).alias("seconds"))


@query("decode_status", "SELECT CASE WHEN vec_id % 5 = 0 THEN 'failed' ELSE 'ok' END AS status, count(*) AS n FROM embeddings GROUP BY 1")
def decode_status(spark, d):
    made = sinks.encode_audio(audio(spark, d).withColumn("out_path", F.col("path")), ".wav").withColumnRenamed("out_path", "path")
    cut = F.expr("substring(content, 1, length(content) - 1)")
    broken = made.withColumn("content", F.when(vec_id() % 5 == 0, cut).otherwise(F.col("content")))
    return stats.counts(files.decode_audio(broken), "status", "status")


@query("transcode_pending", f"SELECT vec_id, ceil({LENGTH}::DOUBLE * 16000 / {RATE})::BIGINT AS n FROM embeddings WHERE vec_id % 2 = 1")
def transcode_pending(spark, d):
    root = wave_files(spark, d)
    done = table(spark, d, "embeddings").where("vec_id % 2 = 0").select(
        F.format_string(root + "/v%d.npy", "vec_id").alias("out_path"), F.lit(b"x").alias("content"),
    )
    sinks.write_files(done).write.format("noop").mode("overwrite").save()
    jobs.transcode(spark, root, ".wav", ".npy", 16000).write.format("noop").mode("overwrite").save()
    made = files.load_arrays(jobs.open_files(spark, f"{root}/*.npy")).where("status = 'ok'")  # not the stand-ins
    return made.select(vec_id(), F.col("shape")[1].cast("bigint").alias("n"))


@query("npy_round_trip", "SELECT vec_id, (unnest(range(64)))::INTEGER AS pos, unnest(embedding)::FLOAT AS x, 32 AS width FROM embeddings")
def npy_round_trip(spark, d):
    root = scratch(spark)
    sinks.write_files(sinks.encode_audio(placed(audio(spark, d, whole=True).withColumn("path", F.format_string("v%d.npy", vec_id())), root), ".npy")).write.format("noop").mode("overwrite").save()
    found = files.load_arrays(jobs.open_files(spark, f"{root}/*.npy"))
    return found.select(vec_id(), F.posexplode("data").alias("pos", "x"), F.col("shape")[1].alias("width"))


@query("npz_arrays", "SELECT vec_id, round(list_sum(list_transform(embedding, lambda x: x::DOUBLE)), 5) + 0.0 AS total FROM embeddings")
def npz_arrays(spark, d):
    def run(batches):
        for b in batches:
            made = [codecs.write_npz({"embeds": np.asarray(x, np.float32), "other": np.zeros(1)}) for x in b.column("embedding").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("path"), pa.array(made, pa.binary())], names=["path", "content"])

    rows = table(spark, d, "embeddings").select(
        F.format_string("v%d.npz", "vec_id").alias("path"), "embedding",
    ).mapInArrow(run, "path string, content binary")
    total = F.aggregate("data", F.lit(0.0), lambda a, x: a + x.cast("double"))
    return files.load_arrays(rows, "embeds").select(vec_id(), (F.round(total, 5) + 0.0).alias("total"))


@query("json_files", "SELECT doc_id, quality::INTEGER AS quality, toxic::INTEGER AS toxic FROM labels")
def json_files(spark, d):
    root = scratch(spark)
    rows = table(spark, d, "labels").select(
        F.format_string(root + "/%d.meta.json", "doc_id").alias("out_path"),
        F.to_json(F.struct("doc_id", "quality", "toxic")).cast("binary").alias("content"),
    )
    sinks.write_files(rows).write.format("noop").mode("overwrite").save()
    return files.load_json(jobs.open_files(spark, f"{root}/*.json"), "doc_id bigint, quality int, toxic int").select("value.*")


@query("features_by_extension", "SELECT CASE doc_id % 3 WHEN 0 THEN 'json' WHEN 1 THEN 'npy' ELSE 'missing' END AS kind, CASE doc_id % 3 WHEN 2 THEN 'failed' ELSE 'ok' END AS status, count(*) AS n FROM labels GROUP BY 1, 2")
def features_by_extension(spark, d):
    root, k = scratch(spark), F.col("doc_id") % 3
    npy = codecs.write_npy(np.ones(3, np.float32))
    name = F.concat(F.lit(root + "/"), F.col("doc_id").cast("string"), F.when(k == 0, ".json").when(k == 1, ".npy").otherwise(".missing"))
    rows = table(spark, d, "labels").select(name.alias("out_path"), F.when(k == 0, F.lit(b"{}")).otherwise(F.lit(npy)).alias("content"))
    sinks.write_files(rows.where(~F.col("out_path").endswith(".missing"))).write.format("noop").mode("overwrite").save()
    found = files.load_features(files.contents(rows.select(F.col("out_path").alias("path"))))
    return found.groupBy(paths.wds_ext(F.col("path")).alias("kind"), "status").agg(F.count("*").alias("n"))


@query("manifest_files", "SELECT doc_id FROM labels WHERE doc_id % 4 = 0")
def manifest_files(spark, d):
    root = scratch(spark)
    rows = table(spark, d, "labels").where("doc_id % 2 = 0").select(
        F.format_string(root + "/files/%d.txt", "doc_id").alias("out_path"), F.lit(b"x").alias("content"),
    )
    sinks.write_files(rows).write.format("noop").mode("overwrite").save()
    # a manifest of groups, with names of files that aren't there; one file that is as large as its list
    listed = table(spark, d, "labels").where("doc_id % 4 = 0 or doc_id % 2 = 1").select(
        (F.col("doc_id") % 7).cast("string").alias("g"), F.format_string("%d.txt", "doc_id").alias("name"),
    )
    whole = listed.groupBy("g").agg(F.collect_list("name").alias("names")).agg(F.to_json(F.map_from_entries(F.collect_list(F.struct("g", "names")))).alias("m"))
    sinks.write_files(whole.select(F.lit(f"{root}/m.json").alias("out_path"), F.col("m").cast("binary").alias("content"))).write.format("noop").mode("overwrite").save()
    found = files.manifest_files(spark, f"{root}/m.json", f"{root}/files")
    return found.select(paths.file_stem(F.col("path")).cast("bigint").alias("doc_id"))


@query("typed_shards", "SELECT vec_id, label, embedding FROM embeddings")
def typed_shards(spark, d):
    root = scratch(spark)
    sinks.write_shards(table(spark, d, "embeddings").select("vec_id", "label", "embedding"), root, 1 << 20)
    return sinks.read_shards(spark, root)


@query("copied_files", "SELECT doc_id, CASE doc_id % 3 WHEN 0 THEN 'failed' ELSE 'ok' END AS status FROM labels")
def copied_files(spark, d):
    root, labels = scratch(spark), table(spark, d, "labels")
    rows = labels.where("doc_id % 3 <> 0").select(
        F.format_string(root + "/a/%d.txt", "doc_id").alias("out_path"),
        F.col("doc_id").cast("string").cast("binary").alias("content"),
    )
    sinks.write_files(rows).write.format("noop").mode("overwrite").save()
    pairs = labels.select(F.format_string(root + "/a/%d.txt", "doc_id").alias("src"), F.format_string(root + "/b/%d.txt", "doc_id").alias("dst"))
    done = sinks.copy_files(pairs)
    return done.select(paths.file_stem(F.col("dst")).cast("bigint").alias("doc_id"), "status")


# --- operators on decoded audio ---------------------------------------------------------------------------------------

HALF = "list_transform(range(32), lambda i: round(({}), 5) + 0.0)"


def samples_of(name: str, sql: str, change, channel: int = 0):
    @query(name, f"SELECT vec_id, (unnest(range(len(a))))::INTEGER AS pos, unnest(a) AS x FROM (SELECT vec_id, {sql} AS a FROM embeddings)")
    def run(spark, d):
        found = signal.map_audio(audio(spark, d, whole=True), change)
        return found.select(vec_id(), F.posexplode(F.col("samples")[channel]).alias("pos", "x")).select(
            "vec_id", "pos", (F.round(F.col("x").cast("double"), 5) + 0.0).alias("x"),
        )


samples_of("to_mono", HALF.format("(embedding[i + 1]::FLOAT + embedding[i + 33]::FLOAT)::DOUBLE / 2"), lambda _, x, sr: (codecs.convert(x, sr, sr, 1), sr))
samples_of("to_stereo", HALF.format("embedding[i + 1]::DOUBLE"), lambda _, x, sr: (codecs.convert(x[:1], sr, sr, 2), sr), channel=1)


@query("resample_len", f"SELECT vec_id, ceil({LENGTH}::DOUBLE * 16000 / {RATE})::BIGINT AS n FROM embeddings")
def resample_len(spark, d):
    return signal.resampled(audio(spark, d), 16000).select(vec_id(), F.col("n_samples").alias("n"))


@query("crop_gt", f"SELECT vec_id, (CASE WHEN {LENGTH} > 40 THEN 40 ELSE {LENGTH} END)::INTEGER AS n FROM embeddings")
def crop_gt(spark, d):
    return audio(spark, d).select(vec_id(), F.size(arrays.crop_longer(F.col("samples")[0], F.lit(16), 2.5)).alias("n"))


@query("crop_or_skip", f"SELECT vec_id, (unnest(range(20)))::INTEGER AS pos, unnest(embedding[vec_id % 24 + 1:vec_id % 24 + 20]) AS x FROM embeddings WHERE {LENGTH} > 44")
def crop_or_skip(spark, d):
    cropped = F.when(F.size(F.col("samples")[0]) > 44, arrays.crop_at(F.col("samples")[0], (vec_id() % 24).cast("int"), 20))
    return audio(spark, d).select(vec_id(), F.posexplode(cropped).alias("pos", "x"))


@query("audio_stats", f"SELECT vec_id, round({LENGTH} / {RATE}::DOUBLE, 9) AS duration, 'mono' AS kind FROM embeddings UNION ALL SELECT vec_id, 2.0, 'stereo' FROM embeddings")
def audio_stats(spark, d):
    both = audio(spark, d).unionByName(audio(spark, d, whole=True))
    return both.select(
        vec_id(), F.round(F.col("n_samples") / F.col("sr"), 9).alias("duration"),
        stats.channel_kind(F.col("n_channels")).alias("kind"),
    )


@query("model_features", "SELECT vec_id, (c * 4 + f)::INTEGER AS pos, round(cos(c) * list_avg(list_transform(range(f * 8, f * 8 + 8), lambda i: abs(embedding[i + 1] + embedding[i + 33])::DOUBLE / 2)), 4) + 0.0 AS x FROM embeddings, (SELECT unnest(range(3)) AS c), (SELECT unnest(range(4)) AS f)")
def model_features(spark, d):
    contract = infer.Contract("energies", ".energies.npy", 16, 2, mono=True)
    found = infer.infer(audio(spark, d, whole=True), lambda: infer.dummy(3, 2), contract).where("status = 'ok'")
    return found.select(vec_id(), F.posexplode("data").alias("pos", "x")).select(
        "vec_id", "pos", (F.round(F.col("x").cast("double"), 4) + 0.0).alias("x"),
    )


@query("contract_failures", f"SELECT CASE WHEN {RATE} = 44100 THEN 'ok' ELSE 'failed' END AS status, count(*) AS n FROM embeddings GROUP BY 1")
def contract_failures(spark, d):
    return stats.counts(infer.infer(audio(spark, d), lambda: infer.dummy(1, 1000), infer.Contract("m", ".m.npy", 44100, 1)), "status", "status")


@query("stems_in_one_pass", "SELECT vec_id, kind, round(list_sum(list_transform(embedding[1:32], lambda x: x::DOUBLE)) * f, 4) + 0.0 AS total FROM embeddings, (VALUES ('half', 0.5), ('whole', 1.0)) v(kind, f)")
def stems_in_one_pass(spark, d):
    found = signal.spread_audio(audio(spark, d, whole=True), lambda: lambda _, x, sr: {"half": (x * 0.5, sr), "whole": (x, sr)})
    total = F.aggregate(F.col("samples")[0], F.lit(0.0), lambda a, x: a + x.cast("double"))
    return found.select(vec_id(), "kind", (F.round(total, 4) + 0.0).alias("total"))


# --- assembly and columns ----------------------------------------------------------------------------------------------

@query("process_counters", "SELECT count(*) FILTER (WHERE event_type <> 'error') AS success, count(*) FILTER (WHERE event_type = 'error') AS error FROM events")
def process_counters(spark, d):
    rows, seen = assemble.counted(table(spark, d, "events"), lambda: F.col("event_type") != "error")
    rows.select("event_id").write.format("noop").mode("overwrite").save()  # counters are filled as the rows pass
    found = seen.get
    return spark.createDataFrame([(found["success"], found["error"])], "success bigint, error bigint")


@query("cogroup_filter", "SELECT d.stem, d.doc_id FROM (SELECT doc_id // 3 AS stem, min(doc_id) AS doc_id FROM documents GROUP BY 1) d JOIN (SELECT doc_id // 3 AS stem, min(quality = 1) AS flag FROM labels GROUP BY 1) f USING (stem) WHERE flag")
def cogroup_filter(spark, d):
    stem = F.expr("doc_id div 3").alias("stem")
    docs = table(spark, d, "documents").select(stem, "doc_id")
    flags = table(spark, d, "labels").select(stem, (F.col("quality") == 1).alias("flag"))
    return assemble.first_by_stem(docs, flags, "stem", "flag", "doc_id")


MEANS = "list_transform(range(8), lambda c: (list_sum(list_transform(range(8), lambda f: embedding[c * 8 + f + 1]::DOUBLE)) / 8)::FLOAT)"


@query("is_music", f"SELECT vec_id, list_position(m, list_max(m)) - 1 = 3 AND list_max(m) >= 0.02::FLOAT AS is_music FROM (SELECT vec_id, {MEANS} AS m FROM embeddings)")
def is_music(spark, d):
    rows = F.transform(F.sequence(F.lit(0), F.lit(7)), lambda c: F.slice(E(), c * 8 + 1, F.lit(8)))
    means = F.transform(rows, lambda r: arrays.mean_std(r)[0].cast("float"))
    return table(spark, d, "embeddings").withColumn("m", means).select("vec_id", arrays.is_music(F.col("m"), 3, 0.02).alias("is_music"))


per_sample("fade_curves", "list_transform(range(64), lambda i: round(embedding[i + 1]::DOUBLE * (CASE WHEN i < 8 THEN i / 7.0::DOUBLE WHEN i >= 56 THEN (63 - i) / 7.0::DOUBLE ELSE 1.0::DOUBLE END), 6) + 0.0)", lambda: rounded(arrays.faded(E(), 8)))
per_sample("downmix_four", "list_transform(range(16), lambda i: round((embedding[i + 1]::DOUBLE + embedding[i + 17]::DOUBLE + embedding[i + 33]::DOUBLE + embedding[i + 49]::DOUBLE) / 4, 6) + 0.0)", lambda: rounded(arrays.downmix(*[F.slice(E(), 1 + 16 * k, 16) for k in range(4)])))

DIFF = "list_transform(range(32), lambda i: abs(embedding[i + 1]::DOUBLE - embedding[i + 33]::DOUBLE))"


@query("difference_totals", f"SELECT vec_id, round(list_max(a), 6) AS largest, round(list_sum(a), 6) AS total, round(list_avg(a), 6) AS average FROM (SELECT vec_id, {DIFF} AS a FROM embeddings)")
def difference_totals(spark, d):
    found = arrays.difference_totals(F.slice(E(), 1, 32), F.slice(E(), 33, 32))
    return table(spark, d, "embeddings").select("vec_id", found.alias("t")).select(
        "vec_id", *[F.round(F.col(f"t.{c}"), 6).alias(c) for c in ("largest", "total", "average")],
    )


@query("stratified_by_part", "SELECT genre, doc_id FROM (SELECT g AS genre, doc_id, row_number() OVER (PARTITION BY g ORDER BY md5(doc_id::VARCHAR || ':42'), doc_id) AS r FROM documents, (SELECT source AS g FROM documents GROUP BY 1 ORDER BY count(*) DESC, source LIMIT 10) WHERE contains(lang || '---' || source, g)) WHERE r <= 10")
def stratified_by_part(spark, d):
    docs = table(spark, d, "documents").select("doc_id", "source", F.concat_ws("---", "lang", "source").alias("genres"))
    genres = [r.source for r in stats.top(docs, "source", 10).collect()]
    return stats.stratified_by_part(docs, "genres", genres, "doc_id", 10).select("genre", "doc_id")


@query("required_match", "SELECT count(*) AS n FROM labels")
def required_match(spark, d):
    root = wave_of_labels(spark, d)
    return listing.require(listing.list_files(spark, f"{root}/*.txt"), "*.txt").agg(F.count("*").alias("n"))


def dealt(spark: SparkSession, rows: DataFrame) -> DataFrame:
    return listing.rebalance(rows, int(spark.conf.get("spark.sql.shuffle.partitions")))


def wave_of_labels(spark: SparkSession, d: str) -> str:
    root = scratch(spark)
    rows = table(spark, d, "labels").select(F.format_string(root + "/%d.txt", "doc_id").alias("out_path"), F.lit(b"x").alias("content"))
    sinks.write_files(dealt(spark, rows)).write.format("noop").mode("overwrite").save()
    return root


@query("stream_new", "SELECT doc_id FROM labels WHERE toxic = 0 OR toxic IS NULL")
def stream_new(spark, d):
    from ..streaming.incremental import process_new

    source, target = wave_of_labels(spark, d), scratch(spark)
    done = table(spark, d, "labels").where("toxic <> 0").select(
        F.format_string(target + "/%d.npy", "doc_id").alias("out_path"), F.lit(b"x").alias("content"),
    )
    sinks.write_files(dealt(spark, done.unionByName(spark.createDataFrame([(f"{target}/none.npy", b"x")], done.schema)))).write.format("noop").mode("overwrite").save()
    out = scratch(spark)
    process_new(spark, f"{source}/*.txt", f"{target}/**", ".txt", [".npy"], lambda df: df.select("path").write.mode("append").parquet(out), f"{out}-state", source_dir=source, target_dir=target, content=False).awaitTermination()
    return spark.read.schema("path string").parquet(out).select(paths.file_stem(F.col("path")).cast("bigint").alias("doc_id"))
