"""Registry of the queries for the engine's operators, over the driver's tables, and their DuckDB counterparts.

The tables stand for the engine's inputs: pages for file listings, documents and labels for sources and features,
embeddings for probabilities and signals, events for decoded-file statistics, conversations for lyrics.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions import arrays, lyrics, paths
from ..operators import assemble, framing, incremental, listing, sharding, stats

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(f):
        QUERIES[name] = f
        if sql:
            ORACLES[name] = sql
        return f

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# --- paths, on a listing made of pages -----------------------------------------------------------------------------

def listed(spark: SparkSession, d: str) -> DataFrame:
    clean = F.regexp_replace(F.regexp_replace("url", "[?#].*$", ""), "/+$", "")
    root = F.regexp_replace(clean, "^https?://", "/lake/")
    return table(spark, d, "pages").select(
        "page_id",
        F.concat(root, F.lit("."), (F.col("page_id") % 10).cast("string"), F.lit(".source.wav")).alias("path"),
    )


FILES = "(SELECT page_id, regexp_replace(regexp_replace(regexp_replace(url, '[?#].*$', ''), '/+$', ''), '^https?://', '/lake/') || '.' || (page_id % 10)::VARCHAR || '.source.wav' AS path FROM pages) f"
NAME = "split_part(path, '/', -1)"


def P() -> Column:
    return F.col("path")


@query("match_glob", f"SELECT page_id, path FROM {FILES} WHERE regexp_matches(path, '^/lake/.*/en/4[^/]*\\.wav$')")
def match_glob(spark, d):
    return listing.match(listed(spark, d), "/lake/**/en/4*.wav")


@query("match_multi", f"SELECT page_id, path, g AS glob FROM {FILES}, (VALUES ('/lake/**/en/*.wav', '^/lake/.*/en/[^/]*\\.wav$'), ('/lake/**/?[0-4]*.wav', '^/lake/.*/[^/][0-4][^/]*\\.wav$')) p(g, r) WHERE regexp_matches(path, r)")
def match_multi(spark, d):
    return listing.match_all(listed(spark, d), ["/lake/**/en/*.wav", "/lake/**/?[0-4]*.wav"])


@query("reshuffle_noop", f"SELECT page_id, path FROM {FILES}")
def reshuffle_noop(spark, d):
    return listing.rebalance(listed(spark, d), 8)


def projected(name: str, sql: str, column: Callable[[], Column], out: str = "result"):
    @query(name, f"SELECT page_id, {sql} AS {out} FROM {FILES}")
    def run(spark, d):
        return listed(spark, d).select("page_id", column().alias(out))


projected("remove_suffix", "CASE WHEN ends_with(path, '.source.wav') THEN left(path, length(path) - 11) ELSE path END", lambda: paths.remove_suffix(P(), ".source.wav"))
projected("remove_suffix_pattern", "CASE WHEN regexp_extract(path, '\\.[0-4]\\.source\\.wav') <> '' THEN left(path, length(path) - length(regexp_extract(path, '\\.[0-4]\\.source\\.wav'))) ELSE path END", lambda: paths.remove_suffix_pattern(P(), r"\.[0-4]\.source\.wav"))
projected("path_move", "'s3://other/' || substr(path, 7)", lambda: paths.move(P(), "/lake/", "s3://other/"))
projected("file_stem", f"split_part({NAME}, '.', 1)", lambda: paths.file_stem(P()))
projected("dir_name", "split_part(path, '/', -2)", lambda: paths.dir_name(P()))
projected("increment_index", "regexp_replace(path, '/[^/]*$', '') || '/' || regexp_extract(" + NAME + ", '^(.*?\\.)\\d+\\.', 1) || (CAST(regexp_extract(" + NAME + ", '\\.(\\d+)\\.', 1) AS BIGINT) + 4)::VARCHAR || '.' || regexp_extract(" + NAME + ", '^.*?\\.\\d+\\.(.*)$', 1)", lambda: paths.increment_index(P()))


@query("wds_id_ext", f"SELECT page_id, regexp_replace(path, '/[^/]*$', '') || '/' || split_part({NAME}, '.', 1) AS id, regexp_extract({NAME}, '^[^.]*\\.(.*)$', 1) AS ext FROM {FILES}")
def wds_id_ext(spark, d):
    return listed(spark, d).select("page_id", paths.wds_id(P()).alias("id"), paths.wds_ext(P()).alias("ext"))


@query("uri_parse", "SELECT page_id, regexp_extract(url, '^[a-z0-9]+://([^/]*)', 1) AS bucket, regexp_extract(url, '^[a-z0-9]+://[^/]*/(.*)$', 1) AS key FROM pages")
def uri_parse(spark, d):
    bucket, key = paths.uri_parts(F.col("url"))
    return table(spark, d, "pages").select("page_id", bucket.alias("bucket"), key.alias("key"))


@query("list_tracks", f"SELECT DISTINCT 'shard-' || (page_id % 4)::VARCHAR || '/' || split_part({NAME}, '.', 1) AS subdir FROM {FILES}")
def list_tracks(spark, d):
    from ..sources.files import track_directories

    shards = F.concat(F.lit("/root/shard-"), (F.col("page_id") % 4).cast("string"), F.lit("/"), paths.file_stem(P()), F.lit("/audio.wav"))
    return track_directories(listed(spark, d).select(shards.alias("path")), "/root")


@query("stem_paths", f"SELECT page_id, left(path, length(path) - 11) || '.' || s || '.wav' AS out_path FROM {FILES}, (VALUES ('vocals'), ('drums'), ('bass'), ('other')) v(s)")
def stem_paths(spark, d):
    stems = F.array(*map(F.lit, ("vocals", "drums", "bass", "other")))
    return listed(spark, d).withColumn("stem", F.explode(stems)).select(
        "page_id",
        F.concat(paths.remove_suffix(P(), ".source.wav"), F.lit("."), "stem", F.lit(".wav")).alias("out_path"),
    )


@query("feature_paths", f"SELECT page_id, left(path, length(path) - 4) || s AS out_path FROM {FILES}, (VALUES ('.tempo.npy'), ('.embedding-v1.npy'), ('.whisper.json')) v(s)")
def feature_paths(spark, d):
    made = F.array(*[paths.output_path(P(), ".wav", s) for s in (".tempo.npy", ".embedding-v1.npy", ".whisper.json")])
    return listed(spark, d).select("page_id", F.explode(made).alias("out_path"))


# --- incremental processing and assembly ---------------------------------------------------------------------------

T0, T1 = "TIMESTAMP '2024-01-01 00:00:00'", "TIMESTAMP '2024-02-01 00:00:00'"


def sources(spark, d):
    return table(spark, d, "documents").select(F.format_string("/src/%d.txt", "doc_id").alias("path"), F.expr(T0).alias("modificationTime"))


def targets(spark, d):
    return table(spark, d, "labels").select(F.format_string("/dst/%d.label", "doc_id").alias("path"), F.expr(T1).alias("modificationTime"))


@query("skip_completed", "SELECT '/src/' || doc_id::VARCHAR || '.txt' AS path FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def skip_completed(spark, d):
    return incremental.skip_completed(sources(spark, d), targets(spark, d), ".txt", ".label", "/src", "/dst").select("path")


@query("skip_completed_ts", "SELECT o_orderkey FROM orders o LEFT JOIN (SELECT l_orderkey, min(l_shipdate) AS made FROM lineitem GROUP BY 1) l ON l_orderkey = o_orderkey WHERE made IS NULL OR made < o_orderdate")
def skip_completed_ts(spark, d):
    files = table(spark, d, "orders").select(
        "o_orderkey", F.concat(F.col("o_orderkey").cast("string"), F.lit(".src")).alias("path"),
        F.col("o_orderdate").alias("modificationTime"),
    )
    made = table(spark, d, "lineitem").select(
        F.concat(F.col("l_orderkey").cast("string"), F.lit(".dst")).alias("path"),
        F.col("l_shipdate").alias("modificationTime"),
    )
    return incremental.skip_completed(files, made, ".src", ".dst", check_timestamp=True).select("o_orderkey")


@query("skip_completed_shifted", f"SELECT page_id FROM {FILES} WHERE page_id % 10 NOT IN (4, 5, 6)")
def skip_completed_shifted(spark, d):
    files = listed(spark, d).withColumn("modificationTime", F.expr(T0))
    made = files.where((F.col("page_id") % 10).isin(4, 5, 6)).select(
        F.regexp_replace(paths.increment_index(P(), 4), r"\.source\.wav$", ".vocals.wav").alias("path"),
        "modificationTime",
    )
    return incremental.skip_completed(files, made, "source.wav", "vocals.wav", shift=4).select("page_id")


@query("vocal_filter", "SELECT doc_id, source FROM documents WHERE doc_id IN (SELECT doc_id FROM labels WHERE quality = 1)")
def vocal_filter(spark, d):
    return assemble.vocal_filter(table(spark, d, "documents"), table(spark, d, "labels"), "doc_id", F.col("quality") == 1).select("doc_id", "source")


@query("assemble_features", "SELECT d.doc_id, d.n_chars AS size, coalesce(l.toxic, -1)::INTEGER AS toxic, coalesce(l.quality, -1)::INTEGER AS quality FROM documents d LEFT JOIN labels l USING (doc_id)")
def assemble_features(spark, d):
    docs, labels = table(spark, d, "documents"), table(spark, d, "labels")
    one = lambda name: (labels.select("doc_id", F.col(name).alias("value")), F.lit(-1))
    return assemble.assemble(
        docs.select("doc_id"), "doc_id", {"size": docs.select("doc_id", F.col("n_chars").alias("value"))},
        {"toxic": one("toxic"), "quality": one("quality")},
    )


@query("track_metadata", "SELECT d.doc_id, d.lang || '---' || d.source AS genre, d.lang AS super_genre, l.quality = 1 AS is_music, coalesce(e.value, -1.0) AS duration FROM documents d JOIN labels l USING (doc_id) LEFT JOIN events e ON e.event_id = d.doc_id AND e.event_type <> 'error'")
def track_metadata(spark, d):
    docs, labels = table(spark, d, "documents"), table(spark, d, "labels")
    genre = docs.select("doc_id", F.concat_ws("---", "lang", "source").alias("value"))
    music = labels.select("doc_id", (F.col("quality") == 1).alias("value"))
    length = table(spark, d, "events").where("event_type <> 'error'").select(F.col("event_id").alias("doc_id"), "value")
    out = assemble.assemble(docs.select("doc_id"), "doc_id", {"genre": genre, "is_music": music}, {"duration": (length, F.lit(-1.0))})
    return out.select("doc_id", "genre", arrays.super_genre(F.col("genre")).alias("super_genre"), "is_music", "duration")


@query("filter_length", "SELECT vec_id FROM embeddings WHERE len(list_filter(embedding, lambda x: x > 0)) >= ceil(1.05 * 30)")
def filter_length(spark, d):
    rows = table(spark, d, "embeddings").select("vec_id", F.filter("embedding", lambda x: x > 0).alias("x"))
    return assemble.long_enough(rows, "x", 1.05, 30).select("vec_id")


# --- statistics ----------------------------------------------------------------------------------------------------

def decoded(spark, d):
    return table(spark, d, "events").withColumnRenamed("value", "duration")


@query("dataset_stats", "SELECT event_type AS kind, count(*) AS n, round(sum(value), 4) AS seconds, round(sum(value) / 3600, 6) AS hours FROM events GROUP BY 1")
def dataset_stats(spark, d):
    total = F.sum("duration")
    return decoded(spark, d).groupBy(F.col("event_type").alias("kind")).agg(
        F.count("*").alias("n"), F.round(total, 4).alias("seconds"), F.round(total / 3600, 6).alias("hours"),
    )


@query("total_duration", "SELECT round(coalesce(sum(value), 0), 4) AS seconds, round(coalesce(sum(value), 0) / 3600, 6) AS hours FROM events WHERE event_type <> 'error'")
def total_duration(spark, d):
    total = F.coalesce(F.sum("duration"), F.lit(0.0))
    return decoded(spark, d).where("event_type <> 'error'").agg(F.round(total, 4).alias("seconds"), F.round(total / 3600, 6).alias("hours"))


@query("total_count", "SELECT count(*) AS total_count FROM events")
def total_count(spark, d):
    return decoded(spark, d).agg(F.count("*").alias("total_count"))


@query("failed_count", "SELECT count(*) FILTER (WHERE event_type = 'error') AS failed_count FROM events")
def failed_count(spark, d):
    return decoded(spark, d).agg(F.count_if(F.col("event_type") == "error").alias("failed_count"))


@query("stereo_counts", "SELECT CASE WHEN user_id % 4 = 2 THEN 'stereo' ELSE 'mono' END AS kind, count(*) AS n FROM events GROUP BY 1")
def stereo_counts(spark, d):
    return stats.counts(decoded(spark, d), stats.channel_kind(F.col("user_id") % 4), "kind")


@query("distinct_sr", "SELECT DISTINCT (CASE user_id % 3 WHEN 0 THEN 44100 WHEN 1 THEN 48000 ELSE 16000 END)::INTEGER AS sr FROM events")
def distinct_sr(spark, d):
    k = F.col("user_id") % 3
    return decoded(spark, d).select(F.when(k == 0, 44100).when(k == 1, 48000).otherwise(16000).alias("sr")).distinct()


@query("duration_hist", "SELECT least(floor((value - lo) / ((hi - lo) / 100)), 99)::INTEGER AS bin, count(*) AS n FROM events, (SELECT min(value) AS lo, max(value) AS hi FROM events) GROUP BY 1")
def duration_hist(spark, d):
    return stats.histogram(decoded(spark, d), "duration", 100)


@query("top_genres", "SELECT source, count(*) AS n FROM documents GROUP BY 1 ORDER BY n DESC, source LIMIT 20")
def top_genres(spark, d):
    return stats.top(table(spark, d, "documents"), "source", 20)


@query("genre_counts", "SELECT genre, count(*) AS n FROM (SELECT unnest([lang, source]) AS genre FROM documents) GROUP BY 1")
def genre_counts(spark, d):
    return stats.counts(table(spark, d, "documents").select(F.explode(F.array("lang", "source")).alias("genre")), "genre", "genre")


@query("json_extract", "SELECT CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, count(*) AS n FROM events GROUP BY 1")
def json_extract(spark, d):
    parsed = F.from_json("props", "k bigint")["k"]
    return stats.counts(table(spark, d, "events"), parsed, "k")


STRATA = "SELECT doc_id, source FROM (SELECT doc_id, source, row_number() OVER (PARTITION BY source ORDER BY md5(doc_id::VARCHAR || ':42'), doc_id) AS r FROM documents WHERE source IN (SELECT source FROM documents GROUP BY 1 ORDER BY count(*) DESC, source LIMIT 10)) WHERE r <= 10"


@query("stratified_sample", STRATA)
def stratified_sample(spark, d):
    return stats.stratified(table(spark, d, "documents").select("doc_id", "source"), "source", "doc_id", 10, 10).select("doc_id", "source")


@query("random_limit", "SELECT doc_id FROM documents ORDER BY md5(doc_id::VARCHAR || ':42'), doc_id LIMIT 50")
def random_limit(spark, d):
    return stats.sample(table(spark, d, "documents").select("doc_id"), "doc_id", 50)


@query("sample_archive", f"SELECT doc_id, n_chars FROM documents WHERE doc_id IN (SELECT doc_id FROM ({STRATA}))")
def sample_archive(spark, d):
    docs = table(spark, d, "documents")
    return docs.select("doc_id", "n_chars").join(stratified_sample(spark, d).select("doc_id"), "doc_id", "left_semi")


@query("super_genre", "SELECT split_part(lang || '---' || source, '---', 1) AS super_genre, count(*) AS n FROM documents GROUP BY 1")
def super_genre(spark, d):
    return stats.counts(table(spark, d, "documents"), arrays.super_genre(F.concat_ws("---", "lang", "source")), "super_genre")


# --- numbering and shards ------------------------------------------------------------------------------------------

@query("enumerate", "SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 + 5 AS idx FROM documents")
def enumerate_(spark, d):
    return sharding.enumerated(table(spark, d, "documents").select("doc_id"), "doc_id", 5)


@query("limit_first_n", "SELECT doc_id FROM documents ORDER BY doc_id LIMIT 137")
def limit_first_n(spark, d):
    return table(spark, d, "documents").select("doc_id").orderBy("doc_id").limit(137)


NUMBERED = "(SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS idx FROM documents)"


@query("shard_assign", f"SELECT doc_id, idx, idx // 300 AS shard FROM {NUMBERED}")
def shard_assign(spark, d):
    return sharding.sharded(table(spark, d, "documents").select("doc_id"), "doc_id", 300)


@query("shard_chunks", f"SELECT shard, chunk, count(*) AS n FROM (SELECT idx // 300 AS shard, (idx % 300) // 100 AS chunk FROM {NUMBERED}) GROUP BY 1, 2")
def shard_chunks(spark, d):
    rows = sharding.chunked(sharding.sharded(table(spark, d, "documents").select("doc_id"), "doc_id", 300), 300, 100)
    return rows.groupBy("shard", "chunk").agg(F.count("*").alias("n"))


@query("shard_paths", f"SELECT page_id, '/out/shard-' || lpad((page_id // 100)::VARCHAR, 4, '0') || '/' || regexp_replace(substr(path, 7), '(\\.[^./]+)$', '.source\\1') AS dst FROM {FILES}")
def shard_paths(spark, d):
    return listed(spark, d).select("page_id", paths.shard_path(P(), "/lake", "/out", F.floor(F.col("page_id") / 100)).alias("dst"))


# --- arrays and signals, on embeddings -----------------------------------------------------------------------------


def E() -> Column:
    return F.col("embedding")


def voted(name: str, sql: str, column: Callable[[], Column], out: str):
    @query(name, f"SELECT vec_id, {sql} AS {out} FROM embeddings")
    def run(spark, d):
        return table(spark, d, "embeddings").select("vec_id", column().alias(out))


VOTE = "len(list_filter({x}, lambda x: NOT isnan(x) AND x > 0.1::FLOAT)) / len({x})::DOUBLE >= 0.25"
voted("majority_vote", VOTE.format(x="embedding"), lambda: arrays.majority_vote(E(), 0.1, 0.25), "keep")
voted("is_vocal", VOTE.format(x="embedding[33:64]"), lambda: arrays.majority_vote(F.slice(E(), 33, 32), 0.1, 0.25), "is_vocal")
voted("is_vocal_row0", VOTE.format(x="embedding[1:32]"), lambda: arrays.majority_vote(F.slice(E(), 1, 32), 0.1, 0.25), "is_vocal")
voted("genre_argmax", "(list_position(embedding, list_max(embedding)) - 1)::INTEGER", lambda: arrays.first_largest(E()), "genre")


@query("music_counts", "SELECT list_max(embedding) >= 0.3::FLOAT AS is_music, count(*) AS n FROM embeddings GROUP BY 1")
def music_counts(spark, d):
    return stats.counts(table(spark, d, "embeddings"), F.array_max(E()) >= F.lit(0.3).cast("float"), "is_music")


@query("genre_multilabel", "SELECT vec_id, (unnest(list_filter(range(64), lambda i: embedding[i + 1] > 0.25::FLOAT)))::INTEGER AS genre FROM embeddings")
def genre_multilabel(spark, d):
    return table(spark, d, "embeddings").select("vec_id", F.explode(arrays.above(E(), 0.25)).alias("genre"))


def per_sample(name: str, sql: str, column: Callable[[], Column], out: str = "x"):
    """Results that are arrays, one row per place."""

    @query(name, f"SELECT vec_id, (unnest(range(len(a))))::INTEGER AS pos, unnest(a) AS {out} FROM (SELECT vec_id, {sql} AS a FROM embeddings)")
    def run(spark, d):
        return table(spark, d, "embeddings").select("vec_id", F.posexplode(column()).alias("pos", out))


HALVES = "list_transform(range(32), lambda i: {})"
rounded = lambda a: F.transform(a, lambda x: F.round(x, 6))


def L() -> Column:
    return F.slice(E(), 1, 32)


def R() -> Column:
    return F.slice(E(), 33, 32)


per_sample("downmix", HALVES.format("round((embedding[i + 1]::DOUBLE + embedding[i + 33]::DOUBLE) / 2, 6) + 0.0"), lambda: rounded(arrays.downmix(L(), R())))
per_sample("mux_stems", "list_transform(range(16), lambda i: round(embedding[i + 1]::DOUBLE + embedding[i + 17]::DOUBLE + embedding[i + 33]::DOUBLE, 6) + 0.0)", lambda: rounded(arrays.added(*[F.slice(E(), 1 + 16 * k, 16).cast("array<double>") for k in range(3)])))
per_sample("interleave", "list_transform(range(64), lambda i: embedding[(i // 2) + 1 + 32 * (i % 2)])", lambda: arrays.interleaved(L(), R()))
per_sample("pcm_quantize", "list_transform(embedding, lambda x: trunc(x::DOUBLE * 32767)::INTEGER)", lambda: F.transform(E(), lambda x: arrays.quantized(x, 16)))
per_sample("array_diff", HALVES.format("round(abs(embedding[i + 1]::DOUBLE - embedding[i + 33]::DOUBLE), 6) + 0.0"), lambda: rounded(arrays.differences(L(), R())))
per_sample("znorm", "list_transform(embedding, lambda x: round((x::DOUBLE - list_avg(list_transform(embedding, lambda y: y::DOUBLE))) / list_aggregate(list_transform(embedding, lambda y: y::DOUBLE), 'stddev_samp'), 5) + 0.0)", lambda: F.transform(arrays.z_normal(E()), lambda x: F.round(x, 5)))

WINDOW, HOP = 20, 12
# starts 0, 12, ..., 60; the last frame (4 long) is shorter than the overlap of 8 and goes
FRAMES = "(SELECT vec_id, i AS index, i * 12 AS start, embedding[i * 12 + 1:least(i * 12 + 20, 64)] AS frame FROM embeddings, (SELECT unnest(range(5)) AS i))"


@query("make_frames", f"SELECT vec_id, index::INTEGER AS index, start::INTEGER AS start, len(frame)::INTEGER AS n, round(list_sum(list_transform(frame, lambda x: x::DOUBLE)), 6) + 0.0 AS total FROM {FRAMES}")
def make_frames(spark, d):
    frames = framing.make_frames(table(spark, d, "embeddings"), "vec_id", "embedding", WINDOW, HOP)
    return frames.select(
        "vec_id", "index", "start", F.size("frame").alias("n"),
        F.round(F.aggregate("frame", F.lit(0.0), lambda a, x: a + x.cast("double")), 6).alias("total"),
    )


WEIGHT = "CASE WHEN i < {t} - 1 AND p >= n - 8 THEN (7 - (p - (n - 8))) / 7.0::DOUBLE WHEN i > 0 AND p < 8 THEN p / 7.0::DOUBLE ELSE 1.0::DOUBLE END"


@query("envelope", "SELECT i::INTEGER AS index, p::INTEGER AS pos, round(" + WEIGHT.format(t=3) + ", 6) AS w FROM (SELECT unnest(range(3)) AS i), (SELECT unnest(range(20)) AS p), (SELECT 20 AS n)")
def envelope(spark, d):
    grid = spark.range(3).select(F.col("id").cast("int").alias("index"), F.explode(F.sequence(F.lit(0), F.lit(WINDOW - 1))).alias("pos"))
    return grid.select("index", "pos", F.round(arrays.envelope(F.col("pos"), F.col("index"), F.lit(3), F.lit(WINDOW), WINDOW - HOP), 6).alias("w"))


@query("overlap_add", f"SELECT vec_id, (start + p)::INTEGER AS at, round(sum(x * w), 5) + 0.0 AS value FROM (SELECT vec_id, start, p, x, {WEIGHT.format(t=5)} AS w FROM (SELECT vec_id, index AS i, start, len(frame) AS n, unnest(range(len(frame))) AS p, unnest(frame)::DOUBLE AS x FROM {FRAMES})) GROUP BY 1, 2")
def overlap_add(spark, d):
    frames = framing.make_frames(table(spark, d, "embeddings"), "vec_id", "embedding", WINDOW, HOP)
    return framing.overlap_add(frames, "vec_id", WINDOW, HOP).select("vec_id", "at", F.round("value", 5).alias("value"))


@query("secs_to_samples", "SELECT event_id, ceil(value * 30)::BIGINT AS n FROM events")
def secs_to_samples(spark, d):
    return table(spark, d, "events").select("event_id", arrays.samples(F.col("value"), 30).alias("n"))


# --- lyrics, on conversations --------------------------------------------------------------------------------------

@query("lyrics_words", "SELECT conv_id, turn, (unnest(range(len(w))))::INTEGER AS at, unnest(w) AS word FROM (SELECT conv_id, turn, string_split(text, ' ') AS w FROM conversations WHERE role <> 'system')")
def lyrics_words(spark, d):
    said = table(spark, d, "conversations").where("role <> 'system'")
    word = F.transform(F.split("text", " "), lambda w: F.struct(w.alias("word"), F.lit(0.0).alias("start"), F.lit(0.0).alias("end")))
    shaped = said.select(F.struct("conv_id", "turn").alias("k"), F.struct(F.array(F.struct(word.alias("words"))).alias("lyrics")).alias("l"))
    return lyrics.words(shaped, "k", "l", ()).select("k.conv_id", "k.turn", "at", "word")


@query("byte_tokens", "SELECT conv_id, turn, len(b)::INTEGER AS n, list_sum(b)::BIGINT AS total, b[1]::INTEGER AS first FROM (SELECT conv_id, turn, list_transform(regexp_extract_all(hex(encode(text)), '..'), lambda x: (('0x' || x)::INTEGER + 3)) AS b FROM conversations WHERE text <> '')")
def byte_tokens(spark, d):
    rows = table(spark, d, "conversations").where("text <> ''").withColumn("b", lyrics.byte_tokens(F.col("text")))
    return rows.select(
        "conv_id", "turn", F.size("b").alias("n"),
        F.aggregate("b", F.lit(0).cast("bigint"), lambda a, x: a + x).alias("total"),
        F.element_at("b", 1).alias("first"),
    )
