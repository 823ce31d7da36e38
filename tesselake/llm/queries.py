"""One query for each operator of this subpackage, over its whole table, with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

import corpus_pipeline


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .toxicity import predict

    return predict(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op2_merkle_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .merkle import edits

    return edits(table(spark, sf_dir, "documents"))


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .langid import classify

    return classify(table(spark, sf_dir, "documents"))


def op4_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from .packing import pack_documents

    return pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op5_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .secrets import digest

    return digest(table(spark, sf_dir, "documents"))


def op6_anisotropic_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .ann import search

    return search(table(spark, sf_dir, "embeddings"), every=20, k=20)


def op7_warc_bundles(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .warc import round_trip

    return round_trip(table(spark, sf_dir, "pages"))


def op8_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .suffix import deduplicated

    return deduplicated(table(spark, sf_dir, "documents")).select(F.col("id").alias("doc_id"), "n_bytes", "n_removed", "n_spans", "kept_sha256")


def op9_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .jaccard import linked

    return linked(table(spark, sf_dir, "documents")).select("doc_id", F.col("n").alias("n_shingles"), F.col("component").alias("component_id"))


def op10_sentence_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from .pieces import encoded

    return encoded(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus_pipeline.run(spark, sf_dir)


def queries() -> dict:
    return {k: f for k, f in globals().items() if k.startswith("op") and callable(f)} | {"pipeline": pipeline}


#: DuckDB counterparts of the queries that SQL can express.
OP7_SQL = """
SELECT page_id, strlen(p)::BIGINT AS payload_bytes, d AS payload_digest,
       CASE WHEN first < page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN first < page_id THEN first END AS refers_to
FROM (SELECT page_id, p, d, CASE WHEN strlen(p) >= 100 THEN min(page_id) OVER (PARTITION BY d) END AS first
      FROM (SELECT page_id, coalesce(html, '') AS p, sha256(coalesce(html, '')) AS d FROM pages))
"""

OP8_SQL = """
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h, octet_length(encode(coalesce(text, ''))) AS n FROM documents),
w AS (SELECT doc_id, i, substr(h, 2 * i + 1, 100) AS s FROM (SELECT doc_id, h, unnest(range(n - 49)) AS i FROM d WHERE n >= 50)),
f AS (SELECT s, min(doc_id) AS first FROM w GROUP BY s HAVING min(doc_id) < max(doc_id)),
r AS (SELECT w.doc_id, i FROM w JOIN f USING (s) WHERE w.doc_id > first),
g AS (SELECT doc_id, i, sum(new) OVER (PARTITION BY doc_id ORDER BY i) AS k
      FROM (SELECT doc_id, i, CASE WHEN i <= lag(i) OVER (PARTITION BY doc_id ORDER BY i) + 50 THEN 0 ELSE 1 END AS new FROM r)),
p AS (SELECT doc_id, min(i) AS a, max(i) + 50 AS b FROM g GROUP BY doc_id, k),
q AS (SELECT doc_id, a, b, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS z FROM p),
c AS (SELECT doc_id, sum(b - a) AS gone, count(*) AS spans, string_agg(substr(h, 2 * z + 1, 2 * (a - z)), '' ORDER BY a) || substr(any_value(h), 2 * max(b) + 1) AS left_
      FROM q JOIN d USING (doc_id) GROUP BY doc_id)
SELECT doc_id, n::BIGINT AS n_bytes, coalesce(gone, 0)::BIGINT AS n_removed, coalesce(spans, 0)::BIGINT AS n_spans,
       sha256(unhex(coalesce(left_, h))) AS kept_sha256
FROM d LEFT JOIN c USING (doc_id)
"""

OP9_SQL = """
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS l FROM documents),
s AS (SELECT doc_id, unnest(list_distinct(CASE WHEN len(l) >= 4 THEN list_transform(range(1, len(l) - 2), lambda i: array_to_string(l[i:i + 3], ' ')) WHEN len(l) > 0 THEN [array_to_string(l, ' ')] ELSE [] END)) AS g FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
k AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS hits FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY 1, 2),
l AS (SELECT a, b FROM k JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * hits >= 85 * (x.n + y.n - hits)),
r AS (SELECT doc_id AS id, doc_id AS c FROM documents UNION SELECT r.id, l.b FROM r JOIN l ON r.c = l.a)
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, m.c AS component_id
FROM documents d LEFT JOIN n USING (doc_id) JOIN (SELECT id, min(c) AS c FROM r GROUP BY id) m ON m.id = d.doc_id
"""


def oracle_sql() -> dict[str, str]:
    return {"op7_warc_bundles": OP7_SQL, "op8_suffix_dedup": OP8_SQL, "op9_jaccard_join": OP9_SQL}
