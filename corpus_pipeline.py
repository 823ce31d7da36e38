"""The corpus pipeline: five stages over ``documents``, each with the columns of its input but for the last.

Every stage is written as Parquet and read again before the next; run() does that in the shared folder.  A stage
judges what its predecessor kept: toxic documents go, of each group of near copies one document stays (the one with
the smallest doc_id), byte strings that repeat an earlier document are cut out, secrets are blanked, and what is
left is packed into sequences.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tesselake.llm import jaccard, packing, secrets, suffix, toxicity
from tesselake.llm.common import written


def like(rows: DataFrame, docs: DataFrame) -> DataFrame:
    """The columns of docs, n_chars counted anew from the text."""
    if "n_chars" in docs.columns:
        rows = rows.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))
    return rows.select(*docs.columns)


def remove_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that aren't rated toxic.  The network learns from the labelled documents of its input."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    rated = toxicity.score(docs, labels, columns=tuple(docs.columns), names=("__score", "__predicted"))
    return rated.where("__predicted = 0").select(*docs.columns)


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: the first by doc_id (repeated rows: one of them).

    Near copies are documents with 5-word shingle sets of a Jaccard similarity of at least 0.8.  Documents without a
    word, or without doc_id, are in no group and stay; different texts of one doc_id are documents of their own."""
    return jaccard.one_of_each_group(docs, t=jaccard.Threshold(80, 100), width=5)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the byte strings of 50 bytes that start in an earlier document too.

    What is left of a character that was cut through goes with it; documents of which nothing is left go."""
    return like(suffix.without_repeats(docs), docs)


def blank_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with each secret replaced by the name of its kind; no document goes."""
    return like(secrets.redacted(docs), docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents' tokens, packed into sequences of at most 4096."""
    import public_tokenizers

    return packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("toxicity", remove_toxic),
    ("near_duplicates", one_of_each),
    ("repeated_passages", cut_repeats),
    ("secrets", blank_secrets),
    ("packing", pack),
]

#: Trained models, components and tokenizers are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
