"""Listings of files as DataFrames: path, length, modificationTime; contents are read only where they are used."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.paths import glob_regex, literal_root, without_scheme


def list_files(spark: SparkSession, glob: str, content: bool = False) -> DataFrame:
    """Files whose full path matches the glob.  Listing starts at the glob's literal directory; no match is no row.
    Files without a byte aren't listed, so a target left empty counts as missing."""
    columns = ["length", "modificationTime"] + ["content"] * content
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(literal_root(glob))
    return match(files.select(without_scheme(F.col("path")).alias("path"), *columns), glob)


def match(files: DataFrame, glob: str, path: str = "path") -> DataFrame:
    return files.where(F.col(path).rlike(glob_regex(glob)))


def match_all(files: DataFrame, globs: list[str], path: str = "path") -> DataFrame:
    """The union of several globs; a file that matches two comes twice."""
    which = F.filter(F.array(*[F.when(F.col(path).rlike(glob_regex(g)), F.lit(g)) for g in globs]), lambda g: g.isNotNull())
    return files.withColumn("glob", F.explode(which))


def require(files: DataFrame, what: str) -> DataFrame:
    """The files, or an error if there are none."""
    if files.isEmpty():
        raise FileNotFoundError(f"nothing matches {what}")
    return files


def rebalance(files: DataFrame, partitions: int) -> DataFrame:
    """Deal the rows out anew before costly work on each."""
    return files.repartition(partitions)
