"""Dataset statistics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F


def totals(rows: DataFrame, duration: str = "duration") -> DataFrame:
    """Count and total duration in seconds, minutes and hours; 0 for an empty table."""
    total = F.coalesce(F.sum(duration), F.lit(0.0))
    return rows.agg(
        F.count("*").alias("total_count"), F.round(total, 6).alias("seconds"), F.round(total / 60, 6).alias("minutes"),
        F.round(total / 3600, 6).alias("hours"),
    )


def counts(rows: DataFrame, key: Column | str, name: str) -> DataFrame:
    key = F.col(key) if isinstance(key, str) else key
    return rows.groupBy(key.alias(name)).agg(F.count("*").alias("n"))


def channel_kind(channels: Column) -> Column:
    return F.when(channels == 2, "stereo").otherwise("mono")


def histogram(rows: DataFrame, value: str, bins: int = 100) -> DataFrame:
    """Counts in bins of equal width from the smallest to the largest value; the last bin is closed."""
    edges = rows.agg(F.struct(F.min(value).alias("lo"), F.max(value).alias("hi"))).scalar()  # one row, a scalar subquery
    width = (edges["hi"] - edges["lo"]) / bins
    place = F.least(F.coalesce(F.floor(F.try_divide(F.col(value) - edges["lo"], width)), F.lit(0)), F.lit(bins - 1)).cast("int")
    return rows.where(F.col(value).isNotNull()).select(place.alias("bin")).groupBy("bin").agg(F.count("*").alias("n"))


def top(rows: DataFrame, key: str, k: int) -> DataFrame:
    """The k most frequent keys; equal counts by key."""
    return rows.groupBy(key).agg(F.count("*").alias("n")).orderBy(F.desc("n"), key).limit(k)


def hash_order(*columns: str | Column, seed: int) -> Column:
    """A repeatable random order that other engines can reproduce."""
    return F.md5(F.concat_ws(":", *columns, F.lit(str(seed))))


def stratified(rows: DataFrame, stratum: str, key: str, k: int, each: int, seed: int = 42) -> DataFrame:
    """Up to ``each`` rows, by hash order, of the k most frequent strata."""
    strata = top(rows, stratum, k).select(stratum)  # k rows
    w = Window.partitionBy(stratum).orderBy(hash_order(F.col(key).cast("string"), seed=seed), key)
    return rows.join(F.broadcast(strata), stratum).withColumn("r", F.row_number().over(w)).where(F.col("r") <= each).drop("r")


def stratified_by_part(rows: DataFrame, label: str, strata: list[str], key: str, each: int, seed: int = 42) -> DataFrame:
    """Up to ``each`` rows, by hash order, of each of a few strata: the rows whose label holds the stratum's name.  A row
    may come under several, in the column ``genre``."""
    found = F.filter(F.array(*map(F.lit, strata)), lambda g: F.contains(F.col(label), g))
    w = Window.partitionBy("genre").orderBy(hash_order(F.col(key).cast("string"), seed=seed), key)
    return rows.withColumn("genre", F.explode(found)).withColumn("r", F.row_number().over(w)).where(F.col("r") <= each).drop("r")


def sample(rows: DataFrame, key: str, n: int, seed: int = 42) -> DataFrame:
    """n rows by hash order."""
    return rows.orderBy(hash_order(F.col(key).cast("string"), seed=seed), key).limit(n)
