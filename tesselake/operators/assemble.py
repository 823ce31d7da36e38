"""Joins of files with their sidecar features."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window, functions as F


def vocal_filter(files: DataFrame, features: DataFrame, key: str, keep: Column, only_if_vocals: bool = True) -> DataFrame:
    """Files whose sidecar fulfils ``keep``; files without sidecar go.  All files if the gate is off."""
    return files.join(features.where(keep).select(key), key, "left_semi") if only_if_vocals else files


def first_by_stem(files: DataFrame, flags: DataFrame, stem: str, flag: str, order: str) -> DataFrame:
    """The first file of each stem whose first flag is true."""
    w = Window.partitionBy(stem).orderBy(order)
    one = files.withColumn("__r", F.row_number().over(w)).where("__r = 1").drop("__r")
    kept = flags.withColumn("__r", F.row_number().over(Window.partitionBy(stem).orderBy(flag))).where("__r = 1").where(F.col(flag)).select(stem)
    return one.join(kept, stem, "left_semi")


def assemble(anchor: DataFrame, key: str, required: dict[str, DataFrame], optional: dict[str, tuple[DataFrame, Column]]) -> DataFrame:
    """One row per key with a column per feature: required ones by inner join, optional ones with a default.

    Features are (key, value)."""
    out = anchor
    for name, df in required.items():
        out = out.join(df.select(key, F.col("value").alias(name)), key)
    for name, (df, default) in optional.items():
        out = out.join(df.select(key, F.col("value").alias(name)), key, "left").withColumn(name, F.coalesce(name, default))
    return out


def validate_dim(rows: DataFrame, feature: str, dim: int) -> DataFrame:
    """Rows whose feature (an array of rows over time) has ``dim`` rows."""
    return rows.where(F.size(feature) == dim)


def long_enough(rows: DataFrame, feature: str, seconds: float, rate: float) -> DataFrame:
    from ..functions.arrays import shortest_frames

    return rows.where(F.size(feature) >= shortest_frames(seconds, rate))


def counted(rows: DataFrame, good: Callable[[], Column], name: str = "counters"):
    """Rows with an Observation of how many passed and failed, filled when the rows are consumed."""
    from pyspark.sql import Observation

    seen = Observation(name)
    return rows.observe(seen, F.count_if(good()).alias("success"), F.count_if(~good()).alias("error")), seen
