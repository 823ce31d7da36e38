"""Global numbering, shards of fixed size, work units."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F


def enumerated(rows: DataFrame, by: str, start: int = 0, partitions: int | None = None) -> DataFrame:
    """Rows with ``idx``, their place in the order of ``by``, without a single-task window.

    Rows are cut into ranges at approximate quantiles, numbered within each range, and shifted by the number of rows in
    the ranges before it; only one count per range passes through one task."""
    parts = partitions or int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = ranges(rows, by, parts)
    before = ranged.groupBy("__b").agg(F.count("*").alias("__n"))
    before = before.withColumn("__before", F.coalesce(F.sum("__n").over(Window.orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    inside = ranged.withColumn("__r", F.row_number().over(Window.partitionBy("__b").orderBy(by)))
    return inside.join(F.broadcast(before.select("__b", "__before")), "__b").withColumn("idx", F.col("__before") + F.col("__r") - 1 + start).drop("__b", "__r", "__before")


def ranges(rows: DataFrame, by: str, parts: int) -> DataFrame:
    """Adds ``__b``, the number of the range of ``by``: ranges are cut at the values of a bounded hash sample."""
    drawn = rows.select(by).where(F.col(by).isNotNull()).orderBy(F.xxhash64(by), by).limit(64 * parts).collect()
    values = sorted({r[0] for r in drawn})
    cuts = sorted({values[len(values) * i // parts] for i in range(1, parts)}) if values else []
    if not cuts:
        return rows.withColumn("__b", F.lit(0))
    # the number of cuts that aren't above the value, by halving
    steps = F.array(*[F.lit(1 << i) for i in reversed(range(len(cuts).bit_length()))])
    known = F.array(*map(F.lit, cuts))
    at = F.aggregate(steps, F.lit(0), lambda n, s: F.when(F.get(known, n + s - 1) <= F.col(by), n + s).otherwise(n))
    return rows.withColumn("__b", F.coalesce(at, F.lit(0)))


def sharded(rows: DataFrame, by: str, per_shard: int, limit: int | None = None, first: int = 0) -> DataFrame:
    """Rows with ``shard``: each shard has per_shard rows in the order of ``by``, but for the last."""
    out = enumerated(rows, by)
    if limit is not None:  # by number: an ordered limit would bring all kept rows to one task
        out, per_shard = out.where(F.col("idx") < limit), min(per_shard, limit)
    return out.withColumn("shard", F.floor(F.col("idx") / per_shard) + first)


def chunked(rows: DataFrame, per_shard: int, per_chunk: int = 1000) -> DataFrame:
    """Adds ``chunk``, a shard's work unit of at most per_chunk rows."""
    return rows.withColumn("chunk", F.floor((F.col("idx") % per_shard) / per_chunk))
