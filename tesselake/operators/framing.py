"""Overlapping frames of signals, and their reassembly by overlap-add."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.arrays import envelope, frame_starts


def make_frames(rows: DataFrame, key: str, signal: str, window: int, hop: int) -> DataFrame:
    """A row per frame: key, index, total, start, frame."""
    starts = frame_starts(F.size(signal), window, hop)
    rows = rows.select(key, F.col(signal).alias("signal"), starts.alias("starts"))
    return rows.select(key, F.size("starts").alias("total"), "signal", F.posexplode("starts").alias("index", "start")).select(
        key, "index", "total", "start",
        F.slice("signal", F.col("start") + 1, F.when(F.size("signal") < window, F.size("signal")).otherwise(window)).alias("frame"),
    )


def overlap_add(frames: DataFrame, key: str, window: int, hop: int, length: str | None = None) -> DataFrame:
    """The weighted sums of frames by place: key, at, value.  A single frame is returned as it is.

    ``frames`` holds all frames of a key, as ``make_frames`` gives them.  They are gathered per key, whole; each place looks
    up the few frames that cover it, so single samples aren't shuffled."""
    extra = [F.first(length).alias("__length")] if length else []
    whole = frames.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("index", "frame"))).alias("f"), F.max("total").alias("total"), *extra)
    whole = whole.withColumn("sizes", F.transform("f", lambda x: F.size(x["frame"])))
    stop = F.array_max(F.transform("f", lambda x: x["index"] * hop + F.size(x["frame"])))
    stop = F.when(F.col("total") == 1, stop).otherwise(F.least(stop, F.col("__length"))) if length else stop

    def value(at: Column) -> Column:
        first = F.greatest(F.lit(0), F.ceil((at - window + 1) / F.lit(hop)).cast("int"))
        last = F.least(F.col("total") - 1, F.floor(at / F.lit(hop)).cast("int"))

        def part(sum_: Column, i: Column) -> Column:
            pos, size = at - i * hop, F.get("sizes", i)
            weight = F.when(F.col("total") > 1, envelope(pos, i, F.col("total"), size, window - hop)).otherwise(1.0)
            return sum_ + F.when((pos >= 0) & (pos < size), F.get(F.get("f", i)["frame"], pos).cast("double") * weight).otherwise(0.0)

        return F.aggregate(F.sequence(first, F.greatest(first, last)), F.lit(0.0), part)

    places = F.filter(F.sequence(F.lit(0), stop), lambda at: at < stop)
    return whole.select(key, F.posexplode(F.transform(places, value)).alias("at", "value"))
