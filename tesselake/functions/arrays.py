"""Column functions on arrays: probabilities over time, and short signals."""

from __future__ import annotations

import math

from pyspark.sql import Column, functions as F


def real(x: Column) -> Column:
    """NaN as null: Spark orders NaN above all numbers, signal code below."""
    return F.when(~F.isnan(x), x)


def vote_share(row: Column, p: float) -> Column:
    """The share of frames strictly above p, null without frames."""
    above = F.size(F.filter(row, lambda x: real(x) > F.lit(p).cast("float")))
    return F.try_divide(above.cast("double"), F.size(row).cast("double"))


def majority_vote(row: Column, p: float = 0.9, n: float = 0.1) -> Column:
    """Whether at least the share n of the frames is strictly above p; false without frames."""
    return F.coalesce(vote_share(row, p) >= n, F.lit(False))


def first_largest(values: Column) -> Column:
    """Place (from 0) of the largest value, the first of equal ones."""
    return (F.array_position(values, F.array_max(values)) - 1).cast("int")


def above(values: Column, threshold: float) -> Column:
    """Places (from 0) of the values strictly above the threshold."""
    marked = F.transform(values, lambda x, i: F.when(real(x) > F.lit(threshold).cast("float"), i))
    return F.filter(marked, lambda i: i.isNotNull())


def super_genre(label: Column) -> Column:
    return F.split_part(label, F.lit("---"), F.lit(1))


def is_music(means: Column, label: int, threshold: float) -> Column:
    """Whether the class with the largest mean is ``label`` and its score reaches the threshold."""
    return (first_largest(means) == label) & (F.array_max(means) >= F.lit(threshold).cast("float"))


def samples(seconds: Column, rate: Column | int) -> Column:
    return F.ceil(seconds.cast("double") * (F.lit(rate) if isinstance(rate, int) else rate)).cast("bigint")


def resampled_length(n: Column, source: Column, target: int) -> Column:
    return F.ceil(n.cast("double") * target / source).cast("bigint")


def crop_longer(signal: Column, rate: Column, seconds: float) -> Column:
    """The first seconds * rate samples of a longer signal."""
    longer = F.size(signal).cast("double") / rate > seconds
    return F.when(longer, F.slice(signal, F.lit(1), (F.lit(seconds) * rate).cast("int"))).otherwise(signal)


def crop_at(signal: Column, start: Column, length: int) -> Column:
    """``length`` samples from ``start``; null unless the signal is longer than that."""
    return F.when(F.size(signal) > length, F.slice(signal, start + 1, F.lit(length)))


def hashed_start(key: Column, signal: Column, length: int) -> Column:
    """A start for ``crop_at`` that depends on the key alone."""
    return F.when(F.size(signal) > length, F.pmod(F.xxhash64(key), F.size(signal) - length)).cast("int")


def downmix(*channels: Column) -> Column:
    """The mean of any number of channels."""
    n = len(channels)
    return F.transform(added(*(c.cast("array<double>") for c in channels)), lambda x: x / n)


def added(*stems: Column) -> Column:
    out = stems[0]
    for s in stems[1:]:
        out = F.zip_with(out, s, lambda x, y: x.cast("double") + y.cast("double"))
    return out


def interleaved(left: Column, right: Column) -> Column:
    return F.flatten(F.zip_with(left, right, lambda x, y: F.array(x, y)))


def quantized(x: Column, bits: int = 16) -> Column:
    """Scaled to a signed integer, cut towards zero."""
    return (x.cast("double") * (2 ** (bits - 1) - 1)).cast("int")


def let(value: Column, body) -> Column:
    """``body`` of a value that is worked out once: inside a lambda an outer expression would be worked out per element."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def mean_std(signal: Column) -> tuple[Column, Column]:
    """Mean and sample standard deviation of an array."""
    n = F.size(signal).cast("double")
    mean = F.try_divide(F.aggregate(signal, F.lit(0.0), lambda a, x: a + x.cast("double")), n)
    square = let(mean, lambda m: F.aggregate(signal, F.lit(0.0), lambda a, x: a + (x.cast("double") - m) * (x.cast("double") - m)))
    return mean, F.sqrt(F.try_divide(square, n - 1))


def z_normal(signal: Column) -> Column:
    mean, std = mean_std(signal)
    return let(F.struct(mean.alias("mean"), std.alias("std")), lambda m: F.transform(signal, lambda x: F.try_divide(x.cast("double") - m["mean"], m["std"])))


def differences(a: Column, b: Column) -> Column:
    """Elementwise absolute differences."""
    return F.zip_with(a, b, lambda x, y: F.abs(x.cast("double") - y.cast("double")))


def difference_totals(a: Column, b: Column) -> Column:
    """(largest, total, average) of the absolute differences; nulls for empty arrays."""
    parts = lambda d: F.struct(F.array_max(d).alias("largest"), F.aggregate(d, F.lit(0.0), lambda t, x: t + x).alias("total"))
    found = let(differences(a, b), parts)
    average = F.try_divide(found["total"], F.size(a).cast("double"))
    return F.struct(found["largest"].alias("largest"), F.when(F.size(a) > 0, found["total"]).alias("total"), average.alias("average"))


def faded(signal: Column, overlap: int) -> Column:
    """A signal with a ramp over ``overlap`` samples at either end; where the two meet, the one at the end holds."""
    step = max(overlap - 1, 1)

    def weight(i: Column) -> Column:
        to_end = F.size(signal) - 1 - i
        return F.when(to_end < overlap, to_end.cast("double") / step).when(i < overlap, i.cast("double") / step).otherwise(1.0)

    return F.transform(signal, lambda x, i: x.cast("double") * weight(i))


def fade_in(overlap: int) -> list[float]:
    return [i / (overlap - 1) if overlap > 1 else 0.0 for i in range(overlap)]


def envelope(pos: Column, index: Column, total: Column, length: Column, overlap: int) -> Column:
    """Weight of place ``pos`` of frame ``index`` of ``total``: ramps at inner edges, the tail's over the head's."""
    if overlap == 0:
        return F.lit(1.0)
    step = max(overlap - 1, 1)
    tail_at = pos - (length - overlap)
    down = F.when(tail_at >= 0, (F.lit(overlap - 1) - tail_at).cast("double") / step)
    # where a frame is shorter than the ramp, the ramp's last places are those that fit
    up = F.when(pos < overlap, pos.cast("double") / step)
    return F.coalesce(F.when(index < total - 1, down), F.when(index > 0, up), F.lit(1.0))


def frame_starts(n: Column, window: int, hop: int) -> Column:
    """Starts of the overlapping windows over n samples; the last window goes if shorter than the overlap."""
    starts = F.sequence(F.lit(0), F.greatest(n - 1, F.lit(0)), F.lit(hop))
    last = F.element_at(starts, -1)
    short = (n - last < window - hop) & (F.size(starts) > 1)
    return F.when(n < window, F.array(F.lit(0))).when(short, F.slice(starts, F.lit(1), F.size(starts) - 1)).otherwise(starts)


def shortest_frames(seconds: float, rate: float) -> int:
    return math.ceil(seconds * rate)
