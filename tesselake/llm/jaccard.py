"""N-gram Jaccard self-join by universe partition and pigeonhole, and its connected components.

A text's set holds the 64-bit hashes of its distinct ``width``-word shingles.  Texts with equal sets are one node from the
start.  For two sets of a and b elements with Jaccard similarity of at least t, the symmetric difference is at most
H = (1 - t) / (1 + t) * (a + b).  Sets fall into size bands with a ratio of t, so that a partner is in the same or a
neighbouring band; a set is indexed for its own band (as the larger of a pair) and the next one (as the smaller).

For a band the universe of hashes is cut into segments.  A segment is matched exactly (worth 1) or within one
deletion (worth 2: its subset and all subsets with one element less are indexed); as soon as the segments are worth
H + 1 together, some segment of a linked pair must match.  Which kind a band gets is chosen by cost: signatures
written against candidates expected, from the band's number of sets.  Exact segments that are empty in a set are left out:
bands get spare ones, and as many as the sets that they really hold need for that (counted over all of them).

Signatures are dealt to buckets in packed form, in as many passes over the texts as keep a pass's exchange below a number of
bytes for each shingle.  Sets that share one become candidate pairs, unless more than ``few``
do.  Such a frequent signature is left out as long as the slack covers a set's frequent ones (a linked pair then still
meets in another).  What remains are families of near copies, whose sets have more of them.  A family's sets are first
held against a few pivots, those in most frequent signatures; whoever is linked to one is joined to it.  Outliers, the
sets outside the family's largest component, choose pivots once more; only those then left over meet the family in
blocks of bounded size, and only links that join components leave such a task.  So a family costs work in proportion to its
size and to its outliers; where a family is no cluster at all (none of many sets linked to a pivot), blocks of it all meet.

Candidate pairs are first held against small parity sketches, whose distance can't exceed the sets' symmetric
difference; those left are verified on the whole sets.

Words are as the contract says: ASCII letters lowered, cut at ASCII white space.  Texts with fewer words than
a shingle have one, null texts and texts without words none (they are their own component).  Rows without doc_id keep a
null component.  Repeated rows get the same component each; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache, reduce
from math import ceil, exp, log

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .common import bucketed, dropped, mix64, partitions, sieved, small_batches, sweep, written
from .components import components

U = np.uint64
BYTE = mix64(np.arange(1, 257, dtype=np.uint64) * U(0x9E3779B97F4A7C15))
#: Multiplier of the words of a shingle by their place.
STEP = U(0xD6E8FEB86659FD93)


@lru_cache
def powers(n: int) -> np.ndarray:
    return np.concatenate([np.ones(1, np.uint64), np.cumprod(np.full(n, STEP, np.uint64))])


def word_hashes(raw: bytes) -> np.ndarray:
    """A hash of each word of ASCII-lowered bytes."""
    a = np.frombuffer(raw, np.uint8)
    blank = (a == 32) | ((a >= 9) & (a <= 13))
    starts = np.flatnonzero(~blank & np.concatenate([[True], blank[:-1]])) if len(a) else np.zeros(0, int)
    if not len(starts):
        return np.zeros(0, np.uint64)
    a, blank, starts = a[starts[0] :], blank[starts[0] :], starts - starts[0]
    place = np.arange(len(a)) - np.repeat(starts, np.diff(np.append(starts, len(a))))
    place[blank] = 0
    value = BYTE[a] * powers(int(place.max()) | 63)[place]
    value[blank] = 0
    return mix64(np.add.reduceat(value, starts))


def shingle_set(text: str | None, width: int = 4) -> np.ndarray:
    """The sorted distinct hashes of a text's shingles."""
    words = word_hashes((text or "").encode("utf-8", "surrogatepass").lower())
    if not len(words):
        return words
    size = min(width, len(words))
    h = np.full(len(words) - size + 1, size, np.uint64)
    for i in range(size):
        h = h * STEP + words[i : i + len(h)]
    return np.unique(mix64(h))


def set_key(s: np.ndarray) -> int:
    """A 63-bit key of a whole set, equal for equal sets."""
    return int(mix64(np.array([mix64(s ^ U(0xA5A5A5A5A5A5A5A5)).sum() + U(len(s))], np.uint64))[0] >> U(1))


@dataclass(frozen=True)
class Threshold:
    """Jaccard similarity of at least num / den."""

    num: int = 85
    den: int = 100

    def most_apart(self, total: int) -> int:
        """The largest symmetric difference of linked sets with ``total`` elements together."""
        return (self.den - self.num) * total // (self.den + self.num)

    def band(self, n: int) -> int:
        return int(log(n) / log(self.den / self.num) + 1e-9) if n else 0

    def top(self, band: int) -> int:
        """The largest size that the band may hold."""
        return int((self.den / self.num) ** (band + 1)) + 1


@dataclass(frozen=True)
class Allocation:
    """Segments of a band, and how many matches it can spare for frequent signatures."""

    exact: int
    deletion: int
    frequent: int


#: Further segments, for empty ones, of which a band takes the least that is enough for all of its sets.
SPARE = ((0.08, 2), (0.16, 3), (0.32, 4), (0.64, 6))


def exact_segments(t: Threshold, band: int, step: int) -> tuple[int, int]:
    """Exact segments of a band at a step of SPARE, and its matches for frequent signatures."""
    need = t.most_apart(2 * t.top(band))
    share, more = SPARE[step]
    frequent = max(1, need // 16)
    return need + 1 + frequent + ceil(need * share) + more, frequent


def segment_numbers(s: np.ndarray, m: int) -> np.ndarray:
    """The segment of each element; a sorted set's are in order."""
    return ((s >> U(32)) * U(m)) >> U(32)


def enough(s: np.ndarray, t: Threshold) -> int:
    """The steps of SPARE, as bits, at which a set has so few empty segments in its own band that any set linked to it,
    and no larger, meets it in more filled segments than the band sets aside for frequent signatures."""
    found, n = 0, len(s)
    for step in range(len(SPARE)):
        m, frequent = exact_segments(t, t.band(n), step)
        filled = len(np.unique(segment_numbers(s, m)))
        found |= (filled - t.most_apart(2 * n) > frequent) << step
    return found


#: The chance that strangers agree in an element of a segment, as allocation takes it.  Exact segments of some 3 elements
#: everywhere gave no more candidates than one-deletion ones in half of the bands, which write 3 signatures for one.
AGREE = 0.01


def allocate(t: Threshold, band: int, sets: int, steps: int) -> Allocation | None:
    """The cheapest segments of a band with so many sets, of which ``steps`` are enough; None: equal sets only.

    Either exact segments, of which sets leave out empty ones, or one-deletion segments with all their subsets."""
    size = t.top(band)
    need = t.most_apart(2 * size)
    if need == 0:
        return None

    def cost(m: int, each: float, chance: float) -> float:
        return m * each + 0.05 * sets * m * chance

    frequent = max(1, need // 16)
    deletion = (need + 2 + 2 * frequent) // 2
    length = size / deletion
    best = cost(deletion, 1 + length, (1 + length) * AGREE ** max(0.0, length - 1) + exp(-length)), Allocation(0, deletion, frequent)
    for step in range(len(SPARE)):
        if steps >> step & 1:
            m, frequent = exact_segments(t, band, step)
            best = min(best, (cost(m, 1, AGREE ** (size / m)), Allocation(m, 0, frequent)), key=lambda x: x[0])
            break
    return best[1]


def signatures(s: np.ndarray, band: int, a: Allocation) -> np.ndarray:
    """The signatures of a sorted set for a band: 40 bits of hash over 8 bits of band, above 16 bits of bucket."""
    m = a.exact + a.deletion
    seg = segment_numbers(s, m)
    mixed = mix64(s)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mixed)])
    at = np.searchsorted(seg, np.arange(m + 1, dtype=np.uint64))
    count = np.diff(at)
    base = np.arange(m, dtype=np.uint64) * U(0x9E3779B97F4A7C15) + U((band + 1) * 0xC2B2AE3D27D4EB4F % 2**64)
    total = sums[at[1:]] - sums[at[:-1]]
    full = mix64(total + count.astype(np.uint64) * U(0x165667B19E3779F9) + base)
    if not a.deletion:
        return marked(full[count > 0], band)
    k = seg.astype(np.int64)
    less = mix64(total[k] - mixed + (count[k] - 1).astype(np.uint64) * U(0x165667B19E3779F9) + base[k])
    return np.unique(marked(np.concatenate([full, less]), band))


def marked(h: np.ndarray, band: int) -> np.ndarray:
    return (h & ~U(0xFF)) | U(band)


def keyed(docs: DataFrame, id_col: str, text: str, t: Threshold, width: int) -> DataFrame:
    """(id, h, n, key, band, steps) of each row; h: a hash of the text, steps as ``enough`` has them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in small_batches(batches, 4 << 20):
            sets = [shingle_set(x, width) for x in b.column("t").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    b.column("id"), b.column("h"), pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([set_key(s) for s in sets], pa.int64()),
                    pa.array([t.band(len(s)) for s in sets], pa.int32()),
                    pa.array([enough(s, t) if len(s) else 0 for s in sets], pa.int32()),
                ],
                names=["id", "h", "n", "key", "band", "steps"],
            )

    return docs.select(
        F.col(id_col).cast("long").alias("id"), text_hash(text).alias("h"), F.col(text).alias("t"),
    ).mapInArrow(run, "id long, h long, n long, key long, band int, steps int")


def text_hash(text: str) -> Column:
    return F.xxhash64(F.coalesce(text, F.lit("")))


#: Bytes of a dealt signature at most: its own 6, 2 or 4 for its set's place, 12 for that set's key and size.
ENTRY = 20


def dealt_signatures(
    docs: DataFrame, text: str, plan: dict[int, Allocation | None], t: Threshold, width: int, buckets: int, few: int,
    turn: int = 0, passes: int = 1,
) -> DataFrame:
    """Packed signatures by bucket, of all passes' those of one.  A set that its task has met already is left out.

    Of a signature that more than ``few`` + 1 sets of a batch share the rest is known to be frequent and goes to buckets
    of its own (below 0), dealt by batch: no bucket gets more than a few entries of a signature from a batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        met: set[int] = set()
        for b in small_batches(batches, 8 << 20):
            keys, sizes, sigs, owner = [], [], [], []
            for x in b.column("t").to_pylist():
                s = shingle_set(x, width)
                if not len(s) or (key := set_key(s)) in met:
                    continue
                met.add(key)
                k = t.band(len(s))
                own = [signatures(s, i, a) for i in (k, k + 1) if (a := plan.get(i))]
                if passes > 1:
                    own = [x[(x >> U(8)) % U(passes) == turn] for x in own]
                if own:
                    sigs += own
                    owner.append(sum(map(len, own)))
                    keys.append(key)
                    sizes.append(len(s))
            if not keys:
                continue
            sig, who = np.concatenate(sigs), np.repeat(np.arange(len(keys), dtype=np.int32), owner)
            order = np.argsort(sig, kind="stable")  # and so by bucket
            sig, who = sig[order], who[order]
            keys_, sizes_ = np.array(keys, np.int64), np.array(sizes, np.int32)
            first = np.flatnonzero(np.concatenate([[True], sig[1:] != sig[:-1]])) if len(sig) else np.zeros(0, int)
            over = np.arange(len(sig)) - np.repeat(first, np.diff(np.append(first, len(sig)))) > few
            rows = []
            if over.any():
                # frequent in this task alone: few + 1 sets tell the bucket so, the others need not go there
                rows.append((-1 - keys[0] % buckets, packed(sig[over]), None, keys_[who[over]].tobytes(), None))
                sig, who = sig[~over], who[~over]
            bucket = ((sig >> U(48)) * U(buckets)) >> U(16)
            at = np.searchsorted(bucket, np.arange(buckets + 1, dtype=np.uint64))
            for i in range(buckets):
                if at[i] < at[i + 1]:
                    used, local = np.unique(who[at[i] : at[i + 1]], return_inverse=True)
                    # the low 48 bits of the signature, and which of this row's sets it is of
                    rows.append((i, packed(sig[at[i] : at[i + 1]]), local.astype(np.uint16 if len(used) < 65536 else np.uint32).tobytes(), keys_[used].tobytes(), sizes_[used].tobytes()))
            kinds = (pa.int32(), *[pa.binary()] * 4)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=["bucket", "sig", "local", "keys", "sizes"])

    return docs.select(F.col(text).alias("t")).mapInArrow(run, "bucket int, sig binary, local binary, keys binary, sizes binary")


def packed(h: np.ndarray) -> bytes:
    """The low 48 bits of each."""
    return h.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6].tobytes()


def unpacked48(raw: bytes) -> np.ndarray:
    a = np.frombuffer(raw, np.uint8).reshape(-1, 6)
    wide = np.zeros((len(a), 8), np.uint8)
    wide[:, :6] = a
    return wide.view(np.uint64).ravel()


def unpacked(table: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(signature, key, size) of a bucket's distinct entries, by signature and key."""
    sig, key, size = [], [], []
    for r in table.to_pylist():
        own = unpacked48(r["sig"])
        local = np.frombuffer(r["local"], np.uint16 if len(r["local"]) == 2 * len(own) else np.uint32)
        sig.append(own)
        key.append(np.frombuffer(r["keys"], np.int64)[local])
        size.append(np.frombuffer(r["sizes"], np.int32)[local])
    sig, key, size = map(np.concatenate, (sig, key, size))
    order = np.lexsort((key, sig))
    sig, key, size = sig[order], key[order], size[order]
    new = np.ones(len(sig), bool)
    new[1:] = (sig[1:] != sig[:-1]) | (key[1:] != key[:-1])
    return sig[new], key[new], size[new]


def candidates(dealt: DataFrame, t: Threshold, few: int) -> DataFrame:
    """Pairs (a, b) of keys; and, with b null, of the groups of more than ``few`` number, band and packed members."""
    columns = (("a", pa.int64()), ("b", pa.int64()), ("g", pa.int64()), ("band", pa.int32()), ("members", pa.binary()))

    def shaped(ab: np.ndarray, large: list[tuple[int, bytes]]) -> pa.Table:
        n, none = [None] * len(ab), [None] * len(large)
        found = (
            [*ab[:, 0].tolist(), *none], [*ab[:, 1].tolist(), *none], [*n, *(g for g, _ in large)],
            [*n, *(g & 0xFF for g, _ in large)], [*n, *(m for _, m in large)],
        )
        return pa.table({name: pa.array(x, kind) for (name, kind), x in zip(columns, found)})

    def run(table: pa.Table) -> pa.Table:
        if table.column("bucket")[0].as_py() < 0:
            rows = table.to_pylist()
            sig, key = np.concatenate([unpacked48(r["sig"]) for r in rows]), np.concatenate([np.frombuffer(r["keys"], np.int64) for r in rows])
            order = np.argsort(sig, kind="stable")
            sig, key = sig[order], key[order]
            ends = np.append(np.flatnonzero(np.concatenate([[True], sig[1:] != sig[:-1]])), len(sig))
            return shaped(np.zeros((0, 2), np.int64), [(int(sig[i]), key[i:j].tobytes()) for i, j in zip(ends, ends[1:])])
        sig, key, size = unpacked(table)
        first = np.flatnonzero(np.concatenate([[True], sig[1:] != sig[:-1]])) if len(sig) else np.zeros(0, int)
        count = np.diff(np.append(first, len(sig)))
        pairs = [np.zeros((0, 2), np.int64)]
        for k in range(2, few + 1):  # all groups of k sets at once
            at = first[count == k]
            if len(at):
                i, j = np.triu_indices(k, 1)
                i, j = (at[:, None] + i).ravel(), (at[:, None] + j).ravel()
                small, big = np.minimum(size[i], size[j]).astype(np.int64), np.maximum(size[i], size[j]).astype(np.int64)
                fine = t.den * small >= t.num * big
                a, b = key[i[fine]], key[j[fine]]
                pairs.append(np.stack([np.minimum(a, b), np.maximum(a, b)], 1))
        large = [(int(sig[at]), key[at : at + k].tobytes()) for at, k in zip(first[count > few], count[count > few])]
        return shaped(np.unique(np.concatenate(pairs), axis=0), large)

    return dealt.groupBy("bucket").applyInArrow(run, "a long, b long, g long, band int, members binary")


def sketch(s: np.ndarray) -> np.ndarray:
    """Parities of the elements by cell; one to two cells an element, a power of two of 64-bit words."""
    words = 1 << max(0, (len(s) - 1) // 64).bit_length()
    cell = (s % U(64 * words)).astype(np.int64)
    parity = (np.bincount(cell, minlength=64 * words) & 1).astype(np.uint8)
    return np.packbits(parity, bitorder="little").view(np.int64)


def sketch_distance(a: Column, b: Column) -> Column:
    """The number of cells in which two sketches differ, the finer one folded to the coarser."""
    words = F.least(F.size(a), F.size(b))
    folded = lambda x, i: F.when(F.size(x) > words, F.get(x, i).bitwiseXOR(F.get(x, i + words))).otherwise(F.get(x, i))
    return F.aggregate(F.sequence(F.lit(0), words - 1), F.lit(0), lambda n, i: n + F.bit_count(folded(a, i).bitwiseXOR(folded(b, i))))


def verified(pairs: DataFrame, sets: DataFrame, t: Threshold) -> DataFrame:
    """The pairs whose sets are similar enough; sets: (key, s array of hashes, p sketch).

    Sketches go through the first two joins, whole sets only for pairs that these can't rule out."""

    def beside(df: DataFrame, what: str) -> DataFrame:
        left, right = sets.select(
            F.col("key").alias("a"), F.col(what).alias("x"), F.size("s").alias("na"),
        ), sets.select(F.col("key").alias("b"), F.col(what).alias("y"), F.size("s").alias("nb"))
        return df.join(left, "a").join(right, "b")

    near = beside(pairs, "p").where((t.den + t.num) * sketch_distance(F.col("x"), F.col("y")) <= (t.den - t.num) * (F.col("na") + F.col("nb"))).select("a", "b")
    joined = beside(written(near, "near"), "s").withColumn("both", F.size(F.array_intersect("x", "y")))
    return joined.where(t.den * F.col("both") >= t.num * (F.col("na") + F.col("nb") - F.col("both"))).select("a", "b")


def sets_of(docs: DataFrame, wanted: DataFrame, id_col: str, text: str, width: int) -> DataFrame:
    """(key, s, p) of the documents that stand for the wanted keys (key, id): a table dealt by key."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.int64())
        for b in small_batches(batches, 4 << 20):
            sets = [shingle_set(x, width) for x in b.column("t").to_pylist()]
            fits = [set_key(s) == k for s, k in zip(sets, b.column("key").to_pylist())]  # a repeated id may bring other texts
            yield pa.RecordBatch.from_arrays(
                [b.column("key"), pa.array([s.view(np.int64) for s in sets], kind), pa.array([sketch(s) for s in sets], kind)],
                names=["key", "s", "p"],
            ).filter(pa.array(fits, pa.bool_()))

    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text).alias("t")).where("id is not null")
    # most texts have no candidate: they aren't moved
    some = sieved(texts, wanted, "id").where("hit").drop("hit")
    sets, n = some.join(wanted.hint("shuffle_hash"), "id").select("key", "t").mapInArrow(run, "key long, s array<long>, p array<long>"), partitions(docs)
    return bucketed(sets.repartition(n, "key").dropDuplicates(["key"]), "sets", "key", n, dealt=True)


def unpacked_members(groups: DataFrame) -> DataFrame:
    """(g, band, key) of packed groups."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keys = [np.frombuffer(x, np.int64) for x in b.column("members").to_pylist()]
            sizes = [len(k) for k in keys]
            if keys:
                g, band = (np.repeat(b.column(n).to_numpy(), sizes) for n in ("g", "band"))
                yield pa.RecordBatch.from_arrays([pa.array(g), pa.array(band), pa.array(np.concatenate(keys))], names=["g", "band", "key"])

    return groups.mapInArrow(run, "g long, band int, key long")


def families(groups: DataFrame, plan: dict[int, Allocation | None]) -> DataFrame:
    """(key, family, c) of the sets that have more frequent signatures in a band than its slack covers; c: how many."""
    members = written(unpacked_members(groups), "members")
    allowed = F.create_map(*[F.lit(x) for k, a in plan.items() if a for x in (k, a.frequent)])
    worth = F.create_map(*[F.lit(x) for k, a in plan.items() if a for x in (k, 2 if a.deletion else 1)])
    many = written(
        members.groupBy("key", "band").agg(F.count("*").alias("c")).where(F.col("c") * worth[F.col("band")] > allowed[F.col("band")]),
        "many",
    )
    held = written(members.join(many, ["key", "band"]).select("g", "key"), "members")
    dropped(groups.sparkSession, members)
    # each set is linked to the least head of its groups, and that head to the heads of the set's other groups; heads
    # are a table of their own, so that a large group is a large key of one side of a join, which Spark can split
    first = written(held.groupBy("g").agg(F.min("key").alias("head")), "heads")
    heads = written(held.join(first, "g").select("key", "head").distinct(), "heads")
    least = heads.groupBy("key").agg(F.min("head").alias("least"))
    links = least.select(F.col("key").alias("a"), F.col("least").alias("b"))
    links = links.unionByName(heads.join(least, "key").select(F.col("least").alias("a"), F.col("head").alias("b")).distinct())
    # a set that is the head of its own groups alone has no link yet
    found = components(links, alone=True).select(F.col("id").alias("key"), F.col("component").alias("family"))
    return found.join(many.groupBy("key").agg(F.sum("c").alias("c")), "key")


def family_links(
    family: DataFrame, sets: DataFrame, t: Threshold, block: int = 1024, elements: int = 400_000, pivots: int = 8,
    rounds: int = 2,
) -> DataFrame:
    """Links (a, b) of keys within families (key, family, c, n), enough of them to join what is linked.

    A block holds about ``block`` sets with ``elements`` elements together at most.  A family of one block has no need of
    pivots: its sets meet in one task."""
    sizes = family.groupBy("family").agg(F.ceil(F.greatest(F.count("*") / block, F.sum("n") / elements)).cast("int").alias("blocks"))
    own = F.pmod(F.xxhash64("key"), F.col("blocks")).cast("int")
    sets = family.join(sizes, "family").join(sets.select("key", "s"), "key").select("family", "key", "c", "n", "s", "blocks", own.alias("own"))
    sets = written(sets, "family-sets")
    wide, found = sets.where("blocks > 1"), None
    rest = sets.where("blocks = 1").select("key", F.col("key").alias("label"), F.lit(True).alias("out"))
    if not wide.isEmpty():
        labels = None
        for _ in range(rounds):
            links = written(pivot_links(wide, labels, t, pivots), "pivots")
            found = links if found is None else found.unionByName(links)
            labels = wide.select("family", "key").join(
                components(found).withColumnRenamed("id", "key"), "key", "left",
            ).select("family", "key", F.coalesce("component", "key").alias("label"))
            main = labels.groupBy("family", "label").agg(F.count("*").alias("size")).groupBy("family").agg(F.max_by("label", F.struct("size", "label")).alias("main"))
            labels = written(labels.join(main, "family").select("key", "label", (F.col("label") != F.col("main")).alias("out")), "labels")
            if labels.where("out").isEmpty():
                break
        rest = rest.unionByName(labels)
    within = outlier_links(sets.join(rest, "key"), t, block, elements)
    return within if found is None else within.unionByName(found)


def pivot_links(sets: DataFrame, labels: DataFrame | None, t: Threshold, pivots: int) -> DataFrame:
    """Links that join a family's sets as all links with its pivots do: of each of some parts (by hash) of the family, or of
    its outliers, the set in most frequent signatures."""
    part = F.pmod(F.xxhash64("key", F.lit(0 if labels is None else 1)), F.lit(pivots))
    from_ = sets if labels is None else sets.join(labels.where("out"), "key", "left_semi")
    chosen = from_.groupBy("family", part.alias("part")).agg(F.max_by("key", F.struct("c", "key")).alias("key"))
    # a family's few pivots go to each of its blocks, as one row
    few = sets.join(chosen.select("key"), "key", "left_semi").groupBy("family").agg(
        F.collect_list(F.struct("key", "s")).alias("pivots"), F.first("blocks").alias("blocks"),
    )
    few = few.select("family", "pivots", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("own"))

    def near(p: Column) -> Column:
        both = F.size(F.array_intersect(p["s"], F.col("s")))
        return t.den * both >= t.num * (F.size(p["s"]) + F.col("n") - both)

    met = sets.join(few, ["family", "own"]).select("key", F.array_sort(F.transform(F.filter("pivots", near), lambda p: p["key"])).alias("b"))
    # a set is linked to the least of its pivots; one set of all with the same pivots joins these
    met = written(met.where("size(b) > 0"), "met")
    joins = met.where("size(b) > 1").groupBy("b").agg(F.min("key").alias("a")).select("a", F.explode("b").alias("b"))
    return met.select(F.col("key").alias("a"), F.col("b")[0].alias("b")).unionByName(joins).where("a <> b")


def outlier_links(sets: DataFrame, t: Threshold, block: int, elements: int) -> DataFrame:
    """Links between outliers and sets of other labels (family, key, n, s, blocks, own, label, out): each block of a
    family's outliers meets each block of the family."""
    few = sets.where("out").groupBy("family").agg(F.ceil(F.greatest(F.count("*") / block, F.sum("n") / elements)).cast("int").alias("parts"))
    sets = sets.join(few, "family")
    every = F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("i")
    right = sets.select("family", every, F.col("own").alias("j"), "key", "label", "s", "out", F.lit(False).alias("left"))
    part = F.pmod(F.xxhash64("key", F.lit(2)), F.col("parts")).cast("int").alias("i")
    left = sets.where("out").select(
        "family", part, F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("j"), "key", "label", "s", "out",
        F.lit(True).alias("left"),
    )

    def run(table: pa.Table) -> pa.Table:
        key, old, left = table.column("key").to_numpy(), table.column("label").to_numpy(), table.column("left").to_numpy(zero_copy_only=False)
        s = table.column("s").combine_chunks()
        size = np.diff(s.offsets.to_numpy()).astype(np.int64)
        token, number = np.unique(s.flatten().to_numpy(), return_inverse=True)
        row = np.repeat(np.arange(len(key)), size)
        shared = np.bincount(number, minlength=len(token)) > 1
        place = np.cumsum(shared) - 1
        row, number = row[shared[number]], place[number[shared[number]]]
        width = -(-(int(shared.sum()) or 1) // 64) * 64
        ends = np.searchsorted(row, np.arange(len(key) + 1))
        bits = np.empty((len(key), width // 64), np.uint64)
        for i in range(0, len(key), 256):
            part = np.zeros((min(256, len(key) - i), width), np.uint8)
            span = slice(ends[i], ends[min(i + 256, len(key))])
            part[row[span] - i, number[span]] = 1
            bits[i : i + 256] = np.packbits(part, axis=1, bitorder="little").view(np.uint64)
        label, found = np.unique(old, return_inverse=True)[1], []
        right, out = np.flatnonzero(~left), table.column("out").to_numpy(zero_copy_only=False)
        out = out[right]
        for x in np.flatnonzero(left):
            # two outliers meet twice, once from either side: the one of smaller key does the work
            with_ = right[(~out | (key[right] > key[x])) & (label[right] != label[x]) & (t.den * np.minimum(size[right], size[x]) >= t.num * np.maximum(size[right], size[x]))]
            if not len(with_):
                continue
            both = np.bitwise_count(bits[with_] & bits[x]).sum(1, dtype=np.int64)
            for y in with_[t.den * both >= t.num * (size[with_] + size[x] - both)]:
                if label[y] != label[x]:
                    found.append((key[x], key[y]))
                    label[label == label[y]] = label[x]
        a, b = (np.array(x, np.int64) for x in zip(*found)) if found else (np.zeros(0, np.int64),) * 2
        return pa.table({"a": a, "b": b})

    return right.unionByName(left).groupBy("family", "i", "j").applyInArrow(run, "a long, b long")


def linked(docs: DataFrame, id_col: str = "doc_id", text: str = "text", t: Threshold = Threshold(), width: int = 4, **options) -> DataFrame:
    """Per row: id, n (size of its set), component (smallest id that links reach; the texts of one id are one document)."""
    nodes, reps, links = links_of(docs, id_col, text, t, width, **options)
    a, b = reps.select(F.col("key").alias("a"), F.col("id").alias("ia")), reps.select(F.col("key").alias("b"), F.col("id").alias("ib"))
    labels = components(links.join(a, "a").join(b, "b").select(F.col("ia").alias("a"), F.col("ib").alias("b")))
    label = reps.join(labels, "id", "left").select("key", F.coalesce("component", "id").alias("component"))
    out = nodes.join(label, "key", "left").select(
        "id", "n",
        F.when((F.col("n") > 0) & F.col("id").isNotNull(), F.col("component")).otherwise(F.col("id")).alias("component"),
    )
    return out.withColumnRenamed("id", id_col)


def one_of_each_group(
    docs: DataFrame, id_col: str = "doc_id", text: str = "text", t: Threshold = Threshold(), width: int = 4, **options,
) -> DataFrame:
    """The documents, with their columns, but of those that links join only one: the first by id, then by a hash of the text
    (of repeated rows one).  Two texts of one id are two documents.  Rows without id, and texts without words, stay."""
    nodes, reps, links = links_of(docs, id_col, text, t, width, **options)
    labels = components(links).withColumnRenamed("id", "key")
    known = nodes.where(F.col("id").isNotNull()).groupBy("id", "h").agg(F.first("key").alias("key"), F.first("n").alias("n"), F.count("*").alias("c"))
    known = written(known.join(labels, "key", "left").select("id", "h", "n", "c", F.coalesce("component", "key").alias("group")), "known")
    first = known.where("n > 0").groupBy("group").agg(F.min(F.struct("id", "h", "c")).alias("first")).select("first.*")
    loose = known.where("n = 0").select("id", "h", F.lit(1).cast("long").alias("c"))
    stay = written(first.unionByName(loose), "stay")
    # only documents that go, or come more than once, need to be looked up: the others aren't moved
    moved = known.select("id", "h").join(stay.where("c = 1").select("id", "h"), ["id", "h"], "left_anti")
    place = [F.col(id_col).cast("long").alias("id"), text_hash(text).alias("h")]
    rows = sieved(docs.where(F.col(id_col).isNotNull()).select(F.struct(*docs.columns).alias("row"), *place), moved, "id", "h")
    found = rows.where("hit").drop("hit").join(stay, ["id", "h"])
    once, again = found.where("c = 1"), found.where("c > 1").dropDuplicates(["id", "h"])
    kept = rows.where("not hit").select("row").unionByName(once.select("row")).unionByName(again.select("row"))
    return kept.select("row.*").unionByName(docs.where(F.col(id_col).isNull()))


def links_of(
    docs: DataFrame, id_col: str, text: str, t: Threshold, width: int, few: int = 16, per_bucket: int = 1_500_000,
    per_shingle: int = 9, room: int = 1 << 26,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(nodes, reps, links): the rows with their keys, an id for each key, and links between keys, enough to join all that
    are linked.  A pass's signatures take ``per_shingle`` bytes a shingle, or ``room`` bytes in all, at most."""
    sweep(docs)
    nodes = written(keyed(docs, id_col, text, t, width), "nodes")
    known = nodes.where("id is not null and n > 0")
    reps = written(
        known.groupBy("key").agg(F.min("id").alias("id"), F.first("n").alias("n"), F.first("band").alias("band"), F.first("steps").alias("steps")),
        "reps",
    )
    bands = {r.band: (r.n, r.steps) for r in reps.groupBy("band").agg(F.count("*").alias("n"), F.bit_and("steps").alias("steps")).collect()}
    # a set that is the smaller of a pair in the band above leaves out its empty segments, too: the larger one's count
    plan = {k: allocate(t, k, bands.get(k, (0, 0))[0] + bands.get(k - 1, (0, 0))[0], bands.get(k, (0, 0))[1]) if k in bands else None for b in bands for k in (b, b + 1)}
    entries = sum(n * sum(a.exact + a.deletion + (t.top(k) if a.deletion else 0) for k in (b, b + 1) if (a := plan[k])) for b, (n, _) in bands.items())
    shingles = reps.agg(F.sum("n")).first()[0] or 0
    passes = max(1, ceil(entries * ENTRY / max(room, per_shingle * shingles)))
    buckets = int(max(ceil(partitions(docs) / passes), entries // (passes * per_bucket)))
    texts = docs.where(F.col(id_col).isNotNull())
    parts = [
        written(candidates(dealt_signatures(texts, text, plan, t, width, buckets, few, turn, passes), t, few), "candidates")
        for turn in range(passes)
    ]
    found = reduce(DataFrame.unionByName, parts)
    pairs = written(found.where("b is not null").select("a", "b").distinct(), "pairs")
    groups = found.where("b is null").select("g", "band", "members")
    large = not groups.isEmpty()
    family = written(families(groups, plan).join(reps.select("key", "n"), "key"), "families") if large else None
    wanted = pairs.select(F.explode(F.array("a", "b")).alias("key"))
    wanted = (wanted.unionByName(family.select("key")) if large else wanted).distinct().join(reps.select("key", "id"), "key")
    sets = sets_of(docs, written(wanted, "wanted"), id_col, text, width)
    links = verified(pairs, sets, t)
    links = written(links.unionByName(family_links(family, sets, t)) if large else links, "joins")
    dropped(docs.sparkSession, *parts, pairs, sets, family)
    return nodes, reps, links
