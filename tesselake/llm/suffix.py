"""Removal of repeated byte strings by a distributed difference-cover suffix sort.

A byte goes if a string of ``width`` bytes that covers it also starts in a document with a smaller doc_id; strings
are judged on the input.  The steps:

1. The texts are dealt once, by a number of their row, to a bucketed table; all later joins bring their (small)
   side to it, so texts aren't shuffled again.  Equal texts are one string of the sort, with the smallest of their ids:
   from the other ids' rows all bytes go (if there are enough), by the same rule, as all their windows stand beside it.
2. Candidates.  The smallest of the 26-gram hashes in a 50-byte window depends on the window alone, so equal windows
   have equal smallest hashes.  These (about one in 13 bytes) are dealt to buckets in packed form; a window whose
   hash occurs in one text only can't repeat and is left out.  This loses nothing and leaves a small part of the input.
3. Dealing.  The windows left are dealt to buckets by their smallest 12-gram hash, again a function of the window
   alone, as stretches of text that hold neighbouring windows of one hash.  A stretch that documents of one batch share
   is written once: it takes part in the sort for the smallest of them, and goes from the others.
4. Difference-cover sort within each bucket: the suffixes at places 1 and 2 modulo 3 are sorted by triples of bytes
   and named; names of three names each are sorted and named in turn until they span the width (9, 27, 81 bytes:
   the recursion ends where prefixes are long enough); the places 0 modulo 3 are sorted by their first byte and the rank
   behind it, and merged with the others by the usual comparisons.  Neighbours in the merged order are compared
   over ``width`` bytes: a run of equal prefixes is a repeated string, which goes from all but its smallest document.
5. The spans to remove are gathered by blocks of documents and cut out of the texts of the documents concerned.

Buckets are as many as keep one to about ``bucket_bytes`` of text, at any size of the input; one with more than ``most``
bytes of stretches is sorted in parts (by the hash that deals them), one at a time.

Null texts count as empty.  Rows with one doc_id don't remove each other's strings.  Rows without doc_id keep all
bytes and take none from others.  An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import StructType

from .common import bucketed, dropped, mix64, partitions, small_batches, sweep, written

U = np.uint64
BYTE = mix64(np.arange(1, 257, dtype=np.uint64) * U(0xD1B54A32D192ED03))
ODD = [U(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB)]


def gram_hashes(a: np.ndarray, k: int) -> np.ndarray:
    """Hashes of all k-grams, put together from those of 1, 2, 4, ... bytes."""
    powers = [BYTE[a]]
    while 2 << (len(powers) - 1) <= k:
        h, step = powers[-1], 1 << (len(powers) - 1)
        powers.append(h[:-step] * ODD[len(powers)] + h[step:])
    n, out, at = len(a) - k + 1, None, 0
    for i in range(len(powers) - 1, -1, -1):
        if k >> i & 1:
            part = powers[i][at : at + n]
            out = part.copy() if out is None else out * ODD[0] + part
            at += 1 << i
    return mix64(out)


def sliding_min(h: np.ndarray, w: int) -> np.ndarray:
    step = 1
    while 2 * step <= w:
        h = np.minimum(h[:-step], h[step:])
        step *= 2
    return np.minimum(h[: len(h) - (w - step)], h[w - step :]) if w > step else h


def window_keys(a: np.ndarray, width: int, k: int) -> np.ndarray:
    """For each start of a ``width``-byte window the smallest hash of its k-grams."""
    if len(a) < width:
        return np.zeros(0, np.uint64)
    return sliding_min(gram_hashes(a, k), width - k + 1)


def run_starts(v: np.ndarray) -> np.ndarray:
    return np.flatnonzero(np.concatenate([[True], v[1:] != v[:-1]])) if len(v) else np.zeros(0, int)


def named(columns: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Ranks of tuples (equal tuples have equal ranks), and an order that sorts them."""
    key, bits = columns[0].astype(np.uint64), int(columns[0].max()).bit_length() if len(columns[0]) else 0
    for c in columns[1:]:
        own = max(1, int(c.max()).bit_length())
        if bits + own > 64:
            key, _ = named([key])
            key, bits = key.astype(np.uint64), int(key.max()).bit_length()
        key = (key << U(own)) | c.astype(np.uint64)
        bits += own
    order = np.argsort(key, kind="stable")
    rank = np.empty(len(key), np.int64)
    found = key[order]
    rank[order] = np.cumsum(np.concatenate([[0], found[1:] != found[:-1]])) if len(key) else 0
    return rank, order


def shifted(x: np.ndarray, by: int) -> np.ndarray:
    """x from place ``by`` on, filled with 0."""
    return np.concatenate([x[by:], np.zeros(min(by, len(x)), x.dtype)])


def difference_cover_order(text: np.ndarray, reach: int) -> np.ndarray:
    """All places of ``text`` (codes from 0 to 255), ordered so that those whose first ``reach`` bytes are equal
    stand together and the order of those prefixes is kept."""
    n = len(text)
    if n < 3:
        return np.array(sorted(range(n), key=lambda i: text[i:].tobytes()), np.int64)
    t = text.astype(np.int64) + 1
    t = np.unique(t, return_inverse=True)[1].astype(np.int64) + 1  # dense codes from 1, 0 is the end
    t = np.concatenate([t, np.zeros(3, np.int64)])
    places = np.concatenate([np.arange(1, n + 1, 3), np.arange(2, n + 1, 3)])  # the sample, as the string of names reads it
    half = len(np.arange(1, n + 1, 3))
    width = int(t.max()).bit_length()
    name, span = (t[places] << (2 * width)) | (t[np.minimum(places + 1, n + 2)] << width) | t[np.minimum(places + 2, n + 2)], 3
    rank = None
    while span < reach or rank is None:
        # three names in a row of the same residue make the next name
        one, two = name[:half], name[half:]
        step = span // 3  # places of one residue between a name and the one that continues it
        follow = [np.concatenate([shifted(one, i), shifted(two, i)]) for i in (step, 2 * step)]
        rank, order = named([name, *follow])
        name, span = rank + 1, span * 3
        if int(rank.max(initial=0)) + 1 == len(rank):
            break
    # a strict order of the sample; ties (equal over ``span`` bytes) fall as they come
    strict = np.empty(len(order), np.int64)
    strict[order] = np.arange(1, len(order) + 1)
    level = np.zeros(n + 4, np.int64)
    level[places] = rank + 1
    rest = np.arange(0, n, 3)
    big = int(level.max()).bit_length()
    _, by = named([t[rest], level[rest + 1]])
    rest = rest[by]
    order = order[places[order] < n]
    sample = places[order]
    ones, twos = sample[sample % 3 == 1], sample[sample % 3 == 2]
    key1 = lambda x: (t[x] << big) | level[x + 1]
    key2 = lambda x: (((t[x] << width) | t[x + 1]) << big) | level[x + 2]
    # the sampled places before each of the rest: two sorted lists each
    before = np.searchsorted(key1(ones), key1(rest)) + np.searchsorted(key2(twos), key2(rest))
    before = np.maximum.accumulate(before)  # within ties the lists are in any order
    out = np.empty(n, np.int64)
    at = before + np.arange(len(rest))
    taken = np.zeros(n, bool)
    taken[at] = True
    out[at] = rest
    out[~taken] = sample
    return out


def repeated(contexts: list[bytes], starts: list[int], width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(context, offset, class) of the first ``starts`` windows of each context; equal windows have one class."""
    lengths = np.array([len(c) for c in contexts])
    text = np.frombuffer(b"".join(contexts), np.uint8)
    base = np.cumsum(lengths) - lengths
    wanted = np.zeros(len(text), bool)
    owner = np.repeat(np.arange(len(contexts)), starts)
    offset = np.arange(len(owner)) - np.repeat(np.cumsum(starts) - starts, starts)
    wanted[base[owner] + offset] = True
    number = np.zeros(len(text), np.int64)
    number[base[owner] + offset] = np.arange(len(owner))
    order = difference_cover_order(text, width)
    order = order[wanted[order]]
    view = np.lib.stride_tricks.sliding_window_view(text, width)
    same = np.zeros(len(order), bool)
    for i in range(1, len(order), 1 << 18):
        here = order[i : i + (1 << 18)]
        same[i : i + (1 << 18)] = (view[here] == view[order[i - 1 : i - 1 + len(here)]]).all(1)
    klass = np.cumsum(~same) - 1
    out = np.empty(len(order), np.int64)
    out[number[order]] = klass
    return owner, offset, out


def bucket_of(h: np.ndarray, buckets: int) -> np.ndarray:
    return ((mix64(h) >> U(32)) * U(buckets)) >> U(32)


def packed6(h: np.ndarray) -> bytes:
    return h.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6].tobytes()


def unpacked6(raw: bytes) -> np.ndarray:
    a = np.frombuffer(raw, np.uint8).reshape(-1, 6)
    wide = np.zeros((len(a), 8), np.uint8)
    wide[:, :6] = a
    return wide.view(np.uint64).ravel()


LOW48 = U((1 << 48) - 1)


def raw_texts(batch: pa.RecordBatch, name: str = "t") -> list[bytes]:
    return [b"" if x is None else x for x in batch.column(name).cast(pa.binary()).to_pylist()]


def candidate_hashes(texts: DataFrame, width: int, k: int, buckets: int) -> DataFrame:
    """Step 2, dealing: distinct window hashes of each text (row, t), packed by bucket.

    A hash that texts of one batch share is known to repeat: a bucket gets two entries of it from a batch at most, the
    others go, dealt by batch, to buckets below 0."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in small_batches(batches, 4 << 20):
            keys, hashes, counts = b.column("row").to_pylist(), [], []
            for raw in raw_texts(b):
                v = window_keys(np.frombuffer(raw, np.uint8), width, k)
                hashes.append(np.unique(v[run_starts(v)]))
                counts.append(len(hashes[-1]))
            if not keys:
                continue
            h, who = np.concatenate(hashes), np.repeat(np.arange(len(keys)), counts)
            order = np.argsort(h, kind="stable")
            h, who = h[order], who[order]
            keys_, rows = np.array(keys, np.int64), []
            first = run_starts(h)
            sure = np.arange(len(h)) - np.repeat(first, np.diff(np.append(first, len(h)))) > 1
            if sure.any():
                # two texts of this batch share it: two entries tell the bucket so, the others need not go there
                rows.append((-1 - keys[0] % buckets, packed6(h[sure]), None, keys_[who[sure]].tobytes()))
                h, who = h[~sure], who[~sure]
            bucket = bucket_of(h, buckets)
            order = np.argsort(bucket, kind="stable")
            h, who = h[order], who[order]
            at = np.searchsorted(bucket[order], np.arange(buckets + 1, dtype=np.uint64))
            for i in range(buckets):
                if at[i] < at[i + 1]:
                    used, local = np.unique(who[at[i] : at[i + 1]], return_inverse=True)
                    rows.append((i, packed6(h[at[i] : at[i + 1]]), local.astype(np.uint16 if len(used) < 65536 else np.uint32).tobytes(), keys_[used].tobytes()))
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, kind) for c, kind in zip(zip(*rows), (pa.int32(), *[pa.binary()] * 3))],
                names=["bucket", "h", "local", "keys"],
            )

    return texts.select("row", "t").mapInArrow(run, "bucket int, h binary, local binary, keys binary")


def repeated_hashes(dealt: DataFrame, blocks: int) -> DataFrame:
    """Step 2, judging: (block, keys, hashes) packed, of the hashes that occur in two texts or more."""

    def run(table: pa.Table) -> pa.Table:
        h, key = [], []
        for r in table.to_pylist():
            own = unpacked6(r["h"])
            h.append(own)
            keys = np.frombuffer(r["keys"], np.int64)
            key.append(keys if r["local"] is None else keys[np.frombuffer(r["local"], np.uint16 if len(r["local"]) == 2 * len(own) else np.uint32)])
        h, key = np.concatenate(h), np.concatenate(key)
        if table.column("bucket")[0].as_py() >= 0:
            order = np.argsort(h, kind="stable")
            h, key = h[order], key[order]
            first = run_starts(h)
            low, high = np.minimum.reduceat(key, first), np.maximum.reduceat(key, first)
            keep = np.repeat(low < high, np.diff(np.append(first, len(h))))
            h, key = h[keep], key[keep]
        block = key % blocks
        order = np.argsort(block, kind="stable")
        at = np.searchsorted(block[order], np.arange(blocks + 1))
        rows = [(i, key[order[at[i] : at[i + 1]]].tobytes(), packed6(h[order[at[i] : at[i + 1]]])) for i in range(blocks) if at[i] < at[i + 1]]
        columns = list(zip(*rows)) if rows else [()] * 3
        return pa.table({"block": pa.array(columns[0], pa.int32()), "keys": pa.array(columns[1], pa.binary()), "h": pa.array(columns[2], pa.binary())})

    found = dealt.groupBy("bucket").applyInArrow(run, "block int, keys binary, h binary")

    def by_key(table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        key, h = np.concatenate([np.frombuffer(r["keys"], np.int64) for r in rows]), np.concatenate([unpacked6(r["h"]) for r in rows])
        order = np.lexsort((h, key))
        key, h = key[order], h[order]
        first = run_starts(key)
        ends = np.append(first, len(key))
        return pa.table({"row": pa.array(key[first]), "h": pa.array([packed6(np.unique(h[ends[i] : ends[i + 1]])) for i in range(len(first))], pa.binary())})

    return found.groupBy("block").applyInArrow(by_key, "row long, h binary")


def stretches(suspects: DataFrame, width: int, k: int, deal: int, buckets: int) -> DataFrame:
    """Step 3: stretches of neighbouring candidate windows with one smallest ``deal``-gram hash, packed by bucket.

    A stretch is written once per row, with a list of where it occurs.  Of the documents of a batch that share one only the
    smallest is in question: the others' spans are settled and go, dealt by batch, to buckets below 0."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in small_batches(batches, 2 << 20):
            found: dict[int, tuple[dict[tuple[bytes, int], int], list[tuple[int, int, int]]]] = {}
            docs, uids = b.column("id").to_pylist(), b.column("row").to_pylist()
            for d, (raw, wanted) in enumerate(zip(raw_texts(b), b.column("h").to_pylist())):
                a = np.frombuffer(raw, np.uint8)
                v = window_keys(a, width, k)
                first = run_starts(v)
                live = np.repeat(np.isin(v[first] & LOW48, unpacked6(wanted)), np.diff(np.append(first, len(v))))
                m = window_keys(a, width, deal)
                cut = np.flatnonzero(np.concatenate([[True], (m[1:] != m[:-1]) | (live[1:] != live[:-1])]))
                ends = np.append(cut[1:], len(m))
                keep = live[cut]
                for s, e, g in zip(cut[keep].tolist(), ends[keep].tolist(), bucket_of(m[cut[keep]], buckets).tolist()):
                    known, places = found.setdefault(g, ({}, []))
                    places.append((known.setdefault((raw[s : e + width - 1], e - s), len(known)), d, s))
            rows, sure = [], []
            ids, uids = np.array(docs, np.int64), np.array(uids, np.int64)
            for g, (known, places) in found.items():
                c, d, s = np.array(places, np.int64).T
                lengths, least = np.array([len(x) for x, _ in known], np.uint32), np.full(len(known), np.iinfo(np.int64).max)
                np.minimum.at(least, c, ids[d])
                goes = ids[d] > least[c]  # an earlier document of this batch has the whole stretch
                sure.append((uids[d[goes]], s[goes], s[goes] + lengths[c[goes]]))
                c, d, s = c[~goes], d[~goes], s[~goes]
                used, local = np.unique(d, return_inverse=True)
                rows.append((g, b"".join(x for x, _ in known), lengths.tobytes(), np.array([w for _, w in known], np.uint32).tobytes(), c.astype(np.uint32).tobytes(), local.astype(np.uint32).tobytes(), s.astype(np.uint32).tobytes(), ids[used].tobytes(), uids[used].tobytes()))
            if sure and sum(len(x[0]) for x in sure):
                u, start, end = map(np.concatenate, zip(*sure))
                rows.append((-1 - int(u[0]) % buckets, None, end.astype(np.uint32).tobytes(), None, None, None, start.astype(np.uint32).tobytes(), None, u.tobytes()))
            columns = list(zip(*rows)) if rows else [()] * 9
            yield pa.RecordBatch.from_arrays(
                [pa.array(x, kind) for x, kind in zip(columns, (pa.int32(), *[pa.binary()] * 8))],
                names=["bucket", "text", "lengths", "starts", "context", "local", "place", "docs", "uids"],
            )

    return suspects.mapInArrow(
        run,
        "bucket int, text binary, lengths binary, starts binary, context binary, local binary, place binary, docs binary, uids binary",
    )


def judged(dealt: DataFrame, width: int, blocks: int, most: int = 1_000_000) -> DataFrame:
    """Step 4: (row, cuts), the spans that go from each suspect."""

    def spans(
        contexts: list[tuple[bytes, int]], context: np.ndarray, doc: np.ndarray, uid: np.ndarray, place: np.ndarray,
    ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        starts = np.array([w for _, w in contexts])
        least = np.full(len(contexts), np.iinfo(np.int64).max)
        np.minimum.at(least, context, doc)
        owner, offset, klass = repeated([x for x, _ in contexts], starts, width)
        order = np.argsort(klass, kind="stable")
        best = np.minimum.reduceat(least[owner][order], run_starts(klass[order]))[klass] if len(klass) else klass
        # runs of windows with one smallest document within a context
        cut = np.flatnonzero(np.concatenate([[True], (owner[1:] != owner[:-1]) | (best[1:] != best[:-1])]))
        ends = np.append(cut[1:], len(owner))
        run_owner, run_best, a, b = owner[cut], best[cut], offset[cut], offset[ends - 1] + width
        # each occurrence of a context with each of its runs
        first = np.searchsorted(run_owner, np.arange(len(contexts) + 1))
        count = (first[1:] - first[:-1])[context]
        occurrence = np.repeat(np.arange(len(context)), count)
        run = first[context][occurrence] + np.arange(len(occurrence)) - np.repeat(np.cumsum(count) - count, count)
        goes = run_best[run] < doc[occurrence]
        occurrence, run = occurrence[goes], run[goes]
        return uid[occurrence], place[occurrence] + a[run], place[occurrence] + b[run]

    def judge(table: pa.Table) -> pa.Table:
        if table.column("bucket")[0].as_py() < 0:
            rows = table.to_pylist()
            return shaped(*(np.concatenate([np.frombuffer(r[n], kind) for r in rows]).astype(np.int64) for n, kind in (("uids", np.int64), ("place", np.uint32), ("lengths", np.uint32))))
        contexts: dict[tuple[bytes, int], int] = {}
        context, doc, uid, place = [], [], [], []
        for r in table.to_pylist():
            lengths, starts = np.frombuffer(r["lengths"], np.uint32).tolist(), np.frombuffer(r["starts"], np.uint32).tolist()
            at, numbers = 0, []
            for n, w in zip(lengths, starts):
                numbers.append(contexts.setdefault((r["text"][at : at + n], w), len(contexts)))
                at += n
            context.append(np.array(numbers)[np.frombuffer(r["context"], np.uint32)])
            local = np.frombuffer(r["local"], np.uint32)
            doc.append(np.frombuffer(r["docs"], np.int64)[local])
            uid.append(np.frombuffer(r["uids"], np.int64)[local])
            place.append(np.frombuffer(r["place"], np.uint32).astype(np.int64))
        context, doc, uid, place = map(np.concatenate, (context, doc, uid, place))
        known = list(contexts)
        # equal windows have equal deal hashes: the bucket may be judged in parts by them
        total = sum(len(x) for x, _ in known)
        parts = -(-total // most)
        out = []
        if parts == 1:
            out.append(spans(known, context, doc, uid, place))
        else:
            part = np.array([int(window_keys(np.frombuffer(x[: width], np.uint8), width, DEAL)[0] % U(parts)) for x, _ in known])
            for p in range(parts):
                own = np.flatnonzero(part == p)
                if len(own):
                    number = np.full(len(known), -1)
                    number[own] = np.arange(len(own))
                    here = part[context] == p
                    out.append(spans([known[i] for i in own], number[context[here]], doc[here], uid[here], place[here]))
        return shaped(*(np.concatenate(x) for x in zip(*out)))

    def shaped(d: np.ndarray, a: np.ndarray, b: np.ndarray) -> pa.Table:
        block = np.mod(d, blocks)
        order = np.lexsort((a, d, block))
        d, a, b, block = d[order], a[order], b[order], block[order]
        at = np.searchsorted(block, np.arange(blocks + 1))
        rows = [(i, d[at[i] : at[i + 1]].tobytes(), a[at[i] : at[i + 1]].astype(np.uint32).tobytes(), b[at[i] : at[i + 1]].astype(np.uint32).tobytes()) for i in range(blocks) if at[i] < at[i + 1]]
        columns = list(zip(*rows)) if rows else [()] * 4
        return pa.table({n: pa.array(c, kind) for n, c, kind in zip(("block", "docs", "from", "to"), columns, (pa.int32(), *[pa.binary()] * 3))})

    found = dealt.groupBy("bucket").applyInArrow(judge, "block int, docs binary, from binary, to binary")

    def gather(table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        d = np.concatenate([np.frombuffer(r["docs"], np.int64) for r in rows])
        a, b = (np.concatenate([np.frombuffer(r[n], np.uint32) for r in rows]).astype(np.int64) for n in ("from", "to"))
        order = np.lexsort((a, d))
        d, a, b = d[order], a[order], b[order]
        ends = np.append(first := run_starts(d), len(d))
        ids, cuts = [], []
        for i, j in zip(ends[:-1], ends[1:]):
            reach = np.maximum.accumulate(b[i:j])
            new = np.concatenate([[True], a[i + 1 : j] > reach[:-1]])
            at = np.flatnonzero(new)
            ids.append(int(d[i]))
            cuts.append(np.stack([a[i:j][at], np.append(reach[at[1:] - 1], reach[-1])], 1).ravel().tolist())
        return pa.table({"row": pa.array(ids, pa.int64()), "cuts": pa.array(cuts, pa.list_(pa.int64()))})

    return found.groupBy("block").applyInArrow(gather, "row long, cuts array<bigint>")


DEAL = 12


def removals(
    docs: DataFrame, id_col: str = "doc_id", text: str = "text", keep: list[str] | None = None, width: int = 50,
    k: int = 26, bucket_bytes: int = 16 << 20, most: int = 1_000_000,
) -> DataFrame:
    """Per row id, t (bytes), the columns ``keep`` as c0, c1, ..., whole (it goes wholly) and cuts (the spans that go, null for none)."""
    sweep(docs)
    t = F.encode(F.coalesce(text, F.lit("")), "utf-8")
    rows = docs.select(
        F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("long").alias("id"), t.alias("t"),
        *[F.col(c).alias(f"c{i}") for i, c in enumerate(keep or [])],
    )
    n = partitions(docs)
    rows = bucketed(rows.withColumn("sha", F.unhex(F.sha2("t", 256))).withColumn("n", F.octet_length("t").cast("long")), "texts", "row", n)
    total = rows.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    buckets = int(max(n, total // bucket_bytes))
    facts = rows.where(F.col("id").isNotNull() & (F.col("n") >= width)).select("row", "id", "sha")
    # the first row of each text; row numbers only break ties between repeated rows
    reps = facts.groupBy("sha").agg(F.min(F.struct("id", "row")).alias("first")).select(
        "sha", F.col("first.id").alias("least"), F.col("first.row").alias("rep"),
    )
    reps = written(reps, "reps")  # else its shuffle would be the join's, whose large keys Spark could then not split
    facts = written(facts.join(reps, "sha").select("row", "rep", (F.col("id") > F.col("least")).alias("whole")), "facts")
    texts = rows.join(facts.where("row = rep").select("row").hint("shuffle_hash"), "row", "left_semi")
    hashes = written(repeated_hashes(candidate_hashes(texts, width, k, buckets), buckets), "hashes")
    suspects = rows.select("row", "id", "t").join(hashes.hint("shuffle_hash"), "row")
    cuts = written(judged(stretches(suspects, width, k, DEAL, buckets), width, buckets, most), "cuts")
    dropped(docs.sparkSession, hashes)
    none = F.lit(None).cast("array<bigint>")
    verdicts = facts.where("whole").select("row", "whole", none.alias("cuts")).unionByName(facts.where("not whole").join(cuts.withColumnRenamed("row", "rep"), "rep").select("row", "whole", "cuts"))
    return rows.join(verdicts.hint("shuffle_hash"), "row", "left").withColumn("whole", F.coalesce("whole", F.lit(False))).drop("row")


def cut_out(raw: bytes, cuts: list[int]) -> bytes:
    out, at = [], 0
    for a, b in zip(cuts[::2], cuts[1::2]):
        out.append(raw[at:a])
        at = b
    return b"".join([*out, raw[at:]])


def shortened(found: DataFrame, as_text: bool = False) -> DataFrame:
    """Removals with t as what is left of it (as text: without the rests of characters that a cut went through),
    n_removed and n_spans."""
    columns = [f for f in found.schema if f.name not in ("t", "whole", "cuts")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in small_batches(batches, 4 << 20):
            texts, cuts = raw_texts(b), b.column("cuts").to_pylist()
            cuts = [[0, len(t)] if whole else c or [] for t, whole, c in zip(texts, b.column("whole").to_pylist(), cuts)]
            kept = [cut_out(t, c) for t, c in zip(texts, cuts)]
            kept = pa.array([t.decode("utf-8", "ignore") for t in kept], pa.string()) if as_text else pa.array(kept, pa.binary())
            removed, spans = ([sum(c[1::2]) - sum(c[::2]) for c in cuts], [len(c) // 2 for c in cuts])
            yield pa.RecordBatch.from_arrays(
                [*[b.column(f.name) for f in columns], kept, pa.array(removed, pa.int64()), pa.array(spans, pa.int64())],
                names=[*[f.name for f in columns], "t", "n_removed", "n_spans"],
            )

    kind = StructType(list(columns)).add("t", "string" if as_text else "binary").add("n_removed", "long").add("n_spans", "long")
    return found.mapInArrow(run, kind)


def deduplicated(docs: DataFrame, **options) -> DataFrame:
    """Per row id, n_bytes, n_removed, n_spans, kept_sha256, and ``kept`` (bytes), what is left of the text."""
    out = shortened(removals(docs, **options))
    return out.select("id", F.col("n").alias("n_bytes"), "n_removed", "n_spans", F.sha2("t", 256).alias("kept_sha256"), F.col("t").alias("kept"))


def without_repeats(docs: DataFrame, text: str = "text", **options) -> DataFrame:
    """The documents, with their columns, without the repeated strings in ``text``; those of which nothing is left go.

    Of a character that a cut went through the rest goes, too.  Texts that lose nothing stay as they are, null ones null."""
    others = [c for c in docs.columns if c != text]
    null = free_name(docs)
    out = shortened(removals(docs.withColumn(null, F.col(text).isNull()), text=text, keep=[*others, null], **options), as_text=True)
    out = out.where("n_removed = 0 or t <> ''").withColumn("t", F.when(~F.col(f"c{len(others)}"), F.col("t")))
    return out.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(others)], F.col("t").alias(text)).select(*docs.columns)


def free_name(docs: DataFrame) -> str:
    """A column name that docs doesn't have."""
    return "_" * (1 + max((len(c) for c in docs.columns), default=0))
