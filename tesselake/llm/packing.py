"""Hierarchical best-fit packing of tokenised documents into sequences.

Each document is tokenised once, whole, in a narrow stage that returns only piece records (document, place,
length, CRC of the ids); token ids never enter a shuffle.  Full pieces are sequences of their own.  The others
are dealt to partitions of about ``per_task``, each with its share of every size, and packed best-fit in decreasing
order there; nearly full bins are emitted at once,
underfull bins go on as items to a tree of further rounds, in each of which the bins of ``fan`` partitions are merged
and best-fit packed again, until one partition is left.

Upper tasks stay bounded without a cap that costs anything.  Of two bins of one best-fit task at most one is half full
or less, as otherwise they would share a bin; and a fuller bin can only take in such a small one.  So if a round has left s
small bins in all, no more than s bins of one fill can ever be used, and none with less room than the least of
them: a task passes on its small bin, and s bins of each fill with that much room.  What is left is closed as it
is, as it would be at the end.  With no small bin left, or a single one and nothing that has room for it, all is closed.

Null texts count as empty: a document of the end id alone.  Repeated rows are packed each for itself and share
their doc_id; rows without doc_id are packed like others.  An empty table gives no rows.
"""

from __future__ import annotations

import json
import re
import unicodedata
import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from .common import small_batches, sweep, texts_of, written

CAPACITY, END = 4096, 1
ITEM = "doc_id long, piece int, start long, length long, ids_crc32 long"


@lru_cache
def tokenizer(path: str):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


#: The normaliser and the splitting that ``Encoder`` knows how to follow chunk by chunk.
NORMALIZERS = [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]
SPLIT = "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"


def by_chunks(path: str) -> bool:
    """Whether the tokenizer's ids are those of its blank-free chunks in turn, with ends marked on the last of a word."""
    t = json.loads(tokenizer(path).to_str())
    split = (t["pre_tokenizer"] or {}).get("pretokenizers", [{}])
    return (
        (t["normalizer"] or {}).get("normalizers") == NORMALIZERS
        and len(split) == 2 and split[0].get("pattern") == {"Regex": SPLIT} and split[0].get("invert") and split[0].get("behavior") == "Removed"
        and split[1].get("type") == "ByteLevel" and not split[1].get("use_regex") and not split[1].get("add_prefix_space")
        and t["model"]["type"] == "BPE" and t["model"]["end_of_word_suffix"] == "</w>" and not t["model"]["dropout"]
        and not any(a["content"] != a["content"].strip() or " " in a["content"] or a["lstrip"] or a["rstrip"] for a in t["added_tokens"])
    )


#: A word of Latin letters with other signs behind it: the tokenizer splits between the two (an apostrophe may
#: start one of its contractions, so it isn't among the signs).
WORD = re.compile(r"([a-zß-öø-ÿ]+)([!-&(-/:-@\[-^`{-~]*)")


class Encoder:
    """Ids of whole texts, as the tokenizer gives them; its work on a blank-free chunk is remembered.

    The tokenizer drops white space and never joins across it, so a text's ids are its chunks' ids in turn.
    It lowers its input, so that lowering first changes nothing where both forms are composed (NFC; but for the
    capital sigma, whose small form depends on its place).  A tokenizer of another make encodes whole texts."""

    def __init__(self, path: str, most: int = 1_000_000):
        self.tokenizer, self.known, self.most, self.chunks = tokenizer(path), {"": b""}, most, by_chunks(path)
        self.kind = np.uint16 if self.tokenizer.get_vocab_size() <= 1 << 16 else np.uint32
        self.ends = np.zeros(self.tokenizer.get_vocab_size(), bool)
        for token, i in self.tokenizer.get_vocab().items():
            self.ends[i] = token.endswith("</w>")

    def whole(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, self.kind)

    def learn(self, chunks: set[str]) -> None:
        """Remember new chunks; words are tokenised many at a time and told apart by their ends."""
        known, split = self.known, [m for c in chunks if (m := WORD.fullmatch(c))]
        heads, tails = [m[1] for m in split], [m[2] for m in split]
        words = list({*heads, *tails} - known.keys())
        for i in range(0, len(words), 2000):
            own = words[i : i + 2000]
            ids = self.whole(" ".join(own))
            stops = ((np.flatnonzero(self.ends[ids]) + 1) * ids.itemsize).tolist()
            if len(stops) == len(own):
                raw = ids.tobytes()
                known.update(zip(own, [raw[a:b] for a, b in zip([0, *stops], stops)]))
            else:
                known.update((w, self.whole(w).tobytes()) for w in own)
        known.update([(m[0], known[a] + known[b]) for m, a, b in zip(split, heads, tails) if b])
        known.update((c, self.whole(c).tobytes()) for c in chunks if c not in known)

    def lower(self, text: str) -> str:
        low = text.lower()
        return low if text.isascii() or unicodedata.is_normalized("NFC", text) and unicodedata.is_normalized("NFC", low) else text

    def batch(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts in turn, and where each text's begin (one entry more than texts).

        Arrow splits the texts and numbers their distinct chunks; only those are looked up one by one."""
        if not self.chunks:
            found = [self.whole(t) for t in texts]
            return np.concatenate([np.zeros(0, np.uint32), *found]).astype(np.uint32), np.concatenate([[0], np.cumsum([len(x) for x in found])]).astype(np.int64)
        if len(self.known) > self.most:
            self.known = {"": b""}
        split = pc.ascii_split_whitespace(pa.array([t if "\u03a3" in t else self.lower(t) for t in texts], pa.large_string()))
        coded = split.flatten().dictionary_encode()
        distinct = coded.dictionary.to_pylist()
        if new := set(distinct) - self.known.keys():
            self.learn(new)
        found = list(map(self.known.__getitem__, distinct))
        size = np.fromiter(map(len, found), np.int64, len(found)) // np.dtype(self.kind).itemsize
        start = np.cumsum(size) - size
        ids = np.frombuffer(b"".join(found), self.kind)
        which = coded.indices.to_numpy(zero_copy_only=False)
        count = size[which]
        ends = np.concatenate([[0], np.cumsum(count)])
        places = np.repeat(start[which] - ends[:-1], count) + np.arange(ends[-1])
        return ids[places].astype(np.uint32), ends[np.asarray(split.offsets)]


@lru_cache
def encoder(path: str) -> Encoder:
    return Encoder(path)


def pieces(docs: DataFrame, path: str, capacity: int = CAPACITY, end: int = END, block_bytes: int = 8 << 20) -> DataFrame:
    """A row per piece of each document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path)
        for b in small_batches(batches, block_bytes):
            rows = []
            flat, at = enc.batch(texts_of(b))
            for doc, i, j in zip(b.column("doc_id").to_pylist(), at[:-1].tolist(), at[1:].tolist()):
                ids = np.append(flat[i:j], np.uint32(end)).astype("<u4")
                rows += [(doc, k, s, len(x := ids[s : s + capacity]), zlib.crc32(x.tobytes())) for k, s in enumerate(range(0, len(ids), capacity))]
            columns = list(zip(*rows)) if rows else [()] * 5
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds)],
                names=["doc_id", "piece", "start", "length", "ids_crc32"],
            )

    return docs.select("doc_id", "text").mapInArrow(run, ITEM)


def best_fit(sizes: list[int], capacity: int) -> list[list[int]]:
    """Best-fit of items in the given order; bins as lists of item numbers."""
    bins: list[list[int]] = []
    rooms: list[tuple[int, int]] = []  # (room, bin), sorted
    for i, size in enumerate(sizes):
        at = bisect_left(rooms, (size, -1))
        if at < len(rooms):
            room, k = rooms.pop(at)
            bins[k].append(i)
        else:
            room, k = capacity, len(bins)
            bins.append([i])
        if room > size:
            insort(rooms, (room - size, k))
    return bins


BIN = "fill long, members array<struct<doc_id:bigint,piece:int,start:bigint,length:bigint,ids_crc32:bigint>>, nth long, task long, sequence_id long"


def pack_round(bins: DataFrame, number: int, capacity: int) -> DataFrame:
    """One best-fit round within each partition.  nth counts a task's bins of one fill."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId()
        rows = pa.Table.from_batches(batches) if (batches := list(batches)) else None
        if rows is None or not rows.num_rows:
            return
        fill, members = rows.column("fill").to_numpy(), rows.column("members").combine_chunks()
        flat, begin = members.flatten(), members.offsets.to_numpy() - members.offsets[0].as_py()
        first = [flat.field(n).fill_null(-1).to_numpy()[begin[:-1]] for n in ("doc_id", "piece", "ids_crc32")]
        order = np.lexsort((*reversed(first), -fill))
        packed = best_fit(fill[order].tolist(), capacity)
        taken = order[np.fromiter((i for b in packed for i in b), np.int64, len(order))]
        ends = np.cumsum([len(b) for b in packed])
        total = np.diff(np.cumsum(fill[taken])[ends - 1], prepend=0)
        # the members of the bins' items in turn: moved as Arrow arrays, never as Python objects
        size = np.diff(begin)[taken]
        stop = np.cumsum(size)
        flat = flat.take(pa.array(np.repeat(begin[taken] - (stop - size), size) + np.arange(stop[-1])))
        offsets = np.concatenate([[0], stop[ends - 1]])
        by_fill = np.argsort(total, kind="stable")
        start = np.flatnonzero(np.diff(total[by_fill], prepend=-1))
        nth = np.empty(len(total), np.int64)
        nth[by_fill] = np.arange(len(total)) - np.repeat(start, np.diff(np.append(start, len(total))))
        table = pa.table({
            "fill": total, "members": pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), flat), "nth": nth,
            "task": np.full(len(total), task), "sequence_id": (number << 56) + (task << 32) + np.arange(len(total)),
        })
        yield from table.to_batches(max_chunksize=10_000)

    return bins.mapInArrow(run, BIN)


def pack(items: DataFrame, capacity: int = CAPACITY, nearly: float = 0.998, fan: int = 8, per_task: int = 10_000) -> DataFrame:
    """The items of ``pieces`` with sequence_id and offset, by rounds of best-fit over a tree of partitions."""
    sweep(items)
    items = written(items, "pieces")
    whole = items.where(F.col("length") >= capacity).withColumn("sequence_id", -1 - F.monotonically_increasing_id()).withColumn("offset", F.lit(0).cast("long"))
    one = F.struct("doc_id", "piece", "start", "length", "ids_crc32")
    bins = items.where(F.col("length") < capacity).select(F.col("length").alias("fill"), F.array(one).alias("members"))
    n = max(1, -(-bins.count() // per_task))
    closed, number = [], 1
    # in turn by size, whatever their ids: each task gets its share of every size, and repeated rows don't gather
    place = F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1) + F.spark_partition_id()
    bins = bins.sortWithinPartitions("fill").repartitionById(n, F.pmod(place, F.lit(n)).cast("int"))
    while True:
        result = written(pack_round(bins, number, capacity), "bins")
        small = result.where(F.col("fill") <= capacity // 2).agg(F.count("*").alias("n"), F.min("fill").alias("least")).first()
        if n == 1 or not small.n:
            closed.append(result)
            break
        useful = (F.col("nth") < small.n) & (F.col("fill") <= capacity - small.least) & (F.col("fill") < int(nearly * capacity))
        closed.append(result.where(~useful))
        bins = result.where(useful).select("fill", "members", "task")
        n, number = -(-n // fan), number + 1
        bins = bins.repartitionById(n, F.floor(F.col("task") / fan).cast("int")).drop("task")
    sequences = closed[0]
    for c in closed[1:]:
        sequences = sequences.unionByName(c)
    placed = sequences.select("sequence_id", F.posexplode("members").alias("at", "m"), F.expr("transform(members, m -> m.length)").alias("lengths"))
    offset = F.aggregate(F.slice("lengths", F.lit(1), F.col("at")), F.lit(0).cast("long"), lambda a, x: a + x)
    placed = placed.select("m.*", "sequence_id", offset.alias("offset"))
    return whole.unionByName(placed)


def pack_documents(docs: DataFrame, path: str, **options) -> DataFrame:
    """Pieces of all documents, packed: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    return pack(pieces(docs, path), **options)
