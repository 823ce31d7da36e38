"""Maximum inner product search with score-aware (anisotropic) product quantisation.

Codebooks of 16 centres per component (four-bit codes, two to a byte) are fitted on a bounded sample under the loss
|r|^2 + (eta - 1) (r.x)^2 / |x|^2: the part of the residual r that is parallel to the vector x, which is what
shifts inner products, costs eta times as much.  Codes are chosen by coordinate descent over the subspaces,
centres by the closed-form least squares of that loss.

Every vector is indexed.  Rows are dealt to blocks of bounded size, the stated queries likewise; each query block meets
each row block (queries are replicated, in packed form, vectors move once).  There a table scan sums, byte by byte, what
two codes are worth to each query; only the best ``rerank`` rows of a block (by default twice k, of thousands) are scored
exactly, in double precision, and only the best k of these leave the task.  Blocks' results are merged in a tree of
bounded fan.  With rerank=0 all rows of a block are scored exactly: the exact way.

Vectors that are null, zero, or that hold null or non-finite components take no part, and rows without id neither.
Vectors of different lengths have no inner product: each length is a search of its own.  Ties go to the smaller id.  Repeated
ids are rows (and queries) of their own, but a query never finds a row with its own id.  An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import partitions, sweep, written

CENTRES = 16


@dataclass
class Quantizer:
    books: np.ndarray  # subspaces x 16 x width
    eta: float

    @property
    def dim(self) -> int:
        return self.books.shape[0] * self.books.shape[2]

    def split(self, x: np.ndarray) -> np.ndarray:
        return x.reshape(len(x), self.books.shape[0], self.books.shape[2])

    def encode(self, x: np.ndarray, passes: int = 2, codes: np.ndarray | None = None) -> np.ndarray:
        """Four-bit codes, not packed yet: the nearest centres, then coordinate descent on the score-aware loss."""
        parts, m = self.split(x), len(self.books)
        if codes is None:
            codes = np.stack([(parts[:, j] @ self.books[j].T - 0.5 * (self.books[j] ** 2).sum(1)).argmax(1) for j in range(m)], 1)
        norm = np.maximum((x * x).sum(1), 1e-30)
        along = np.stack([((parts[:, j] - self.books[j][codes[:, j]]) * parts[:, j]).sum(1) for j in range(m)], 1)
        total = along.sum(1)
        for _ in range(passes):
            for j in range(m):
                rest = total - along[:, j]
                off = parts[:, j][:, None, :] - self.books[j][None]
                own = (off * parts[:, j][:, None, :]).sum(2)
                loss = (off * off).sum(2) + (self.eta - 1) * (rest[:, None] + own) ** 2 / norm[:, None]
                codes[:, j] = loss.argmin(1)
                along[:, j] = own[np.arange(len(x)), codes[:, j]]
                total = rest + along[:, j]
        return codes.astype(np.uint8)

    def tables(self, q: np.ndarray) -> np.ndarray:
        """Per subspace and centre the inner products with each query: subspaces x 16 x queries."""
        return np.einsum("qmw,mcw->mcq", self.split(q), self.books).astype(np.float32)

    def scan(self, codes: np.ndarray, tables: np.ndarray) -> np.ndarray:
        """Approximate scores, rows x queries, of packed codes: one table of 256 entries for each byte."""
        out = np.zeros((len(codes), tables.shape[2]), np.float32)
        for j in range(0, len(tables), 2):
            two = tables[j][:, None] + (tables[j + 1][None] if j + 1 < len(tables) else np.zeros((1, CENTRES, 1), np.float32))
            out += two.reshape(CENTRES * CENTRES, -1)[codes[:, j // 2]]
        return out


def packed_codes(codes: np.ndarray) -> np.ndarray:
    """Two four-bit codes to a byte."""
    if codes.shape[1] % 2:
        codes = np.concatenate([codes, np.zeros((len(codes), 1), np.uint8)], 1)
    return codes[:, ::2] << 4 | codes[:, 1::2]


def fit(x: np.ndarray, width: int = 1, threshold: float = 0.2, rounds: int = 4, seed: int = 3) -> Quantizer:
    """Codebooks for vectors whose scores above ``threshold`` (relative to the norm) matter."""
    dim = x.shape[1]
    width = width if dim % width == 0 else 1
    m, rng = dim // width, np.random.default_rng(seed)
    eta = max(1.0, (dim - 1) * threshold**2 / (1 - threshold**2))
    parts = x.reshape(len(x), m, width)
    books = np.stack([parts[rng.choice(len(x), CENTRES, len(x) < CENTRES), j] for j in range(m)])
    for _ in range(8):  # plain k-means to start with
        for j in range(m):
            near = (parts[:, j] @ books[j].T - 0.5 * (books[j] ** 2).sum(1)).argmax(1)
            count = np.bincount(near, minlength=CENTRES)
            for w in range(width):
                total = np.bincount(near, parts[:, j, w], CENTRES)
                books[j, :, w] = np.where(count > 0, total / np.maximum(count, 1), books[j, :, w])
    model, codes = Quantizer(books, eta), None
    unit = x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-30)
    size = m * CENTRES * width
    for _ in range(rounds):
        codes = model.encode(x, 1, None if codes is None else codes.astype(np.int64))
        slots = ((np.arange(m) * CENTRES + codes)[:, :, None] * width + np.arange(width)).reshape(len(x), dim)
        gram, right, count = np.zeros((size, size)), np.zeros(size), np.zeros(size)
        for i in range(0, len(x), 1000):
            v = np.zeros((len(x[i : i + 1000]), size))
            np.put_along_axis(v, slots[i : i + 1000], unit[i : i + 1000], 1)
            gram += v.T @ v
        np.add.at(right, slots.ravel(), eta * x.ravel())
        np.add.at(count, slots.ravel(), 1.0)
        gram *= eta - 1
        gram[np.diag_indices(size)] += count + 1e-6
        right += 1e-6 * model.books.ravel()
        model = Quantizer(np.linalg.solve(gram, right).reshape(m, CENTRES, width), eta)
    return model


def exact(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Inner products along the last axis, summed alike for equal rows."""
    return (q.astype(np.float64) * x.astype(np.float64)).sum(-1)


def in_order(x: np.ndarray) -> np.ndarray:
    """32-bit integers in the order of float32 values."""
    i = x.view(np.int32).astype(np.int64)
    return np.where(i < 0, -(i & 0x7FFFFFFF), i)


def search_block(
    model: Quantizer, qid: np.ndarray, q: np.ndarray, vid: np.ndarray, x: np.ndarray, codes: np.ndarray, k: int,
    rerank: int,
) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(queries, ids, scores) of the best k of the block for some queries at a time; ids of -1 stand for none.

    The block is in the order of its ids.  With no rerank, or no more rows than that, all are scored exactly."""
    n = len(vid)
    few = n if rerank == 0 else min(n, rerank)
    step = max(1, min(128, (1 << 21) // max(1, few * x.shape[1])))
    for i in range(0, len(q), step):
        some, own = q[i : i + step], qid[i : i + step]
        first, last = np.searchsorted(vid, own, "left"), np.searchsorted(vid, own, "right")
        if few == n:
            top = np.broadcast_to(np.arange(n), (len(some), n))
        else:
            # by falling approximate score, ties by place
            order = (-in_order(model.scan(codes, model.tables(some)).T.copy()) << 24) + np.arange(n)
            for j in np.flatnonzero(last > first):
                order[j, first[j] : last[j]] = np.iinfo(np.int64).max
            top = np.sort(np.argpartition(order, few - 1, axis=1)[:, :few], axis=1)
        score = exact(some[:, None, :], x[top])
        score[(top >= first[:, None]) & (top < last[:, None])] = -np.inf
        best = np.argsort(-score, axis=1, kind="stable")[:, :k]  # places are in the order of ids
        score, ids = np.take_along_axis(score, best, 1), vid[np.take_along_axis(top, best, 1)]
        yield np.arange(i, i + len(some)), np.where(score == -np.inf, -1, ids), score


def usable(rows: DataFrame, id_col: str, vector: str) -> DataFrame:
    """(vec_id, v, dim) of the vectors that take part."""
    v = F.transform(F.col(vector), lambda x: x.cast("double"))
    rows = rows.select(F.col(id_col).cast("long").alias("vec_id"), v.alias("v")).where("vec_id is not null and v is not null")
    fine = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))) & F.exists("v", lambda x: x != 0)
    return rows.where(fine).withColumn("dim", F.size("v"))


RESULT = "query_id long, rank int, vec_id long, score double"


def search(
    rows: DataFrame, every: int, k: int = 20, id_col: str = "vec_id", vector: str = "embedding", block: int = 32_768,
    query_block: int = 512, sample: int = 8000, rerank: int | None = None,
) -> DataFrame:
    """The k nearest rows of each row whose id is divisible by ``every``: query_id, rank, vec_id, score.

    A block holds about ``block`` rows at most (under 2^24), fewer where that gives the cluster too few tasks."""
    sweep(rows)
    data = written(usable(rows, id_col, vector), "vectors")
    found = [searched(data.where(F.col("dim") == r.dim), r.dim, every, k, block, query_block, sample, 2 * k if rerank is None else rerank) for r in data.select("dim").distinct().orderBy("dim").collect()]
    out = rows.sparkSession.createDataFrame([], RESULT) if not found else found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out


def searched(data: DataFrame, dim: int, every: int, k: int, block: int, query_block: int, sample: int, rerank: int) -> DataFrame:
    """``search`` over vectors of one length."""
    data = data.select("vec_id", "v")
    drawn = data.orderBy(F.xxhash64("vec_id", "v"), "vec_id").limit(sample).collect()
    model = fit(np.array([r.v for r in drawn]))
    counts = data.agg(F.count("*").alias("n"), F.count_if(F.col("vec_id") % every == 0).alias("q")).first()
    blocks, query_blocks = max(1, -(-counts.n // block), min(partitions(data), counts.n // 2048)), max(1, -(-counts.q // query_block))

    def packed(table: pa.Table, encode: bool) -> pa.Table:
        order = np.argsort(ids := table.column("vec_id").to_numpy(), kind="stable")
        x = table.column("v").combine_chunks().flatten().to_numpy().reshape(-1, dim)[order]
        codes = packed_codes(model.encode(x)).tobytes() if encode else b""
        return pa.table({"number": table.column("number")[:1], "ids": pa.array([ids[order].astype("<i8").tobytes()], pa.binary()), "x": pa.array([x.tobytes()], pa.binary()), "codes": pa.array([codes], pa.binary())})

    kind = "number long, ids binary, x binary, codes binary"

    def dealt(df: DataFrame, n: int, encode: bool) -> DataFrame:
        # by row, not by id: an id may be that of many rows
        number = F.pmod(F.xxhash64("vec_id", F.monotonically_increasing_id()), F.lit(n)).cast("long")
        return df.withColumn("number", number).groupBy("number").applyInArrow(lambda t: packed(t, encode), kind)

    queries = dealt(data.where(F.col("vec_id") % every == 0), query_blocks, False).select(
        F.col("number").alias("q_number"), F.col("ids").alias("q_ids"), F.col("x").alias("q_x"),
        F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))).alias("number"),
    )
    pairs = dealt(data, blocks, True).join(queries, "number")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        entry = pa.struct([("minus", pa.float64()), ("vec_id", pa.int64())])
        for b in batches:
            for i in range(b.num_rows):
                get = lambda name, kind: np.frombuffer(b.column(name)[i].as_buffer(), kind)
                q_ids, number, q_number = get("q_ids", "<i8"), b.column("number")[i].as_py(), b.column("q_number")[i].as_py()
                for at, ids, score in search_block(
                    model, q_ids, get("q_x", np.float64).reshape(-1, dim), get("ids", "<i8"),
                    get("x", np.float64).reshape(-1, dim),
                    get("codes", np.uint8).reshape(-1, -(-len(model.books) // 2)), k, rerank,
                ):
                    real = score > -np.inf
                    flat = pa.StructArray.from_arrays([pa.array(-score[real]), pa.array(ids[real])], fields=list(entry))
                    best = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(real.sum(1))]), pa.int32()), flat)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(q_ids[at]), pa.array((q_number << 32) | at), pa.array(np.full(len(at), number)), best],
                        names=["query_id", "q", "number", "best"],
                    )

    part = pairs.mapInArrow(run, "query_id long, q long, number long, best array<struct<minus:double,vec_id:bigint>>")
    while True:  # a merge sees the best k of 64 blocks at most
        part = part.withColumn("number", F.floor(F.col("number") / 64)).groupBy("query_id", "q", "number").agg(F.slice(F.array_sort(F.flatten(F.collect_list("best"))), 1, k).alias("best"))
        blocks = -(-blocks // 64)
        if blocks == 1:
            break
    return part.select("query_id", F.posexplode("best").alias("at", "b")).select(
        "query_id", (F.col("at") + 1).cast("int").alias("rank"), F.col("b.vec_id").alias("vec_id"),
        (-F.col("b.minus")).alias("score"),
    )
