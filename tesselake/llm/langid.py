"""Language identification with string kernels.

Texts are cut into segments; a segment is its set of 1- to 3-grams of lower-case code points (blended spectrum,
presence only), hashed to a fixed number of cells.  The kernel of two segments is the cosine of their presence
vectors.  Nystroem landmarks (training segments, drawn evenly by language) give features K(x, L) K(L, L)^(-1/2),
on which one-versus-rest kernel ridge regression is solved in closed form.  As the features are linear in the
presence vector, landmarks and weights fold into one matrix of cells by languages: a batch is scored by one
product of its presence matrix with it.  A text's score is the mean of its segments' scores by length.

The model is fitted on a bounded sample: of about ``per_lang`` documents of each language (those whose hash of doc_id is
below the share that this is of the language) ``per_doc`` segments each at most, and of these ``most`` in all, as many of
each language, at least one.  Segments are cut where the texts are; only those drawn reach the driver.  Each whole text is
scored.  Null texts and texts without a letter are ``und`` with score 0; so is everything where there is nothing to learn
from.  Repeated rows are scored one by one (and learned from once); a row without doc_id isn't held out and isn't learned
from.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import small_batches, sweep, texts_of, written

CELLS, ORDERS, SEGMENT = 1 << 13, (1, 2, 3), 2048
#: Multipliers of the code points of an n-gram, by order.
SEEDS = {n: np.array([0x9E3779B1, 0x85EBCA6B, 0xC2B2AE35][:n], np.uint32) + np.uint32(2 * n) for n in ORDERS}


@dataclass
class Model:
    langs: list[str]
    weights: np.ndarray  # cells x languages
    land: np.ndarray | None = None  # presence of the landmarks
    theta: np.ndarray | None = None  # weights of the features, of which ``weights`` is folded

    def scores(self, presence: np.ndarray) -> np.ndarray:
        return presence @ self.weights / np.sqrt(np.maximum(presence.sum(1, keepdims=True), 1))


def segments(text: str) -> list[str]:
    """Even pieces of at most SEGMENT characters."""
    parts = -(-len(text) // SEGMENT)
    return [text[len(text) * i // parts : len(text) * (i + 1) // parts] for i in range(parts)]


def presence(pieces: list[str]) -> np.ndarray:
    """The presence matrix of lower-case pieces: one row each, a cell is 1 if one of its n-grams occurs."""
    codes = np.frombuffer("".join(pieces).encode("utf-32-le", "surrogatepass"), np.uint32)
    row = np.repeat(np.arange(len(pieces), dtype=np.int64), [len(p) for p in pieces])
    out = np.zeros(len(pieces) * CELLS, np.float32)
    for n in ORDERS:
        m = len(codes) - n + 1
        if m <= 0:
            continue
        h = np.zeros(m, np.uint32)
        for i, seed in enumerate(SEEDS[n]):
            h += codes[i : i + m] * seed
        h ^= h >> np.uint32(15)
        h *= np.uint32(0x2C1B3C6D)
        h >>= np.uint32(32 - CELLS.bit_length() + 1)
        cell = row[:m] * CELLS + h
        out[cell[row[:m] == row[n - 1 :]] if n > 1 else cell] = 1
    return out.reshape(len(pieces), CELLS)


def fit(samples: list[tuple[str, str]], landmarks: int = 192, ridge: float = 1e-3, seed: int = 7) -> Model:
    """Kernel ridge regression on (text, language) pairs."""
    langs = sorted({lang for _, lang in samples})
    rng = np.random.default_rng(seed)
    pieces = [(p.lower(), langs.index(lang)) for text, lang in samples for p in segments(text)]
    pieces = [pieces[i] for i in rng.permutation(len(pieces))]
    if not pieces:
        return Model([], np.zeros((CELLS, 0), np.float32))
    x = np.concatenate([presence([p for p, _ in pieces[i : i + 256]]).astype(np.uint8) for i in range(0, len(pieces), 256)])
    y = np.array([c for _, c in pieces])
    each = max(1, landmarks // len(langs))
    marks = np.concatenate([np.flatnonzero(y == c)[:each] for c in range(len(langs))])
    scale = 1 / np.sqrt(np.maximum(x.sum(1, dtype=np.float64), 1))
    land = x[marks].astype(np.float64) * scale[marks, None]
    values, vectors = np.linalg.eigh(land @ land.T)
    keep = values > 1e-8 * values.max()
    root = vectors[:, keep] / np.sqrt(values[keep])  # K(L, L)^(-1/2), rank-reduced
    fold = (land.T @ root).astype(np.float32)
    feats = np.concatenate([(x[i : i + 256].astype(np.float32) @ fold) * scale[i : i + 256, None] for i in range(0, len(x), 256)])
    weight = 1 / np.maximum(np.bincount(y, minlength=len(langs)), 1)[y]  # languages count alike
    target = np.where(y[:, None] == np.arange(len(langs)), 1.0, -1.0)
    a = feats.T @ (feats * weight[:, None]) + ridge * np.eye(feats.shape[1])
    theta = np.linalg.solve(a, feats.T @ (target * weight[:, None]))
    return Model(langs, (fold @ theta).astype(np.float32), x[marks], theta)


def predict(texts: list[str], model: Model, rows: int = 256) -> list[tuple[str, float]]:
    """(language, score from 0 to 1) of each text."""
    owner, pieces = [], []
    for i, t in enumerate(texts):
        if model.langs and any(map(str.isalpha, t)):
            own = [p.lower() for p in segments(t)]
            owner += [i] * len(own)
            pieces += own
    total = np.zeros((len(texts), len(model.langs)))
    owners, length = np.array(owner, int), np.array([len(p) for p in pieces], float)
    for i in range(0, len(pieces), rows):
        s = model.scores(presence(pieces[i : i + rows]))
        np.add.at(total, owners[i : i + rows], s * length[i : i + rows, None])
    out = [("und", 0.0)] * len(texts)
    for i in sorted(set(owner)):
        z = total[i] / sum(map(len, segments(texts[i])))
        e = np.exp(4 * (z - z.max()))
        best = int(z.argmax())
        out[i] = (model.langs[best], float(e[best] / e.sum()))
    return out


def held_out(doc_id: Column, folds: int = 5, fold: int = 0) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % folds == fold, F.lit(False))


def train(docs: DataFrame, per_lang: int = 400, per_doc: int = 8, most: int = 4000) -> Model:
    """A model from a bounded sample of the documents that aren't held out."""
    known = docs.select("doc_id", "text", "lang").where("doc_id is not null and lang is not null and text is not null").where(~held_out(F.col("doc_id")))
    counts = written(known.groupBy("lang").agg(F.count("*").alias("c")), "langs")
    langs = counts.count()
    share = F.when(F.col("c") > per_lang, F.lit(float(per_lang)) / F.col("c")).otherwise(2.0)
    drawn = known.join(F.broadcast(counts), "lang").where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 40)) < share * (1 << 40))
    one = drawn.groupBy("lang", "doc_id").agg(F.min("text").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in small_batches(batches, 4 << 20):
            rows = []
            for lang, doc, text in zip(*(b.column(c).to_pylist() for c in ("lang", "doc_id", "text"))):
                own = segments(text)
                rows += [(lang, doc, own[i]) for i in sorted({len(own) * k // per_doc for k in range(per_doc)} if own else ())]
            yield pa.RecordBatch.from_pylist(
                [dict(zip(("lang", "doc_id", "piece"), r)) for r in rows],
                pa.schema([("lang", pa.string()), ("doc_id", pa.int64()), ("piece", pa.string())]),
            )

    pieces = one.select("lang", F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "lang string, doc_id long, piece string")
    # of a language there are about per_lang * per_doc at most
    first = Window.partitionBy("lang").orderBy(F.xxhash64("piece", "doc_id"), "doc_id", "piece")
    rows = pieces.withColumn("r", F.row_number().over(first)).where(F.col("r") <= max(1, most // max(1, langs))).collect()
    return fit([(r.piece, r.lang) for r in sorted(rows, key=lambda r: (r.lang, r.r))])


def classify(docs: DataFrame, per_lang: int = 400, per_doc: int = 8, most: int = 4000, block_bytes: int = 4 << 20) -> DataFrame:
    """Per document: doc_id, held_out, lang_pred, score."""
    sweep(docs)
    model = train(docs, per_lang, per_doc, most)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in small_batches(batches, block_bytes):
            found = predict(texts_of(b), model)
            yield pa.RecordBatch.from_arrays(
                [
                    b.column("doc_id"), b.column("held_out"), pa.array([x for x, _ in found], pa.string()),
                    pa.array([s for _, s in found], pa.float64()),
                ],
                names=["doc_id", "held_out", "lang_pred", "score"],
            )

    return docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "text").mapInArrow(
        run, "doc_id long, held_out boolean, lang_pred string, score double",
    )
