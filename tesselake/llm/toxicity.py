"""Toxicity scores from a bidirectional gated recurrent network with attention pooling, trained in numpy.

Input of the network is a window of 16 words; windows overlap by half and cover the whole text.  A word's input
is the sum of embeddings of its hashed form and of its hashed character 3- to 6-grams (with marks for its start and
end), so unseen words are read by their characters.  Two gated recurrent layers of opposite direction run over the
window, attention weighs their states, a linear layer gives the window's logit.  A text's logit is the largest of
its windows; its score is that logit's calibrated sigmoid.

Training sees a bounded sample of the labelled documents (``per_label`` of each label, those with the smallest hash
of doc_id; one text of each id, and none of more than ``longest`` characters) and labels of whole documents only: all windows of a clean document are clean, of a toxic document
the window that is rated highest stands for it.  Labels, lang, source and doc_id are never inputs.

Null texts count as empty; a text without a word has score 0.  Repeated rows are scored one by one; of several
labels of one doc_id the larger counts.  Rows without doc_id are neither held out nor learned from.  With labels of
one kind only (or none), every score is 0.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .common import mix64, small_batches, texts_of

WINDOW, STRIDE, HIDDEN, DIM, BUCKETS, GRAMS = 16, 8, 8, 12, 1 << 15, (3, 4, 5, 6)
EDGE = "".join(chr(c) for c in range(33, 128) if not chr(c).isalnum()) + "«»„“”’…¿¡"
THRESHOLD = 0.7


def words_of(text: str) -> list[str]:
    return text.lower().split()


def features(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(feature, word number) pairs of the words, each word's own feature first, ordered by word."""
    marked = ["\x02" + (w.strip(EDGE) or w) + "\x03" for w in words]
    codes = np.frombuffer("".join(marked).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    lengths = np.array([len(w) for w in marked])
    starts = np.cumsum(lengths) - lengths
    owner = np.repeat(np.arange(len(words)), lengths)
    place = np.arange(len(codes)) - starts[owner]
    whole = np.add.reduceat(
        mix64(codes * np.uint64(0x10001) + place.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)), starts,
    ) if len(words) else np.zeros(0, np.uint64)
    found, owners = [mix64(whole) % np.uint64(BUCKETS)], [np.arange(len(words))]
    for n in GRAMS:
        m = len(codes) - n + 1
        if m <= 0:
            continue
        h = np.full(m, n, np.uint64)
        for i in range(n):
            h = h * np.uint64(1_000_003) + codes[i : i + m]
        same = owner[:m] == owner[n - 1 :]
        found.append(mix64(h[same]) % np.uint64(BUCKETS))
        owners.append(owner[:m][same])
    f, o = np.concatenate(found).astype(np.int64), np.concatenate(owners)
    order = np.argsort(o, kind="stable")
    return f[order], o[order]


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


@dataclass
class Network:
    """All weights: embedding, input to gates of both directions, recurrent, attention, output, calibration."""

    p: dict[str, np.ndarray]
    scale: float = 1.0
    shift: float = 0.0
    known: dict[str, int] = field(default_factory=dict)
    table: np.ndarray | None = None
    most: int = 150_000

    def __getstate__(self):
        return self.__dict__ | {"known": {}, "table": None}

    def inputs(self, feats: np.ndarray, owner: np.ndarray, n: int) -> np.ndarray:
        """Gate inputs of n words: the two directions' reset, update and candidate."""
        starts = np.searchsorted(owner, np.arange(n))
        count = np.diff(np.append(starts, len(owner)))
        x = np.add.reduceat(self.p["emb"][feats], starts, axis=0) / np.sqrt(count)[:, None]
        return (x @ self.p["win"] + self.p["bin"]).astype(np.float32)

    def table_of(self, feats: np.ndarray, starts: np.ndarray, step: int = 20_000) -> np.ndarray:
        """Gate inputs of a whole vocabulary, a part at a time, below a row of zeros for no word."""
        n = len(starts) - 1
        table = np.zeros((n + 1, 6 * HIDDEN), np.float32)
        for i in range(0, n, step):
            j = min(i + step, n)
            table[i + 1 : j + 1] = self.inputs(feats[starts[i] : starts[j]], np.repeat(np.arange(j - i), np.diff(starts[i : j + 1])), j - i)
        return table

    def ids(self, texts: list[list[str]]) -> list[np.ndarray]:
        """Rows of the table of gate inputs; words met before are remembered, row 0 stands for no word."""
        new = {w for t in texts for w in t} - self.known.keys()
        if self.table is None or len(self.known) + len(new) > self.most:
            self.known, self.table, self.used = {}, np.zeros((1 << 16, 6 * HIDDEN), np.float32), 1
            new = {w for t in texts for w in t}
        fresh = list(new)
        while self.used + len(fresh) > len(self.table):
            self.table = np.concatenate([self.table, np.zeros_like(self.table)])
        for i in range(0, len(fresh), 20_000):
            own = fresh[i : i + 20_000]
            self.table[self.used : self.used + len(own)] = self.inputs(*features(own), len(own))
            self.known.update(zip(own, range(self.used, self.used + len(own))))
            self.used += len(own)
        get = self.known.__getitem__
        return [np.fromiter(map(get, t), np.int32, len(t)) for t in texts]

    def run(self, x: np.ndarray, u: np.ndarray, mask: np.ndarray | None, keep: list | None = None) -> np.ndarray:
        """States of one direction; x is steps x batch x 3H of gate inputs."""
        h = np.zeros((x.shape[1], HIDDEN), np.float32)
        out = np.empty((x.shape[0], x.shape[1], HIDDEN), np.float32)
        for t in range(len(x)):
            a = h @ u
            g = x[t, :, : 2 * HIDDEN] + a[:, : 2 * HIDDEN]
            np.negative(g, out=g)
            np.minimum(g, 30, out=g)
            np.exp(g, out=g)
            g += 1
            np.reciprocal(g, out=g)
            r, z = g[:, :HIDDEN], g[:, HIDDEN:]
            c = np.tanh(x[t, :, 2 * HIDDEN :] + r * a[:, 2 * HIDDEN :])
            new = c + z * (h - c)
            if mask is not None:
                new = np.where(mask[t][:, None], new, h)
            if keep is not None:
                keep.append((h, r, z, c, a[:, 2 * HIDDEN :]))
            out[t] = h = new
        return out

    def pooled(self, states: np.ndarray, mask: np.ndarray | None, keep: dict | None = None) -> np.ndarray:
        """Logits of windows by attention over steps x batch x 2H states."""
        k = np.tanh(states @ self.p["att"])
        e = k @ self.p["query"]
        if mask is not None:
            e = np.where(mask, e, np.float32(-1e9))
        w = np.exp(e - e.max(0))
        w /= w.sum(0)
        c = (w[:, :, None] * states).sum(0)
        if keep is not None:
            keep |= {"k": k, "w": w, "c": c}
        return c @ self.p["out"] + self.p["bias"][0]

    def logits(self, table: np.ndarray, windows: np.ndarray, chunk: int = 2048) -> np.ndarray:
        """Logits of windows (rows of word numbers, 0 where there is none)."""
        out = np.empty(len(windows), np.float32)
        for i in range(0, len(windows), chunk):
            w = windows[i : i + chunk].T
            x = table[w]
            mask = None if w.all() else w > 0
            states = np.concatenate(
                [
                    self.run(x[:, :, : 3 * HIDDEN], self.p["uf"], mask),
                    self.run(x[::-1, :, 3 * HIDDEN :], self.p["ub"], None if mask is None else mask[::-1])[::-1],
                ],
                2,
            )
            out[i : i + chunk] = self.pooled(states, mask)
        return out

    def text_logits(self, texts: list[str]) -> np.ndarray:
        """The largest window logit of each text, -inf without words."""
        ids = self.ids([words_of(t) for t in texts])
        windows, owner = cut(ids)
        out = np.full(len(texts), -np.inf)
        if len(windows):
            order = np.argsort(windows[:, -1] == 0, kind="stable")  # full windows need no mask
            z = np.empty(len(windows), np.float32)
            z[order] = self.logits(self.table, windows[order])
            first = np.flatnonzero(np.diff(owner, prepend=-1))
            out[owner[first]] = np.maximum.reduceat(z, first)
        return out

    def scores(self, texts: list[str]) -> np.ndarray:
        z = self.text_logits(texts)
        return np.where(np.isfinite(z), sigmoid(self.scale * np.where(np.isfinite(z), z, 0) + self.shift), 0.0)


def cut(ids: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """All overlapping windows of the texts (the last one ends with the text), and whose they are."""
    lengths = np.array([len(x) for x in ids], np.int64)
    counts = np.where(lengths > 0, 1 + np.maximum(0, -(-(lengths - WINDOW) // STRIDE)), 0)
    owner = np.repeat(np.arange(len(ids)), counts)
    nth = np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)
    at = np.minimum(nth * STRIDE, np.maximum(lengths - WINDOW, 0)[owner])
    flat = np.concatenate([*ids, np.zeros(WINDOW, np.int32)]) if ids else np.zeros(WINDOW, np.int32)
    base = (np.cumsum(lengths) - lengths)[owner]
    inside = at[:, None] + np.arange(WINDOW)
    return np.where(inside < lengths[owner][:, None], flat[np.minimum(base[:, None] + inside, len(flat) - 1)], 0).astype(np.int32), owner


def scattered(index: np.ndarray, values: np.ndarray, n: int) -> np.ndarray:
    """n rows with the sums of the values by index."""
    out = np.zeros((n, values.shape[1]), np.float32)
    order = np.argsort(index, kind="stable")
    found = index[order]
    first = np.flatnonzero(np.diff(found, prepend=-1))
    out[found[first]] = np.add.reduceat(values[order], first, axis=0)
    return out


def gradients(
    net: Network, feats: np.ndarray, owner: np.ndarray, n: int, windows: np.ndarray, target: np.ndarray,
    weight: np.ndarray,
) -> tuple[dict, np.ndarray]:
    """Gradients of the weighted log loss of a batch of windows; words are numbered from 1."""
    p, table = net.p, np.concatenate([np.zeros((1, 6 * HIDDEN), np.float32), net.inputs(feats, owner, n)])
    w = windows.T
    x, mask = table[w], w > 0
    keep = ([], [])
    pool: dict = {}
    sides = ((p["uf"], slice(0, 3 * HIDDEN), 1), (p["ub"], slice(3 * HIDDEN, 6 * HIDDEN), -1))
    states = np.concatenate([net.run(x[::d, :, s], u, mask[::d], k)[::d] for (u, s, d), k in zip(sides, keep)], 2)
    z = net.pooled(states, mask, pool)
    dz = ((sigmoid(z) - target) * weight / weight.sum()).astype(np.float32)
    g = {"bias": np.array([dz.sum()]), "out": pool["c"].T @ dz}
    dc = dz[:, None] * p["out"]
    dw = (states * dc).sum(2)
    de = pool["w"] * (dw - (pool["w"] * dw).sum(0))
    g["query"] = np.einsum("tb,tbk->k", de, pool["k"])
    dk = de[:, :, None] * p["query"] * (1 - pool["k"] ** 2)
    g["att"] = np.einsum("tbi,tbk->ik", states, dk)
    ds = pool["w"][:, :, None] * dc + dk @ p["att"].T
    dx = np.zeros_like(x)
    for (u, s, d), k, name, part in zip(sides, keep, ("uf", "ub"), (slice(0, HIDDEN), slice(HIDDEN, 2 * HIDDEN))):
        du, dh, m = np.zeros_like(u), np.zeros((w.shape[1], HIDDEN), np.float32), mask[::d]
        grad_in, grad_out = dx[::d, :, s], ds[::d, :, part]
        for t in range(WINDOW - 1, -1, -1):
            h, r, zt, c, an = k[t]
            total = dh + grad_out[t]
            live = total * m[t][:, None]
            dcand = live * (1 - zt) * (1 - c * c)
            dzt = live * (h - c) * zt * (1 - zt)
            dr = dcand * an * r * (1 - r)
            grad_in[t] = np.concatenate([dr, dzt, dcand], 1)
            da = np.concatenate([dr, dzt, dcand * r], 1)
            du += h.T @ da
            dh = np.where(m[t][:, None], live * zt + da @ u.T, total)
        g[name] = du
    rows = scattered(w.ravel(), dx.reshape(-1, 6 * HIDDEN), len(table))[1:]
    starts = np.searchsorted(owner, np.arange(n))
    count = np.sqrt(np.diff(np.append(starts, len(owner))))[:, None]
    summed = np.add.reduceat(p["emb"][feats], starts, axis=0) / count
    g["bin"], g["win"] = rows.sum(0), summed.T @ rows
    g["emb"] = scattered(feats, ((rows @ p["win"].T) / count)[owner], len(p["emb"]))
    return g, z


def train(samples: list[tuple[str, int]], steps: int = 500, batch: int = 256, rate: float = 0.01, seed: int = 11) -> Network:
    """Fit the network to (text, label) pairs."""
    rng = np.random.default_rng(seed)
    texts, labels = [words_of(t) for t, _ in samples], np.array([y for _, y in samples])
    vocabulary = {w: i + 1 for i, w in enumerate(dict.fromkeys(w for t in texts for w in t))}
    known, parts, counts = list(vocabulary), [], []
    for i in range(0, len(known), 20_000):
        own, owner = features(known[i : i + 20_000])
        parts.append(own.astype(np.uint16))
        counts.append(np.bincount(owner, minlength=len(known[i : i + 20_000])))
    feats = np.concatenate(parts) if parts else np.zeros(0, np.uint16)
    starts = np.concatenate([[0], np.cumsum(np.concatenate(counts))]) if counts else np.zeros(1, int)
    ids = [np.array([vocabulary[w] for w in t], np.int32) for t in texts]
    windows, of = cut(ids)
    # document frequencies of the features give the first component of the embedding its start
    seen = np.full((2, BUCKETS), 0.0)
    for x, y in zip(ids, labels):
        own = [feats[starts[i - 1] : starts[i]] for i in set(x.tolist())]
        if own:
            seen[y, np.unique(np.concatenate(own))] += 1
    size = np.array([(labels == 0).sum(), (labels == 1).sum()])[:, None]
    odds = np.log((seen[1] + 0.5) / (size[1] + 1)) - np.log((seen[0] + 0.5) / (size[0] + 1))
    draw = lambda *shape: (rng.standard_normal(shape) / np.sqrt(shape[0])).astype(np.float32)
    p = {
        "emb": 0.1 * draw(BUCKETS, DIM) * np.sqrt(BUCKETS), "win": draw(DIM, 6 * HIDDEN),
        "bin": np.zeros(6 * HIDDEN, np.float32), "uf": draw(HIDDEN, 3 * HIDDEN), "ub": draw(HIDDEN, 3 * HIDDEN),
        "att": draw(2 * HIDDEN, 8), "query": draw(8), "out": draw(2 * HIDDEN), "bias": np.zeros(1, np.float32),
    }
    p = {k: v.astype(np.float32) for k, v in p.items()}
    p["emb"][:, 0] = 0.25 * odds
    net = Network(p)
    moment = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in p.items()}
    # the fifth part of the documents is kept for calibration
    fit = rng.random(len(samples)) >= 0.2 if len(samples) >= 100 else np.ones(len(samples), bool)
    usable = np.flatnonzero(fit[of])
    clean = usable[labels[of[usable]] == 0]
    word_odds = np.concatenate([[0], np.add.reduceat(odds[feats].astype(np.float32), starts[:-1]) / np.sqrt(np.diff(starts))])
    rating = word_odds[windows].max(1)
    toxic, hard = np.zeros(0, int), clean
    for step in range(steps):
        if step % 50 == 0:
            if step >= 100:
                table = net.table_of(feats, starts)
                look = usable if step % 200 == 0 else np.concatenate([usable[labels[of[usable]] == 1], rng.choice(clean, min(len(clean), 20_000), False)])
                rating[look] = net.logits(table, windows[look])
            own = usable[labels[of[usable]] == 1]
            order = own[np.lexsort((-rating[own], of[own]))]
            toxic = order[np.flatnonzero(np.diff(of[order], prepend=-1))]
            hard = clean[np.argsort(-rating[clean])[: max(200, len(clean) // 50)]]
        half = batch // 2
        pick = np.concatenate([rng.choice(toxic, half), rng.choice(hard, half // 2), rng.choice(clean, half - half // 2)])
        w = windows[pick]
        used = np.unique(w[w > 0])
        local = np.zeros(len(vocabulary) + 1, np.int32)
        local[used] = np.arange(1, len(used) + 1)
        span = [np.arange(starts[i - 1], starts[i]) for i in used]
        sub = feats[np.concatenate(span)]
        sub_owner = np.repeat(np.arange(len(used)), [len(s) for s in span])
        y = labels[of[pick]].astype(np.float32)
        g, _ = gradients(net, sub, sub_owner, len(used), local[w], y, np.ones(len(pick), np.float32))
        lr = rate * min(1, 2 * (1 - step / steps) + 0.05)
        for k, v in p.items():
            m, s = moment[k]
            m *= 0.9
            m += 0.1 * g[k].astype(np.float32)
            s *= 0.99
            s += 0.01 * g[k].astype(np.float32) ** 2
            v -= lr * (m / (1 - 0.9 ** (step + 1))) / (np.sqrt(s / (1 - 0.99 ** (step + 1))) + 1e-6)
    calibrate(net, [t for (t, _), f in zip(samples, fit) if not f or fit.all()], [int(y) for (_, y), f in zip(samples, fit) if not f or fit.all()])
    return net


def calibrate(net: Network, texts: list[str], labels: list[int]) -> None:
    """Set scale and shift so that the best cut between the labels lies at THRESHOLD."""
    z, y = net.text_logits(texts), np.array(labels)
    z, y = z[np.isfinite(z)], y[np.isfinite(z)]
    if not len(z) or y.min() == y.max():
        return
    order = np.argsort(z)
    z, y = z[order], y[order]
    # errors if all above the gap count as toxic; a clean text taken for toxic counts as two
    errors = np.concatenate([[0], np.cumsum(y)]) + 2 * ((y == 0).sum() - np.concatenate([[0], np.cumsum(y == 0)]))
    gaps = (np.append(z, z[-1] + 1) + np.insert(z, 0, z[0] - 1)) / 2
    best = np.flatnonzero(errors == errors.min())
    at = float(np.median(gaps[best]))
    net.scale = 1.0
    net.shift = float(np.log(THRESHOLD / (1 - THRESHOLD)) - net.scale * at)


def held_out(doc_id: Column, folds: int = 3, fold: int = 1) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % folds == fold, F.lit(False))


def learn(docs: DataFrame, labels: DataFrame, per_label: int = 1200, longest: int = 1 << 17) -> Network | None:
    """A network from a bounded sample of the labelled documents that aren't held out."""
    known = labels.select("doc_id", "toxic").where("doc_id is not null and toxic in (0, 1)").where(~held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.max("toxic").cast("int").alias("y"))
    # an ordered limit of each label: no task passes on more than per_label rows
    ids = [known.where(F.col("y") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_label) for y in (0, 1)]
    texts = docs.select("doc_id", "text").where(F.col("text").isNotNull() & (F.char_length("text") <= longest)).join(F.broadcast(ids[0].unionByName(ids[1])), "doc_id")
    rows = sorted((r.doc_id, r.text, r.y) for r in texts.groupBy("doc_id", "y").agg(F.min("text").alias("text")).collect())
    return train([(t, y) for _, t, y in rows]) if {y for *_, y in rows} == {0, 1} else None


def score(
    docs: DataFrame, labels: DataFrame, per_label: int = 1200, threshold: float = THRESHOLD, block_bytes: int = 2 << 20,
    columns: tuple[str, ...] = ("doc_id",), names: tuple[str, str] = ("score", "predicted"),
) -> DataFrame:
    """The columns named, with the score and the prediction under ``names``."""
    net = learn(docs, labels, per_label)
    carried = docs.select(*columns, F.col("text").alias("__text"))
    schema = carried.drop("__text").schema.add(names[0], "double").add(names[1], "integer")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in small_batches(batches, block_bytes):
            s = net.scores(texts_of(b, "__text")) if net else np.zeros(b.num_rows)
            yield pa.RecordBatch.from_arrays(
                [*(b.column(c) for c in columns), pa.array(s, pa.float64()), pa.array((s >= threshold).astype(np.int32))],
                names=[*columns, *names],
            )

    return carried.mapInArrow(run, schema)


def predict(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The query's columns: doc_id, held_out, score, predicted."""
    return score(docs, labels).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")
