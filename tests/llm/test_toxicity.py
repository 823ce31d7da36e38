import random
from zlib import crc32

import numpy as np

from tesselake.llm import toxicity

SYLLABLES = "ka ko mi tu ra ne so li be du".split()
INSULTS = ["grumblewort", "snarkface", "vexloon"]


def text(rng, toxic, n):
    words = ["".join(rng.choice(SYLLABLES) for _ in range(rng.randrange(1, 4))) for _ in range(n)]
    if toxic:
        for _ in range(2):
            words.insert(rng.randrange(len(words) + 1), rng.choice(INSULTS) + rng.choice(["", ",", "!"]))
    return " ".join(words)


def test_gradients():
    rng = np.random.default_rng(0)
    vocabulary = ["aba", "bcd", "idiot,", "x"]
    feats, owner = toxicity.features(vocabulary)
    draw = lambda *s: rng.standard_normal(s) * 0.5
    h = toxicity.HIDDEN
    p = {"emb": draw(toxicity.BUCKETS, toxicity.DIM), "win": draw(toxicity.DIM, 6 * h), "bin": draw(6 * h), "uf": draw(h, 3 * h), "ub": draw(h, 3 * h), "att": draw(2 * h, 8), "query": draw(8), "out": draw(2 * h), "bias": draw(1)}
    net = toxicity.Network({k: v.astype(np.float32) for k, v in p.items()})
    windows = np.zeros((3, toxicity.WINDOW), np.int32)
    windows[0, :5], windows[1], windows[2, :1] = [1, 2, 3, 4, 1], rng.integers(1, 5, toxicity.WINDOW), [3]
    y, w = np.array([1, 0, 1], np.float32), np.ones(3, np.float32)
    g, z = toxicity.gradients(net, feats, owner, 4, windows, y, w)

    def loss():
        table = np.concatenate([np.zeros((1, 6 * h), np.float32), net.inputs(feats, owner, 4)])
        z = net.logits(table, windows).astype(float)
        return float((np.log1p(np.exp(-np.abs(z))) + np.maximum(z, 0) - y * z).mean())

    for name in net.p:
        flat, grad = net.p[name].reshape(-1), np.asarray(g[name]).reshape(-1)
        for i in [int(np.abs(grad).argmax()), len(flat) // 2]:
            old = flat[i]
            flat[i] = old + 1e-2
            up = loss()
            flat[i] = old - 1e-2
            down = loss()
            flat[i] = old
            assert abs((up - down) / 2e-2 - grad[i]) < 2e-3 + 0.03 * abs(grad[i]), name


def test_held_out_accuracy_and_odd_rows(spark):
    rng = random.Random(3)
    rows = [(i, text(rng, i % 4 == 0, rng.randrange(5, 120)), int(i % 4 == 0)) for i in range(400)]
    docs = [(i, t, "en", 0.5) for i, t, _ in rows] + [(900, None, "", 0.0), (901, "", "", 0.0), (902, " \n", "", 0.0), (None, text(rng, True, 20), "", 0.0), (3, rows[3][1], "", 0.0), (903, text(rng, False, 30_000) + " snarkface vexloon", "", 0.0)]
    labels = [(i, 1, y) for i, _, y in rows] + [(5, 1, 0), (777, 0, 1), (None, 0, 1), (6, 0, None)]
    out = toxicity.predict(spark.createDataFrame(docs, "doc_id long, text string, lang string, score double"), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")).collect()
    assert len(out) == len(docs)
    by = {r.doc_id: r for r in out}
    held = [(by[i].predicted, y) for i, _, y in rows if by[i].held_out]
    assert len(held) > 80 and sum(p == y for p, y in held) / len(held) > 0.95
    assert all(by[i].score == 0 for i in (900, 901, 902)) and by[903].predicted == 1
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in out)
    assert all(r.held_out == (crc32(str(r.doc_id).encode()) % 3 == 1) for r in out if r.doc_id is not None)


def test_nothing_to_learn_from(spark):
    docs, labels = spark.createDataFrame([(1, "a b")], "doc_id long, text string"), spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert toxicity.predict(docs, labels).first().score == 0
    assert toxicity.predict(docs.where("false"), labels).count() == 0


def test_windows_cover_every_word():
    for n in (0, 1, 15, 16, 17, 24, 100):
        windows, owner = toxicity.cut([np.arange(1, n + 1, dtype=np.int32)])
        assert set(windows.ravel()) - {0} == set(range(1, n + 1)) and len(owner) == len(windows)
