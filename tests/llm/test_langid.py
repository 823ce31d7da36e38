import random
from zlib import crc32

import numpy as np

from tesselake.llm import langid

WORDS = {"xx": "ka ko mi tu ra ne so li".split(), "yy": "böck gräm tüsch ölf würm ßat".split()}


def text(lang, rng, n=60):
    return " ".join("".join(rng.choice(WORDS[lang]) for _ in range(rng.randrange(1, 4))) for _ in range(n))


def test_held_out_accuracy_and_odd_rows(spark):
    rng = random.Random(1)
    rows = [(i, text(lang := rng.choice(["xx", "yy"]), rng), lang, "a") for i in range(200)]
    rows += [(1000, None, "xx", "a"), (1001, "", None, "a"), (1002, "12 34 !", "yy", "a"), (None, text("xx", rng), None, "a"), (7, rows[7][1], rows[7][2], "b"), (1003, text("yy", rng, 40_000), None, "c")]
    out = langid.classify(spark.createDataFrame(rows, "doc_id long, text string, lang string, score string")).collect()
    assert len(out) == len(rows)
    by = {r.doc_id: r for r in out}
    assert all(by[i].lang_pred == "und" and by[i].score == 0 for i in (1000, 1001, 1002))
    assert all(by[r[0]].lang_pred == r[2] for r in rows[:200] if by[r[0]].held_out)
    assert all(r.held_out == (crc32(str(r.doc_id).encode()) % 5 == 0) for r in out if r.doc_id is not None)
    assert by[1003].lang_pred == "yy" and all(0 <= r.score <= 1 for r in out)


def test_nothing_to_learn_from(spark):
    df = spark.createDataFrame([(1, "abc", None)], "doc_id long, text string, lang string")
    assert langid.classify(df).first().lang_pred == "und"
    assert langid.classify(df.where("false")).count() == 0


def test_folded_weights_equal_kernel_form():
    rng = random.Random(2)
    samples = [(text(lang, rng), lang) for lang in ("xx", "yy") for _ in range(20)]
    ridge = 1e-3
    m = langid.fit(samples, landmarks=10, ridge=ridge)
    x = langid.presence([t.lower() for t, _ in samples])
    cells = lambda a: [set(np.flatnonzero(r).tolist()) for r in a]
    kernel = lambda a, b: np.array([[len(p & q) / np.sqrt(len(p) * len(q)) for q in b] for p in a])
    points, land = cells(x), cells(m.land)
    assert len(land) == 10
    values, vectors = np.linalg.eigh(kernel(land, land))
    feats = kernel(points, land) @ (vectors / np.sqrt(values))
    assert np.allclose(m.scores(x), feats @ m.theta, atol=1e-4)
    # the ridge regression's normal equations hold, one language against the rest
    y = np.array([m.langs.index(lang) for _, lang in samples])
    target, weight = np.where(y[:, None] == np.arange(2), 1.0, -1.0), 1 / 20
    assert np.allclose(weight * feats.T @ (feats @ m.theta - target) + ridge * m.theta, 0, atol=1e-4)
    assert (np.array(m.langs)[m.scores(x).argmax(1)] == [lang for _, lang in samples]).all()


def test_a_rare_language_and_hot_rows_are_learned_from(spark):
    rng = random.Random(3)
    rows = [(i, text("xx", rng, 3000), "xx") for i in range(120)] + [(5000 + i, text("yy", rng, 12), "yy") for i in range(6)]
    rows += [(1, "der eine Text", "xx")] * 300
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    m = langid.train(df, per_lang=50, per_doc=2, most=20)
    assert m.langs == ["xx", "yy"]
    found = langid.predict([text("xx", rng), text("yy", rng)], m)
    assert [x for x, _ in found] == ["xx", "yy"]


def test_presence_counts_no_gram_across_pieces():
    one, two = langid.presence(["ab", "cd"])
    assert np.array_equal(one, langid.presence(["ab"])[0]) and np.array_equal(two, langid.presence(["cd"])[0])
