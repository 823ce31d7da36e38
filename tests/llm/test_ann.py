import numpy as np

from tesselake.llm import ann


def brute(rows, every, k):
    ok = [(i, np.array(v, float)) for i, v in rows if i is not None and v is not None and None not in v and np.isfinite(v).all() and np.any(v) and len(v) == 8]
    ok.sort(key=lambda r: r[0])
    ids, x = np.array([i for i, _ in ok]), np.array([v for _, v in ok])
    out = {}
    for i, q in ok:
        if i % every == 0:
            s = (q * x).sum(1)
            s[ids == i] = -np.inf
            top = np.lexsort((ids, -s))[:k]
            out[i] = [(int(ids[j]), float(s[j])) for j in top if np.isfinite(s[j])]
    return out


def test_search_equals_brute_force(spark):
    rng = np.random.default_rng(1)
    rows = [(i, rng.standard_normal(8).astype(np.float32).tolist()) for i in range(900)]
    rows += [(1000 + i, rows[5][1]) for i in range(60)]
    rows += [(2000, None), (2020, [0.0] * 8), (2040, [1.0] * 7 + [float("nan")]), (2060, [1.0] * 7 + [None]), (None, [1.0] * 8), (2100, [float("inf")] * 8)]
    df = spark.createDataFrame([(*r, 1) for r in rows], "vec_id long, embedding array<float>, score int")
    out = ann.search(df, every=20, k=7, block=300, query_block=20, rerank=0).toPandas().sort_values(["query_id", "rank"])
    want = brute(rows, 20, 7)
    assert set(out.query_id) == set(want)
    for q, g in out.groupby("query_id"):
        assert g["rank"].tolist() == list(range(1, 8))
        assert g.vec_id.tolist() == [i for i, _ in want[q]]
        assert np.allclose(g.score, [s for _, s in want[q]], atol=1e-12)


def recall(out, x, k):
    hits = 0
    for q, g in out.groupby("query_id"):
        s = x @ x[q]
        s[q] = -np.inf
        hits += len(set(g.vec_id) & set(np.argsort(-s)[:k]))
    return hits / (k * out.query_id.nunique())


def test_recall_where_the_codes_decide(spark):
    x = np.random.default_rng(2).standard_normal((3000, 32))
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    # of one block of 3000 only 20 rows are scored exactly: less than a hundredth
    assert recall(ann.search(df, every=50, k=10, block=3000, rerank=20).toPandas(), x, 10) >= 0.9
    # blocks enough for two rounds of merges
    assert recall(ann.search(df, every=50, k=10, block=20, rerank=0).toPandas(), x, 10) == 1.0


def test_equal_vectors_and_repeated_ids(spark):
    rng = np.random.default_rng(4)
    x = rng.standard_normal((200, 8))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    rows = [(i, v.tolist()) for i, v in enumerate(x)] + [(500 + i, x[7].tolist()) for i in range(700)] + [(40, (0.9 * x[i % 200]).tolist()) for i in range(300)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(5)
    out = ann.search(df, every=20, k=5, block=400, rerank=10).toPandas()
    assert len(out) == 5 * sum(i % 20 == 0 for i, _ in rows)
    assert not (out.query_id == out.vec_id).any()
    found = out[out.query_id == 500].sort_values("rank")  # the equal vectors of smallest ids, without itself
    assert found.vec_id.tolist() == [7, 501, 502, 503, 504]


def test_lengths_are_searched_apart(spark):
    rows = [(i, [float(i % 7 + 1), 1.0, float(i % 3)]) for i in range(30)] + [(100 + i, [1.0, float(i)]) for i in range(30)]
    out = ann.search(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), every=20, k=3).toPandas()
    assert set(out.query_id) == {0, 20, 100, 120} and ((out.query_id < 100) == (out.vec_id < 100)).all()


def test_packed_scan_equals_the_sum_of_tables():
    rng = np.random.default_rng(5)
    for dim in (5, 8):
        x = rng.standard_normal((300, dim))
        m = ann.fit(x)
        codes, tables = m.encode(x), m.tables(x[:20])
        packed = ann.packed_codes(codes)
        assert packed.shape == (300, (dim + 1) // 2) and packed.dtype == np.uint8
        plain = sum(tables[j][codes[:, j]] for j in range(dim))
        assert np.allclose(m.scan(packed, tables), plain, atol=1e-5)


def test_few_rows_and_none(spark):
    df = spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.5, 0.5])], "vec_id long, embedding array<double>")
    assert [tuple(r) for r in ann.search(df, every=20).collect()] == [(0, 1, 1, 0.5)]
    assert ann.search(df.where("false"), every=20).count() == 0


def test_anisotropic_loss_favours_small_parallel_error():
    rng = np.random.default_rng(3)
    x = rng.standard_normal((2000, 8))
    aware, plain = ann.fit(x, threshold=0.5), ann.fit(x, threshold=0.0)

    def parallel(m):
        c = m.encode(x, 2)
        y = np.concatenate([m.books[j][c[:, j]] for j in range(len(m.books))], 1)
        return (((x - y) * x).sum(1) ** 2 / (x * x).sum(1)).mean()

    assert parallel(aware) < parallel(plain)
