import random
import re

import numpy as np
import pytest

from tesselake.llm import jaccard
from tesselake.llm.components import components


def shingles(text, width=4):
    w = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().lower())
    return frozenset(tuple(w[i : i + width]) for i in range(max(1, len(w) - width + 1))) if w else frozenset()


def brute(rows, num=85, width=4):
    sets = {i: shingles(t, width) for i, t in rows if i is not None}
    label = {i: i for i in sets}

    def root(x):
        while label[x] != x:
            x = label[x]
        return x

    ids = sorted(sets)
    for i in ids:
        for j in ids:
            a, b = sets[i], sets[j]
            if i < j and a and b and 100 * len(a & b) >= num * len(a | b):
                x, y = root(i), root(j)
                label[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), root(i)) for i in ids}


def family_rows(seed, n=150, longest=120):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdé") for _ in range(rng.randrange(1, 6)))
    rows, base = [], []
    for i in range(n):
        if base and rng.random() < 0.6:
            w = list(rng.choice(base))
            for _ in range(rng.randrange(1 + len(w) // 15)):
                if w:
                    w[rng.randrange(len(w))] = word()
            if rng.random() < 0.2:
                w = w[: int(len(w) * 0.9)]
        else:
            w = [word() for _ in range(rng.randrange(longest))]
            base.append(w)
        rows.append((i, rng.choice([" ", "\t", " \n", "\x0b"]).join(w)))
    return rows


@pytest.mark.parametrize("seed", [1, 2])
@pytest.mark.parametrize(("num", "width"), [(85, 4), (80, 5)])
def test_equals_brute_force(spark, seed, num, width):
    rows = family_rows(seed) + [(500, None), (501, ""), (502, " \n"), (503, "one two"), (504, "One TWO"), (505, "ÉINS"), (506, "éins")]
    df = spark.createDataFrame([(*r, 1, "c") for r in rows], "doc_id long, text string, n int, component string")
    out = {r.doc_id: (r.n, r.component) for r in jaccard.linked(df, t=jaccard.Threshold(num, 100), width=width).collect()}
    assert out == brute(rows, num, width)


def test_large_groups_are_settled(spark):
    rng = random.Random(9)
    base = [f"w{i}" for i in range(60)]
    rows = []
    for i in range(150):
        w = list(base)
        for _ in range(rng.randrange(3)):
            w[rng.randrange(60)] = f"x{rng.randrange(1000)}"
        rows.append((i, " ".join(w)))
    out = {r.doc_id: (r.n, r.component) for r in jaccard.linked(spark.createDataFrame(rows, "doc_id long, text string"), few=3).collect()}
    assert out == brute(rows)


def set_rows(rng, kind, n):
    """Sets of numbers: copies of one base, a chain in which only neighbours are linked, a star around one set, or strangers."""
    base = rng.choice(10**9, 200, False)
    if kind == "chain":
        long = rng.choice(10**9, 200 + 10 * n, False)
        return [long[10 * i : 10 * i + 200] for i in range(n)]
    if kind == "strangers":
        return [np.concatenate([base[:100], rng.choice(10**9, 100, False)]) for _ in range(n)]
    apart = {"copies": 5, "star": 15}[kind]
    return [base, *(np.concatenate([rng.permutation(base)[apart:], rng.choice(10**9, apart, False)]) for _ in range(n - 1))]


@pytest.mark.parametrize("kind", ["copies", "all"])
def test_families_over_several_blocks(spark, kind):
    rng, t = np.random.default_rng(3), jaccard.Threshold()
    made = [x for k in (["copies", "chain", "star", "strangers"] if kind == "all" else [kind]) for x in set_rows(rng, k, 90)]
    made = [np.unique(x).astype(np.int64) for x in made]
    keys = [int(k) for k in rng.permutation(10_000)[: len(made)]]
    sets = spark.createDataFrame([(k, x.tolist()) for k, x in zip(keys, made)], "key long, s array<long>")
    family = spark.createDataFrame([(k, 1, int(rng.integers(5)), len(x)) for k, x in zip(keys, made)], "key long, family long, c long, n long")
    label = {k: k for k in keys}
    for i, a in enumerate(made):
        for j in range(i):
            both = len(np.intersect1d(a, made[j]))
            if 100 * both >= 85 * (len(a) + len(made[j]) - both):
                x, y = label[keys[i]], label[keys[j]]
                label = {k: min(x, y) if v in (x, y) else v for k, v in label.items()}
    for block in (1000, 30):
        links = [tuple(r) for r in jaccard.family_links(family, sets, t, block=block).collect()]
        by = dict(zip(keys, made))
        for a, b in links:
            both = len(np.intersect1d(by[a], by[b]))
            assert 100 * both >= 85 * (len(by[a]) + len(by[b]) - both)
        out = {r.id: r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
        assert {k: out.get(k, k) for k in keys} == label
        if kind == "copies":  # rows in proportion to the family, whatever the number of blocks
            assert len(links) <= 9 * len(made)


def test_long_texts_and_hot_ids(spark):
    rng = random.Random(11)
    long = [f"w{rng.randrange(10**6)}" for _ in range(30_000)]
    rows = [(1, " ".join(long)), (2, " ".join(long[:29_000])), (3, " ".join(long[:20_000])), (4, "x" * 500_000), (5, "x" * 500_000)]
    rows += [(9, f"text {i % 40} of the one id that many rows have") for i in range(300)]
    out = {(r.doc_id, r.n, r.component) for r in jaccard.linked(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert {(i, c) for i, _, c in out} == {(1, 1), (2, 1), (3, 3), (4, 4), (5, 4), (9, 9)}


def test_odd_rows(spark):
    df = spark.createDataFrame([(None, "a b c d"), (1, "a b c d"), (1, "a b c d"), (2, "a b c d")], "doc_id long, text string")
    assert sorted([(r.doc_id or 0, r.n, r.component) for r in jaccard.linked(df).collect()]) == [(0, 1, None), (1, 1, 1), (1, 1, 1), (2, 1, 1)]
    assert jaccard.linked(df.where("false")).count() == 0


@pytest.mark.parametrize("size", [7, 13, 40, 300, 1500])
def test_every_pair_within_the_threshold_shares_a_signature(size):
    t, rng = jaccard.Threshold(), np.random.default_rng(size)
    for _ in range(30):
        apart = t.most_apart(2 * size)
        a = np.unique(rng.integers(0, 2**63, size).astype(np.uint64))
        out, new = int(rng.integers(0, apart + 1)), 0
        new = apart - out
        b = np.unique(np.concatenate([a[out:], rng.integers(0, 2**63, new).astype(np.uint64)]))
        both = len(np.intersect1d(a, b))
        if 100 * both < 85 * (len(a) + len(b) - both):
            continue
        small, large = sorted((a, b), key=len)
        band = t.band(len(large))
        for docs, steps in ((1, 0), (1, jaccard.enough(large, t)), (10**9, jaccard.enough(large, t))):
            plan = jaccard.allocate(t, band, docs, steps)
            if plan is None:
                assert np.array_equal(a, b)
                continue
            shared = np.intersect1d(jaccard.signatures(small, band, plan), jaccard.signatures(large, band, plan))
            assert len(shared) > (plan.frequent if plan.exact else 0)


def test_components(spark):
    chain = [(i, i + 1) for i in range(40)] + [(100, 90), (7, 7)]
    out = {r.id: r.component for r in components(spark.createDataFrame(chain, "a long, b long")).collect()}
    assert all(out[i] == 0 for i in range(41)) and out[90] == out[100] == 90
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


@pytest.mark.parametrize("num", [80, 85])
def test_more_sets_need_no_more_signatures(num):
    t = jaccard.Threshold(num, 100)
    for size in (40, 100, 300, 1000, 5000):
        few, many = (jaccard.allocate(t, t.band(size), sets, 15) for sets in (100, 300_000))
        assert many == few and many.exact and not many.deletion


def test_passes_deal_each_signature_once(spark):
    rows = family_rows(4)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    t = jaccard.Threshold()
    plan = {k: jaccard.allocate(t, k, 100, 15) for k in range(60)}

    def dealt(*turn):
        return sum(len(r.sig) // 6 for r in jaccard.dealt_signatures(df.coalesce(1), "text", plan, t, 4, 3, 16, *turn).collect())

    parts = [dealt(i, 4) for i in range(4)]
    assert sum(parts) == dealt() and max(parts) < sum(parts) / 3
    out = {r.doc_id: (r.n, r.component) for r in jaccard.linked(df, few=3, per_shingle=9, room=1).collect()}
    assert out == brute(rows)


def test_a_family_is_joined_by_about_a_link_for_each_set(spark):
    rng = np.random.default_rng(5)
    made = [np.unique(x).astype(np.int64) for x in set_rows(rng, "copies", 120)]
    sets = spark.createDataFrame([(k, x.tolist()) for k, x in enumerate(made)], "key long, s array<long>")
    family = spark.createDataFrame([(k, 1, k % 5, len(x)) for k, x in enumerate(made)], "key long, family long, c long, n long")
    links = [tuple(r) for r in jaccard.family_links(family, sets, jaccard.Threshold(), block=30).collect()]
    assert len(links) <= 2 * len(made)
    assert {r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()} == {0}
