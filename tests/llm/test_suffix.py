import hashlib
import random

import numpy as np
import pytest

from tesselake.llm import suffix


def brute(rows, width=50):
    first = {}
    for doc, text in rows:
        b = (text or "").encode()
        if doc is not None:
            for i in range(len(b) - width + 1):
                s = b[i : i + width]
                first[s] = min(first.get(s, doc), doc)
    out = []
    for doc, text in rows:
        b = (text or "").encode()
        gone = np.zeros(len(b), bool)
        for i in range(len(b) - width + 1):
            if doc is not None and first[b[i : i + width]] < doc:
                gone[i : i + width] = True
        kept = bytes(np.frombuffer(b, np.uint8)[~gone])
        out.append((doc, len(b), int(gone.sum()), int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum()), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("letters", [1, 2, 4, 100, 256])
def test_order_keeps_equal_prefixes_together(letters):
    rng = np.random.default_rng(letters)
    for n in (1, 2, 3, 4, 5, 9, 50, 500, 3000):
        t = rng.integers(0, letters, n).astype(np.uint8)
        order = suffix.difference_cover_order(t, 50)
        assert sorted(order.tolist()) == list(range(n))
        b = t.tobytes()
        prefixes = [b[i : i + 50] for i in order]
        assert prefixes == sorted(prefixes)


def rows_with_repeats():
    rng = random.Random(4)
    words = ["alpha", "bé", "gamma ", "δελτα", "\n", "e" * 30, "zeta eta "]
    passage = ["".join(rng.choice(words) for _ in range(rng.randrange(8, 60))) for _ in range(6)]
    rows = []
    for i in range(120):
        text = "".join(rng.choice(words) for _ in range(rng.randrange(30)))
        for _ in range(rng.randrange(3)):
            at = rng.randrange(len(text) + 1)
            text = text[:at] + rng.choice(passage)[rng.randrange(9) :] + text[at:]
        rows.append((i, text))
    rows += [(200, None), (201, ""), (202, rows[3][1]), (203, rows[3][1]), (204, "a" * 400), (205, "a" * 49), (206, "a" * 70), (None, rows[5][1]), (7, rows[7][1]), (8, rows[9][1]), (207, "x" * 20_000 + rows[10][1])]
    return rows


def test_equals_brute_force(spark):
    rows = rows_with_repeats()
    df = spark.createDataFrame([(*r, "k", 1) for r in rows], "doc_id long, text string, kept string, id int")
    for size, most in ((1 << 30, 1_000_000), (2000, 1_000_000), (1 << 30, 3000)):
        out = suffix.deduplicated(df, bucket_bytes=size, most=most).select("id", "n_bytes", "n_removed", "n_spans", "kept_sha256").collect()
        assert sorted(map(tuple, out), key=str) == brute(rows)


def test_empty(spark):
    assert suffix.deduplicated(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_equal_windows_have_equal_keys():
    rng = np.random.default_rng(0)
    a = rng.integers(0, 5, 500).astype(np.uint8)
    b = np.concatenate([rng.integers(0, 5, 37).astype(np.uint8), a[100:180], rng.integers(0, 5, 90).astype(np.uint8)])
    for k in (12, 26):
        x, y = suffix.window_keys(a, 50, k), suffix.window_keys(b, 50, k)
        assert (x[100:131] == y[37:68]).all()
        naive = [min(suffix.gram_hashes(a[i : i + 50], k)) for i in range(len(a) - 49)]
        assert x.tolist() == naive
