import hashlib
import random
import re

import pytest

from pyspark.sql import functions as F

from tesselake.llm import merkle


def sha(level, x):
    return hashlib.sha256((level + x).encode()).hexdigest()


def pieces(line):
    """The leaves of a line: up to eight words with their blanks, ended early by a word that ends a sentence."""
    out, count = [""], 0
    for word in re.findall(r"[^ ]* +|[^ ]+", line):
        out[-1] += word
        count += 1
        if count == 8 or (word.endswith(" ") and word.rstrip(" ")[-1:] in (".", "!", "?")):
            out.append("")
            count = 0
    return [x for x in out if x]


def tree(text):
    lines = re.split("(?<=\n)", text) if text else [""]
    leaves = [[sha("L", x) for x in pieces(p)] for p in lines]
    assert "".join(x for p in lines for x in pieces(p)) == text
    sections = [[]]
    for p in leaves:
        sections[-1].append((sha("P", "".join(p)), p))
        if sections[-1][-1][0][0] < "4":
            sections.append([])
    sections = [(sha("S", "".join(h for h, _ in s)), s) for s in sections if s]
    return sha("R", "".join(h for h, _ in sections)), sections


def printed(text):
    root, sections = tree(text)
    return root + ":" + "/".join(h[:8] + "[" + ".".join("".join(x[:6] for x in p) for _, p in s) + "]" for h, s in sections)


def likeness(a, b):
    (ra, a), (rb, b) = tree(a), tree(b)
    if ra == rb:
        return 1.0
    count = lambda s: sum(len(p) for _, ps in s for _, p in ps)
    total, apart = 0, 0
    for x, y in ((a, b), (b, a)):
        rest = [p for h, ps in x if h not in {g for g, _ in y} for p in ps]
        other = [p for h, ps in y if h not in {g for g, _ in x} for p in ps]
        low = [l for h, p in rest if h not in {g for g, _ in other} for l in p]
        others = {l for h, p in other if h not in {g for g, _ in rest} for l in p}
        total += count(x) - len(low) + len(set(low))
        apart += len(set(low) - others)
    return (total - apart) / total if total else 1.0


def corpus():
    rng = random.Random(5)
    words = ["eins", "zwei.", "drei!", "é\x01", "", "\n", "four", "five?", "\x01", "sechs\t", "𓀀", "a.b", "\r\n"]
    texts = [" ".join(rng.choice(words) for _ in range(rng.randrange(60))) for _ in range(40)]
    texts += ["Hello there. World", "Hello there.\x01World", "Hello there.\x01 World", "abc", "abc", "", None, "\n", "\n\n", "  lead and trail  ", "x" * 5000 + "\n" + "y z. " * 300]
    long = [" ".join(rng.choice(words[:3]) for _ in range(6)) + f" {i}" for i in range(60)]
    return texts + ["\n".join(long), "\n".join(long[:20] + ["new"] + long[20:]), "\n".join(long[:30] + long[31:]), "\n".join(reversed(long))]


@pytest.mark.parametrize("buckets", [1, 3, 40])
def test_edits_equal_brute_force(spark, buckets):
    texts = corpus()
    ids = list(range(len(texts)))
    random.Random(1).shuffle(ids)
    rows = sorted(zip(ids, texts), reverse=True)
    out = {r.doc_id: r for r in merkle.edits(spark.createDataFrame([(*r, "other", 1) for r in rows], "doc_id long, text string, next string, b int").repartition(3), buckets).collect()}
    assert len(out) == len(rows)
    for i, (doc, text) in enumerate(rows):
        a, b = text or "", rows[(i + 1) % len(rows)][1] or ""
        half = len(a) // 2
        edited, r = a[: len(a) - half] + b[:half], out[doc]
        assert (r.n_chars, r.edited_sha256) == (len(a), hashlib.sha256(edited.encode()).hexdigest())
        assert (r.fingerprint, r.edited_fingerprint) == (printed(a), printed(edited))
        assert r.near_edited == pytest.approx(likeness(a, edited), abs=1e-12)
        assert r.near_next == pytest.approx(likeness(a, b), abs=1e-12)
        assert (r.fingerprint == r.edited_fingerprint) == (a == edited)


def test_a_control_character_is_no_blank(spark):
    texts = ["Hello there. World", "Hello there.\x01World"]
    df = merkle.fingerprint(spark.createDataFrame([(x,) for x in texts], "text string"), "text")
    assert len({r.fingerprint for r in df.select("fingerprint").collect()}) == 2


def sections_of(spark, text):
    return merkle.fingerprint(spark.createDataFrame([(text,)], "text string"), "text").first().fingerprint.split(":")[1].split("/")


@pytest.mark.parametrize("at", [0, 17, 39])
def test_an_inserted_or_deleted_line_leaves_most_sections(spark, at):
    lines = [f"line {i} has words of its own." for i in range(40)]
    before = sections_of(spark, "\n".join(lines))
    for changed in (lines[:at] + ["something else."] + lines[at:], lines[:at] + lines[at + 1 :]):
        after = sections_of(spark, "\n".join(changed))
        assert len(set(before) - set(after)) <= 2 and len(set(after) - set(before)) <= 2 and len(before) >= 6


def test_differing_branches_locate_edits(spark):
    lines = [f"line {i} has words of its own. It has another sentence." for i in range(40)]
    changed = [*lines[:9], "It is new.", *lines[9:20], lines[20].replace("another", "a"), *lines[21:30], *lines[31:]]
    df = merkle.places(spark.createDataFrame([("\n".join(lines), "\n".join(changed), 7)], "old string, new string, places int").drop("places"), "old", "new")
    r = df.first()
    assert [tuple(x) for x in r.places] == [(9, 0, "It is new.\n"), (21, 1, "It has a sentence.\n")]
    assert set(df.columns) == {"old", "new", "places"}


def test_odd_tables(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert merkle.edits(empty).count() == 0
    one = merkle.edits(spark.createDataFrame([(1, "ab")], "doc_id long, text string")).collect()
    assert one[0].edited_sha256 == hashlib.sha256(b"aa").hexdigest()
    many = spark.createDataFrame([(1, "a"), (1, "a"), (1, "b"), (None, "c"), (None, None)], "doc_id long, text string")
    assert merkle.edits(many, 3).count() == 5


def test_a_hot_id_and_hot_rows(spark):
    rows = [(7, f"text {i % 40} of one id. It goes on.") for i in range(400)] + [(7, "the same row. Again.")] * 3500 + [(i, f"other text {i}") for i in range(10, 60)] + [(None, f"none {i % 5}") for i in range(200)] + [(None, "hot none")] * 1500
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    plain, counted = ([tuple(r) for r in merkle.edits(df, 8, many=many).orderBy(F.col("doc_id"), "fingerprint", "edited_fingerprint").collect()] for many in (100_000, 1000))
    assert len(plain) == len(rows) and plain == counted
    # equal rows follow each other: only the last of them is followed by another text
    same = [r for r in counted if r[0] == 7 and r[3] == printed("the same row. Again.")]
    assert len(same) == 3500 and sum(r[6] == 1.0 for r in same) == 3499
