"""Each stage, and the whole, on a small corpus with planted cases."""

import random

import pytest

import corpus_pipeline as cp
from tesselake.llm import jaccard, suffix


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    rng = random.Random(8)
    word = lambda: "".join(rng.choice("ka ko mi tu ra ne so li be du".split()) for _ in range(rng.randrange(1, 4)))
    texts = [" ".join(word() for _ in range(rng.randrange(20, 120))) for _ in range(200)]
    for i in range(0, 200, 4):
        w = texts[i].split()
        for _ in range(3):
            w.insert(rng.randrange(len(w)), rng.choice(["grumblewort", "snarkface"]))
        texts[i] = " ".join(w)
    shared = " ".join(word() for _ in range(40))
    rows = [(i, t, "en", "src", len(t), 1) for i, t in enumerate(texts)]
    extra = [texts[1], texts[1] + " plus", texts[3] + " " + shared, texts[5] + " " + shared, " ".join(word() for _ in range(50)) + " password=hunter2hunter2 end", None, ""]
    rows += [(1000 + i, t, "en", "src", len(t or ""), 2) for i, t in enumerate(extra)] + [(None, texts[2] + " ka ko mi", "en", "src", 17, 3)]
    root = tmp_path_factory.mktemp("sf")
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, sha int").write.parquet(f"{root}/documents.parquet")
    spark.createDataFrame([(i, 1, int(i % 4 == 0)) for i in range(150)], "doc_id long, quality int, toxic int").write.parquet(f"{root}/labels.parquet")
    return str(root)


def test_stages_and_run(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    clean = cp.remove_toxic(spark, docs, folder).cache()
    assert clean.columns == docs.columns
    gone = {r.doc_id for r in docs.select("doc_id").subtract(clean.select("doc_id")).collect()}
    assert len(gone & set(range(0, 200, 4))) >= 48 and len(gone - set(range(0, 200, 4))) <= 2
    one = cp.one_of_each(spark, clean, folder).cache()
    ids = {r.doc_id for r in one.select("doc_id").collect()}
    assert 1 in ids and not ids & {1000, 1001} and {None, 1005, 1006} <= ids and one.columns == docs.columns
    cut = cp.cut_repeats(spark, one, folder).cache()
    by = {r.doc_id: r for r in cut.collect()}
    assert cut.columns == docs.columns and by[1005].text is None and by[1006].text == ""
    assert all(r.n_chars == len(r.text) for r in by.values() if r.text is not None)
    blank = {r.doc_id: r.text for r in cp.blank_secrets(spark, cut, folder).collect()}
    assert "[ASSIGN]" in blank[1004] and "hunter2" not in blank[1004] and len(blank) == len(by)
    out = cp.run(spark, folder)
    assert {r.doc_id for r in out.select("doc_id").collect()} == set(blank)
    assert out.groupBy("sequence_id").sum("length").where("`sum(length)` > 4096").count() == 0
    assert [n for n, _ in cp.STAGES] == ["toxicity", "near_duplicates", "repeated_passages", "secrets", "packing"]


def test_different_texts_of_one_id_stay(spark):
    long = [" ".join(f"{w}{i}" for i in range(60)) for w in "abc"]
    rows = [(1, long[0], "x"), (1, long[1], "y"), (1, long[1], "z"), (2, long[0] + " more", "x"), (3, long[2], "x"), (4, "", "x"), (4, None, "y"), (4, "  ", "x"), (None, long[0], "x"), (None, long[0], "x")]
    out = cp.one_of_each(spark, spark.createDataFrame(rows, "doc_id long, text string, h string"), "")
    found = sorted(((r.doc_id, r.text) for r in out.collect()), key=str)
    assert out.columns == ["doc_id", "text", "h"]
    assert found == sorted([(1, long[0]), (1, long[1]), (3, long[2]), (4, ""), (4, None), (4, "  "), (None, long[0]), (None, long[0])], key=str)


def test_a_held_result_outlives_later_runs(spark, folder):
    import threading

    docs = spark.read.parquet(f"{folder}/documents.parquet")
    held = jaccard.linked(docs)
    first = sorted(map(str, held.collect()))
    cp.run(spark, folder).count()
    assert sorted(map(str, held.collect())) == first
    found = {}
    threads = [threading.Thread(target=lambda f=f: found.update({f.__name__: f(docs).count()})) for f in (jaccard.linked, suffix.deduplicated)]
    for x in threads:
        x.start()
    for x in threads:
        x.join()
    assert found == {"linked": docs.count(), "deduplicated": docs.count()}


def test_empty(spark, folder):
    none = spark.read.parquet(f"{folder}/documents.parquet").where("false")
    for _, stage in cp.STAGES:
        assert stage(spark, none, folder).count() == 0
