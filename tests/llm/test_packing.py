import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tesselake.llm import packing

PATH = public_tokenizers.path("word_bpe_49k.json")
ODD = ["", None, "It's  done'll I've", "a\x1cb  c", "ΑΣ ΣΑΣ", "J̌ é É İx K", "<|endoftext|> hi<|startoftext|>there", "x²³ 12½ ab12cd", "naïve—test…ok ŁÓDŹ", "don't! can't's '''s", "   ", "日本語テキスト です", "a_b__c", "ﬀ ﬁ ǅ", "﻿bom a​b", "word " * 9000, "é."]


def test_ids_equal_the_tokenizers():
    t, enc = Tokenizer.from_file(PATH), packing.Encoder(PATH)
    texts = [x or "" for x in ODD]
    for _ in range(2):
        flat, at = enc.batch(texts)
        for i, x in enumerate(texts):
            assert flat[at[i] : at[i + 1]].tolist() == t.encode(x, add_special_tokens=False).ids


def test_pieces_and_places(spark):
    rows = [(i, x, 1) for i, x in enumerate(ODD)] + [(3, ODD[3], 2), (None, "no id", 3)] + [(100 + i, "many words here " * (i % 90), 4) for i in range(300)]
    out = packing.pack_documents(spark.createDataFrame(rows, "doc_id long, text string, length int"), PATH).toPandas()
    t = Tokenizer.from_file(PATH)
    want = {}
    for doc, text, _ in rows:
        ids = np.array([*t.encode(text or "", add_special_tokens=False).ids, 1], "<u4")
        for k, s in enumerate(range(0, len(ids), 4096)):
            want.setdefault((doc, k), []).append((s, len(ids[s : s + 4096]), zlib.crc32(ids[s : s + 4096].tobytes())))
    assert len(out) == sum(map(len, want.values()))
    for r in out.astype(object).where(out.notna(), None).itertuples():
        assert (r.start, r.length, r.ids_crc32) in want[(r.doc_id, r.piece)]
    for _, g in out.sort_values("offset").groupby("sequence_id"):
        assert g.offset.tolist() == [0, *g.length.cumsum()[:-1]] and g.length.sum() <= 4096
    total = out.length.sum()
    assert out.sequence_id.nunique() <= -(-total // 4096) + 2
    assert packing.pack_documents(spark.createDataFrame([], "doc_id long, text string"), PATH).count() == 0


@pytest.mark.parametrize("per_task", [200, 2000])
def test_tree_of_rounds(spark, per_task):
    rng = np.random.default_rng(0)
    sizes = rng.integers(1, 4096, 1500)
    items = spark.createDataFrame([(i, 0, 0, int(n), 0) for i, n in enumerate(sizes)], packing.ITEM)
    out = packing.pack(items, per_task=per_task).toPandas()
    assert sorted(out.doc_id) == list(range(1500))
    assert out.groupby("sequence_id").length.sum().max() <= 4096
    best = len(packing.best_fit(sorted(sizes.tolist(), reverse=True), 4096))
    assert out.sequence_id.nunique() <= 1.02 * best + 1


def test_many_rounds_and_equal_items(spark):
    rng = np.random.default_rng(1)
    sizes = [*rng.integers(1, 400, 600).tolist(), *[2500] * 900, *rng.integers(3000, 4000, 200).tolist()]
    items = spark.createDataFrame([(7 if n == 2500 else i, 0, 0, int(n), 5) for i, n in enumerate(sizes)], packing.ITEM)
    out = packing.pack(items, per_task=50, fan=3).toPandas()
    assert sorted(out.length) == sorted(sizes)
    for _, g in out.sort_values("offset").groupby("sequence_id"):
        assert g.offset.tolist() == [0, *g.length.cumsum()[:-1]] and g.length.sum() <= 4096
    # no more than one sequence is half full, as all small bins have met
    assert (out.groupby("sequence_id").length.sum() <= 2048).sum() <= 1


@pytest.mark.parametrize("seed", range(12))
def test_passing_on_useful_bins_loses_none(seed):
    """Rounds over all bins, and over those that ``pack`` passes on, end with as many sequences."""
    rng = np.random.default_rng(seed)
    parts = [rng.integers(1, int(rng.choice([300, 3000, 4096])), int(rng.integers(1, 60))).tolist() for _ in range(27)]

    def rounds(useful):
        closed, tasks = 0, [sorted(p, reverse=True) for p in parts]
        while True:
            tasks = [[sum(t[i] for i in b) for b in packing.best_fit(t, 4096)] for t in tasks]
            small = [f for t in tasks for f in t if f <= 2048]
            if len(tasks) == 1 or not small:
                return closed + sum(map(len, tasks))
            on = [[f for k, f in enumerate(sorted(t)) if not useful or (sorted(t)[:k].count(f) < len(small) and f <= 4096 - min(small))] for t in tasks]
            closed += sum(map(len, tasks)) - sum(map(len, on))
            tasks = [sorted((f for t in on[i : i + 3] for f in t), reverse=True) for i in range(0, len(on), 3)]

    assert rounds(True) == rounds(False)


def test_another_tokenizer_encodes_whole_texts():
    path = public_tokenizers.path("byte_bpe_50k.json")
    enc, t = packing.Encoder(path), Tokenizer.from_file(path)
    assert not enc.chunks and packing.Encoder(PATH).chunks
    flat, at = enc.batch([x or "" for x in ODD])
    assert [flat[i:j].tolist() for i, j in zip(at[:-1], at[1:])] == [t.encode(x or "", add_special_tokens=False).ids for x in ODD]
