import numpy as np
import public_tokenizers
import pytest

from tesselake.llm import pieces

PATH = public_tokenizers.path("piece_bpe_32k.model")
MARK = pieces.MARK
ODD = ["", "a", " ", "  a   b ", "The the.\nOf it\n\nx", "日本語テキスト 𓀀 x", "a▁b ▁▁ c", "nul\0byte \0", "x" * 100 + " " + "ab" * 60, "tab\there\r\n", "é̂ ñ", "▁", "\0", " ▁\0 ", "𝔘𝔫𝔦" * 30, "   ", "a  ", "\n a", "internationalization " * 30]


def brute(p, stretch):
    """The full lattice of a unigram model, no window and no early commit."""
    cost, back = [0] + [10**18] * len(stretch), [0] * (len(stretch) + 1)
    price = dict(zip(p.id_at.tolist(), p.cost_at.tolist()))
    for j in range(1, len(stretch) + 1):
        for k in range(min(p.reach, j), 0, -1):
            i = p.ids.get(stretch[j - k : j])
            if i is not None and cost[j - k] + price[i] < cost[j]:
                cost[j], back[j] = cost[j - k] + price[i], k
    out, j = [], len(stretch)
    while j:
        out.append(p.ids[stretch[j - back[j] : j]])
        j -= back[j]
    return out[::-1]


def model_of(path, scores):
    """A unigram model file of given pieces: nothing is trained."""
    from sentencepiece import sentencepiece_model_pb2

    m = sentencepiece_model_pb2.ModelProto()
    m.trainer_spec.model_type, m.trainer_spec.byte_fallback = m.trainer_spec.UNIGRAM, True
    m.normalizer_spec.name, m.normalizer_spec.add_dummy_prefix, m.normalizer_spec.remove_extra_whitespaces, m.normalizer_spec.escape_whitespaces = "identity", True, False, True
    kind = m.pieces.add
    for piece, what in (("<unk>", 2), ("<s>", 3), ("</s>", 3), *((f"<0x{i:02X}>", 6) for i in range(256))):
        kind(piece=piece, score=0.0, type=what)
    for piece, score in scores.items():
        kind(piece=piece, score=score, type=1)
    with open(path, "wb") as f:
        f.write(m.SerializeToString())
    return str(path)


@pytest.fixture(scope="module")
def unigram(tmp_path_factory):
    rng = np.random.default_rng(4)
    made = {c: -9.0 - i / 8 for i, c in enumerate(MARK + "abcdefgh")}
    while len(made) < 400:
        piece = "".join(rng.choice(list("abcdefgh"), rng.integers(2, 9)))
        made[MARK * int(rng.integers(2)) + piece] = -float(rng.integers(64 * 4, 64 * 14)) / 64  # sums of floats are exact
    made |= {"ab" * n: -3.0 * n for n in range(1, 7)}  # many equal sums
    return model_of(tmp_path_factory.mktemp("u") / "u.model", made)


def stretches():
    rng = np.random.default_rng(5)
    made = ["".join(rng.choice(list("abcdefgh"), n)) for n in (1, 2, 3, 8, 13, 14, 15, 16, 17, 31, 40, 41, 64, 333, 5000)]
    return [*made, *(MARK + x for x in made), "ab" * 700, "a" * 600, MARK, MARK * 40]


def test_streaming_equals_the_full_lattice(unigram):
    p = pieces.pieces(unigram)
    for own, ids in zip(stretches(), p.together(stretches())):
        assert ids.tolist() == brute(p, own)
        assert list(p.stream(own)) == ids.tolist()
    assert p.together([]) == []


@pytest.mark.parametrize("which", ["bpe", "unigram"])
def test_stream_commits_within_a_window(which, unigram):
    p, seen = pieces.pieces(PATH if which == "bpe" else unigram), 0
    text = "".join(np.random.default_rng(6).choice(list("abcdefgh"), 4000))

    def characters():
        nonlocal seen
        for seen, c in enumerate(text):
            yield c

    given = 0
    for i in p.stream(characters()):
        given += len(p.text[i])
        assert seen - given < 4 * p.reach or seen == len(text) - 1
    assert given == len(text)


def test_the_ring_grows_while_paths_do_not_meet(tmp_path):
    # with odd and even cuts of equal worth to the end, no boundary is shared until the last character
    path = model_of(tmp_path / "x.model", {MARK: -5.0, "a": -4.0, "aa": -1.0, "b": -1.0, "ab": -1.0})
    p = pieces.pieces(path)
    for n in (300, 301):
        streams = pieces.Streams(p, 1)
        early = [x for c in "a" * n for x in streams.step(np.array([ord(c)]))]
        assert streams.size > 256 or early
        assert p.together(["a" * n + "b"])[0].tolist() == brute(p, "a" * n + "b")


def test_query(spark):
    rows = [(i, t, "x") for i, t in enumerate(ODD)] + [(None, None, "y"), (3, ODD[3], "z")]
    out = pieces.encoded(spark.createDataFrame(rows, "doc_id long, text string, ids string"), PATH)
    assert out.count() == len(rows) and out.where("not round_trip").count() == 0
    back = {(r.doc_id, r.text) for r in pieces.decoded(out, PATH).collect()}
    assert back == {(i, t or "") for i, t, _ in rows}
    assert pieces.encoded(spark.createDataFrame([], "doc_id long, text string"), PATH).count() == 0
    assert np.array_equal(pieces.codec(PATH).encode([])[0], np.zeros(0))


WORDS = ["running", "Transformational", "zzzz", "AKIA12ff", "été", "straße", "日本", "😀", "\n", "\t", " ", "  ", "     ", "x" * 50, "0123456789", "deadbeef" * 8, "don't", "é", "ij" * 30]


def plain_texts():
    rng = np.random.default_rng(3)
    made = ["".join(" " * int(rng.integers(3)) + w for w in rng.choice(WORDS, rng.integers(1, 30))) for _ in range(200)]
    return [t for t in ODD if MARK not in t] + made


def test_ids_of_a_bpe_model_are_those_of_sentencepiece():
    import sentencepiece

    texts = plain_texts()
    want = sentencepiece.SentencePieceProcessor(model_file=PATH).encode(texts)
    c = pieces.codec(PATH)
    for _ in range(2):  # the second time from memory
        flat, at = c.encode(texts)
        assert [flat[i:j].tolist() for i, j in zip(at[:-1], at[1:])] == want
    assert [c.decode(flat[i:j]) for i, j in zip(at[:-1], at[1:])] == texts


def test_streaming_equals_the_merges():
    p = pieces.pieces(PATH)
    rng = np.random.default_rng(7)
    made = [MARK + "internationalization", MARK * 17, MARK + "aaaaaaaaaaaab", "0123", "deadbeef" * 30, *("".join(rng.choice(list("etaoinsh1/_"), n)) for n in (1, 5, 16, 17, 39, 40, 41, 200))]
    for own, ids in zip(made, p.together(made)):
        assert ids.tolist() == p.merges.together([own])[0].tolist() == list(p.stream(own))


def test_ids_of_a_unigram_model_are_those_of_sentencepiece(unigram):
    import sentencepiece

    rng = np.random.default_rng(8)
    texts = [" ".join("".join(rng.choice(list("abcdefgh"), rng.integers(1, 12))) for _ in range(12)) for _ in range(300)]
    texts += ["", " ", "ab  cd", "aéb", "日a 本", "ff abc\nd", "abcdefgh" * 20]
    want = sentencepiece.SentencePieceProcessor(model_file=unigram).encode(texts)
    flat, at = pieces.codec(unigram).encode(texts)
    assert [flat[i:j].tolist() for i, j in zip(at[:-1], at[1:])] == want


def test_wide_ids(tmp_path):
    made = {MARK: -5.0, "a": -4.0, "b": -4.5} | {chr(0x4E00 + i): -9.0 for i in range(20_000)} | {chr(0x10000 + i): -9.0 for i in range(46_000) if not 0xFFF0 < i % 0x10000}
    path = model_of(tmp_path / "w.model", made)
    c = pieces.Codec(path)
    assert c.kind == np.uint32
    last = list(made)[-1]
    flat, at = c.encode([f"ab {last}"])
    assert flat.max() > 65_535 and c.decode(flat[at[0] : at[1]]) == f"ab {last}"


def test_registered_query_gives_ids_that_decode_to_the_texts(spark, tmp_path):
    from tesselake.llm.queries import op10_sentence_pieces

    rows = [(i, t) for i, t in enumerate(ODD)] + [(None, None)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    out = op10_sentence_pieces(spark, str(tmp_path))
    assert {(r.doc_id, r.text) for r in pieces.decoded(out, PATH).collect()} == {(i, t or "") for i, t in rows}
    assert all(len(r.ids) == r.n_ids for r in out.collect())
