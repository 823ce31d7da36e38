"""Encoding and decoding over a SentencePiece vocabulary by streaming Viterbi, with the ids that the model file defines.

At each boundary between characters the decoder keeps one back-pointer, the last piece of the best path there, and a window
of the last ``reach`` boundaries (the longest piece), as no later piece begins before it.  The back-pointers form a
tree.  A boundary that leaves the window without a path through it is cut off, and so are those before it that no other
path needs; as long as only one path leaves the tree's root, its first piece is committed and the root moves on.  So ids are
committed as soon as all surviving paths run through one boundary, and only what lies behind it is kept.

What makes a path the best depends on the model.  A unigram model's scores are log probabilities: the largest sum wins (of
equal ones that with the longer piece, from the end).  A BPE model's scores are ranks of merges: starting from single
characters, the adjacent pair whose text is the piece of best score is merged, the leftmost of equal ones, until none is
left.  There a path is good if of each two neighbours the merges leave just these two pieces of their joint text.  (A
merge across a border of pieces would happen in the pair alone as it does in the text; so the pieces of a text are
those whose neighbours all agree, and so are those of each beginning of it that ends with a piece: one piece ends at each
boundary.)  Which pairs agree is found by merging them, once per pair.

The blank is written as the mark U+2581, one of which stands before the text; a mark in the text itself is spelled
in bytes, so decoding gives back every text exactly (sentencepiece itself takes such a mark for a blank).  Characters
without piece are spelled in bytes, too.  Before a mark that follows another character (no piece has a mark behind one)
and around such characters all paths meet whatever the text; texts are cut there, and the distinct stretches between go
through the decoder together, one character of each at a time, whatever their lengths.  They are remembered.

Null texts count as empty: no ids, and the empty text back.  Each row stands for itself, whatever its doc_id; an
empty table gives no rows.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from .common import small_batches, texts_of

MARK = "▁"
U = np.uint64
STEP = U(0x9E3779B97F4A7C15)
SCALE = 1 << 16
FAR = np.int64(1) << 50
#: Hashes are looked up by the bits above these.
SLOT = U(46)
NONE = np.int32(np.iinfo(np.int32).max)


class Pieces:
    """A vocabulary: pieces with costs, and the ids of single bytes."""

    def __init__(self, path: str):
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2

        m = sentencepiece.SentencePieceProcessor(model_file=path)
        with open(path, "rb") as f:
            proto = sentencepiece_model_pb2.ModelProto.FromString(f.read())
        kinds, norm = type(proto.trainer_spec), proto.normalizer_spec
        if proto.trainer_spec.model_type not in (kinds.BPE, kinds.UNIGRAM):
            raise ValueError("neither a BPE nor a unigram model")
        if norm.precompiled_charsmap or norm.remove_extra_whitespaces or not (norm.add_dummy_prefix and norm.escape_whitespaces) or proto.trainer_spec.treat_whitespace_as_suffix:
            raise ValueError("the model changes texts before it encodes them")
        if any(p.type in (p.USER_DEFINED, p.UNUSED) for p in proto.pieces):
            raise ValueError("pieces that the user defined or that are unused")
        self.bpe = proto.trainer_spec.model_type == kinds.BPE
        self.bytes_, self.ids, self.text = {}, {}, []
        for i in range(m.get_piece_size()):
            p = m.id_to_piece(i)
            if m.is_byte(i):
                self.bytes_[int(p[1:-1], 16)] = i
                self.text.append(bytes([int(p[1:-1], 16)]))
            elif m.is_control(i) or m.is_unknown(i) or m.is_unused(i):
                self.text.append(b"")
            else:
                self.ids[p] = i
                self.text.append(p.replace(MARK, " ").encode())
        if any(MARK in p.lstrip(MARK) for p in self.ids):
            raise ValueError("a piece holds a mark behind other characters")
        if len(self.bytes_) < 256 or {c for p in self.ids for c in p} - self.ids.keys() or "\n" in self.ids:
            raise ValueError("a byte or a character of a piece has no piece, or a line end has one")
        self.score = {p: m.get_score(i) for p, i in self.ids.items()}
        self.reach = max(map(len, self.ids))
        self.kind = np.uint16 if len(self.text) <= 1 << 16 else np.uint32
        hashes = np.array([self.hash_of(p) for p in self.ids], np.uint64)
        order = np.argsort(hashes)
        self.hashes = hashes[order]
        if len(np.unique(hashes)) < len(hashes):
            raise ValueError("two pieces have one hash")
        self.id_at = np.array(list(self.ids.values()), np.int32)[order]
        self.cost_at = np.array([round(-SCALE * self.score[p]) for p in self.ids], np.int64)[order]
        self.power = np.array([pow(int(STEP), k, 1 << 64) for k in range(self.reach + 1)], np.uint64)
        # where a hash's piece may stand: by its first bits, -1 for none, -2 for more than one
        first, at, count = np.unique(self.hashes >> SLOT, return_index=True, return_counts=True)
        self.slots = np.full(1 << (64 - int(SLOT)), -1, np.int32)
        self.slots[first.astype(np.int64)] = np.where(count > 1, -2, at)
        self.merges = Merges(self) if self.bpe else None

    @staticmethod
    def hash_of(p: str) -> np.uint64:
        h = 0
        for c in p:
            h = (h * int(STEP) + ord(c) + 1) % (1 << 64)
        return U(h)

    def spelled(self, c: str) -> list[int]:
        return [self.bytes_[b] for b in c.encode("utf-8", "surrogatepass")]

    def find(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of pieces by hash, and whether there is one."""
        at = self.slots[(h >> SLOT).astype(np.int64)]
        more = at == -2
        if more.any():
            at[more] = np.minimum(np.searchsorted(self.hashes, h[more]), len(self.hashes) - 1)
        return at, (at >= 0) & (self.hashes[at] == h)

    def together(self, stretches: list[str]) -> list[np.ndarray]:
        """Ids of stretches whose characters all have pieces, decoded side by side."""
        order = sorted(range(len(stretches)), key=lambda i: -len(stretches[i]))
        length = np.array([len(stretches[i]) for i in order], np.int64)
        flat = np.frombuffer("".join(stretches[i] for i in order).encode("utf-32-le", "surrogatepass"), np.uint32)
        start = np.cumsum(length) - length
        streams, rows, tokens = Streams(self, len(order)), [np.zeros(0, np.int64)], [np.zeros(0, np.int32)]
        for j in range(int(length.max(initial=0))):
            live = int(np.searchsorted(-length, -j))  # those longer than j
            found = streams.step(flat[start[:live] + j])
            ended = np.arange(int(np.searchsorted(-length, -(j + 1))), live)
            for r, x in [*found, *streams.rest(ended)]:
                rows.append(r)
                tokens.append(x)
        row, token = np.concatenate(rows), np.concatenate(tokens)
        by = np.argsort(row, kind="stable")
        parts = np.split(token[by], np.cumsum(np.bincount(row, minlength=len(order)))[:-1]) if len(order) else []
        out: list[np.ndarray] = [None] * len(order)
        for i, x in zip(order, parts):
            out[i] = x
        return out

    def stream(self, characters: Iterable[str]) -> Iterator[int]:
        """Ids of a stream of characters with pieces (marks for blanks), each given as soon as it is committed."""
        streams = Streams(self, 1)
        for c in characters:
            for _, x in streams.step(np.array([ord(c)])):
                yield from x.tolist()
        for _, x in streams.rest(np.arange(1)):
            yield from x.tolist()


class Streams:
    """The windows and back-pointer trees of many stretches, each as far as the others, in rings.

    A ring holds what lies behind the root (the last committed boundary) and the window; it is doubled where paths
    have not met for so long."""

    def __init__(self, p: Pieces, n: int):
        self.p, self.j, self.size, self.root = p, 0, 1 << (2 * p.reach).bit_length(), np.zeros(n, np.int64)
        # by boundary: hash of what lies before, cost, the last piece and where it begins, pieces that go on from here
        # (how many, and the sum of their ends)
        self.prefix, self.cost, self.token, self.back, self.kids, self.heirs = (np.zeros((n, self.size), kind) for kind in (np.uint64, np.int64, np.int32, np.int64, np.int32, np.int64))

    def grow(self) -> None:
        places = np.arange(max(0, self.j - self.size + 1), self.j + 1)
        for name in ("prefix", "cost", "token", "back", "kids", "heirs"):
            old = getattr(self, name)
            new = np.zeros((len(old), 2 * self.size), old.dtype)
            new[:, places % (2 * self.size)] = old[:, places % self.size]
            setattr(self, name, new)
        self.size *= 2

    def step(self, codes: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        """The next character of the first stretches; (rows, ids) that are now committed, in order."""
        n, reach = len(codes), self.p.reach
        if self.j + 2 - self.root[:n].min() >= self.size:
            self.grow()
        j, ring = self.j + 1, self.size - 1
        self.j, now = j, j & ring
        most = min(reach, j)
        self.prefix[:n, now] = self.prefix[:n, (j - 1) & ring] * STEP + codes.astype(np.uint64) + U(1)
        before = (j - np.arange(most, 0, -1)) & ring  # longest pieces first
        at, hit = self.p.find(self.prefix[:n, now, None] - self.prefix[:n][:, before] * self.p.power[most:0:-1])
        which, token = self.by_pairs(at, hit, before, j) if self.p.bpe else self.by_cost(at, hit, before, now)
        parent, rows = j - most + which, np.arange(n)
        self.token[:n, now], self.back[:n, now], self.kids[:n, now], self.heirs[:n, now] = token, parent, 0, 0
        self.kids[rows, parent & ring] += 1
        self.heirs[rows, parent & ring] += j
        return self.committed(rows, j - reach) if j >= reach else []

    def by_cost(self, at: np.ndarray, hit: np.ndarray, before: np.ndarray, now: int) -> tuple[np.ndarray, np.ndarray]:
        n = len(at)
        cost = np.where(hit, self.cost[:n][:, before] + self.p.cost_at[at], FAR)
        which = cost.argmin(1)  # of equal ones the longest
        self.cost[:n, now] = cost[np.arange(n), which]
        return which, self.p.id_at[at[np.arange(n), which]]

    def by_pairs(self, at: np.ndarray, hit: np.ndarray, before: np.ndarray, j: int) -> tuple[np.ndarray, np.ndarray]:
        row, col = np.nonzero(hit)
        token = self.p.id_at[at[row, col]]
        last = np.where(j - len(before) + col > 0, self.token[row, before[col]], -1)
        good = self.p.merges.agree(last, token)
        row, col, token = row[good], col[good], token[good]
        if len(row) != len(at) or (row != np.arange(len(at))).any():
            raise RuntimeError("not one piece ends at a boundary")
        return col, token

    def committed(self, rows: np.ndarray, left: int) -> list[tuple[np.ndarray, np.ndarray]]:
        """The boundary ``left`` leaves the window: cut off what no path needs, commit what all share."""
        ring, out = self.size - 1, []
        r = rows[(self.kids[rows, left & ring] == 0) & (self.root[rows] < left)]
        x = np.full(len(r), left)
        while len(r):
            parent = self.back[r, x & ring]
            self.kids[r, parent & ring] -= 1
            self.heirs[r, parent & ring] -= x
            more = (self.kids[r, parent & ring] == 0) & (parent > self.root[r])
            r, x = r[more], parent[more]
        r = rows[self.root[rows] <= left]
        while len(r := r[self.kids[r, self.root[r] & ring] == 1]):
            heir = self.heirs[r, self.root[r] & ring]
            out.append((r, self.token[r, heir & ring]))
            self.root[r] = heir
            r = r[heir <= left]
        return out

    def rest(self, rows: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        """(rows, ids) of stretches that end here, from the root on."""
        out, ring, x = [], self.size - 1, np.full(len(rows), self.j)
        while len(rows := rows[more := x > self.root[rows]]):
            x = x[more]
            out.append((rows, self.token[rows, x & ring]))
            x = self.back[rows, x & ring]
        return out[::-1]


class Merges:
    """The merges of a BPE model: pairs of pieces whose joint text is a piece, and its place by score."""

    def __init__(self, p: Pieces, most: int = 4_000_000):
        self.text_of, self.most = {i: w for w, i in p.ids.items()}, most
        self.none = np.array([np.iinfo(np.int64).max])
        self.pairs, self.agreed = self.none, np.zeros(1, bool)  # pairs met so far, sorted
        order = {x: i for i, x in enumerate(sorted(set(p.score.values()), reverse=True))}
        pairs = sorted((p.ids[w[:i]] << 32 | p.ids[w[i:]], order[p.score[w]], n) for w, n in p.ids.items() for i in range(1, len(w)) if w[:i] in p.ids and w[i:] in p.ids)
        keys, ranks, into = zip(*pairs, ((1 << 62), NONE, 0))
        self.keys, self.ranks, self.into = np.array(keys, np.int64), np.array(ranks, np.int32), np.array(into, np.int32)
        single = sorted((ord(w), n) for w, n in p.ids.items() if len(w) == 1)
        self.codes, self.code_ids = np.array([c for c, _ in single], np.uint32), np.array([n for _, n in single], np.int32)

    def look(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """By pair of ids the place of its merge (NONE if there is none) and the id that it makes."""
        key = a.astype(np.int64) << 32 | b
        at = np.searchsorted(self.keys, key)
        return np.where(self.keys[at] == key, self.ranks[at], NONE), self.into[at]

    def together(self, stretches: list[str]) -> list[np.ndarray]:
        """Ids of stretches of one length whose characters all have pieces: one merge of each stretch at a time."""
        codes = np.frombuffer("".join(stretches).encode("utf-32-le"), np.uint32).reshape(len(stretches), -1)
        sym = self.code_ids[np.searchsorted(self.codes, codes)]
        rank, into = self.look(sym[:, :-1], sym[:, 1:])
        out: list[np.ndarray] = [None] * len(stretches)
        rows = np.arange(len(stretches))
        while len(rows):
            n, width = sym.shape
            if width == 1:
                done, place = np.ones(n, bool), np.zeros(n, np.int64)
            else:
                place = rank.argmin(1)  # the leftmost of equal ones
                done = rank[np.arange(n), place] == NONE
            if done.any():
                for i, ids in zip(rows[done].tolist(), sym[done]):
                    out[i] = ids
                sym, rank, into, rows, place = sym[~done], rank[~done], into[~done], rows[~done], place[~done]
                if not len(rows):
                    break
            n = len(rows)
            every = np.arange(n)
            new = into[every, place]
            sym[every, place] = new
            rest = np.ones((n, width), bool)
            rest[every, place + 1] = False
            sym = sym[rest].reshape(n, width - 1)
            rest = np.ones((n, width - 1), bool)
            rest[every, place] = False
            rank, into = rank[rest].reshape(n, width - 2), into[rest].reshape(n, width - 2)
            r = np.flatnonzero(place > 0)
            at = place[r] - 1
            rank[r, at], into[r, at] = self.look(sym[r, at], new[r])
            r = np.flatnonzero(place < width - 2)
            at = place[r]
            rank[r, at], into[r, at] = self.look(new[r], sym[r, at + 1])
        return out

    def agree(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether the merges leave just the pieces a and b of their joint text; a of -1: whether they make b at all."""
        key, where = np.unique((a.astype(np.int64) << 32) + b, return_inverse=True)
        at = np.minimum(np.searchsorted(self.pairs, key), len(self.pairs) - 1)
        new = key[self.pairs[at] != key]
        if len(new):
            if len(self.pairs) > self.most:
                self.pairs, self.agreed = self.none, np.zeros(1, bool)
            place = np.searchsorted(self.pairs, new)
            self.pairs, self.agreed = np.insert(self.pairs, place, new), np.insert(self.agreed, place, self.merged(new >> 32, new & 0xFFFFFFFF))
            if len(key) > len(new):
                return self.agree(a, b)
            at = np.searchsorted(self.pairs, key)
        return self.agreed[at][where]

    def merged(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        texts = [self.text_of.get(x, "") + self.text_of[y] for x, y in zip(a.tolist(), b.tolist())]
        by_length: dict[int, list[int]] = {}
        for i, t in enumerate(texts):
            by_length.setdefault(len(t), []).append(i)
        out = np.zeros(len(texts), bool)
        for own in by_length.values():
            for i, ids in zip(own, self.together([texts[i] for i in own])):
                out[i] = ids.tolist() == ([int(a[i]), int(b[i])] if a[i] >= 0 else [int(b[i])])
        return out


@lru_cache
def pieces(path: str) -> Pieces:
    return Pieces(path)


class Codec:
    """Batches of texts to ids and back; stretches met before are remembered."""

    def __init__(self, path: str, most: int = 1_000_000):
        self.pieces, self.known, self.most = pieces(path), {"": b""}, most
        self.kind = self.pieces.kind
        covered = "".join(re.escape(p) for p in self.pieces.ids if len(p) == 1 and p != MARK)
        #: A stretch: marks and the characters with pieces behind them; any other character alone.
        self.stretch = re.compile(f"{MARK}*[{covered}]+|{MARK}+|.", re.S)
        self.odd = re.compile(f"[^ {covered}]")

    def learn(self, stretches: set[str]) -> None:
        odd = {s for s in stretches if self.odd.search(s.replace(MARK, " "))}  # single characters
        self.known.update((s, np.array(self.pieces.spelled(s), self.kind).tobytes()) for s in odd)
        # those of about one length together; a part has a bounded number of characters, or one stretch
        rest, i = sorted(stretches - odd, key=len), 0
        while i < len(rest):
            own = rest[i : i + 20_000]
            while len(own) > 1 and sum(map(len, own)) > 1 << 20:
                own = own[: len(own) // 2]
            self.known.update((s, x.astype(self.kind).tobytes()) for s, x in zip(own, self.pieces.together(own)))
            i += len(own)

    def split(self, text: str) -> list[str]:
        """The text's stretches, marks for its blanks.  A mark of its own is given as a NUL-marked stretch."""
        if not text:
            return []
        out = []
        for i, part in enumerate(text.split(MARK)):
            if i:
                out.append("\0")
            part = part.replace(" ", MARK)
            if i == 0:
                part = MARK + part
            out += self.stretch.findall(part)
        return out

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts in turn, and where each text's begin (one entry more than texts)."""
        if len(self.known) > self.most:
            self.known = {"": b""}
        plain = [t if t and t[0] != " " and MARK not in t and "\0" not in t and "  " not in t else None for t in texts]
        marked = [None if t is None else MARK + t.replace(" ", f"\0{MARK}").replace("\n", "\0\n\0") for t in plain]
        split = pc.split_pattern(pa.array(["" if t is None else t for t in marked], pa.large_string()), "\0")
        coded = split.flatten().dictionary_encode()
        distinct = coded.dictionary.to_pylist()
        odd = {i: self.split(t) for i, t in enumerate(texts) if plain[i] is None and t}
        # a plain text's stretches may still hold characters without pieces: cut those once more
        new = {s for s in distinct if s not in self.known}
        finer = {s: self.stretch.findall(s) for s in new if self.odd.search(s.replace(MARK, " "))}
        wanted = (new - finer.keys()) | {x for v in finer.values() for x in v} | {x for v in odd.values() for x in v}
        own = np.array(self.pieces.spelled(MARK), self.kind).tobytes()
        nul = np.array(self.pieces.spelled("\0"), self.kind).tobytes()
        self.learn({s for s in wanted if s not in self.known and s != "\0"})
        for s, v in finer.items():
            self.known[s] = b"".join(self.known[x] for x in v)
        found = list(map(self.known.__getitem__, distinct))
        size = np.fromiter(map(len, found), np.int64, len(found)) // np.dtype(self.kind).itemsize
        start = np.cumsum(size) - size
        which = coded.indices.to_numpy(zero_copy_only=False)
        count = size[which]
        ends = np.concatenate([[0], np.cumsum(count)])
        flat = np.frombuffer(b"".join(found), self.kind)[np.repeat(start[which] - ends[:-1], count) + np.arange(ends[-1])]
        bounds = ends[np.asarray(split.offsets)]
        if not odd:
            return flat, bounds
        parts = [flat[bounds[i] : bounds[i + 1]] for i in range(len(texts))]
        for i, v in odd.items():
            raw = texts[i]
            marks = iter([c for c in raw if c in (MARK, "\0")])  # which of the two a NUL in the list stands for
            parts[i] = np.frombuffer(b"".join(self.known[x] if x != "\0" else own if next(marks) == MARK else nul for x in v), self.kind)
        return np.concatenate(parts), np.concatenate([[0], np.cumsum([len(x) for x in parts])])

    def decode(self, ids: np.ndarray) -> str:
        raw = b"".join(map(self.pieces.text.__getitem__, ids.tolist()))
        return raw[1:].decode("utf-8", "surrogatepass") if len(ids) else ""


@lru_cache
def codec(path: str) -> Codec:
    return Codec(path)


def encoded(docs: DataFrame, path: str, id_col: str = "doc_id", text: str = "text", ids: bool = True, block_bytes: int = 4 << 20) -> DataFrame:
    """Per row the id, n_ids, ids_crc32 (little-endian unsigned 32-bit ids), round_trip and, if asked for, the ids."""
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(path)
        for b in small_batches(batches, block_bytes):
            texts = texts_of(b, text)
            flat, at = c.encode(texts)
            own = [flat[i:j] for i, j in zip(at[:-1], at[1:])]
            columns = [
                b.column(id_col), pa.array(np.diff(at), pa.int64()),
                pa.array([zlib.crc32(x.astype("<u4").tobytes()) for x in own], pa.int64()),
                pa.array([c.decode(x) == t for x, t in zip(own, texts)], pa.bool_()),
            ]
            if ids:
                columns.append(pa.array([x.astype(np.int32) for x in own], pa.list_(pa.int32())))
            yield pa.RecordBatch.from_arrays(columns, names=[id_col, "n_ids", "ids_crc32", "round_trip", "ids"][: len(columns)])

    schema = f"{id_col} {kind}, n_ids long, ids_crc32 long, round_trip boolean"
    return docs.select(id_col, text).mapInArrow(run, schema + ", ids array<int>" * ids)


def decoded(rows: DataFrame, path: str, id_col: str = "doc_id", ids: str = "ids") -> DataFrame:
    """(id, text) of rows of ids; null ids count as none."""
    kind = rows.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(path)
        for b in batches:
            texts = [c.decode(np.array(x or [], np.int64)) for x in b.column(ids).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(id_col), pa.array(texts, pa.string())], names=[id_col, "text"])

    return rows.select(id_col, ids).mapInArrow(run, f"{id_col} {kind}, text string")
