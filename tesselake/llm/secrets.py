"""Secret scans through a trigram inverted index.

Each rule's regular expression is turned into a Boolean query over lower-case byte trigrams (an OR of ANDs):
every text that the rule can match contains all trigrams of one of the alternatives.  A partition is indexed
in blocks: one pass over a block's trigrams gives posting lists of those that occur in some rule's query.  Postings are
intersected and united as the query says, and only the candidates are run through the regular expression.
A rule without a mandatory trigram (a plain run of hex digits) scans every text.

Null texts count as empty, empty texts have no spans, repeated rows are scanned one by one, other columns of
the input are left alone; nothing depends on doc_id.  No shuffle: the scan is one narrow stage, texts never
leave their task.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import small_batches, texts_of

try:
    from re import _constants as sre, _parser as sre_parser
except ImportError:  # before Python 3.11
    import sre_constants as sre
    import sre_parse as sre_parser


def either_case(word: str) -> str:
    """A pattern for a word with its ASCII letters in either case."""
    return "".join(f"[{c.upper()}{c.lower()}]" if c.isalpha() else re.escape(c) for c in word)


@dataclass(frozen=True)
class Rule:
    """A kind of secret; a match counts if the group has at least ``least`` characters."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 1


# The base kinds, in the order in which spans of one start are listed.
KEYWORDS = ("password", "passwd", "secret", "token")
BASE = (
    Rule(
        "assign",
        "(" + "|".join(map(either_case, KEYWORDS)) + "|[Aa][Pp][Ii]_?[Kk][Ee][Yy]" + r""")["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        2, 8,
    ),
    Rule("access", "AKIA[A-Z0-9]+", 0, 16),
    Rule("hex", "[0-9a-f]+", 0, 32),
)
# A PEM key: up to the END line of the same label, if no other BEGIN comes first; else what follows of headers and base64
# lines (20 characters or more; the last one may be shorter, if it is padded or ends its line).
BREAK = r"""(?:[\s>"']|\\[nrt])+"""
PEM = (
    r"-----BEGIN ([A-Z ]*)PRIVATE KEY-----"
    r"(?:[^-]*(?:-(?!----BEGIN |----END \1PRIVATE KEY-----)[^-]*)*-----END \1PRIVATE KEY-----"
    rf"|(?:{BREAK}(?:Proc-Type|DEK-Info): ?[A-Za-z0-9,-]+)*(?:{BREAK}[A-Za-z0-9+/]{{20,}}={{0,2}})*"
    rf"""(?:{BREAK}(?:[A-Za-z0-9+/]+={{1,2}}|[A-Za-z0-9+/]+(?=\r?\n|\\[nr]|["']|\s*\Z)))?)"""
)
# Further public formats.
EXTRA = (
    Rule("private_key", PEM),
    Rule("github", "gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("slack", "xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{10,}\.eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}"),
    Rule("google", "AIza[A-Za-z0-9_-]{35}"),
)
RULES = BASE + EXTRA

#: A disjunction of conjunctions of trigrams; None: every text can match.
Query = frozenset[frozenset[bytes]] | None


def trigram_query(pattern: str, most: int = 64) -> Query:
    """The Boolean trigram query that each match of the pattern fulfils, read off its syntax tree.

    A subtree is a finite set of exact lower-case strings as long as there are at most ``most`` of them;
    where that ends, the trigrams of the strings gathered so far are required and a new run starts."""

    def fold(c: int) -> str:
        return chr(c).lower() if c < 128 else "\0"

    def strings(op, arg) -> set[str] | None:
        if op is sre.LITERAL:
            return {fold(arg)}
        if op is sre.IN:
            found = set()
            for kind, x in arg:
                if kind is sre.LITERAL:
                    found.add(fold(x))
                elif kind is sre.RANGE and x[1] - x[0] < 3:
                    found |= {fold(c) for c in range(x[0], x[1] + 1)}
                else:
                    return None
            return found if len(found) <= 4 else None
        if op is sre.SUBPATTERN:
            return joined(arg[3])
        if op is sre.BRANCH:
            parts = [joined(x) for x in arg[1]]
            return None if None in parts else set().union(*parts)
        if op in (sre.MAX_REPEAT, sre.MIN_REPEAT) and arg[1] <= 1:
            one = joined(arg[2])
            return None if one is None else one | ({""} if arg[0] == 0 else set())
        return None

    def joined(tree) -> set[str] | None:
        out = {""}
        for op, arg in tree:
            if (x := strings(op, arg)) is None or len(out) * len(x) > most:
                return None
            out = {a + b for a in out for b in x}
        return out

    def both(a: Query, b: Query) -> Query:
        if a is None or b is None:
            return a if b is None else b
        return frozenset(x | y for x in a for y in b)

    def need(words: set[str]) -> Query:
        if any(len(w) < 3 or "\0" in w for w in words):
            return None
        return frozenset(frozenset(w[i : i + 3].encode() for i in range(len(w) - 2)) for w in words)

    def query(tree) -> Query:
        out: Query = None
        run = {""}
        for op, arg in tree:
            x = strings(op, arg)
            if x is not None and len(run) * len(x) <= most:
                run = {a + b for a in run for b in x}
                continue
            out, run = both(out, need(run)), x if x is not None else {""}
            if x is None and op is sre.SUBPATTERN:
                out = both(out, query(arg[3]))
            elif x is None and op is sre.BRANCH:
                parts = [query(b) for b in arg[1]]
                out = both(out, None if None in parts else frozenset().union(*parts))
            elif x is None and op in (sre.MAX_REPEAT, sre.MIN_REPEAT) and arg[0] >= 1:
                out = both(out, query(arg[2]))
        return both(out, need(run))

    return query(sre_parser.parse(pattern))


@lru_cache
def compiled(rules: tuple[Rule, ...]) -> tuple[list[tuple[Rule, re.Pattern, Query]], list[bytes]]:
    plans = [(r, re.compile(fast(r)), trigram_query(r.pattern)) for r in rules]
    return plans, sorted({t for _, _, q in plans if q for words in q for t in words})


def fast(rule: Rule) -> str:
    """A pattern of one repeated class whose whole match is measured: shorter runs need not be reported at all."""
    if rule.group == 0 and (m := re.fullmatch(r"(\[[^\]]+\])\+", rule.pattern)):
        return f"{m[1]}{{{rule.least},}}"
    return rule.pattern


@lru_cache
def numbers(trigrams: tuple[bytes, ...]) -> np.ndarray:
    """By trigram, read as a number, its place among the given ones from 1 on; 0 for any other."""
    out = np.zeros(1 << 24, np.uint16)
    out[[int.from_bytes(t, "big") for t in trigrams]] = np.arange(1, len(trigrams) + 1)
    return out


def index(block: list[bytes], trigrams: list[bytes], part: int = 1 << 20) -> dict[bytes, np.ndarray]:
    """Posting lists of a block of lower-case texts: sorted numbers of the texts that hold a trigram."""
    known, flat = numbers(tuple(trigrams)), np.frombuffer(b"\0\0".join(block) + b"\0\0", np.uint8)
    starts = np.cumsum([0, *(len(x) + 2 for x in block)])[:-1]  # two NULs apart: no trigram of a query holds one
    found = [np.zeros(0, np.int64)]
    for i in range(0, len(flat) - 2, part):
        a = flat[i : i + part + 2].astype(np.uint32)
        which = known[a[:-2] << 16 | a[1:-1] << 8 | a[2:]]
        at = np.flatnonzero(which)
        found.append(np.unique(which[at].astype(np.int64) * len(block) + np.searchsorted(starts, at + i, "right") - 1))
    pairs = np.unique(np.concatenate(found))
    ends = np.searchsorted(pairs, np.arange(1, len(trigrams) + 2) * len(block))
    return {t: pairs[ends[k] : ends[k + 1]] % max(1, len(block)) for k, t in enumerate(trigrams)}


def candidates(q: Query, postings: dict[bytes, np.ndarray], n: int) -> list[int]:
    if q is None:
        return list(range(n))
    found = [np.zeros(0, np.int64)]
    for words in q:
        own, *rest = sorted((postings[t] for t in words), key=len)
        for other in rest:
            if not len(own):
                break
            own = own[np.isin(own, other, assume_unique=True)]
        found.append(own)
    return np.unique(np.concatenate(found)).tolist()


def scan(texts: list[str], rules: tuple[Rule, ...] = RULES) -> list[list[tuple[int, int, str]]]:
    """Per text its (start, end, kind), by start, then in the order of the rules; code points, end exclusive."""
    plans, trigrams = compiled(rules)
    raw = [t.encode("utf-8", "surrogatepass") for t in texts]
    postings = index([r.lower() for r in raw], trigrams)
    found: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    for k, (rule, regex, q) in enumerate(plans):
        for i in candidates(q, postings, len(texts)):
            for m in regex.finditer(texts[i]):
                if m.end(rule.group) - m.start(rule.group) >= rule.least:
                    found[i].append((m.start(), k, m.end()))
    return [[(s, e, rules[k].kind) for s, k, e in sorted(x)] for x in found]


def listed(spans: list[tuple[int, int, str]]) -> str:
    return ",".join(f"{kind}:{s}:{e}" for s, e, kind in spans)


def redact(text: str, spans: list[tuple[int, int, str]]) -> str:
    """The text with each maximal run of overlapping spans replaced by the name of its first kind."""
    out, at = [], 0
    for s, e, kind in spans:
        if s >= at:
            out += [text[at:s], f"[{kind.upper()}]"]
        at = max(at, e)
    return "".join([*out, text[at:]])


def redacted(docs: DataFrame, text: str = "text", rules: tuple[Rule, ...] = RULES, block_bytes: int = 8 << 20) -> DataFrame:
    """The rows with secrets blanked out of the text; null texts stay null, other columns as they are."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in small_batches(batches, block_bytes):
            at, texts = b.schema.get_field_index(text), texts_of(b, text)
            clean = [redact(t, x) if x else t for t, x in zip(texts, scan(texts, rules))]
            column = pa.array([None if old is None else new for old, new in zip(b.column(text).to_pylist(), clean)], b.schema.field(at).type)
            yield b.set_column(at, b.schema.field(at), column)

    return docs.mapInArrow(run, docs.schema)


def digest(docs: DataFrame, rules: tuple[Rule, ...] = RULES, block_bytes: int = 8 << 20) -> DataFrame:
    """The query's columns, made in the task that scans: counts and digest of the base kinds, all spans as text."""
    kinds = [r.kind for r in BASE]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in small_batches(batches, block_bytes):
            rows = scan(texts_of(b), rules)
            base = [[x for x in spans if x[2] in kinds] for spans in rows]
            counts = [pa.array([sum(x[2] == k for x in spans) for spans in base], pa.int64()) for k in kinds]
            hashes = pa.array([hashlib.sha256(listed(x).encode()).hexdigest() for x in base], pa.string())
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), *counts, hashes, pa.array(map(listed, rows), pa.string())],
                names=["doc_id", *(f"n_{k}" for k in kinds), "base_sha256", "spans"],
            )

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string")
