"""Merkle fingerprints of documents, with DataFrame functions only.

The tree: a text's paragraphs are its lines, each with its line end; a paragraph's leaves are its sentences, cut into
runs of eight words at most, each with the blanks behind it.  So the leaves put together are the text, whatever characters
it holds.  A section ends behind each paragraph whose hash begins with a digit below 4 (one in four), and with the
text; as its ends depend on the paragraphs alone, a line that comes or goes changes one or two sections.  Leaf, paragraph,
section and root are SHA-256 hashes of what stands below them behind a letter for the level, so equal roots mean
equal texts.  A fingerprint is printed as

    root:section/section/...    a section as  hash[paragraph.paragraph...],  a paragraph as its leaf hashes

with inner hashes shortened to 8 hex digits and leaves to 6.

Two trees are compared from the top: sections that both have count with all their leaves; within the others, paragraphs
that both have do; within the others of these, the distinct leaves that both have.  The likeness is the share of the two
trees' leaves that stand so under equal branches (distinct ones within differing paragraphs); 1 for equal roots.
``places`` gives the leaves that don't: where the second text was edited.  Nodes are compared by 60 bits of their hashes.

Null texts count as empty, a text without a leaf.  Rows with the same doc_id follow each other by the hash of
their text (equal rows follow one another); rows without doc_id come last in the descending order.  One row and an
empty table work (a single row's next document is itself).
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import partitions, sweep, written

#: Up to eight words with the blanks behind them, of which only the last may end a sentence.
LEAF = r"(?:[^ ]*+(?<![.!?]) ++){0,7}(?:[^ ]*+ ++|[^ ]++\z)"
#: First digits of the hashes of paragraphs that end a section.
LAST = "4"


def paragraphs(text: Column) -> Column:
    return F.split(text, "(?<=\n)")


def leaves(paragraph: Column) -> Column:
    return F.regexp_extract_all(paragraph, F.lit(LEAF), 0)


def node(level: str, below: Column) -> Column:
    return F.sha2(F.concat(F.lit(level), below), 256)


def joined(level: str, nodes: Column) -> Column:
    return node(level, F.array_join(nodes, ""))


def key(x: Column) -> Column:
    return F.conv(F.substring(x, 1, 15), 16, 10).cast("long")


def by_section(ends: Column, items: Column, f) -> Column:
    """f(the items of a section, its number) for each section; ends: how many paragraphs there are up to each one's end."""

    def own(end: Column, i: Column) -> Column:
        begin = F.coalesce(F.get(ends, i - 1), F.lit(0))
        return f(F.slice(items, begin + 1, end - begin), i)

    return F.transform(ends, own)


def fingerprint(docs: DataFrame, text: str, prefix: str = "", printed: bool = True) -> DataFrame:
    """Adds the tree of the column ``text``: {prefix}fingerprint (if asked for), and __{prefix}root, _ends, _sections,
    _paragraphs (each with its leaves) as the comparison reads them."""
    leaf, para, ends, section, root = (f"__{prefix}{x}" for x in ("leaf", "para", "ends", "section", "root"))
    docs = docs.withColumn(leaf, F.transform(paragraphs(F.col(text)), lambda p: F.transform(leaves(p), lambda x: node("L", x))))
    docs = docs.withColumn(para, F.transform(leaf, lambda p: joined("P", p)))
    count = F.size(para)
    docs = docs.withColumn(
        ends,
        F.filter(F.sequence(F.lit(1), count), lambda i: (F.substring(F.get(F.col(para), i - 1), 1, 1) < LAST) | (i == count)),
    )
    docs = docs.withColumn(section, by_section(F.col(ends), F.col(para), lambda p, _: joined("S", p)))
    docs = docs.withColumn(root, joined("R", F.col(section)))
    if printed:
        lines = F.transform(leaf, lambda p: F.array_join(F.transform(p, lambda x: F.substring(x, 1, 6)), ""))
        docs = docs.withColumn("__lines", lines)
        one = by_section(F.col(ends), F.col("__lines"), lambda p, i: F.concat(F.substring(F.get(F.col(section), i), 1, 8), F.lit("["), F.array_join(p, "."), F.lit("]")))
        docs = docs.withColumn(f"{prefix}fingerprint", F.concat(F.col(root), F.lit(":"), F.array_join(one, "/"))).drop("__lines")
    docs = docs.withColumn(f"__{prefix}sections", F.transform(section, key))
    keyed = F.zip_with(para, leaf, lambda p, x: F.struct(key(p).alias("k"), F.transform(x, key).alias("leaves")))
    return docs.withColumn(f"__{prefix}paragraphs", keyed).drop(leaf, para, section)


def differing(docs: DataFrame, a: str, b: str) -> DataFrame:
    """Adds, for the trees of prefixes a and b, __new_{a} and __new_{b}: the distinct leaves under differing branches of
    each that the other has not there, and __all_{a}, __all_{b}, __like."""
    one = {a: b, b: a}
    for x, y in one.items():
        rest = F.flatten(by_section(F.col(f"__{x}ends"), F.col(f"__{x}paragraphs"), lambda p, i: F.when(F.array_contains(F.col(f"__{y}sections"), F.get(F.col(f"__{x}sections"), i)), F.slice(p, 1, 0)).otherwise(p)))  # noqa: B023
        docs = docs.withColumn(f"__rest_{x}", F.when(F.col(f"__{x}root") == F.col(f"__{y}root"), F.slice(f"__{x}paragraphs", 1, 0)).otherwise(rest))
    for x in one:
        docs = docs.withColumn(f"__keys_{x}", F.transform(f"__rest_{x}", lambda p: p["k"]))
    for x, y in one.items():
        docs = docs.withColumn(
            f"__low_{x}",
            F.flatten(F.transform(F.filter(f"__rest_{x}", lambda p: ~F.array_contains(F.col(f"__keys_{y}"), p["k"])), lambda p: p["leaves"])),
        )  # noqa: B023
    for x, y in one.items():
        held = F.aggregate(f"__{x}paragraphs", F.lit(0), lambda n, p: n + F.size(p["leaves"])) - F.size(f"__low_{x}")
        docs = docs.withColumn(f"__new_{x}", F.array_except(f"__low_{x}", f"__low_{y}")).withColumn(f"__all_{x}", held + F.size(F.array_distinct(f"__low_{x}")))
    total = (F.col(f"__all_{a}") + F.col(f"__all_{b}")).cast("double")
    apart = F.size(f"__new_{a}") + F.size(f"__new_{b}")
    docs = docs.withColumn("__like", F.when((F.col(f"__{a}root") == F.col(f"__{b}root")) | (total == 0), 1.0).otherwise((total - apart) / total))
    return docs.drop(*[f"__{what}_{x}" for what in ("rest", "keys", "low") for x in one])


def places(docs: DataFrame, old: str, new: str) -> DataFrame:
    """Adds ``places``: (paragraph, leaf, text) of the leaves of ``new`` in branches that differ from ``old``, in order.
    The numbers begin with 0."""
    docs = differing(fingerprint(fingerprint(docs, old, "old", printed=False), new, "new", printed=False), "old", "new")
    docs = docs.withColumn("__kept", F.col("__new_new"))
    told = lambda p, i: F.transform(leaves(p), lambda x, k: F.struct(i.alias("paragraph"), k.alias("leaf"), x.alias("text")))
    found = F.filter(F.flatten(F.transform(paragraphs(F.col(new)), told)), lambda x: F.array_contains(F.col("__kept"), key(node("L", x["text"]))))
    return docs.withColumn("places", found).drop(*[c for c in docs.columns if c.startswith("__")])


#: A row's place in the order: without doc_id last, else by descending doc_id; then by the hash of the text.
ORDER = ("nul", "inv", "h")


def ordered(docs: DataFrame) -> DataFrame:
    return docs.withColumns({"nul": F.col("doc_id").isNull(), "inv": F.coalesce(F.bitwise_not(F.col("doc_id").cast("long")), F.lit(0).cast("long")), "h": F.xxhash64("text")})


def with_next(docs: DataFrame, buckets: int, many: int = 100_000) -> tuple[DataFrame, DataFrame | None]:
    """(doc_id, text, next): each row with the text of the row that follows in the order, that of the first for the last.

    Keys alone are range-partitioned first; the smallest of each range (``buckets`` at most reach the driver) cut the rows
    into buckets, so that one shuffle of the texts brings neighbours together.  Each bucket also gets the first row of the
    one behind it.  Rows with one id are told apart by the hash of their text.  Of more than ``many`` equal rows only
    one takes part: the second table has a row for each such group, whose next is itself, and ``more``, how often."""
    spark, docs = docs.sparkSession, ordered(docs)
    keys = written(docs.select(*ORDER), "keys")
    # a bound on their number: there are at most rows / many
    hot = keys.groupBy(*ORDER).agg(F.count("*").alias("c")).where(F.col("c") > many).collect()
    more = None
    if hot:
        known = spark.createDataFrame([(*[r[c] for c in ORDER], r.c - 1) for r in hot], "nul boolean, inv long, h long, more long")
        keys = keys.join(F.broadcast(known), list(ORDER), "left_anti").select(*ORDER).unionByName(known.select(*ORDER))
        more = written(docs.join(F.broadcast(known), list(ORDER)).dropDuplicates(list(ORDER)), "hot")
        docs = docs.join(F.broadcast(known), list(ORDER), "left_anti").unionByName(more.drop("more"))
        more = more.select("doc_id", "text", F.col("text").alias("next"), "more")
    ranges = keys.repartitionByRange(buckets, *ORDER).groupBy(F.spark_partition_id().alias("p")).agg(F.min(F.struct(*ORDER)).alias("first"))
    firsts = sorted(tuple(r["first"]) for r in ranges.collect())
    if not firsts:
        return docs.select("doc_id", "text", F.col("text").alias("next")), more
    cuts = F.from_json(F.lit(json.dumps([dict(zip(ORDER, x)) for x in firsts])), "array<struct<nul:boolean,inv:bigint,h:bigint>>")
    steps = F.array(*[F.lit(1 << i) for i in reversed(range(len(firsts).bit_length()))])
    # the last cut that isn't above the row, by halving
    bucket = F.aggregate(steps, F.lit(0), lambda at, s: F.when(F.get(cuts, at + s) <= F.struct(*ORDER), at + s).otherwise(at))
    heads = spark.createDataFrame([(*x, (i - 1) % len(firsts)) for i, x in enumerate(firsts)], "nul boolean, inv long, h long, b int")
    heads = docs.join(F.broadcast(heads), list(ORDER)).select("doc_id", "text", *ORDER, "b", F.lit(1).alias("copy")).dropDuplicates(["b"])
    dealt = docs.select("doc_id", "text", *ORDER).withColumn("b", bucket).withColumn("copy", F.lit(0)).unionByName(heads)
    w = Window.partitionBy("b").orderBy("copy", *ORDER, "text")
    return dealt.withColumn("next", F.lead("text").over(w)).where("copy = 0").select("doc_id", "text", "next"), more


def edits(docs: DataFrame, buckets: int | None = None, many: int = 100_000) -> DataFrame:
    """The query's columns: each document's fingerprint, its edited text's, and the two likenesses."""
    sweep(docs)
    rows, more = with_next(docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")), buckets or 4 * partitions(docs), many)
    out = compared(rows)
    if more is not None:
        # equal rows but one of each group, counted until now: in parts of a thousand, dealt anew
        parts = compared(more, "more").withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("more") - 1) / 1000))))
        parts = parts.repartition(partitions(docs)).withColumn(
            "one",
            F.explode(F.sequence(F.lit(1).cast("long"), F.least(F.lit(1000), F.col("more") - 1000 * F.col("part")))),
        )
        out = out.unionByName(parts.select(*out.columns))
    return out


def compared(rows: DataFrame, *more: str) -> DataFrame:
    n = F.char_length("text").cast("long")
    half = F.floor(n / 2).cast("int")
    rows = rows.withColumn("n_chars", n).withColumn(
        "edited",
        F.concat(F.expr("left(text, int(n_chars) - int(floor(n_chars / 2)))"), F.substring(F.col("next"), F.lit(1), half)),
    )
    rows = rows.withColumn("edited_sha256", F.sha2("edited", 256))
    rows = fingerprint(rows, "text", "text_")
    rows = fingerprint(rows, "edited", "edited_")
    rows = fingerprint(rows, "next", "next_", printed=False)
    rows = differing(rows, "text_", "edited_").withColumnRenamed("__like", "near_edited")
    rows = differing(rows.drop("__new_text_", "__all_text_"), "text_", "next_").withColumnRenamed("__like", "near_next")
    return rows.select(
        "doc_id", "n_chars", "edited_sha256", F.col("text_fingerprint").alias("fingerprint"), "edited_fingerprint",
        "near_edited", "near_next", *more,
    )
