"""Timed lyrics: words, filler filter, byte tokens."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

LYRICS = "lyrics array<struct<words:array<struct<word:string,start:double,end:double>>,start:double,end:double>>"
# Phrases that speech-to-text models invent over silence.
FILLERS = ("Bye.", "Thank you.")


def words(rows: DataFrame, key: str, lyrics: str, blacklist: tuple[str, ...] = FILLERS) -> DataFrame:
    """A row per word with its place and times, without segments whose words joined are a filler."""
    segment = rows.select(key, F.posexplode(F.col(lyrics)["lyrics"]).alias("segment", "s"))
    text = F.array_join(F.transform(F.col("s.words"), lambda w: w["word"]), " ")
    kept = segment.where(~text.isin(*blacklist)) if blacklist else segment
    return kept.select(key, "segment", F.posexplode("s.words").alias("at", "w")).select(key, "segment", "at", "w.word", "w.start", "w.end")


def byte_tokens(text: Column) -> Column:
    """UTF-8 bytes plus 3: the ids of byte-level text models with three special tokens."""
    codes = F.regexp_extract_all(F.hex(F.encode(text, "utf-8")), F.lit("(..)"), F.lit(1))
    return F.transform(codes, lambda x: F.conv(x, 16, 10).cast("int") + 3)


def require_suffix(path: Column, suffix: str = ".whisper.json") -> Column:
    """The path, or an error if it doesn't end with the suffix."""
    return F.when(F.endswith(path, F.lit(suffix)), path).otherwise(F.raise_error(F.concat(F.lit(f"must end with {suffix}: "), path)).cast("string"))
