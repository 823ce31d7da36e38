"""Which files still have to be processed: joins of a listing with the listing of the targets."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.paths import increment_index, move, remove_suffix


def skip_completed(
    files: DataFrame, targets: DataFrame, old_suffix: str, new_suffixes: list[str] | str, source_dir: str | None = None,
    target_dir: str | None = None, check_timestamp: bool = False, overwrite: bool = False, shift: int = 0,
) -> DataFrame:
    """The files of which some expected target is missing or, with check_timestamp, older than the file.

    Both sides are (path, modificationTime, ...).  One equi-join of all expected targets with the listing; the file's
    own columns travel once, in the final semi-join on its path."""
    if (source_dir is None) != (target_dir is None):
        raise ValueError("give both of source_dir and target_dir, or neither")
    if overwrite:
        return files
    suffixes = [new_suffixes] if isinstance(new_suffixes, str) else new_suffixes
    base = remove_suffix(F.col("path"), old_suffix)
    base = move(base, source_dir, target_dir) if source_dir is not None else base
    base = increment_index(base, shift) if shift else base
    wanted = files.select(
        "path", F.col("modificationTime").alias("changed"),
        F.explode(F.array(*[F.concat(base, F.lit(s)) for s in suffixes])).alias("target"),
    )
    made = targets.groupBy(F.col("path").alias("target")).agg(F.min("modificationTime").alias("made"))
    missing = F.col("made").isNull()
    stale = F.col("made") < F.col("changed")
    open_ = wanted.join(made, "target", "left").where(missing | stale if check_timestamp else missing)
    return files.join(open_.select("path"), "path", "left_semi")
