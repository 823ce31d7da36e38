"""Skip-completed as a stream: new files of a directory, in micro-batches, without those already processed."""

from __future__ import annotations

from collections.abc import Callable
from contextlib import suppress

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.paths import glob_regex, literal_root, without_scheme
from ..operators.incremental import skip_completed
from ..operators.listing import list_files


#: For files of which only names are taken: what a task counts for one (Spark's 4 MB, meant for files that are opened, make a
#: task of every few), and the tasks in which a micro-batch's files are looked up (by default one for each file, up to 10,000).
NAMES = {"spark.sql.files.openCostInBytes": str(1 << 14), "spark.sql.sources.parallelPartitionDiscovery.parallelism": "64"}


def names_session(spark: SparkSession) -> SparkSession:
    """A session with the settings of this one and NAMES: a file source looks files up with those of the session it was made in."""
    own = spark.newSession()
    for k, v in {**dict(spark.conf.getAll), **NAMES}.items():
        with suppress(PySparkException):  # those of the whole application are the same here and can't be set
            own.conf.set(k, v)
    return own


def file_stream(spark: SparkSession, glob: str, per_batch: int | None = None, content: bool = True) -> DataFrame:
    """New files below a glob, as they come; 1000 in a micro-batch, without contents 100,000, unless ``per_batch`` says."""
    schema = "path string, modificationTime timestamp, length bigint, content binary"
    most = per_batch or (1000 if content else 100_000)
    files = spark.readStream.format("binaryFile").schema(schema).option("recursiveFileLookup", "true").option("maxFilesPerTrigger", most).load(literal_root(glob))
    files = files.withColumn("path", without_scheme(F.col("path")))
    files = files.where(F.col("path").rlike(glob_regex(glob)))
    return files if content else files.drop("content")


def process_new(
    spark: SparkSession, glob: str, target_glob: str, old_suffix: str, new_suffixes: list[str],
    process: Callable[[DataFrame], None], checkpoint: str, per_batch: int | None = None, content: bool = True, **options,
) -> StreamingQuery:
    """Run ``process`` on each micro-batch's files that still miss a target; ends when no new file is left.

    Each micro-batch lists all targets.  Without ``content`` no source file is opened and micro-batches are large, so the
    targets of many files are listed a few times only."""

    def batch(files: DataFrame, _: int) -> None:
        process(skip_completed(files, list_files(files.sparkSession, target_glob), old_suffix, new_suffixes, **options))

    stream = file_stream(spark if content else names_session(spark), glob, per_batch, content).writeStream.foreachBatch(batch)
    return stream.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
