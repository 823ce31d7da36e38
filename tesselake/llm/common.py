"""What the operators of this subpackage share: shared-folder tables, hashing of words, Arrow helpers."""

from __future__ import annotations

import gc
import tempfile
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

#: With this setting Spark removes a query's exchanges as soon as the query has ended.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir.  Where that is unset, a session with a local
    master gets a folder made here, stored under that setting; any other raises, as executors would not see it."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        master = spark.sparkContext.master
        if not (master == "local" or master.startswith("local[")):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        found = Path(tempfile.mkdtemp(prefix="tesselake-")).as_uri()
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


#: How many threads are within ``short_lived_exchanges``, and the setting that the first of them found.
INSIDE: dict[str, tuple[int, str | None]] = {}
GUARD = threading.Lock()


@contextmanager
def short_lived_exchanges(spark: SparkSession) -> Iterator[None]:
    """Queries that run within leave no shuffle files behind (a setting of the session: another thread's query may lose
    its exchanges, too, at its end, and writes them again if it is run again)."""
    who = spark._jsparkSession.sessionUUID()
    with GUARD:
        n, before = INSIDE.get(who, (0, None))
        INSIDE[who] = n + 1, before if n else spark.conf.get(CLEANUP, None)
        spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        with GUARD:
            n, before = INSIDE.pop(who)
            if n > 1:
                INSIDE[who] = n - 1, before
            elif before is None:
                spark.conf.unset(CLEANUP)
            else:
                spark.conf.set(CLEANUP, before)


class Held:
    """The written tables of this process, each with a weak reference to the file index that every plan over it holds.

    A table goes when its maker drops it, or when no plan reads it any more: ``sweep`` removes those whose file index
    the JVM has collected.  So a result that someone still holds keeps its tables, in whichever thread it was made."""

    def __init__(self) -> None:
        self.lock, self.refs = threading.Lock(), {}

    def add(self, path: str, table: DataFrame) -> None:
        jvm = table.sparkSession._jvm
        index = table._jdf.queryExecution().analyzed().collectLeaves().head().relation().location()
        with self.lock:
            self.refs[path] = jvm.java.lang.ref.WeakReference(index)

    def remove(self, spark: SparkSession, path: str) -> None:
        with self.lock:
            self.refs.pop(path, None)
        place = spark._jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)

    def sweep(self, spark: SparkSession) -> None:
        gc.collect()  # Python's handles on JVM objects
        spark._jvm.System.gc()
        with self.lock:
            gone = [path for path, ref in self.refs.items() if ref.get() is None]
        for path in gone:
            self.remove(spark, path)


HELD = Held()


def written(df: DataFrame, name: str) -> DataFrame:
    """Cut the lineage of ``df``: write it as Parquet in the shared folder and read that."""
    spark = df.sparkSession
    path = new_path(spark, name)
    with short_lived_exchanges(spark):
        df.write.option("compression", "zstd").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._written = path
    HELD.add(path, out)
    return out


def bucketed(df: DataFrame, name: str, by: str, buckets: int, dealt: bool = False) -> DataFrame:
    """Like ``written``, dealt by the column ``by``: joins on it don't shuffle the table again.  dealt: ``df`` comes from
    ``repartition(buckets, by)`` already.

    Spark keeps buckets for catalogue tables only; the entry goes again once the table's plan is made."""
    spark = df.sparkSession
    path, entry = new_path(spark, name), f"{name}_{uuid.uuid4().hex}"
    with short_lived_exchanges(spark):
        rows = df if dealt else df.repartition(buckets, by)
        rows.write.bucketBy(buckets, by).option("compression", "zstd").option("path", path).saveAsTable(entry)
    out = spark.table(entry)
    out = out.select("*")  # analysed: holds the files, not the entry
    out._written = path
    HELD.add(path, out)
    spark.sql(f"DROP TABLE {entry}")
    return out


#: Bits of a sieve: its words are a broadcast of 131,072 rows at most, whatever the data.
SIEVE = 1 << 23


def sieved(rows: DataFrame, wanted: DataFrame, *keys: str) -> DataFrame:
    """Rows with ``hit``: false only where no row of ``wanted`` has these keys.

    A bitmap of hashes, of a fixed size, says so; what it lets through by chance a join behind it removes.  So rows that the
    join would drop needn't be shuffled for it, as long as the wanted ones are few beside the bitmap's bits."""
    place = F.pmod(F.xxhash64(*keys), F.lit(SIEVE)).alias("place")
    words = wanted.select(place).select(F.expr("shiftright(place, 6)").alias("word"), F.expr("shiftleft(1L, int(place % 64))").alias("bit"))
    words = written(words.groupBy("word").agg(F.bit_or("bit").alias("bits")), "sieve")
    found = rows.withColumn("place", place).withColumn("word", F.expr("shiftright(place, 6)")).join(F.broadcast(words), "word", "left")
    hit = F.coalesce(F.expr("shiftright(bits, int(place % 64)) & 1L = 1L"), F.lit(False))
    return found.withColumn("hit", hit).drop("place", "word", "bits")


def dropped(spark: SparkSession, *tables: DataFrame | None) -> None:
    """Remove written tables of an operator's own that nothing reads any more."""
    for t in tables:
        if path := getattr(t, "_written", None):
            HELD.remove(spark, path)


def sweep(df: DataFrame) -> None:
    """Remove the written tables that no plan reads any more, as those of consumed results."""
    HELD.sweep(df.sparkSession)


def partitions(df: DataFrame, floor: int = 1) -> int:
    """Shuffle partitions of the session, the number by which operators deal out their own buckets."""
    return max(floor, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def texts_of(batch: pa.RecordBatch, name: str = "text") -> list[str]:
    """The strings of a column, null as the empty text."""
    return ["" if x is None else x for x in batch.column(name).to_pylist()]


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of uint64 values (the finaliser of splitmix64)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def small_batches(batches: Iterator[pa.RecordBatch], max_bytes: int) -> Iterator[pa.RecordBatch]:
    """Slices of the batches of about max_bytes at most (a single larger row stays whole)."""
    for batch in batches:
        parts = max(1, -(-batch.nbytes // max_bytes))
        step = max(1, batch.num_rows // parts)
        for at in range(0, batch.num_rows, step):
            yield batch.slice(at, step)
