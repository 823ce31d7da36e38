"""The tables that operators write: how long they and their exchanges live."""

import gc
import threading
import time
from pathlib import Path
from urllib.parse import urlparse

import pytest

from tesselake.llm import common


def there(table):
    return Path(urlparse(table._written).path).exists()


def test_tables_live_as_long_as_a_plan_reads_them(spark):
    one, two = (common.written(spark.range(10), "t") for _ in range(2))
    derived = one.where("id > 3")
    paths = one._written, two._written
    del one, two
    for _ in range(5):
        gc.collect()
        common.sweep(spark.range(1))
        time.sleep(0.3)
    assert derived.count() == 6
    assert [Path(urlparse(p).path).exists() for p in paths] == [True, False]


def test_dropped_and_bucketed(spark):
    table = common.bucketed(spark.range(100).withColumnRenamed("id", "row"), "b", "row", 4)
    assert spark.sql("show tables").where("tableName like 'b_%'").count() == 0
    joined = table.join(spark.range(50).withColumnRenamed("id", "row").hint("shuffle_hash"), "row")
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert joined.count() == 50 and plan.count("Exchange hashpartitioning") == 1 and "Bucketed: true" in plan
    common.dropped(spark, table)
    assert not there(table)


def test_a_sieve_misses_nothing(spark, monkeypatch):
    rows = spark.range(5000).selectExpr("id", "id % 7 as h")
    wanted = rows.where("id % 50 = 3")
    out = common.sieved(rows, wanted, "id", "h")
    assert out.columns == ["id", "h", "hit"] and out.count() == 5000
    hits = {r.id for r in out.where("hit").collect()}
    assert {i for i in range(5000) if i % 50 == 3} <= hits and len(hits) < 110
    assert common.sieved(rows, wanted.where("false"), "id", "h").where("hit").count() == 0
    monkeypatch.setattr(common, "SIEVE", 64)  # full: lets all through
    assert common.sieved(rows, rows, "id", "h").where("hit").count() == 5000


def test_the_setting_comes_back(spark):
    assert spark.conf.get(common.CLEANUP, None) in (None, "false")
    before = spark.conf.get(common.CLEANUP, None)
    inside, leave = threading.Event(), threading.Event()

    def other():
        with common.short_lived_exchanges(spark):
            inside.set()
            leave.wait(10)

    t = threading.Thread(target=other)
    t.start()
    inside.wait(10)
    with common.short_lived_exchanges(spark):
        leave.set()
        t.join()
        assert spark.conf.get(common.CLEANUP) == "true"
    assert spark.conf.get(common.CLEANUP, None) == before


def test_a_shared_folder_is_asked_for_on_a_cluster():
    class Conf:
        def get(self, name, default=None):
            return default

    class Session:
        conf = Conf()

        class sparkContext:
            master = "spark://host:7077"

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        common.shared_dir(Session())
