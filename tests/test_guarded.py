"""Upserts whose deliveries come late, in any order, and with deletions."""

import datetime
import itertools
import random
import uuid

import pytest
from pyspark.sql import functions as F

from tableferry.operators import load
from tableferry.session import new_folder
from tableferry.streaming.stream import stream_upsert
from tableferry.streaming.tombstones import TombstoneStore

ROWS = "id long, v int, s string"


def rows(spark, values):
    return spark.createDataFrame(values, ROWS)


def held(df):
    return sorted((tuple(r) for r in df.select("id", "v", "s").collect()), key=str)


def test_older_rows_do_not_replace_newer_ones(spark):
    target = rows(spark, [(1, 10, "t"), (2, 10, "t"), (3, None, "t"), (5, 7, "t")])
    stage = rows(spark, [(1, 5, "s"), (2, 11, "s"), (3, 0, "s"), (4, None, "s"), (5, 7, "s"), (None, 1, "s")])
    found = held(load.guarded_upsert(target, stage, ["id"], ["v"]))
    assert found == sorted(
        [(1, 10, "t"), (2, 11, "s"), (3, 0, "s"), (4, None, "s"), (5, 7, "s"), (None, 1, "s")], key=str
    )


def test_every_order_of_deliveries_gives_the_same_table(spark):
    rng = random.Random(2)
    target = rows(spark, [(i, 3, "first") for i in range(6)])
    deliveries = [
        rows(spark, [(rng.randrange(8), version, f"{version}") for _ in range(6)]).dropDuplicates(["id"])
        for version in (1, 4, 7)
    ]
    results = []
    for order in list(itertools.permutations(deliveries))[1::2]:
        current = target
        for stage in order:
            current = load.guarded_upsert(current, stage, ["id"], ["v"])
        results.append(held(current))
    assert all(r == results[0] for r in results)


def test_the_target_is_not_shuffled_for_a_small_stage(spark):
    target = spark.read.parquet("/root/testdata/sf0.01/orders.parquet")
    stage = target.where("o_orderkey % 1000 = 1")
    plan = load.guarded_upsert(target, stage, ["o_orderkey"], ["o_orderdate"])._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    # The only rows that are shuffled are those with a staged key.
    assert plan.index("Exchange hashpartitioning") < plan.index("LeftSemi") or "LeftSemi" in plan


@pytest.fixture
def table(spark):
    name = f"guarded_{uuid.uuid4().hex}"
    first = rows(spark, [(i, 10, "first") for i in range(10)]).withColumn("p", (F.col("id") % 3).cast("int"))
    load.create_partitioned(first, name, ["p"])
    return name


def deliver(spark, table, values, stones=None, **options):
    stage = spark.createDataFrame(values, "id long, v int, s string, p int, gone boolean")
    return load.upsert_partitions(
        spark, table, stage, ["id"], ["p"], ["v"], guarded=True, deleted="gone", tombstones=stones, **options
    )


def test_partitions_that_only_get_older_rows_are_left_alone(spark, table):
    files = sorted(spark.table(table).inputFiles())
    assert deliver(spark, table, [(1, 9, "old", 1, False), (2, 8, "old", 0, None)]) == 0
    assert sorted(spark.table(table).inputFiles()) == files
    assert deliver(spark, table, [(1, 11, "new", 2, False), (2, 8, "old", 0, None)]) == 2
    found = {r["id"]: (r["s"], r["p"]) for r in spark.table(table).collect()}
    assert found[1] == ("new", 2) and found[2] == ("first", 2) and len(found) == 10


def test_a_deleted_key_stays_deleted(spark, table):
    stones = TombstoneStore(new_folder(spark, "stones"), ["id"], ["v"])
    deliver(spark, table, [(1, 20, None, None, True), (99, 20, None, None, True), (2, 5, None, None, True)], stones)
    ids = {r["id"] for r in spark.table(table).collect()}
    assert 1 not in ids and 2 in ids  # an older deletion deletes nothing
    deliver(spark, table, [(1, 15, "late", 1, False), (99, 15, "late", 0, False)], stones)
    assert {r["id"] for r in spark.table(table).collect()} == ids
    # Of equal versions the deletion stands; a newer row is a new row.
    deliver(spark, table, [(1, 20, "tie", 1, False), (99, 21, "back", 0, False)], stones)
    found = {r["id"]: r["s"] for r in spark.table(table).collect()}
    assert 1 not in found and found[99] == "back"
    # Repeating a delivery changes nothing.
    before = held(spark.table(table))
    deliver(spark, table, [(1, 20, None, None, True), (99, 20, None, None, True)], stones)
    assert held(spark.table(table)) == before


def test_without_tombstones_a_late_row_of_a_deleted_key_comes_back(spark, table):
    deliver(spark, table, [(1, 20, None, None, True)])
    deliver(spark, table, [(1, 15, "late", 1, False)])
    assert {r["id"]: r["s"] for r in spark.table(table).collect()}[1] == "late"


def test_tombstones_are_forgotten(spark, table):
    stones = TombstoneStore(new_folder(spark, "stones"), ["id"], ["v"])
    deliver(spark, table, [(1, 20, None, None, True), (2, 30, None, None, True)], stones)
    deliver(spark, table, [(2, 31, None, None, True)], stones)
    stones.forget(spark, F.col("v") < 25)
    assert [tuple(r) for r in stones.rows(spark).select("id", "v").collect()] == [(2, 31)]
    deliver(spark, table, [(1, 15, "late", 1, False), (2, 30, "late", 1, False)], stones)
    found = {r["id"]: r["s"] for r in spark.table(table).collect()}
    assert found[1] == "late" and 2 not in found


def test_a_load_cut_off_after_noting_its_deletions_can_be_repeated(spark, table, monkeypatch):
    stones = TombstoneStore(new_folder(spark, "stones"), ["id"], ["v"])
    values = [(1, 20, None, None, True), (2, 21, "new", 0, False)]
    with monkeypatch.context() as broken, pytest.raises(RuntimeError):
        broken.setattr(load, "_rewrite", lambda *_: (_ for _ in ()).throw(RuntimeError("lost")))
        deliver(spark, table, values, stones)
    assert spark.table(table).count() == 10
    deliver(spark, table, values, stones)
    found = {r["id"]: r["s"] for r in spark.table(table).collect()}
    assert 1 not in found and found[2] == "new"


def test_an_open_reader_finishes_after_a_load(spark, table):
    reader = spark.table(table)
    files = reader.inputFiles()
    deliver(spark, table, [(i, 11, "new", i % 3, False) for i in range(10)])
    assert {r["s"] for r in spark.read.parquet(*files).collect()} == {"first"}
    assert {r["s"] for r in spark.table(table).collect()} == {"new"}
    assert load.clean_replaced(spark, table) == 0  # within the time of grace
    assert load.clean_replaced(spark, table, datetime.timedelta(0)) == 3
    assert spark.table(table).count() == 10 and load.clean_replaced(spark, table, datetime.timedelta(0)) == 0


def test_a_guard_needs_a_version(spark, table):
    with pytest.raises(ValueError):
        load.upsert_partitions(spark, table, spark.table(table), ["id"], ["p"], guarded=True)


def test_one_batch_or_many_make_the_same_table(spark):
    """Versions of keys as files, in one batch of a stream and in one batch each."""
    rng = random.Random(7)
    values = [(rng.randrange(9), v, f"{v}", rng.randrange(3), rng.random() < 0.3) for v in range(40)]
    rng.shuffle(values)
    schema = "id long, v int, s string, p int, gone boolean"
    want = {}
    for i, v, s, p, gone in values:
        want[i] = max(want.get(i, (-1,)), (v, s, p, gone))
    want = sorted((i, v, s, p) for i, (v, s, p, gone) in want.items() if not gone)
    for files_per_run in (40, 20):
        name = f"stream_{uuid.uuid4().hex}"
        load.create_partitioned(spark.createDataFrame([], "id long, v int, s string, p int"), name, ["p"])
        arrivals, checkpoint = new_folder(spark, "arrivals"), new_folder(spark, "checkpoint")
        stones = TombstoneStore(new_folder(spark, "stones"), ["id"], ["v"])
        for at in range(0, 40, files_per_run):
            spark.createDataFrame(values[at : at + files_per_run], schema).write.mode("append").parquet(arrivals)
            stream = spark.readStream.schema(schema).parquet(arrivals)
            stream_upsert(
                stream, name, ["id"], ["p"], checkpoint, ["v"], guarded=True, deleted="gone", tombstones=stones
            ).awaitTermination()
        assert sorted(tuple(r) for r in spark.table(name).select("id", "v", "s", "p").collect()) == want
