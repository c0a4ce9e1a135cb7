"""The plans are what the operators promise: what is read, joined and shuffled."""

import datetime
import re

import pytest
from pyspark.sql import functions as F

from tableferry.operators import audits, load, reconcile
from tableferry.operators.shape import conform_table, prune_unsupported
from tableferry.session import new_folder
from tableferry.sources.ranges import in_splits
from tableferry.streaming.incremental import newer_rows

SF_DIR = "/root/testdata/sf0.01"


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def orders(spark):
    return spark.read.parquet(f"{SF_DIR}/orders.parquet")


def test_dropped_columns_are_not_read(spark):
    vectors = spark.read.parquet(f"{SF_DIR}/embeddings.parquet")
    plan = plan_of(conform_table(prune_unsupported(vectors)))
    assert "ReadSchema: struct<vec_id:bigint,label:int>" in plan
    assert "Exchange" not in plan


def test_the_mark_filters_the_scan(spark):
    events = spark.read.parquet(f"{SF_DIR}/events.parquet")
    plan = plan_of(newer_rows(events, "ts", datetime.datetime(2024, 1, 20)))
    assert "PushedFilters: [Or(GreaterThanOrEqual(ts,2024-01-20T00:00),IsNull(ts))]" in plan


def test_interval_bounds_filter_the_scan(orders):
    plan = plan_of(orders.where(in_splits("o_orderkey", 1, 1000, 10, [2, 3])))
    assert "GreaterThanOrEqual(o_orderkey,201)" in plan
    assert "LessThanOrEqual(o_orderkey,400)" in plan


def test_comparing_shuffles_keys_and_hashes_once(orders):
    for df in (
        reconcile.row_diff(orders, orders.where("o_orderkey <> 1"), ["o_orderkey"]),
        reconcile.column_diff(orders, orders.where("o_orderkey <> 1"), ["o_orderkey"]),
        reconcile.multiset_suspects(orders, orders.where("o_orderkey <> 1")),
    ):
        plan = plan_of(df)
        assert "Join" not in plan and "SortAggregate" not in plan
        assert plan.count("Exchange hashpartitioning") == 1
        shuffled = plan[plan.index("Exchange hashpartitioning"):].split("\n")[1]
        assert "partial_sum" in shuffled and "o_orderpriority" not in shuffled


def test_checksums_shuffle_one_row_per_task(orders):
    plan = plan_of(reconcile.table_checksums({"orders": orders}))
    assert re.findall(r"Exchange (\w+)", plan) == ["SinglePartition"]
    assert "partial_sum" in plan[plan.index("Exchange"):]


def test_samples_do_not_sort_the_table(orders):
    smallest = orders.select("o_orderkey").coalesce(20).orderBy("o_orderkey").limit(1000)
    plan = plan_of(smallest.agg(F.max(F.struct("o_orderkey"))))
    assert "TakeOrderedAndProject" in plan and "rangepartitioning" not in plan
    assert "Exchange" not in plan_of(reconcile.rows_by_key_share(orders, ["o_orderkey"], 0.1))


def test_bad_row_samples_do_not_sort_the_export(spark):
    folder = new_folder(spark, "hex")
    spark.createDataFrame([("1", "zz")], "id string, data string").write.csv(folder)
    from tableferry.sources.csv_files import read_export

    found = audits.hex_audit_samples(read_export(spark, folder, ["id", "data"]), ["data"], "id")
    assert "TakeOrderedAndProject" in plan_of(found)


@pytest.fixture
def no_broadcast(spark):
    threshold = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(threshold)
    spark.conf.set(threshold, "1k")
    yield
    spark.conf.set(threshold, before)


def _orphan_plan(spark):
    lines = spark.read.parquet(f"{SF_DIR}/lineitem.parquet")
    supplier = spark.read.parquet(f"{SF_DIR}/supplier.parquet")
    return plan_of(audits.fk_orphans(lines, ["l_suppkey"], supplier, ["s_suppkey"]))


def test_children_are_counted_before_they_meet_a_large_parent(spark, no_broadcast):
    plan = _orphan_plan(spark)
    assert plan.index("SortMergeJoin") < plan.index("partial_count")
    assert "Broadcast" not in plan


def test_children_meet_a_small_parent_without_a_shuffle(spark):
    plan = _orphan_plan(spark)
    below_the_only_shuffle = plan[plan.index("Exchange hashpartitioning"):]
    assert plan.count("Exchange hashpartitioning") == 1
    assert below_the_only_shuffle.index("partial_count") < below_the_only_shuffle.index("Join")


def test_a_small_stage_is_broadcast(orders):
    stage = orders.where("o_orderkey % 2 = 0")
    assert "BroadcastHashJoin" in plan_of(load.delete_insert(orders, stage, ["o_orderkey"]))


def test_a_large_stage_is_not(orders, no_broadcast):
    stage = orders.where("o_orderkey % 2 = 0")
    plan = plan_of(load.delete_insert(orders, stage, ["o_orderkey"]))
    assert "SortMergeJoin" in plan and "Broadcast" not in plan
