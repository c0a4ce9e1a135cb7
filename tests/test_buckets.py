"""Increments by fingerprints of buckets."""

import uuid

import pytest
from pyspark.sql import functions as F

from tableferry.operators import load
from tableferry.session import new_folder
from tableferry.streaming.buckets import BucketStore, bucket_load, differing_buckets


def source_of(spark, rows):
    return spark.createDataFrame(rows, "id long, s string, day int, hour int")


@pytest.fixture
def target(spark):
    name = f"buckets_{uuid.uuid4().hex}"
    load.create_partitioned(source_of(spark, []), name, ["day", "hour"])
    store = BucketStore(new_folder(spark, "buckets"), ["day", "hour"])

    def take(rows):
        def commit(stage, places):
            load.replace_partitions(spark, name, stage, ["day", "hour"], places)

        return bucket_load(source_of(spark, rows), store, commit)

    return name, store, take


FIRST = [(i, f"s{i}", i // 4, i % 2) for i in range(16)]


def content(spark, name):
    return sorted(tuple(r) for r in spark.table(name).select("id", "s", "day", "hour").collect())


def test_late_changed_and_deleted_rows(spark, target):
    name, store, take = target
    assert take(FIRST) == {"new": 8, "changed": 0, "gone": 0, "rows": 16}
    assert take(FIRST) == {"new": 0, "changed": 0, "gone": 0, "rows": 0}
    # A late row in an old bucket, a changed one, a deleted one, a bucket that goes, a new one.
    rows = [r for r in FIRST if r[0] not in (5, 13, 15)]
    rows = [(i, "changed" if i == 8 else s, d, h) for i, s, d, h in rows] + [(99, "late", 0, 0), (100, "new", 9, 9)]
    assert take(rows) == {"new": 1, "changed": 3, "gone": 1, "rows": 3 + 1 + 2 + 1}
    assert content(spark, name) == sorted(rows)
    # A bucket that went comes back, and everything may go.
    assert take(FIRST)["new"] == 1
    assert content(spark, name) == sorted(FIRST)
    assert take([])["gone"] == 8 and content(spark, name) == []
    assert take([]) == {"new": 0, "changed": 0, "gone": 0, "rows": 0}


def test_a_failed_commit_is_taken_up_again(spark, target):
    name, store, take = target

    def failing(stage, places):
        raise RuntimeError("lost")

    with pytest.raises(RuntimeError):
        bucket_load(source_of(spark, FIRST), store, failing)
    assert take(FIRST)["new"] == 8 and content(spark, name) == sorted(FIRST)


def test_rows_that_change_places_within_a_bucket_are_no_change(spark, target):
    _, store, take = target
    take(FIRST)
    assert take(FIRST[::-1])["changed"] == 0
    # Two rows that swap their texts are one.
    rows = [(i, {0: "s2", 2: "s0"}.get(i, s), d, h) for i, s, d, h in FIRST]
    assert take(rows)["changed"] == 1


def test_repeated_rows_and_null_buckets(spark, target):
    _, store, _ = target
    rows = source_of(spark, [(1, "a", 1, None), (1, "a", 1, None), (2, "b", None, None)])
    assert differing_buckets(rows, store).count() == 2
    bucket_load(rows, store, lambda stage, places: None)
    assert differing_buckets(rows, store).isEmpty()
    assert differing_buckets(rows.dropDuplicates(), store).count() == 1


def test_the_store_keeps_its_newest_entries(spark, target):
    _, store, take = target
    take(FIRST)
    take(FIRST[4:])
    before = sorted(map(tuple, store.latest(spark).collect()))
    assert store.entries(spark).count() == 10
    store.compact(spark)
    assert store.entries(spark).count() == 8
    assert sorted(map(tuple, store.latest(spark).collect())) == before


def test_rows_are_not_shuffled(spark, target):
    _, store, take = target
    take(FIRST)
    plan = differing_buckets(source_of(spark, FIRST), store)._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "partial_sum" in plan[plan.index("Exchange"):]
