import datetime

import pytest
from pyspark.sql import functions as F

from tableferry.operators import load
from tableferry.session import new_folder
from tableferry.streaming.incremental import incremental_load, incremental_upsert, newer_rows
from tableferry.streaming.marks import MarkStore
from tableferry.streaming.stream import stream_upsert

NOON = datetime.datetime(2024, 1, 1, 12)


def changes(spark, text):
    return spark.sql(f"SELECT * FROM VALUES {text} AS t(id, at, s)").withColumn(
        "at", F.col("at").cast("timestamp_ntz")
    )


def test_newer_rows_keep_ties_and_rows_without_a_moment(spark):
    rows = changes(
        spark,
        "(1, '2024-01-01 11:59:59.999999', 'a'), (2, '2024-01-01 12:00:00', 'b'),"
        "(3, NULL, 'c'), (4, '2024-01-01 13:00:00', 'd')",
    )
    assert newer_rows(rows, "at", None).count() == 4
    assert [r.id for r in newer_rows(rows, "at", NOON).orderBy("id").collect()] == [2, 3, 4]
    assert [r.id for r in newer_rows(rows, "at", NOON, NOON).orderBy("id").collect()] == [2, 3]


def test_incremental_upsert(spark):
    target = changes(spark, "(1, '2024-01-01 10:00:00', 'a'), (2, '2024-01-01 12:00:00', 'b')")
    source = changes(spark, "(1, '2024-01-01 10:00:00', 'A'), (2, '2024-01-01 13:00:00', 'B')")
    found = incremental_upsert(source, target, ["id"], "at", NOON).orderBy("id").collect()
    assert [r.s for r in found] == ["a", "B"]


def test_marks(spark):
    marks = MarkStore(new_folder(spark, "marks"))
    assert marks.last_time(spark, "t") is None
    assert marks.latest(spark).count() == 0
    marks.save(spark, "t", NOON, 5)
    later = NOON + datetime.timedelta(hours=1, microseconds=7)
    marks.save(spark, "t", later, 3)
    marks.save(spark, "t", later + datetime.timedelta(days=1), 0, "failed")
    marks.save(spark, "other", NOON, 1)
    assert marks.last_time(spark, "t") == later
    newest = {r.table_name: (r.status, r.last_sync_count) for r in marks.latest(spark).collect()}
    assert newest == {"t": ("failed", 0), "other": ("success", 1)}
    marks.reset(spark, "t")
    assert marks.last_time(spark, "t") is None
    assert marks.last_time(spark, "other") == NOON


def test_the_mark_moves_only_after_the_commit(spark):
    marks = MarkStore(new_folder(spark, "marks"))
    source = changes(spark, "(1, '2024-01-01 10:00:00', 'a'), (2, '2024-01-01 12:00:00', 'b')")
    seen = []

    def failing(stage):
        raise RuntimeError("lost")

    with pytest.raises(RuntimeError):
        incremental_load(source, "t", "at", marks, failing)
    assert marks.last_time(spark, "t") is None
    assert incremental_load(source, "t", "at", marks, lambda s: seen.append(s.count())) == 2
    assert incremental_load(source, "t", "at", marks, lambda s: seen.append(s.count())) == 1
    assert seen == [2, 1] and marks.last_time(spark, "t") == NOON
    assert incremental_load(source.limit(0), "t", "at", marks, failing) == 0


def test_a_stream_takes_up_where_it_stopped(spark):
    name = "stream_case"
    arrivals, checkpoint = new_folder(spark, "arrivals"), new_folder(spark, "checkpoint")
    empty = spark.range(0).select("id", F.lit("").alias("s"), F.lit(0).alias("p"))
    load.create_partitioned(empty, name, ["p"])

    def deliver(text):
        spark.sql(f"SELECT * FROM VALUES {text} AS t(id, s, p)").select(
            F.col("id").cast("bigint"), "s", "p"
        ).write.mode("append").parquet(arrivals)

    def run():
        stream = spark.readStream.schema(empty.schema).parquet(arrivals)
        query = stream_upsert(stream, name, ["id"], ["p"], checkpoint)
        query.awaitTermination()
        return sum(p["numInputRows"] for p in query.recentProgress)

    deliver("(1, 'a', 0), (2, 'b', 1)")
    assert run() == 2
    deliver("(2, 'B', 0), (3, 'c', 1)")
    assert run() == 2
    assert run() == 0
    found = [tuple(r) for r in spark.table(name).select("id", "s", "p").orderBy("id").collect()]
    assert found == [(1, "a", 0), (2, "B", 0), (3, "c", 1)]


def test_no_clock_decides_which_mark_is_newest(spark, monkeypatch):
    marks = MarkStore(new_folder(spark, "marks"))

    hours = iter(range(20, 0, -1))

    class Clock(datetime.datetime):
        @classmethod
        def now(cls, tz=None):
            return datetime.datetime(2024, 1, 1, next(hours))

    with monkeypatch.context() as patched:
        patched.setattr("tableferry.streaming.marks.datetime.datetime", Clock)
        for k in range(3):
            marks.save(spark, "t", NOON + datetime.timedelta(days=k), k)
    assert marks.last_time(spark, "t") == NOON + datetime.timedelta(days=2)
    marks.save(spark, "t", NOON, 0, "failed")
    marks.compact(spark)
    assert marks.all_marks(spark).count() == 2
    assert marks.last_time(spark, "t") == NOON + datetime.timedelta(days=2)
    assert marks.latest(spark).first().status == "failed"
