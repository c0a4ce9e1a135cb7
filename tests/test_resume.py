"""Observed loads, key ranges, and loads that go on where they stopped."""

import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tableferry.operators.observed import Watch
from tableferry.operators.reconcile import table_checksums
from tableferry.plans import migration, resume
from tableferry.plans.resume import RangeLedger, ResumableLoad
from tableferry.session import discard, new_folder
from tableferry.sources import key_ranges
from tableferry.sources.files import FileStore

SF_DIR = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def lines(spark):
    return spark.read.parquet(f"{SF_DIR}/lineitem.parquet")


# -- facts of a load --------------------------------------------------------------------------


def test_facts_are_those_of_the_table(spark, lines):
    store = FileStore(new_folder(spark, "target"))
    watch = Watch(lines)
    store.reload(watch.rows, "lineitem")
    facts = watch.facts()
    found = table_checksums({"t": store.read(spark, "lineitem")}, typed=True).first()
    assert (facts.n_rows, facts.checksum) == (found["n_rows"], found["checksum"])
    assert watch.rows.columns == lines.columns
    assert facts.comparable_with(store.read(spark, "lineitem").schema)
    assert not facts.comparable_with(lines.drop("l_tax").schema)


def test_facts_of_an_empty_table(spark, lines):
    for empty in (lines.limit(0), lines.where("1 = 0"), spark.createDataFrame([], lines.schema)):
        watch = Watch(empty)
        FileStore(new_folder(spark, "target")).reload(watch.rows, "t")
        assert watch.facts().n_rows == 0
        assert watch.facts().checksum == table_checksums({"t": empty}, typed=True).first()["checksum"]


def test_the_source_is_read_once(spark, lines):
    """Taken from the file system: the source is gone before the validation."""
    source, target = FileStore(new_folder(spark, "source")), FileStore(new_folder(spark, "target"))
    source.append(lines, "lineitem")
    facts = {}
    migration.migrate(spark, source, target, ["lineitem"], facts=facts)
    discard(spark, source.path("lineitem"))
    reports = migration.validate(spark, source, target, ["lineitem"], facts=facts)
    assert reports["load"].first()["status"] == "success"
    assert reports["checksums"].first()["matched"] and reports["counts"].first()["matched"]


def test_a_changed_value_and_other_types_are_found(spark, lines):
    source, target = FileStore(new_folder(spark, "source")), FileStore(new_folder(spark, "target"))
    source.append(lines, "lineitem")
    facts = {}
    migration.migrate(spark, source, target, ["lineitem"], facts=facts)
    worse = lines.withColumn("l_tax", F.when(F.col("l_orderkey") == 1, 9.0).otherwise(F.col("l_tax")))
    target.reload(worse, "lineitem")
    reports = migration.validate(spark, source, target, ["lineitem"], facts=facts)
    assert not reports["checksums"].first()["matched"] and reports["counts"].first()["matched"]
    # A target with other types is compared with the source, as before.
    target.reload(lines.withColumn("l_linenumber", F.col("l_linenumber").cast("long")), "lineitem")
    reports = migration.validate(spark, source, target, ["lineitem"], facts=facts)
    assert reports["checksums"].first()["matched"]


# -- ranges over keys of any kind -------------------------------------------------------------


def pieces(df, keys, cuts):
    """Rows of each range by its filter; the numbers must agree with them."""
    number = key_ranges.range_number(keys, cuts)
    out = []
    for n, (low, high) in enumerate(key_ranges.key_ranges(cuts)):
        part = df.where(key_ranges.in_key_range(keys, low, high))
        assert part.where(number != n).isEmpty()
        out.append(part.count())
    return out


def test_ranges_over_two_columns_are_balanced(lines):
    keys = ["l_orderkey", "l_linenumber"]
    sizes = pieces(lines, keys, key_ranges.key_cuts(lines, keys, 10))
    assert sum(sizes) == lines.count() and len(sizes) == 10
    assert max(sizes) < 1.2 * sum(sizes) / 10 and min(sizes) > 0.8 * sum(sizes) / 10


def test_a_hot_leading_key_is_cut_by_the_second(spark):
    df = spark.range(9000).select((F.col("id") % 3 == 0).cast("int").alias("a"), F.col("id").alias("b"))
    df = df.withColumn("a", F.when(F.col("b") < 6000, 7).otherwise(F.col("a")))
    sizes = pieces(df, ["a", "b"], key_ranges.key_cuts(df, ["a", "b"], 6))
    assert max(sizes) < 1.2 * 1500 and len(sizes) == 6


@pytest.mark.parametrize("kind", ["text", "date", "moment", "decimal", "double"])
def test_kinds_of_keys_with_nulls(spark, kind):
    value = {
        "text": F.concat(F.lit("é'\\"), F.md5(F.col("id").cast("string"))),
        "date": F.date_add(F.lit("2024-01-01").cast("date"), F.col("id").cast("int")),
        "moment": F.expr("timestamp_ntz'2024-01-01 00:00:00.000001' + make_interval(0,0,0,0,0,id)"),
        "decimal": (F.col("id") / 7).cast("decimal(20,6)"),
        "double": F.sqrt("id"),
    }[kind]
    df = spark.range(400).select(F.when(F.col("id") % 5 > 0, value).alias("k`y"), (F.col("id") % 4).alias("n"))
    keys = ["k`y", "n"]
    cuts = key_ranges.key_cuts(df, keys, 5)
    assert sum(pieces(df, keys, cuts)) == 400 and len(cuts) == 4
    types = [df.schema[name].dataType for name in keys]
    again = [key_ranges.key_from_text(key_ranges.key_text(cut), types) for cut in cuts]
    assert again == cuts and pieces(df, keys, again) == pieces(df, keys, cuts)


def test_ranges_of_small_tables(spark):
    none = spark.createDataFrame([], "k long")
    assert key_ranges.key_cuts(none, ["k"], 4) == []
    assert pieces(none, ["k"], []) == [0]
    same = spark.range(50).select(F.lit(3).alias("k"))
    assert sum(pieces(same, ["k"], key_ranges.key_cuts(same, ["k"], 4))) == 50
    few = spark.createDataFrame([(None,), (1,), (2,)], "k long")
    assert sum(pieces(few, ["k"], key_ranges.key_cuts(few, ["k"], 8))) == 3


def test_cuts_as_texts():
    key = (None, 3, "a\"b", Decimal("1.50"), datetime.date(2024, 2, 3), datetime.datetime(2024, 2, 3, 4, 5, 6, 7))
    types = [T.LongType(), T.LongType(), T.StringType(), T.DecimalType(5, 2), T.DateType(), T.TimestampNTZType()]
    assert key_ranges.key_from_text(key_ranges.key_text(key), types) == key
    assert key_ranges.key_text(None) is None and key_ranges.key_from_text(None, types) is None


def test_the_leading_bound_filters_the_scan(spark, lines):
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    plan = lines.where(key_ranges.in_key_range(["l_orderkey", "l_linenumber"], (100, 2), (200, 1)))
    shown = plan._jdf.queryExecution().executedPlan().toString()
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    pushed = shown[shown.index("PushedFilters") :]
    assert "GreaterThanOrEqual(l_orderkey,100)" in pushed and "LessThanOrEqual(l_orderkey,200)" in pushed


# -- the ledger -------------------------------------------------------------------------------


def job_of(spark, **settings):
    settings = {"parts": 6, "ranges_per_job": 2, **settings}
    return ResumableLoad(
        FileStore(new_folder(spark, "target")), "t", ["l_orderkey", "l_linenumber"], RangeLedger(new_folder(spark, "ledger")), **settings
    )


def same(one, other):
    return one.exceptAll(other).isEmpty() and other.exceptAll(one).isEmpty()


class Lost(RuntimeError):
    pass


def test_a_load_cut_off_is_finished_by_the_next_call(spark, lines, monkeypatch):
    job = job_of(spark)
    note, calls = RangeLedger.note, []

    def breaking(self, *args):
        calls.append(1)
        if len(calls) == 4:  # the plan, two groups, and the third is written but not noted
            raise Lost
        note(self, *args)

    with monkeypatch.context() as broken, pytest.raises(Lost):
        broken.setattr(RangeLedger, "note", breaking)
        job.run(lines)
    rest = job.run(lines)
    assert (rest.n_loaded, rest.n_open) == (2, 0) and 0 < rest.rows_read < lines.count() / 2
    assert same(job.read(spark), lines)
    assert job.run(lines).rows_read == 0


def test_what_a_broken_attempt_left_is_overwritten(spark, lines):
    job = job_of(spark)
    job.run(lines, most_groups=1)
    stray = lines.limit(50).withColumn("_range", F.lit(3))
    stray.write.mode("append").partitionBy("_range").parquet(job.store.path("t"))
    assert job.run(lines).n_open == 0
    assert same(job.read(spark), lines)


def test_a_target_that_differs_is_not_verified(spark, lines, monkeypatch):
    job, seen = job_of(spark), []
    sums = resume.range_sums

    def short(df, number, columns):
        seen.append(1)
        return sums(df.where("l_orderkey % 1000 <> 5"), number, columns)

    with monkeypatch.context() as broken:
        broken.setattr(resume, "range_sums", short)
        first = job.run(lines)
    assert first.n_failed == 6 and first.n_open == 6 and seen
    assert job.run(lines).n_loaded == 6 and same(job.read(spark), lines)


def test_changes_at_the_source_reopen_their_ranges(spark, lines):
    job = job_of(spark, parts=10, ranges_per_job=10)
    job.run(lines)
    assert job.reopen_changed(lines) == []
    lowest = lines.agg(F.min("l_orderkey")).first()[0]
    changed = lines.where(F.col("l_orderkey") != lowest)
    assert job.reopen_changed(changed) == [0]
    after = job.run(changed)
    assert after.n_loaded == 1 and after.rows_read < lines.count() / 5
    assert same(job.read(spark), changed)
    # A range whose rows all went keeps no file.
    emptied = changed.where(~key_ranges.in_key_range(job.keys, *key_ranges.key_ranges(job._cuts(lines, job._planned(lines)))[4]))
    assert job.reopen_changed(emptied) == [4]
    assert job.run(emptied).rows_read == 0 and same(job.read(spark), emptied)


def test_the_ledger_keeps_its_newest_entries(spark, lines):
    job = job_of(spark)
    job.run(lines, most_groups=2)
    before = sorted(map(tuple, job.ledger.ranges(spark, "t").drop("updated_at").collect()))
    job.ledger.note(spark, "other", [{"part": 0, "status": "pending"}])
    job.ledger.compact(spark, "t")
    assert sorted(map(tuple, job.ledger.ranges(spark, "t").drop("updated_at").collect())) == before
    assert job.ledger.ranges(spark, "other").count() == 1
    assert job.ledger.entries(spark).count() == 7


def test_an_empty_table(spark, lines):
    job = job_of(spark)
    done = job.run(lines.limit(0))
    assert (done.n_ranges, done.n_loaded, done.n_open, done.rows_read) == (1, 1, 0, 0)
    assert job.reopen_changed(lines.limit(9)) == [0]
