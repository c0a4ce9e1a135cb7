"""Loads into targets, increments, streams, and whole migrations."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tableferry.functions.text import quoted
from tableferry.functions.types import ColumnSpec, describe
from tableferry.operators import generations, load
from tableferry.operators.gate import TableRules, gate
from tableferry.operators.report import write_report
from tableferry.operators.shape import conform_table
from tableferry.plans import migration
from tableferry.plans.quarantine import load_with_quarantine
from tableferry.plans.resume import RangeLedger, ResumableLoad
from tableferry.queries.inputs import (
    FAULTY_ORDERS,
    LINE_COLUMNS,
    ORDER_COLUMNS,
    faulty_orders,
    store,
    table,
)
from tableferry.queries.shaping import EVENT_SPECS
from tableferry.session import discard, new_folder, written
from tableferry.sources.csv_files import CsvForm, parse_export, read_export, write_export
from tableferry.sources.files import FileStore
from tableferry.streaming.buckets import BucketStore, bucket_load
from tableferry.streaming.incremental import incremental_load
from tableferry.streaming.marks import MarkStore, latest_marks
from tableferry.streaming.stream import stream_upsert
from tableferry.streaming.tombstones import TombstoneStore

KEY = ["o_orderkey"]
CUT = "2024-01-20 00:00:00"


def _fresh(name: str) -> str:
    return f"ferry_{name}_{uuid.uuid4().hex}"


def _staged_orders(orders: DataFrame) -> DataFrame:
    """Some orders at a higher price, some of them staged twice, and some new ones."""
    key, price = F.col("o_orderkey"), F.col("o_totalprice")
    dearer = orders.where(key % 50 == 0).withColumn("o_totalprice", price + 100)
    again = orders.where(key % 100 == 0).withColumn("o_totalprice", price + 200)
    added = orders.where(key % 50 == 1).withColumn("o_orderkey", key + 10000000)
    return dearer.unionByName(again).unionByName(added)


def dedupe_stage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load.dedupe_stage(table(spark, sf_dir, "events"), ["user_id"], ["ts"])


def upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    return load.upsert(orders, _staged_orders(orders), KEY, ["o_totalprice"])


def _price_versions(orders: DataFrame) -> list[DataFrame]:
    """Two deliveries of order prices with rising versions: the second one, which brings the older
    versions of most keys, comes late. Some versions are NULL."""
    key, price = F.col("o_orderkey"), F.col("o_totalprice")
    newer = orders.where(key % 5 < 2).withColumns({"o_totalprice": price + 20, "version": F.lit(20) + key % 2})
    older = orders.where(key % 5 < 3).withColumns(
        {"o_totalprice": price + 10, "version": F.when(key % 7 == 0, None).otherwise(F.lit(5) + key % 11)}
    )
    return [newer, older]


def guarded_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders at version 10, then a delivery at version 20 and a late one at versions 5 to 15."""
    orders = table(spark, sf_dir, "orders")
    held = orders.withColumn("version", F.lit(10).cast("bigint"))
    for stage in _price_versions(orders):
        stage = stage.withColumn("version", F.col("version").cast("bigint"))
        held = load.guarded_upsert(held, stage, KEY, ["version"])
    return held.select("o_orderkey", "o_totalprice", "version")


def _event_versions(events: DataFrame) -> list[DataFrame]:
    """Deliveries of events in the wrong order: corrections at version 3 that move events to
    another day, deletions at version 4, late corrections at version 2 of both, and late rows at
    version 5 that bring some deleted events back."""
    number = F.col("event_id") % 10
    daily = events.withColumn("event_day", F.to_date("ts"))

    def sent(rows: DataFrame, version: int, gone: bool = False) -> DataFrame:
        return rows.withColumns({"version": F.lit(version), "value": F.col("value") + version, "gone": F.lit(gone)})

    moved = daily.where(number < 3).withColumn("event_day", F.date_add("event_day", 1))
    deletions = sent(daily.where((number > 1) & (number < 5)), 4, True).withColumn(
        "event_day", F.lit(None).cast("date")
    )
    late = sent(daily.where(number < 6), 2)
    again = sent(daily.where(number == 4), 5)
    return [sent(moved, 3), deletions, late, again]


def out_of_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table after deliveries that come in the wrong order, with deletions."""
    events = table(spark, sf_dir, "events").select("event_id", "ts", "value")
    name = _fresh("events")
    first = events.withColumns({"event_day": F.to_date("ts"), "version": F.lit(1)})
    load.create_partitioned(first, name, ["event_day"])
    stones = TombstoneStore(new_folder(spark, "tombstones"), ["event_id"], ["version"])
    for stage in _event_versions(events):
        load.upsert_partitions(
            spark, name, stage, ["event_id"], ["event_day"], ["version"],
            guarded=True, deleted="gone", tombstones=stones,
        )
    return spark.table(name)


def stream_out_of_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same deliveries as files of a stream, each taken up by a run of its own; the deletions
    are noted before the second half of the files arrives."""
    events = table(spark, sf_dir, "events").select("event_id", "ts", "value")
    name = _fresh("events")
    first = events.withColumns({"event_day": F.to_date("ts"), "version": F.lit(1)})
    load.create_partitioned(first, name, ["event_day"])
    arrivals, checkpoint = new_folder(spark, "arrivals"), new_folder(spark, "stream")
    stones = TombstoneStore(new_folder(spark, "tombstones"), ["event_id"], ["version"])
    deliveries = _event_versions(events)
    for some in (deliveries[:2], deliveries[2:]):
        for delivery in some:
            delivery.write.mode("append").parquet(arrivals)
        stream = spark.readStream.schema(deliveries[0].schema).parquet(arrivals)
        stream_upsert(
            stream, name, ["event_id"], ["event_day"], checkpoint, ["version"],
            guarded=True, deleted="gone", tombstones=stones,
        ).awaitTermination()
    return spark.table(name)


def _staged_lines(lines: DataFrame) -> DataFrame:
    """Whole orders sent anew: every line at double quantity, their last lines left out."""
    return lines.where("l_orderkey % 20 = 0 AND l_linenumber < 4").withColumn(
        "l_quantity", F.col("l_quantity") * 2
    )


def delete_insert(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem")
    return load.delete_insert(lines, _staged_lines(lines), ["l_orderkey"])


def deleted_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem")
    return load.deleted_rows(lines, _staged_lines(lines), ["l_orderkey"])


def append_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Appended to a written target after the key check, and read back."""
    orders = table(spark, sf_dir, "orders")
    target = FileStore(new_folder(spark, "target"))
    target.append(orders, "orders")
    stage = orders.where("o_orderkey % 50 = 1").withColumn(
        "o_orderkey", F.col("o_orderkey") + 10000000
    )
    load.append_checked(
        target.read(spark, "orders"), stage, KEY, lambda rows: target.append(rows, "orders")
    )
    return target.read(spark, "orders")


def append_conflicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    return load.append_conflicts(orders, _staged_orders(orders), KEY)


def reload(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The reloaded rows, and how many the table held before."""
    orders = table(spark, sf_dir, "orders")
    target = FileStore(new_folder(spark, "target"))
    target.reload(faulty_orders(orders), "orders")
    before = target.count(spark, "orders").first()[0]
    target.reload(orders, "orders")
    return target.read(spark, "orders").withColumn("n_before", F.lit(before).cast("long"))


def staged_reload(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The live table after the swap and the table it replaced, under its backup name."""
    orders = table(spark, sf_dir, "orders")
    name = _fresh("orders")
    load.staged_reload(faulty_orders(orders), name, KEY)
    backup = load.staged_reload(orders, name, KEY, [load.same_rows_as(orders, KEY)])
    held = {"live": spark.table(name), "backup": spark.table(backup)}
    live, old = (df.withColumn("held_by", F.lit(label)) for label, df in held.items())
    return live.unionByName(old)


def swapped_generations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table published twice and taken back once: what a reader that was opened before the second
    publication reads after it, what the table held then, and what it holds in the end."""
    orders = table(spark, sf_dir, "orders")
    name = _fresh("orders")
    generations.publish(faulty_orders(orders), name, KEY)
    reader = spark.table(name)
    generations.publish(orders, name, KEY, [load.same_rows_as(orders, KEY)], [load.same_rows_as(orders, KEY)])
    generations.clean_generations(spark, name)
    held = {"open reader": reader, "live": spark.table(name).where("o_orderkey % 2 = 0")}
    generations.roll_back(spark, name)
    held["taken back"] = spark.table(name).where("o_orderkey % 2 = 1")
    one, other, last = (df.withColumn("held_by", F.lit(label)) for label, df in held.items())
    return one.unionByName(other).unionByName(last)


def quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders against a tight schema: the rows that fit, those set aside by reason, and a second
    load that is refused for its error rate."""
    specs = [
        ColumnSpec("o_orderkey", "bigint", nullable=False),
        ColumnSpec("o_orderpriority", "character varying", length=8),
        ColumnSpec("o_totalprice", "numeric", precision=7, scale=2),
    ]
    price = F.col("o_totalprice")
    orders = describe(
        table(spark, sf_dir, "orders").where("o_orderkey % 10 = 0")
        .withColumn("o_totalprice", F.round(price % 120000, 2)),
        specs,
    )
    target, aside = FileStore(new_folder(spark, "target")), FileStore(new_folder(spark, "aside"))
    more = {"blocked customer": F.col("o_custkey") % 50 == 0}
    found = load_with_quarantine(orders, "orders", target, aside, 100.0, keys=KEY, more=more)
    refused = False
    try:
        load_with_quarantine(orders, "orders", FileStore(new_folder(spark, "target")), aside, 0.5, keys=KEY)
    except load.LoadRefused:
        refused = True
    loaded = target.read(spark, "orders").select(
        "o_orderkey", F.col("o_totalprice").cast("double").alias("o_totalprice"), F.lit("").alias("reasons")
    )
    load_with_quarantine(orders, "orders", FileStore(new_folder(spark, "target")), aside, 100.0, keys=KEY, more=more)
    bad = aside.read(spark, "orders").select("o_orderkey", "o_totalprice", F.array_join("reasons", "; ").alias("reasons"))
    counts = {
        "n_rows": F.lit(found.n_rows).cast("long"),
        "n_loaded": F.lit(found.n_loaded).cast("long"),
        "n_bad": F.lit(found.n_bad).cast("long"),
        "refused": F.lit(refused),
    }
    return loaded.unionByName(bad).withColumns(counts)


def _daily_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").withColumn("event_day", F.to_date("ts"))


def upsert_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Half of one day's events get a new value; some move to another day."""
    events = _daily_events(spark, sf_dir)
    name = _fresh("events")
    load.create_partitioned(events, name, ["event_day"])
    late = events.where("event_day = DATE'2024-01-05'").withColumn("value", F.col("value") + 1)
    moved = late.where("event_id % 2 = 0").select(
        "event_id",
        (F.col("ts") + F.expr("interval 60 days")).alias("ts"),
        "user_id", "event_type", "value", "props",
    ).withColumn("event_day", F.to_date("ts"))
    stage = late.where("event_id % 2 = 1").unionByName(moved)
    rewritten = load.upsert_partitions(spark, name, stage, ["event_id"], ["event_day"])
    return spark.table(name).withColumn("n_rewritten", F.lit(rewritten).cast("long"))


def incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three loads by mark: up to the cut, the rest, and one that finds only the last moment. The
    result shows the rows staged by each and the mark at the end."""
    events = _daily_events(spark, sf_dir)
    name = _fresh("events")
    load.create_partitioned(events.limit(0), name, ["event_day"])
    marks = MarkStore(new_folder(spark, "marks"))

    def commit(stage: DataFrame) -> None:
        load.upsert_partitions(
            spark, name, stage, ["event_id"], ["event_day"], key_fixes_partition=True, prepared=True
        )

    before = events.where(F.col("ts") < F.lit(CUT).cast("timestamp_ntz"))
    staged = [
        incremental_load(source, name, "ts", marks, commit, ["event_id"])
        for source in (before, events, events)
    ]
    mark = F.lit(marks.last_time(spark, name).isoformat(sep=" ")).cast("timestamp_ntz")
    counts = {f"n_staged_{i}": F.lit(n).cast("long") for i, n in enumerate(staged, 1)}
    return spark.table(name).withColumns({**counts, "mark": mark})


def streamed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two runs over arriving files; the second brings new events and corrections of old ones."""
    events = _daily_events(spark, sf_dir)
    name = _fresh("events")
    load.create_partitioned(events.limit(0), name, ["event_day"])
    arrivals, checkpoint = new_folder(spark, "arrivals"), new_folder(spark, "stream")
    early = F.col("ts") < F.lit(CUT).cast("timestamp_ntz")
    corrected = events.where(early & (F.col("event_id") % 10 == 0)).withColumn(
        "value", F.col("value") + 1
    )
    for delivery in (events.where(early), events.where(~early).unionByName(corrected)):
        delivery.write.mode("append").parquet(arrivals)
        stream = spark.readStream.schema(events.schema).parquet(arrivals)
        stream_upsert(stream, name, ["event_id"], ["event_day"], checkpoint).awaitTermination()
    return spark.table(name)


def late_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two loads by fingerprints of days. Between them the source gets rows below its newest moment,
    one day's values change, some rows and a whole day go. The result shows what each load took."""
    events = _daily_events(spark, sf_dir)
    number, day = F.col("event_id") % 100, F.col("event_day")
    first = events.where((number != 0) | (day != F.lit("2024-01-03").cast("date")))
    gone = (day == F.lit("2024-01-09").cast("date")) | (
        (day == F.lit("2024-01-11").cast("date")) & (number < 3)
    )
    second = events.where(~gone).withColumn(
        "value", F.when(day == F.lit("2024-01-06").cast("date"), F.col("value") * 2).otherwise(F.col("value"))
    )
    name = _fresh("events")
    load.create_partitioned(events.limit(0), name, ["event_day"])
    store_of = BucketStore(new_folder(spark, "buckets"), ["event_day"])

    def commit(stage: DataFrame, places: DataFrame) -> None:
        load.replace_partitions(spark, name, stage, ["event_day"], places)

    taken = [bucket_load(source, store_of, commit) for source in (first, second, second)]
    counts = {
        f"{what}_{i}": F.lit(found[what]).cast("long")
        for i, found in enumerate(taken, 1) for what in ("new", "changed", "gone", "rows")
    }
    return spark.table(name).withColumns(counts)


def resumed_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines loaded by key ranges: a first call that ends after two of four groups, one that does
    the rest and reads nothing twice, and one that has nothing to do. Then the source changes in
    three places, and a last call reads only the ranges concerned."""
    lines = table(spark, sf_dir, "lineitem")
    job = ResumableLoad(
        FileStore(new_folder(spark, "target")), "lineitem", ["l_orderkey", "l_linenumber"],
        RangeLedger(new_folder(spark, "ledger")), parts=8, ranges_per_job=2,
    )
    calls = [job.run(lines, most_groups=2), job.run(lines), job.run(lines)]
    low, high = lines.agg(F.min("l_orderkey"), F.max("l_orderkey")).first()
    changed = lines.where(F.col("l_orderkey") != low).withColumn(
        "l_quantity", F.when(F.col("l_orderkey") == high, F.col("l_quantity") + 1).otherwise(F.col("l_quantity"))
    )
    reopened = job.reopen_changed(changed)
    calls.append(job.run(changed))
    facts = {
        "ranges_loaded": F.array(*[F.lit(call.n_loaded) for call in calls]).cast("string"),
        "ranges_open": F.array(*[F.lit(call.n_open) for call in calls]).cast("string"),
        "rows_read_before": F.lit(sum(call.rows_read for call in calls[:3])).cast("long"),
        "reread_share_below_half": F.lit(0 < calls[3].rows_read < calls[1].rows_read),
        "reopened": F.lit(len(reopened)).cast("long"),
    }
    return job.read(spark).withColumns(facts)


def marks_of_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as a log of marks, one table per event type."""
    log = table(spark, sf_dir, "events").select(
        F.col("event_type").alias("table_name"),
        F.col("ts").alias("last_sync_time"),
        F.col("event_id").alias("last_sync_count"),
        F.lit("success").alias("status"),
        F.col("ts").alias("updated_at"),
    )
    return latest_marks(log)


MIGRATED = ["customer", "orders", "events", "embeddings", "documents", "lineitem"]


def full_migration(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Six tables copied and validated: outcome and whether the checksums agree."""
    target = FileStore(new_folder(spark, "target"))
    specs = {"events": EVENT_SPECS}
    source = store(sf_dir)
    facts: dict = {}
    migration.migrate(spark, source, target, MIGRATED, specs=specs, facts=facts)
    reports = migration.validate(spark, source, target, MIGRATED, specs=specs, facts=facts)
    load_rows = reports["load"].drop("message")
    return load_rows.join(reports["checksums"].select("table_name", "matched"), "table_name")


def written_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The report of a migration of which one table did not arrive whole, as read back from the file
    it was written to."""
    target, source = FileStore(new_folder(spark, "target")), store(sf_dir)
    tables = ["customer", "orders", "nation"]
    migration.migrate(spark, source, target, tables)
    target.reload(faulty_orders(table(spark, sf_dir, "orders")).where("o_orderkey < 10000000"), "orders")
    report = migration.validate(spark, source, target, tables)["load"].drop("message")
    folder = new_folder(spark, "report")
    write_report(report, folder)
    return spark.read.schema(report.schema).json(folder)


def growing_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A source that gets rows between load and validation: compared with what was loaded, and with
    the source as it is by then. One of the targets loses a row as well."""
    source, target = FileStore(new_folder(spark, "source")), FileStore(new_folder(spark, "target"))
    tables = ["orders", "customer"]
    for name in tables:
        source.append(table(spark, sf_dir, name), name)
    facts: dict = {}
    migration.migrate(spark, source, target, tables, facts=facts)
    source.append(table(spark, sf_dir, "orders").where("o_orderkey % 10 = 0"), "orders")
    lost = table(spark, sf_dir, "customer").where("c_custkey <> 7")
    target.reload(lost, "customer")
    told = {"loaded": facts, "read again": None}
    reports = [
        migration.validate(spark, source, target, tables, facts=taken) for taken in told.values()
    ]
    rows = [
        report["load"].drop("message").join(report["checksums"].select("table_name", "matched"), "table_name")
        .withColumn("compared_with", F.lit(label))
        for label, report in zip(told, reports)
    ]
    return rows[0].unionByName(rows[1])


def failed_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Outcome of loads that went wrong: a table that is not at the source, one whose target lost
    a column, one whose target file is gone, and one that is sound."""
    target, source = FileStore(new_folder(spark, "target")), store(sf_dir)
    tables = ["customer", "orders", "supplier", "absent"]
    settings = migration.Settings(continue_on_error=True)
    errors = migration.migrate(spark, source, target, tables, settings)
    target.reload(table(spark, sf_dir, "orders").drop("o_orderpriority"), "orders")
    discard(spark, target.path("supplier"))
    reports = migration.validate(spark, source, target, tables, settings, errors=errors)
    noted = F.col("message").isNotNull().alias("has_message")
    return reports["load"].select("table_name", "status", "migrated", "failed", "total", noted)


def load_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The gate over a sound table and four that fail at one step each."""
    source = {n: table(spark, sf_dir, n) for n in ("customer", "orders", "supplier", "nation", "part")}
    source["sample_orders"] = source["orders"]
    first = F.col("o_orderkey") == F.lit(source["orders"].agg(F.min("o_orderkey")).first()[0])
    target = dict(
        source,
        orders=faulty_orders(source["orders"]).where("o_orderkey < 10000000"),
        sample_orders=source["orders"].withColumn(
            "o_totalprice", F.when(first, F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice"))
        ),
        nation=source["nation"].where("n_nationkey % 2 = 0"),
        supplier=source["supplier"],
    )
    source["nation"] = target["nation"]
    rules = {
        "customer": TableRules(["c_custkey"], foreign=[(["c_nationkey"], "nation", ["n_nationkey"])]),
        "orders": TableRules(KEY),
        "sample_orders": TableRules(KEY),
        "supplier": TableRules(["s_suppkey"]),
        "part": TableRules(["p_partkey"], unique=[["p_size"]]),
        "nation": TableRules(["n_nationkey"]),
    }
    return gate(spark, source, target, rules).drop("message")


def text_migration_marker(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents of which some hold a literal marker text, moved under another marker."""
    documents = table(spark, sf_dir, "documents").withColumn(
        "source", F.when(F.col("doc_id") % 7 == 0, "\\N").when(F.col("doc_id") % 11 == 0, None).otherwise(F.col("source"))
    )
    source, target = FileStore(new_folder(spark, "source")), FileStore(new_folder(spark, "target"))
    source.reload(documents, "documents")
    settings = migration.Settings(csv=CsvForm(delimiter="\t", null_marker="<none>"))
    folder = new_folder(spark, "export")
    schemas = migration.export_tables(spark, source, folder, ["documents"], settings)
    audit = migration.audit_export(spark, f"{folder}/documents", schemas["documents"], settings)
    if audit.first()["bad_rows"]:
        raise load.LoadRefused("the export holds bad rows")
    migration.import_tables(spark, folder, schemas, target, settings)
    return target.read(spark, "documents").select("doc_id", "text", "lang", "source", "n_chars")


# Bytes of a split of ``csv_split_read``.
SPLIT = 64 << 10


def csv_split_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents, whose texts hold line breaks, in files whose lines end with a sign of their own:
    each read back in splits of 64 KB, by several tasks. Every task that reads documents writes
    files of its own, so none moves the whole table; in_one_task tells whether all rows, or all
    of a file whose last row begins after its first split, came from one task."""
    documents = table(spark, sf_dir, "documents")
    folder, form = new_folder(spark, "export"), CsvForm(line_end="\x1e")
    write_export(documents, folder, **vars(form))
    back = split_read(spark, folder, documents.schema, form)
    parts = back.groupBy("file", "file_size", "task").agg(F.max("row_size").alias("longest"))
    files = parts.groupBy("file", "file_size").agg(F.count("*").alias("tasks"), F.max("longest").alias("longest"))
    whole = files.where((F.col("tasks") == 1) & (F.col("file_size") > SPLIT + F.col("longest")))
    most = back.groupBy("task").count().agg(F.max("count")).first()[0]
    alone = most == back.count() or not whole.isEmpty()
    return back.drop("task", "file", "file_size", "row_size").withColumn("in_one_task", F.lit(alone))


def split_read(spark: SparkSession, folder: str, schema: T.StructType, form: CsvForm) -> DataFrame:
    """The rows of an export, read in splits of ``SPLIT`` bytes, with the number of the task, the
    file, its size and the most bytes that the row may have there."""
    knob = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(knob)
    spark.conf.set(knob, str(SPLIT))
    try:
        texts = read_export(spark, folder, schema.names, **vars(form), keep_bad_rows=False)
        row_size = F.lit(4 * len(schema.names))  # quotes and separators; every sign may be escaped
        for name in schema.names:
            row_size = row_size + F.coalesce(2 * F.octet_length(quoted(name)), F.lit(0))
        place = {"file": F.col("_metadata.file_path"), "file_size": F.col("_metadata.file_size"), "row_size": row_size}
        texts = texts.select("*", *[value.cast("string").alias(name) for name, value in place.items()])
        places = [T.StructField("file", T.StringType())] + [T.StructField(name, T.LongType()) for name in ("file_size", "row_size")]
        parsed = parse_export(texts, T.StructType([*schema.fields, *places]))
        return written(parsed.withColumn("task", F.spark_partition_id()), "split-read")
    finally:
        spark.conf.set(knob, before)


def text_migration(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents through CSV, their language as bytes; audited on the way, then read back."""
    documents = table(spark, sf_dir, "documents").withColumn(
        "lang", F.col("lang").cast("binary")
    )
    source = FileStore(new_folder(spark, "source"))
    source.reload(conform_table(describe(documents, [])), "documents")
    folder = new_folder(spark, "export")
    schemas = migration.export_tables(spark, source, folder, ["documents"])
    audit = migration.audit_export(spark, f"{folder}/documents", schemas["documents"])
    if audit.first()["bad_rows"]:
        raise load.LoadRefused("the export holds bad rows")
    target = FileStore(new_folder(spark, "target"))
    migration.import_tables(spark, folder, schemas, target)
    back = target.read(spark, "documents")
    return back.withColumn("lang", F.col("lang").cast(T.StringType()))


QUERIES = {
    "dedupe_stage": dedupe_stage,
    "upsert": upsert,
    "guarded_upsert": guarded_upsert,
    "out_of_order": out_of_order,
    "stream_out_of_order": stream_out_of_order,
    "delete_insert": delete_insert,
    "deleted_rows": deleted_rows,
    "append_load": append_load,
    "append_conflicts": append_conflicts,
    "reload": reload,
    "staged_reload": staged_reload,
    "swapped_generations": swapped_generations,
    "quarantine": quarantine,
    "upsert_partitions": upsert_partitions,
    "incremental_load": incremental,
    "stream_upsert": streamed,
    "late_rows": late_rows,
    "resumed_load": resumed_load,
    "latest_marks": marks_of_events,
    "full_migration": full_migration,
    "growing_source": growing_source,
    "written_report": written_report,
    "failed_load": failed_load,
    "load_gate": load_gate,
    "csv_split_read": csv_split_read,
    "text_migration": text_migration,
    "text_migration_marker": text_migration_marker,
}

_ORDERS = ", ".join(ORDER_COLUMNS)
_STAGED = """
WITH stage AS (
  SELECT * REPLACE (o_totalprice + CASE WHEN o_orderkey % 100 = 0 THEN 200 ELSE 100 END
                    AS o_totalprice)
  FROM orders WHERE o_orderkey % 50 = 0
  UNION ALL
  SELECT * REPLACE (o_orderkey + 10000000 AS o_orderkey) FROM orders WHERE o_orderkey % 50 = 1)
"""
_LINES = ", ".join(LINE_COLUMNS)
_SENT = "SELECT l_orderkey FROM lineitem WHERE l_orderkey % 20 = 0 AND l_linenumber < 4"

_VERSIONS = """
WITH sent AS (
  SELECT o_orderkey, o_totalprice, 10 AS version FROM orders
  UNION ALL SELECT o_orderkey, o_totalprice + 20, 20 + o_orderkey % 2 FROM orders WHERE o_orderkey % 5 < 2
  UNION ALL SELECT o_orderkey, o_totalprice + 10,
                   CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE 5 + o_orderkey % 11 END
            FROM orders WHERE o_orderkey % 5 < 3)
SELECT o_orderkey, o_totalprice, version::BIGINT AS version FROM (
  SELECT *, row_number() OVER (
    PARTITION BY o_orderkey ORDER BY version DESC NULLS LAST, o_totalprice DESC) AS nth FROM sent)
WHERE nth = 1
"""
_EVENT_VERSIONS = """
WITH sent AS (
  SELECT event_id, ts, value, ts::DATE AS event_day, 1 AS version, FALSE AS gone FROM events
  UNION ALL SELECT event_id, ts, value + 3, ts::DATE + 1, 3, FALSE FROM events WHERE event_id % 10 < 3
  UNION ALL SELECT event_id, ts, value + 4, NULL, 4, TRUE FROM events WHERE event_id % 10 IN (2, 3, 4)
  UNION ALL SELECT event_id, ts, value + 2, ts::DATE, 2, FALSE FROM events WHERE event_id % 10 < 6
  UNION ALL SELECT event_id, ts, value + 5, ts::DATE, 5, FALSE FROM events WHERE event_id % 10 = 4)
SELECT event_id, ts, value, event_day::DATE AS event_day, version FROM (
  SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY version DESC) AS nth FROM sent)
WHERE nth = 1 AND NOT gone
"""

SQL = {
    "guarded_upsert": _VERSIONS,
    "out_of_order": _EVENT_VERSIONS,
    "stream_out_of_order": _EVENT_VERSIONS,
    "dedupe_stage": """
        SELECT event_id, ts, user_id, event_type, value, props FROM (
          SELECT *, row_number() OVER (
            PARTITION BY user_id
            ORDER BY ts DESC, event_id DESC, event_type DESC, value DESC, props DESC) AS nth
          FROM events) WHERE nth = 1""",
    "upsert": _STAGED + f"""
        SELECT {_ORDERS} FROM orders WHERE o_orderkey NOT IN (SELECT o_orderkey FROM stage)
        UNION ALL SELECT {_ORDERS} FROM stage""",
    "delete_insert": f"""
        SELECT {_LINES} FROM lineitem WHERE l_orderkey NOT IN ({_SENT})
        UNION ALL
        SELECT * REPLACE (l_quantity * 2 AS l_quantity) FROM lineitem
        WHERE l_orderkey % 20 = 0 AND l_linenumber < 4""",
    "deleted_rows": f"SELECT {_LINES} FROM lineitem WHERE l_orderkey IN ({_SENT})",
    "append_load": f"""
        SELECT {_ORDERS} FROM orders
        UNION ALL
        SELECT * REPLACE (o_orderkey + 10000000 AS o_orderkey) FROM orders
        WHERE o_orderkey % 50 = 1""",
    "append_conflicts": """
        SELECT o_orderkey, CASE WHEN o_orderkey % 100 = 0 THEN 3 ELSE 2 END::BIGINT AS n_rows
        FROM orders WHERE o_orderkey % 50 = 0""",
    "reload": f"""
        WITH {FAULTY_ORDERS}
        SELECT {_ORDERS}, (SELECT count(*) FROM faulty_orders) AS n_before FROM orders""",
    "staged_reload": f"""
        WITH {FAULTY_ORDERS}
        SELECT {_ORDERS}, 'live' AS held_by FROM orders
        UNION ALL SELECT {_ORDERS}, 'backup' FROM faulty_orders""",
    "swapped_generations": f"""
        WITH {FAULTY_ORDERS}
        SELECT {_ORDERS}, 'open reader' AS held_by FROM faulty_orders
        UNION ALL SELECT {_ORDERS}, 'live' FROM orders WHERE o_orderkey % 2 = 0
        UNION ALL SELECT {_ORDERS}, 'taken back' FROM faulty_orders WHERE o_orderkey % 2 = 1""",
    "quarantine": """
        WITH rows AS (
          SELECT * REPLACE (round(o_totalprice % 120000, 2) AS o_totalprice)
          FROM orders WHERE o_orderkey % 10 = 0),
        tested AS (
          SELECT o_orderkey, o_totalprice, concat_ws('; ',
                   CASE WHEN o_totalprice >= 99999.995 THEN 'o_totalprice: decimal_misfit' END,
                   CASE WHEN length(o_orderpriority) > 8 THEN 'o_orderpriority: too_long' END,
                   CASE WHEN o_custkey % 50 = 0 THEN 'blocked customer' END) AS reasons
          FROM rows)
        SELECT o_orderkey, o_totalprice, reasons,
               (SELECT count(*) FROM tested) AS n_rows,
               (SELECT count(*) FROM tested WHERE reasons = '') AS n_loaded,
               (SELECT count(*) FROM tested WHERE reasons <> '') AS n_bad,
               (SELECT count(*) FROM tested WHERE reasons LIKE '%:%') * 200 > (SELECT count(*) FROM tested) AS refused
        FROM tested""",
    "upsert_partitions": """
        WITH changed AS (
          SELECT event_id,
                 CASE WHEN ts::DATE = DATE '2024-01-05' AND event_id % 2 = 0
                      THEN ts + INTERVAL 60 DAY ELSE ts END AS ts,
                 user_id, event_type,
                 CASE WHEN ts::DATE = DATE '2024-01-05' THEN value + 1 ELSE value END AS value,
                 props
          FROM events)
        SELECT *, ts::DATE AS event_day,
               1 + (SELECT count(DISTINCT ts::DATE) FROM changed WHERE event_id IN (
                  SELECT event_id FROM events
                  WHERE ts::DATE = DATE '2024-01-05' AND event_id % 2 = 0)) AS n_rewritten
        FROM changed""",
    "incremental_load": f"""
        SELECT *, ts::DATE AS event_day,
               (SELECT count(*) FROM events WHERE ts < TIMESTAMP '{CUT}') AS n_staged_1,
               (SELECT count(*) FROM events WHERE ts >= (
                  SELECT max(ts) FROM events WHERE ts < TIMESTAMP '{CUT}')) AS n_staged_2,
               (SELECT count(*) FROM events WHERE ts = (SELECT max(ts) FROM events)) AS n_staged_3,
               (SELECT max(ts) FROM events) AS mark
        FROM events""",
    "stream_upsert": f"""
        SELECT * REPLACE (CASE WHEN ts < TIMESTAMP '{CUT}' AND event_id % 10 = 0
                               THEN value + 1 ELSE value END AS value),
               ts::DATE AS event_day
        FROM events""",
    "late_rows": """
        WITH e AS (SELECT *, ts::DATE AS event_day FROM events),
        first AS (SELECT * FROM e WHERE event_id % 100 <> 0 OR event_day <> DATE '2024-01-03'),
        second AS (
          SELECT * REPLACE (CASE WHEN event_day = DATE '2024-01-06' THEN value * 2 ELSE value END AS value)
          FROM e WHERE NOT (event_day = DATE '2024-01-09'
                            OR event_day = DATE '2024-01-11' AND event_id % 100 < 3)),
        a AS (SELECT event_day, count(*) AS n, sum(hash(e1)::HUGEINT) AS h FROM first AS e1 GROUP BY 1),
        b AS (SELECT event_day, count(*) AS n, sum(hash(e2)::HUGEINT) AS h FROM second AS e2 GROUP BY 1),
        c AS (SELECT a.n AS na, b.n AS nb, a.n IS DISTINCT FROM b.n OR a.h IS DISTINCT FROM b.h AS differs
              FROM a FULL JOIN b USING (event_day))
        SELECT *, (SELECT count(*) FROM a) AS new_1, 0::BIGINT AS changed_1, 0::BIGINT AS gone_1,
               (SELECT count(*) FROM first) AS rows_1,
               (SELECT count(*) FROM c WHERE na IS NULL) AS new_2,
               (SELECT count(*) FROM c WHERE na IS NOT NULL AND nb IS NOT NULL AND differs) AS changed_2,
               (SELECT count(*) FROM c WHERE nb IS NULL) AS gone_2,
               (SELECT sum(nb) FROM c WHERE differs)::BIGINT AS rows_2,
               0::BIGINT AS new_3, 0::BIGINT AS changed_3, 0::BIGINT AS gone_3, 0::BIGINT AS rows_3
        FROM second""",
    "resumed_load": f"""
        SELECT {_LINES}, '[4, 4, 0, 2]' AS ranges_loaded, '[4, 0, 0, 0]' AS ranges_open,
               (SELECT count(*) FROM lineitem) AS rows_read_before,
               TRUE AS reread_share_below_half, 2::BIGINT AS reopened
        FROM (SELECT * REPLACE (CASE WHEN l_orderkey = (SELECT max(l_orderkey) FROM lineitem)
                                     THEN l_quantity + 1 ELSE l_quantity END AS l_quantity)
              FROM lineitem WHERE l_orderkey <> (SELECT min(l_orderkey) FROM lineitem))""",
    "latest_marks": """
        SELECT event_type AS table_name, max(ts) AS last_sync_time,
               arg_max(event_id, ts) AS last_sync_count, 'success' AS status,
               max(ts) AS updated_at
        FROM events GROUP BY event_type""",
    "full_migration": " UNION ALL ".join(
        f"SELECT '{name}' AS table_name, 'success' AS status, count(*) AS migrated, "
        f"0::BIGINT AS failed, count(*) AS total, TRUE AS matched FROM {name}"
        for name in MIGRATED
    ),
    "written_report": f"""
        WITH {FAULTY_ORDERS},
        n AS (
          SELECT 'customer' AS table_name, count(*) AS held, count(*) AS total FROM customer
          UNION ALL SELECT 'nation', count(*), count(*) FROM nation
          UNION ALL SELECT 'orders', (SELECT count(*) FROM faulty_orders WHERE o_orderkey < 10000000),
                           count(*) FROM orders)
        SELECT table_name, CASE WHEN held = total THEN 'success' ELSE 'partial' END AS status,
               held AS migrated, total - held AS failed, total FROM n""",
    "growing_source": """
        WITH n AS (
          SELECT 'orders' AS table_name, count(*) AS loaded,
                 count(*) + count(*) FILTER (o_orderkey % 10 = 0) AS held, count(*) AS target
          FROM orders
          UNION ALL
          SELECT 'customer', count(*), count(*), count(*) FILTER (c_custkey <> 7) FROM customer)
        SELECT table_name, CASE WHEN target = loaded THEN 'success' ELSE 'partial' END AS status,
               target AS migrated, loaded - target AS failed, loaded AS total,
               target = loaded AS matched, 'loaded' AS compared_with FROM n
        UNION ALL
        SELECT table_name, CASE WHEN target = held THEN 'success' ELSE 'partial' END,
               target, held - target, held, target = held, 'read again' FROM n""",
    "failed_load": """
        SELECT 'customer' AS table_name, 'success' AS status, count(*) AS migrated,
               0::BIGINT AS failed, count(*) AS total, FALSE AS has_message FROM customer
        UNION ALL SELECT 'orders', 'failed', count(*), 0, count(*), TRUE FROM orders
        UNION ALL SELECT 'supplier', 'failed', 0, count(*), count(*), TRUE FROM supplier
        UNION ALL SELECT 'absent', 'failed', 0, 0, 0, TRUE""",
    "load_gate": f"""
        WITH {FAULTY_ORDERS},
        kept AS (SELECT * FROM faulty_orders WHERE o_orderkey < 10000000),
        dearer AS (
          SELECT * REPLACE (CASE WHEN o_orderkey = (SELECT min(o_orderkey) FROM orders)
                                 THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice)
          FROM orders),
        half AS (SELECT * FROM nation WHERE n_nationkey % 2 = 0),
        tested AS (
          SELECT 'customer' AS table_name, TRUE AS counts, TRUE AS sample,
                 (SELECT count(*) = count(DISTINCT c_custkey) FROM customer) AS keys,
                 NOT EXISTS (SELECT * FROM customer
                             WHERE c_nationkey NOT IN (SELECT n_nationkey FROM half)) AS foreign_keys
          UNION ALL
          SELECT 'orders', (SELECT count(*) FROM orders) = (SELECT count(*) FROM kept), TRUE, TRUE, TRUE
          UNION ALL
          SELECT 'sample_orders', (SELECT count(*) FROM orders) = (SELECT count(*) FROM dearer),
                 NOT EXISTS (SELECT * FROM (SELECT * FROM orders ORDER BY o_orderkey LIMIT 1000) o
                             JOIN dearer d USING (o_orderkey) WHERE o.o_totalprice <> d.o_totalprice),
                 TRUE, TRUE
          UNION ALL
          SELECT 'supplier', TRUE, TRUE, (SELECT count(*) = count(DISTINCT s_suppkey) FROM supplier), TRUE
          UNION ALL
          SELECT 'part', TRUE, TRUE, (SELECT count(*) = count(DISTINCT p_partkey)
                                             AND count(*) = count(DISTINCT p_size) FROM part), TRUE
          UNION ALL
          SELECT 'nation', TRUE, TRUE, (SELECT count(*) = count(DISTINCT n_nationkey) FROM half), TRUE)
        SELECT table_name, counts, CASE WHEN counts THEN sample END AS sample,
               CASE WHEN counts AND sample THEN keys END AS keys,
               CASE WHEN counts AND sample AND keys THEN foreign_keys END AS foreign_keys,
               counts AND sample AND keys AND foreign_keys AS passed
        FROM tested""",
    "csv_split_read": "SELECT *, FALSE AS in_one_task FROM documents",
    "text_migration": "SELECT doc_id, text, lang, source, n_chars FROM documents",
    "text_migration_marker": """
        SELECT doc_id, text, lang,
               CASE WHEN doc_id % 7 = 0 THEN '\\N' WHEN doc_id % 11 = 0 THEN NULL ELSE source END
               AS source, n_chars FROM documents""",
}
