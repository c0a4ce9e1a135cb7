"""Bringing staged rows into a target: append, upsert, delete and insert, reload, swap.

The DataFrame forms return the new content of the target. ``upsert_partitions`` applies one to a
partitioned table and rewrites only the partitions concerned; ``staged_reload`` swaps a checked
copy in.
"""

from __future__ import annotations

import datetime
import uuid
from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import reduce
from typing import Protocol
from urllib.parse import unquote

from pyspark import inheritable_thread_target
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tableferry.functions.text import quoted
from tableferry.operators.audits import duplicate_keys
from tableferry.operators.reconcile import row_diff
from tableferry.session import discard, written, written_at
from tableferry.sources.ranges import either


class LoadRefused(RuntimeError):
    """A check before the commit failed; the target was not touched."""


def _in_order(df: DataFrame, like: DataFrame) -> DataFrame:
    return df.select(*map(quoted, like.columns))


def _null_in_key(keys: Sequence[str]) -> Column:
    return reduce(Column.__or__, [F.col(quoted(name)).isNull() for name in keys])


def _newest(stage: DataFrame, keys: Sequence[str], version: Sequence[str] | None) -> DataFrame:
    version = list(version or [])
    rest = [
        field.name
        for field in stage.schema.fields
        if field.name not in {*keys, *version}
        and not isinstance(field.dataType, (T.MapType, T.VariantType))
    ]
    order = [F.desc(quoted(name)) for name in version + rest]
    newest_first = Window.partitionBy(*map(quoted, keys)).orderBy(*(order or [F.lit(1)]))
    return (
        stage.withColumn("_nth", F.row_number().over(newest_first)).where("_nth = 1").drop("_nth")
    )


def dedupe_stage(
    stage: DataFrame, keys: Sequence[str], version: Sequence[str] | None = None
) -> DataFrame:
    """The newest staged row per key: highest ``version``, then highest remaining columns.

    Spark keeps one row per key in every task before the shuffle, so a key staged very often
    does not load one task. NULL never equals NULL in a key, so such rows are all kept.
    """
    nulls = _null_in_key(keys)
    return _newest(stage.where(~nulls), keys, version).unionByName(stage.where(nulls))


def _staged_keys(stage: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The distinct keys of a written stage, written: the planner broadcasts them only if the
    files are small, and else can split a target key that holds very many rows (it does so only
    for joins that read their shuffles directly, not through an aggregate)."""
    return written(stage.select(*map(quoted, keys)).distinct(), "staged-keys")


def _matching(target: DataFrame, staged: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    """Semi- or anti-join by equal keys; names may hold any character."""
    values = staged.select(*[F.col(quoted(name)).alias(f"_k{i}") for i, name in enumerate(keys)])
    tests = [F.col(quoted(name)) == F.col(f"_k{i}") for i, name in enumerate(keys)]
    return target.join(values, reduce(Column.__and__, tests), how)


def _without(target: DataFrame, staged: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Target rows whose key is not among the (distinct) staged keys."""
    return _matching(target, staged.select(*map(quoted, keys)), keys, "left_anti")


def append_conflicts(target: DataFrame, stage: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that appending ``stage`` would repeat (or that are NULL), with the number of rows
    they would have.

    Of the target only the rows with a staged key are counted; a small stage is broadcast to
    find them, so the target is not shuffled. The stage is read once.
    """
    names = [quoted(name) for name in keys]
    stage = written(stage.select(*names), "stage")
    held = _matching(target.select(*names), _staged_keys(stage, keys), keys, "left_semi")
    return (
        held.unionAll(stage)
        .groupBy(*names)
        .agg(F.count(F.lit(1)).alias("n_rows"))
        .where((F.col("n_rows") > 1) | _null_in_key(keys))
    )


def append_load(target: DataFrame, stage: DataFrame) -> DataFrame:
    """All rows of both. Whether keys collide is asked by ``append_conflicts``."""
    return target.unionByName(stage)


def append_checked(
    target: DataFrame, stage: DataFrame, keys: Sequence[str], commit: Callable[[DataFrame], None]
) -> None:
    """Commit the stage by ``commit(stage)``, or refuse all of it when a key would repeat. The
    stage is written once; what is checked is what is committed, whatever arrives meanwhile."""
    spark = stage.sparkSession
    held, folder = written_at(_in_order(stage, target), "stage")
    try:
        if not append_conflicts(target, held, keys).isEmpty():
            raise LoadRefused(f"staged rows repeat a key {list(keys)}")
        commit(held)
    finally:
        discard(spark, folder)


def upsert(
    target: DataFrame,
    stage: DataFrame,
    keys: Sequence[str],
    version: Sequence[str] | None = None,
) -> DataFrame:
    """Target with each staged row replacing the row of the same key, or added.

    Several staged rows of one key count once, the newest by ``version``. Applying the same
    stage again changes nothing, unless it has NULL in a key: such a row matches no other. The
    stage is written once, below the work folder, and the result reads that copy.
    """
    stage = written(stage, "stage")
    kept = _without(target, _staged_keys(stage, keys), keys)
    return kept.unionByName(dedupe_stage(stage, keys, version))


def guarded_upsert(
    target: DataFrame, stage: DataFrame, keys: Sequence[str], version: Sequence[str]
) -> DataFrame:
    """``upsert`` in which a staged row replaces only a row that is not newer by ``version``.

    Deliveries may come late or in any order: the result is the newest row of each key. Of equal
    versions the staged row stands; a NULL version is older than any other. Only target rows with
    a staged key meet the stage; the others are not shuffled where the stage's keys are few.
    """
    stage = written(stage, "stage")
    staged_keys = _staged_keys(stage, keys)
    current = _matching(target, staged_keys, keys, "left_semi").withColumn("_staged", F.lit(0))
    staged = _in_order(dedupe_stage(stage, keys, version), target).withColumn("_staged", F.lit(1))
    winners = dedupe_stage(current.unionByName(staged), keys, [*version, "_staged"])
    return _without(target, staged_keys, keys).unionByName(winners.drop("_staged"))


def delete_insert(target: DataFrame, stage: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Target with all rows of the staged keys deleted, and all staged rows inserted.

    Unlike ``upsert`` the key need not be unique: a staged group replaces the whole group. The
    stage is written once, as in ``upsert``.
    """
    stage = written(stage, "stage")
    return _without(target, _staged_keys(stage, keys), keys).unionByName(stage)


def deleted_rows(target: DataFrame, stage: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The rows ``delete_insert`` deletes."""
    staged = _staged_keys(stage, keys)
    return _matching(target, staged, keys, "left_semi")


# -- tables ---------------------------------------------------------------------------------


def create_partitioned(df: DataFrame, table: str, partition_by: Sequence[str]) -> None:
    """Create a parquet table in the catalog, partitioned, holding ``df``, at its own place."""
    (
        df.hint("rebalance", *partition_by)
        .write.format("parquet")
        .partitionBy(*partition_by)
        .saveAsTable(table)
    )


def table_location(spark: SparkSession, table: str) -> str:
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").where("col_name = 'Location'")
    return rows.select("data_type").first()[0].rstrip("/")


def _quoted(text: str) -> str:
    return text.replace("\\", "\\\\").replace("'", "\\'")


def _partition_clause(row: Row, fields: Sequence[T.StructField]) -> str:
    """``a = '1', b = '2'`` for a PARTITION clause."""
    nulls = [field.name for field in fields if row[field.name] is None]
    if nulls:
        raise ValueError(f"partition columns must not be NULL: {nulls}")
    return ", ".join(f"`{f.name}` = '{_quoted(str(row[f.name]))}'" for f in fields)


def _in_places(by: Sequence[str], places: Sequence[Row]) -> Column:
    """Filter on partition columns alone, so only these partitions are listed and read."""
    if len(by) == 1:
        return F.col(quoted(by[0])).isin([place[by[0]] for place in places])
    return either(
        [
            reduce(Column.__and__, [F.col(quoted(name)) == F.lit(place[name]) for name in by])
            for place in places
        ]
    )


def _point_to(
    spark: SparkSession, table: str, clauses: Sequence[str], folders: Mapping[str, str]
) -> None:
    """Make the catalog read partitions from new folders; those without a folder are dropped.
    The partitions of the table are not listed: one that cannot be moved is new."""

    def move(clause: str) -> str | None:
        if clause not in folders:
            spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION ({clause})")
            return None
        try:
            place = f"LOCATION '{_quoted(folders[clause])}'"
            spark.sql(f"ALTER TABLE {table} PARTITION ({clause}) SET {place}")
        except AnalysisException as error:
            if error.getCondition() not in ("PARTITIONS_NOT_FOUND", "NO_SUCH_PARTITION"):
                raise
            return f"PARTITION ({clause}) {place}"
        return None

    with ThreadPoolExecutor(max_workers=8) as pool:
        added = [new for new in pool.map(inheritable_thread_target(spark)(move), clauses) if new]
    if added:
        spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS {' '.join(added)}")


def _folders_of(df: DataFrame, by: Sequence[str], fields: Sequence[T.StructField]) -> dict:
    """Partition clause -> folder, of the partitions in which ``df`` has files."""
    folder = F.regexp_replace("_metadata.file_path", "/[^/]*$", "").alias("_folder")
    rows = df.select(*map(quoted, by), folder).distinct().collect()
    return {_partition_clause(row, fields): unquote(row["_folder"]) for row in rows}


class Tombstones(Protocol):
    """Remembers deleted keys (``tombstones.TombstoneStore``)."""

    def newer(self, stage: DataFrame, deleted: str | None) -> DataFrame: ...

    def bury(self, rows: DataFrame) -> None: ...


def _retire(spark: SparkSession, root: str, folders: Sequence[str]) -> None:
    """Note replaced folders, for ``clean_replaced``: readers may still have their files open."""
    if folders:
        rows = spark.createDataFrame([(folder,) for folder in folders], "value string")
        stamp = datetime.datetime.now(datetime.UTC).strftime("%Y%m%d%H%M%S")
        rows.coalesce(1).write.text(f"{root}/_replaced/{stamp}-{uuid.uuid4().hex}")


def clean_replaced(
    spark: SparkSession, table: str, grace: datetime.timedelta = datetime.timedelta(hours=1)
) -> int:
    """Delete the files that loads of a table replaced at least ``grace`` ago; returns how many
    folders. A reader that began before a load has that long to finish."""
    root = table_location(spark, table)
    place = spark._jvm.org.apache.hadoop.fs.Path(f"{root}/_replaced")
    store = place.getFileSystem(spark._jsc.hadoopConfiguration())
    if not store.exists(place):
        return 0
    now, removed = datetime.datetime.now(datetime.UTC).replace(tzinfo=None), 0
    for status in store.listStatus(place):
        note = status.getPath()
        replaced_at = datetime.datetime.strptime(note.getName().split("-")[0], "%Y%m%d%H%M%S")
        if now - replaced_at >= grace:
            for row in spark.read.text(note.toString()).collect():
                discard(spark, row["value"])
                removed += 1
            store.delete(note, True)
    return removed


def _rewrite(
    spark: SparkSession,
    table: str,
    newest: DataFrame,
    keys: Sequence[str],
    fields: Sequence[T.StructField],
    places: Sequence[Row],
    deleted: str | None,
) -> None:
    """Rewrite one group of partitions with the staged rows that belong there."""
    by = [field.name for field in fields]
    clauses = [_partition_clause(place, fields) for place in places]
    target, wanted = spark.table(table), _in_places(by, places)
    root = table_location(spark, table)
    before = _folders_of(target.where(wanted), by, fields)
    kept = _without(target.where(wanted), newest, keys)
    staged = newest.where(wanted)
    if deleted:
        staged = _in_order(staged.where(~F.col(quoted(deleted))), target)
    folder = f"{root}/_loads/{uuid.uuid4().hex}"
    (
        kept.unionByName(staged)
        .hint("rebalance", *by)
        .write.format("parquet")
        .partitionBy(*by)
        .save(folder)
    )
    # A partition that lost all its rows has no folder.
    found = spark.read.schema(T.StructType(list(fields))).parquet(folder)
    folders = _folders_of(found, by, fields)
    _point_to(spark, table, clauses, folders)
    spark.catalog.refreshTable(table)
    gone = set(before.values()) - set(folders.values())
    _retire(spark, root, sorted(old for old in gone if old.startswith(f"{root}/")))


def _newer_than(target: DataFrame, newest: DataFrame, keys: Sequence[str], version: Sequence[str]) -> DataFrame:
    """The staged rows whose key the target holds in no newer version. Of the target only keys
    and versions are read, and shuffled only for the staged keys."""
    names = [f"_k{i}" for i in range(len(keys))]
    held = _matching(target.select(*map(quoted, dict.fromkeys([*keys, *version]))), newest.select(*map(quoted, keys)), keys, "left_semi")
    current = held.groupBy(*[F.col(quoted(key)).alias(name) for key, name in zip(keys, names)]).agg(
        F.max(F.struct(*map(quoted, version))).alias("_held")
    )
    same = reduce(Column.__and__, [F.col(quoted(key)) == F.col(name) for key, name in zip(keys, names)])
    fits = F.col("_held").isNull() | (F.struct(*map(quoted, version)) >= F.col("_held"))
    return newest.join(current, same, "left").where(fits).drop("_held", *names)


def upsert_partitions(
    spark: SparkSession,
    table: str,
    stage: DataFrame,
    keys: Sequence[str],
    partition_by: Sequence[str],
    version: Sequence[str] | None = None,
    key_fixes_partition: bool = False,
    group_size: int = 500,
    guarded: bool = False,
    deleted: str | None = None,
    tombstones: Tombstones | None = None,
    prepared: bool = False,
) -> int:
    """Upsert into a partitioned catalog table; rewrites only the partitions concerned.

    Those are the partitions of the staged rows and, unless ``key_fixes_partition``, the ones in
    which the staged keys live now (only keys are read to find them), so a row may move. They are
    worked through in groups of about ``group_size``, however many they are. The new files go to
    a folder of their own below the table's location and the catalog is pointed there partition
    by partition. The files they replace stay, for readers that have them open, until
    ``clean_replaced`` removes them. A stage with NULL in a key is refused, for its rows could not
    be found again. Returns the number of partitions rewritten.

    ``guarded``: a staged row replaces only a row that is not newer by ``version``, so deliveries
    may come late or in any order, and partitions that only get older rows are left alone.
    ``deleted`` names a boolean column of the stage: its true rows delete their key (of equal
    versions the deletion counts). ``tombstones`` remembers deleted keys with their versions, so
    that an older row of such a key that comes later is not taken for new. ``prepared``: the stage
    is written already and holds each key once, so it is not written again.

    Readers never see a half-written partition, and a lost job leaves every partition old or new;
    running it again gives the same table. Several partitions do not change at one moment: until
    the call ends, a row that moves may be seen in both or in neither.
    """
    if (guarded or tombstones) and not version:
        raise ValueError("a guarded upsert needs a version")
    target = spark.table(table)
    by = list(partition_by)
    fields = [target.schema[name] for name in by]
    names = target.columns + ([deleted] if deleted else [])
    order = [*(version or []), *([deleted] if deleted else [])]
    if deleted:
        stage = stage.withColumn(deleted, F.coalesce(F.col(quoted(deleted)), F.lit(False)))
    newest = stage if prepared else _newest(stage, keys, order or None)
    newest = newest.select(*map(quoted, names))
    if tombstones:
        newest = tombstones.newer(newest, deleted)
    if guarded:
        newest, raw_folder = written_at(newest, f"{table}-raw")
        folders = [raw_folder]
        newest = _newer_than(target, newest, keys, version)
    else:
        folders = []
    if guarded or tombstones or not prepared:
        newest, stage_folder = written_at(newest, f"{table}-stage")
        folders.append(stage_folder)
    try:
        if not newest.where(_null_in_key(keys)).isEmpty():
            raise LoadRefused(f"staged rows have NULL in the key {list(keys)}")
        living = newest.where(~F.col(quoted(deleted))) if deleted else newest
        if not living.where(_null_in_key(by)).isEmpty():
            raise ValueError(f"partition columns must not be NULL: {by}")
        if tombstones and deleted:
            # Before the table changes: a load that is cut off and repeated finds the same rows.
            tombstones.bury(newest.where(F.col(quoted(deleted))))
        concerned = living.select(*map(quoted, by))
        if key_fixes_partition and deleted:
            homes = newest.where(F.col(quoted(deleted)) & ~_null_in_key(by))
            concerned = concerned.unionAll(homes.select(*map(quoted, by)))
        if not key_fixes_partition:
            held = target.select(*map(quoted, dict.fromkeys([*keys, *by])))
            homes = _matching(held, newest.select(*map(quoted, keys)), keys, "left_semi")
            concerned = concerned.unionAll(homes.select(*map(quoted, by)))
        places, places_folder = written_at(concerned.distinct(), f"{table}-places")
        folders.append(places_folder)
        n_places = places.count()
        groups = -(-n_places // group_size)
        number = F.pmod(F.xxhash64(*map(quoted, by)), F.lit(groups))
        for group in range(groups):
            chosen = places.where(number == group).collect()
            if chosen:
                _rewrite(spark, table, newest, keys, fields, chosen, deleted)
        return n_places
    finally:
        for folder in folders:
            discard(spark, folder)


def replace_partitions(
    spark: SparkSession,
    table: str,
    rows: DataFrame,
    partition_by: Sequence[str],
    places: DataFrame,
    group_size: int = 500,
) -> int:
    """Give the partitions ``places`` (one row each, written) of a catalog table the content that
    ``rows`` (written) has for them; a partition without rows is dropped.

    New files go to folders of their own and the catalog is pointed there, as in
    ``upsert_partitions``; replaced files stay until ``clean_replaced``. Returns the number of
    partitions replaced.
    """
    target = spark.table(table)
    by = list(partition_by)
    fields = [target.schema[name] for name in by]
    root = table_location(spark, table)
    n_places = places.count()
    groups = -(-n_places // group_size)
    number = F.pmod(F.xxhash64(*map(quoted, by)), F.lit(groups))
    for group in range(groups):
        chosen = places.where(number == group).select(*map(quoted, by)).collect()
        if not chosen:
            continue
        clauses = [_partition_clause(place, fields) for place in chosen]
        wanted = _in_places(by, chosen)
        before = _folders_of(spark.table(table).where(wanted), by, fields)
        folder = f"{root}/_loads/{uuid.uuid4().hex}"
        staged = _in_order(rows.where(wanted), target)
        staged.hint("rebalance", *by).write.format("parquet").partitionBy(*by).save(folder)
        folders = _folders_of(spark.read.schema(T.StructType(fields)).parquet(folder), by, fields)
        _point_to(spark, table, clauses, folders)
        spark.catalog.refreshTable(table)
        gone = set(before.values()) - set(folders.values())
        _retire(spark, root, sorted(old for old in gone if old.startswith(f"{root}/")))
    return n_places


def stage_name(table: str, at: datetime.datetime | None = None) -> str:
    """``<table>_tmp_<timestamp>``."""
    moment = at or datetime.datetime.now()
    return f"{table}_tmp_{moment:%Y%m%d%H%M%S%f}"


def same_rows_as(source: DataFrame, keys: Sequence[str]) -> Callable[[DataFrame], None]:
    """A check for ``staged_reload``: the stage holds the rows of ``source``, field by field."""

    def check(loaded: DataFrame) -> None:
        if not row_diff(source, loaded, keys).isEmpty():
            raise LoadRefused("the stage differs from the source")

    return check


def staged_reload(
    df: DataFrame,
    table: str,
    keys: Sequence[str],
    checks: Sequence[Callable[[DataFrame], None]] = (),
    after_swap: Sequence[Callable[[DataFrame], None]] = (),
) -> str:
    """Replace a catalog table by a checked copy; returns the name the old one is kept under.

    The rows are written to a stage table, and only if its keys are sound and every check passes
    (a check raises to refuse) are the two names exchanged. Then the table is read under its own
    name: it must have the staged schema and as many rows, and pass every check of
    ``after_swap``; if not, or if the second rename fails, the old table gets its name back. A
    refused stage is kept for inspection. The two renames are not one atomic step; readers in
    between find no table.
    """
    spark = df.sparkSession
    stage = stage_name(table)
    df.write.format("parquet").saveAsTable(stage)
    loaded = spark.table(stage)
    if not duplicate_keys(loaded, keys).isEmpty():
        raise LoadRefused(f"{stage}: key {list(keys)} is repeated or NULL")
    for check in checks:
        check(loaded)
    schema, n_rows = loaded.schema, loaded.count()
    backup = stage.replace("_tmp_", "_bak_") if spark.catalog.tableExists(table) else ""
    if backup:
        spark.sql(f"ALTER TABLE {table} RENAME TO {backup}")
    try:
        spark.sql(f"ALTER TABLE {stage} RENAME TO {table}")
        spark.catalog.refreshTable(table)
        live = spark.table(table)
        if live.schema != schema or live.count() != n_rows:
            raise LoadRefused(f"{table} is not what was staged")
        for check in after_swap:
            check(live)
    except Exception:
        if spark.catalog.tableExists(table):
            spark.sql(f"ALTER TABLE {table} RENAME TO {stage}")
        if backup:
            spark.sql(f"ALTER TABLE {backup} RENAME TO {table}")
        raise
    return backup
