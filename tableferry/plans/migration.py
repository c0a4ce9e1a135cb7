"""Moving a list of tables and checking the result: the direct way and the way through CSV."""

from __future__ import annotations

from collections.abc import Callable, Mapping, MutableMapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tableferry.functions import types as rules
from tableferry.functions.types import IGNORED_WORDS, TYPE_MAP, ColumnSpec
from tableferry.operators.audits import hex_audit
from tableferry.operators.observed import LoadFacts, Watch
from tableferry.operators.reconcile import (
    reconcile_checksums,
    sampled_checksums,
    table_checksums,
)
from tableferry.operators.report import load_report
from tableferry.operators.shape import conform_table, ignored_columns, prune_unsupported
from tableferry.sources.csv_files import CsvForm, parse_export, read_export, write_export
from tableferry.sources.files import FileStore
from tableferry.sources.jdbc import JdbcStore

Store = FileStore | JdbcStore


@dataclass(frozen=True)
class Settings:
    """Defaults of a migration run."""

    include_tables: Sequence[str] = ()
    exclude_tables: Sequence[str] = ()
    ignore_words: Sequence[str] = IGNORED_WORDS
    type_map: Mapping[str, str] = field(default_factory=lambda: dict(TYPE_MAP))
    strict_decimal: bool = False
    parallel_tables: int = 4
    partitions_per_table: int | None = None
    rows_per_task: int = 1_000_000
    find_split_keys: bool = True
    sample_size: int | None = None
    check_count: bool = True
    check_checksum: bool = True
    continue_on_error: bool = False
    csv: CsvForm = CsvForm()


def chosen_tables(tables: Sequence[str], settings: Settings) -> list[str]:
    """Included tables, or all but the excluded ones."""
    if settings.include_tables:
        return [name for name in tables if name in settings.include_tables]
    return [name for name in tables if name not in settings.exclude_tables]


def scan(
    spark: SparkSession, store: Store, table: str, settings: Settings, split_key: str | None
) -> DataFrame:
    """A stored table; JDBC tables are read over several connections by ``split_key``, or else by
    the primary key that their catalog names, as many as their rows need unless the settings name
    a number."""
    if isinstance(store, JdbcStore) and split_key is None and settings.find_split_keys:
        split_key = store.split_key(spark, table)
    if isinstance(store, JdbcStore) and split_key:
        parts = settings.partitions_per_table
        if parts is None:
            parts = max(1, -(-store.count(spark, table).first()[0] // settings.rows_per_task))
        return store.read_partitioned(spark, table, split_key, parts)
    return store.read(spark, table)


def conformed(
    spark: SparkSession,
    source: Store,
    table: str,
    settings: Settings,
    specs: Sequence[ColumnSpec] | None = None,
    split_key: str | None = None,
) -> DataFrame:
    """A source table as the target will hold it."""
    df = scan(spark, source, table, settings, split_key)
    described = rules.describe(df, specs) if specs else df
    pruned = prune_unsupported(described, settings.ignore_words)
    return conform_table(pruned, settings.type_map, strict_decimal=settings.strict_decimal)


def _run_tables(
    spark: SparkSession,
    tables: Sequence[str],
    work: Callable[[str], None],
    settings: Settings,
) -> dict[str, str]:
    """Run ``work`` for several tables at once, so that the last tasks of one table do not leave
    the cluster idle. Returns the error message per failed table."""
    guarded = inheritable_thread_target(spark)(work)
    errors: dict[str, str] = {}
    with ThreadPoolExecutor(max_workers=settings.parallel_tables) as pool:
        jobs = {name: pool.submit(guarded, name) for name in tables}
        for name, job in jobs.items():
            error = job.exception()
            if error is not None:
                if not settings.continue_on_error:
                    for other in jobs.values():
                        other.cancel()
                    raise error
                errors[name] = str(error).splitlines()[0]
    return errors


def migrate(
    spark: SparkSession,
    source: Store,
    target: Store,
    tables: Sequence[str],
    settings: Settings | None = None,
    specs: Mapping[str, Sequence[ColumnSpec]] | None = None,
    split_keys: Mapping[str, str] | None = None,
    facts: MutableMapping[str, LoadFacts] | None = None,
) -> dict[str, str]:
    """Load every chosen table, replacing its rows; returns errors by table.

    A load that Spark repeats after a failure starts from an empty table, so no row is doubled.
    ``facts`` receives, per table written to files, the count and checksum of the rows as they
    were written. ``validate`` then compares the target with them and leaves the source alone,
    so a source that changes meanwhile is no difference. (Through JDBC Spark does not hand the
    facts on; such tables have none.)
    """
    settings, specs, split_keys = settings or Settings(), specs or {}, split_keys or {}

    def load(table: str) -> None:
        rows = conformed(
            spark, source, table, settings, specs.get(table), split_keys.get(table)
        )
        if not rows.columns:
            raise ValueError(f"{table} has no column the target supports")
        if isinstance(target, JdbcStore):
            target.reload(rows, table, source.count(spark, table).first()[0])
            return
        if facts is None:
            target.reload(rows, table)
            return
        watch = Watch(rows)
        target.reload(watch.rows, table)
        facts[table] = watch.facts()

    return _run_tables(spark, chosen_tables(tables, settings), load, settings)


def ignored_by_table(
    spark: SparkSession,
    source: Store,
    tables: Sequence[str],
    settings: Settings | None = None,
    specs: Mapping[str, Sequence[ColumnSpec]] | None = None,
) -> dict[str, list[str]]:
    """Columns that will be left out, per table: schema only, nothing is read."""
    settings, specs = settings or Settings(), specs or {}
    found = {}
    for table in chosen_tables(tables, settings):
        df = source.read(spark, table)
        described = rules.describe(df, specs[table]) if table in specs else df
        names = ignored_columns(described, settings.ignore_words)
        if names:
            found[table] = names
    return found


_FACTS = (
    "table_name string, source_count long, target_count long, source_checksum string, "
    "target_checksum string, message string"
)


def validate(
    spark: SparkSession,
    source: Store,
    target: Store,
    tables: Sequence[str],
    settings: Settings | None = None,
    specs: Mapping[str, Sequence[ColumnSpec]] | None = None,
    keys: Mapping[str, Sequence[str]] | None = None,
    split_keys: Mapping[str, str] | None = None,
    errors: Mapping[str, str] | None = None,
    facts: Mapping[str, LoadFacts] | None = None,
) -> dict[str, DataFrame]:
    """``counts``, ``checksums`` and ``load`` reports, one row per table.

    Spark reads both ends once: the pass that makes the (typed, exact) checksums also counts.
    Tables with ``facts`` (from ``migrate``) are read at the target only, if that holds the types
    that were written. Without checksums each store counts its own rows. Checksums cover whole tables unless the
    settings name a ``sample_size`` and the table has ``keys``; then each store counts as well.

    Nothing that is wrong with a table raises: a table whose load failed (``errors``, from
    ``migrate``), that is missing, unreadable or has other columns is reported as failed with its
    message. The facts, one row per table, come to the driver.
    """
    settings, specs, split_keys = settings or Settings(), specs or {}, split_keys or {}
    chosen = chosen_tables(tables, settings)
    keys, messages, facts = keys or {}, dict(errors or {}), facts or {}

    def counted(store: Store, table: str) -> int | None:
        try:
            return store.count(spark, table).first()[0]
        except Exception as error:  # noqa: BLE001 - whatever a store raises is the finding
            messages.setdefault(table, str(error).splitlines()[0])
            return None

    def arrived(table: str) -> tuple | None:
        """Facts of the load and of the target, or None where the load left none to compare."""
        if table not in facts or settings.sample_size and table in keys:
            return None
        written, theirs = facts[table], target.read(spark, table)
        if not written.comparable_with(theirs.schema):
            return None
        found = table_checksums({table: theirs}, {table: written.schema.names}, typed=True).first()
        return written.n_rows, found["n_rows"], written.checksum, found["checksum"]

    def checked(table: str) -> tuple:
        found = arrived(table)
        if found is not None:
            return found
        ours = conformed(spark, source, table, settings, specs.get(table), split_keys.get(table))
        theirs = scan(spark, target, table, settings, split_keys.get(table))
        if settings.sample_size and table in keys:
            found = sampled_checksums(
                {table: ours}, {table: theirs}, keys, settings.sample_size, typed=True
            ).first()
            counts = counted(source, table), counted(target, table)
        else:
            found = reconcile_checksums({table: ours}, {table: theirs}, typed=True, counts=True).first()
            counts = found["source_n_rows"], found["target_n_rows"]
        return *counts, found["source_checksum"], found["target_checksum"]

    def outcome(table: str) -> tuple:
        if settings.check_checksum and table not in messages:
            try:
                return table, *checked(table), None
            except Exception as error:  # noqa: BLE001
                messages[table] = str(error).splitlines()[0]
        n_source = facts[table].n_rows if table in facts else counted(source, table)
        return table, n_source, counted(target, table), None, None, messages.get(table)

    guarded = inheritable_thread_target(spark)(outcome)
    with ThreadPoolExecutor(max_workers=settings.parallel_tables) as pool:
        rows = spark.createDataFrame(list(pool.map(guarded, chosen)), _FACTS)

    def agree(fact: str) -> Column:
        return F.coalesce(F.col(f"source_{fact}") == F.col(f"target_{fact}"), F.lit(False))

    reports = {}
    if settings.check_count:
        counts = ["table_name", "source_count", "target_count"]
        reports["counts"] = rows.select(*counts, agree("count").alias("matched"))
        reports["load"] = load_report(rows.select(*counts, "message"))
    if settings.check_checksum:
        reports["checksums"] = rows.select(
            "table_name", "source_checksum", "target_checksum", agree("checksum").alias("matched")
        )
    return reports


def export_tables(
    spark: SparkSession,
    source: Store,
    folder: str,
    tables: Sequence[str],
    settings: Settings | None = None,
    specs: Mapping[str, Sequence[ColumnSpec]] | None = None,
    split_keys: Mapping[str, str] | None = None,
) -> dict[str, T.StructType]:
    """Write every chosen table as CSV below ``folder``; returns the exported schemas. Tables
    without a column to export are skipped and have none."""
    settings, specs, split_keys = settings or Settings(), specs or {}, split_keys or {}
    schemas: dict[str, T.StructType] = {}

    def export(table: str) -> None:
        rows = conformed(
            spark, source, table, settings, specs.get(table), split_keys.get(table)
        )
        if rows.columns:
            write_export(rows, f"{folder}/{table}", **vars(settings.csv))
            schemas[table] = rows.schema

    _run_tables(spark, chosen_tables(tables, settings), export, settings)
    return schemas


def audit_export(
    spark: SparkSession, path: str, schema: T.StructType, settings: Settings | None = None
) -> DataFrame:
    """Audit of one exported table: the number of fields, and the hex text of binary columns."""
    hexes = [f.name for f in schema.fields if isinstance(f.dataType, T.BinaryType)]
    form = vars((settings or Settings()).csv)
    return hex_audit(read_export(spark, path, schema.names, **form), hexes)


def import_tables(
    spark: SparkSession,
    folder: str,
    schemas: Mapping[str, T.StructType],
    target: Store,
    settings: Settings | None = None,
) -> dict[str, str]:
    """Load exported CSV back, replacing the rows of the target; returns errors by table.

    A row with the wrong number of fields fails its table: nothing is padded or cut off.
    """

    form = vars((settings or Settings()).csv)

    def load(table: str) -> None:
        schema = schemas[table]
        texts = read_export(
            spark, f"{folder}/{table}", schema.names, **form, keep_bad_rows=False
        )
        target.reload(parse_export(texts, schema), table)

    return _run_tables(spark, list(schemas), load, settings or Settings())
