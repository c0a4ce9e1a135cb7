"""Loads that go on where they stopped: a ledger of key ranges with counts and checksums."""

from __future__ import annotations

import datetime
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tableferry.functions.fingerprint import with_row_hash, word_halves
from tableferry.functions.text import quoted
from tableferry.operators.observed import Watch
from tableferry.session import discard
from tableferry.sources.files import FileStore
from tableferry.sources.key_ranges import (
    in_key_range,
    key_cuts,
    key_from_text,
    key_ranges,
    key_text,
    range_number,
)
from tableferry.sources.ranges import either

RANGE = "_range"
_SUMS = ["n_rows", *word_halves(True)]

LEDGER_SCHEMA = T.StructType(
    [
        T.StructField("table_name", T.StringType()),
        T.StructField("part", T.IntegerType()),
        T.StructField("low", T.StringType()),
        T.StructField("high", T.StringType()),
        T.StructField("status", T.StringType()),
        *[T.StructField(name, T.LongType()) for name in _SUMS],
        T.StructField("version", T.LongType()),
        T.StructField("updated_at", T.TimestampNTZType()),
    ]
)


def range_sums(df: DataFrame, number: Column, columns: Sequence[str]) -> DataFrame:
    """``part`` and the additive facts of its rows: one small row per task and range is shuffled."""
    marked = with_row_hash(df.select(number.alias(RANGE), *map(quoted, columns)), columns)
    sums = [F.expr(value).alias(name) for name, value in word_halves(True).items()]
    counted = marked.groupBy(F.col(RANGE).cast("int").alias("part"))
    return counted.agg(F.count(F.lit(1)).alias("n_rows"), *sums)


@dataclass(frozen=True)
class RangeLedger:
    """The state of every key range of every table, as an append-only parquet folder.

    ``pending``: to be loaded. ``verified``: the target holds the rows that were read, with these
    facts. ``failed``: the target held something else; to be loaded again. The newest entry of a
    range, by a number that rises, counts.
    """

    path: str

    def entries(self, spark: SparkSession) -> DataFrame:
        try:
            return spark.read.schema(LEDGER_SCHEMA).parquet(self.path)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return spark.createDataFrame([], LEDGER_SCHEMA)

    def ranges(self, spark: SparkSession, table: str) -> DataFrame:
        """One row per range: its newest entry."""
        held = self.entries(spark).where(F.col("table_name") == table)
        facts = [field.name for field in LEDGER_SCHEMA.fields if field.name != "part"]
        newest = F.max_by(F.struct(*facts), "version").alias("newest")
        return held.groupBy("part").agg(newest).select("part", "newest.*")

    def note(self, spark: SparkSession, table: str, rows: Sequence[dict]) -> None:
        """Append entries of ranges: ``part, low, high, status`` and the facts there are."""
        last = self.entries(spark).where(F.col("table_name") == table).agg(F.max("version")).first()[0]
        now = datetime.datetime.now(datetime.UTC).replace(tzinfo=None)
        base = dict.fromkeys(LEDGER_SCHEMA.names) | {"table_name": table, "version": 1 + (last or 0), "updated_at": now}
        entries = [tuple((base | row)[name] for name in LEDGER_SCHEMA.names) for row in rows]
        spark.createDataFrame(entries, LEDGER_SCHEMA).coalesce(1).write.mode("append").parquet(self.path)

    def compact(self, spark: SparkSession, table: str) -> None:
        """Write the newest entries once more, alone, and remove the files before. Entries that are
        there twice, after a cut in between, change nothing."""
        held = self.entries(spark)
        files = held.inputFiles()
        others = held.where(F.col("table_name") != table)
        kept = self.ranges(spark, table).select(*LEDGER_SCHEMA.names).unionByName(others)
        kept.coalesce(1).write.mode("append").parquet(self.path)
        for file in files:
            discard(spark, file)


@dataclass(frozen=True)
class Progress:
    """What one call did, and what is left."""

    n_ranges: int
    n_loaded: int
    n_failed: int
    n_open: int
    rows_read: int


@dataclass(frozen=True)
class ResumableLoad:
    """A load of one table by key ranges into files that are partitioned by range.

    The first call cuts the key (``key_cuts``) into ``parts`` ranges of about equal size and notes
    them. Every call takes up the open ranges in groups of ``ranges_per_job``: a group's rows are
    read by their key bounds and written over whatever an earlier, broken attempt left in the
    group's folders; the write counts and hashes them. Then the written files are read once, and
    only if their facts add up to those of the write are the ranges noted as verified, each with
    its own. So a load may be cut off anywhere and called again; what is verified is not read
    again. The target is the store's table with a further column ``_range``; ``read`` hides it.
    """

    store: FileStore
    table: str
    keys: Sequence[str]
    ledger: RangeLedger
    parts: int = 64
    ranges_per_job: int = 16
    _settings: dict = field(default_factory=lambda: {"partitionOverwriteMode": "dynamic"}, repr=False)

    def read(self, spark: SparkSession) -> DataFrame:
        return self.store.read(spark, self.table).drop(RANGE)

    def _planned(self, source: DataFrame) -> list[dict]:
        spark = source.sparkSession
        rows = [row.asDict() for row in self.ledger.ranges(spark, self.table).orderBy("part").collect()]
        if not rows:
            bounds = key_ranges(key_cuts(source, self.keys, self.parts))
            rows = [
                {"part": part, "low": key_text(low), "high": key_text(high), "status": "pending"}
                for part, (low, high) in enumerate(bounds)
            ]
            self.ledger.note(spark, self.table, rows)
        return rows

    def _cuts(self, source: DataFrame, rows: Sequence[dict]) -> list:
        types = [source.schema[name].dataType for name in self.keys]
        return [key_from_text(row["low"], types) for row in rows[1:]]

    def run(self, source: DataFrame, most_groups: int | None = None) -> Progress:
        """Load the open ranges, or the first groups of them; returns the progress."""
        spark = source.sparkSession
        rows = self._planned(source)
        cuts = self._cuts(source, rows)
        bounds = key_ranges(cuts)
        open_parts = [row["part"] for row in rows if row["status"] != "verified"]
        groups = [open_parts[i : i + self.ranges_per_job] for i in range(0, len(open_parts), self.ranges_per_job)]
        rows_read = n_loaded = n_failed = 0
        for group in groups[:most_groups]:
            # Neighbours are one range of the scan.
            runs: list[list[int]] = []
            for part in group:
                if runs and runs[-1][1] + 1 == part:
                    runs[-1][1] = part
                else:
                    runs.append([part, part])
            wanted = either([in_key_range(self.keys, bounds[a][0], bounds[b][1]) for a, b in runs])
            watch = Watch(source.where(wanted))
            marked = watch.rows.withColumn(RANGE, range_number(self.keys, cuts))
            for part in group:  # a range that has become empty must not keep old files
                discard(spark, f"{self.store.path(self.table)}/{RANGE}={part}")
            (
                marked.write.format(self.store.format)
                .options(**self._settings)
                .mode("overwrite")
                .partitionBy(RANGE)
                .save(self.store.path(self.table))
            )
            facts = watch.facts()
            found = {row["part"]: row.asDict() for row in self._target_sums(spark, source, group).collect()}
            total = {name: sum(row[name] for row in found.values()) for name in _SUMS}
            status = "verified" if total == dict(facts.sums) else "failed"
            empty = dict.fromkeys(_SUMS, 0)
            texts = [{"low": key_text(bounds[part][0]), "high": key_text(bounds[part][1])} for part in group]
            self.ledger.note(
                spark,
                self.table,
                [{**empty, **found.get(part, {}), "part": part, "status": status, **text} for part, text in zip(group, texts)],
            )
            rows_read += facts.n_rows
            n_loaded += len(group) if status == "verified" else 0
            n_failed += len(group) if status == "failed" else 0
        return Progress(len(rows), n_loaded, n_failed, len(open_parts) - n_loaded, rows_read)

    def _target_sums(self, spark: SparkSession, source: DataFrame, group: Sequence[int]) -> DataFrame:
        """Facts per range of what the target holds; only the group's folders are read."""
        fields = T.StructType([*source.schema.fields, T.StructField(RANGE, T.IntegerType())])
        held = spark.read.schema(fields).format(self.store.format).load(self.store.path(self.table))
        return range_sums(held.where(F.col(RANGE).isin(list(group))), F.col(RANGE), source.columns)

    def reopen_changed(self, source: DataFrame) -> list[int]:
        """Compare the source, range by range, with the facts of the load: ranges that differ are
        noted as pending and returned. One pass over the source, whose rows are not shuffled."""
        spark = source.sparkSession
        rows = self.ledger.ranges(spark, self.table).orderBy("part").collect()
        number = range_number(self.keys, self._cuts(source, [row.asDict() for row in rows]))
        now = {row["part"]: row for row in range_sums(source, number, source.columns).collect()}
        changed = [
            row
            for row in rows
            if row["status"] == "verified"
            and any((now[row["part"]][name] if row["part"] in now else 0) != row[name] for name in _SUMS)
        ]
        if changed:
            facts = [{"part": r["part"], "low": r["low"], "high": r["high"], "status": "pending"} for r in changed]
            self.ledger.note(spark, self.table, facts)
        return [row["part"] for row in changed]
