"""Increments that see late, changed and deleted rows: stored fingerprints per bucket of time.

A mark only finds rows that are newer than it. Here each bucket (a day, say) has its number of
rows and added-up hashes in a store. A load adds up the source's buckets, without a shuffle of
rows, and takes up those that differ: new ones, ones with a late, changed or deleted row, and ones
that are gone.
"""

from __future__ import annotations

import datetime
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tableferry.functions.fingerprint import with_row_hash, word_halves
from tableferry.functions.text import quoted
from tableferry.session import discard, written_at

_SUMS = ["n_rows", *word_halves(True)]


def bucket_sums(df: DataFrame, by: Sequence[str]) -> DataFrame:
    """``by`` and the additive facts of each bucket's rows; NULL is a bucket of its own."""
    sums = [F.expr(value).alias(name) for name, value in word_halves(True).items()]
    marked = with_row_hash(df, df.columns)
    return marked.groupBy(*map(quoted, by)).agg(F.count(F.lit(1)).alias("n_rows"), *sums)


@dataclass(frozen=True)
class BucketStore:
    """The facts of the buckets of one table as last loaded; an append-only parquet folder.

    Every load appends the facts of the buckets it took up, with a number that rises; a bucket that
    went has ``n_rows`` 0. The newest entry of a bucket counts.
    """

    path: str
    by: Sequence[str]

    def entries(self, spark: SparkSession) -> DataFrame | None:
        try:
            return spark.read.parquet(self.path)
        except AnalysisException as error:
            if error.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
                raise
            return None

    def latest(self, spark: SparkSession) -> DataFrame | None:
        """One row per bucket: its facts, also of those that are gone."""
        held = self.entries(spark)
        if held is None:
            return None
        newest = F.max_by(F.struct(*_SUMS), "version").alias("newest")
        return held.groupBy(*map(quoted, self.by)).agg(newest).select(*map(quoted, self.by), "newest.*")

    def save(self, facts: DataFrame) -> None:
        spark = facts.sparkSession
        held = self.entries(spark)
        last = held.agg(F.max("version")).first()[0] if held is not None else 0
        stamp = datetime.datetime.now(datetime.UTC).replace(tzinfo=None).isoformat(sep=" ")
        rows = facts.select(
            *map(quoted, self.by), *_SUMS, F.lit(1 + (last or 0)).cast("bigint").alias("version"),
            F.lit(stamp).cast("timestamp_ntz").alias("updated_at"),
        )
        rows.write.mode("append").parquet(self.path)

    def compact(self, spark: SparkSession) -> None:
        """Keep the newest entry of each bucket; written before the old files go."""
        held = self.entries(spark)
        if held is not None:
            files = held.inputFiles()
            whole = F.max_by(F.struct(*held.columns), "version").alias("newest")
            kept = held.groupBy(*[F.col(quoted(n)).alias(f"_b{i}") for i, n in enumerate(self.by)]).agg(whole)
            kept.select("newest.*").write.mode("append").parquet(self.path)
            for file in files:
                discard(spark, file)


def _same(by: Sequence[str], other: str = "_o") -> Column:
    tests = [F.col(quoted(name)).eqNullSafe(F.col(f"{other}{i}")) for i, name in enumerate(by)]
    return reduce(Column.__and__, tests)


def _renamed(df: DataFrame, by: Sequence[str], *rest: Column | str) -> DataFrame:
    return df.select(*[F.col(quoted(name)).alias(f"_o{i}") for i, name in enumerate(by)], *rest)


def differing_buckets(source: DataFrame, store: BucketStore) -> DataFrame:
    """``by`` and ``change`` of every bucket in which the source is not what was loaded: ``new``,
    ``changed`` or ``gone``. One pass over the source; the join is between buckets."""
    now = bucket_sums(source, store.by)
    before = store.latest(source.sparkSession)
    if before is None:
        return now.select(*map(quoted, store.by), F.lit("new").alias("change"))
    own = F.struct(*_SUMS)
    sides = now.select(*map(quoted, store.by), own.alias("now"), F.lit(None).cast(_struct()).alias("held"))
    sides = sides.unionAll(
        before.select(*map(quoted, store.by), F.lit(None).cast(_struct()).alias("now"), own.alias("held"))
    )
    both = sides.groupBy(*map(quoted, store.by)).agg(F.max("now").alias("now"), F.max("held").alias("held"))
    held = F.coalesce(F.col("held.n_rows"), F.lit(0))
    change = (
        F.when(F.col("now").isNull(), F.when(held > 0, "gone"))
        .when(held == 0, "new")
        .when(F.col("now") != F.col("held"), "changed")
    )
    return both.select(*map(quoted, store.by), change.alias("change")).where("change IS NOT NULL")


def _struct() -> str:
    return "struct<" + ",".join(f"{name}:bigint" for name in _SUMS) + ">"


def bucket_load(
    source: DataFrame, store: BucketStore, commit: Callable[[DataFrame, DataFrame], object]
) -> dict[str, int]:
    """One increment: ``commit(stage, places)`` the rows of all buckets that differ, then note them.

    ``stage`` holds the whole content of the buckets named in ``places``, which may be none for one
    that is gone: the target replaces them (``load.replace_partitions``). The stage is written once
    and the facts noted are those of the stage, so rows that arrive meanwhile are found by the next
    load. Notes are made last: after a failure the same buckets are taken up again. Returns the
    number of buckets ``new``, ``changed`` and ``gone``, and the ``rows`` staged.
    """
    spark = source.sparkSession
    places, places_folder = written_at(differing_buckets(source, store), "buckets")
    folders = [places_folder]
    try:
        found = {row["change"]: row["count"] for row in places.groupBy("change").count().collect()}
        counts = {change: found.get(change, 0) for change in ("new", "changed", "gone")}
        if not found:
            return {**counts, "rows": 0}
        wanted = _renamed(places.where("change <> 'gone'"), store.by)
        stage, folder = written_at(source.join(wanted, _same(store.by), "left_semi"), "bucket-stage")
        folders.append(folder)
        commit(stage, places)
        facts, folder = written_at(bucket_sums(stage, store.by), "bucket-facts")
        folders.append(folder)
        none = [F.lit(0).cast("bigint").alias(name) for name in _SUMS]
        emptied = places.join(_renamed(facts, store.by), _same(store.by), "left_anti")
        store.save(facts.unionByName(emptied.select(*map(quoted, store.by), *none)))
        return {**counts, "rows": facts.agg(F.coalesce(F.sum("n_rows"), F.lit(0))).first()[0]}
    finally:
        for folder in folders:
            discard(spark, folder)
