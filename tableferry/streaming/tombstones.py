"""Deleted keys and the versions they were deleted at, so that late rows do not bring them back."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tableferry.functions.text import quoted
from tableferry.session import discard


@dataclass(frozen=True)
class TombstoneStore:
    """Keys and versions of one table's deleted rows, as an append-only parquet folder.

    A key may be noted several times; the highest version counts. ``forget`` bounds the store:
    it drops what is older than the oldest delivery that may still come.
    """

    path: str
    keys: Sequence[str]
    version: Sequence[str]

    def _names(self) -> list[str]:
        return [quoted(name) for name in dict.fromkeys([*self.keys, *self.version])]

    def rows(self, spark: SparkSession) -> DataFrame | None:
        """All notes, or None before the first."""
        try:
            return spark.read.parquet(self.path)
        except AnalysisException as error:
            if error.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
                raise
            return None

    def newest(self, spark: SparkSession) -> DataFrame | None:
        """One row per deleted key: ``_t0, _t1, ...`` and ``_buried``, its versions as a struct."""
        held = self.rows(spark)
        if held is None:
            return None
        names = [F.col(quoted(key)).alias(f"_t{i}") for i, key in enumerate(self.keys)]
        return held.groupBy(*names).agg(F.max(F.struct(*map(quoted, self.version))).alias("_buried"))

    def newer(self, stage: DataFrame, deleted: str | None = None) -> DataFrame:
        """The staged rows that are newer than the deletion of their key; a deletion that is as new
        passes as well, so that a repeated load finds it again."""
        buried = self.newest(stage.sparkSession)
        if buried is None:
            return stage
        same = reduce(
            Column.__and__, [F.col(quoted(key)) == F.col(f"_t{i}") for i, key in enumerate(self.keys)]
        )
        own = F.struct(*map(quoted, self.version))
        fits = F.col("_buried").isNull() | (own > F.col("_buried"))
        if deleted:
            fits = fits | (F.col(quoted(deleted)) & (own >= F.col("_buried")))
        names = [f"_t{i}" for i in range(len(self.keys))]
        return stage.join(buried, same, "left").where(fits).drop("_buried", *names)

    def bury(self, rows: DataFrame) -> None:
        """Note the keys and versions of deleted rows."""
        rows.select(*self._names()).write.mode("append").parquet(self.path)

    def forget(self, spark: SparkSession, before: Column) -> None:
        """Drop the notes for which ``before`` (a test on the version columns) is true, and the
        repeated ones. The kept ones are written before the old files go: cut off half-way, notes
        are there twice, which changes nothing."""
        held = self.rows(spark)
        if held is None:
            return
        files = held.inputFiles()
        kept = held.where(~F.coalesce(before, F.lit(False))).groupBy(*map(quoted, self.keys))
        newest = kept.agg(F.max(F.struct(*map(quoted, self.version))).alias("_newest"))
        versions = [F.col("_newest")[name].alias(name) for name in self.version if name not in self.keys]
        newest.select(*map(quoted, self.keys), *versions).write.mode("append").parquet(self.path)
        for file in files:
            discard(spark, file)
