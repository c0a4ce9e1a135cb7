"""High-water marks: where the last load of a table stopped."""

from __future__ import annotations

import datetime
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tableferry.session import discard

# The fields of a stored mark.
MARK_SCHEMA = T.StructType(
    [
        T.StructField("table_name", T.StringType()),
        T.StructField("last_sync_time", T.TimestampNTZType()),
        T.StructField("last_sync_count", T.LongType()),
        T.StructField("status", T.StringType()),
        T.StructField("updated_at", T.TimestampNTZType()),
    ]
)
# A store also keeps a number that rises with every mark of a table, so that no clock decides
# which mark is the newest. ``updated_at`` is UTC.
STORED_SCHEMA = T.StructType([*MARK_SCHEMA.fields, T.StructField("version", T.LongType())])


def latest_marks(marks: DataFrame) -> DataFrame:
    """One row per table: its newest mark, by ``version`` where there is one, then by time."""
    facts = ["last_sync_time", "last_sync_count", "status", "updated_at"]
    newest = F.max_by(F.struct(*facts), _age(marks)).alias("newest")
    return marks.groupBy("table_name").agg(newest).select("table_name", "newest.*")


def _age(marks: DataFrame) -> Column:
    if "version" in marks.columns:
        return F.struct(F.coalesce("version", F.lit(0)), "updated_at")
    return F.struct("updated_at")


@dataclass(frozen=True)
class MarkStore:
    """Marks as an append-only parquet folder; one row per load."""

    path: str

    def all_marks(self, spark: SparkSession) -> DataFrame:
        try:
            return spark.read.schema(STORED_SCHEMA).parquet(self.path)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return _marks(spark, 0, None, None, 0, "", 0)

    def latest(self, spark: SparkSession) -> DataFrame:
        return latest_marks(self.all_marks(spark))

    def last_time(self, spark: SparkSession, table: str) -> datetime.datetime | None:
        """Where the next load starts: None before the first one and after a reset. A load
        recorded as failed does not move it."""
        marks = self.all_marks(spark)
        counting = F.col("status").isin("success", "reset") & (F.col("table_name") == table)
        newest = F.max_by("last_sync_time", _age(marks))
        return marks.where(counting).agg(newest).first()[0]

    def save(
        self,
        spark: SparkSession,
        table: str,
        last_sync_time: datetime.datetime | None,
        last_sync_count: int,
        status: str = "success",
    ) -> None:
        own = self.all_marks(spark).where(F.col("table_name") == table)
        version = 1 + own.agg(F.coalesce(F.max("version"), F.lit(0))).first()[0]
        row = _marks(spark, 1, table, last_sync_time, last_sync_count, status, version)
        row.coalesce(1).write.mode("append").parquet(self.path)

    def reset(self, spark: SparkSession, table: str) -> None:
        """Forget the marks of one table, so that its next load takes everything."""
        self.save(spark, table, None, 0, "reset")

    def compact(self, spark: SparkSession) -> None:
        """Keep, per table, the newest mark and the newest that counts for the next load. The
        kept marks are written before the old files go: cut off half-way, marks are there twice,
        which changes nothing."""
        marks = self.all_marks(spark)
        files = marks.inputFiles()
        counts = F.col("status").isin("success", "reset").alias("counts")
        whole = F.max_by(F.struct(*marks.columns), _age(marks)).alias("newest")
        kept = marks.groupBy("table_name", counts).agg(whole).select("newest.*").collect()
        if kept:
            spark.createDataFrame(kept, STORED_SCHEMA).coalesce(1).write.mode("append").parquet(self.path)
            for file in files:
                discard(spark, file)


def _marks(
    spark: SparkSession,
    n_rows: int,
    table: str | None,
    last_sync_time: datetime.datetime | None,
    last_sync_count: int,
    status: str,
    version: int,
) -> DataFrame:
    values = [
        table,
        last_sync_time.isoformat(sep=" ") if last_sync_time else None,
        last_sync_count,
        status,
        datetime.datetime.now(datetime.UTC).replace(tzinfo=None).isoformat(sep=" "),
        version,
    ]
    columns = [
        F.lit(value).cast(field.dataType).alias(field.name)
        for value, field in zip(values, STORED_SCHEMA.fields)
    ]
    return spark.range(n_rows).select(*columns)
