"""Tables kept as folders or files of one format below a root."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


@dataclass(frozen=True)
class FileStore:
    """``root/<table><suffix>`` in ``format``. Column pruning and filters reach the scan."""

    root: str
    format: str = "parquet"
    suffix: str = ""

    def path(self, table: str) -> str:
        return f"{self.root.rstrip('/')}/{table}{self.suffix}"

    def read(
        self, spark: SparkSession, table: str, columns: Sequence[str] | None = None
    ) -> DataFrame:
        df = spark.read.format(self.format).load(self.path(table))
        return df.select(*columns) if columns is not None else df

    def count(self, spark: SparkSession, table: str) -> DataFrame:
        """One row, ``n_rows``; no column is read."""
        return self.read(spark, table).agg(F.count(F.lit(1)).alias("n_rows"))

    def append(self, df: DataFrame, table: str) -> None:
        df.write.format(self.format).mode("append").save(self.path(table))

    def reload(self, df: DataFrame, table: str) -> None:
        """Replace all rows. The old ones go first, so a lost job leaves an incomplete table;
        ``load.staged_reload`` avoids that."""
        df.write.format(self.format).mode("overwrite").save(self.path(table))
