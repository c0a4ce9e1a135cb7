"""Loads that set misfits aside and stop past an error rate."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from tableferry.functions.text import quoted
from tableferry.functions.types import TYPE_MAP
from tableferry.operators.audits import misfits
from tableferry.operators.load import LoadRefused
from tableferry.operators.observed import Watch
from tableferry.operators.shape import conform_table
from tableferry.session import discard, new_folder
from tableferry.sources.files import FileStore
from tableferry.sources.jdbc import JdbcStore

REASONS = "reasons"


@dataclass(frozen=True)
class Outcome:
    """Rows read, rows that went on, rows set aside, and how many were set aside for what."""

    n_rows: int
    n_loaded: int
    n_bad: int
    by_reason: Mapping[str, int]

    @property
    def error_percent(self) -> float:
        return 100.0 * self.n_bad / self.n_rows if self.n_rows else 0.0


def load_with_quarantine(
    df: DataFrame,
    table: str,
    target: FileStore | JdbcStore,
    quarantine: FileStore,
    most_percent: float = 1.0,
    type_map: Mapping[str, str] = TYPE_MAP,
    keys: Sequence[str] = (),
    more: Mapping[str, Column] | None = None,
    append: bool = False,
) -> Outcome:
    """Load the rows that fit the target and set the others aside with the reasons.

    ``df`` carries its column descriptions (``types.describe``); the tests are those of
    ``audits.misfits`` and ``more``, tests on the source columns by name. One pass over the source
    writes every row once, misfits apart from the rest, in the source's own types, and counts both
    as it writes. If more than ``most_percent`` of the rows are misfits, nothing is loaded:
    ``LoadRefused`` names the figures, and the quarantine holds the misfits all the same. Else the
    rows that fit are conformed from the written copy, so what was tested is what is loaded.

    A repeated call replaces what an earlier one set aside; with ``append`` both tables grow.
    """
    spark = df.sparkSession
    reasons = misfits(df, type_map, keys)
    extra = [F.when(F.coalesce(test, F.lit(False)), F.lit(name)) for name, test in (more or {}).items()]
    if extra:
        reasons = F.concat(reasons, F.array_compact(F.array(*extra)))
    marked = df.select("*", reasons.alias(REASONS)).withColumn("_fits", F.size(REASONS) == 0)
    observation = Observation()
    counted = marked.observe(
        observation, F.count(F.lit(1)).alias("n_rows"), F.count_if(~F.col("_fits")).alias("n_bad")
    )
    folder = new_folder(spark, "quarantine-split")
    counted.write.partitionBy("_fits").parquet(folder)
    try:
        found = observation.get
        n_rows, n_bad = found.get("n_rows") or 0, found.get("n_bad") or 0
        # The schema also brings back the column descriptions, which files do not keep.
        split = spark.read.schema(marked.schema).parquet(folder)
        bad = split.where(~F.col("_fits")).select(*map(quoted, df.columns), REASONS)
        (quarantine.append if append else quarantine.reload)(bad, table)
        each = bad.select(F.explode(REASONS).alias("reason")).groupBy("reason").count()
        by_reason = {row["reason"]: row["count"] for row in each.collect()}
        if n_bad * 100 > most_percent * n_rows:
            raise LoadRefused(f"{table}: {n_bad} of {n_rows} rows do not fit, more than {most_percent} %: {by_reason}")
        fitting = split.where("_fits").select(*map(quoted, df.columns))
        good = conform_table(fitting, type_map)
        n_loaded = _loaded(good, table, target, append)
        if n_loaded is not None and n_loaded != n_rows - n_bad:
            raise LoadRefused(f"{table}: {n_loaded} rows written of {n_rows - n_bad}")
        return Outcome(n_rows, n_rows - n_bad, n_bad, by_reason)
    finally:
        discard(spark, folder)


def _loaded(good: DataFrame, table: str, target: FileStore | JdbcStore, append: bool) -> int | None:
    """Write the rows and count them as they are written (JDBC does not hand the count on)."""
    if isinstance(target, JdbcStore):
        (target.append if append else target.reload)(good, table)
        return None
    watch = Watch(good)
    (target.append if append else target.reload)(watch.rows, table)
    return watch.facts().n_rows
