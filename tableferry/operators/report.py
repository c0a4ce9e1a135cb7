"""Outcome of a load, table by table and in total."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

STATUSES = ["success", "partial", "failed", "skipped"]


def load_report(counts: DataFrame) -> DataFrame:
    """``table_name, status, migrated, failed, total`` from ``reconcile.reconcile_counts``, and
    ``message`` where the counts come with one (``migration.validate``).

    ``skipped``: nothing to load. ``failed``: rows to load and none arrived, no such table at the
    target, or a message. ``partial``: some are missing, or rows arrived that the source does not
    have.
    """
    noted = "message" in counts.columns
    broken = F.col("message").isNotNull() if noted else F.lit(False)
    total = F.coalesce("source_count", F.lit(0))
    arrived = F.coalesce("target_count", F.lit(0))
    status = (
        F.when(broken, "failed")
        .when((total == 0) & (arrived == 0), "skipped")
        .when(arrived == 0, "failed")
        .when(total == arrived, "success")
        .otherwise("partial")
    )
    return counts.select(
        "table_name",
        status.alias("status"),
        F.least(arrived, total).alias("migrated"),
        F.greatest(total - arrived, F.lit(0)).cast("bigint").alias("failed"),
        total.alias("total"),
        *(["message"] if noted else []),
    )


def report_totals(report: DataFrame) -> DataFrame:
    """One row: tables by status, rows, and the error rate in percent."""
    per_status = [F.count_if(F.col("status") == name).alias(f"n_{name}") for name in STATUSES]
    rate = F.sum("failed") * F.lit(100) / F.nullif(F.sum("total"), F.lit(0))
    return report.agg(
        F.count(F.lit(1)).alias("n_tables"),
        *per_status,
        F.sum("migrated").alias("migrated"),
        F.sum("failed").alias("failed"),
        F.sum("total").alias("total"),
        F.coalesce(rate, F.lit(0)).cast("decimal(9,4)").alias("error_percent"),
    )


def write_report(report: DataFrame, path: str, format: str = "json") -> None:
    """Write a report (one row per table) as a single file."""
    report.coalesce(1).write.format(format).mode("overwrite").save(path)
