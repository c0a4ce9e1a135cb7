"""Tables that change in one catalog step: generations behind a view.

A published table is a view on its newest generation, which is a table of its own. Publishing
writes and checks a new generation and then defines the view anew, in one statement: a reader finds
the old content or the new, never none. Generations that the view has left stay for readers that
began before, and for going back, until ``clean_generations`` drops them.
"""

from __future__ import annotations

import datetime
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession

from tableferry.functions.text import quoted
from tableferry.operators.audits import duplicate_keys
from tableferry.operators.load import LoadRefused

_MARK = "__g"


def _names(name: str) -> tuple[str, str]:
    """(database or nothing, with its dot; table) of a name."""
    database, dot, table = name.rpartition(".")
    return database + dot, table


def _generation(name: str, at: datetime.datetime) -> str:
    return f"{name}{_MARK}{at:%Y%m%d%H%M%S%f}"


def generations(spark: SparkSession, name: str) -> list[str]:
    """The generations of a published table that are kept, oldest first."""
    database, table = _names(name)
    place = f" IN {database.rstrip('.')}" if database else ""
    rows = spark.sql(f"SHOW TABLES{place} LIKE '{table.lower()}{_MARK}*'").collect()
    return sorted(database + row["tableName"] for row in rows if not row["isTemporary"])


def current_generation(spark: SparkSession, name: str) -> str | None:
    """The generation the view shows; None where nothing is published under the name."""
    if not spark.catalog.tableExists(name):
        return None
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").where("col_name = 'View Text'").collect()
    if not rows:
        raise ValueError(f"{name} is a table, not a view on generations; see adopt")
    return _names(name)[0] + rows[0]["data_type"].rpartition(" FROM ")[2].strip().rpartition(".")[2].strip("`")


def _show(spark: SparkSession, name: str, generation: str) -> None:
    columns = ", ".join(quoted(column) for column in spark.table(generation).columns)
    spark.sql(f"CREATE OR REPLACE VIEW {name} AS SELECT {columns} FROM {generation}")


def adopt(spark: SparkSession, name: str) -> str:
    """Make a plain table the first generation behind a view of its name. This alone takes two
    steps, between which the name is not there."""
    first = _generation(name, datetime.datetime.fromtimestamp(0))
    spark.sql(f"ALTER TABLE {name} RENAME TO {first}")
    _show(spark, name, first)
    return first


def publish(
    df: DataFrame,
    name: str,
    keys: Sequence[str],
    checks: Sequence[Callable[[DataFrame], None]] = (),
    after_swap: Sequence[Callable[[DataFrame], None]] = (),
) -> str:
    """Replace the content of ``name`` by a checked copy of ``df``; returns the new generation.

    The copy is written under a name of its own. Only if its keys are sound and every check passes
    (a check raises to refuse) is the view pointed to it; a refused copy is kept for inspection.
    Then the table is read under its own name: it must have the copy's columns and rows and pass
    every check of ``after_swap``, else the view goes back to the generation before.
    """
    spark = df.sparkSession
    before = current_generation(spark, name)
    new = _generation(name, datetime.datetime.now())
    df.write.format("parquet").saveAsTable(new)
    loaded = spark.table(new)
    if not duplicate_keys(loaded, keys).isEmpty():
        raise LoadRefused(f"{new}: key {list(keys)} is repeated or NULL")
    for check in checks:
        check(loaded)
    try:
        _show(spark, name, new)
        live = spark.table(name)
        if live.columns != loaded.columns or live.count() != loaded.count():
            raise LoadRefused(f"{name} is not what was staged")
        for check in after_swap:
            check(live)
    except Exception:
        if before:
            _show(spark, name, before)
        else:
            spark.sql(f"DROP VIEW IF EXISTS {name}")
        raise
    return new


def roll_back(spark: SparkSession, name: str, generation: str | None = None) -> str:
    """Show an earlier generation again, the one before the current by default; one step as well."""
    current = current_generation(spark, name)
    kept = generations(spark, name)
    if generation is None:
        earlier = [one for one in kept if current and one < current]
        if not earlier:
            raise LoadRefused(f"{name} has no earlier generation")
        generation = earlier[-1]
    elif generation not in kept:
        raise LoadRefused(f"{generation} is no generation of {name}")
    _show(spark, name, generation)
    return generation


def clean_generations(
    spark: SparkSession,
    name: str,
    keep: int = 1,
    grace: datetime.timedelta = datetime.timedelta(hours=1),
) -> list[str]:
    """Drop what the view has left: all but the current generation and the ``keep`` newest others,
    if their successor is older than ``grace``, so that readers had that long to finish. Copies
    that were refused go the same way. Returns the names dropped."""
    current, kept = current_generation(spark, name), generations(spark, name)
    others = [one for one in kept if one != current]
    limit = _generation(name, datetime.datetime.now() - grace).lower()
    dropped = []
    for one in others[: max(0, len(others) - keep)]:
        after = next((later for later in kept if later > one), None)
        if after is not None and after.lower() <= limit:
            spark.sql(f"DROP TABLE {one}")
            dropped.append(one)
    return dropped
