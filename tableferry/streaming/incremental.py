"""Loading what is newer than the mark, then moving the mark."""

from __future__ import annotations

import datetime
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tableferry.operators.load import dedupe_stage, upsert
from tableferry.session import discard, written_at
from tableferry.streaming.marks import MarkStore


def _moment(value: datetime.datetime) -> Column:
    return F.lit(value.isoformat(sep=" ")).cast("timestamp_ntz")


def newer_rows(
    source: DataFrame,
    changed_at: str,
    mark: datetime.datetime | None,
    until: datetime.datetime | None = None,
) -> DataFrame:
    """Rows from the mark on, the mark itself included: rows may share its moment, and loading
    one twice does no harm to an upsert. The range reaches the scan as a filter.

    Rows without a moment cannot be told old from new and are always taken along.
    """
    moment = F.col(changed_at)
    wanted = F.lit(True)
    if mark is not None:
        wanted = moment >= _moment(mark)
    if until is not None:
        wanted = wanted & (moment <= _moment(until))
    return source.where(wanted | moment.isNull())


def incremental_upsert(
    source: DataFrame,
    target: DataFrame,
    keys: Sequence[str],
    changed_at: str,
    mark: datetime.datetime | None,
) -> DataFrame:
    """New content of the target after one increment."""
    return upsert(target, newer_rows(source, changed_at, mark), keys, [changed_at])


def incremental_load(
    source: DataFrame,
    table: str,
    changed_at: str,
    marks: MarkStore,
    commit: Callable[[DataFrame], None],
    keys: Sequence[str] | None = None,
) -> int:
    """One increment: ``commit(stage)`` the rows from the mark on, then move the mark.

    The stage is written once; its newest moment becomes the mark, so rows that arrive meanwhile
    wait for the next load. The mark is moved last: after a failure in between the same rows are
    staged again, so ``commit`` must be an upsert (``load.upsert_partitions``). With ``keys`` the
    stage holds the newest row of each key only, and the upsert may take it as ``prepared``.
    Returns the rows staged.

    A large table is better brought over once as a whole (``load.create_partitioned``) and given
    its first mark by ``MarkStore.save``, since the first increment stages everything.
    """
    spark = source.sparkSession
    mark = marks.last_time(spark, table)
    rows = newer_rows(source, changed_at, mark)
    if keys:
        rows = dedupe_stage(rows, keys, [changed_at])
    stage, folder = written_at(rows, f"{table}-increment")
    try:
        newest, n_rows = stage.agg(
            F.max(changed_at).cast("timestamp_ntz"), F.count(F.lit(1))
        ).first()
        if n_rows:
            commit(stage)
            marks.save(spark, table, newest or mark, n_rows)
        return n_rows
    finally:
        discard(spark, folder)
