"""Ranges over keys of several columns and of any ordered type, text included.

A key is compared column by column, NULL before any value, as Spark orders rows. Cuts are key
values drawn from a sample, so every range holds about as many rows, however the keys are spread.
"""

from __future__ import annotations

import datetime
import json
from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tableferry.functions.text import quoted

Key = tuple

# Sampled keys per range: the size of a range then varies by about a twentieth.
SAMPLED = 400


def _plain(value: object) -> object:
    if value is None or isinstance(value, (str, int, float, Decimal, datetime.date)):
        return value
    raise TypeError(f"no range over values like {value!r}")


def key_cuts(df: DataFrame, keys: Sequence[str], parts: int, seed: int = 1) -> list[Key]:
    """First key of every range but the first, in order; at most ``parts - 1``.

    Two reads of the key columns: a count (files answer it from their footers) and a sample of
    about ``SAMPLED`` keys a range, of which every ``SAMPLED``-th comes to the driver. A key that
    repeats very often is never cut, so it may leave fewer and larger ranges.
    """
    names = [quoted(name) for name in keys]
    wanted = SAMPLED * parts
    total = df.count()
    if parts < 2 or total < 2:
        return []
    held = df.select(*names)
    if total > wanted:
        held = held.sample(fraction=wanted / total, seed=seed)
    # The sample is bounded by the ranges asked for, not by the table.
    order = Window.orderBy(*[F.col(name).asc_nulls_first() for name in names])
    place = (F.row_number().over(order) - 1).alias("_place")
    part = F.floor(F.col("_place") * parts / F.count(F.lit(1)).over(Window.partitionBy()))
    ranked = held.select(*names, place).withColumn("_part", part)
    opens = F.col("_part") > F.lag("_part", 1, 0).over(Window.orderBy("_place"))
    rows = ranked.withColumn("_opens", opens).where("_opens").select(*names).distinct().collect()
    return sorted((tuple(map(_plain, row)) for row in rows), key=_rank)


def _rank(key: Key) -> tuple:
    return tuple((value is not None, _bytes(value) if isinstance(value, str) else value) for value in key)


def _bytes(text: str) -> bytes:
    """Spark orders texts by their UTF-8 bytes."""
    return text.encode("utf-8", "surrogatepass")


def _tests(value: Column, bound: object) -> tuple[Column, Column, Column]:
    """(less, equal, greater) than ``bound``, never NULL; NULL is less than any value."""
    if bound is None:
        return F.lit(False), value.isNull(), value.isNotNull()
    known, no = F.lit(bound), F.lit(False)
    if isinstance(bound, datetime.datetime):
        known = F.lit(bound.isoformat(sep=" ")).cast("timestamp_ntz")
    return (
        value.isNull() | F.coalesce(value < known, no),
        F.coalesce(value == known, no),
        F.coalesce(value > known, no),
    )


def before(keys: Sequence[str], bound: Key) -> Column:
    """Whether a row's key comes before ``bound``."""
    found, same = F.lit(False), F.lit(True)
    for name, value in zip(keys, bound):
        less, equal, _ = _tests(F.col(quoted(name)), value)
        found, same = found | (same & less), same & equal
    return found


def in_key_range(keys: Sequence[str], low: Key | None, high: Key | None) -> Column:
    """Rows from ``low`` on and before ``high``; None is an open end.

    The bounds of the leading column stand in front as plain comparisons, which reach the scan.
    """
    lead = F.col(quoted(keys[0]))
    wanted = F.lit(True)
    if low is not None:
        if low[0] is not None:
            wanted = wanted & (lead >= F.lit(low[0]))
        wanted = wanted & ~before(keys, low)
    if high is not None:
        wanted = wanted & (lead.isNull() if high[0] is None else lead.isNull() | (lead <= F.lit(high[0])))
        wanted = wanted & before(keys, high)
    return wanted


def key_ranges(cuts: Sequence[Key]) -> list[tuple[Key | None, Key | None]]:
    """(low, high) of the ranges between the cuts; together they hold every row once."""
    ends = [None, *cuts, None]
    return list(zip(ends[:-1], ends[1:]))


def range_number(keys: Sequence[str], cuts: Sequence[Key]) -> Column:
    """0-based number of the range a row's key is in, found by halving."""

    def within(low: int, high: int) -> Column:
        if low == high:
            return F.lit(low)
        middle = (low + high + 1) // 2
        return F.when(before(keys, cuts[middle - 1]), within(low, middle - 1)).otherwise(within(middle, high))

    return within(0, len(cuts))


def key_text(key: Key | None) -> str | None:
    """A cut as JSON, for a table that keeps it. Numbers beyond JSON's, dates and moments are texts."""
    if key is None:
        return None
    return json.dumps([v if v is None or isinstance(v, (int, float, str)) and not isinstance(v, bool) else str(v) for v in key])


def key_from_text(text: str | None, types: Sequence[T.DataType]) -> Key | None:
    """The cut again, in values that compare with columns of these types."""
    if text is None:
        return None
    return tuple(_value(value, kind) for value, kind in zip(json.loads(text), types))


def _value(value: object, kind: T.DataType) -> object:
    if value is None:
        return None
    if isinstance(kind, T.DecimalType):
        return Decimal(value)
    if isinstance(kind, T.DateType):
        return datetime.date.fromisoformat(value)
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return datetime.datetime.fromisoformat(value)
    return value
