"""Cutting a table into key intervals, for parallel reads and exports."""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def key_bounds(df: DataFrame, key: str) -> tuple[int | None, int | None]:
    """Smallest and largest key: two numbers, as JDBC's ``lowerBound`` and ``upperBound``."""
    row = df.agg(F.min(key), F.max(key)).first()
    return row[0], row[1]


def interval_width(lower: int, upper: int, parts: int) -> int:
    return -(-(upper - lower + 1) // parts)


def equal_cuts(lower: int, upper: int, parts: int) -> list[int]:
    """First key of every interval but the first, for intervals of equal width."""
    width = interval_width(lower, upper, parts)
    return list(range(lower + width, upper + 1, width))


def split_number(key: str, lower: int, upper: int, parts: int) -> Column:
    """0-based number of the equal-width interval a key lies in; NULL keys go to the first."""
    width = interval_width(lower, upper, parts)
    return F.coalesce(F.expr(f"(`{key}` - {lower}) div {width}"), F.lit(0)).cast("int")


def bounded_split_number(key: str, lower: int, upper: int, parts: int) -> Column:
    """``split_number`` for keys that may lie outside: -1 below ``lower`` (and for NULL),
    ``parts`` above ``upper``."""
    inside = split_number(key, lower, upper, parts)
    value = F.col(key)
    return (
        F.when(value.isNull() | (value < lower), -1).when(value > upper, parts).otherwise(inside)
    )


# A scan filter names at most so many ranges; more are merged where the gaps are smallest.
SCAN_RANGES = 64


def either(tests: Sequence[Column]) -> Column:
    """OR of any number of tests, joined in pairs so that the expression stays shallow."""
    tests = list(tests) or [F.lit(False)]
    while len(tests) > 1:
        odd = tests[-1:] if len(tests) % 2 else []
        tests = [one | other for one, other in zip(tests[::2], tests[1::2])] + odd
    return tests[0]


def in_splits(key: str, lower: int, upper: int, parts: int, numbers: Sequence[int]) -> Column:
    """Rows of the given intervals. Ranges of the key filter the scan; where the numbers lie too
    scattered for few ranges, a set of the numbers decides among the rows these let through."""
    width, value = interval_width(lower, upper, parts), F.col(key)
    chosen = sorted(set(numbers))
    runs: list[list[int]] = []
    for number in (number for number in chosen if 0 <= number < parts):
        if runs and runs[-1][1] + 1 == number:
            runs[-1][1] = number
        else:
            runs.append([number, number])
    exact = len(runs) <= SCAN_RANGES
    if not exact:
        gaps = sorted(range(1, len(runs)), key=lambda i: runs[i][0] - runs[i - 1][1])
        kept = {0, *gaps[-(SCAN_RANGES - 1) :]}
        starts = sorted(kept)
        ends = [*starts[1:], len(runs)]
        runs = [[runs[first][0], runs[end - 1][1]] for first, end in zip(starts, ends)]
    tests = [
        value.between(lower + first * width, min(lower + (last + 1) * width - 1, upper))
        for first, last in runs
    ]
    if -1 in chosen:
        tests += [value.isNull(), value < lower]
    if parts in chosen:
        tests.append(value > upper)
    wanted = either(tests)
    return wanted if exact else wanted & bounded_split_number(key, lower, upper, parts).isin(chosen)


def balanced_cuts(df: DataFrame, key: str, parts: int, accuracy: int = 10000) -> list:
    """Like ``equal_cuts``, but each interval holds about as many rows: key gaps do not matter.

    One pass over the key column; ``parts`` numbers come back to the driver.
    """
    shares = [index / parts for index in range(1, parts)]
    if not shares:
        return []
    row = df.agg(F.percentile_approx(key, shares, accuracy)).first()
    return sorted(set(row[0] or []))


def range_predicates(key: str, cuts: Sequence) -> list[str]:
    """WHERE clauses that cover every row exactly once, for ``spark.read.jdbc(predicates=...)``."""
    if not cuts:
        return ["1 = 1"]
    cuts = [cut if isinstance(cut, (int, float, Decimal)) else f"'{cut}'" for cut in cuts]
    first = [f"({key} < {cuts[0]} OR {key} IS NULL)"]
    middle = [f"({key} >= {low} AND {key} < {high})" for low, high in zip(cuts, cuts[1:])]
    return first + middle + [f"{key} >= {cuts[-1]}"]


def spread_by_range(df: DataFrame, parts: int, key: str, *tie_breakers: str) -> DataFrame:
    """Partition a table by key interval, for one file per interval.

    Rows of one very frequent key would all fall into one interval; ``tie_breakers`` (by default
    a hash of the whole row) let Spark cut within that key.
    """
    if tie_breakers:
        return df.repartitionByRange(parts, key, *tie_breakers)
    return df.repartitionByRange(parts, F.col(key), F.xxhash64(*df.columns))
