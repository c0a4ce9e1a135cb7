"""Differences between two ends by invertible sketches: no row and no key is shuffled.

Each end folds its rows into a table of cells. An element is the 64-bit hash of a row's key and
that of the whole row; it is added to one cell of each of three parts, chosen by its hash. A cell
holds the number of its elements and the sums of their words. The ends' cells are subtracted:
what both have goes away, and cells with one element left give it back. Taking it from its other
cells frees more of them, until all are zero and every element in which the ends differ is known.

Sums, not XOR: an element that one end holds more often stays there with its number.

How large the table must be is estimated by strata: elements are dealt by the leading zeros of a
hash, the n-th stratum getting 2**-n of them, into small tables of their own. The strata that can
be resolved tell the size of the difference. A small difference is resolved by the first pass
itself; else a table of the estimated size is made, and doubled while it cannot be resolved. Up
to ``MOST_DIFFERENCES`` this is the way, however large the ends; what differs in more is compared
by ``row_diff``. Cells, not rows, are shuffled, and their number does not depend on the table.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tableferry.functions.fingerprint import row_hash
from tableferry.operators.reconcile import comparable, row_diff

PARTS = 3
FIRST_CELLS = 3 * 1024
STRATA = 24
STRATUM_CELLS = 3 * 32
MOST_DIFFERENCES = 200_000

# The constants of 64-bit xxHash for one long, as the published algorithm has them.
_P1, _P2, _P3, _P4, _P5 = (
    np.uint64(p)
    for p in (0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5)
)


def _rotated(x: np.ndarray, by: int) -> np.ndarray:
    return (x << np.uint64(by)) | (x >> np.uint64(64 - by))


def hash_long(values: np.ndarray, seed: np.ndarray | int) -> np.ndarray:
    """xxHash of 64-bit values, as Spark's ``xxhash64`` has it for one bigint and a seed."""
    with np.errstate(over="ignore"):
        x = np.asarray(seed).astype(np.uint64) + _P5 + np.uint64(8)
        x = x ^ (_rotated(values.astype(np.uint64) * _P2, 31) * _P1)
        x = _rotated(x, 27) * _P1 + _P4
        x = (x ^ (x >> np.uint64(33))) * _P2
        x = (x ^ (x >> np.uint64(29))) * _P3
        return x ^ (x >> np.uint64(32))


def _hash_of(key: np.ndarray, row: np.ndarray, number: int) -> np.ndarray:
    """``xxhash64(key, row, number)`` of the elements."""
    seed = hash_long(row, hash_long(key, 42))
    return hash_long(np.full(len(key), number, np.uint64), seed)


_SUMS = ["key_high", "key_low", "row_high", "row_low"]


def cell_sums(df: DataFrame, keys: Sequence[str], cells: int, strata: int = 0) -> DataFrame:
    """``stratum, cell, n`` and the sums of the words of the elements in each cell.

    Stratum -1 is the table of ``cells`` cells; with ``strata`` the small tables are made as well.
    Every task adds up its own cells, so at most that many small rows per task are shuffled.
    """
    hashed = df.selectExpr(f"{row_hash(keys)} AS k", f"{row_hash(df.columns)} AS r")

    def places(stratum: str, size: int) -> list[str]:
        width = size // PARTS
        return [
            f"named_struct('stratum', {stratum}, 'cell', CAST({width * i} + pmod(xxhash64(k, r, {i}L), {width}) AS INT))"
            for i in range(PARTS)
        ]

    wanted = places("-1", cells)
    if strata:
        # The leading zeros of 23 bits of a hash of their own, at most strata - 1.
        level = f"least({strata - 1}, 23 - length(trim(LEADING '0' FROM bin(xxhash64(k, r, {PARTS}L) & 8388607))))"
        hashed = hashed.selectExpr("k", "r", f"CAST({level} AS INT) AS level")
        wanted += places("level", STRATUM_CELLS)
    placed = hashed.selectExpr("k", "r", f"inline(array({', '.join(wanted)}))")
    return placed.groupBy("stratum", "cell").agg(
        F.count(F.lit(1)).alias("n"),
        F.expr("sum(shiftrightunsigned(k, 32))").alias("key_high"),
        F.expr("sum(k & 4294967295L)").alias("key_low"),
        F.expr("sum(shiftrightunsigned(r, 32))").alias("row_high"),
        F.expr("sum(r & 4294967295L)").alias("row_low"),
    )


@dataclass
class Cells:
    """Subtracted cells of one table: counts and sums by cell number."""

    n: np.ndarray
    sums: np.ndarray

    @classmethod
    def of(cls, size: int, cell: np.ndarray, n: np.ndarray, sums: np.ndarray) -> Cells:
        made = cls(np.zeros(size, np.int64), np.zeros((size, len(_SUMS)), np.int64))
        np.add.at(made.n, cell, n)
        np.add.at(made.sums, cell, sums)
        return made

    def pure(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(cell, key, row, n) of the cells that hold one element, n times."""
        cell = np.flatnonzero(self.n)
        n, sums = self.n[cell], self.sums[cell]
        # One element: every sum is its word times n, and the words lead to this cell.
        words = sums // n[:, None]
        fits = (words * n[:, None] == sums).all(axis=1) & (words >= 0).all(axis=1) & (words < 1 << 32).all(axis=1)
        cell, n, words = cell[fits], n[fits], words[fits].astype(np.uint64)
        key = (words[:, 0] << np.uint64(32)) | words[:, 1]
        row = (words[:, 2] << np.uint64(32)) | words[:, 3]
        right = places_of(key, row, len(self.n))[cell // (len(self.n) // PARTS), np.arange(len(cell))] == cell
        return cell[right], key[right], row[right], n[right]

    def peeled(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, bool]:
        """(key, row, n) of the elements that could be taken out, and whether nothing is left."""
        keys, rows, numbers = [], [], []
        while True:
            _, key, row, n = self.pure()
            if not len(key):
                break
            # An element may stand alone in several cells.
            _, first = np.unique(np.stack([key, row]), axis=1, return_index=True)
            key, row, n = key[first], row[first], n[first]
            words = np.stack([key >> np.uint64(32), key & np.uint64(0xFFFFFFFF), row >> np.uint64(32), row & np.uint64(0xFFFFFFFF)], axis=1)
            for cell in places_of(key, row, len(self.n)):
                np.subtract.at(self.n, cell, n)
                np.subtract.at(self.sums, cell, words.astype(np.int64) * n[:, None])
            keys.append(key)
            rows.append(row)
            numbers.append(n)
            if sum(map(len, keys)) > 4 * len(self.n):
                break  # only chance could bring this about
        left = bool(self.n.any() or self.sums.any())
        joined = [np.concatenate(x) if x else np.zeros(0, np.int64) for x in (keys, rows, numbers)]
        return *joined, not left


def places_of(key: np.ndarray, row: np.ndarray, size: int) -> np.ndarray:
    """The cell of each element in each part, as ``cell_sums`` has them."""
    width = size // PARTS
    hashed = [_hash_of(key, row, i).astype(np.int64) % width for i in range(PARTS)]
    return np.stack([width * i + h for i, h in enumerate(hashed)])


@dataclass(frozen=True)
class Found:
    """What the sketches tell: the hashes of the keys that differ (None: too many), how many cells
    were needed at last, and how many passes were made over the ends."""

    keys: np.ndarray | None
    cells: int
    passes: int


def _subtracted(source: DataFrame, target: DataFrame, keys: Sequence[str], cells: int, strata: int):
    """Subtracted cells by stratum; at most the cells of the tables reach the driver."""
    ends = [cell_sums(source, keys, cells, strata), cell_sums(target, keys, cells, strata)]
    minus = [F.col(name) * -1 for name in ("n", *_SUMS)]
    both = ends[0].unionAll(ends[1].select("stratum", "cell", *minus))
    sums = [F.sum(name).alias(name) for name in ("n", *_SUMS)]
    unequal = both.groupBy("stratum", "cell").agg(*sums).where(" OR ".join(f"{name} <> 0" for name in ("n", *_SUMS)))
    rows = unequal.collect()
    held = np.array([[row[name] for name in ("stratum", "cell", "n", *_SUMS)] for row in rows], np.int64).reshape(-1, 7)
    out = {}
    for stratum in [-1, *range(strata)]:
        own = held[held[:, 0] == stratum]
        size = cells if stratum < 0 else STRATUM_CELLS
        out[stratum] = Cells.of(size, own[:, 1], own[:, 2], own[:, 3:])
    return out


def _estimated(tables: dict, strata: int) -> int:
    """Elements in which the ends differ, from the strata: those of the highest strata that can be
    resolved, scaled up by the share of all elements that these get."""
    n = 0
    for stratum in reversed(range(strata)):
        key, _, _, whole = tables[stratum].peeled()
        if not whole:
            # The strata above this one get 2**-(stratum + 1) of all elements.
            return max(n, 1) << (stratum + 1)
        n += len(key)
    return n


def differing_keys(
    source: DataFrame, target: DataFrame, keys: Sequence[str], first_cells: int = FIRST_CELLS
) -> Found:
    """Hashes (``row_hash`` of the keys) of the keys whose rows differ between the ends."""
    cells = -(-first_cells // PARTS) * PARTS
    tables = _subtracted(source, target, keys, cells, STRATA)
    key, _, _, whole = tables[-1].peeled()
    passes = 1
    if not whole:
        wanted = _estimated(tables, STRATA)
        # A third more cells than elements, and two, are enough nearly always.
        size = max(cells * 2, wanted * 3 // 2)
        while not whole:
            if size > 2 * MOST_DIFFERENCES:
                return Found(None, cells, passes)
            cells = -(-size // PARTS) * PARTS
            key, _, _, whole = _subtracted(source, target, keys, cells, 0)[-1].peeled()
            passes += 1
            size = cells * 2
    return Found(np.unique(key), cells, passes)


def sketch_diff(
    source: DataFrame,
    target: DataFrame,
    keys: Sequence[str],
    columns: Sequence[str] | None = None,
    first_cells: int = FIRST_CELLS,
) -> DataFrame:
    """``row_diff`` by sketches: the key, ``status``, ``n_source``, ``n_target`` of the keys that
    are not the same at both ends.

    The rows of the keys found are compared as ``row_diff`` does it; one more pass over the ends
    picks them by the hashes, which are at most ``MOST_DIFFERENCES``. A key that both ends repeat
    alike is no difference here (``row_diff`` names it ``duplicated``).
    """
    columns = list(columns or [name for name in source.columns if name not in keys])
    left, right = comparable(source, target, [*keys, *columns])
    found = differing_keys(left, right, keys, first_cells)
    if found.keys is None:
        return row_diff(left, right, keys, columns)
    spark = source.sparkSession
    hashes = spark.createDataFrame([(h,) for h in found.keys.astype(np.int64).tolist()], "_hash long")

    def picked(df: DataFrame) -> DataFrame:
        marked = df.withColumn("_hash", F.expr(row_hash(keys)))
        return marked.join(F.broadcast(hashes), "_hash", "left_semi").drop("_hash")

    return row_diff(picked(left), picked(right), keys, columns)
