"""Differences by invertible sketches, against the plain comparison."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tableferry.operators import reconcile, sketch_diff
from tableferry.queries.inputs import faulty_orders


@pytest.fixture(scope="module")
def orders(spark):
    return spark.read.parquet("/root/testdata/sf0.01/orders.parquet")


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_the_hash_is_sparks(spark):
    values = [0, 1, -1, 42, 2**63 - 1, -(2**63), 123456789012345]
    df = spark.createDataFrame([(v, w) for v in values for w in values], "k long, r long")
    found = df.selectExpr("k", "r", "xxhash64(k, r, 2L) AS h").collect()
    key, row = (np.array([r[c] for r in found], np.int64).astype(np.uint64) for c in "kr")
    assert sketch_diff._hash_of(key, row, 2).astype(np.int64).tolist() == [r["h"] for r in found]


@pytest.mark.parametrize("first_cells", [9, 300, 3 * 1024])
def test_as_row_diff(orders, first_cells):
    faulty = faulty_orders(orders)
    want = rows(reconcile.row_diff(orders, faulty, ["o_orderkey"]))
    assert len(want) > 800
    assert rows(sketch_diff.sketch_diff(orders, faulty, ["o_orderkey"], first_cells=first_cells)) == want


def test_a_small_difference_takes_one_pass_and_a_large_one_grows(orders):
    one = orders.where("o_orderkey <> 3")
    left, right = reconcile.comparable(orders, one, orders.columns)
    found = sketch_diff.differing_keys(left, right, ["o_orderkey"])
    assert found.passes == 1 and len(found.keys) == 1
    left, right = reconcile.comparable(orders, faulty_orders(orders), orders.columns)
    found = sketch_diff.differing_keys(left, right, ["o_orderkey"], 30)
    assert found.passes > 1 and found.cells > 900
    want = reconcile.row_diff(left, right, ["o_orderkey"]).count()
    assert len(found.keys) == want and found.cells < 16 * want


def test_equal_ends_and_empty_ends(spark, orders):
    none = orders.limit(0)
    assert sketch_diff.sketch_diff(orders, orders, ["o_orderkey"]).isEmpty()
    assert sketch_diff.sketch_diff(none, none, ["o_orderkey"]).isEmpty()
    few = orders.limit(40)
    assert rows(sketch_diff.sketch_diff(few, none, ["o_orderkey"])) == rows(reconcile.row_diff(few, none, ["o_orderkey"]))


def test_too_many_differences_are_compared_plainly(orders, monkeypatch):
    monkeypatch.setattr(sketch_diff, "MOST_DIFFERENCES", 100)
    faulty = faulty_orders(orders)
    left, right = reconcile.comparable(orders, faulty, orders.columns)
    assert sketch_diff.differing_keys(left, right, ["o_orderkey"], 30).keys is None
    assert rows(sketch_diff.sketch_diff(orders, faulty, ["o_orderkey"], first_cells=30)) == rows(
        reconcile.row_diff(orders, faulty, ["o_orderkey"])
    )


def test_keys_of_several_columns_nulls_and_repeated_rows(spark):
    schema = "a long, b string, c double"
    one = spark.createDataFrame([(1, "x", 1.0), (None, None, None), (2, "y", 2.0), (2, "y", 2.0), (3, "z", 3.0)], schema)
    other = spark.createDataFrame([(1, "x", 1.5), (None, None, 0.0), (2, "y", 2.0), (3, None, 3.0), (3, "z", 3.0)], schema)
    want = rows(reconcile.row_diff(one, other, ["a", "b"]))
    assert rows(sketch_diff.sketch_diff(one, other, ["a", "b"])) == want and len(want) == 4


def test_only_cells_are_shuffled(orders):
    for n in (1_000, 15_000):
        sums = sketch_diff.cell_sums(orders.where(F.col("o_orderkey") < n), ["o_orderkey"], 300, 4)
        plan = sums._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hashpartitioning") == 1
        assert "partial_sum" in plan[plan.index("Exchange"):] and "Join" not in plan
        assert sums.count() <= 300 + 4 * sketch_diff.STRATUM_CELLS


def test_elements_that_an_end_holds_several_times(spark):
    """Sums give them back with their number, where an XOR would lose every second one."""
    cells = sketch_diff.Cells.of(9, np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros((0, 4), np.int64))
    key, row = np.array([7], np.uint64) << np.uint64(33), np.array([2**64 - 5], np.uint64)
    words = np.array([[int(key[0]) >> 32, int(key[0]) & 0xFFFFFFFF, int(row[0]) >> 32, int(row[0]) & 0xFFFFFFFF]], np.int64)
    for cell in sketch_diff.places_of(key, row, 9):
        np.add.at(cells.n, cell, -4)
        np.add.at(cells.sums, cell, -4 * words)
    keys, found, n, whole = cells.peeled()
    assert whole and keys.tolist() == key.tolist() and found.tolist() == row.tolist() and n.tolist() == [-4]
