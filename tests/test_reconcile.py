from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from tableferry.functions.text import exact_double_sql
from tableferry.operators import reconcile
from tableferry.operators.report import load_report, report_totals, write_report
from tableferry.operators.shape import conform_table
from tableferry.session import new_folder, written


def one_checksum(df, **options):
    return reconcile.table_checksums({"t": df}, **options).first()


def test_checksum_ignores_order_and_partitions(spark):
    rows = spark.range(1000).select("id", F.md5(F.col("id").cast("string")).alias("text"))
    turned = rows.orderBy(F.desc("id")).repartition(7)
    for typed in (False, True):
        assert one_checksum(rows, typed=typed) == one_checksum(turned, typed=typed)


def test_checksum_sees_changes_copies_and_nulls(spark):
    rows = spark.sql("SELECT * FROM VALUES (1, 'a', NULL), (2, NULL, 'a') AS t(id, x, y)")
    variants = [
        rows,
        rows.where("id = 1"),
        rows.unionAll(rows),
        rows.withColumn("x", F.col("y")).withColumn("y", F.lit(None).cast("string")),
        spark.sql("SELECT * FROM VALUES (1, 'a', '\\\\N'), (2, NULL, 'a') AS t(id, x, y)"),
        spark.sql("SELECT * FROM VALUES (1, 'a|1:a', NULL), (2, NULL, 'a') AS t(id, x, y)"),
        spark.sql("SELECT * FROM VALUES (2, 'a', NULL), (1, NULL, 'a') AS t(id, x, y)"),
    ]
    for typed in (False, True):
        sums = [one_checksum(df, typed=typed).checksum for df in variants]
        assert len(set(sums)) == len(sums)


def test_checksum_of_nothing_is_a_digest(spark):
    found = one_checksum(spark.range(0))
    assert found.n_rows == 0 and len(found.checksum) == 32


def test_conformed_booleans_match(spark):
    source = spark.sql("SELECT 1 AS id, true AS flag UNION ALL SELECT 2, NULL")
    target = spark.sql("SELECT 1 AS id, 1Y AS flag UNION ALL SELECT 2, NULL")
    for typed in (False, True):
        found = reconcile.reconcile_checksums(
            {"t": conform_table(source)}, {"t": target}, typed=typed
        )
        assert found.first().matched


def test_large_doubles_are_told_apart(spark):
    values = ["1e15D", "2e15D", "1e300D", "-1e300D", "double('NaN')", "double('Infinity')", "NULL"]
    sums = [one_checksum(spark.sql(f"SELECT CAST({v} AS DOUBLE) AS v")).checksum for v in values]
    assert len(set(sums)) == len(sums)


def test_counts_and_report(spark):
    ends = {"a": 100, "b": 100, "c": 0, "d": 5}, {"a": 100, "b": 90, "c": 0, "d": 0}
    source, target = [{k: spark.range(n) for k, n in end.items()} for end in ends]
    counts = reconcile.reconcile_counts(source, target)
    assert {row.table_name: row.matched for row in counts.collect()} == {
        "a": True, "b": False, "c": True, "d": False,
    }
    report = load_report(counts)
    assert {row.table_name: row.status for row in report.collect()} == {
        "a": "success", "b": "partial", "c": "skipped", "d": "failed",
    }
    folder = new_folder(spark, "report")
    write_report(report, folder)
    assert spark.read.json(folder).count() == 4
    totals = report_totals(report).first()
    assert (totals.n_tables, totals.failed, totals.total) == (4, 15, 205)
    assert float(totals.error_percent) == pytest.approx(15 / 205 * 100, abs=1e-4)


def statuses(source, target, keys, columns=None):
    found = reconcile.row_status(source, target, keys, columns).collect()
    return {tuple(row[name] for name in keys): row.status for row in found}


def test_row_status_of_every_kind(spark):
    source = spark.sql(
        """SELECT * FROM VALUES (1, 'a', 1.0D), (2, NULL, 2.0D), (3, 'c', double('NaN')),
           (4, 'd', 0.0D), (5, 'e', 5.0D), (6, 'f', 6.0D), (6, 'f', 6.0D), (NULL, 'n', 1.0D)
           AS t(id, x, y)"""
    )
    target = spark.sql(
        """SELECT * FROM VALUES (1, 'a', 1.0D), (2, '', 2.0D), (3, 'c', double('NaN')),
           (4, 'd', -0.0D), (6, 'f', 6.0D), (6, 'f', 6.0D), (7, 'g', 7.0D), (NULL, 'n', 1.0D)
           AS t(id, x, y)"""
    )
    assert statuses(source, target, ["id"]) == {
        (1,): "same", (2,): "changed", (3,): "same", (4,): "same", (5,): "missing",
        (6,): "duplicated", (7,): "extra", (None,): "same",
    }


def test_values_that_moved_between_null_columns_differ(spark):
    source = spark.sql("SELECT 1 AS id, 'v' AS x, CAST(NULL AS STRING) AS y")
    target = spark.sql("SELECT 1 AS id, CAST(NULL AS STRING) AS x, 'v' AS y")
    assert statuses(source, target, ["id"]) == {(1,): "changed"}


def test_types_are_brought_together(spark):
    source = spark.sql("SELECT 1 AS id, 5 AS n, 1.50BD AS d, DATE'2024-01-02' AS t, true AS b")
    target = spark.sql(
        "SELECT 1L AS id, 5L AS n, 1.5BD AS d, TIMESTAMP_NTZ'2024-01-02 00:00:00' AS t, 1Y AS b"
    )
    assert statuses(source, target, ["id"]) == {(1,): "same"}
    with pytest.raises(ValueError, match="not present"):
        reconcile.row_diff(source, target.drop("n"), ["id"])


def test_a_hot_key_is_one_row_and_multiplies_nothing(spark):
    hot = spark.range(30000).select(F.lit(1).alias("id"), F.lit("x").alias("v"))
    rest = spark.range(2, 60000).select(F.col("id").cast("int"), F.lit("x").alias("v"))
    rows = hot.unionAll(rest)
    found = reconcile.row_status(rows, rows, ["id"])
    assert found.count() == 59999
    top = found.where("id = 1").first()
    assert (top.status, top.n_source, top.n_target) == ("duplicated", 30000, 30000)
    assert reconcile.column_diff(rows, rows, ["id"]).first().n_compared == 59998


def test_column_diff_and_changed_values(spark):
    source = spark.range(100).select("id", F.lit("a").alias("x"), F.col("id").alias("y"))
    target = source.withColumn("y", F.when(F.col("id") % 10 == 0, None).otherwise(F.col("y")))
    found = {r.column_name: r.n_different for r in
             reconcile.column_diff(source, target, ["id"]).collect()}
    assert found == {"x": 0, "y": 10}
    diff = written(reconcile.row_diff(source, target, ["id"]), "diff")
    values = reconcile.changed_values(source, target, ["id"], diff).collect()
    assert sorted((r.id, r.column_name, r.source_value, r.target_value) for r in values) == [
        (n, "y", str(n), None) for n in range(0, 100, 10)
    ]


def test_multiset_diff_counts_copies(spark):
    source = spark.sql("SELECT * FROM VALUES ('a', 1), ('a', 1), ('b', NULL) AS t(x, n)")
    target = spark.sql("SELECT * FROM VALUES ('a', 1), ('b', NULL), ('c', 3) AS t(x, n)")
    suspects = written(reconcile.multiset_suspects(source, target), "suspects")
    found = reconcile.multiset_diff(source, target, suspects).collect()
    assert sorted(tuple(row) for row in found) == [("a", 1, 2, 1), ("c", 3, 0, 1)]


def test_odd_names_of_tables_and_columns(spark):
    rows = spark.sql("SELECT 1 AS row_hash, 2 AS h, 3 AS n_rows, 'x' AS `a b`")
    for typed in (False, True):
        found = reconcile.reconcile_checksums({"it's": rows}, {"it's": rows}, typed=typed).first()
        assert found.table_name == "it's" and found.matched
    other = rows.withColumn("a b", F.lit("y"))
    suspects = written(reconcile.multiset_suspects(rows, other), "suspects")
    assert reconcile.multiset_diff(rows, other, suspects).count() == 2


def test_sample_is_drawn_alike(spark):
    source = spark.range(5000).select((F.col("id") * 7).alias("id"), F.lit(1).alias("v"))
    target = source.repartition(5).where("id <> 35000 - 7")
    for options in ({"size": 100}, {"share": 0.5}):
        found = reconcile.sampled_checksums(
            {"t": source}, {"t": target}, {"t": ["id"]}, **options
        )
        assert found.first().matched == ("size" in options or not _sampled(spark, 34993, 0.5))
    last = reconcile.last_sampled_key(source, ["id"], 100)
    assert last[0] == 99 * 7
    assert reconcile.rows_up_to_key(source, ["id"], last).count() == 100


def _sampled(spark, key, share):
    row = spark.sql(f"SELECT CAST({key} AS BIGINT) AS id")
    return not reconcile.rows_by_key_share(row, ["id"], share).isEmpty()


def test_sample_with_two_part_and_null_keys(spark):
    rows = spark.sql(
        "SELECT * FROM VALUES (NULL, 1), (NULL, 2), (1, 1), (1, 2), (2, 1) AS t(a, b)"
    )
    for size in range(1, 6):
        last = reconcile.last_sampled_key(rows, ["a", "b"], size)
        assert reconcile.rows_up_to_key(rows, ["a", "b"], last).count() == size
    assert reconcile.last_sampled_key(rows.limit(0), ["a", "b"], 3) is None


def test_key_share_is_about_the_share(spark):
    n = reconcile.rows_by_key_share(spark.range(20000), ["id"], 0.25).count()
    assert 4500 < n < 5500


def test_row_diff_by_range_reads_only_what_differs(spark):
    source = spark.range(10, 5010).select("id", F.md5(F.col("id").cast("string")).alias("v"))
    target = (
        source.where("id <> 1000")
        .withColumn("v", F.when(F.col("id") == 3000, "x").otherwise(F.col("v")))
        .unionAll(spark.sql("SELECT 9999L, 'new' UNION ALL SELECT 3L, 'low'"))
        .unionAll(spark.sql("SELECT CAST(NULL AS BIGINT), 'null'"))
    )
    numbers, bounds = reconcile.differing_ranges(source, target, "id", 100)
    assert numbers == [-1, (1000 - 10) // 50, (3000 - 10) // 50, 100]
    assert bounds == (10, 5009)
    wanted = sorted(map(str, reconcile.row_diff(source, target, ["id"]).collect()))
    for parts in (1, 7, 100, 4000):
        found = reconcile.row_diff_by_range(source, target, "id", parts)
        assert sorted(map(str, found.collect())) == wanted
    assert reconcile.row_diff_by_range(source, source, "id").isEmpty()
    assert reconcile.row_diff_by_range(source.limit(0), target, "id").count() == target.count()


def test_ranges_see_rows_that_swapped_values(spark):
    source = spark.sql("SELECT * FROM VALUES (1L, 'a'), (2L, 'b') AS t(id, v)")
    target = spark.sql("SELECT * FROM VALUES (1L, 'b'), (2L, 'a') AS t(id, v)")
    assert reconcile.row_diff_by_range(source, target, "id", 1).count() == 2


def test_names_with_dots(spark):
    one = spark.sql("SELECT 1 AS `k.a`, 'x' AS `v.b`, 1 AS c UNION ALL SELECT 2, 'y', 2")
    two = spark.sql("SELECT 1 AS `k.a`, 'z' AS `v.b`, 1 AS c UNION ALL SELECT 2, 'y', 2")
    key = ["k.a"]
    diff = written(reconcile.row_diff(one, two, key), "diff")
    assert [(r["k.a"], r.status) for r in diff.collect()] == [(1, "changed")]
    assert {r.column_name: r.n_different for r in reconcile.column_diff(one, two, key).collect()} == {
        "v.b": 1, "c": 0,
    }
    values = reconcile.changed_values(one, two, key, diff).collect()
    assert [(r["k.a"], r.column_name, r.source_value, r.target_value) for r in values] == [(1, "v.b", "x", "z")]
    assert reconcile.sampled_row_diff(one, two, key).count() == 1
    assert reconcile.row_diff_by_range(one, two, "c").where("status <> 'same'").count() == 1
    suspects = written(reconcile.multiset_suspects(one, two), "suspects")
    assert reconcile.multiset_diff(one, two, suspects).count() == 2
    assert not reconcile.sampled_checksums({"t": one}, {"t": two}, {"t": key}, 1).first().matched


def test_checksums_are_exact_unless_told_otherwise(spark):
    base = spark.sql("SELECT 1 AS id, 1.5D AS v, TIMESTAMP_NTZ'2024-01-01 00:00:00' AS at")
    for column, text in (("v", "1.5000001D"), ("v", "1.0E15D"), ("at", "TIMESTAMP_NTZ'2024-01-01 00:00:00.000001'")):
        other = base.withColumn(column, F.expr(text))
        for typed in (False, True):
            assert not reconcile.reconcile_checksums({"t": base}, {"t": other}, typed=typed).first().matched
    near = base.withColumn("v", F.lit(1.5000001)).withColumn("at", F.expr("at + interval 1 microsecond"))
    assert reconcile.reconcile_checksums({"t": base}, {"t": near}, double_scale=4, micros=False).first().matched


@pytest.mark.parametrize(
    "value", [0.0, -0.0, 1.0, -1.5, 0.1, 1e-300, 5e-324, 2.2250738585072014e-308, 1e15, 1.7976931348623157e308,
              4503599627370496.0, 4503599627370495.5, 9007199254740993.0, 1 / 3, 1e23, 2.0**-44]
)
def test_exact_text_of_doubles(spark, value):
    found = spark.sql(f"SELECT {exact_double_sql(f'CAST({value!r} AS DOUBLE)')} AS t").first().t
    if value == 0:
        assert found == "0"
    else:
        whole, _, power = found.lstrip("-").partition("p")
        assert 2**52 <= int(whole) < 2**53 and found.startswith("-") == (value < 0)
        assert Fraction(int(whole)) * Fraction(2) ** int(power) == abs(Fraction(value))
