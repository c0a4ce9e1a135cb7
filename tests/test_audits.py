import pytest
from pyspark.sql import functions as F

from tableferry.functions.types import ColumnSpec, describe
from tableferry.operators import audits
from tableferry.session import new_folder, written
from tableferry.sources.csv_files import read_export


def test_primary_key_flags_copies_and_nulls(spark):
    rows = spark.sql("SELECT * FROM VALUES (1, 1), (1, 2), (2, 1), (NULL, 1) AS t(a, b)")
    found = audits.duplicate_keys(rows, ["a"]).collect()
    assert sorted((str(r.a), r.n_rows) for r in found) == [("1", 2), ("None", 1)]
    assert audits.duplicate_keys(rows, ["a", "b"]).first().a is None


def test_unique_key_lets_nulls_repeat_and_takes_a_predicate(spark):
    rows = spark.sql("SELECT * FROM VALUES (1, 'x'), (1, 'y'), (NULL, 'x'), (NULL, 'x') AS t(a, b)")
    assert audits.duplicate_keys(rows, ["a"], primary=False).count() == 1
    assert audits.duplicate_keys(rows, ["a"], "b = 'x'", primary=False).isEmpty()
    assert audits.duplicate_keys(rows, ["a"], F.col("b") == "y").isEmpty()


def test_usable_keys():
    assert audits.usable_keys(["id", "doc"], ["doc"]) == ["id"]


def test_orphans_with_a_hot_and_a_null_key(spark):
    child = spark.range(20000).select(F.lit(9).alias("p"), "id").unionAll(
        spark.sql("SELECT * FROM VALUES (1, 1L), (NULL, 2L), (8, 3L) AS t(p, id)")
    )
    parent = spark.sql("SELECT 1 AS k")
    orphans = audits.fk_orphans(child, ["p"], parent, ["k"])
    assert sorted(tuple(r) for r in orphans.collect()) == [(8, 1), (9, 20000)]
    rows = audits.fk_orphan_rows(child, ["p"], written(orphans, "orphans"))
    assert rows.count() == 20001


def test_two_part_foreign_key(spark):
    child = spark.sql("SELECT * FROM VALUES (1, 1), (1, 2), (1, NULL) AS t(a, b)")
    parent = spark.sql("SELECT 1 AS x, 1 AS y")
    found = audits.fk_orphans(child, ["a", "b"], parent, ["x", "y"]).collect()
    assert [tuple(r) for r in found] == [(1, 2, 1)]


def test_null_audit_needs_something_to_check(spark):
    with pytest.raises(ValueError, match="NOT NULL"):
        audits.null_audit(spark.sql("SELECT CAST(NULL AS INT) AS a"))


def test_fit_audit(spark):
    rows = spark.sql(
        """SELECT * FROM VALUES
           ('abcd', 123.4BD, TIMESTAMP_NTZ'1969-12-31 00:00:00', 12.5BD, 70000),
           ('äöü',  99.9BD,  TIMESTAMP_NTZ'2038-01-19 03:14:07.9', 12BD, 5),
           (NULL, NULL, NULL, NULL, NULL) AS t(s, d, t, u, i)"""
    )
    specs = [
        ColumnSpec("s", "character varying", length=3),
        ColumnSpec("d", "numeric", precision=3, scale=1),
        ColumnSpec("t", "timestamp without time zone"),
        ColumnSpec("u", "numeric"),
        ColumnSpec("i", "smallint"),
    ]
    found = {(r.column_name, r.rule): r.n_misfit for r in
             audits.fit_audit(describe(rows, specs)).collect()}
    assert found == {
        ("s", "too_long"): 1, ("d", "decimal_misfit"): 1, ("t", "timestamp_range"): 1,
        ("u", "unsized_decimal"): 1, ("i", "not_castable"): 1,
    }


HEX_ROWS = [
    ("1,0aFF", None), ("2,", None), ("3,abc", "odd_length"), ("4,\\x00", "prefix"),
    ("5,zz", "not_hex"), ("6,00,00", "arity"), ("7", "arity"), ("8,\\N", None), ("9,00", None),
    ('10,"0a"', None), ("11,zzz", "not_hex"),
]


@pytest.mark.parametrize("line_breaks", [True, False])
def test_hex_audit(spark, line_breaks):
    folder = new_folder(spark, "hex")
    spark.createDataFrame([(line,) for line, _ in HEX_ROWS], "line string").write.text(folder)
    texts = read_export(spark, folder, ["id", "data"], line_breaks=line_breaks)
    counted = audits.hex_audit(texts, ["data"]).first().asDict()
    faults = [fault for _, fault in HEX_ROWS if fault]
    assert counted.pop("total_rows") == len(HEX_ROWS)
    assert counted.pop("bad_rows") == len(faults)
    assert counted == {f"n_{f}": faults.count(f) for f in set(faults)}
    first = audits.hex_audit_samples(texts, ["data"], "id", max_errors=2).collect()
    assert [r.id for r in first] == ["11", "3"]
    plain = audits.hex_audit(texts, []).first()
    assert plain.bad_rows == plain.n_arity == faults.count("arity")


def test_names_with_dots(spark):
    rows = spark.sql("SELECT 1 AS `a.b`, CAST(NULL AS INT) AS `c.d` UNION ALL SELECT 1, 5")
    assert audits.duplicate_keys(rows, ["a.b"]).count() == 1
    assert {r.column_name: r.n_null for r in audits.null_audit(rows, ["a.b", "c.d"]).collect()} == {"a.b": 0, "c.d": 1}
    parent = spark.sql("SELECT 4 AS `p.q`")
    orphans = audits.fk_orphans(rows, ["c.d"], parent, ["p.q"])
    assert [r["c.d"] for r in orphans.collect()] == [5]
    assert audits.fk_orphan_rows(rows, ["c.d"], orphans).count() == 1


def test_not_null_holds_for_columns_that_are_there(spark):
    from pyspark.sql import types as T

    from tableferry.operators.shape import evolve_table

    rows = spark.sql("SELECT 1 AS a, CAST(NULL AS STRING) AS b")
    filled = T.StructType([T.StructField("a", T.IntegerType()), T.StructField("b", T.StringType(), False, {"source_type": "text", "default": "'x'"})])
    assert evolve_table(rows, filled).first().b == "x"
    bare = T.StructType([T.StructField("b", T.StringType(), False)])
    with pytest.raises(Exception, match="must not be NULL"):
        evolve_table(rows, bare).collect()
