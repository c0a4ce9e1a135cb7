"""Key, foreign key, NULL, fit and hex audits."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tableferry.functions.types import ColumnSpec, describe
from tableferry.operators import audits
from tableferry.queries.inputs import LINE_COLUMNS, faulty_orders, table
from tableferry.session import new_folder, written
from tableferry.sources.csv_files import read_export

LINE_KEY = ["l_orderkey", "l_linenumber"]


def duplicate_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audits.duplicate_keys(table(spark, sf_dir, "lineitem"), LINE_KEY)


def duplicate_keys_sound(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audits.duplicate_keys(table(spark, sf_dir, "orders"), ["o_orderkey"])


def duplicate_keys_partial(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem")
    return audits.duplicate_keys(lines, LINE_KEY, "l_returnflag = 'R'", primary=False)


def _lost_suppliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of which some name a supplier that does not exist, and some none."""
    key = F.col("l_suppkey")
    broken = F.when(F.col("l_partkey") % 53 == 0, key + 10000000).when(
        F.col("l_partkey") % 59 == 0, None
    )
    return table(spark, sf_dir, "lineitem").withColumn("l_suppkey", broken.otherwise(key))


def fk_orphans(spark: SparkSession, sf_dir: str) -> DataFrame:
    supplier = table(spark, sf_dir, "supplier")
    lines = _lost_suppliers(spark, sf_dir)
    return audits.fk_orphans(lines, ["l_suppkey"], supplier, ["s_suppkey"])


def fk_orphan_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    orphans = written(fk_orphans(spark, sf_dir), "orphans")
    lines = _lost_suppliers(spark, sf_dir)
    return audits.fk_orphan_rows(lines, ["l_suppkey"], orphans).select(*LINE_COLUMNS)


def null_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = faulty_orders(table(spark, sf_dir, "orders"))
    return audits.null_audit(orders, orders.columns)


def null_audit_declared(spark: SparkSession, sf_dir: str) -> DataFrame:
    specs = [
        ColumnSpec("doc_id", "bigint", nullable=False),
        ColumnSpec("text", "text", nullable=False),
        ColumnSpec("lang", "char", nullable=True),
    ]
    return audits.null_audit(describe(table(spark, sf_dir, "documents"), specs))


def fit_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    specs = [
        ColumnSpec("text", "character varying", length=1000),
        ColumnSpec("lang", "char"),
        ColumnSpec("source", "character varying(4)"),
        ColumnSpec("n_chars", "numeric", precision=4, scale=0),
    ]
    return audits.fit_audit(describe(table(spark, sf_dir, "documents"), specs))


def fit_audit_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    specs = [
        ColumnSpec("ts", "timestamp without time zone"),
        ColumnSpec("value", "numeric", precision=4, scale=1),
        ColumnSpec("amount", "numeric"),
        ColumnSpec("props", "xml", "xml"),
    ]
    events = table(spark, sf_dir, "events").select(
        "event_id",
        F.when(F.col("event_id") % 7 == 0, F.col("ts") + F.expr("interval 15 years"))
        .otherwise(F.col("ts")).alias("ts"),
        "value",
        F.col("value").cast("decimal(18,4)").alias("amount"),
        "props",
    )
    return audits.fit_audit(describe(events, specs))


def _faulty_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exported customers, the name as hex, with every kind of fault in the files."""
    key = F.col("c_custkey")
    hexed = F.lower(F.hex(F.col("c_name").cast("binary")))
    value = (
        F.when(key % 50 == 7, F.concat(F.lit("\\x"), hexed))
        .when(key % 50 == 11, F.concat(hexed, F.lit("a")))
        .when(key % 50 == 13, F.concat(F.lit("zz"), hexed))
        .when(key % 50 == 17, F.concat(hexed, F.lit(",more")))
        .when(key % 50 == 19, F.lit("\\N"))
        .when(key % 50 == 23, F.lit(""))
        .otherwise(hexed)
    )
    folder = new_folder(spark, "export")
    lines = F.concat_ws(",", key.cast("string"), value)
    table(spark, sf_dir, "customer").select(lines.alias("line")).write.text(folder)
    return read_export(spark, folder, ["c_custkey", "name_hex"], line_breaks=False)


def hex_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audits.hex_audit(_faulty_export(spark, sf_dir), ["name_hex"])


def hex_audit_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audits.hex_audit_samples(_faulty_export(spark, sf_dir), ["name_hex"], "c_custkey")


QUERIES = {
    "duplicate_keys": duplicate_keys,
    "duplicate_keys_sound": duplicate_keys_sound,
    "duplicate_keys_partial": duplicate_keys_partial,
    "fk_orphans": fk_orphans,
    "fk_orphan_rows": fk_orphan_rows,
    "null_audit": null_audit,
    "null_audit_declared": null_audit_declared,
    "fit_audit": fit_audit,
    "fit_audit_events": fit_audit_events,
    "hex_audit": hex_audit,
    "hex_audit_samples": hex_audit_samples,
}

_LOST = """
WITH lines AS (
  SELECT * REPLACE (CASE WHEN l_partkey % 53 = 0 THEN l_suppkey + 10000000
                         WHEN l_partkey % 59 = 0 THEN NULL ELSE l_suppkey END AS l_suppkey)
  FROM lineitem)
"""
_ORPHAN = "l_suppkey IS NOT NULL AND l_suppkey NOT IN (SELECT s_suppkey FROM supplier)"
_FAULTS = """
WITH hexed AS (SELECT c_custkey, lower(hex(encode(c_name))) AS h FROM customer),
rows_read AS (
  SELECT c_custkey::VARCHAR AS c_custkey,
         CASE c_custkey % 50 WHEN 7 THEN '\\x' || h WHEN 11 THEN h || 'a'
              WHEN 13 THEN 'zz' || h WHEN 19 THEN NULL WHEN 23 THEN NULL ELSE h END AS name_hex,
         CASE c_custkey % 50 WHEN 7 THEN 'prefix' WHEN 11 THEN 'odd_length'
              WHEN 13 THEN 'not_hex' WHEN 17 THEN 'arity' END AS fault
  FROM hexed)
"""


def _nulls_sql(source: str, names: list[str]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{name}' AS column_name, count(*) AS n_rows, "
        f"count(*) FILTER ({name} IS NULL) AS n_null FROM {source}"
        for name in names
    )


def _misfits_sql(source: str, tests: list[tuple[str, str, str]]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{name}' AS column_name, '{rule}' AS rule, count(*) AS n_rows, "
        f"count(*) FILTER ({test}) AS n_misfit FROM {source}"
        for name, rule, test in tests
    )


SQL = {
    "duplicate_keys": """
        SELECT l_orderkey, l_linenumber, count(*) AS n_rows FROM lineitem
        GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1""",
    "duplicate_keys_sound": """
        SELECT o_orderkey, count(*) AS n_rows FROM orders
        GROUP BY o_orderkey HAVING count(*) > 1""",
    "duplicate_keys_partial": """
        SELECT l_orderkey, l_linenumber, count(*) AS n_rows FROM lineitem
        WHERE l_returnflag = 'R' GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1""",
    "fk_orphans": _LOST
    + f"SELECT l_suppkey, count(*) AS n_rows FROM lines WHERE {_ORPHAN} GROUP BY l_suppkey",
    "fk_orphan_rows": _LOST
    + f"SELECT {', '.join(LINE_COLUMNS)} FROM lines WHERE {_ORPHAN}",
    "null_audit": """
        WITH faulty AS (
          SELECT CASE WHEN o_orderkey % 83 = 0 THEN NULL ELSE o_orderstatus END AS o_orderstatus,
                 o_orderkey, o_custkey, o_totalprice, o_orderdate, o_orderpriority
          FROM orders WHERE o_orderkey % 97 <> 0
          UNION ALL
          SELECT o_orderstatus, o_orderkey, o_custkey, o_totalprice, o_orderdate, o_orderpriority
          FROM orders WHERE o_orderkey % 101 = 0)
        """
    + _nulls_sql(
        "faulty",
        ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate",
         "o_orderpriority"],
    ),
    "null_audit_declared": _nulls_sql("documents", ["doc_id", "text"]),
    "fit_audit": _misfits_sql(
        "documents",
        [
            ("text", "too_long", "length(text) > 1000"),
            ("lang", "too_long", "length(lang) > 1"),
            ("source", "too_long", "length(source) > 4"),
            ("n_chars", "decimal_misfit",
             "n_chars IS NOT NULL AND TRY_CAST(n_chars AS DECIMAL(4,0)) IS NULL"),
        ],
    ),
    "fit_audit_events": """
        WITH shifted AS (
          SELECT CASE WHEN event_id % 7 = 0 THEN ts + INTERVAL 15 YEAR ELSE ts END AS ts,
                 value, CAST(value AS DECIMAL(18,4)) AS amount, props FROM events)
        """
    + _misfits_sql(
        "shifted",
        [
            ("ts", "timestamp_range",
             "ts < TIMESTAMP '1970-01-01 00:00:01' OR ts >= TIMESTAMP '2038-01-19 03:14:08'"),
            ("value", "decimal_misfit",
             "value IS NOT NULL AND (TRY_CAST(value AS DECIMAL(4,1)) IS NULL "
             "OR TRY_CAST(value AS DECIMAL(4,1))::DOUBLE <> value)"),
            ("amount", "unsized_decimal",
             "amount IS NOT NULL AND (TRY_CAST(amount AS DECIMAL(10,0)) IS NULL "
             "OR TRY_CAST(amount AS DECIMAL(10,0)) <> amount)"),
            ("props", "unmapped", "props IS NOT NULL"),
        ],
    ),
    "hex_audit": _FAULTS
    + """
        SELECT count(*) AS total_rows, count(fault) AS bad_rows,
               count(*) FILTER (fault = 'arity') AS n_arity,
               count(*) FILTER (fault = 'prefix') AS n_prefix,
               count(*) FILTER (fault = 'odd_length') AS n_odd_length,
               count(*) FILTER (fault = 'not_hex') AS n_not_hex
        FROM rows_read""",
    "hex_audit_samples": _FAULTS
    + """
        SELECT c_custkey, fault, name_hex FROM rows_read WHERE fault IS NOT NULL
        ORDER BY c_custkey, fault LIMIT 20""",
}
