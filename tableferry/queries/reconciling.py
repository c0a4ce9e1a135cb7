"""Counts, checksums and differences of the test tables and their faulty copies."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tableferry.operators import reconcile
from tableferry.operators.report import load_report, report_totals
from tableferry.operators.sketch_diff import sketch_diff
from tableferry.queries.inputs import (
    CUSTOMER_MD5,
    FAULTY_LINEITEM,
    FAULTY_ORDERS,
    LINE_COLUMNS,
    LINEITEM_MD5,
    ORDERS_MD5,
    checksum_sql,
    faulty_lineitem,
    faulty_orders,
    plain_sql,
    table,
)
from tableferry.session import written

KEY = ["o_orderkey"]
COUNTED = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings",
]
SAMPLE_ROWS = 1000
SAMPLE_SHARE = 0.25


def _sources(spark: SparkSession, sf_dir: str, names: list[str]) -> dict[str, DataFrame]:
    return {name: table(spark, sf_dir, name) for name in names}


def _ends(spark: SparkSession, sf_dir: str) -> tuple[dict, dict]:
    """Five tables: one intact, two faulty, one that arrived empty, one that is not there."""
    sources = _sources(spark, sf_dir, ["customer", "orders", "lineitem", "supplier", "part"])
    targets = {
        "customer": sources["customer"],
        "orders": faulty_orders(sources["orders"]),
        "lineitem": faulty_lineitem(sources["lineitem"]),
        "supplier": sources["supplier"].where("s_suppkey IS NULL"),
    }
    return sources, targets


def _orders(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    orders = table(spark, sf_dir, "orders")
    return orders, faulty_orders(orders)


def table_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reconcile.table_counts(_sources(spark, sf_dir, COUNTED))


def reconcile_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reconcile.reconcile_counts(*_ends(spark, sf_dir))


def report_of_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load_report(reconcile_counts(spark, sf_dir))


def totals_of_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report_totals(report_of_load(spark, sf_dir))


def reconcile_checksum(spark: SparkSession, sf_dir: str) -> DataFrame:
    sources, targets = _ends(spark, sf_dir)
    names = ["customer", "orders", "lineitem"]
    return reconcile.reconcile_checksums(
        {name: sources[name] for name in names}, {name: targets[name] for name in names}
    )


def sampled_checksum(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders, faulty = _orders(spark, sf_dir)
    return reconcile.sampled_checksums(
        {"orders": orders}, {"orders": faulty}, {"orders": KEY}, SAMPLE_ROWS
    )


def sampled_checksum_by_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders, faulty = _orders(spark, sf_dir)
    return reconcile.sampled_checksums(
        {"orders": orders}, {"orders": faulty}, {"orders": KEY}, share=SAMPLE_SHARE
    )


def row_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reconcile.row_diff(*_orders(spark, sf_dir), KEY)


def row_diff_by_sketch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """By sketches that are too small at first and have to grow."""
    return sketch_diff(*_orders(spark, sf_dir), KEY, first_cells=96)


def row_diff_by_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reconcile.row_diff_by_range(*_orders(spark, sf_dir), KEY[0])


def row_diff_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reconcile.row_diff_summary(*_orders(spark, sf_dir), KEY)


def row_diff_repeated_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    lineitem = table(spark, sf_dir, "lineitem")
    return reconcile.row_diff_summary(
        lineitem, faulty_lineitem(lineitem), ["l_orderkey", "l_linenumber"]
    )


def column_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reconcile.column_diff(*_orders(spark, sf_dir), KEY)


def changed_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders, faulty = _orders(spark, sf_dir)
    diff = written(reconcile.row_diff(orders, faulty, KEY), "row-diff")
    return reconcile.changed_values(orders, faulty, KEY, diff)


def multiset_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    lineitem = table(spark, sf_dir, "lineitem")
    faulty = faulty_lineitem(lineitem)
    suspects = written(reconcile.multiset_suspects(lineitem, faulty), "suspects")
    return reconcile.multiset_diff(lineitem, faulty, suspects)


def fingerprint_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    lineitem = table(spark, sf_dir, "lineitem")
    return reconcile.fingerprint_diff(lineitem, faulty_lineitem(lineitem))


def typed_checksum(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether the typed checksums agree; their values are Spark's own."""
    sources, targets = _ends(spark, sf_dir)
    names = ["customer", "orders", "lineitem"]
    found = reconcile.reconcile_checksums(
        {name: sources[name] for name in names},
        {name: targets[name] for name in names},
        typed=True,
    )
    return found.select("table_name", "matched")


def checksum_precision(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Checksums of events against copies in which one microsecond, or one millionth of one value,
    or nothing differs; exact by default, and at the precision of seconds and four places."""
    events = table(spark, sf_dir, "events")
    one = F.col("event_id") == F.lit(events.agg(F.min("event_id")).first()[0])
    later = F.when(one, F.col("ts") + F.expr("interval 1 microsecond")).otherwise(F.col("ts"))
    more = F.when(one, F.col("value") + 1e-6).otherwise(F.col("value"))
    copies = {
        "same": events, "moment": events.withColumn("ts", later), "value": events.withColumn("value", more),
    }
    sources = dict.fromkeys(copies, events)
    exact = reconcile.reconcile_checksums(sources, copies).select("table_name", "matched")
    typed = reconcile.reconcile_checksums(sources, copies, typed=True)
    return exact.join(typed.select("table_name", F.col("matched").alias("typed_matched")), "table_name")


def sampled_short_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A sample larger than the source, whose target has further rows behind its last key."""
    parts = table(spark, sf_dir, "part")
    ends = [{"part": parts.where(f"p_partkey <= {n}")} for n in (50, 70)]
    found = reconcile.sampled_checksums(*ends, {"part": ["p_partkey"]}, SAMPLE_ROWS)
    return found.select("table_name", "matched")


QUERIES = {
    "table_counts": table_counts,
    "reconcile_counts": reconcile_counts,
    "load_report": report_of_load,
    "load_report_totals": totals_of_load,
    "reconcile_checksum": reconcile_checksum,
    "reconcile_checksum_typed": typed_checksum,
    "sampled_checksum": sampled_checksum,
    "sampled_checksum_by_key": sampled_checksum_by_key,
    "sampled_checksum_short_source": sampled_short_source,
    "checksum_precision": checksum_precision,
    "row_diff": row_diff,
    "row_diff_by_sketch": row_diff_by_sketch,
    "row_diff_by_range": row_diff_by_range,
    "row_diff_summary": row_diff_summary,
    "row_diff_repeated_keys": row_diff_repeated_keys,
    "column_diff": column_diff,
    "changed_values": changed_values,
    "multiset_diff": multiset_diff,
    "multiset_diff_fingerprints": fingerprint_diff,
}

_COUNTS = f"""
WITH {FAULTY_ORDERS}, {FAULTY_LINEITEM},
counts AS (
  SELECT 'customer' AS table_name, (SELECT count(*) FROM customer) AS source_count,
         (SELECT count(*) FROM customer) AS target_count
  UNION ALL
  SELECT 'orders', (SELECT count(*) FROM orders), (SELECT count(*) FROM faulty_orders)
  UNION ALL
  SELECT 'lineitem', (SELECT count(*) FROM lineitem), (SELECT count(*) FROM faulty_lineitem)
  UNION ALL
  SELECT 'supplier', (SELECT count(*) FROM supplier), 0
  UNION ALL
  SELECT 'part', (SELECT count(*) FROM part), NULL),
report AS (
  SELECT table_name,
         CASE WHEN coalesce(source_count, 0) = 0 AND coalesce(target_count, 0) = 0 THEN 'skipped'
              WHEN coalesce(target_count, 0) = 0 THEN 'failed'
              WHEN source_count = target_count THEN 'success' ELSE 'partial' END AS status,
         least(coalesce(target_count, 0), coalesce(source_count, 0)) AS migrated,
         greatest(coalesce(source_count, 0) - coalesce(target_count, 0), 0) AS failed,
         coalesce(source_count, 0) AS total
  FROM counts)
"""

_ROW_STATUS = f"""
WITH {FAULTY_ORDERS},
pairs AS (
  SELECT coalesce(s.o_orderkey, t.o_orderkey) AS o_orderkey,
         CASE WHEN t.o_orderkey IS NULL THEN 'missing'
              WHEN s.o_orderkey IS NULL THEN 'extra'
              WHEN s.o_custkey IS NOT DISTINCT FROM t.o_custkey
               AND s.o_orderstatus IS NOT DISTINCT FROM t.o_orderstatus
               AND s.o_totalprice IS NOT DISTINCT FROM t.o_totalprice
               AND s.o_orderdate IS NOT DISTINCT FROM t.o_orderdate
               AND s.o_orderpriority IS NOT DISTINCT FROM t.o_orderpriority
              THEN 'same' ELSE 'changed' END AS status,
         CASE WHEN s.o_orderkey IS NULL THEN 0 ELSE 1 END::BIGINT AS n_source,
         CASE WHEN t.o_orderkey IS NULL THEN 0 ELSE 1 END::BIGINT AS n_target
  FROM orders s FULL OUTER JOIN faulty_orders t ON s.o_orderkey = t.o_orderkey)
"""

_COMPARED = ["o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]
_SHOWN = {
    "o_custkey": "{0}::VARCHAR",
    "o_orderstatus": "{0}",
    "o_totalprice": "{0}::VARCHAR",
    "o_orderdate": "strftime({0}, '%Y-%m-%d %H:%M:%S.%f')",
    "o_orderpriority": "{0}",
}
_JOINED = "FROM orders s JOIN faulty_orders t ON s.o_orderkey = t.o_orderkey"


def _sampled_sql(source: str, target: str) -> str:
    return f"""
    WITH {FAULTY_ORDERS}, s AS ({source}), t AS ({target}),
    sums AS (SELECT ({checksum_sql(ORDERS_MD5, "s")}) AS source_checksum,
                    ({checksum_sql(ORDERS_MD5, "t")}) AS target_checksum)
    SELECT 'orders' AS table_name, source_checksum, target_checksum,
           source_checksum = target_checksum AS matched FROM sums"""


def _checksum_row(name: str, source: str, target: str, fingerprint: str) -> str:
    return f"""
    SELECT '{name}' AS table_name, s.checksum AS source_checksum, t.checksum AS target_checksum,
           s.checksum = t.checksum AS matched
    FROM ({checksum_sql(fingerprint, source)}) s, ({checksum_sql(fingerprint, target)}) t"""


_KEY_WORD = f"('0x' || substr(md5({plain_sql('o_orderkey')}), 1, 8))::BIGINT"
_SHARE_LIMIT = int(SAMPLE_SHARE * (1 << 32))
_LINES = ", ".join(LINE_COLUMNS)

SQL = {
    "table_counts": " UNION ALL ".join(
        f"SELECT '{name}' AS table_name, count(*) AS n_rows FROM {name}" for name in COUNTED
    ),
    "reconcile_counts": _COUNTS + """
        SELECT table_name, source_count, target_count,
               coalesce(source_count = target_count, FALSE) AS matched FROM counts""",
    "load_report": _COUNTS + "SELECT table_name, status, migrated, failed, total FROM report",
    "load_report_totals": _COUNTS + """
        SELECT count(*) AS n_tables,
               count(*) FILTER (status = 'success') AS n_success,
               count(*) FILTER (status = 'partial') AS n_partial,
               count(*) FILTER (status = 'failed') AS n_failed,
               count(*) FILTER (status = 'skipped') AS n_skipped,
               sum(migrated)::BIGINT AS migrated, sum(failed)::BIGINT AS failed,
               sum(total)::BIGINT AS total,
               CAST(sum(failed) * 100.0 / sum(total) AS DECIMAL(9,4)) AS error_percent
        FROM report""",
    "reconcile_checksum": f"WITH {FAULTY_ORDERS}, {FAULTY_LINEITEM} "
    + " UNION ALL ".join(
        [
            _checksum_row("customer", "customer", "customer", CUSTOMER_MD5),
            _checksum_row("orders", "orders", "faulty_orders", ORDERS_MD5),
            _checksum_row("lineitem", "lineitem", "faulty_lineitem", LINEITEM_MD5),
        ]
    ),
    "reconcile_checksum_typed": " UNION ALL ".join(
        f"SELECT '{name}' AS table_name, {matched} AS matched"
        for name, matched in (
            ("customer", "TRUE"),
            ("orders", "NOT EXISTS (SELECT 1 FROM orders WHERE o_orderkey % 97 = 0)"),
            ("lineitem", "NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey % 97 = 0)"),
        )
    ),
    "sampled_checksum": _sampled_sql(
        f"SELECT * FROM orders ORDER BY o_orderkey LIMIT {SAMPLE_ROWS}",
        f"SELECT * FROM faulty_orders ORDER BY o_orderkey LIMIT {SAMPLE_ROWS}",
    ),
    "sampled_checksum_by_key": _sampled_sql(
        f"SELECT * FROM orders WHERE {_KEY_WORD} < {_SHARE_LIMIT}",
        f"SELECT * FROM faulty_orders WHERE {_KEY_WORD} < {_SHARE_LIMIT}",
    ),
    "sampled_checksum_short_source": """
        SELECT 'part' AS table_name,
               count(*) FILTER (p_partkey <= 50) = count(*) FILTER (p_partkey <= 70) AS matched
        FROM part""",
    "checksum_precision": """
        WITH one AS (SELECT * FROM events WHERE event_id = (SELECT min(event_id) FROM events))
        SELECT 'same' AS table_name, TRUE AS matched, TRUE AS typed_matched
        UNION ALL
        SELECT 'moment', bool_and(ts = ts + INTERVAL 1 MICROSECOND),
               bool_and(ts = ts + INTERVAL 1 MICROSECOND) FROM one
        UNION ALL
        SELECT 'value', bool_and(value = value + 1e-6), bool_and(value = value + 1e-6) FROM one""",
    "row_diff": _ROW_STATUS
    + "SELECT o_orderkey, status, n_source, n_target FROM pairs WHERE status <> 'same'",
    "row_diff_by_sketch": _ROW_STATUS
    + "SELECT o_orderkey, status, n_source, n_target FROM pairs WHERE status <> 'same'",
    "row_diff_by_range": _ROW_STATUS
    + "SELECT o_orderkey, status, n_source, n_target FROM pairs WHERE status <> 'same'",
    "row_diff_summary": _ROW_STATUS
    + "SELECT status, count(*) AS n_keys FROM pairs GROUP BY status",
    "row_diff_repeated_keys": f"""
        WITH {FAULTY_LINEITEM},
        s AS (SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY ALL),
        t AS (SELECT l_orderkey, l_linenumber, count(*) AS n FROM faulty_lineitem GROUP BY ALL),
        pairs AS (
          SELECT CASE WHEN t.n IS NULL THEN 'missing' WHEN s.n IS NULL THEN 'extra'
                      WHEN s.n > 1 OR t.n > 1 THEN 'duplicated' ELSE 'same' END AS status
          FROM s FULL OUTER JOIN t
            ON s.l_orderkey = t.l_orderkey AND s.l_linenumber = t.l_linenumber)
        SELECT status, count(*) AS n_keys FROM pairs GROUP BY status""",
    "column_diff": f"WITH {FAULTY_ORDERS} "
    + " UNION ALL ".join(
        f"SELECT '{name}' AS column_name, count(*) AS n_compared, "
        f"count(*) FILTER (s.{name} IS DISTINCT FROM t.{name}) AS n_different {_JOINED}"
        for name in _COMPARED
    ),
    "changed_values": f"WITH {FAULTY_ORDERS} "
    + " UNION ALL ".join(
        f"SELECT s.o_orderkey, '{name}' AS column_name, "
        f"{_SHOWN[name].format('s.' + name)} AS source_value, "
        f"{_SHOWN[name].format('t.' + name)} AS target_value "
        f"{_JOINED} WHERE s.{name} IS DISTINCT FROM t.{name}"
        for name in _COMPARED
    ),
    "multiset_diff_fingerprints": f"""
        WITH {FAULTY_LINEITEM},
        s AS (SELECT {LINEITEM_MD5} AS fingerprint, count(*) AS n FROM lineitem GROUP BY 1),
        t AS (SELECT {LINEITEM_MD5} AS fingerprint, count(*) AS n FROM faulty_lineitem GROUP BY 1)
        SELECT coalesce(s.fingerprint, t.fingerprint) AS fingerprint,
               coalesce(s.n, 0) AS n_source, coalesce(t.n, 0) AS n_target
        FROM s FULL OUTER JOIN t ON s.fingerprint = t.fingerprint
        WHERE s.n IS DISTINCT FROM t.n""",
    "multiset_diff": f"""
        WITH {FAULTY_LINEITEM},
        both_ends AS (SELECT {_LINES}, 1 AS s, 0 AS t FROM lineitem
                      UNION ALL SELECT {_LINES}, 0, 1 FROM faulty_lineitem)
        SELECT {_LINES}, sum(s)::BIGINT AS n_source, sum(t)::BIGINT AS n_target
        FROM both_ends GROUP BY {_LINES} HAVING sum(s) <> sum(t)""",
}
