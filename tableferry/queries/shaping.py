"""Scans, pruning, conforming, aligning, export forms."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tableferry.functions.types import ColumnSpec, describe
from tableferry.operators.renames import proposed_renames
from tableferry.operators.shape import conform_table, evolve_table, prune_unsupported
from tableferry.queries.inputs import store, table, with_flag
from tableferry.session import new_folder
from tableferry.sources.csv_files import (
    export_projection,
    parse_export,
    read_export,
    write_export,
)
from tableferry.sources.files import FileStore
from tableferry.sources.key_ranges import in_key_range, key_cuts, key_ranges, range_number
from tableferry.sources.ranges import key_bounds, split_number

SPLITS = 8

# information_schema data types of the test tables, where they matter.
ORDER_SPECS = [
    ColumnSpec("o_orderkey", "bigint"),
    ColumnSpec("o_custkey", "integer"),
    ColumnSpec("o_totalprice", "numeric", precision=12, scale=2),
    ColumnSpec("o_orderdate", "timestamp without time zone"),
    ColumnSpec("o_orderpriority", "character varying", length=15),
    ColumnSpec("is_final", "boolean"),
]
EVENT_SPECS = [ColumnSpec("props", "jsonb", "jsonb")]


def partitioned_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = ["o_orderkey", "o_custkey", "o_totalprice"]
    orders = store(sf_dir).read(spark, "orders", columns)
    low, high = key_bounds(orders, "o_orderkey")
    return orders.withColumn("split_id", split_number("o_orderkey", low, high, SPLITS))


def range_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        partitioned_scan(spark, sf_dir)
        .groupBy("split_id")
        .agg(
            F.count(F.lit(1)).alias("n_rows"),
            F.min("o_orderkey").alias("first_key"),
            F.max("o_orderkey").alias("last_key"),
        )
    )


_BOUNDED = f"""
WITH bounds AS (SELECT min(o_orderkey) AS low, max(o_orderkey) AS high FROM orders),
     width AS (SELECT low, (high - low + 1 + {SPLITS - 1}) // {SPLITS} AS width FROM bounds),
     scan AS (SELECT o_orderkey, o_custkey, o_totalprice,
                     CAST((o_orderkey - low) // width AS INTEGER) AS split_id
              FROM orders, width)
"""


def _range_sizes(df: DataFrame, keys: list[str], parts: int) -> DataFrame:
    """Rows that the ranges hold together, by filter and by number, how many ranges there are, and
    whether none is more than a fifth larger or smaller than the mean."""
    cuts = key_cuts(df, keys, parts)
    numbered = df.select(range_number(keys, cuts).alias("part"), *keys)
    held = reduce(
        Column.__or__,
        [(F.col("part") == n) & in_key_range(keys, *ends) for n, ends in enumerate(key_ranges(cuts))],
    )
    sizes = numbered.where(held).groupBy("part").agg(F.count(F.lit(1)).alias("n"))
    mean = F.sum("n") / F.lit(parts)
    return sizes.agg(
        F.count(F.lit(1)).alias("n_ranges"),
        F.sum("n").alias("n_rows"),
        ((F.max("n") <= mean * 1.2) & (F.min("n") >= mean * 0.8)).alias("balanced"),
    )


def range_split_composite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines cut into sixteen ranges of (order, line number), and customers into eight of (market
    segment, name), both texts; NULL segments first."""
    lines = table(spark, sf_dir, "lineitem")
    customers = table(spark, sf_dir, "customer").withColumn(
        "c_mktsegment", F.when(F.col("c_custkey") % 9 == 0, None).otherwise(F.col("c_mktsegment"))
    )
    sizes = {
        "lineitem": _range_sizes(lines, ["l_orderkey", "l_linenumber"], 16),
        "customer": _range_sizes(customers, ["c_mktsegment", "c_name"], 8),
    }
    one, other = (df.withColumn("table_name", F.lit(name)) for name, df in sizes.items())
    return one.unionByName(other)


def target_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    target = FileStore(new_folder(spark, "target"))
    target.reload(table(spark, sf_dir, "supplier"), "supplier")
    return target.read(spark, "supplier", ["s_suppkey", "s_name", "s_nationkey"])


def prune_arrays(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prune_unsupported(table(spark, sf_dir, "embeddings"))


def prune_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prune_unsupported(describe(table(spark, sf_dir, "events"), EVENT_SPECS))


def conform_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conform_table(describe(with_flag(table(spark, sf_dir, "orders")), ORDER_SPECS))


DESIRED_ORDERS = T.StructType(
    [
        T.StructField("o_orderkey", T.LongType(), False),
        T.StructField("o_custkey", T.StringType()),
        T.StructField("o_totalprice", T.DecimalType(12, 2)),
        T.StructField("ordered_at", T.TimestampNTZType()),
        T.StructField("status", T.StringType(), False, {
            "source_type": "character varying", "default": "'pending'::character varying",
        }),
        T.StructField("is_open", T.ByteType(), True, {
            "source_type": "boolean", "default": "true",
        }),
        T.StructField("retries", T.IntegerType(), True, {
            "source_type": "integer", "default": "(0)",
        }),
        T.StructField("note", T.StringType()),
    ]
)


def evolve_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    return evolve_table(orders, DESIRED_ORDERS, renames={"ordered_at": "o_orderdate"})


def rename_proposal(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders in a new schema: three columns renamed, two of them retyped as well, among columns
    that hold other values of the same kinds."""
    orders = table(spark, sf_dir, "orders")
    after = orders.select(
        "o_orderkey",
        F.col("o_custkey").cast("string").alias("customer"),
        F.col("o_totalprice").cast("decimal(14,2)").alias("amount"),
        F.col("o_orderdate").alias("ordered_at"),
        (F.col("o_custkey") * 3 + 5_000_000).alias("supplier"),
        (F.col("o_totalprice") / 2).alias("discounted"),
        F.concat(F.col("o_orderpriority"), F.lit("!")).alias("note"),
    )
    before = orders.drop("o_orderpriority", "o_orderstatus")
    return proposed_renames(before, after).select("removed", "added", "type_before", "type_after")


def export_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = with_flag(table(spark, sf_dir, "orders"))
    day = F.col("o_orderdate").cast("date")
    chosen = orders.select("o_orderkey", "is_final", "o_orderdate", day.alias("o_day"))
    return export_projection(chosen)


def export_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return export_projection(table(spark, sf_dir, "events").select("event_id", "ts", "event_type"))


def export_hex(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = table(spark, sf_dir, "customer")
    return export_projection(
        customer.select("c_custkey", F.col("c_name").cast("binary").alias("name_hex"))
    )


def csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    folder = new_folder(spark, "export")
    write_export(documents, folder)
    texts = read_export(spark, folder, documents.columns, keep_bad_rows=False)
    return parse_export(texts, documents.schema)


def csv_roundtrip_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = conform_orders(spark, sf_dir).withColumn(
        "tag", F.col("o_orderpriority").cast("binary")
    )
    folder = new_folder(spark, "export")
    write_export(orders, folder)
    texts = read_export(spark, folder, orders.columns, keep_bad_rows=False)
    back = parse_export(texts, orders.schema)
    return back.withColumn("tag", F.col("tag").cast("string"))


QUERIES = {
    "partitioned_scan": partitioned_scan,
    "range_split": range_split,
    "range_split_composite": range_split_composite,
    "target_scan": target_scan,
    "prune_unsupported": prune_json,
    "prune_unsupported_arrays": prune_arrays,
    "conform_table": conform_orders,
    "evolve_table": evolve_orders,
    "rename_proposal": rename_proposal,
    "export_projection": export_orders,
    "export_projection_events": export_events,
    "export_hex": export_hex,
    "csv_roundtrip": csv_roundtrip,
    "csv_roundtrip_types": csv_roundtrip_types,
}

_CONFORMED = """
  o_orderkey, CAST(o_custkey AS INTEGER) AS o_custkey, o_orderstatus,
  CAST(o_totalprice AS DECIMAL(12,2)) AS o_totalprice, o_orderdate, o_orderpriority,
  CAST(CASE WHEN o_orderkey % 11 = 0 THEN NULL WHEN o_orderstatus = 'F' THEN 1
            WHEN o_orderstatus IS NULL THEN NULL ELSE 0 END AS TINYINT) AS is_final
"""

_SIMILAR = """
SELECT '{0}' AS removed, '{1}' AS added, '{2}' AS type_before, '{3}' AS type_after
WHERE (SELECT count(*) FROM (SELECT {4} FROM orders INTERSECT SELECT {5} FROM orders)) * 2
   >= (SELECT count(*) FROM (SELECT {4} FROM orders UNION SELECT {5} FROM orders))
"""
_BEFORE = {
    "o_custkey": ("bigint", "o_custkey::DECIMAL(38,9)::VARCHAR"),
    "o_totalprice": ("double", "o_totalprice::DECIMAL(38,9)::VARCHAR"),
    "o_orderdate": ("timestamp_ntz", "o_orderdate::VARCHAR"),
}
_AFTER = {
    "customer": ("string", "o_custkey::DECIMAL(38,9)::VARCHAR"),
    "amount": ("decimal(14,2)", "o_totalprice::DECIMAL(38,9)::VARCHAR"),
    "ordered_at": ("timestamp_ntz", "o_orderdate::VARCHAR"),
    "supplier": ("bigint", "(o_custkey * 3 + 5000000)::DECIMAL(38,9)::VARCHAR"),
    "discounted": ("double", "(o_totalprice / 2)::DECIMAL(38,9)::VARCHAR"),
    "note": ("string", "o_orderpriority || '!'"),
}

SQL = {
    "rename_proposal": " UNION ALL ".join(
        _SIMILAR.format(old, new, one[0], other[0], one[1], other[1])
        for old, one in _BEFORE.items() for new, other in _AFTER.items()
    ),
    "range_split_composite": """
        SELECT 16::BIGINT AS n_ranges, count(*) AS n_rows, TRUE AS balanced, 'lineitem' AS table_name
        FROM lineitem
        UNION ALL SELECT 8, count(*), TRUE, 'customer' FROM customer""",
    "partitioned_scan": _BOUNDED + "SELECT * FROM scan",
    "range_split": _BOUNDED + """
        SELECT split_id, count(*) AS n_rows, min(o_orderkey) AS first_key,
               max(o_orderkey) AS last_key
        FROM scan GROUP BY split_id""",
    "target_scan": "SELECT s_suppkey, s_name, s_nationkey FROM supplier",
    "prune_unsupported": "SELECT event_id, ts, user_id, event_type, value FROM events",
    "prune_unsupported_arrays": "SELECT vec_id, label FROM embeddings",
    "conform_table": f"SELECT {_CONFORMED} FROM orders",
    "evolve_table": """
        SELECT o_orderkey, o_custkey::VARCHAR AS o_custkey,
               CAST(o_totalprice AS DECIMAL(12,2)) AS o_totalprice,
               o_orderdate AS ordered_at, 'pending' AS status, 1::TINYINT AS is_open,
               0::INTEGER AS retries, NULL::VARCHAR AS note
        FROM orders""",
    "export_projection": """
        SELECT o_orderkey,
               CAST(CASE WHEN o_orderkey % 11 = 0 THEN NULL WHEN o_orderstatus = 'F' THEN 1
                         WHEN o_orderstatus IS NULL THEN NULL ELSE 0 END AS TINYINT) AS is_final,
               strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS o_orderdate,
               strftime(o_orderdate, '%Y-%m-%d') AS o_day
        FROM orders""",
    "export_projection_events": """
        SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts, event_type FROM events""",
    "export_hex": """
        SELECT c_custkey, lower(hex(encode(c_name))) AS name_hex FROM customer""",
    "csv_roundtrip": "SELECT doc_id, text, lang, source, n_chars FROM documents",
    "csv_roundtrip_types": f"SELECT {_CONFORMED}, o_orderpriority AS tag FROM orders",
}
