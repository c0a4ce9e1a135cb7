"""The test tables, and copies of them with faults put in for the comparisons to find."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tableferry.sources.files import FileStore

ORDER_COLUMNS = [
    "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority",
]
LINE_COLUMNS = [
    "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
    "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate",
]


def store(sf_dir: str) -> FileStore:
    return FileStore(sf_dir, suffix=".parquet")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return store(sf_dir).read(spark, name)


def faulty_orders(orders: DataFrame) -> DataFrame:
    """Some orders lost, some changed in one of three columns, some there under a foreign key."""
    key = F.col("o_orderkey")
    changed = orders.where(key % 97 != 0).select(
        "o_orderkey",
        "o_custkey",
        F.when(key % 83 == 0, None).otherwise(F.col("o_orderstatus")).alias("o_orderstatus"),
        F.when(key % 89 == 0, F.col("o_totalprice") + 1)
        .otherwise(F.col("o_totalprice")).alias("o_totalprice"),
        F.when(key % 79 == 0, F.col("o_orderdate") + F.expr("interval 1 day"))
        .otherwise(F.col("o_orderdate")).alias("o_orderdate"),
        "o_orderpriority",
    )
    foreign = orders.where(key % 101 == 0).withColumn("o_orderkey", key + 10000000)
    return changed.unionByName(foreign)


FAULTY_ORDERS = """
faulty_orders AS (
  SELECT o_orderkey, o_custkey,
         CASE WHEN o_orderkey % 83 = 0 THEN NULL ELSE o_orderstatus END AS o_orderstatus,
         CASE WHEN o_orderkey % 89 = 0 THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice,
         CASE WHEN o_orderkey % 79 = 0 THEN o_orderdate + INTERVAL 1 DAY
              ELSE o_orderdate END AS o_orderdate,
         o_orderpriority
  FROM orders WHERE o_orderkey % 97 <> 0
  UNION ALL
  SELECT o_orderkey + 10000000, o_custkey, o_orderstatus, o_totalprice, o_orderdate,
         o_orderpriority
  FROM orders WHERE o_orderkey % 101 = 0)
"""


def faulty_lineitem(lineitem: DataFrame) -> DataFrame:
    """Some lines lost, some there twice."""
    return lineitem.where(F.col("l_orderkey") % 97 != 0).unionByName(
        lineitem.where(F.col("l_partkey") % 101 == 0)
    )


FAULTY_LINEITEM = """
faulty_lineitem AS (
  SELECT * FROM lineitem WHERE l_orderkey % 97 <> 0
  UNION ALL
  SELECT * FROM lineitem WHERE l_partkey % 101 = 0)
"""


def with_flag(orders: DataFrame) -> DataFrame:
    """Orders with a boolean that is sometimes NULL."""
    flag = F.when(F.col("o_orderkey") % 11 == 0, None).otherwise(F.col("o_orderstatus") == "F")
    return orders.withColumn("is_final", flag)


# SQL pieces of the row fingerprint.
def text_sql(column: str) -> str:
    return f"coalesce(length({column})::VARCHAR || ':' || {column}, '\\N')"


def plain_sql(column: str) -> str:
    return f"coalesce({column}::VARCHAR, '\\N')"


def double_sql(column: str) -> str:
    """The exact value as <sign><whole number>p<power of two>."""
    power = f"floor(log2(abs({column})))::INT"
    up = f"(52 - {power})"
    scaled = f"(abs({column}) * pow(2.0::DOUBLE, {up} // 2) * pow(2.0::DOUBLE, {up} - {up} // 2))"
    return (
        f"coalesce(CASE WHEN {column} = 0 THEN '0' ELSE CASE WHEN {column} < 0 THEN '-' ELSE '' END || "
        f"CASE WHEN {scaled} < {2**52} THEN ({scaled} * 2)::BIGINT || 'p' || ({power} - 53) "
        f"WHEN {scaled} >= {2**53} THEN ({scaled} / 2)::BIGINT || 'p' || ({power} - 51) "
        f"ELSE {scaled}::BIGINT || 'p' || ({power} - 52) END END, '\\N')"
    )


def moment_sql(column: str) -> str:
    return f"coalesce(strftime({column}, '%Y-%m-%d %H:%M:%S.%f'), '\\N')"


def md5_sql(fields: list[str]) -> str:
    return "md5(" + " || '|' || ".join(fields) + ")"


ORDERS_MD5 = md5_sql(
    [
        plain_sql("o_orderkey"), plain_sql("o_custkey"), text_sql("o_orderstatus"),
        double_sql("o_totalprice"), moment_sql("o_orderdate"), text_sql("o_orderpriority"),
    ]
)
CUSTOMER_MD5 = md5_sql(
    [
        plain_sql("c_custkey"), text_sql("c_name"), plain_sql("c_nationkey"),
        double_sql("c_acctbal"), text_sql("c_mktsegment"),
    ]
)
LINEITEM_MD5 = md5_sql(
    [
        plain_sql("l_orderkey"), plain_sql("l_partkey"), plain_sql("l_suppkey"),
        plain_sql("l_linenumber"), double_sql("l_quantity"), double_sql("l_extendedprice"),
        double_sql("l_discount"), double_sql("l_tax"), text_sql("l_returnflag"),
        text_sql("l_linestatus"), moment_sql("l_shipdate"),
    ]
)


def checksum_sql(fingerprint: str, table: str) -> str:
    """One-row query: checksum of a whole table."""
    words = [
        f"coalesce(sum(('0x' || substr(h, {start}, 8))::BIGINT), 0)::DECIMAL(38,0)::VARCHAR"
        for start in (1, 9)
    ]
    return (
        f"SELECT md5(count(*)::VARCHAR || '|' || {words[0]} || '|' || {words[1]}) AS checksum "
        f"FROM (SELECT {fingerprint} AS h FROM {table})"
    )
