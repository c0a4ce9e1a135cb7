"""Tables in a relational database, read and written through Spark's JDBC source.

Credentials come from the caller's ``options`` and are never stored here.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, DataFrameReader, SparkSession

from tableferry.functions.types import ColumnSpec
from tableferry.sources.ranges import equal_cuts, range_predicates


@dataclass(frozen=True)
class JdbcStore:
    """``options`` holds user, password, driver and anything else the driver understands.

    ``quote`` is the database's identifier quote (``"`` or a backtick); without it names are used
    as they are.
    """

    url: str
    schema: str | None = None
    options: Mapping[str, str] = field(default_factory=dict, repr=False)
    fetch_size: int = 10000
    batch_size: int = 1000
    writers: int | None = None
    rows_per_writer: int = 250_000
    most_writers: int = 64
    quote: str = ""

    def _ident(self, name: str) -> str:
        if not self.quote:
            return name
        return self.quote + name.replace(self.quote, self.quote * 2) + self.quote

    def _name(self, table: str) -> str:
        parts = [self.schema, table] if self.schema else [table]
        return ".".join(self._ident(part) for part in parts)

    def _reader(self, spark: SparkSession) -> DataFrameReader:
        return (
            spark.read.format("jdbc")
            .options(**dict(self.options))
            .option("url", self.url)
            .option("fetchsize", self.fetch_size)
            .option("preferTimestampNTZ", "true")
        )

    def query(self, spark: SparkSession, text: str) -> DataFrame:
        """Run a query in the database and read its result, for counts, bounds and catalogs."""
        return self._reader(spark).option("query", text).load()

    def read(
        self, spark: SparkSession, table: str, columns: Sequence[str] | None = None
    ) -> DataFrame:
        df = self._reader(spark).option("dbtable", self._name(table)).load()
        return df.select(*columns) if columns is not None else df

    def count_query(self, table: str) -> str:
        return f"SELECT COUNT(*) AS n_rows FROM {self._name(table)}"

    def count(self, spark: SparkSession, table: str) -> DataFrame:
        """One row, ``n_rows``, counted by the database: no table row crosses the network."""
        return self.query(spark, self.count_query(table)).selectExpr(
            "CAST(n_rows AS BIGINT) AS n_rows"
        )

    def bounds_query(self, table: str, key: str) -> str:
        name = self._ident(key)
        return f"SELECT MIN({name}) AS low_key, MAX({name}) AS high_key FROM {self._name(table)}"

    def read_partitioned(
        self,
        spark: SparkSession,
        table: str,
        key: str,
        parts: int,
        columns: Sequence[str] | None = None,
        cuts: Sequence[int] | None = None,
    ) -> DataFrame:
        """``parts`` connections, each with one key interval of the table.

        Without ``cuts`` the intervals have equal width between the smallest and largest key.
        Pass cuts (see ``ranges.balanced_cuts``) where the keys have large gaps.
        """
        if cuts is None:
            low, high = self.query(spark, self.bounds_query(table, key)).first()
            cuts = [] if low is None else equal_cuts(int(low), int(high), parts)
        properties = {
            **dict(self.options),
            "fetchsize": str(self.fetch_size),
            "preferTimestampNTZ": "true",
        }
        df = spark.read.jdbc(
            self.url,
            self._name(table),
            predicates=range_predicates(self._ident(key), cuts),
            properties=properties,
        )
        return df.select(*columns) if columns is not None else df

    def columns_query(self, table: str) -> str:
        where = f"table_name = '{_literal(table)}'"
        if self.schema:
            where += f" AND table_schema = '{_literal(self.schema)}'"
        names = (
            "column_name, data_type, udt_name, character_maximum_length, numeric_precision, "
            "numeric_scale, is_nullable, column_default, ordinal_position"
        )
        return f"SELECT {names} FROM information_schema.columns WHERE {where}"

    def specs(self, spark: SparkSession, table: str) -> list[ColumnSpec]:
        """Column descriptions, in order: as many rows as the table has columns."""
        rows = self.query(spark, self.columns_query(table)).orderBy("ordinal_position").collect()
        return [ColumnSpec.from_catalog(row.asDict()) for row in rows]

    def key_query(self, table: str) -> str:
        """The columns of the primary key, in order, from the catalog."""
        where = f"c.constraint_type = 'PRIMARY KEY' AND c.table_name = '{_literal(table)}'"
        if self.schema:
            where += f" AND c.table_schema = '{_literal(self.schema)}'"
        return (
            "SELECT k.column_name, k.ordinal_position, t.data_type "
            "FROM information_schema.table_constraints c "
            "JOIN information_schema.key_column_usage k ON k.constraint_name = c.constraint_name "
            "AND k.table_schema = c.table_schema AND k.table_name = c.table_name "
            "JOIN information_schema.columns t ON t.table_schema = k.table_schema "
            f"AND t.table_name = k.table_name AND t.column_name = k.column_name WHERE {where}"
        )

    def split_key(self, spark: SparkSession, table: str) -> str | None:
        """The leading column of the primary key, if it holds whole numbers: what to read the table
        by over several connections. None if there is no such key."""
        rows = self.query(spark, self.key_query(table)).collect()
        first = min(rows, key=lambda row: row["ordinal_position"], default=None)
        if first is None or base_type(first["data_type"]) not in WHOLE_NUMBERS:
            return None
        return first["column_name"]

    def writers_for(self, n_rows: int | None) -> int:
        """Connections to write so many rows over; ``writers`` if that is set."""
        if self.writers is not None:
            return self.writers
        if n_rows is None:
            return 8
        return min(self.most_writers, max(1, -(-n_rows // self.rows_per_writer)))

    def _write(self, df: DataFrame, table: str, mode: str, n_rows: int | None, **extra: str) -> None:
        (
            df.write.format("jdbc")
            .options(**dict(self.options), **extra)
            .option("url", self.url)
            .option("dbtable", self._name(table))
            .option("batchsize", self.batch_size)
            .option("numPartitions", self.writers_for(n_rows))
            .mode(mode)
            .save()
        )

    def append(self, df: DataFrame, table: str, n_rows: int | None = None) -> None:
        """Insert in batches, over as many connections as ``n_rows`` (if known) are worth. Spark commits per partition, so a failed job can leave a part of
        the rows behind: load into an empty stage table where that matters."""
        self._write(df, table, "append", n_rows)

    def reload(self, df: DataFrame, table: str, n_rows: int | None = None) -> None:
        """Empty the table, keeping its definition, then insert."""
        self._write(df, table, "overwrite", n_rows, truncate="true")


#: Catalog names of whole-number types.
WHOLE_NUMBERS = {"smallint", "integer", "bigint", "int", "tinyint", "mediumint"}


def base_type(name: str) -> str:
    """A catalog type without its size, in lower case."""
    return name.lower().partition("(")[0].strip()


def _literal(text: str) -> str:
    return text.replace("'", "''")
