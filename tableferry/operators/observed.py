"""Facts of a load, taken by the write itself: no second read of the source."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tableferry.functions.fingerprint import checksum_of, with_row_hash, word_halves


@dataclass(frozen=True)
class LoadFacts:
    """What was written: the rows, the added-up words of their typed hashes, and their types."""

    schema: T.StructType
    sums: Mapping[str, int]

    @property
    def n_rows(self) -> int:
        return self.sums["n_rows"]

    @property
    def checksum(self) -> str:
        """As ``reconcile.table_checksums(typed=True)`` has it."""
        return checksum_of(self.sums)

    def comparable_with(self, schema: T.StructType) -> bool:
        """Whether a table of that schema holds the columns in the types they were written with;
        else its checksum says nothing about the load."""
        types = {field.name: field.dataType for field in schema.fields}
        return all(types.get(field.name) == field.dataType for field in self.schema.fields)


class Watch:
    """Rows on their way into a store.

    Write ``rows`` once, with nothing but the write behind them, and ask for ``facts`` afterwards.
    The facts are added up in the tasks that write; Spark counts a task that is repeated once, as
    they stand in the last stage of the job. So they describe the rows that were written, whatever
    happens to the source meanwhile.
    """

    def __init__(self, df: DataFrame):
        self.schema = df.schema
        self._names = ["n_rows", *word_halves(True)]
        self._observation = Observation()
        measures = [F.count(F.lit(1)).alias("n_rows")]
        measures += [F.expr(value).alias(name) for name, value in word_halves(True).items()]
        marked = with_row_hash(df, df.columns)
        self.rows = marked.observe(self._observation, *measures).drop("__fingerprint")

    def facts(self) -> LoadFacts:
        found = self._observation.get
        # A plan that turns out to be empty has no place where anything is counted.
        return LoadFacts(self.schema, {name: found.get(name) or 0 for name in self._names})
