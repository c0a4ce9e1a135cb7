"""Which removed column lives on under a new name: columns compared by what they hold.

A change of schema shows columns that went and columns that came. Two of them are taken for one
column renamed if they hold the same values. Values are compared in one text form (numbers by
value, whatever their type, also those written as text), so a column that was retyped on the way
is found as well.

Every column is reduced to a min-hash of its distinct values: a hash falls into one of ``SLOTS``
slots by its low bits, and each slot keeps its smallest hash. The share of slots in which two
columns agree estimates the Jaccard similarity of their distinct values. All columns of a table are
sketched in one pass; what is shuffled is one row per task, column and slot.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tableferry.functions.text import quoted, shown_sql

SLOTS = 512


def value_text(name: str, kind: T.DataType) -> str:
    """Expression for a value's text, alike for a number of any type and for its decimal text."""
    value = quoted(name)
    if isinstance(kind, T.BooleanType):
        return f"CAST(CAST({value} AS TINYINT) AS STRING)"
    if isinstance(kind, (T.NumericType, T.StringType)):
        # 5, 5.00 and the text "5.0" are one value; a number beyond this type keeps its own text.
        text = f"CAST({value} AS STRING)"
        return f"coalesce(CAST(try_cast({text} AS DECIMAL(38,9)) AS STRING), {text})"
    return shown_sql(value, kind)


def column_sketches(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``column_name, slot, low`` (the slot's smallest hash) and ``n`` (values that fell there)."""
    entries = [
        f"named_struct('column_name', '{_literal(name)}', 'h', xxhash64({value_text(name, df.schema[name].dataType)}), "
        f"'there', {quoted(name)} IS NOT NULL)"
        for name in columns
    ]
    hashed = df.selectExpr(f"inline(array({', '.join(entries)}))").where("there")
    slots = hashed.selectExpr("column_name", f"pmod(h, {SLOTS}) AS slot", "h")
    return slots.groupBy("column_name", "slot").agg(F.min("h").alias("low"), F.count(F.lit(1)).alias("n"))


def _literal(text: str) -> str:
    return text.replace("\\", "\\\\").replace("'", "\\'")


def similarities(before: DataFrame, after: DataFrame, removed: Sequence[str], added: Sequence[str]) -> DataFrame:
    """``removed, added, similarity`` of every pair that agrees in a slot: slots in which both hold
    the same hash, of the slots in which either holds one."""
    one = column_sketches(before, removed).select(F.col("column_name").alias("removed"), "slot", "low")
    other = column_sketches(after, added).select(F.col("column_name").alias("added"), "slot", "low")
    used = [side.groupBy(name).agg(F.count(F.lit(1)).alias(f"n_{name}")) for side, name in ((one, "removed"), (other, "added"))]
    pairs = one.join(other.withColumnRenamed("low", "low_added"), "slot").groupBy("removed", "added").agg(
        F.count(F.lit(1)).alias("n_both"), F.count_if(F.col("low") == F.col("low_added")).alias("n_same")
    )
    either = F.col("n_removed") + F.col("n_added") - F.col("n_both")
    return (
        pairs.where("n_same > 0")
        .join(used[0], "removed")
        .join(used[1], "added")
        .select("removed", "added", (F.col("n_same") / either).alias("similarity"))
    )


def proposed_renames(
    before: DataFrame, after: DataFrame, least: float = 0.5, keep: Sequence[str] = ()
) -> DataFrame:
    """``removed, added, similarity, type_before, type_after``: the columns of ``before`` that
    ``after`` seems to hold under another name.

    Both are samples or whole tables of the same rows, or nearly. A pair is proposed if each is
    the other's most similar column and the similarity is at least ``least``; so one column is
    never proposed twice. Columns of one name are the same column and not looked at; ``keep`` names
    others to leave out. Columns of few values (flags) are alike by chance: look at those yourself.
    """
    now, then = before.columns, after.columns
    removed = [name for name in now if name not in then and name not in keep]
    added = [name for name in then if name not in now and name not in keep]
    spark = before.sparkSession
    if not removed or not added:
        return spark.createDataFrame([], "removed string, added string, similarity double, type_before string, type_after string")
    pairs = similarities(before, after, removed, added)
    ranks = [
        F.row_number().over(Window.partitionBy(one).orderBy(F.desc("similarity"), other)).alias(f"rank_{one}")
        for one, other in (("removed", "added"), ("added", "removed"))
    ]
    types = {
        side: F.create_map(*[F.lit(x) for name in names for x in (name, df.schema[name].dataType.simpleString())])
        for side, df, names in (("removed", before, removed), ("added", after, added))
    }
    best = pairs.select("*", *ranks).where(f"rank_removed = 1 AND rank_added = 1 AND similarity >= {least}")
    return best.select(
        "removed",
        "added",
        "similarity",
        F.element_at(types["removed"], F.col("removed")).alias("type_before"),
        F.element_at(types["added"], F.col("added")).alias("type_after"),
    )
