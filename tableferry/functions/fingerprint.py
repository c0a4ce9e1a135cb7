"""Row fingerprints and order-free table checksums.

Two kinds, for two purposes:

* ``row_md5``: MD5 of a canonical text. Any engine can compute it, so two stores can be compared
  by their checksums alone.
* ``row_hash``: ``xxhash64`` of the typed columns, several times cheaper. Used where Spark reads
  both ends. Two different rows under one key pass as equal with probability 2**-64.
"""

from __future__ import annotations

import hashlib
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tableferry.functions.text import (
    canonical_sql,
    double_power_sql,
    double_scaled_sql,
    quoted,
)

# The NULL marker as SQL; written so that it does not depend on how literals are escaped.
_NULL_SQL = "char(92) || 'N'"


def row_text(
    df: DataFrame,
    columns: Sequence[str],
    double_scale: int | None = None,
    micros: bool = True,
    steps: Mapping[str, tuple[str, str]] | None = None,
) -> str:
    """Expression for the canonical text of a row: fields joined by ``|``, NULL as the marker.

    Strings carry their length in front (``3:abc``), so no text can run into its neighbour or
    pass for NULL. The other types have no ``|`` in their text and need no prefix. One SQL
    expression, because a plan over many wide tables would else spend its time on building
    columns. ``steps`` names the columns that hold the steps of a double (``with_row_md5``).
    """
    fields = []
    for name in columns:
        kind, value = df.schema[name].dataType, quoted(name)
        text = canonical_sql(value, kind, double_scale, micros, (steps or {}).get(name, ()))
        if isinstance(kind, T.StringType):
            text = f"char_length({value}) || ':' || {value}"
        fields.append(f"coalesce({text}, {_NULL_SQL})")
    return f"concat_ws('|', {', '.join(fields)})"


def row_md5(
    df: DataFrame, columns: Sequence[str], double_scale: int | None = None, micros: bool = True
) -> str:
    """Expression for the MD5 of the canonical text, for few columns: where doubles are many,
    ``with_row_md5`` is much faster."""
    return f"md5({row_text(df, columns, double_scale, micros)})"


def with_row_md5(
    df: DataFrame,
    columns: Sequence[str],
    name: str = "__fingerprint",
    double_scale: int | None = None,
    micros: bool = True,
) -> DataFrame:
    """``df`` with the ``row_md5`` of ``columns``. The steps of each double are columns of inner
    projections, which the planner keeps apart because they are used more than once."""
    floats = [c for c in columns if isinstance(df.schema[c].dataType, (T.FloatType, T.DoubleType))]
    steps = {c: (f"__power_{i}", f"__scaled_{i}") for i, c in enumerate(floats)}
    staged = df
    if floats:
        powers = [f"{double_power_sql(quoted(c))} AS {steps[c][0]}" for c in floats]
        scaled = [f"{double_scaled_sql(quoted(c), steps[c][0])} AS {steps[c][1]}" for c in floats]
        staged = df.selectExpr("*", *powers).selectExpr("*", *scaled)
    text = row_text(df, columns, double_scale, micros, steps)
    return staged.selectExpr(*map(quoted, df.columns), f"md5({text}) AS {name}")


def with_row_hash(df: DataFrame, columns: Sequence[str], name: str = "__fingerprint") -> DataFrame:
    """``df`` with the ``row_hash`` of ``columns``."""
    return df.selectExpr("*", f"{row_hash(columns)} AS {name}")


def row_hash(columns: Sequence[str]) -> str:
    """Expression for a 64-bit hash of typed columns. ``xxhash64`` skips NULLs, so each column's
    NULL flag is hashed along; otherwise (1, NULL) and (NULL, 1) would agree."""
    names = [quoted(name) for name in columns]
    return f"xxhash64({', '.join(f'{name}, {name} IS NULL' for name in names)})"


def md5_word(md5_text: str, start: int) -> str:
    """Expression for the 32 bits that begin at a hexadecimal digit of an MD5."""
    return f"CAST(conv(substring({md5_text}, {start}, 8), 16, 10) AS BIGINT)"


def word_halves(typed: bool, name: str = "__fingerprint") -> dict[str, str]:
    """Aggregates over a column of fingerprints: the added-up 16-bit halves of its first two words.

    The first 64 bits of a ``row_md5`` or ``row_hash`` (``typed``) are two words. Sums of halves
    stay within a bigint for 2**47 rows, and the aggregate keeps to fixed-width buffers, so one
    small row per task reaches the shuffle. Sums of parts of a table add up to those of the whole.
    """
    if typed:
        words = {"a": f"shiftrightunsigned({name}, 32)", "b": f"({name} & 4294967295L)"}
    else:
        words = {"a": md5_word(name, 1), "b": md5_word(name, 9)}
    halves = {"high": "shiftright({}, 16)", "low": "({} & 65535)"}
    return {
        f"_word_{word}_{part}": f"coalesce(sum({half.format(value)}), 0)"
        for word, value in words.items()
        for part, half in halves.items()
    }


def word_sums(marked: DataFrame, typed: bool, table_name: str) -> DataFrame:
    """One row: the name, ``n_rows`` and the added-up words of ``__fingerprint``."""
    label = table_name.replace("\\", "\\\\").replace("'", "\\'")
    halves = [f"{value} AS {name}" for name, value in word_halves(typed).items()]
    return marked.select("__fingerprint").selectExpr(f"'{label}' AS table_name", "count(1) AS n_rows", *halves)


def checksum_of(facts: Mapping[str, int]) -> str:
    """The checksum of a table from its ``n_rows`` and word sums, taken or added up elsewhere."""
    totals = [facts[f"_word_{word}_high"] * 65536 + facts[f"_word_{word}_low"] for word in ("a", "b")]
    return hashlib.md5("|".join(map(str, [facts["n_rows"], *totals])).encode()).hexdigest()


def checksums_of(sums: DataFrame) -> DataFrame:
    """``table_name, n_rows, checksum`` from rows of ``word_sums``; a repeated row of a table
    changes both, the order of its rows neither."""
    totals = [
        f"CAST(CAST(_word_{word}_high AS DECIMAL(28,0)) * 65536 + _word_{word}_low AS DECIMAL(38,0))"
        for word in ("a", "b")
    ]
    checksum = f"md5(n_rows || '|' || {totals[0]} || '|' || {totals[1]}) AS checksum"
    return sums.selectExpr("table_name", "n_rows", checksum)
