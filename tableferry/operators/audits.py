"""Audits of the data: keys, foreign keys, NULLs, fit of values, hex text in exports."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tableferry.functions import types as rules
from tableferry.functions.text import HEX_DIGITS, HEX_PATTERN, quoted
from tableferry.functions.types import TYPE_MAP, ColumnSpec
from tableferry.sources.csv_files import BAD_ROW

# First and last moment a target TIMESTAMP can hold.
TIMESTAMP_FIRST = "1970-01-01 00:00:01"
TIMESTAMP_LAST = "2038-01-19 03:14:07"


def _any_null(names: Sequence[str]) -> Column:
    return reduce(Column.__or__, [F.col(quoted(name)).isNull() for name in names])


def _unpivot(counted: DataFrame, labels: Sequence[Sequence[str]], names: Sequence[str]) -> DataFrame:
    """One row per counter of a one-row result: its label columns, ``n_rows``, its value."""
    fields = []
    for index, label in enumerate(labels):
        fields += [*map(F.lit, label), F.col(f"_c{index}")]
    stacked = F.stack(F.lit(len(labels)), *fields).alias(*names)
    return counted.select("n_rows", stacked).select(*names[:-1], "n_rows", names[-1])


# -- keys -----------------------------------------------------------------------------------


def duplicate_keys(
    df: DataFrame,
    keys: Sequence[str],
    predicate: Column | str | None = None,
    primary: bool = True,
) -> DataFrame:
    """Keys that break a primary or unique key, with their row count.

    A primary key also must not hold NULL; a unique key (``primary=False``) ignores rows with
    NULL. ``predicate`` is the WHERE of a partial unique index.
    """
    rows = df if predicate is None else df.where(predicate)
    if not primary:
        rows = rows.where(~_any_null(keys))
    counted = rows.groupBy(*map(quoted, keys)).agg(F.count(F.lit(1)).alias("n_rows"))
    broken = F.col("n_rows") > 1
    return counted.where(broken | _any_null(keys) if primary else broken)


def usable_keys(keys: Sequence[str], ignored: Sequence[str]) -> list[str]:
    """Primary key columns that are still there once the ignored columns are left out."""
    return [name for name in keys if name not in ignored]


def fk_orphans(
    child: DataFrame,
    foreign_key: Sequence[str],
    parent: DataFrame,
    parent_key: Sequence[str],
) -> DataFrame:
    """Foreign key values with no parent row, and how many child rows hold each.

    The child rows are counted per value first, so a value that fills a third of the table joins
    as one row. A key with a NULL in it refers to nothing and is not an orphan.
    """
    values = (
        child.where(~_any_null(foreign_key))
        .groupBy(*map(quoted, foreign_key))
        .agg(F.count(F.lit(1)).alias("n_rows"))
    )
    return values.join(
        parent.select(*[F.col(quoted(name)).alias(f"_p{i}") for i, name in enumerate(parent_key)]),
        [F.col(quoted(name)) == F.col(f"_p{i}") for i, name in enumerate(foreign_key)],
        "left_anti",
    )


def fk_orphan_rows(child: DataFrame, foreign_key: Sequence[str], orphans: DataFrame) -> DataFrame:
    """The child rows behind ``fk_orphans``; hand its result in written (``session.written``)."""
    values = orphans.select(*[F.col(quoted(name)).alias(f"_o{i}") for i, name in enumerate(foreign_key)])
    tests = [F.col(quoted(name)) == F.col(f"_o{i}") for i, name in enumerate(foreign_key)]
    return child.join(values, reduce(Column.__and__, tests), "left_semi")


# -- values ---------------------------------------------------------------------------------


def null_audit(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """``column_name, n_rows, n_null``, all columns in one pass.

    Without ``columns``, those the catalog declares NOT NULL.
    """
    if columns is None:
        columns = [spec.name for spec in rules.specs_of(df) if not spec.nullable]
    if not columns:
        raise ValueError("no columns to audit: none is declared NOT NULL")
    counted = df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        *[F.count_if(F.col(quoted(name)).isNull()).alias(f"_c{i}") for i, name in enumerate(columns)],
    )
    return _unpivot(counted, [[name] for name in columns], ["column_name", "n_null"])


def _fit_checks(spec: ColumnSpec, kind: T.DataType, type_map: Mapping[str, str]) -> list:
    """``(rule, misfit test)`` of one column against its target type."""
    value = F.col(quoted(spec.name))
    wanted = rules.spark_type(spec, type_map)
    declared = rules.target_type(spec, type_map).upper()
    if rules.is_unsized_decimal(spec):
        plain = rules.spark_type(spec, type_map, strict_decimal=True)
        fitted = value.try_cast(plain)
        return [("unsized_decimal", value.isNotNull() & (fitted.isNull() | (fitted != value)))]
    if not rules.is_mapped(spec, type_map):
        return [("unmapped", value.isNotNull())]
    checks = []
    if declared.startswith(("CHAR(", "VARCHAR(")) and isinstance(kind, T.StringType):
        size = int(declared[declared.index("(") + 1 : declared.index(")")])
        checks.append(("too_long", F.char_length(value) > size))
    elif isinstance(wanted, T.DecimalType):
        fitted = value.try_cast(wanted)
        misfit = value.isNotNull() & (fitted.isNull() | (fitted.cast(kind) != value))
        checks.append(("decimal_misfit", misfit))
    elif declared.startswith("TIMESTAMP"):
        moment = value.cast("timestamp_ntz")
        first, last = (
            F.lit(text).cast("timestamp_ntz") for text in (TIMESTAMP_FIRST, TIMESTAMP_LAST)
        )
        beyond = (moment < first) | (moment >= last + F.expr("interval 1 second"))
        checks.append(("timestamp_range", beyond))
    elif wanted is not None and not isinstance(kind, type(wanted)) and not isinstance(
        wanted, (T.StringType, T.BinaryType)
    ):
        checks.append(("not_castable", value.isNotNull() & value.try_cast(wanted).isNull()))
    return checks


def fit_audit(df: DataFrame, type_map: Mapping[str, str] = TYPE_MAP) -> DataFrame:
    """``column_name, rule, n_rows, n_misfit``: values the target type could not hold as they are.

    Rules, from the column descriptions: too_long, decimal_misfit, timestamp_range, not_castable,
    unsized_decimal (a fraction or size DECIMAL(10,0) would lose), unmapped. One pass.
    """
    labels, tests = [], []
    for spec, field in zip(rules.specs_of(df), df.schema.fields):
        for rule, misfit in _fit_checks(spec, field.dataType, type_map):
            labels.append([spec.name, rule])
            tests.append(misfit)
    if not labels:
        raise ValueError("no column has a limit to check; describe the table first")
    counted = df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        *[F.count_if(test).alias(f"_c{i}") for i, test in enumerate(tests)],
    )
    return _unpivot(counted, labels, ["column_name", "rule", "n_misfit"])


def misfits(
    df: DataFrame, type_map: Mapping[str, str] = TYPE_MAP, keys: Sequence[str] = ()
) -> Column:
    """Per row the reasons why the target could not hold it, as ``column: rule`` texts; empty for a
    row that fits. The rules of ``fit_audit`` that single out rows (not ``unmapped`` and
    ``unsized_decimal``, which are about the column), and ``not_null`` for columns that are
    declared so and for ``keys``."""
    reasons = []
    for spec, field in zip(rules.specs_of(df), df.schema.fields):
        checks = [c for c in _fit_checks(spec, field.dataType, type_map) if c[0] not in ("unmapped", "unsized_decimal")]
        if spec.name in keys or not spec.nullable:
            checks.append(("not_null", F.col(quoted(spec.name)).isNull()))
        reasons += [F.when(F.coalesce(test, F.lit(False)), F.lit(f"{spec.name}: {rule}")) for rule, test in checks]
    return F.array_compact(F.array(*reasons)) if reasons else F.array().cast("array<string>")


# -- hex text in exports --------------------------------------------------------------------


def hex_fault(texts: DataFrame, hex_columns: Sequence[str]) -> Column:
    """Why a row of ``csv_files.read_export`` is bad, or NULL.

    ``arity`` (wrong number of fields), then the first fault by column: ``prefix`` (begins with
    ``\\x``), ``odd_length``, ``not_hex``. NULL and empty texts are valid.
    """
    fault = F.when(F.col(BAD_ROW).isNotNull(), "arity")
    for name in hex_columns:
        value = F.col(quoted(name))
        bad = value.isNotNull() & ~value.rlike(HEX_PATTERN)
        fault = (
            fault.when(bad & value.startswith("\\x"), "prefix")
            .when(bad & value.rlike(HEX_DIGITS), "odd_length")
            .when(bad, "not_hex")
        )
    return fault


def _with_fault(texts: DataFrame, hex_columns: Sequence[str]) -> DataFrame:
    return texts.withColumn("fault", hex_fault(texts, hex_columns))


def hex_audit(texts: DataFrame, hex_columns: Sequence[str]) -> DataFrame:
    """``total_rows, bad_rows`` and bad rows by fault, over the whole export in one pass. A table
    without hex columns is audited for its number of fields."""
    faults = ["arity", "prefix", "odd_length", "not_hex"]
    first = quoted(next(name for name in texts.columns if name != BAD_ROW))
    checked = _with_fault(texts, hex_columns).select("fault", first)
    # The reader does not give the raw line alone, so the count looks at a field as well.
    return checked.agg(
        F.count_if(F.length(F.coalesce(F.col(first), F.lit(""))) >= 0).alias("total_rows"),
        F.count("fault").alias("bad_rows"),
        *[F.count_if(F.col("fault") == name).alias(f"n_{name}") for name in faults],
    )


def hex_audit_samples(
    texts: DataFrame, hex_columns: Sequence[str], key: str, max_errors: int = 20
) -> DataFrame:
    """The first ``max_errors`` bad rows by key, with their fault; the counts stay complete."""
    return (
        _with_fault(texts, hex_columns)
        .where(F.col("fault").isNotNull())
        .orderBy(quoted(key), "fault")
        .limit(max_errors)
        .select(quoted(key), "fault", *map(quoted, hex_columns))
    )
