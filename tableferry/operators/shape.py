"""Shaping a table for the target: leave out, conform, align."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tableferry.functions import types as rules
from tableferry.functions.text import quoted
from tableferry.functions.types import IGNORED_WORDS, TYPE_MAP


def ignored_columns(df: DataFrame, words: Sequence[str] = IGNORED_WORDS) -> list[str]:
    """Columns the target has no type for, in table order."""
    return [spec.name for spec in rules.specs_of(df) if rules.is_ignored(spec, words)]


def column_plan(
    df: DataFrame,
    type_map: Mapping[str, str] = TYPE_MAP,
    words: Sequence[str] = IGNORED_WORDS,
) -> list[tuple[str, str, str | None, str]]:
    """``(column, source type, target type, note)`` per column, so that nothing is left out or
    guessed in silence. Notes: ``ignored``, ``unmapped``, ``unsized_decimal``."""
    plan = []
    for spec in rules.specs_of(df):
        if rules.is_ignored(spec, words):
            plan.append((spec.name, spec.data_type, None, "ignored"))
            continue
        note = "" if rules.is_mapped(spec, type_map) else "unmapped"
        if rules.is_unsized_decimal(spec):
            note = "unsized_decimal"
        plan.append((spec.name, spec.data_type, rules.target_type(spec, type_map), note))
    return plan


def prune_unsupported(df: DataFrame, words: Sequence[str] = IGNORED_WORDS) -> DataFrame:
    """The table without those columns; they are not read from the source either."""
    return df.drop(*ignored_columns(df, words))


def conform_table(
    df: DataFrame,
    type_map: Mapping[str, str] = TYPE_MAP,
    expressions: Mapping[str, Column] | None = None,
    strict_decimal: bool = False,
) -> DataFrame:
    """Cast every column to the type its target column has. NULL stays NULL.

    ``expressions`` replaces the cast of single columns. A value that does not fit is an error,
    never a silent NULL; ``audits.fit_audit`` finds such values beforehand.
    """
    expressions = expressions or {}

    def conformed(field: T.StructField) -> Column | str:
        spec = rules.spec_of_field(field)
        if spec.name in expressions:
            return expressions[spec.name].alias(spec.name)
        kind = rules.spark_type(spec, type_map, strict_decimal)
        if kind is None or kind == field.dataType:
            return quoted(spec.name)
        return F.col(quoted(spec.name)).cast(kind).alias(spec.name)

    return df.select(*[conformed(field) for field in df.schema.fields])


def schema_changes(
    current: T.StructType, desired: T.StructType, renames: Mapping[str, str] | None = None
) -> list[tuple[str, str, str | None, str | None]]:
    """``(column, change, type now, type wanted)`` per difference; metadata only.

    ``renames`` maps a desired name to the current one.
    """
    renames = renames or {}
    now = {field.name: field.dataType for field in current.fields}
    changes, used = [], set()
    for field in desired.fields:
        source = renames.get(field.name, field.name)
        used.add(source)
        wanted = field.dataType.simpleString()
        if source not in now:
            changes.append((field.name, "added", None, wanted))
        elif now[source] != field.dataType:
            changes.append((field.name, "retyped", now[source].simpleString(), wanted))
        elif source != field.name:
            changes.append((field.name, "renamed", now[source].simpleString(), wanted))
    for name, kind in now.items():
        if name not in used:
            changes.append((name, "removed", kind.simpleString(), None))
    return changes


def evolve_table(
    df: DataFrame,
    desired: T.StructType,
    renames: Mapping[str, str] | None = None,
    expressions: Mapping[str, Column] | None = None,
) -> DataFrame:
    """The table in the desired schema: columns added with their default, cast, removed.

    Defaults are taken from the field metadata (``default``), as catalogs write them. A new
    column that may not be NULL and has no default is an error. A column that is there already
    and may not be NULL gets its default where it is NULL; without a default the job fails on
    such a row.
    """
    renames, expressions = renames or {}, expressions or {}

    def aligned(field: T.StructField) -> Column:
        if field.name in expressions:
            value = expressions[field.name]
        elif renames.get(field.name, field.name) in df.columns:
            value = F.col(quoted(renames.get(field.name, field.name)))
        else:
            spec = rules.spec_of_field(field)
            if not field.nullable and not rules.normalize_default(spec):
                raise ValueError(f"new column {field.name!r} needs a default or an expression")
            value = rules.default_column(spec)
        value = value.cast(field.dataType)
        if not field.nullable:
            spec = rules.spec_of_field(field)
            stop = F.raise_error(F.lit(f"column {field.name} must not be NULL"))
            filled = rules.default_column(spec) if rules.normalize_default(spec) else stop
            value = F.coalesce(value, filled.cast(field.dataType))
        return value.alias(field.name)

    return df.select(*[aligned(field) for field in desired.fields])
