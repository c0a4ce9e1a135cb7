"""One pass/fail decision per loaded table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from tableferry.operators.audits import duplicate_keys, fk_orphans
from tableferry.operators.reconcile import sampled_row_diff, table_counts

STEPS = ["counts", "sample", "keys", "foreign_keys"]
_ROWS = "table_name string, " + ", ".join(f"{step} boolean" for step in STEPS) + ", passed boolean, message string"


@dataclass(frozen=True)
class TableRules:
    """What a table has to keep: its primary key, unique keys, and foreign keys as
    (columns, parent table, parent columns)."""

    primary: Sequence[str]
    unique: Sequence[Sequence[str]] = ()
    foreign: Sequence[tuple[Sequence[str], str, Sequence[str]]] = field(default=())


def _first_fault(
    name: str, source: Mapping[str, DataFrame], target: Mapping[str, DataFrame], rules: TableRules, size: int
):
    """(step, what is wrong) in the order of the steps, or None."""
    ours, theirs = source[name], target[name]
    n_source, n_target = (table_counts({name: df}).first()["n_rows"] for df in (ours, theirs))
    if n_source != n_target:
        return "counts", f"{n_source} rows at the source, {n_target} at the target"
    differing = sampled_row_diff(ours, theirs, rules.primary, size).limit(1).collect()
    if differing:
        return "sample", f"key {tuple(differing[0][: len(rules.primary)])}: {differing[0]['status']}"
    for key, primary in [(rules.primary, True), *((key, False) for key in rules.unique)]:
        if not duplicate_keys(theirs, key, primary=primary).isEmpty():
            return "keys", f"key {list(key)} is repeated or NULL"
    for columns, parent, parent_key in rules.foreign:
        if not fk_orphans(theirs, columns, target[parent], parent_key).isEmpty():
            return "foreign_keys", f"{list(columns)} names rows that {parent} does not have"
    return None


def gate(
    spark: SparkSession,
    source: Mapping[str, DataFrame],
    target: Mapping[str, DataFrame],
    rules: Mapping[str, TableRules],
    size: int = 1000,
) -> DataFrame:
    """``table_name``, one boolean per step, ``passed``, ``message``: one row per table.

    The steps are counts, a field-by-field comparison of the first ``size`` keys, primary and
    unique keys, foreign keys. They stop at the first that fails; later ones are NULL. A table
    that cannot be read or is not there fails its first step. One row per table reaches the driver.
    """
    rows = []
    for name, rule in rules.items():
        try:
            fault = _first_fault(name, source, target, rule, size)
        except Exception as error:  # noqa: BLE001 - whatever reading raises is the finding
            fault = STEPS[0], str(error).splitlines()[0]
        at = STEPS.index(fault[0]) if fault else len(STEPS)
        steps = [True if i < at else False if i == at else None for i in range(len(STEPS))]
        rows.append((name, *steps, fault is None, fault[1] if fault else None))
    return spark.createDataFrame(rows, _ROWS)
