"""Comparing two ends: counts, checksums, rows by key, columns, multisets.

No operator here joins the two tables. Both ends are stacked and grouped, so Spark combines the
rows of a key before the shuffle: a key that holds a third of all rows costs one row per task,
and a repeated key never multiplies rows.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tableferry.functions.fingerprint import (
    checksums_of,
    md5_word,
    row_hash,
    row_md5,
    with_row_hash,
    with_row_md5,
    word_sums,
)
from tableferry.functions.text import canonical_sql, quoted, shown_sql
from tableferry.sources.ranges import bounded_split_number, in_splits, key_bounds

Tables = Mapping[str, DataFrame]


def _stack(frames: Sequence[DataFrame]) -> DataFrame:
    """Union in pairs, so that the plan over very many tables stays shallow."""
    frames = list(frames)
    while len(frames) > 1:
        pairs = zip(frames[::2], frames[1::2])
        odd = frames[-1:] if len(frames) % 2 else []
        frames = [one.unionAll(other) for one, other in pairs] + odd
    return frames[0]


# -- whole tables ---------------------------------------------------------------------------


def labelled(one_row_frames: Tables) -> DataFrame:
    """One-row results of several tables as one plan, with their ``table_name`` in front."""
    return _stack(
        [df.select(F.lit(name).alias("table_name"), "*") for name, df in one_row_frames.items()]
    )


def table_counts(tables: Tables) -> DataFrame:
    """``table_name, n_rows``, as one plan over all tables."""
    return labelled(
        {name: df.agg(F.count(F.lit(1)).alias("n_rows")) for name, df in tables.items()}
    )


def table_checksums(
    tables: Tables,
    columns: Mapping[str, Sequence[str]] | None = None,
    double_scale: int | None = None,
    micros: bool = True,
    typed: bool = False,
) -> DataFrame:
    """``table_name, n_rows, checksum`` over all rows of each table, in any order.

    The checksum is made of MD5s any engine can compute. ``typed=True`` hashes the typed values
    instead: much cheaper, but only Spark can repeat it, and only for columns of equal types.
    """
    columns = columns or {}

    def sums(name: str, df: DataFrame) -> DataFrame:
        chosen = columns.get(name, df.columns)
        if typed:
            return word_sums(with_row_hash(df, chosen), typed, name)
        return word_sums(with_row_md5(df, chosen, "__fingerprint", double_scale, micros), typed, name)

    return checksums_of(_stack([sums(name, df) for name, df in tables.items()]))


def _both_ends(source: DataFrame, target: DataFrame, facts: Sequence[str]) -> DataFrame:
    """One row per table with ``source_<fact>`` and ``target_<fact>``; NULL where absent."""
    sides = _stack(
        [
            source.select("table_name", F.lit("source").alias("side"), *facts),
            target.select("table_name", F.lit("target").alias("side"), *facts),
        ]
    )
    picked = [
        F.max(F.when(F.col("side") == side, F.col(fact))).alias(f"{side}_{fact}")
        for fact in facts
        for side in ("source", "target")
    ]
    return sides.groupBy("table_name").agg(*picked)


def compare_counts(source: DataFrame, target: DataFrame) -> DataFrame:
    """``table_name, source_count, target_count, matched`` from two results of ``table_counts``
    (or of counts taken elsewhere, such as by a database)."""
    both = _both_ends(
        source.withColumnRenamed("n_rows", "count"),
        target.withColumnRenamed("n_rows", "count"),
        ["count"],
    )
    matched = F.coalesce(F.col("source_count") == F.col("target_count"), F.lit(False))
    return both.withColumn("matched", matched)


def reconcile_counts(sources: Tables, targets: Tables) -> DataFrame:
    """``table_name, source_count, target_count, matched``."""
    return compare_counts(table_counts(sources), table_counts(targets))


def reconcile_checksums(
    sources: Tables,
    targets: Tables,
    columns: Mapping[str, Sequence[str]] | None = None,
    double_scale: int | None = None,
    micros: bool = True,
    typed: bool = False,
    counts: bool = False,
) -> DataFrame:
    """``table_name, source_checksum, target_checksum, matched``, over whole tables; with
    ``counts`` also ``source_n_rows, target_n_rows``, which the same pass yields.

    Hand in conformed tables, so that true and 1 have the same text. ``typed`` as in
    ``table_checksums``; the types of the two ends are brought together first.
    """
    columns = columns or {name: df.columns for name, df in sources.items()}
    if typed:
        shared = {
            name: comparable(sources[name], targets[name], columns[name])
            for name in sources
            if name in targets
        }
        sources = {**sources, **{name: pair[0] for name, pair in shared.items()}}
        targets = {**targets, **{name: pair[1] for name, pair in shared.items()}}
    both = _both_ends(
        table_checksums(sources, columns, double_scale, micros, typed),
        table_checksums(targets, columns, double_scale, micros, typed),
        ["checksum", "n_rows"] if counts else ["checksum"],
    )
    matched = F.coalesce(F.col("source_checksum") == F.col("target_checksum"), F.lit(False))
    return both.withColumn("matched", matched)


# -- samples --------------------------------------------------------------------------------


# Tasks hand their smallest keys to so many tasks, and these to the one that picks among them.
_HANDOVERS = 128


def last_sampled_key(df: DataFrame, keys: Sequence[str], size: int = 1000) -> Row | None:
    """The ``size``-th smallest key. Only the key columns are read; every task passes on its
    ``size`` smallest keys, in two steps, so no task gets the keys of all. None for an empty
    table."""
    names = [quoted(name) for name in keys]
    marked = df.select(*names).withColumn("_from", F.pmod(F.spark_partition_id(), F.lit(_HANDOVERS)))
    rank = F.row_number().over(Window.partitionBy("_from").orderBy(*names))
    smallest = marked.withColumn("_rank", rank).where(F.col("_rank") <= size).select(*names)
    return smallest.orderBy(*names).limit(size).agg(F.max(F.struct(*names))).first()[0]


def rows_up_to_key(df: DataFrame, keys: Sequence[str], last: Row | None) -> DataFrame:
    """The rows with keys up to ``last``, NULL keys first; the leading key filters the scan."""
    if last is None:
        return df
    lead = F.col(quoted(keys[0]))
    wanted = F.lit(True) if last[0] is None else lead <= F.lit(last[0])
    if len(keys) > 1:
        limit = F.struct(*[F.lit(value).cast(df.schema[k].dataType) for k, value in zip(keys, last)])
        together = F.struct(*map(quoted, keys))
        wanted = wanted & (together <= limit)
        return df.where(wanted | (lead.isNull() & (together <= limit)))
    return df.where(lead.isNull() if last[0] is None else wanted | lead.isNull())


def rows_by_key_share(
    df: DataFrame, keys: Sequence[str], share: float, double_scale: int | None = None
) -> DataFrame:
    """The rows whose key falls into a fixed share of all keys, the same keys at both ends.

    Decided row by row from the key's MD5: no sort, no shuffle, and as large as wanted.
    """
    word = md5_word(row_md5(df, keys, double_scale), 1)
    return df.where(f"{word} < {int(share * (1 << 32))}")


def sampled_checksums(
    sources: Tables,
    targets: Tables,
    keys: Mapping[str, Sequence[str]],
    size: int = 1000,
    share: float | None = None,
    typed: bool = False,
) -> DataFrame:
    """``reconcile_checksums`` over a sample that both ends draw alike.

    By default each end's own first ``size`` keys (one small query per table and end finds the
    last of them); with ``share``, that share of all keys, which also suits very large samples.
    """
    ours, theirs = {}, {}
    for name, df in sources.items():
        key = keys[name]
        if share is not None:
            ours[name] = rows_by_key_share(df, key, share)
            theirs[name] = rows_by_key_share(targets[name], key, share)
        else:
            ours[name], theirs[name] = (
                rows_up_to_key(end, key, last_sampled_key(end, key, size))
                for end in (df, targets[name])
            )
    columns = {name: df.columns for name, df in sources.items()}
    return reconcile_checksums(ours, theirs, columns, typed=typed)


# -- rows and columns -----------------------------------------------------------------------


def _common_type(one: T.DataType, other: T.DataType) -> T.DataType | None:
    """Type in which values of both types can be compared; None when only their texts can."""
    whole = (T.BooleanType, T.ByteType, T.ShortType, T.IntegerType, T.LongType)
    floating = (T.FloatType, T.DoubleType)
    moments = (T.DateType, T.TimestampType, T.TimestampNTZType)
    pair = (one, other)
    if all(isinstance(kind, whole) for kind in pair):
        return T.LongType()
    if all(isinstance(kind, moments) for kind in pair):
        return T.TimestampNTZType()
    if all(isinstance(kind, T.StringType) for kind in pair):
        return T.StringType()
    exact = whole[1:] + (T.DecimalType,)
    if all(isinstance(kind, exact) for kind in pair):
        scale = max(kind.scale if isinstance(kind, T.DecimalType) else 0 for kind in pair)
        return T.DecimalType(38, scale)
    if all(isinstance(kind, exact + floating) for kind in pair):
        return T.DoubleType()
    return None


def comparable(
    source: DataFrame, target: DataFrame, columns: Sequence[str]
) -> tuple[DataFrame, DataFrame]:
    """Both ends cut down to ``columns``, with one type per column."""
    absent = [name for name in columns if name not in source.columns or name not in target.columns]
    if absent:
        raise ValueError(f"columns not present at both ends: {absent}")
    left, right = [], []
    for name in columns:
        one, other = source.schema[name].dataType, target.schema[name].dataType
        if one == other:
            left.append(quoted(name))
            right.append(quoted(name))
            continue
        common = _common_type(one, other)
        for side, kind in ((left, one), (right, other)):
            value = F.col(quoted(name))
            text = F.expr(canonical_sql(quoted(name), kind))
            shared = text if common is None else value.cast(common)
            side.append(shared.alias(name))
    return source.select(*left), target.select(*right)


def _paired(
    source: DataFrame,
    target: DataFrame,
    keys: Sequence[str],
    digests: Mapping[str, Column],
) -> DataFrame:
    """Per key: ``n_source``, ``n_target`` and, per digest, the XOR over all its rows.

    With one row on either side the XOR is zero exactly when the two digests agree. Only the key
    and 64-bit digests are shuffled, never the rows.
    """

    def side(df: DataFrame, in_source: int) -> DataFrame:
        return df.select(
            *map(quoted, keys),
            F.lit(in_source).alias("_in_source"),
            F.lit(1 - in_source).alias("_in_target"),
            *[digest.alias(name) for name, digest in digests.items()],
        )

    return (
        side(source, 1)
        .unionAll(side(target, 0))
        .groupBy(*map(quoted, keys))
        .agg(
            F.sum("_in_source").alias("n_source"),
            F.sum("_in_target").alias("n_target"),
            *[F.bit_xor(name).alias(name) for name in digests],
        )
    )


def row_status(
    source: DataFrame,
    target: DataFrame,
    keys: Sequence[str],
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """One row per key: the key, ``status``, ``n_source``, ``n_target``.

    ``missing`` at the target, ``extra`` at the target, ``same``, ``changed``, or ``duplicated``
    where an end holds the key more than once and rows cannot be paired. NULL keys are one key.
    """
    columns = list(columns or [name for name in source.columns if name not in keys])
    left, right = comparable(source, target, [*keys, *columns])
    digest = F.expr(row_hash(columns)) if columns else F.lit(0).cast("bigint")
    status = (
        F.when(F.col("n_target") == 0, "missing")
        .when(F.col("n_source") == 0, "extra")
        .when((F.col("n_source") > 1) | (F.col("n_target") > 1), "duplicated")
        .when(F.col("_digest") != 0, "changed")
        .otherwise("same")
    )
    return _paired(left, right, keys, {"_digest": digest}).select(
        *map(quoted, keys), status.alias("status"), "n_source", "n_target"
    )


def row_diff(
    source: DataFrame,
    target: DataFrame,
    keys: Sequence[str],
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """The keys of ``row_status`` that are not the same at both ends."""
    return row_status(source, target, keys, columns).where(F.col("status") != "same")


def differing_ranges(
    source: DataFrame,
    target: DataFrame,
    key: str,
    parts: int = 1024,
    columns: Sequence[str] | None = None,
) -> tuple[list[int], tuple[int | None, int | None]]:
    """Numbers of the equal-width key intervals whose rows differ between the ends, and the key
    bounds of the source that fix the intervals (-1 and ``parts`` lie below and above them).

    Each task adds up its hashes per interval, so at most ``parts + 2`` small rows per task are
    shuffled, and as many compared.
    """
    columns = list(columns or source.columns)
    left, right = comparable(source, target, list(dict.fromkeys([key, *columns])))
    low, high = key_bounds(left, key)
    if low is None:
        return [], (None, None)
    number = bounded_split_number(key, low, high, parts)

    def sums(df: DataFrame, sign: int) -> DataFrame:
        hashed = df.select(number.alias("part"), F.expr(row_hash(df.columns)).alias("h"))
        return hashed.selectExpr(
            "part",
            f"{sign} AS n",
            f"{sign} * (h & 2097151) AS a",
            f"{sign} * (shiftright(h, 21) & 2097151) AS b",
            f"{sign} * shiftright(h, 42) AS c",
        )

    unequal = (
        sums(left, 1)
        .unionAll(sums(right, -1))
        .groupBy("part")
        .agg(*[F.sum(name).alias(name) for name in ("n", "a", "b", "c")])
        .where("n <> 0 OR a <> 0 OR b <> 0 OR c <> 0")
    )
    return sorted(row.part for row in unequal.select("part").collect()), (low, high)


def row_diff_by_range(
    source: DataFrame,
    target: DataFrame,
    key: str,
    parts: int = 1024,
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """``row_diff`` for ends that hold the same rows but for a few places.

    The key intervals are compared by checksum first, without shuffling rows; only rows of
    intervals that differ are then compared, and the interval bounds filter their scans. Where
    differences are spread over all intervals, ``row_diff`` alone is cheaper.
    """
    found, (low, high) = differing_ranges(source, target, key, parts, columns)
    if low is None:
        return row_diff(source, target, [key], columns)
    wanted = in_splits(key, low, high, parts, found)
    return row_diff(source.where(wanted), target.where(wanted), [key], columns)


def sampled_row_diff(
    source: DataFrame,
    target: DataFrame,
    keys: Sequence[str],
    size: int = 1000,
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """``row_diff`` of each end's own first ``size`` keys, field by field."""
    ends = [rows_up_to_key(end, keys, last_sampled_key(end, keys, size)) for end in (source, target)]
    return row_diff(*ends, keys, columns)


def row_diff_summary(
    source: DataFrame,
    target: DataFrame,
    keys: Sequence[str],
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """``status, n_keys``."""
    return (
        row_status(source, target, keys, columns)
        .groupBy("status")
        .agg(F.count(F.lit(1)).alias("n_keys"))
    )


def column_diff(
    source: DataFrame,
    target: DataFrame,
    keys: Sequence[str],
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """``column_name, n_compared, n_different`` over the keys held once by either end."""
    columns = list(columns or [name for name in source.columns if name not in keys])
    left, right = comparable(source, target, [*keys, *columns])
    digests = {f"_d{index}": F.xxhash64(F.col(quoted(name))) for index, name in enumerate(columns)}
    pairs = _paired(left, right, keys, digests).where("n_source = 1 AND n_target = 1")
    different = [F.count_if(F.col(name) != 0).alias(name) for name in digests]
    counted = pairs.agg(F.count(F.lit(1)).alias("n_compared"), *different)
    rows = [F.lit(part) if index % 2 == 0 else F.col(part)
            for pair in zip(columns, digests) for index, part in enumerate(pair)]
    return counted.select(
        "n_compared", F.stack(F.lit(len(columns)), *rows).alias("column_name", "n_different")
    ).select("column_name", "n_compared", "n_different")


def changed_values(
    source: DataFrame,
    target: DataFrame,
    keys: Sequence[str],
    diff: DataFrame,
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """Key, ``column_name``, ``source_value``, ``target_value`` of every field that differs.

    ``diff`` is the result of ``row_diff``, best written and read back (``session.written``): the
    planner then knows its size and broadcasts it only if it is small. Its changed keys occur
    once at each end, so the joins cannot multiply rows.
    """
    columns = list(columns or [name for name in source.columns if name not in keys])
    left, right = comparable(source, target, [*keys, *columns])
    changed = diff.where(F.col("status") == "changed").select(*map(quoted, keys))

    def renamed(df: DataFrame, prefix: str) -> DataFrame:
        return df.select(*[F.col(quoted(name)).alias(prefix + name) for name in df.columns])

    def same_key(one: str, other: str) -> Column:
        tests = [F.col(quoted(one + name)).eqNullSafe(F.col(quoted(other + name))) for name in keys]
        return reduce(Column.__and__, tests)

    joined = (
        renamed(changed, "k_")
        .join(renamed(left, "s_"), same_key("k_", "s_"))
        .join(renamed(right, "t_"), same_key("k_", "t_"))
    )
    fields = []
    for index, name in enumerate(columns):
        kind = left.schema[name].dataType
        one, other = quoted("s_" + name), quoted("t_" + name)
        shown = [shown_sql(end, kind) for end in (one, other)]
        fields.append(
            f"IF({one} <=> {other}, NULL, named_struct('column_index', {index}, "
            f"'source_value', {shown[0]}, 'target_value', {shown[1]}))"
        )
    names = F.array(*[F.lit(name) for name in columns])
    key_columns = [F.col(quoted("k_" + name)).alias(name) for name in keys]
    found = F.expr(f"explode(array_compact(array({', '.join(fields)})))")
    return joined.select(*key_columns, found.alias("field")).select(
        *map(quoted, keys),
        F.get(names, "field.column_index").alias("column_name"),
        "field.source_value",
        "field.target_value",
    )


# -- tables without a key -------------------------------------------------------------------


def _unequal(left: DataFrame, right: DataFrame, by: Sequence[str]) -> DataFrame:
    """``by, n_source, n_target`` of the values the ends hold in unequal number."""

    def side(df: DataFrame, in_source: int) -> DataFrame:
        return df.select(
            *map(quoted, by),
            F.lit(in_source).alias("_in_source"),
            F.lit(1 - in_source).alias("_in_target"),
        )

    return (
        side(left, 1)
        .unionAll(side(right, 0))
        .groupBy(*map(quoted, by))
        .agg(F.sum("_in_source").alias("n_source"), F.sum("_in_target").alias("n_target"))
        .where("n_source <> n_target")
    )


def multiset_suspects(
    source: DataFrame, target: DataFrame, columns: Sequence[str] | None = None
) -> DataFrame:
    """``row_hash, n_source, n_target`` of every hash the ends hold in unequal number.

    Copies of a row are counted before the shuffle, and only 64-bit hashes travel. Written
    (``session.written``), the result says which rows ``multiset_diff`` has to look at.
    """
    columns = list(columns or source.columns)
    left, right = comparable(source, target, columns)
    hashed = [df.selectExpr(f"{row_hash(columns)} AS row_hash") for df in (left, right)]
    return _unequal(*hashed, ["row_hash"])


def multiset_diff(
    source: DataFrame,
    target: DataFrame,
    suspects: DataFrame,
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """One row per distinct row value the ends hold in unequal number: the columns,
    ``n_source``, ``n_target``.

    Only rows with a suspect hash are compared, and those by their values, so rows that merely
    share a hash with a difference are not reported.
    """
    columns = list(columns or source.columns)
    left, right = comparable(source, target, columns)
    wanted = suspects.select(F.col("row_hash").alias("_row_hash"))
    found = [
        df.withColumn("_row_hash", F.expr(row_hash(columns))).join(
            wanted, "_row_hash", "left_semi"
        )
        for df in (left, right)
    ]
    return _unequal(*found, columns)


def fingerprint_diff(
    source: DataFrame,
    target: DataFrame,
    columns: Sequence[str] | None = None,
    double_scale: int | None = None,
    micros: bool = True,
) -> DataFrame:
    """``fingerprint, n_source, n_target``: as ``multiset_suspects``, by MD5s other engines can
    compute as well, with doubles and timestamps at the precision of the checksums."""
    columns = list(columns or source.columns)
    marked = [
        with_row_md5(df, columns, "_row_md5", double_scale, micros).selectExpr("_row_md5 AS fingerprint")
        for df in comparable(source, target, columns)
    ]
    return _unequal(*marked, ["fingerprint"])
