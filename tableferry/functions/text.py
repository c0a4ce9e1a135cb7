"""Text forms of values: the canonical form that is compared, and the form that is exported."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The CSV form of the exports.
DELIMITER = ","
QUOTE = '"'
ESCAPE = "\\"
LINE_END = "\n"
NULL_MARKER = "\\N"
TIMESTAMP_FORMAT = "yyyy-MM-dd HH:mm:ss"
DATE_FORMAT = "yyyy-MM-dd"

# Fixed value: hexadecimal text of whole bytes.
HEX_PATTERN = "^([0-9a-fA-F]{2})*$"
HEX_DIGITS = "^[0-9a-fA-F]*$"


def quoted(name: str) -> str:
    """A column name for use in a SQL expression."""
    return "`" + name.replace("`", "``") + "`"


def hex_text(value: Column) -> Column:
    return F.lower(F.hex(value))


def double_power_sql(value: str) -> str:
    """Expression for the power of two of a double's leading digit, off by one at the most; 0 for
    zero, infinities and NaN."""
    size = f"abs(CAST({value} AS DOUBLE))"
    return f"IF({size} > 0 AND {size} < CAST('Infinity' AS DOUBLE), CAST(floor(log2({size})) AS INT), 0)"


def double_scaled_sql(value: str, power: str) -> str:
    """Expression for a double's size scaled by that power, about 2**52 to 2**53. Only scaling by
    powers of two, in two steps that stay finite, which every engine does without rounding."""
    up = f"(52 - {power})"
    return f"(abs(CAST({value} AS DOUBLE)) * pow(2D, floor({up} / 2)) * pow(2D, {up} - floor({up} / 2)))"


def exact_double_sql(value: str, power: str | None = None, scaled: str | None = None) -> str:
    """Expression for a double's exact value as ``<sign><whole number>p<power of two>``, the
    whole number between 2**52 and 2**53; zero (of either sign) is ``0``.

    The logarithm may be off by one next to a power of two; the scaled value shows that and it is
    put right. ``power`` and ``scaled`` name columns that hold these; without them the steps are
    written out again wherever they are needed, which is many times slower.
    """
    d = f"CAST({value} AS DOUBLE)"
    power = power or double_power_sql(value)
    scaled = scaled or double_scaled_sql(value, power)

    def written(number: str, power_of_two: str) -> str:
        return f"CAST(CAST({number} AS BIGINT) AS STRING) || 'p' || CAST({power_of_two} AS STRING)"

    return (
        f"CASE WHEN isnan({d}) THEN 'NaN' WHEN {d} = 0 THEN '0' "
        f"WHEN abs({d}) = CAST('Infinity' AS DOUBLE) THEN IF({d} > 0, 'Infinity', '-Infinity') "
        f"ELSE IF({d} < 0, '-', '') || CASE "
        f"WHEN {scaled} < {2**52}D THEN {written(f'{scaled} * 2', f'{power} - 53')} "
        f"WHEN {scaled} >= {2**53}D THEN {written(f'{scaled} / 2', f'{power} - 51')} "
        f"ELSE {written(scaled, f'{power} - 52')} END END"
    )


def canonical_sql(
    value: str,
    kind: T.DataType,
    double_scale: int | None = None,
    micros: bool = True,
    steps: tuple[str, str] | tuple[()] = (),
) -> str:
    """Expression for one text per value, the same whichever engine or type width holds it.

    Exact by default: doubles by ``exact_double_sql``, timestamps with microseconds. With
    ``double_scale`` doubles become a whole number of units of ``10**-double_scale``, and only
    those too large for that keep the exact form; ``micros=False`` cuts timestamps to seconds.
    NULL stays NULL. ``steps`` as in ``exact_double_sql``.
    """
    if isinstance(kind, T.BooleanType):
        return f"CAST(CAST({value} AS TINYINT) AS STRING)"
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        if double_scale is None:
            return exact_double_sql(value, *steps)
        units = f"CAST(floor(CAST({value} AS DOUBLE) * 1e{double_scale}D + 0.5D) AS STRING)"
        return f"IF(abs({value}) < 1e{18 - double_scale}D, {units}, {exact_double_sql(value, *steps)})"
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        pattern = TIMESTAMP_FORMAT + (".SSSSSS" if micros else "")
        return f"date_format({value}, '{pattern}')"
    return shown_sql(value, kind)


def shown_sql(value: str, kind: T.DataType) -> str:
    """Expression for the full value as a text a reader can compare."""
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return f"date_format({value}, '{TIMESTAMP_FORMAT}.SSSSSS')"
    if isinstance(kind, T.DateType):
        return f"date_format({value}, '{DATE_FORMAT}')"
    if isinstance(kind, T.BinaryType):
        return f"lower(hex({value}))"
    return f"CAST({value} AS STRING)"


def export_text(value: Column, kind: T.DataType) -> Column:
    """Export form: booleans 1/0, timestamps to the second, dates, lower-case hex; NULL kept."""
    if isinstance(kind, T.BooleanType):
        return value.cast("tinyint")
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return F.date_format(value, TIMESTAMP_FORMAT)
    if isinstance(kind, T.DateType):
        return F.date_format(value, DATE_FORMAT)
    if isinstance(kind, T.BinaryType):
        return hex_text(value)
    return value


def refuse_marker(value: Column, name: str, marker: str = NULL_MARKER) -> Column:
    """Fail the job on a text that equals the NULL marker: it could not be told from NULL."""
    message = F.lit(f"column {name} holds the text {marker}, which the export uses for NULL")
    return F.when(value == F.lit(marker), F.raise_error(message).cast("string")).otherwise(value)


def refuse_sign(value: Column, name: str, sign: str) -> Column:
    """Fail the job on a text that holds the sign which ends lines."""
    message = F.lit(f"column {name} holds the sign {sign!r}, which ends the lines of the export")
    return F.when(F.contains(value, F.lit(sign)), F.raise_error(message).cast("string")).otherwise(value)


def marker_to_null(value: Column, marker: str = NULL_MARKER) -> Column:
    return F.nullif(value, F.lit(marker))
