"""CSV exports: no header, NULL as a marker, quotes escaped by a backslash."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tableferry.functions.text import (
    DELIMITER,
    ESCAPE,
    LINE_END,
    NULL_MARKER,
    QUOTE,
    TIMESTAMP_FORMAT,
    export_text,
    quoted,
    refuse_marker,
    refuse_sign,
)

BAD_ROW = "_bad_row"


@dataclass(frozen=True)
class CsvForm:
    """How an export is written and read: another marker carries tables that hold a literal
    ``\\N``, another ``line_end`` makes files with line breaks in their texts splittable."""

    delimiter: str = DELIMITER
    null_marker: str = NULL_MARKER
    quote: str = QUOTE
    escape: str = ESCAPE
    line_end: str = LINE_END


def export_projection(
    df: DataFrame, null_marker: str | None = None, line_end: str = LINE_END
) -> DataFrame:
    """The columns in their export form. With ``null_marker``, a text equal to it is an error, and
    so is one that holds a ``line_end`` other than the usual."""

    def exported(field: T.StructField) -> Column:
        value = F.col(quoted(field.name))
        if isinstance(field.dataType, T.StringType):
            if null_marker is not None:
                value = refuse_marker(value, field.name, null_marker)
            if line_end != LINE_END:
                value = refuse_sign(value, field.name, line_end)
            return value.alias(field.name)
        return export_text(value, field.dataType).alias(field.name)

    return df.select(*[exported(field) for field in df.schema.fields])


# Rows whose texts are measured before an export.
MEASURED_ROWS = 20_000


def rows_of_bytes(df: DataFrame, n_bytes: int) -> int:
    """How many rows of a projection of texts have about ``n_bytes``, by the mean of the first
    ``MEASURED_ROWS``: only their sizes are taken, from the first partitions, so the table is
    neither read twice nor moved to one task."""
    names = [F.coalesce(F.octet_length(F.col(quoted(n)).cast("string")), F.lit(2)) for n in df.columns]
    size = names[0]
    for other in names[1:]:
        size = size + other + 1
    sizes = [row[0] for row in df.select(size).take(MEASURED_ROWS)]
    return max(1, int(n_bytes / max(1.0, sum(sizes) / max(1, len(sizes)))))


def write_export(
    df: DataFrame,
    path: str,
    delimiter: str = DELIMITER,
    null_marker: str = NULL_MARKER,
    quote: str = QUOTE,
    escape: str = ESCAPE,
    line_end: str = LINE_END,
    bytes_per_file: int = 256 << 20,
) -> None:
    """Write one table as CSV part files.

    Files whose texts hold line breaks cannot be split when read, so ``bytes_per_file`` (met as
    far as the rows are as long as the first ones) bounds the work of a reading task. Every row is
    written; a task simply starts another file.

    With a ``line_end`` that no text holds (one sign, such as the record separator x1E; a text that
    holds it is an error) the lines are found without regard to quotes, so files of any size are
    read by as many tasks as one likes.
    """
    rows = export_projection(df, null_marker, line_end)
    (
        rows.write.option("sep", delimiter)
        .option("quote", quote)
        .option("escape", escape)
        .option("lineSep", line_end)
        .option("nullValue", null_marker)
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .option("maxRecordsPerFile", rows_of_bytes(export_projection(df), bytes_per_file))
        .csv(path)
    )


def read_export(
    spark: SparkSession,
    path: str,
    columns: Sequence[str],
    delimiter: str = DELIMITER,
    null_marker: str = NULL_MARKER,
    quote: str = QUOTE,
    escape: str = ESCAPE,
    line_end: str = LINE_END,
    line_breaks: bool = True,
    keep_bad_rows: bool = True,
) -> DataFrame:
    """All columns as text, plus the raw line of rows with a wrong number of fields.

    ``line_breaks=False`` is for tables without free text: their files can be split freely, as can
    those written with a ``line_end`` of their own.
    ``keep_bad_rows=False`` fails on the first such row instead.
    """
    schema = T.StructType([T.StructField(name, T.StringType()) for name in columns])
    reader = (
        spark.read.option("sep", delimiter)
        .option("quote", quote)
        .option("escape", escape)
        .option("nullValue", null_marker)
        .option("multiLine", line_breaks and line_end == LINE_END)
        # Named, because otherwise the parser guesses it and rewrites other breaks within texts.
        .option("lineSep", line_end)
        # Fields are counted only while all columns are parsed.
        .option("columnPruning", False)
        .option("mode", "PERMISSIVE" if keep_bad_rows else "FAILFAST")
    )
    if keep_bad_rows:
        schema = schema.add(BAD_ROW, T.StringType())
        reader = reader.option("columnNameOfCorruptRecord", BAD_ROW)
    return reader.schema(schema).csv(path)


def parse_export(texts: DataFrame, schema: T.StructType) -> DataFrame:
    """Typed columns from exported texts; a text that does not fit its type is an error."""

    def parsed(field: T.StructField) -> Column:
        value, kind = F.col(quoted(field.name)), field.dataType
        if isinstance(kind, T.BinaryType):
            value = F.unhex(value)
        elif isinstance(kind, T.TimestampNTZType):
            value = F.to_timestamp_ntz(value, F.lit(TIMESTAMP_FORMAT))
        elif isinstance(kind, T.TimestampType):
            value = F.to_timestamp(value, TIMESTAMP_FORMAT)
        elif isinstance(kind, T.BooleanType):
            value = value.cast("tinyint").cast("boolean")
        elif not isinstance(kind, T.StringType):
            value = value.cast(kind)
        return value.alias(field.name)

    return texts.select(*[parsed(field) for field in schema.fields])
