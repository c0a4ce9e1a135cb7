"""Column descriptions, the type map, the ignore rule and default values.

Everything here works on metadata of a few columns; no table data passes through.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Source type -> target type. {precision}, {scale} and {length} are filled in from
# the column description.
TYPE_MAP = {
    "smallint": "SMALLINT",
    "integer": "INT",
    "bigint": "BIGINT",
    "serial": "INT AUTO_INCREMENT",
    "bigserial": "BIGINT AUTO_INCREMENT",
    "decimal": "DECIMAL({precision},{scale})",
    "numeric": "DECIMAL({precision},{scale})",
    "real": "FLOAT",
    "double precision": "DOUBLE",
    "boolean": "TINYINT(1)",
    "char": "CHAR({length})",
    "varchar": "VARCHAR({length})",
    "text": "LONGTEXT",
    "bytea": "LONGBLOB",
    "date": "DATE",
    "timestamp": "TIMESTAMP",
    "timestamptz": "TIMESTAMP",
    "uuid": "VARCHAR(36)",
    "enum": "VARCHAR(255)",
}

# Long type names -> the names used in the type map.
TYPE_ALIASES = {
    "character varying": "varchar",
    "character": "char",
    "timestamp with time zone": "timestamptz",
    "timestamp without time zone": "timestamp",
}

# Columns whose type contains one of these words are left out.
IGNORED_WORDS = ("json", "jsonb", "array")

# Spellings of boolean defaults.
TRUE_WORDS = ("true", "t", "1")
FALSE_WORDS = ("false", "f", "0")

# Target type name -> Spark type, for the types without parameters.
_SPARK_TYPES = {
    "TINYINT": T.ByteType(),
    "SMALLINT": T.ShortType(),
    "INT": T.IntegerType(),
    "INTEGER": T.IntegerType(),
    "BIGINT": T.LongType(),
    "FLOAT": T.FloatType(),
    "DOUBLE": T.DoubleType(),
    "CHAR": T.StringType(),
    "VARCHAR": T.StringType(),
    "TEXT": T.StringType(),
    "MEDIUMTEXT": T.StringType(),
    "LONGTEXT": T.StringType(),
    "BINARY": T.BinaryType(),
    "VARBINARY": T.BinaryType(),
    "BLOB": T.BinaryType(),
    "LONGBLOB": T.BinaryType(),
    "DATE": T.DateType(),
    "TIMESTAMP": T.TimestampNTZType(),
    "DATETIME": T.TimestampNTZType(),
}

_SIZED = re.compile(r"^(?P<name>[^(]+?)\s*\((?P<size>[0-9, ]+)\)(?P<rest>.*)$")
_TRAILING_CAST = re.compile(r"::[A-Za-z0-9_ ]+(\([0-9, ]+\))?(\[\])*$")


@dataclass(frozen=True)
class ColumnSpec:
    """What a database catalog says about one column."""

    name: str
    data_type: str
    udt_name: str = ""
    length: int | None = None
    precision: int | None = None
    scale: int | None = None
    nullable: bool = True
    default: str | None = None

    @classmethod
    def from_catalog(cls, row: Mapping) -> ColumnSpec:
        """From a row of ``information_schema.columns``; only the name and type are required."""
        return cls(
            name=row["column_name"],
            data_type=row.get("data_type") or "",
            udt_name=row.get("udt_name") or "",
            length=row.get("character_maximum_length"),
            precision=row.get("numeric_precision"),
            scale=row.get("numeric_scale"),
            nullable=(row.get("is_nullable") or "YES").upper() != "NO",
            default=row.get("column_default"),
        )

    @property
    def sizes(self) -> list[int]:
        """Sizes written inside the type name, as in ``varchar(20)``."""
        match = _SIZED.match(self.data_type)
        return [int(part) for part in match["size"].split(",")] if match else []

    @property
    def base(self) -> str:
        """Lower-case type name without sizes, aliases resolved."""
        match = _SIZED.match(self.data_type)
        name = (match["name"] + match["rest"]) if match else self.data_type
        name = name.strip().lower()
        return TYPE_ALIASES.get(name, name)


def target_type(spec: ColumnSpec, type_map: Mapping[str, str] = TYPE_MAP) -> str:
    """Type name at the target; a type the map does not know keeps its upper-cased name."""
    base, sizes = spec.base, spec.sizes
    if base in ("char", "varchar"):
        length = spec.length or (sizes[0] if sizes else None)
        if length is None:
            if base == "varchar":
                return type_map.get("text", "TEXT")
            length = 1
        return type_map.get(base, base.upper() + "({length})").format(length=length)
    if base in ("decimal", "numeric"):
        precision = spec.precision or (sizes[0] if sizes else 10)
        scale = spec.scale if spec.scale is not None else (sizes[1] if len(sizes) > 1 else 0)
        return type_map.get(base, type_map.get("decimal", TYPE_MAP["decimal"])).format(
            precision=precision, scale=scale
        )
    return type_map.get(base, spec.data_type.upper())


def is_unsized_decimal(spec: ColumnSpec) -> bool:
    return spec.base in ("decimal", "numeric") and not spec.precision and not spec.sizes


def is_mapped(spec: ColumnSpec, type_map: Mapping[str, str] = TYPE_MAP) -> bool:
    return spec.base in type_map


def spark_type(
    spec: ColumnSpec,
    type_map: Mapping[str, str] = TYPE_MAP,
    strict_decimal: bool = False,
) -> T.DataType | None:
    """Spark type a column is conformed to, read off its target type.

    ``None`` means "leave as it is": a decimal declared without a precision, which would lose
    its fraction as DECIMAL(10,0). ``strict_decimal=True`` conforms even those.
    """
    if is_unsized_decimal(spec) and not strict_decimal:
        return None
    if not is_mapped(spec, type_map):
        return T.StringType()
    declared = target_type(spec, type_map).upper()
    name = re.split(r"[( ]", declared, maxsplit=1)[0]
    if name in ("DECIMAL", "NUMERIC"):
        match = _SIZED.match(declared)
        parts = [int(part) for part in match["size"].split(",")] if match else [10, 0]
        return T.DecimalType(*parts)
    return _SPARK_TYPES.get(name, T.StringType())


def is_ignored(spec: ColumnSpec, words: Sequence[str] = IGNORED_WORDS) -> bool:
    """Arrays are always left out (their udt starts with ``_``), other types by word."""
    data_type, udt = spec.data_type.lower(), spec.udt_name.lower()
    return udt.startswith("_") or any(word in data_type or word in udt for word in words)


def normalize_default(spec: ColumnSpec) -> str:
    """Text of a column default at the target; empty when there is none to carry over."""
    text = (spec.default or "").strip()
    if not text or "nextval(" in text.lower() or spec.base in ("serial", "bigserial"):
        return ""
    text = _TRAILING_CAST.sub("", text).strip()
    if text.startswith("(") and text.endswith(")"):
        text = text[1:-1].strip()
    text = _TRAILING_CAST.sub("", text).strip()
    word = text.lower().strip("'")
    if spec.base == "boolean" and word in TRUE_WORDS:
        return "1"
    if spec.base == "boolean" and word in FALSE_WORDS:
        return "0"
    return "CURRENT_TIMESTAMP" if text.lower() == "now()" else text


def default_column(spec: ColumnSpec) -> Column:
    """The default as a literal; NULL when there is none."""
    text = normalize_default(spec)
    if not text or text.upper() == "NULL":
        return F.lit(None)
    if text == "CURRENT_TIMESTAMP":
        return F.current_timestamp()
    if len(text) > 1 and text[0] == text[-1] == "'":
        return F.lit(text[1:-1].replace("''", "'"))
    if re.fullmatch(r"[-+]?[0-9]+(\.[0-9]*)?([eE][-+]?[0-9]+)?", text):
        return F.lit(text)
    raise ValueError(f"default of {spec.name!r} is not a literal; pass an expression: {text}")


def spec_of_field(field: T.StructField) -> ColumnSpec:
    """Description of a Spark column; what its metadata says about the source wins."""
    meta = field.metadata or {}
    if "source_type" in meta:
        return ColumnSpec(
            name=field.name,
            data_type=meta["source_type"],
            udt_name=meta.get("udt_name", ""),
            length=meta.get("length"),
            precision=meta.get("precision"),
            scale=meta.get("scale"),
            nullable=meta.get("nullable", field.nullable),
            default=meta.get("default"),
        )
    plain = {
        T.BooleanType: "boolean", T.ByteType: "smallint", T.ShortType: "smallint",
        T.IntegerType: "integer", T.LongType: "bigint", T.FloatType: "real",
        T.DoubleType: "double precision", T.StringType: "text", T.BinaryType: "bytea",
        T.DateType: "date", T.TimestampNTZType: "timestamp", T.TimestampType: "timestamptz",
    }
    kind = field.dataType
    if isinstance(kind, T.DecimalType):
        return ColumnSpec(
            field.name, "numeric", "numeric", precision=kind.precision, scale=kind.scale,
            nullable=field.nullable,
        )
    if isinstance(kind, T.ArrayType):
        return ColumnSpec(
            field.name, "ARRAY", "_" + kind.elementType.simpleString(), nullable=field.nullable
        )
    if isinstance(kind, (T.MapType, T.StructType, T.VariantType)):
        return ColumnSpec(field.name, "jsonb", "jsonb", nullable=field.nullable)
    if isinstance(kind, (T.VarcharType, T.CharType)):
        name = "varchar" if isinstance(kind, T.VarcharType) else "char"
        return ColumnSpec(field.name, name, name, length=kind.length, nullable=field.nullable)
    name = plain.get(type(kind), kind.simpleString())
    return ColumnSpec(field.name, name, name, nullable=field.nullable)


def specs_of(df: DataFrame) -> list[ColumnSpec]:
    return [spec_of_field(field) for field in df.schema.fields]


def describe(df: DataFrame, specs: Sequence[ColumnSpec]) -> DataFrame:
    """Store catalog descriptions in the column metadata, where the operators look for them."""
    by_name = {spec.name: spec for spec in specs}

    def described(name: str) -> Column:
        spec, column = by_name.get(name), F.col("`" + name.replace("`", "``") + "`")
        if spec is None:
            return column
        facts = {
            "source_type": spec.data_type, "udt_name": spec.udt_name, "length": spec.length,
            "precision": spec.precision, "scale": spec.scale, "nullable": spec.nullable,
            "default": spec.default,
        }
        known = {key: value for key, value in facts.items() if value is not None}
        return column.alias(name, metadata=known)

    return df.select(*[described(name) for name in df.columns])
