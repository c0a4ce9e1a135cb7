import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tableferry.functions import types as rules
from tableferry.functions.types import ColumnSpec
from tableferry.operators import reconcile
from tableferry.operators.shape import (
    column_plan,
    conform_table,
    evolve_table,
    ignored_columns,
    prune_unsupported,
    schema_changes,
)
from tableferry.sources.csv_files import export_projection


def spec(data_type, **facts):
    return ColumnSpec("c", data_type, **facts)


@pytest.mark.parametrize(
    "column, wanted",
    [
        (spec("integer"), "INT"),
        (spec("boolean"), "TINYINT(1)"),
        (spec("text"), "LONGTEXT"),
        (spec("bytea"), "LONGBLOB"),
        (spec("decimal", precision=10, scale=2), "DECIMAL(10,2)"),
        (spec("decimal(10,2)"), "DECIMAL(10,2)"),
        (spec("numeric"), "DECIMAL(10,0)"),
        (spec("varchar", length=255), "VARCHAR(255)"),
        (spec("character varying", length=255), "VARCHAR(255)"),
        (spec("character varying(40)"), "VARCHAR(40)"),
        (spec("varchar"), "LONGTEXT"),
        (spec("character"), "CHAR(1)"),
        (spec("character", length=3), "CHAR(3)"),
        (spec("timestamp with time zone"), "TIMESTAMP"),
        (spec("timestamp(6) without time zone"), "TIMESTAMP"),
        (spec("double precision"), "DOUBLE"),
        (spec("uuid"), "VARCHAR(36)"),
        (spec("bigserial"), "BIGINT AUTO_INCREMENT"),
        (spec("USER-DEFINED"), "USER-DEFINED"),
        (spec("inet"), "INET"),
    ],
)
def test_target_type(column, wanted):
    assert rules.target_type(column) == wanted


@pytest.mark.parametrize(
    "column, wanted",
    [
        (spec("boolean"), T.ByteType()),
        (spec("serial"), T.IntegerType()),
        (spec("bigserial"), T.LongType()),
        (spec("decimal", precision=10, scale=2), T.DecimalType(10, 2)),
        (spec("numeric"), None),
        (spec("timestamptz"), T.TimestampNTZType()),
        (spec("uuid"), T.StringType()),
        (spec("bytea"), T.BinaryType()),
        (spec("inet"), T.StringType()),
    ],
)
def test_spark_type(column, wanted):
    assert rules.spark_type(column) == wanted


def test_unsized_decimal_can_be_forced():
    assert rules.spark_type(spec("numeric"), strict_decimal=True) == T.DecimalType(10, 0)


def test_own_type_map():
    own = {**rules.TYPE_MAP, "xml": "LONGTEXT", "money": "DECIMAL(19,2)"}
    assert rules.is_mapped(spec("xml"), own) and not rules.is_mapped(spec("xml"))
    assert rules.target_type(spec("money"), own) == "DECIMAL(19,2)"
    assert rules.spark_type(spec("money"), own) == T.DecimalType(19, 2)


@pytest.mark.parametrize(
    "data_type, udt, words, ignored",
    [
        ("json", "json", ["json"], True),
        ("jsonb", "jsonb", ["jsonb"], True),
        ("text[]", "_text", ["array", "_array"], True),
        ("varchar", "varchar", ["json"], False),
        ("ARRAY", "_int4", [], True),
        ("xml", "xml", ["xml"], True),
    ],
)
def test_ignore_rule(data_type, udt, words, ignored):
    assert rules.is_ignored(ColumnSpec("c", data_type, udt), words) is ignored


@pytest.mark.parametrize(
    "data_type, default, wanted",
    [
        ("integer", "nextval('users_id_seq'::regclass)", ""),
        ("character varying", "'pending'::character varying", "'pending'"),
        ("boolean", "true", "1"),
        ("boolean", "f", "0"),
        ("timestamp", "now()", "CURRENT_TIMESTAMP"),
        ("integer", "(0)", "0"),
        ("ARRAY", "'{}'::text[]", "'{}'"),
        ("character varying", "'a'::varchar(10)", "'a'"),
        ("character varying", "('a'::varchar(10))", "'a'"),
        ("integer", None, ""),
    ],
)
def test_defaults(data_type, default, wanted):
    assert rules.normalize_default(spec(data_type, default=default)) == wanted


def test_default_that_is_no_literal_is_refused():
    with pytest.raises(ValueError, match="expression"):
        rules.default_column(spec("uuid", default="gen_random_uuid()"))


def test_catalog_row():
    row = {
        "column_name": "name", "data_type": "character varying", "is_nullable": "NO",
        "character_maximum_length": 20,
    }
    found = ColumnSpec.from_catalog(row)
    assert (found.base, found.length, found.nullable, found.udt_name) == ("varchar", 20, False, "")


USERS = [
    ColumnSpec("id", "integer", nullable=False, default="nextval('users_id_seq'::regclass)"),
    ColumnSpec("username", "character varying", length=100, nullable=False),
    ColumnSpec("is_active", "boolean", default="true"),
    ColumnSpec("created_at", "timestamp without time zone", default="now()"),
    ColumnSpec("profile_data", "jsonb", "jsonb"),
    ColumnSpec("tags", "ARRAY", "_text"),
]


def test_conform_and_prune(spark):
    users = spark.sql(
        """SELECT 1L AS id, 'user1' AS username, true AS is_active,
                  TIMESTAMP_NTZ'2024-01-15 10:00:00.5' AS created_at, '{}' AS profile_data,
                  array('a') AS tags
           UNION ALL SELECT 2L, 'user2', false, NULL, NULL, NULL
           UNION ALL SELECT 3L, 'user3', NULL, NULL, NULL, NULL"""
    )
    described = rules.describe(users, USERS)
    assert ignored_columns(described) == ["profile_data", "tags"]
    assert column_plan(described)[2] == ("is_active", "boolean", "TINYINT(1)", "")
    assert column_plan(described)[5] == ("tags", "ARRAY", None, "ignored")
    done = conform_table(prune_unsupported(described))
    assert [f.dataType for f in done.schema.fields] == [
        T.IntegerType(), T.StringType(), T.ByteType(), T.TimestampNTZType(),
    ]
    assert [row.is_active for row in done.orderBy("id").collect()] == [1, 0, None]


def test_conform_takes_expressions_and_never_hides_a_bad_value(spark):
    rows = spark.sql("SELECT 'x' AS a, 99999999999L AS b")
    upper = conform_table(rows.select("a"), expressions={"a": F.upper("a")})
    assert upper.first().a == "X"
    described = rules.describe(rows, [ColumnSpec("b", "integer")])
    with pytest.raises(Exception, match="OVERFLOW"):
        conform_table(described).collect()


def test_odd_column_names(spark):
    rows = spark.sql("SELECT 1 AS `a.b`, true AS `c``d`, 'x' AS `e f`")
    done = conform_table(rows)
    assert done.columns == ["a.b", "c`d", "e f"]
    assert done.first()[1] == 1
    assert rules.describe(rows, [ColumnSpec("a.b", "integer")]).columns == rows.columns
    assert export_projection(rows).first()[1] == 1
    assert evolve_table(rows, rows.schema).first() == rows.first()
    assert reconcile.reconcile_checksums({"t": done}, {"t": done}, typed=True).first().matched


def test_evolve(spark):
    now = spark.sql("SELECT 1 AS id, 'a' AS name, 5 AS gone")
    wanted = T.StructType(
        [
            T.StructField("id", T.LongType()),
            T.StructField("title", T.StringType()),
            T.StructField("state", T.StringType(), False, {
                "source_type": "text", "default": "'new'::text",
            }),
        ]
    )
    changes = schema_changes(now.schema, wanted, {"title": "name"})
    assert changes == [
        ("id", "retyped", "int", "bigint"),
        ("title", "renamed", "string", "string"),
        ("state", "added", None, "string"),
        ("gone", "removed", "int", None),
    ]
    assert evolve_table(now, wanted, {"title": "name"}).first().asDict() == {
        "id": 1, "title": "a", "state": "new",
    }
    bare = T.StructType([T.StructField("x", T.IntegerType(), False)])
    with pytest.raises(ValueError, match="needs a default"):
        evolve_table(now, bare)


def test_plan_flags_what_needs_a_look(spark):
    rows = spark.sql("SELECT 'x' AS a, 1.5BD AS b")
    described = rules.describe(rows, [ColumnSpec("a", "inet"), ColumnSpec("b", "numeric")])
    assert [(p[2], p[3]) for p in column_plan(described)] == [
        ("INET", "unmapped"), ("DECIMAL(10,0)", "unsized_decimal"),
    ]
