"""Publishing by generations, loads with a quarantine, proposals of renames, catalog keys."""

import datetime
import uuid

import pytest
from pyspark.sql import functions as F

from tableferry.functions.types import ColumnSpec, describe
from tableferry.operators import generations
from tableferry.operators.load import LoadRefused, same_rows_as
from tableferry.operators.renames import proposed_renames, similarities
from tableferry.plans.quarantine import load_with_quarantine
from tableferry.session import new_folder
from tableferry.sources.files import FileStore
from tableferry.sources.jdbc import JdbcStore


@pytest.fixture
def name():
    return f"gen_{uuid.uuid4().hex}"


def rows(spark, n, text="a"):
    return spark.range(n).select("id", F.lit(text).alias("s"))


def texts(spark, name):
    return {r["s"] for r in spark.table(name).collect()}


def test_publishing_and_going_back(spark, name):
    assert generations.current_generation(spark, name) is None
    first = generations.publish(rows(spark, 3, "a"), name, ["id"])
    reader = spark.table(name)
    second = generations.publish(rows(spark, 4, "b"), name, ["id"], [same_rows_as(rows(spark, 4, "b"), ["id"])])
    assert generations.current_generation(spark, name) == second
    assert generations.generations(spark, name) == [first, second]
    assert {r["s"] for r in reader.collect()} == {"a"} and texts(spark, name) == {"b"}
    assert generations.roll_back(spark, name) == first and texts(spark, name) == {"a"}
    with pytest.raises(LoadRefused):
        generations.roll_back(spark, name)
    assert generations.roll_back(spark, name, second) == second and texts(spark, name) == {"b"}


def test_refused_copies_and_failed_checks_leave_the_table(spark, name):
    generations.publish(rows(spark, 3, "a"), name, ["id"])
    with pytest.raises(LoadRefused):
        generations.publish(rows(spark, 3, "b").unionAll(rows(spark, 1, "b")), name, ["id"])

    def refuse(_):
        raise LoadRefused("no")

    with pytest.raises(LoadRefused):
        generations.publish(rows(spark, 3, "c"), name, ["id"], [refuse])
    with pytest.raises(LoadRefused):
        generations.publish(rows(spark, 3, "d"), name, ["id"], (), [refuse])
    assert texts(spark, name) == {"a"} and len(generations.generations(spark, name)) == 4
    other = name + "x"
    with pytest.raises(LoadRefused):
        generations.publish(rows(spark, 3, "d"), other, ["id"], (), [refuse])
    assert generations.current_generation(spark, other) is None


def test_old_generations_are_dropped_after_the_time_of_grace(spark, name):
    made = [generations.publish(rows(spark, 2, text), name, ["id"]) for text in "abcd"]
    assert generations.clean_generations(spark, name) == []
    assert generations.clean_generations(spark, name, grace=datetime.timedelta(0)) == made[:2]
    assert generations.generations(spark, name) == made[2:] and texts(spark, name) == {"d"}
    assert generations.clean_generations(spark, name, 0, datetime.timedelta(0)) == [made[2]]


def test_another_schema_and_a_plain_table(spark, name):
    rows(spark, 2, "old").write.saveAsTable(name)
    with pytest.raises(ValueError):
        generations.current_generation(spark, name)
    first = generations.adopt(spark, name)
    assert texts(spark, name) == {"old"}
    generations.publish(rows(spark, 2, "new").withColumn("n`x", F.lit(1)), name, ["id"])
    assert spark.table(name).columns == ["id", "s", "n`x"]
    assert generations.roll_back(spark, name) == first and spark.table(name).columns == ["id", "s"]


# -- quarantine -------------------------------------------------------------------------------

SPECS = [
    ColumnSpec("id", "bigint", nullable=False),
    ColumnSpec("s", "character varying", length=3),
    ColumnSpec("d", "numeric", precision=4, scale=1),
]


@pytest.fixture
def mixed(spark):
    values = [(1, "abc", "1.5"), (2, "abcd", "1.5"), (3, None, None), (None, "abcd", "12345"), (4, "é日本", "9.95"), (5, "x", "999.9")]
    df = spark.createDataFrame(values, "id long, s string, d string").withColumn("d", F.col("d").cast("decimal(10,2)"))
    return describe(df, SPECS)


def stores(spark):
    return FileStore(new_folder(spark, "target")), FileStore(new_folder(spark, "aside"))


def test_rows_that_fit_go_on_and_the_others_are_set_aside(spark, mixed):
    target, aside = stores(spark)
    found = load_with_quarantine(mixed, "t", target, aside, 60.0)
    assert (found.n_rows, found.n_loaded, found.n_bad) == (6, 3, 3)
    assert found.by_reason == {"id: not_null": 1, "s: too_long": 2, "d: decimal_misfit": 2}
    assert sorted(r["id"] for r in target.read(spark, "t").collect()) == [1, 3, 5]
    assert dict(target.read(spark, "t").dtypes)["d"] == "decimal(4,1)"
    bad = {r["id"]: list(r["reasons"]) for r in aside.read(spark, "t").collect()}
    assert bad[None] == ["id: not_null", "s: too_long", "d: decimal_misfit"] and bad[4] == ["d: decimal_misfit"]
    # The rows set aside are those of the source.
    assert {str(r["d"]) for r in aside.read(spark, "t").collect()} == {"1.50", "12345.00", "9.95"}


def test_a_load_past_its_error_rate_is_refused(spark, mixed):
    target, aside = stores(spark)
    target.reload(mixed.limit(1), "t")
    with pytest.raises(LoadRefused, match="3 of 6"):
        load_with_quarantine(mixed, "t", target, aside, 49.0)
    assert target.read(spark, "t").count() == 1 and aside.read(spark, "t").count() == 3
    assert load_with_quarantine(mixed, "t", target, aside, 50.0).error_percent == 50.0


def test_more_tests_appending_and_empty_tables(spark, mixed):
    target, aside = stores(spark)
    more = {"odd": F.col("id") % 2 == 1}
    for _ in range(2):
        found = load_with_quarantine(mixed.where("id < 4"), "t", target, aside, 100.0, more=more, append=True)
    assert found.by_reason == {"odd": 2, "s: too_long": 1} and found.n_loaded == 0
    assert aside.read(spark, "t").count() == 6 and target.read(spark, "t").count() == 0
    none = load_with_quarantine(mixed.limit(0), "t", *stores(spark), 0.0)
    assert (none.n_rows, none.n_loaded, none.n_bad) == (0, 0, 0)
    sound = load_with_quarantine(mixed.where("id = 1"), "t", *stores(spark), 0.0, keys=["s"])
    assert sound.n_loaded == 1


# -- renames ----------------------------------------------------------------------------------


def test_renamed_and_retyped_columns_among_decoys(spark):
    before = spark.range(5000).select(
        "id", (F.col("id") * 3).alias("a"), F.md5(F.col("id").cast("string")).alias("b"),
        (F.col("id") / 4).alias("c"), F.lit(None).cast("string").alias("gone"),
        F.timestamp_seconds("id").cast("timestamp_ntz").alias("at"),
    )
    after = before.where("id % 50 <> 0").select(
        "id", F.col("a").cast("string").alias("text_of_a"), F.col("b").alias("b`2"), F.col("c").cast("decimal(12,4)").alias("cc"),
        (F.col("id") * 3 + 1).alias("decoy"), F.md5((F.col("id") + 9_000).cast("string")).alias("decoy_text"),
        F.when(F.col("id") % 3 == 0, F.col("a")).alias("a_third"), F.col("at").alias("moment"),
    )
    found = {r["removed"]: (r["added"], r["type_before"], r["type_after"]) for r in proposed_renames(before, after).collect()}
    assert found == {
        "a": ("text_of_a", "bigint", "string"), "b": ("b`2", "string", "string"), "c": ("cc", "double", "decimal(12,4)"),
        "at": ("moment", "timestamp_ntz", "timestamp_ntz"),
    }


def test_the_estimate_is_near_the_true_similarity(spark):
    one = spark.range(20_000).select(F.col("id").alias("x"))
    for shared in (0.2, 0.5, 0.9):
        other = spark.range(int(20_000 * (1 - shared)), 20_000).select(F.col("id").alias("y"))
        found = similarities(one, other, ["x"], ["y"]).first()["similarity"]
        assert abs(found - shared) < 0.08
    assert similarities(one, one.select((F.col("x") + 10**6).alias("y")), ["x"], ["y"]).isEmpty()


def test_no_renames(spark):
    one = spark.range(9).select("id", F.lit("x").alias("s"))
    assert proposed_renames(one, one).isEmpty()
    assert proposed_renames(one, one.drop("s")).isEmpty()
    assert proposed_renames(one.limit(0), one.limit(0).withColumnRenamed("s", "t")).isEmpty()
    # Two removed columns with the same values: each added column is proposed once.
    two = one.select("id", F.col("id").alias("p"), F.col("id").alias("q"))
    assert proposed_renames(two, two.select("id", F.col("p").alias("r"))).count() == 1


# -- catalog keys and writers -----------------------------------------------------------------


def test_the_split_key_comes_from_the_catalog(spark, monkeypatch):
    store = JdbcStore("jdbc:none", schema="s'x")
    assert "table_name = 'it''s'" in store.key_query("it's") and "table_schema = 's''x'" in store.key_query("t")
    kinds = iter([("integer", "numeric"), ("character varying(9)", "bigint"), None])

    def query(self, spark, text):
        kind = next(kinds)
        values = [] if kind is None else [("second", 2, kind[1]), ("first", 1, kind[0])]
        return spark.createDataFrame(values, "column_name string, ordinal_position int, data_type string")

    monkeypatch.setattr(JdbcStore, "query", query)
    assert [store.split_key(spark, "t") for _ in range(3)] == ["first", None, None]


def test_writers_follow_the_rows():
    store = JdbcStore("jdbc:none")
    assert [store.writers_for(n) for n in (None, 0, 1, 250_001, 10**9)] == [8, 1, 1, 2, 64]
    assert JdbcStore("jdbc:none", writers=3).writers_for(10**9) == 3
