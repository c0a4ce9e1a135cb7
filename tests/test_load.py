import datetime
import os
import uuid

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from tableferry.operators import load
from tableferry.plans import migration
from tableferry.session import new_folder, work_root
from tableferry.sources.files import FileStore


def rows(df, *order):
    return [tuple(row) for row in df.orderBy(*order).collect()]


def test_newest_row_wins_and_null_keys_are_kept(spark):
    stage = spark.sql(
        """SELECT * FROM VALUES (1, 1, 'old'), (1, 2, 'new'), (2, 1, 'a'), (2, 1, 'b'),
           (NULL, 1, 'x'), (NULL, 1, 'x') AS t(id, v, s)"""
    )
    found = load.dedupe_stage(stage, ["id"], ["v"])
    assert rows(found, "id") == [
        (None, 1, "x"), (None, 1, "x"), (1, 2, "new"), (2, 1, "b"),
    ]


def test_a_hot_staged_key_is_thinned_before_the_shuffle(spark):
    stage = spark.range(50000).select((F.col("id") % 2).alias("k"), F.col("id").alias("v"))
    found = load.dedupe_stage(stage, ["k"], ["v"])
    plan = found._jdf.queryExecution().executedPlan().toString()
    before_shuffle = plan[plan.index("Exchange"):]
    assert "WindowGroupLimit" in before_shuffle and "Partial" in before_shuffle
    assert rows(found, "k") == [(0, 49998), (1, 49999)]


def test_upsert_is_idempotent(spark):
    target = spark.sql("SELECT * FROM VALUES (1, 'a'), (2, 'b'), (NULL, 'n') AS t(id, s)")
    stage = spark.sql("SELECT * FROM VALUES ('B', 2), ('c', 3) AS t(s, id)")
    once = load.upsert(target, stage, ["id"])
    assert rows(once, "id") == [(None, "n"), (1, "a"), (2, "B"), (3, "c")]
    assert rows(load.upsert(once, stage, ["id"]), "id") == rows(once, "id")


def test_delete_insert_replaces_groups(spark):
    target = spark.sql("SELECT * FROM VALUES (1, 1), (1, 2), (2, 1) AS t(k, n)")
    stage = spark.sql("SELECT * FROM VALUES (1, 7), (3, 1), (3, 2) AS t(k, n)")
    assert rows(load.delete_insert(target, stage, ["k"]), "k", "n") == [
        (1, 7), (2, 1), (3, 1), (3, 2),
    ]
    assert rows(load.deleted_rows(target, stage, ["k"]), "n") == [(1, 1), (1, 2)]


def test_append_refuses_a_repeated_key(spark):
    target = FileStore(new_folder(spark, "target"))
    target.append(spark.range(5), "t")
    for stage in (spark.range(4, 6), spark.range(6, 7).unionAll(spark.range(6, 7)),
                  spark.sql("SELECT CAST(NULL AS BIGINT) AS id")):
        with pytest.raises(load.LoadRefused):
            load.append_checked(
                target.read(spark, "t"), stage, ["id"], lambda df: target.append(df, "t")
            )
    load.append_checked(
        target.read(spark, "t"), spark.range(5, 7), ["id"], lambda df: target.append(df, "t")
    )
    assert target.read(spark, "t").count() == 7


def test_staged_reload_keeps_the_old_table_and_refuses_bad_stages(spark):
    name = "staged_case"
    good = spark.range(10).select("id", F.lit("a").alias("s"))
    assert load.staged_reload(good, name, ["id"]) == ""
    with pytest.raises(load.LoadRefused, match="repeated"):
        load.staged_reload(good.unionAll(good), name, ["id"])
    with pytest.raises(load.LoadRefused, match="differs"):
        load.staged_reload(good, name, ["id"], [load.same_rows_as(spark.range(10).select(
            "id", F.lit("b").alias("s")), ["id"])])
    assert spark.table(name).where("s = 'a'").count() == 10
    newer = good.withColumn("s", F.lit("z"))
    backup = load.staged_reload(newer, name, ["id"], [load.same_rows_as(newer, ["id"])])
    assert spark.table(name).first().s == "z"
    assert spark.table(backup).first().s == "a"


def test_stage_name():
    at = datetime.datetime(2024, 1, 2, 3, 4, 5, 6)
    assert load.stage_name("users", at) == "users_tmp_20240102030405000006"


def test_upsert_partitions_moves_rows_and_leaves_others_alone(spark):
    name = "parts_case"
    start = spark.sql(
        """SELECT * FROM VALUES (1, 'a', 'x y'), (2, 'b', 'x y'), (3, 'c', "q'1"), (4, 'd', 'z/z')
           AS t(id, s, p)"""
    )
    load.create_partitioned(start, name, ["p"])
    untouched = spark.table(name).where("p = 'z/z'").select(F.input_file_name()).first()[0]
    stage = spark.sql(
        """SELECT * FROM VALUES (3, 'C', 'x y'), (5, 'e', 'new%1'), (1, 'A', 'x y') AS t(id, s, p)"""
    )
    assert load.upsert_partitions(spark, name, stage, ["id"], ["p"]) == 3
    wanted = [(1, "A", "x y"), (2, "b", "x y"), (3, "C", "x y"), (4, "d", "z/z"),
              (5, "e", "new%1")]
    assert rows(spark.table(name).select("id", "s", "p"), "id") == wanted
    after = spark.table(name).where("p = 'z/z'").select(F.input_file_name()).first()[0]
    assert after == untouched
    load.upsert_partitions(spark, name, stage, ["id"], ["p"])
    assert rows(spark.table(name).select("id", "s", "p"), "id") == wanted
    with pytest.raises(load.LoadRefused, match="NULL"):
        load.upsert_partitions(
            spark, name, stage.withColumn("id", F.lit(None).cast("int")), ["id"], ["p"]
        )
    assert load.upsert_partitions(spark, name, stage.limit(0), ["id"], ["p"]) == 0


def test_upsert_partitions_by_two_columns_and_its_refusals(spark):
    name = "parts_two"
    start = spark.range(40).select("id", (F.col("id") % 2).cast("int").alias("a"),
                                   F.to_date(F.lit("2024-01-01")).alias("b"))
    load.create_partitioned(start, name, ["a", "b"])
    stage = start.where("id < 4").withColumn("b", F.to_date(F.lit("2024-02-01")))
    load.upsert_partitions(spark, name, stage, ["id"], ["a", "b"])
    found = {(r.a, str(r.b)): r["count"] for r in
             spark.table(name).groupBy("a", "b").count().collect()}
    assert found == {(0, "2024-01-01"): 18, (1, "2024-01-01"): 18,
                     (0, "2024-02-01"): 2, (1, "2024-02-01"): 2}
    hidden = stage.withColumn("a", F.lit(None).cast("int"))
    with pytest.raises(ValueError, match="NULL"):
        load.upsert_partitions(spark, name, hidden, ["id"], ["a", "b"])


def test_an_upsert_cut_off_half_way_is_finished_by_running_it_again(spark, monkeypatch):
    name = "parts_cut"
    start = spark.range(60).select("id", F.lit("old").alias("s"), (F.col("id") % 3).alias("p"))
    load.create_partitioned(start, name, ["p"])
    stage = spark.range(50, 70).select(
        "id", F.lit("new").alias("s"), ((F.col("id") + 1) % 3).alias("p")
    )
    whole = load._point_to

    def cut_off(spark, table, clauses, folders):
        whole(spark, table, clauses[:1], folders)
        raise RuntimeError("driver lost")

    monkeypatch.setattr(load, "_point_to", cut_off)
    with pytest.raises(RuntimeError):
        load.upsert_partitions(spark, name, stage, ["id"], ["p"])
    monkeypatch.undo()
    load.upsert_partitions(spark, name, stage, ["id"], ["p"])
    wanted = load.upsert(start, stage, ["id"])
    assert rows(spark.table(name).select("id", "s", "p"), "id") == rows(wanted, "id")


def test_upsert_partitions_in_groups(spark):
    name = "parts_groups"
    start = spark.range(400).select("id", F.lit("old").alias("s"), (F.col("id") % 40).alias("a"),
                                    (F.col("id") % 2).alias("b"))
    load.create_partitioned(start, name, ["a", "b"])
    stage = start.where("id % 3 = 0").withColumn("s", F.lit("new")).withColumn(
        "a", (F.col("a") + 7) % 50)
    assert load.upsert_partitions(spark, name, stage, ["id"], ["a", "b"], group_size=6) > 6
    wanted = load.upsert(start, stage, ["id"])
    assert rows(spark.table(name).select("id", "s", "a", "b"), "id") == rows(
        wanted.select("id", "s", "a", "b"), "id")


def test_many_partitions_of_two_columns_make_a_flat_filter(spark):
    places = [Row(a=i, b=str(i % 7)) for i in range(5000)]
    wanted = load._in_places(["a", "b"], places)
    found = spark.range(6000).select(F.col("id").alias("a"), (F.col("id") % 7).cast("string").alias("b"))
    assert found.where(wanted).count() == 5000


def test_the_work_folder_holds_no_live_rows(spark):
    name = "parts_home"
    start = spark.range(30).select("id", (F.col("id") % 3).alias("p"))
    load.create_partitioned(start, name, ["p"])
    load.upsert_partitions(spark, name, spark.range(30, 33).select("id", F.lit(0).cast("long").alias("p")), ["id"], ["p"])
    root = load.table_location(spark, name)
    files = [row[0] for row in spark.table(name).select(F.input_file_name()).distinct().collect()]
    assert all(file.replace("///", "/").startswith(root.replace("///", "/")) for file in files)
    staged = [f for f in os.listdir(f"{work_root(spark)}/tableferry") if f.startswith(name)]
    assert staged == []
    # The replaced files of the partition stay for open readers, and go when they are cleaned up.
    assert os.path.exists(f"{root.removeprefix('file:')}/p=0")
    assert load.clean_replaced(spark, name, datetime.timedelta(0)) == 1
    assert not os.path.exists(f"{root.removeprefix('file:')}/p=0")
    assert spark.table(name).count() == 33


def _growing(spark, tmp_path):
    """A stage that has more rows each time it is read."""
    folder = str(tmp_path / "stage")
    spark.range(3).write.parquet(folder)

    @F.udf("long")
    def grow(value):
        path = f"{folder}/more-{uuid.uuid4().hex}.parquet"
        if not os.path.exists(path):
            pq.write_table(pa.table({"id": [0, 1, 2, 3]}), path)
        return value

    return spark.read.parquet(folder).select(grow("id").alias("id"))


@pytest.mark.parametrize("operator", [load.upsert, load.delete_insert])
def test_a_growing_stage_is_read_once(spark, tmp_path, operator):
    stage = _growing(spark, tmp_path)
    target = spark.range(2, 10)
    found = operator(target, stage, ["id"])
    first = rows(found, "id")
    ids = [r[0] for r in first]
    assert len(set(ids)) == len(ids) == 10
    assert rows(found, "id") == first


def test_a_growing_stage_is_appended_as_it_was_checked(spark, tmp_path):
    target = FileStore(new_folder(spark, "target"))
    target.append(spark.range(20, 25), "t")
    load.append_checked(
        target.read(spark, "t"), _growing(spark, tmp_path), ["id"], lambda df: target.append(df, "t")
    )
    ids = [r.id for r in target.read(spark, "t").collect()]
    assert len(ids) == len(set(ids))


def test_a_swap_that_fails_its_check_is_undone(spark):
    name = "swap_case"
    load.staged_reload(spark.range(5), name, ["id"])

    def broken(live):
        raise load.LoadRefused("not readable")

    with pytest.raises(load.LoadRefused, match="not readable"):
        load.staged_reload(spark.range(9), name, ["id"], after_swap=[broken])
    assert spark.table(name).count() == 5
    assert load.staged_reload(spark.range(9), name, ["id"])
    assert spark.table(name).count() == 9


def test_names_with_dots(spark):
    target = spark.sql("SELECT 1 AS `k.a`, 'x' AS `v.b` UNION ALL SELECT 2, 'y'")
    stage = spark.sql("SELECT 2 AS `k.a`, 'z' AS `v.b`")
    key = ["k.a"]
    assert rows(load.upsert(target, stage, key), "`k.a`") == [(1, "x"), (2, "z")]
    assert rows(load.delete_insert(target, stage, key), "`k.a`") == [(1, "x"), (2, "z")]
    assert load.append_conflicts(target, stage, key).count() == 1
    assert rows(load.dedupe_stage(stage.unionAll(stage), key, ["v.b"]), "`k.a`") == [(2, "z")]


def test_tables_without_a_supported_column(spark):
    source, target = FileStore(new_folder(spark, "source")), FileStore(new_folder(spark, "target"))
    source.reload(spark.sql("SELECT array(1) AS a"), "vectors")
    source.reload(spark.range(2), "t")
    folder = new_folder(spark, "export")
    assert list(migration.export_tables(spark, source, folder, ["vectors", "t"])) == ["t"]
    settings = migration.Settings(continue_on_error=True)
    errors = migration.migrate(spark, source, target, ["vectors", "t"], settings)
    assert errors == {"vectors": "vectors has no column the target supports"}


def test_migration_picks_tables_and_collects_errors(spark):
    source = FileStore(new_folder(spark, "source"))
    for name in ("a", "b", "c"):
        source.reload(spark.range(3), name)
    target = FileStore(new_folder(spark, "target"))
    tables = ["a", "b", "c", "absent"]
    settings = migration.Settings(exclude_tables=["b"], continue_on_error=True)
    errors = migration.migrate(spark, source, target, tables, settings)
    assert list(errors) == ["absent"]
    assert target.read(spark, "c").count() == 3
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        migration.migrate(spark, source, target, tables)
    only = migration.Settings(include_tables=["a"], sample_size=2)
    reports = migration.validate(
        spark, source, target, ["a", "c"], only, keys={"a": ["id"]}
    )
    assert reports["checksums"].first().matched and reports["load"].count() == 1
    assert migration.ignored_by_table(spark, source, ["a"]) == {}
