import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tableferry import session
from tableferry.functions.text import marker_to_null
from tableferry.queries import loading
from tableferry.session import new_folder
from tableferry.sources import ranges
from tableferry.sources.csv_files import (
    export_projection,
    parse_export,
    read_export,
    rows_of_bytes,
    write_export,
)
from tableferry.sources.jdbc import JdbcStore

TEXTS = [
    None, "", "N", 'a"b,c', "back\\slash", "two\nlines", "cr\rhere", "both\r\n", 'q\\"z', "\\",
    "ends\\", " lead", "trail ", "\t", '"', "''", "ü語", "x,y", "\\\\N", "#no comment",
]


def test_texts_survive_the_round_trip(spark):
    rows = spark.createDataFrame(list(enumerate(TEXTS)), "id int, t string")
    folder = new_folder(spark, "csv")
    write_export(rows, folder)
    back = parse_export(
        read_export(spark, folder, rows.columns, keep_bad_rows=False), rows.schema
    )
    assert [r.t for r in back.orderBy("id").collect()] == TEXTS


def test_a_text_equal_to_the_marker_is_refused(spark):
    rows = spark.createDataFrame([("\\N",)], "t string")
    with pytest.raises(Exception, match="uses for NULL"):
        write_export(rows, new_folder(spark, "csv"))
    folder = new_folder(spark, "csv")
    write_export(rows, folder, null_marker="<null>")
    assert read_export(spark, folder, ["t"], null_marker="<null>").first().t == "\\N"


def test_marker_to_null(spark):
    rows = spark.createDataFrame([("\\N",), ("N",)], "t string")
    assert [r[0] for r in rows.select(marker_to_null(F.col("t"))).collect()] == [None, "N"]


def test_types_survive_the_round_trip(spark):
    rows = spark.sql(
        """SELECT 1 AS i, true AS b, 1.50BD AS d, 2.5D AS f, DATE'2024-02-29' AS day,
                  TIMESTAMP_NTZ'2024-01-01 10:11:12' AS t, X'00FF' AS bin, 'x' AS s
           UNION ALL SELECT NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL"""
    )
    folder = new_folder(spark, "csv")
    write_export(rows, folder)
    back = parse_export(read_export(spark, folder, rows.columns, keep_bad_rows=False), rows.schema)
    assert sorted(map(str, back.collect())) == sorted(map(str, rows.collect()))


def test_export_forms(spark):
    rows = spark.sql(
        """SELECT CAST(NULL AS BOOLEAN) AS n, false AS b,
                  TIMESTAMP_NTZ'2024-01-01 10:11:12.999' AS t, X'0aFF' AS h"""
    )
    assert tuple(export_projection(rows).first()) == (None, 0, "2024-01-01 10:11:12", "0aff")


def test_a_short_row_fails_a_strict_read(spark):
    folder = new_folder(spark, "csv")
    spark.createDataFrame([("1,a",), ("2",)], "line string").write.text(folder)
    strict = read_export(spark, folder, ["id", "s"], keep_bad_rows=False)
    with pytest.raises(Exception, match="MALFORMED"):
        strict.select("id").collect()
    kept = read_export(spark, folder, ["id", "s"])
    assert kept.where("_bad_row IS NOT NULL").select("id", "_bad_row").collect() == [("2", "2")]


def test_large_exports_are_cut_into_files(spark):
    folder = new_folder(spark, "csv")
    write_export(spark.range(1000).coalesce(1), folder, bytes_per_file=289)
    texts = read_export(spark, folder, ["id"])
    assert texts.select(F.input_file_name()).distinct().count() == 10


def test_a_split_read_is_written_by_every_task(spark, tmp_path, monkeypatch):
    text = F.concat(F.lit('a "line"\n'), F.repeat(F.lit("word "), 60))
    rows = spark.range(4000).select(F.col("id").alias("doc_id"), text.alias("text"))
    rows.repartition(4).write.parquet(str(tmp_path / "documents.parquet"))
    exported = []

    def write(df, path, **form):
        write_export(df, path, **form)
        exported.append(df.sparkSession.read.text(path, lineSep="\x1e").select("_metadata.file_path"))

    monkeypatch.setattr(loading, "write_export", write)
    back = loading.csv_split_read(spark, str(tmp_path))
    assert exported[0].distinct().count() == 4
    assert back.select("in_one_task").distinct().collect() == [(False,)]
    assert back.drop("in_one_task").exceptAll(rows).isEmpty() and back.count() == 4000


def test_rows_of_bytes_takes_sizes_of_the_first_rows_only(spark):
    rows = spark.range(4, numPartitions=2).select(F.repeat(F.lit("x"), F.col("id").cast("int")).alias("t"))
    assert rows_of_bytes(rows, 300) == 200
    assert rows_of_bytes(rows.limit(0), 300) == 300


def test_thousands_of_scattered_ranges(spark):
    numbers = list(range(0, 8192, 2)) + [-1]
    wanted = ranges.in_splits("id", 0, 8191, 8192, numbers)
    keys = spark.range(-3, 8195).unionAll(spark.sql("SELECT CAST(NULL AS BIGINT)"))
    found = [row.id for row in keys.where(wanted).collect()]
    assert sorted(x for x in found if x is not None) == [-3, -2, -1, *range(0, 8192, 2)]
    assert found.count(None) == 1


def test_merged_ranges_still_filter_the_scan(spark):
    folder = new_folder(spark, "ranges")
    spark.range(100000).write.parquet(folder)
    rows = spark.read.parquet(folder).where(ranges.in_splits("id", 0, 99999, 1000, range(0, 400, 3)))
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [" in plan and "GreaterThanOrEqual(id" in plan
    assert rows.count() == sum(100 for _ in range(0, 400, 3))


def test_cuts_cover_every_key_once(spark):
    keys = spark.range(1000).select((F.col("id") * F.col("id")).alias("id")).unionAll(
        spark.sql("SELECT CAST(NULL AS BIGINT)")
    )
    low, high = ranges.key_bounds(keys, "id")
    for cuts in (ranges.equal_cuts(low, high, 7), ranges.balanced_cuts(keys, "id", 7), []):
        parts = [keys.where(text).count() for text in ranges.range_predicates("id", cuts)]
        assert sum(parts) == 1001 and len(parts) == len(cuts) + 1
    balanced = ranges.range_predicates("id", ranges.balanced_cuts(keys, "id", 7))
    assert max(keys.where(text).count() for text in balanced) < 160


def test_cuts_that_are_no_numbers_are_quoted(spark):
    days = spark.sql("SELECT explode(sequence(DATE'2024-01-01', DATE'2024-01-30')) AS day")
    texts = ranges.range_predicates("day", ranges.balanced_cuts(days, "day", 3))
    assert sum(days.where(text).count() for text in texts) == 30 and len(texts) == 3


def test_split_number_agrees_with_the_cuts(spark):
    keys = spark.range(10, 110)
    cuts = ranges.equal_cuts(10, 109, 7)
    numbered = keys.withColumn("n", ranges.split_number("id", 10, 109, 7))
    for number, text in enumerate(ranges.range_predicates("id", cuts)):
        assert numbered.where(text).select("n").distinct().collect() == [(number,)]


def test_ranges_split_within_a_hot_key(spark):
    rows = spark.range(20000).select(F.lit(1).alias("k"), F.col("id").alias("v"))
    sizes = ranges.spread_by_range(rows, 8, "k").groupBy(F.spark_partition_id()).count()
    assert sizes.count() == 8


STORE = JdbcStore("jdbc:any://host/db", "public", {"user": "u", "password": "secret"})


def test_jdbc_queries_and_secrets():
    assert STORE.count_query("t") == "SELECT COUNT(*) AS n_rows FROM public.t"
    assert "MIN(id)" in STORE.bounds_query("t", "id")
    assert "table_name = 'o''t'" in STORE.columns_query("o't")
    assert "secret" not in repr(STORE)
    assert JdbcStore("jdbc:any://host/db")._name("t") == "t"
    quoted = JdbcStore("jdbc:any://host/db", "public", quote='"')
    assert quoted.count_query('a"b') == 'SELECT COUNT(*) AS n_rows FROM "public"."a""b"'
    assert 'MIN("Id")' in quoted.bounds_query("t", "Id")


def test_work_folder_comes_from_the_session(spark):
    assert session.work_root(spark) == spark.conf.get("spark.checkpoint.dir")


class _Conf:
    def __init__(self, **values):
        self.values = values

    def get(self, key, default=None):
        return self.values.get(key.replace(".", "_"), default)


class _Context:
    def getCheckpointDir(self):
        return None


class _Session:
    sparkContext = _Context()

    def __init__(self, **values):
        self.conf = _Conf(**values)


def test_a_cluster_must_name_the_folder():
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.work_root(_Session(spark_master="yarn"))
    shared = _Session(spark_master="yarn", spark_checkpoint_dir="hdfs://x/y/")
    assert session.work_root(shared) == "hdfs://x/y"
    local = {"spark_sql_warehouse_dir": "file:/w"}
    assert session.work_root(_Session(spark_master="local[2]", **local)) == "file:/w/_work"
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.work_root(_Session(spark_master="local-cluster[2,1,1024]", **local))


def test_written_keeps_the_schema(spark):
    rows = spark.sql("SELECT 1 AS a, CAST(NULL AS STRING) AS b")
    back = session.written(rows, "case")
    assert [f.dataType for f in back.schema.fields] == [T.IntegerType(), T.StringType()]
    assert back.count() == 1
