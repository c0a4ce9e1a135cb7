"""Session settings and the shared work folder."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings the operators are written for. None of them changes a result. Skewed joins are split
# and small shuffle partitions merged at run time, so the shuffle partition number only has to
# be high enough.
RECOMMENDED = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
}


def build_session(app: str, master: str | None = None, **settings: str) -> SparkSession:
    """A session with the recommended settings; ``settings`` use ``__`` for the dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    overrides = {key.replace("__", "."): value for key, value in settings.items()}
    for key, value in {**RECOMMENDED, **overrides}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def work_root(spark: SparkSession) -> str:
    """Folder for written intermediate tables: the one named in ``spark.checkpoint.dir``, or else
    given to ``setCheckpointDir``.

    Only a local session may leave both out; it uses a folder below its warehouse. On a cluster
    that could be machine-local and not seen by the other executors, so it is an error.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if shared:
        return shared.rstrip("/")
    master = spark.conf.get("spark.master", "")
    if not master.startswith("local") or master.startswith("local-cluster"):
        raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
    return spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_work"


def new_folder(spark: SparkSession, label: str) -> str:
    """A path nothing else uses, below the work folder."""
    return f"{work_root(spark)}/tableferry/{label}-{uuid.uuid4().hex}"


def written_at(df: DataFrame, label: str) -> tuple[DataFrame, str]:
    """``written``, with the folder, for a caller that removes it (``discard``) after use."""
    path = new_folder(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def written(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` as parquet in the work folder and read it back.

    This ends the lineage in files that outlive lost executors, and the planner then knows the
    size: a later join is broadcast only if the files are below the broadcast threshold.
    """
    return written_at(df, label)[0]


def discard(spark: SparkSession, path: str) -> None:
    """Delete a folder, in whichever store it is."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
