"""Session helpers: builder defaults, the shared scratch folder, and lineage cuts."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def get_session(app: str = "adloom", master: str | None = None, **conf: object) -> SparkSession:
    """A session with the settings every job here relies on; ``conf`` overrides them.

    On a cluster leave ``master`` unset so that spark-submit decides.
    """
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.parquet.aggregatePushdown": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.ui.showConsoleProgress": "false",
    }
    settings.update({k: str(v) for k, v in conf.items()})
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """Folder all executors can reach: ``spark.checkpoint.dir``, or a local one where that is unset.

    The fallback is for single-machine sessions only.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="adloom-")
        spark.sparkContext.setCheckpointDir(folder)
    return folder.rstrip("/")


def session_dir(spark: SparkSession) -> str:
    """This application's own folder below the shared one."""
    return f"{shared_dir(spark)}/adloom/{spark.sparkContext.applicationId}"


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new path in the session's folder; never reused, so retries cannot mix two runs."""
    return f"{session_dir(spark)}/{label}-{uuid.uuid4().hex}"


def _file_system(spark: SparkSession, path: str):
    """The Hadoop file system of a path, and the path as it wants it."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), where


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, where = _file_system(spark, path)
    return fs.exists(where)


def remove_path(spark: SparkSession, path: str) -> None:
    fs, where = _file_system(spark, path)
    fs.delete(where, True)


def release(spark: SparkSession) -> None:
    """Delete the tables this application wrote for itself; call it when their results are stored."""
    remove_path(spark, session_dir(spark))


def materialize(df: DataFrame, label: str = "stage") -> DataFrame:
    """Cut lineage by writing ``df`` to the shared folder and reading it back.

    A written table survives the loss of executors and keeps column pruning for later passes.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
