"""The session's settings, and the shared folder that written intermediate tables go to."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def get_session(app_name: str = "slicehouse", master: str | None = None, **settings: object) -> SparkSession:
    """A session with the settings the library is tested under.

    The library's own functions take any session. They set nothing on it: the overwrite mode, for one, goes with
    each write.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    defaults = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.ansi.enabled": "true",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    }
    for key, value in {**defaults, **settings}.items():
        builder = builder.config(key, str(value))
    return builder.getOrCreate()


def is_single_machine(spark: SparkSession) -> bool:
    """Whether driver and executors are one process. ``local-cluster`` is not: it starts executors of its own."""
    return re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master) is not None


def shared_folder(spark: SparkSession) -> str:
    """The folder that every executor can reach: ``spark.checkpoint.dir``, or the context's checkpoint folder.

    Where neither is set, a single-process session gets a temporary folder. A cluster gets an error, because a
    folder on one machine would lose its rows together with that machine.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    if not is_single_machine(spark):
        raise ValueError("set spark.checkpoint.dir to a folder which all executors share")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="slicehouse-"))
    return spark.sparkContext.getCheckpointDir().rstrip("/")


def scratch_folder(spark: SparkSession) -> str:
    """A new folder under the shared folder. Hadoop deletes it when the driver ends."""
    folder = f"{shared_folder(spark)}/slicehouse-{uuid.uuid4().hex}"
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    files.mkdirs(path)
    files.deleteOnExit(path)
    return folder


def written(rows: DataFrame) -> DataFrame:
    """The rows, written to the shared folder and read again: a cut in the lineage that outlives any executor."""
    place = f"{scratch_folder(rows.sparkSession)}/rows"
    rows.write.parquet(place)
    return rows.sparkSession.read.schema(rows.schema).parquet(place)


def scratch_database(spark: SparkSession) -> str:
    """This application's database for intermediate tables, kept in the shared folder and made on first use."""
    name = "slicehouse_" + re.sub(r"\W", "_", spark.sparkContext.applicationId).lower()
    if not spark.catalog.databaseExists(name):
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {name} LOCATION '{scratch_folder(spark)}'")
    return name


def scratch_name(spark: SparkSession, stem: str) -> str:
    """A table name in the scratch database which nobody else uses."""
    return f"{scratch_database(spark)}.{stem}_{uuid.uuid4().hex[:12]}"


def drop_scratch(spark: SparkSession) -> None:
    """Drop the scratch database with its tables, once nothing reads from them any more."""
    name = "slicehouse_" + re.sub(r"\W", "_", spark.sparkContext.applicationId).lower()
    spark.sql(f"DROP DATABASE IF EXISTS {name} CASCADE")
