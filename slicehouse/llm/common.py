"""Small helpers of the training-data operators: tables written aside, texts without nulls, passing rows through Arrow."""

from __future__ import annotations

import gc
import time
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from slicehouse.session import scratch_folder


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def persisted(frame: DataFrame) -> DataFrame:
    """The rows, written to the shared folder and read again: a cut in the lineage that outlives any executor."""
    folder = scratch_folder(frame.sparkSession)
    frame.write.option("compression", "zstd").parquet(f"{folder}/rows")
    rows = frame.sparkSession.read.schema(frame.schema).parquet(f"{folder}/rows")
    rows.written_to = folder
    return rows


def discard(*frames: DataFrame) -> None:
    """Delete what ``persisted`` wrote for these frames. Nothing may be read from them any more."""
    for frame in frames:
        spark = frame.sparkSession
        path = spark._jvm.org.apache.hadoop.fs.Path(frame.written_to)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def text_of(column: str) -> Column:
    """The text, with null as empty text."""
    return F.coalesce(quoted(column), F.lit(""))


def quoted(column: str) -> Column:
    return F.col("`" + column.replace("`", "``") + "`")


def parallelism(frame: DataFrame) -> int:
    return int(frame.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def map_arrow(frame: DataFrame, work: Callable[[Iterator[pa.RecordBatch]], Iterable[pa.RecordBatch]], schema: str) -> DataFrame:
    return frame.mapInArrow(work, schema)


def small_batches(batches: Iterable[pa.RecordBatch], rows: int = 512) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of at most so many, without copies."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def free_shuffles(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of steps whose results have been written and that nothing refers to any more."""
    for _ in range(2):  # Python's references to the JVM's objects go a moment after Python's own
        gc.collect()
        time.sleep(0.3)
        spark.sparkContext._jvm.System.gc()
