"""Where intermediate results are written: the folder that the cluster shares."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

SETTING = "spark.checkpoint.dir"


def shared_dir(spark: SparkSession) -> str:
    """The session's checkpoint folder; a local session without one gets a fresh temporary folder."""
    context = spark.sparkContext
    named = spark.conf.get(SETTING, None) or context.getCheckpointDir()
    if named is None:
        if not context.master.startswith("local"):
            raise RuntimeError(f"set {SETTING} to a folder that all executors share")
        named = tempfile.mkdtemp(prefix="run-")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(named)
    return named


def settle(df: DataFrame) -> DataFrame:
    """Compute ``df`` once and continue from its rows in the shared folder."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def remove(spark: SparkSession, folder: str) -> None:
    """Remove a folder of the shared file system with all that is in it."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


@contextmanager
def settled(df: DataFrame) -> Iterator[DataFrame]:
    """As ``settle``, but the rows are removed from the shared folder in the end."""
    spark = df.sparkSession
    folder = f"{shared_dir(spark)}/settled-{uuid.uuid4().hex}"
    try:
        df.write.parquet(folder)
        yield spark.read.schema(df.schema).parquet(folder)
    finally:
        remove(spark, folder)
