"""Raw telemetry files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vanewatch.schemas import RAW, RUN


def read_telemetry_csv(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Comma-separated files with a header line, all fields as text.

    Fields are taken by position. Nothing is inferred, so planning reads no data, and files stay
    splittable. A short line gives NULLs, a long line loses its extra fields.
    """
    return spark.read.schema(RAW).option("header", True).option("enforceSchema", True).csv(path)


def stamp_run(df: DataFrame, run: str) -> DataFrame:
    """Add the run id to every row."""
    return df.withColumn(RUN, F.lit(run).cast("string"))
