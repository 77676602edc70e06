"""Declared layouts of every table, and the step that brings a frame into one of them.

Column and table names are fixed values: existing readers of the tables rely on them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.types import (
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

RUN = "event_id"
RAW_FIELDS = ("timestamp", "turbine_id", "wind_speed", "wind_direction", "power_output")


def _required(**columns) -> StructType:
    return StructType([StructField(name, dtype, False) for name, dtype in columns.items()])


RAW = StructType([StructField(name, StringType(), True) for name in RAW_FIELDS])
BRONZE = StructType(RAW.fields + [StructField(RUN, StringType(), False)])
QUARANTINE = BRONZE
SILVER = _required(
    telemetry_time=TimestampType(),
    turbine_id=IntegerType(),
    wind_speed=DoubleType(),
    wind_direction=IntegerType(),
    power_output=DoubleType(),
    event_id=StringType(),
)
SUMMARY = _required(
    turbine_id=IntegerType(),
    min_power_output=DoubleType(),
    max_power_output=DoubleType(),
    mean_power_output=DoubleType(),
    event_id=StringType(),
)
ANOMALY = _required(
    telemetry_time=TimestampType(),
    turbine_id=IntegerType(),
    power_output=DoubleType(),
    event_id=StringType(),
)

# statistics of a turbine's readings in one UTC day, in a form that can be merged; null where power was null only
DAILY_STATE = StructType([
    StructField("turbine_id", IntegerType(), True),
    StructField("day", IntegerType(), True),
    StructField("readings", LongType(), False),
    StructField("measured", LongType(), False),
    StructField("mean", DoubleType(), True),
    StructField("m2", DoubleType(), True),
    StructField("lowest", DoubleType(), True),
    StructField("highest", DoubleType(), True),
    StructField("event_id", StringType(), False),
])

# layer, table name and layout of each stored table
TABLES = {
    "bronze": ("bronze", "wind_turbine_telemetry", BRONZE),
    "silver": ("silver", "wind_turbine_telemetry", SILVER),
    "quarantine": ("quarantine", "wind_turbine_telemetry", QUARANTINE),
    "summary_statistics": ("gold", "summary_statistics", SUMMARY),
    "turbine_power_output_anomaly": ("gold", "turbine_power_output_anomaly", ANOMALY),
    "turbine_daily_state": ("silver", "turbine_daily_state", DAILY_STATE),
}


def table_info(name: str) -> tuple[str, str, StructType]:
    if name not in TABLES:
        raise ValueError(f"unknown table {name!r}, expected one of {sorted(TABLES)}")
    return TABLES[name]


def conform(df: DataFrame, table: str) -> DataFrame:
    """Select a table's columns in their declared order and type.

    Anomalies may come without their time, all other columns are needed.
    """
    fields = table_info(table)[2].fields
    if table == "turbine_power_output_anomaly" and "telemetry_time" not in df.columns:
        fields = [f for f in fields if f.name != "telemetry_time"]
    missing = [f.name for f in fields if f.name not in df.columns]
    if missing:
        raise ValueError(f"missing columns {missing}, got {df.columns}")
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in fields])


class RequiredColumns:
    """What becomes of a NULL in a column that a table declares as required.

    ``ignore`` stores it, ``fail`` ends the job with its first one, and ``count`` stores it and counts them while the
    rows are written, without another pass: after ``take``, ``counts`` has a number for each such column of a table.
    """

    HOW = ("ignore", "fail", "count")

    def __init__(self, how: str):
        if how not in self.HOW:
            raise ValueError(f"unknown choice {how!r}, expected one of {self.HOW}")
        self.how = how
        self.counts: dict[str, dict[str, int]] = {}

    def apply(self, df: DataFrame, table: str, rows: Column | None = None) -> tuple[DataFrame, Observation | None]:
        """``df`` with the check of the table's columns that it has, of some ``rows`` only if given; what counts them."""
        names = [f.name for f in table_info(table)[2].fields if not f.nullable and f.name in df.columns]
        if self.how == "ignore" or not names:
            return df, None
        meant = F.lit(True) if rows is None else rows
        if self.how == "count":
            counted = Observation()
            return df.observe(counted, *[F.count_if(meant & F.col(n).isNull()).alias(n) for n in names]), counted
        checked = {
            n: F.when(meant & F.col(n).isNull(), F.raise_error(F.lit(f"{table}.{n} is required"))).otherwise(F.col(n))
            for n in names
        }
        return df.withColumns(checked), None

    def take(self, table: str, counted: Observation | None) -> None:
        """Keep the counts of a write of ``table`` that has ended."""
        if counted is not None:
            self.counts[table] = counted.get
