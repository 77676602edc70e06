"""Typed view of raw readings, the validity flag, and the split into valid and invalid rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vanewatch.functions.convert import lenient_double, lenient_int, lenient_timestamp
from vanewatch.schemas import RAW_FIELDS, RUN

CONVERSIONS = {
    "timestamp": lenient_timestamp,
    "turbine_id": lenient_int,
    "wind_speed": lenient_double,
    "wind_direction": lenient_int,
    "power_output": lenient_double,
}


def _converted(field: str) -> str:
    return f"converted_{field}"


# What makes a typed reading invalid. Every condition is true or false, never NULL.
RULES = {
    "bad_time": "converted_timestamp IS NULL",
    "bad_turbine": "converted_turbine_id IS NULL",
    "bad_speed": "converted_wind_speed IS NULL",
    "bad_direction": "converted_wind_direction IS NULL",
    "direction_range": "coalesce(converted_wind_direction NOT BETWEEN 0 AND 359, false)",
    "bad_power": "converted_power_output IS NULL",
}


# the column that holds the text of an invalid row, where valid and invalid rows are stored together
SPLIT_RAW = "raw"


def for_run(df: DataFrame, run: str | None) -> DataFrame:
    """Rows of one run; ``None`` selects the rows without a run id."""
    return df.filter(F.col(RUN).eqNullSafe(F.lit(run)))


def flag_quality(df: DataFrame) -> DataFrame:
    """Raw columns, ``converted_*`` columns, run id and ``is_error``, for the rows of every run.

    The conversions come out of ``inline``, which Catalyst does not merge with the filters of
    ``to_silver`` and ``to_quarantine``. As plain projections they would be copied into the filter
    condition and each value would be parsed twice.
    """
    typed = F.struct(
        *[convert(F.col(field)).alias(_converted(field)) for field, convert in CONVERSIONS.items()]
    )
    return df.select(*RAW_FIELDS, RUN, F.inline(F.array(typed))).select(
        *RAW_FIELDS,
        *map(_converted, CONVERSIONS),
        RUN,
        F.expr(" OR ".join(RULES.values())).alias("is_error"),
    )


def with_quality(df: DataFrame, run: str | None) -> DataFrame:
    """``flag_quality`` of one run's readings."""
    return flag_quality(for_run(df, run))


def to_silver(quality: DataFrame) -> DataFrame:
    """Valid readings, typed."""
    names = {"timestamp": "telemetry_time"}
    return quality.filter(~F.col("is_error")).select(
        *[F.col(_converted(field)).alias(names.get(field, field)) for field in CONVERSIONS], RUN
    )


def to_quarantine(quality: DataFrame) -> DataFrame:
    """Invalid readings, as the text that came in."""
    return quality.filter("is_error").select(*RAW_FIELDS, RUN)


def split_rows(quality: DataFrame, table: str) -> DataFrame:
    """Both outcomes as one frame: typed columns of the valid rows, text of the invalid ones in a struct.

    The column ``table`` names the one that a row belongs to, so that a single pass can write both.
    """
    names = {"timestamp": "telemetry_time"}
    typed = [
        F.when(~F.col("is_error"), F.col(_converted(field))).alias(names.get(field, field)) for field in CONVERSIONS
    ]
    text = F.when(F.col("is_error"), F.struct(*RAW_FIELDS)).alias(SPLIT_RAW)
    side = F.when(F.col("is_error"), F.lit("quarantine")).otherwise(F.lit("silver")).alias(table)
    return quality.select(*typed, text, RUN, side)
