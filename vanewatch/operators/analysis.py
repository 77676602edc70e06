"""Per-turbine statistics over a period, and the readings far away from their turbine's mean."""

from __future__ import annotations

import re
from datetime import date, datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import AtomicType, TimestampType

from vanewatch.operators.quality import for_run
from vanewatch.schemas import RUN
from vanewatch.scratch import settle

# A band is a key and two doubles, measured at 125 bytes in a broadcast, so this many take 64 MB.
BROADCAST_GROUPS = 500_000
# Bits of the filter of turbines before a join by key: 8 MB.
FILTER_BITS = 1 << 26

Bound = str | datetime | date


def period_bounds(
    spark: SparkSession, start: Bound, end: Bound, dtype: AtomicType = TimestampType()
) -> tuple[Column, Column]:
    """Both bounds as literals of the given timestamp type; ``ValueError`` if one cannot be read.

    A date-time without a zone means the session time zone, as text does. A bound with a zone cannot be
    compared with a zone-less column and is refused there.
    """
    for bound in (start, end):
        if not isinstance(bound, (str, datetime, date)):
            raise ValueError(f"a period bound must be text or a date-time, got {bound!r}")
    kind = "timestamp_ltz" if dtype == TimestampType() else dtype.simpleString()
    # constant-folded on the driver, runs no job
    readable = spark.sql(
        f"SELECT try_cast(? AS {kind}) IS NOT NULL, try_cast(? AS {kind}) IS NOT NULL",
        args=[str(start), str(end)],
    ).first()
    for bound, is_readable in zip((start, end), readable):
        if not is_readable:
            raise ValueError(f"not a timestamp: {bound!r}")
    if dtype != TimestampType():
        zoned = [bound for bound in (start, end) if _has_zone(str(bound))]
        if zoned:
            raise ValueError(f"{zoned[0]!r} has a zone, but the column has none")
    return F.lit(str(start)).cast(dtype), F.lit(str(end)).cast(dtype)


def _has_zone(bound: str) -> bool:
    """Whether anything follows the digits of a time: an offset, ``Z`` or the name of a zone."""
    time = re.search(r"[T ]\s*\d{1,2}(:\d{1,2}){0,2}(\.\d*)?(.*)$", bound.strip(), re.S)
    return bool(time and time.group(3).strip())


def in_period(df: DataFrame, start: Bound, end: Bound, column: str = "telemetry_time") -> DataFrame:
    """Rows from ``start`` to ``end``, both included."""
    bounds = period_bounds(df.sparkSession, start, end, df.schema[column].dataType)
    return df.filter(F.col(column).between(*bounds))


def turbine_statistics(readings: DataFrame) -> DataFrame:
    """Power statistics of each turbine, with the number of its readings."""
    power = F.col("power_output")
    return readings.groupBy("turbine_id").agg(
        F.min(power).alias("min_power_output"),
        F.max(power).alias("max_power_output"),
        F.mean(power).alias("mean_power_output"),
        F.stddev_samp(power).alias("stddev_power_output"),
        F.count(F.lit(1)).alias("readings"),
    )


def daily_states(readings: DataFrame, *keys: str) -> DataFrame:
    """Statistics of each turbine and UTC day (and value of ``keys``) in a form that can be merged: numbers of readings
    and of measured powers, their mean and the sum of squared deviations from it, least and largest power.
    """
    power = F.col("power_output")
    day = F.floor(F.unix_seconds("telemetry_time") / 86400).cast("int").alias("day")
    return readings.groupBy("turbine_id", day, *keys).agg(
        F.count(F.lit(1)).alias("readings"),
        F.count(power).alias("measured"),
        F.mean(power).alias("mean"),
        (F.var_pop(power) * F.count(power)).alias("m2"),
        F.min(power).alias("lowest"),
        F.max(power).alias("highest"),
    )


def _merged(a: Column, b: Column) -> Column:
    """Two states as one, by the formula of Chan, Golub and LeVeque, which subtracts no large sums."""
    n, more = a["measured"], b["measured"]
    total = n + more
    apart = b["mean"] - a["mean"]
    mean = a["mean"] + apart * more / total
    m2 = a["m2"] + b["m2"] + apart * apart * n * more / total
    # a state without a measured power changes nothing
    return F.struct(
        total.alias("measured"),
        F.when(n == 0, b["mean"]).when(more == 0, a["mean"]).otherwise(mean).alias("mean"),
        F.when(n == 0, b["m2"]).when(more == 0, a["m2"]).otherwise(m2).alias("m2"),
    )


def merged_statistics(states: DataFrame) -> DataFrame:
    """``turbine_statistics`` of all readings that the states stand for, in any order and of any parts.

    A turbine has as many states as the period has days, whatever the number of its readings.
    """
    state = F.struct("day", "measured", "mean", "m2")
    nothing = F.struct(F.lit(0).cast("long").alias("measured"), F.lit(None).cast("double").alias("mean"), F.lit(None).cast("double").alias("m2"))
    parts = states.groupBy("turbine_id").agg(
        F.min("lowest").alias("min_power_output"),
        F.max("highest").alias("max_power_output"),
        F.sort_array(F.collect_list(state)).alias("parts"),
        F.sum("readings").alias("readings"),
    )
    whole = F.aggregate("parts", nothing, _merged)
    return parts.withColumn("whole", whole).select(
        "turbine_id",
        "min_power_output",
        "max_power_output",
        F.col("whole.mean").alias("mean_power_output"),
        F.when(F.col("whole.measured") > 1, F.sqrt(F.col("whole.m2") / (F.col("whole.measured") - 1))).alias("stddev_power_output"),
        "readings",
    )


def anomaly_thresholds(statistics: DataFrame, k: float = 2.0) -> DataFrame:
    """Statistics with the bounds ``mean - k * stddev`` and ``mean + k * stddev``."""
    mean, spread = F.col("mean_power_output"), F.col("stddev_power_output") * F.lit(float(k))
    return statistics.withColumns(
        {
            "power_output_anomaly_threshold_min": mean - spread,
            "power_output_anomaly_threshold_max": mean + spread,
        }
    )


def summary(statistics: DataFrame, run: str | None) -> DataFrame:
    """Published statistics of a run."""
    return statistics.select(
        "turbine_id",
        "min_power_output",
        "max_power_output",
        "mean_power_output",
        F.lit(run).cast("string").alias(RUN),
    )


def _outside(low: Column, high: Column) -> Column:
    """Whether the span from ``low`` to ``high`` leaves the threshold band on either side."""
    return (low < F.col("b.power_output_anomaly_threshold_min")) | (
        high > F.col("b.power_output_anomaly_threshold_max")
    )


def may_be_in(turbines: DataFrame, count: int) -> Column | None:
    """Condition on ``turbine_id`` that holds for all of about ``count`` turbines and for few others.

    A Bloom filter with one probe and eight bits or more for each turbine, built on Spark. Its words, 8 MB at most,
    reach the tasks as the value of a scalar subquery. None where so many turbines would fill it.
    """
    bits = max(64, 1 << (8 * count - 1).bit_length())
    if bits > FILTER_BITS:
        return None
    turbine = F.col("turbine_id")
    bit = F.pmod(F.xxhash64(turbine), F.lit(bits))
    word, place = F.floor(bit / 64).cast("int"), F.pmod(bit, F.lit(64)).cast("int")
    set_bits = turbines.select(word.alias("word"), F.call_function("shiftleft", F.lit(1).cast("long"), place).alias("mask"))
    words = (
        turbines.sparkSession.range(bits // 64)
        .join(set_bits.groupBy("word").agg(F.bit_or("mask").alias("mask")), F.col("id") == F.col("word"), "left")
        .select(F.struct("id", F.coalesce("mask", F.lit(0).cast("long")).alias("mask")).alias("entry"))
        .agg(F.transform(F.sort_array(F.collect_list("entry")), lambda entry: entry["mask"]).alias("words"))
    )
    return F.getbit(F.element_at(settle(words).scalar(), word + 1), place) == 1


def anomalies(
    readings: DataFrame,
    thresholds: DataFrame,
    run: str | None,
    include_time: bool = True,
    broadcast_groups: int = BROADCAST_GROUPS,
) -> DataFrame:
    """Readings strictly outside the band of their own turbine.

    Only turbines whose smallest or largest reading leaves the band can have anomalies, so the others
    are dropped before the join. When at most ``broadcast_groups`` turbines are left, their bands
    are broadcast and the readings do not move. Beyond that, a turbine with more than
    ``1 / broadcast_groups`` of the readings counts as heavy: there can be at most
    ``broadcast_groups`` of them, so their bands are broadcast and their readings never shuffled,
    while the readings of the many light turbines are joined by key.

    Readings without a turbine id form one more group, with a single band. They are joined on their
    own: a null-safe key for all readings would make the hash join several times slower.

    Counts ``thresholds`` once, which should therefore be a settled frame (see ``analyse``).
    """
    leaves = F.coalesce(
        (F.col("min_power_output") < F.col("power_output_anomaly_threshold_min"))
        | (F.col("max_power_output") > F.col("power_output_anomaly_threshold_max")),
        F.lit(False),
    )
    total = thresholds.agg(
        F.count_if(leaves).alias("bands"),
        F.sum("readings").alias("rows"),
        F.count_if(F.col("turbine_id").isNull()).alias("unknown"),
    ).first()
    power = F.col("r.power_output")
    same_turbine = F.col("r.turbine_id") == F.col("b.turbine_id")
    columns = ["r.turbine_id", "r.power_output"]
    if include_time:
        columns.insert(0, "r.telemetry_time")

    readings = readings.alias("r")
    bands = thresholds.alias("b").filter(
        _outside(F.col("b.min_power_output"), F.col("b.max_power_output"))
    )

    def hits(rows: DataFrame, bands: DataFrame, on: Column = same_turbine) -> DataFrame:
        found = rows.join(bands, on, "inner").filter(_outside(power, power))
        return found.select(*columns, F.lit(run).cast("string").alias(RUN))

    if total["bands"] <= broadcast_groups:
        result = hits(readings, F.broadcast(bands))
    else:
        is_heavy = F.col("b.readings") > F.lit(total["rows"] / broadcast_groups)
        heavy = F.broadcast(thresholds.alias("b").filter(is_heavy).select("turbine_id").alias("b"))
        light = bands.filter(~is_heavy)
        light_readings = readings.join(heavy, same_turbine, "left_anti")
        # readings without a light band are left out before the shuffle, most of them
        wanted = may_be_in(light, total["bands"])
        if wanted is not None:
            light_readings = light_readings.filter(wanted)
        # a light turbine has few readings and one band, so that no task's hash table grows large
        result = hits(readings, F.broadcast(bands.filter(is_heavy))).unionByName(
            hits(light_readings, light.hint("shuffle_hash"))
        )
    if total["unknown"]:
        result = result.unionByName(
            hits(
                readings.filter(F.col("r.turbine_id").isNull()),
                F.broadcast(bands.filter(F.col("b.turbine_id").isNull())),
                F.col("r.turbine_id").eqNullSafe(F.col("b.turbine_id")),
            )
        )
    return result


def period_readings(df: DataFrame, run: str | None, start: Bound, end: Bound) -> DataFrame:
    """The three columns the analysis needs, of one run and period."""
    return in_period(for_run(df, run), start, end).select(
        "telemetry_time", "turbine_id", "power_output"
    )


def whole_days(spark: SparkSession, start: Bound, end: Bound) -> tuple[int, int]:
    """First and last UTC day that lie in the period with all their microseconds; the last may come before the first."""
    first, last = period_bounds(spark, start, end)
    micros = spark.range(1).select(F.unix_micros(first), F.unix_micros(last)).first()
    day = 86_400_000_000
    return -(-micros[0] // day), (micros[1] + 1) // day - 1


def edge_periods(spark: SparkSession, start: Bound, end: Bound) -> list[tuple[str, str]]:
    """What a period has besides its whole UTC days: the time before them and after them, one of which may be empty."""
    first, last = whole_days(spark, start, end)
    bounds = spark.range(1).select(*[
        F.to_utc_timestamp(F.timestamp_seconds(F.lit(86400 * day)), F.current_timezone()).cast("string")
        for day in (first, last + 1)
    ]).first()
    before = datetime.fromisoformat(bounds[0]) - timedelta(microseconds=1)
    return [(str(start), f"{before}+00:00"), (f"{bounds[1]}+00:00", str(end))]


def period_statistics(edges: DataFrame, states: DataFrame, run: str | None, start: Bound, end: Bound) -> DataFrame:
    """``turbine_statistics`` of one run and period, from the states of its whole days and the readings of the rest.

    ``states`` has those of every day of the run. ``edges`` has the readings of the period's first and last day at
    least, of all of it if it holds no whole day; what more there is of whole days is not counted again.
    """
    first, last = whole_days(edges.sparkSession, start, end)
    readings = period_readings(edges, run, start, end)
    if first > last:
        return turbine_statistics(readings)
    day = F.floor(F.unix_seconds("telemetry_time") / 86400)
    rest = daily_states(readings.filter(~day.between(first, last)))
    inner = for_run(states, run).filter(F.col("day").between(first, last))
    return merged_statistics(inner.select(*rest.columns).unionByName(rest))


def analyse(
    df: DataFrame,
    run: str | None,
    start: Bound,
    end: Bound,
    k: float = 2.0,
    include_time: bool = True,
    broadcast_groups: int = BROADCAST_GROUPS,
) -> tuple[DataFrame, DataFrame]:
    """Summary and anomalies of one run and period.

    Runs the aggregation, whose result has one row per turbine, and settles it in the shared
    checkpoint folder: both results then use the very same statistics, even if executors are lost
    in between, and the size of the join's small side is known.
    """
    readings = period_readings(df, run, start, end)
    statistics = settle(turbine_statistics(readings))
    thresholds = anomaly_thresholds(statistics, k)
    return (
        summary(statistics, run),
        anomalies(readings, thresholds, run, include_time, broadcast_groups),
    )
