"""Queries over the supplied tables, and the SQL that gives the same results.

The tables hold no machine telemetry, so raw readings are derived from every row of ``events``: the
values become text and some of them are made unreadable. ``load-1`` is the whole table as one run;
where several runs matter, each event type is a run.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vanewatch import (
    ParquetStore,
    analyse,
    anomaly_thresholds,
    daily_states,
    flag_quality,
    for_run,
    in_period,
    ingest,
    period_statistics,
    publish,
    refine,
    run_pipeline,
    run_stage_of_runs,
    stamp_run,
    summarise,
    to_quarantine,
    to_silver,
    turbine_statistics,
    with_quality,
)
from vanewatch.functions.convert import lenient_double, lenient_int, lenient_timestamp
from vanewatch.operators.quality import RULES
from vanewatch.schemas import RAW_FIELDS
from vanewatch.scratch import shared_dir

try:  # the training-data operators are an optional part
    from vanewatch.llm import queries as llm_queries
except ImportError as missing:
    if not (missing.name or "").startswith("vanewatch.llm"):
        raise
    llm_queries = None
try:
    import corpus_pipeline
except ImportError as missing:
    if missing.name != "corpus_pipeline" and not (missing.name or "").startswith("vanewatch.llm"):
        raise
    corpus_pipeline = None

RUN = "load-1"
START, END = "2024-01-05 00:00:00", "2024-01-20 00:00:00"

_RAW = """
 case when event_id % 50 = 0 then 'INVALID' when event_id % 50 = 1 then null else {ts} end as {q}timestamp{q},
 case when event_id % 71 = 0 then 'T' || cast(user_id % 20 as {s}) else cast(user_id % 20 as {s}) end as turbine_id,
 case when event_id % 83 = 0 then '' else cast(event_id % 25 as {s}) || '.5' end as wind_speed,
 cast(event_id % 380 as {s}) || case event_id % 4 when 1 then '.0' when 2 then '.9' else '' end as wind_direction,
 case when event_id % 97 = 0 then 'n/a' else cast(value as {s}) end as power_output,
 event_type as event_id"""


# --- inputs ---------------------------------------------------------------------------------------


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    # with the schema given, planning reads no file
    columns = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double"
    return spark.read.schema(columns).parquet(f"{sf_dir}/events.parquet")


def bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw readings, one run per event type."""
    columns = _RAW.format(s="string", q="`", ts="date_format(ts, 'yyyy-MM-dd HH:mm:ss')")
    return _events(spark, sf_dir).selectExpr(*[c.strip() for c in columns.split(",\n")])


def one_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same raw readings as a single run."""
    return stamp_run(bronze(spark, sf_dir).drop("event_id"), RUN)


def silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return to_silver(with_quality(one_run(spark, sf_dir), RUN))


def period_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return in_period(for_run(silver(spark, sf_dir), RUN), START, END)


def typed_events(spark: SparkSession, sf_dir: str, key: str = "user_id") -> DataFrame:
    """Events as readings without any cleaning, and a period that holds all of them."""
    return _events(spark, sf_dir).selectExpr(
        "ts as telemetry_time",
        f"{key} as turbine_id",
        "value as power_output",
        f"'{RUN}' as event_id",
    )


ALL_TIME = ("0001-01-01 00:00:00", "9999-12-31 23:59:59")


def new_folder(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def new_store(spark: SparkSession, **options) -> ParquetStore:
    return ParquetStore(spark, new_folder(spark, "tables"), **options)


def loaded_store(spark: SparkSession, sf_dir: str) -> ParquetStore:
    """A store whose bronze table holds the whole table as one run."""
    store = new_store(spark)
    store.write("bronze", one_run(spark, sf_dir), RUN)
    return store


def csv_folder(spark: SparkSession, sf_dir: str) -> str:
    folder = new_folder(spark, "csv")
    bronze(spark, sf_dir).drop("event_id").write.option("header", True).csv(folder)
    return folder


def wall_clock(df: DataFrame, column: str = "telemetry_time") -> DataFrame:
    """Timestamps without a time zone, as the SQL side has them."""
    return df.withColumn(column, F.col(column).cast("timestamp_ntz"))


def rounded(df: DataFrame, *columns: str) -> DataFrame:
    """The last digits of a mean depend on the order of addition."""
    return df.withColumns({c: F.round(c, 6) for c in columns})


# --- queries --------------------------------------------------------------------------------------


def csv_ingest(spark, sf_dir):
    store = new_store(spark)
    ingest(spark, store, csv_folder(spark, sf_dir), RUN)
    return store.read("bronze", RUN)


def bronze_roundtrip(spark, sf_dir):
    store = new_store(spark)
    store.write_runs("bronze", bronze(spark, sf_dir))
    return store.read_all("bronze")


def rerun_replaces(spark, sf_dir):
    store = loaded_store(spark, sf_dir)
    store.write("bronze", one_run(spark, sf_dir), RUN)
    return store.read("bronze", RUN).groupBy("event_id").agg(F.count("*").alias("rows"))


def convert_timestamp(spark, sf_dir):
    return wall_clock(
        bronze(spark, sf_dir).select(
            F.col("timestamp").alias("text"), lenient_timestamp(F.col("timestamp")).alias("value")
        ),
        "value",
    )


def convert_int(spark, sf_dir):
    turbine, direction = F.col("turbine_id"), F.col("wind_direction")
    return bronze(spark, sf_dir).select(
        turbine.alias("turbine_text"),
        lenient_int(turbine).alias("turbine_value"),
        direction.alias("direction_text"),
        lenient_int(direction).alias("direction_value"),
    )


def convert_double(spark, sf_dir):
    speed, power = F.col("wind_speed"), F.col("power_output")
    return bronze(spark, sf_dir).select(
        speed.alias("speed_text"),
        lenient_double(speed).alias("speed_value"),
        power.alias("power_text"),
        lenient_double(power).alias("power_value"),
    )


def run_filter(spark, sf_dir):
    return for_run(bronze(spark, sf_dir), "click")


def quality_flags(spark, sf_dir):
    return wall_clock(flag_quality(bronze(spark, sf_dir)), "converted_timestamp")


def quality_error_counts(spark, sf_dir):
    return (
        flag_quality(bronze(spark, sf_dir))
        .groupBy("event_id")
        .agg(*[F.expr(f"count_if({failed})").alias(rule) for rule, failed in RULES.items()])
    )


def silver_rows(spark, sf_dir):
    return wall_clock(silver(spark, sf_dir))


def quarantine_rows(spark, sf_dir):
    return to_quarantine(with_quality(one_run(spark, sf_dir), RUN))


def refine_split(spark, sf_dir):
    store = new_store(spark)
    store.write_runs("bronze", bronze(spark, sf_dir))
    run_stage_of_runs(spark, "transform", store.runs("bronze"), store)
    parts = [
        store.read_all(table).groupBy("event_id").agg(F.count("*").alias("n")).withColumn("t", F.lit(table))
        for table in ("bronze", "silver", "quarantine")
    ]
    return (
        parts[0].unionByName(parts[1]).unionByName(parts[2])
        .groupBy("event_id")
        .agg(*[
            F.sum(F.when(F.col("t") == table, F.col("n"))).alias(f"{table}_rows")
            for table in ("bronze", "silver", "quarantine")
        ])
    )


def _refined(spark, sf_dir) -> ParquetStore:
    store = loaded_store(spark, sf_dir)
    refine(spark, store, RUN)
    return store


def silver_store(spark, sf_dir):
    return wall_clock(_refined(spark, sf_dir).read("silver", RUN))


def quarantine_store(spark, sf_dir):
    return _refined(spark, sf_dir).read("quarantine", RUN)


def period_filter(spark, sf_dir):
    return wall_clock(period_silver(spark, sf_dir))


def turbine_statistics_rows(spark, sf_dir):
    return rounded(
        turbine_statistics(period_silver(spark, sf_dir)), "mean_power_output", "stddev_power_output"
    )


def _analysed(spark, sf_dir, **options):
    return analyse(silver(spark, sf_dir), RUN, START, END, **options)


def summary_rows(spark, sf_dir):
    return rounded(_analysed(spark, sf_dir)[0], "mean_power_output")


def anomaly_thresholds_rows(spark, sf_dir):
    thresholds = anomaly_thresholds(turbine_statistics(period_silver(spark, sf_dir)))
    bounds = ("power_output_anomaly_threshold_min", "power_output_anomaly_threshold_max")
    return rounded(thresholds.select("turbine_id", *bounds), *bounds)


def power_anomalies(spark, sf_dir):
    return wall_clock(_analysed(spark, sf_dir)[1])


def power_anomalies_many_turbines(spark, sf_dir):
    """The way taken beyond the broadcast limit: heavy turbines broadcast, the others by key."""
    return wall_clock(_analysed(spark, sf_dir, broadcast_groups=16)[1])


SKEWED = "case when event_id % 3 = 0 then 0 when event_id % 50 = 1 then null else user_id end"


def skewed_turbine_anomalies(spark, sf_dir):
    """A third of the readings on one turbine, which is broadcast, the light ones joined by key."""
    return analyse(typed_events(spark, sf_dir, SKEWED), RUN, *ALL_TIME, broadcast_groups=8)[1]


def silver_of_other_writer(spark, sf_dir):
    """Silver files without the hidden day column, read by period."""
    store = new_store(spark)
    rows = silver(spark, sf_dir)
    rows.drop("event_id").write.parquet(f"{store.path('silver')}/event_id={RUN}")
    return wall_clock(in_period(store.read("silver", RUN, period=(START, END)), START, END))


def write_takes_its_run(spark, sf_dir):
    """Writing one run out of a frame that holds several."""
    store = new_store(spark)
    store.write("bronze", bronze(spark, sf_dir), "click")
    return store.read("bronze", "click")


def _silver_store(spark, sf_dir) -> ParquetStore:
    store = new_store(spark)
    store.write("silver", silver(spark, sf_dir), RUN)
    return store


def power_anomalies_stored(spark, sf_dir):
    store = _silver_store(spark, sf_dir)
    publish(spark, store, RUN, START, END, include_time=False)
    return store.read("turbine_power_output_anomaly", RUN).drop("telemetry_time")


def summary_store(spark, sf_dir):
    store = _silver_store(spark, sf_dir)
    publish(spark, store, RUN, START, END)
    return rounded(store.read("summary_statistics", RUN), "mean_power_output")


def _daily_store(spark, sf_dir) -> ParquetStore:
    store = new_store(spark, daily=True)
    store.write("silver", silver(spark, sf_dir), RUN)
    publish(spark, store, RUN, START, END, include_time=False)
    return store


def power_anomalies_daily(spark, sf_dir):
    return _daily_store(spark, sf_dir).read("turbine_power_output_anomaly", RUN).drop("telemetry_time")


def summary_daily(spark, sf_dir):
    return rounded(_daily_store(spark, sf_dir).read("summary_statistics", RUN), "mean_power_output")


ODD_START, ODD_END = "2024-01-05 07:30:00", "2024-01-19 16:45:10.5"


def statistics_from_states(spark, sf_dir):
    """A period that begins and ends within a day, from the states of its whole days and the readings of the others."""
    rows = silver(spark, sf_dir)
    states = daily_states(rows, "event_id")
    found = period_statistics(rows, states, RUN, ODD_START, ODD_END)
    return rounded(found, "mean_power_output", "stddev_power_output")


def summary_from_states(spark, sf_dir):
    store = loaded_store(spark, sf_dir)
    refine(spark, store, RUN, states=True)
    summarise(spark, store, RUN, START, END)
    return rounded(store.read("summary_statistics", RUN), "mean_power_output")


def period_of_ordered_files(spark, sf_dir):
    store = new_store(spark, ordered=True)
    store.write("silver", silver(spark, sf_dir), RUN)
    return wall_clock(store.read("silver", RUN, period=(ODD_START, ODD_END)))


def required_counts(spark, sf_dir):
    """NULLs in required columns, counted while all typed readings, the invalid ones too, are stored."""
    store = new_store(spark, required="count")
    names = {"converted_timestamp": "telemetry_time"} | {f"converted_{f}": f for f in RAW_FIELDS[1:]}
    rows = flag_quality(one_run(spark, sf_dir)).select(*[F.col(k).alias(v) for k, v in names.items()], "event_id")
    store.write("silver", rows, RUN)
    counts = store.violations["silver"]
    return spark.createDataFrame([tuple(counts.values())], ", ".join(f"{name} long" for name in counts))


def publish_job(spark, sf_dir):
    store = new_store(spark)
    store.write_runs("silver", to_silver(flag_quality(bronze(spark, sf_dir))))
    run_stage_of_runs(spark, "publish", store.runs("silver"), store, start=START, end=END)
    turbines = store.read_all("summary_statistics").groupBy("event_id").agg(F.count("*").alias("turbines"))
    found = store.read_all("turbine_power_output_anomaly").groupBy("event_id").agg(F.count("*").alias("anomalies"))
    return turbines.join(found, "event_id", "left").fillna(0, ["anomalies"])


def telemetry_pipeline(spark, sf_dir):
    store = new_store(spark)
    run_pipeline(spark, store, csv_folder(spark, sf_dir), RUN, START, END)
    return wall_clock(store.read("turbine_power_output_anomaly", RUN))


def events_anomalies(spark, sf_dir):
    return analyse(typed_events(spark, sf_dir), RUN, *ALL_TIME)[1]


def null_key_anomalies(spark, sf_dir):
    readings = typed_events(spark, sf_dir, "nullif(user_id % 20, 7)")
    return analyse(readings, RUN, *ALL_TIME)[1]


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = telemetry_queries()
    if llm_queries:
        found |= llm_queries.queries()
    if corpus_pipeline:
        found["pipeline"] = corpus_pipeline.run
    return found


def telemetry_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "csv_ingest": csv_ingest,
        "bronze_roundtrip": bronze_roundtrip,
        "rerun_replaces": rerun_replaces,
        "convert_timestamp": convert_timestamp,
        "convert_int": convert_int,
        "convert_double": convert_double,
        "run_filter": run_filter,
        "quality_flags": quality_flags,
        "quality_error_counts": quality_error_counts,
        "silver": silver_rows,
        "quarantine": quarantine_rows,
        "refine_split": refine_split,
        "silver_store": silver_store,
        "quarantine_store": quarantine_store,
        "period_filter": period_filter,
        "turbine_statistics": turbine_statistics_rows,
        "summary": summary_rows,
        "anomaly_thresholds": anomaly_thresholds_rows,
        "power_anomalies": power_anomalies,
        "power_anomalies_many_turbines": power_anomalies_many_turbines,
        "power_anomalies_stored": power_anomalies_stored,
        "summary_store": summary_store,
        "power_anomalies_daily": power_anomalies_daily,
        "summary_daily": summary_daily,
        "statistics_from_states": statistics_from_states,
        "summary_from_states": summary_from_states,
        "period_of_ordered_files": period_of_ordered_files,
        "required_counts": required_counts,
        "publish_job": publish_job,
        "telemetry_pipeline": telemetry_pipeline,
        "events_anomalies": events_anomalies,
        "null_key_anomalies": null_key_anomalies,
        "skewed_turbine_anomalies": skewed_turbine_anomalies,
        "silver_of_other_writer": silver_of_other_writer,
        "write_takes_its_run": write_takes_its_run,
    }


def entry(spark: SparkSession) -> DataFrame:
    """Anomalous readings of the whole smallest table."""
    return power_anomalies(spark, "/root/testdata/sf0.001")


# --- the same in SQL ------------------------------------------------------------------------------

_INT = r"try_cast(regexp_replace({0}, '^\s*([+-]?)([0-9]*)\.[0-9]*\s*$', '\10\2') as integer)"
_RAW_LIST = ", ".join(f'"{name}"' for name in RAW_FIELDS)
_SILVER_LIST = "telemetry_time, turbine_id, wind_speed, wind_direction, power_output, event_id"
_STATS = """
 min(power_output) as min_power_output, max(power_output) as max_power_output,
 avg(power_output) as mean_power_output, stddev_samp(power_output) as stddev_power_output"""

_CTE = f"""
with runs as (
 select {_RAW.format(s="varchar", q='"', ts="strftime(ts, '%Y-%m-%d %H:%M:%S')")} from events
), quality as (
 select *,
  converted_timestamp is null as bad_time, converted_turbine_id is null as bad_turbine,
  converted_wind_speed is null as bad_speed, converted_wind_direction is null as bad_direction,
  coalesce(converted_wind_direction not between 0 and 359, false) as direction_range,
  converted_power_output is null as bad_power
 from (
  select *, try_cast("timestamp" as timestamp) as converted_timestamp,
   {_INT.format("turbine_id")} as converted_turbine_id,
   try_cast(wind_speed as double) as converted_wind_speed,
   {_INT.format("wind_direction")} as converted_wind_direction,
   try_cast(power_output as double) as converted_power_output
  from runs)
), flagged as (
 select *, bad_time or bad_turbine or bad_speed or bad_direction or direction_range or bad_power as is_error
 from quality
), typed_runs as (
 select converted_timestamp as telemetry_time, converted_turbine_id as turbine_id,
  converted_wind_speed as wind_speed, converted_wind_direction as wind_direction,
  converted_power_output as power_output, event_id
 from flagged where not is_error
), raw as (select * replace ('{RUN}' as event_id) from runs),
silver as (select * replace ('{RUN}' as event_id) from typed_runs),
quarantine as (select {_RAW_LIST}, '{RUN}' as event_id from flagged where is_error),
in_period as (
 select * from silver where telemetry_time between timestamp '{START}' and timestamp '{END}'
), stats as (
 select turbine_id, {_STATS}, count(*) as readings from in_period group by turbine_id
), bounds as (
 select *, mean_power_output - stddev_power_output * 2 as lo, mean_power_output + stddev_power_output * 2 as hi
 from stats
), anomalies as (
 select t.telemetry_time, t.turbine_id, t.power_output, t.event_id
 from in_period t join bounds b on t.turbine_id is not distinct from b.turbine_id
 where t.power_output < b.lo or t.power_output > b.hi
)
"""


def _typed_sql(key: str) -> str:
    return f"""
with t as (select ts as telemetry_time, {key} as turbine_id, value as power_output, '{RUN}' as event_id from events),
b as (select turbine_id, avg(power_output) as m, stddev_samp(power_output) as s from t group by turbine_id)
select t.* from t join b on t.turbine_id is not distinct from b.turbine_id
where power_output < m - s * 2 or power_output > m + s * 2"""


def oracle_sql() -> dict[str, str]:
    raw_rows = f"select {_RAW_LIST}, event_id from raw"
    loaded = ", ".join(f"""nullif("{name}", '') as "{name}\"""" for name in RAW_FIELDS)
    converted = ", ".join(f"converted_{name}" for name in RAW_FIELDS)
    rules = ("bad_time", "bad_turbine", "bad_speed", "bad_direction", "direction_range", "bad_power")
    summary_sql = """select turbine_id, min_power_output, max_power_output,
 round(mean_power_output, 6) as mean_power_output, event_id from stats cross join (select '%s' as event_id)""" % RUN
    silver_sql = f"select {_SILVER_LIST} from silver"
    quarantine_sql = "select * from quarantine"
    anomalies_sql = "select * from anomalies"
    body = {
        "csv_ingest": f"select {loaded}, event_id from raw",
        "bronze_roundtrip": f"select {_RAW_LIST}, event_id from runs",
        "rerun_replaces": "select event_id, count(*) as rows from raw group by event_id",
        "convert_timestamp": """select "timestamp" as text, converted_timestamp as value from quality""",
        "convert_int": """select turbine_id as turbine_text, converted_turbine_id as turbine_value,
 wind_direction as direction_text, converted_wind_direction as direction_value from quality""",
        "convert_double": """select wind_speed as speed_text, converted_wind_speed as speed_value,
 power_output as power_text, converted_power_output as power_value from quality""",
        "run_filter": f"select {_RAW_LIST}, event_id from runs where event_id is not distinct from 'click'",
        "quality_flags": f"select {_RAW_LIST}, {converted}, event_id, is_error from flagged",
        "quality_error_counts": "select event_id, "
        + ", ".join(f"count(*) filter (where {rule}) as {rule}" for rule in rules)
        + " from quality group by event_id",
        "silver": silver_sql,
        "quarantine": quarantine_sql,
        "refine_split": """select event_id, count(*) as bronze_rows,
 count(*) filter (where not is_error) as silver_rows, count(*) filter (where is_error) as quarantine_rows
 from flagged group by event_id""",
        "silver_store": silver_sql,
        "quarantine_store": quarantine_sql,
        "period_filter": f"select {_SILVER_LIST} from in_period",
        "turbine_statistics": """select turbine_id, min_power_output, max_power_output,
 round(mean_power_output, 6) as mean_power_output, round(stddev_power_output, 6) as stddev_power_output,
 readings from stats""",
        "summary": summary_sql,
        "anomaly_thresholds": """select turbine_id, round(lo, 6) as power_output_anomaly_threshold_min,
 round(hi, 6) as power_output_anomaly_threshold_max from bounds""",
        "power_anomalies": anomalies_sql,
        "power_anomalies_many_turbines": anomalies_sql,
        "power_anomalies_stored": "select turbine_id, power_output, event_id from anomalies",
        "summary_store": summary_sql,
        "power_anomalies_daily": "select turbine_id, power_output, event_id from anomalies",
        "summary_daily": summary_sql,
        "statistics_from_states": f"""select turbine_id, min(power_output) as min_power_output,
 max(power_output) as max_power_output, round(avg(power_output), 6) as mean_power_output,
 round(stddev_samp(power_output), 6) as stddev_power_output, count(*) as readings from silver
 where telemetry_time between timestamp '{ODD_START}' and timestamp '{ODD_END}' group by turbine_id""",
        "summary_from_states": summary_sql,
        "period_of_ordered_files": f"""select {_SILVER_LIST} from silver
 where telemetry_time between timestamp '{ODD_START}' and timestamp '{ODD_END}'""",
        "required_counts": """select count(*) filter (where bad_time) as telemetry_time,
 count(*) filter (where bad_turbine) as turbine_id, count(*) filter (where bad_speed) as wind_speed,
 count(*) filter (where bad_direction) as wind_direction, count(*) filter (where bad_power) as power_output,
 0::bigint as event_id from flagged""",
        "publish_job": f""", per_run as (
 select event_id, turbine_id, avg(power_output) as m, stddev_samp(power_output) as s from typed_runs
 where telemetry_time between timestamp '{START}' and timestamp '{END}' group by event_id, turbine_id
)
select r.event_id, count(distinct r.turbine_id) as turbines,
 count(*) filter (where t.power_output < m - s * 2 or t.power_output > m + s * 2) as anomalies
from per_run r join typed_runs t on t.event_id = r.event_id and t.turbine_id = r.turbine_id
where t.telemetry_time between timestamp '{START}' and timestamp '{END}'
group by r.event_id""",
        "telemetry_pipeline": anomalies_sql,
        "silver_of_other_writer": f"select {_SILVER_LIST} from in_period",
        "write_takes_its_run": f"select {_RAW_LIST}, event_id from runs where event_id = 'click'",
    }
    sql = {name: _CTE + text for name, text in body.items()}
    sql["events_anomalies"] = _typed_sql("user_id")
    sql["skewed_turbine_anomalies"] = _typed_sql(SKEWED)
    sql["null_key_anomalies"] = _typed_sql("nullif(user_id % 20, 7)")
    if llm_queries:
        sql |= llm_queries.oracle_sql()
    if corpus_pipeline and corpus_pipeline.ORACLE_SQL:
        sql["pipeline"] = corpus_pipeline.ORACLE_SQL
    return sql
