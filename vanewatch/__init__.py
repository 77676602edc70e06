"""Telemetry quality and anomaly analysis on Spark DataFrames."""

from vanewatch.operators.analysis import (
    analyse,
    anomalies,
    anomaly_thresholds,
    daily_states,
    in_period,
    merged_statistics,
    period_statistics,
    summary,
    turbine_statistics,
)
from vanewatch.operators.quality import (
    flag_quality,
    for_run,
    to_quarantine,
    to_silver,
    with_quality,
)
from vanewatch.plans.stages import (
    ingest,
    publish,
    refine,
    refine_runs,
    run_pipeline,
    run_stage,
    run_stage_of_runs,
    store_states,
    summarise,
)
from vanewatch.sources.jdbc_store import JdbcStore, postgres_connection
from vanewatch.sources.parquet_store import ParquetStore
from vanewatch.sources.telemetry_csv import read_telemetry_csv, stamp_run

__all__ = [
    "JdbcStore",
    "postgres_connection",
    "ParquetStore",
    "analyse",
    "anomalies",
    "anomaly_thresholds",
    "daily_states",
    "flag_quality",
    "for_run",
    "in_period",
    "ingest",
    "merged_statistics",
    "period_statistics",
    "publish",
    "read_telemetry_csv",
    "refine",
    "refine_runs",
    "run_pipeline",
    "run_stage",
    "run_stage_of_runs",
    "stamp_run",
    "store_states",
    "summarise",
    "summary",
    "to_quarantine",
    "to_silver",
    "turbine_statistics",
    "with_quality",
]
