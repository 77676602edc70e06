"""The three stages of a run, and their order."""

from __future__ import annotations

from collections.abc import Iterable
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from functools import reduce

from pyspark import StorageLevel, inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

from vanewatch.operators.analysis import (
    Bound,
    anomalies,
    anomaly_thresholds,
    daily_states,
    edge_periods,
    period_bounds,
    period_readings,
    period_statistics,
    summary,
    turbine_statistics,
    whole_days,
)
from vanewatch.operators.quality import flag_quality, to_quarantine, to_silver
from vanewatch.schemas import RUN
from vanewatch.scratch import settled
from vanewatch.sources.telemetry_csv import read_telemetry_csv, stamp_run

MODES = ("ingest", "transform", "publish")


@contextmanager
def _reused(df: DataFrame, cached: bool):
    """``df`` for more than one action, cached for their duration if asked for.

    On disk only: the frame is as long as its input, and memory is better left to the tasks.
    """
    if not cached:
        yield df
        return
    df.persist(StorageLevel.DISK_ONLY)
    try:
        yield df
    finally:
        df.unpersist()


def ingest(spark: SparkSession, store, path: str | list[str], run: str) -> None:
    """Files to bronze, under a run id."""
    store.write("bronze", stamp_run(read_telemetry_csv(spark, path), run), run)


def refine(spark: SparkSession, store, run: str, cached: bool | None = None, states: bool = False) -> None:
    """Bronze to silver and quarantine.

    A store that can write both tables in one pass does so. With ``cached`` the typed rows are kept between two
    writes instead; by default the store decides. ``states`` adds the mergeable statistics of each day; a run that
    has them gets new ones in any case.
    """
    refine_runs(spark, store, [run], cached, states)


def refine_runs(
    spark: SparkSession, store, runs: Iterable[str], cached: bool | None = None, states: bool = False
) -> None:
    """``refine`` of many runs as one job: their rows carry their run id."""
    runs = list(runs)
    quality = flag_quality(store.read_runs("bronze", runs))
    if not (not store.cheap_rescan if cached is None else cached):
        store.write_split(quality, runs)
    else:
        with _reused(quality, True) as quality:
            for run in runs:
                store.write("silver", to_silver(quality), run)
                store.write("quarantine", to_quarantine(quality), run, compact=True)
    had = set() if states else set(store.runs("turbine_daily_state"))
    store_states(store, [run for run in runs if states or run in had])


def store_states(store, runs: Iterable[str]) -> None:
    """Mergeable statistics of each turbine and day of the runs, from their silver."""
    runs = list(runs)
    if runs:
        found = daily_states(store.read_runs("silver", runs), RUN)
        if len(runs) == 1:
            # a run without readings gets no states rather than keeping its old ones
            store.write("turbine_daily_state", found, runs[0], compact=True)
        else:
            store.write_runs("turbine_daily_state", found, compact=True, runs=runs)


def summarise(spark: SparkSession, store, run: str, start: Bound, end: Bound) -> None:
    """Summary of a period from the stored states of its whole days; of silver it reads the first and last day only."""
    first, last = whole_days(spark, start, end)
    periods = edge_periods(spark, start, end) if first <= last else [(start, end)]
    edges = reduce(DataFrame.unionByName, [store.read("silver", run, period=period) for period in periods])
    statistics = period_statistics(edges, store.read("turbine_daily_state", run), run, start, end)
    store.write("summary_statistics", summary(statistics, run), run, compact=True)


def publish(
    spark: SparkSession,
    store,
    run: str,
    start: Bound,
    end: Bound,
    k: float = 2.0,
    include_time: bool = True,
    cached: bool | None = None,
) -> None:
    """Silver to summary and anomalies of a period."""
    silver = store.read("silver", run, period=(start, end))
    readings = period_readings(silver, run, start, end)
    with _reused(readings, not store.cheap_rescan if cached is None else cached) as readings:
        with settled(turbine_statistics(readings)) as statistics:
            store.write("summary_statistics", summary(statistics, run), run)
            found = anomalies(readings, anomaly_thresholds(statistics, k), run, include_time)
            store.write("turbine_power_output_anomaly", found, run, compact=True)


def run_stage(
    spark: SparkSession,
    mode: str,
    run: str,
    store,
    path: str | list[str] | None = None,
    start: Bound | None = None,
    end: Bound | None = None,
    k: float = 2.0,
    include_time: bool = True,
    cached: bool | None = None,
    states: bool = False,
) -> None:
    """Run one stage by name, checking first that it has what it needs."""
    if mode not in MODES:
        raise ValueError(f"unknown mode {mode!r}, expected one of {MODES}")
    if not run:
        raise ValueError("a run id is required")
    if mode == "ingest":
        if not path:
            raise ValueError("ingest needs a source path")
        ingest(spark, store, path, run)
    elif mode == "transform":
        refine(spark, store, run, cached, states)
    else:
        if not start or not end:
            raise ValueError("publish needs a start and an end")
        publish(spark, store, run, start, end, k, include_time, cached)


def run_stage_of_runs(
    spark: SparkSession, mode: str, runs: Iterable[str], store, at_once: int = 4, **options
) -> None:
    """One stage of many runs, with the options of ``run_stage``.

    Transform takes all runs in one job. Of the other stages ``at_once`` run at the same time, so that small runs
    fill the cluster; the other runs are finished before the error of a failed one is raised.
    """
    runs = list(runs)
    if mode == "transform":
        if not all(runs):
            raise ValueError("a run id is required")
        if runs:
            refine_runs(spark, store, runs, options.get("cached"), options.get("states", False))
        return
    stage = inheritable_thread_target(spark)(run_stage)
    with ThreadPoolExecutor(at_once) as pool:
        started = [pool.submit(stage, spark, mode, run, store, **options) for run in runs]
    for one in started:
        one.result()


def run_pipeline(
    spark: SparkSession,
    store,
    path: str | list[str],
    run: str,
    start: Bound,
    end: Bound,
    **options,
) -> None:
    """All stages of one run, in order, with the options of ``run_stage``. Bad period bounds are reported before any work is done."""
    period_bounds(spark, start, end)
    for mode in MODES:
        run_stage(spark, mode, run, store, path=path, start=start, end=end, **options)
