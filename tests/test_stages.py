from datetime import datetime

from concurrent.futures import ThreadPoolExecutor

import pytest

from helpers import ANALYSIS_INPUT, RUN, assert_rows
from vanewatch import ParquetStore, publish, refine, run_pipeline, run_stage, run_stage_of_runs, summarise
from vanewatch.__main__ import main, parse, splits_of

HEADER = "timestamp,turbine_id,wind_speed,wind_direction,power_output\n"
PERIOD = ("2022-03-01 00:00:00", "2022-03-02 00:00:00")


@pytest.fixture
def source(folder):
    lines = [f"{t},{k},2.0,1,{p}" for t, k, p in ANALYSIS_INPUT]
    lines += ["INVALID,1,11.8,169,2.7", "2022-03-01 03:00:00,1,2.0,360,99"]
    with open(folder + "/readings.csv", "w") as file:
        file.write(HEADER + "\n".join(lines))
    return folder


@pytest.fixture
def store(spark, tmp_path):
    return ParquetStore(spark, str(tmp_path / "tables"))


def counts(store, run=RUN):
    return {table: store.read(table, run).count() for table in EXPECTED}


EXPECTED = {
    "bronze": 26, "silver": 24, "quarantine": 2, "summary_statistics": 2,
    "turbine_power_output_anomaly": 1,
}


def test_pipeline_and_rerun(spark, store, source):
    for _ in range(2):
        run_pipeline(spark, store, source, RUN, *PERIOD)
        assert counts(store) == EXPECTED
    assert_rows(
        store.read("turbine_power_output_anomaly", RUN), [(datetime.fromisoformat("2022-03-01 16:00:00"), 1, 4.5, RUN)]
    )
    assert_rows(
        store.read("quarantine", RUN),
        [("INVALID", "1", "11.8", "169", "2.7", RUN), ("2022-03-01 03:00:00", "1", "2.0", "360", "99", RUN)],
    )
    run_pipeline(spark, store, source, "second", *PERIOD)
    assert counts(store) == EXPECTED and counts(store, "second") == EXPECTED


def test_runs_at_the_same_time(spark, store, source):
    runs = ["r1", "r2", "r3"]
    with ThreadPoolExecutor(3) as pool:
        list(pool.map(lambda run: run_pipeline(spark, store, source, run, *PERIOD), runs))
    assert [counts(store, run) for run in runs] == [EXPECTED] * 3
    assert store.read_all("bronze").count() == 3 * EXPECTED["bronze"]


def test_stage_of_many_runs(spark, store, source):
    for run in ("r1", "r2"):
        run_stage(spark, "ingest", run, store, path=source)
    run_stage_of_runs(spark, "transform", ["r1", "r2"], store)
    # one run fails, the others are published all the same
    with pytest.raises(ValueError, match="run id"):
        run_stage_of_runs(spark, "publish", ["r1", "", "r2"], store, start=PERIOD[0], end=PERIOD[1])
    assert [counts(store, run) for run in ("r1", "r2")] == [EXPECTED] * 2


def test_summary_from_states(spark, store, source):
    """States are stored with silver, follow a rerun, and give the summary of any period."""
    for run in ("r1", "r2"):
        run_stage(spark, "ingest", run, store, path=source)
    run_stage_of_runs(spark, "transform", ["r1", "r2"], store, states=True)
    assert store.read("turbine_daily_state", "r1").count() == 3
    period = ("2022-03-01 03:00:00", "2022-03-02 05:00:00")
    for run in ("r1", "r2"):
        publish(spark, store, run, *period)
        want = store.read("summary_statistics", run).collect()
        summarise(spark, store, run, *period)
        assert_rows(store.read("summary_statistics", run), [tuple(r) for r in want])
    with open(source + "/readings.csv", "w") as file:
        file.write(HEADER + "2022-03-01 00:00:00,1,2.0,1,2.3")
    run_stage(spark, "ingest", "r1", store, path=source)
    run_stage(spark, "transform", "r1", store)
    assert (store.read("turbine_daily_state", "r1").count(), store.read("turbine_daily_state", "r2").count()) == (1, 3)
    summarise(spark, store, "r1", *PERIOD)
    assert_rows(store.read("summary_statistics", "r1"), [(1, 2.3, 2.3, 2.3, "r1")])
    summarise(spark, store, "absent", *PERIOD)
    assert store.read("summary_statistics", "absent").isEmpty()


def test_command_line_of_many_runs(spark, store, source):
    for run in ("r1", "r2"):
        main(["ingest", run, "--store", store.root, "--source", source])
    main(["transform", "r1", "r2", "--store", store.root, "--states", "--ordered", "--required", "fail"])
    main(["publish", "r1", "r2", "--store", store.root, "--start", PERIOD[0], "--end", PERIOD[1], "--at-once", "2"])
    assert [counts(store, run) for run in ("r1", "r2")] == [EXPECTED] * 2
    assert store.read_all("turbine_daily_state").count() == 6
    with pytest.raises(SystemExit):
        parse(["ingest", "r1", "r2", "--store", "x", "--source", "y"])


def test_append_doubles(spark, store, source):
    store.mode = "append"
    run_stage(spark, "ingest", RUN, store, path=source)
    run_stage(spark, "ingest", RUN, store, path=source)
    assert store.read("bronze", RUN).count() == 2 * EXPECTED["bronze"]


@pytest.mark.parametrize("cached", [True, False])
def test_caching_changes_nothing(spark, store, source, cached):
    run_stage(spark, "ingest", RUN, store, path=source)
    refine(spark, store, RUN, cached=cached)
    publish(spark, store, RUN, *PERIOD, cached=cached)
    assert counts(store) == EXPECTED
    assert spark.sparkContext._jsc.getPersistentRDDs().isEmpty()


def test_cache_is_released_on_failure(spark, store, source, monkeypatch):
    run_stage(spark, "ingest", RUN, store, path=source)

    def fail(*args, **kwargs):
        raise OSError("disk full")

    monkeypatch.setattr(store, "write", fail)
    with pytest.raises(OSError):
        refine(spark, store, RUN, cached=True)
    assert spark.sparkContext._jsc.getPersistentRDDs().isEmpty()


def test_rerun_after_the_errors_are_gone(spark, store, source):
    run_pipeline(spark, store, source, RUN, *PERIOD)
    with open(source + "/readings.csv", "w") as file:
        file.write(HEADER + "2022-03-01 00:00:00,1,2.0,1,2.3")
    run_pipeline(spark, store, source, RUN, *PERIOD)
    assert counts(store) == {
        "bronze": 1, "silver": 1, "quarantine": 0, "summary_statistics": 1,
        "turbine_power_output_anomaly": 0,
    }


def test_publish_without_time(spark, store, source):
    run_stage(spark, "ingest", RUN, store, path=source)
    run_stage(spark, "transform", RUN, store)
    publish(spark, store, RUN, *PERIOD, include_time=False)
    assert_rows(store.read("turbine_power_output_anomaly", RUN), [(None, 1, 4.5, RUN)])


def test_stage_of_an_unknown_run(spark, store):
    run_stage(spark, "transform", "absent", store)
    run_stage(spark, "publish", "absent", store, start=PERIOD[0], end=PERIOD[1])
    assert set(counts(store, "absent").values()) == {0}


@pytest.mark.parametrize(
    "mode, run, options",
    [
        ("load", RUN, {}),
        ("ingest", RUN, {}),
        ("ingest", "", {"path": "x"}),
        ("publish", RUN, {"start": PERIOD[0]}),
        ("publish", RUN, {"end": PERIOD[1]}),
        ("publish", RUN, {"start": PERIOD[0], "end": "never"}),
    ],
)
def test_argument_checks(spark, store, mode, run, options):
    with pytest.raises(ValueError):
        run_stage(spark, mode, run, store, **options)


def test_bad_period_is_reported_before_any_work(spark, store, source):
    with pytest.raises(ValueError):
        run_pipeline(spark, store, source, RUN, PERIOD[0], "never")
    assert store.read("bronze", RUN).isEmpty()


def test_command_line_options(spark, store, source):
    main([
        "all", RUN, "--store", store.root, "--source", source, "--start", PERIOD[0], "--end", PERIOD[1],
        "--k", "2.5", "--without-time", "--append",
    ])
    assert counts(store) == EXPECTED | {"turbine_power_output_anomaly": 0}
    main(["publish", RUN, "--store", store.root, "--start", PERIOD[0], "--end", PERIOD[1], "--without-time"])
    assert_rows(store.read("turbine_power_output_anomaly", RUN), [(None, 1, 4.5, RUN)])
    args = parse(["transform", RUN, "--jdbc-url", "u", "--split", "bronze:a < 1", "--split", "bronze:a >= 1 or a is null"])
    assert splits_of(args.split) == {"bronze": ["a < 1", "a >= 1 or a is null"]}
    with pytest.raises(SystemExit):
        parse(["transform", RUN, "--jdbc-url", "u", "--split", "bronze"])


def test_command_line(spark, store, source):
    main(["all", RUN, "--store", store.root, "--source", source, "--start", PERIOD[0], "--end", PERIOD[1]])
    assert counts(store) == EXPECTED
    for bad in (["ingest", RUN, "--store", "x"], ["publish", RUN, "--store", "x"], ["transform", RUN]):
        with pytest.raises(SystemExit):
            parse(bad)
