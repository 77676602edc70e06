import glob
import os
import re
from datetime import datetime

import duckdb
import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from helpers import (
    ANALYSIS_INPUT,
    END,
    QUALITY_INPUT,
    RUN,
    START,
    assert_rows,
    assert_same_rows,
    bronze,
    plan,
    readings,
)
from vanewatch import (
    JdbcStore,
    ParquetStore,
    analyse,
    flag_quality,
    for_run,
    in_period,
    read_telemetry_csv,
    run_stage_of_runs,
    stamp_run,
    to_quarantine,
    to_silver,
    turbine_statistics,
)
from vanewatch.operators.analysis import period_readings
from vanewatch.operators.quality import split_rows
from vanewatch.schemas import RAW, SUMMARY, TABLES, conform
from vanewatch.sources.jdbc_store import block_splits, hash_splits, postgres_connection, quoted
from vanewatch.sources import parquet_store
from vanewatch.sources.parquet_store import live, partition_folder

HEADER = "timestamp,turbine_id,wind_speed,wind_direction,power_output\n"
ODD_RUNS = [
    "2022", "manual__2022-03-01T00:00:00+00:00", "a b", " padded ", ".", "50%", "x=y/z", "Zoë", "{a,b}*?[c]^", "\\'\"#",
]


def write_text(folder, name, text):
    os.makedirs(os.path.dirname(f"{folder}/{name}"), exist_ok=True)
    with open(f"{folder}/{name}", "w") as file:
        file.write(text)


def write_replaced(spark, folder, run, rows, mode="replace"):
    ParquetStore(spark, folder, mode).write("bronze", bronze(spark, rows, run), run)


# --- CSV ------------------------------------------------------------------------------------------


def test_csv_odd_lines(spark, folder):
    lines = [
        "2022-03-01 00:00:00,1,11.8,169,2.7",
        "2022-03-01 01:00:00,1",
        "2022-03-01 02:00:00,1,11.8,169,2.7,extra,fields",
        "",
        '"2022-03-01, 03:00:00",1,,"",2.7',
        "  7 , 1 ,a,# no comment,2.7",
        "INVALID,1,11.8,169,2.7",
    ]
    write_text(folder, "a.csv", HEADER + "\n".join(lines))
    df = read_telemetry_csv(spark, folder)
    assert df.schema == RAW
    assert_rows(
        df,
        [
            ("2022-03-01 00:00:00", "1", "11.8", "169", "2.7"),
            ("2022-03-01 01:00:00", "1", None, None, None),
            ("2022-03-01 02:00:00", "1", "11.8", "169", "2.7"),
            ("2022-03-01, 03:00:00", "1", None, None, "2.7"),
            ("  7 ", " 1 ", "a", "# no comment", "2.7"),
            ("INVALID", "1", "11.8", "169", "2.7"),
        ],
    )


def test_csv_fields_go_by_position(spark, folder):
    write_text(folder, "a.csv", "turbine_id,timestamp,wind_speed,wind_direction,power_output\n1,t,2,3,4\n")
    assert_rows(read_telemetry_csv(spark, folder), [("1", "t", "2", "3", "4")])


def test_csv_folder_listing(spark, folder):
    write_text(folder, "a.csv", HEADER + "a,1,2,3,4\n")
    write_text(folder, "b.txt", HEADER + "b,1,2,3,4\n")
    for hidden in ("_hidden.csv", ".hidden.csv", "below/c.csv"):
        write_text(folder, hidden, HEADER + "x,1,2,3,4\n")
    assert sorted(r.timestamp for r in read_telemetry_csv(spark, folder).collect()) == ["a", "b"]
    assert read_telemetry_csv(spark, [f"{folder}/a.csv", f"{folder}/below/c.csv"]).count() == 2


def test_csv_missing_path(spark, folder):
    with pytest.raises(AnalysisException, match="PATH_NOT_FOUND"):
        read_telemetry_csv(spark, folder + "/absent")


def test_stamp(spark):
    df = stamp_run(spark.createDataFrame([("a", "1", "2", "3", "4")], RAW), "2022")
    assert df.schema["event_id"].dataType.simpleString() == "string"
    assert_rows(df, [("a", "1", "2", "3", "4", "2022")])


# --- layouts --------------------------------------------------------------------------------------


def test_conform(spark):
    df = spark.sql("select 'r' event_id, 2L turbine_id, 1f min_power_output, 2f max_power_output, 9 extra")
    with pytest.raises(ValueError, match="mean_power_output"):
        conform(df, "summary_statistics")
    got = conform(df.withColumn("mean_power_output", F.lit(1)), "summary_statistics")
    assert [f.dataType for f in got.schema] == [f.dataType for f in SUMMARY]
    assert got.columns == SUMMARY.names
    with pytest.raises(ValueError, match="telemetry_time"):
        conform(df, "silver")
    narrow = df.selectExpr("event_id", "turbine_id", "9 power_output")
    assert conform(narrow, "turbine_power_output_anomaly").columns == ["turbine_id", "power_output", "event_id"]


# --- parquet --------------------------------------------------------------------------------------


@pytest.mark.parametrize("run", ODD_RUNS + [None])
def test_run_id_survives(spark, folder, run):
    store = ParquetStore(spark, folder)
    store.write("bronze", bronze(spark, QUALITY_INPUT, run), run)
    store.write("bronze", bronze(spark, QUALITY_INPUT[:1], "other"), "other")
    expected = [(*r, run) for r in QUALITY_INPUT]
    assert_rows(store.read("bronze", run), expected)
    assert_rows(store.read_all("bronze"), expected + [(*QUALITY_INPUT[0], "other")])


@pytest.mark.parametrize("run", ODD_RUNS + [None])
def test_folder_is_the_one_spark_would_write(spark, folder, run):
    bronze(spark, QUALITY_INPUT[:1], run).write.partitionBy("event_id").parquet(folder + "/t")
    assert partition_folder(run) in os.listdir(folder + "/t")


def test_empty_run_id(spark, folder):
    with pytest.raises(ValueError):
        ParquetStore(spark, folder).read("bronze", "")


def test_rerun_replaces_only_its_own_run(spark, folder):
    write_replaced(spark, folder, "a", QUALITY_INPUT)
    write_replaced(spark, folder, "b", QUALITY_INPUT[:2])
    write_replaced(spark, folder, "a", QUALITY_INPUT[:3])
    store = ParquetStore(spark, folder)
    assert (store.read("bronze", "a").count(), store.read("bronze", "b").count()) == (3, 2)


def test_rerun_without_rows_removes_the_old_ones(spark, folder):
    write_replaced(spark, folder, "a", QUALITY_INPUT)
    write_replaced(spark, folder, "a", [])
    store = ParquetStore(spark, folder)
    assert store.read("bronze", "a").isEmpty() and store.read_all("bronze").isEmpty()


def test_append(spark, folder):
    write_replaced(spark, folder, "a", QUALITY_INPUT)
    write_replaced(spark, folder, "a", QUALITY_INPUT, mode="append")
    assert ParquetStore(spark, folder).read("bronze", "a").count() == 14
    with pytest.raises(ValueError):
        ParquetStore(spark, folder, "upsert")


def test_nothing_written_yet(spark, folder):
    store = ParquetStore(spark, folder)
    for table, (_, _, schema) in TABLES.items():
        assert store.read(table, "r").columns == schema.names
        assert store.read(table, "r").isEmpty() and store.read_all(table).isEmpty()
    with pytest.raises(ValueError):
        store.read("platinum", "r")


def test_layers(spark, folder):
    write_replaced(spark, folder, "a", QUALITY_INPUT)
    base = f"{folder}/bronze/wind_turbine_telemetry"
    log, commit = sorted(os.listdir(base))
    assert log == "_log" and os.listdir(f"{base}/_log") == os.listdir(f"{base}/{commit}") == ["event_id=a"]


def test_scan_of_a_run_is_pruned(spark, folder):
    write_replaced(spark, folder, "a", QUALITY_INPUT)
    write_replaced(spark, folder, "b", QUALITY_INPUT)
    df = ParquetStore(spark, folder).read("bronze", "a")
    assert all("event_id=a" in path for path in df.inputFiles())
    assert "PartitionFilters: [(event_id" in plan(df)
    assert "ReadSchema: struct<turbine_id:string>" in plan(df.select("turbine_id"))


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Asia/Kolkata"])
def test_period_reaches_the_scan(spark, with_conf, folder, zone):
    with_conf("spark.sql.session.timeZone", zone)
    times = ["1969-12-31 23:59:59", "2022-02-28 00:00:00", "2022-03-01 00:00:00", "2022-03-02 00:00:00", "2022-03-05 00:00:00"]
    store = ParquetStore(spark, folder)
    store.write("silver", readings(spark, [(t, 1, 1.0) for t in times]), RUN)
    assert store.read("silver", RUN).count() == 5
    with_conf("spark.sql.session.timeZone", "UTC")
    for start, end in [(1, 3), (0, 4), (2, 2), (0, 0)]:
        every = [r.telemetry_time for r in store.read("silver", RUN).sort("telemetry_time").collect()]
        df = store.read("silver", RUN, period=(every[start], every[end]))
        assert {r.telemetry_time for r in df.collect()} >= set(every[start : end + 1])
        assert "GreaterThanOrEqual(telemetry_day" in plan(df)
    assert store.read("silver", RUN, period=("2022-03-01", "2022-03-02")).count() < 5


def test_day_statistics_skip_row_groups(spark, folder):
    store = ParquetStore(spark, folder, mode="append")
    for day in ("2022-03-01", "2022-03-02", "2022-03-03"):
        store.write("silver", readings(spark, [(f"{day} 12:00:00", 1, 1.0)] * 10).coalesce(1), RUN)
    df = store.read("silver", RUN, period=("2022-03-02", "2022-03-02 23:00:00"))
    assert_rows(df.select("telemetry_time"), [(datetime.fromisoformat("2022-03-02 12:00:00"),)] * 10)
    df.collect()
    scan = df._jdf.queryExecution().executedPlan()
    while scan.children().size():
        scan = scan.children().apply(0)
    assert scan.metrics().apply("numOutputRows").value() == 10


def test_far_away_times(spark, folder):
    rows = [("0001-01-01 00:00:00", 1, 1.0), ("1582-10-10 00:00:00", 1, 1.0), ("9999-12-31 23:59:59", 1, 1.0)]
    store = ParquetStore(spark, folder)
    store.write("silver", readings(spark, rows), RUN)
    df = store.read("silver", RUN).selectExpr("cast(telemetry_time as string)")
    assert_rows(df, [(t,) for t, _, _ in rows])
    for time, _, _ in rows:
        assert in_period(store.read("silver", RUN, period=(time, time)), time, time).count() == 1


def test_analysis_reads_only_what_it_needs(spark, with_conf, folder):
    with_conf("spark.sql.maxMetadataStringLength", "1000")
    store = ParquetStore(spark, folder)
    store.write("silver", readings(spark, ANALYSIS_INPUT), RUN)
    df = store.read("silver", RUN, period=(START, END))
    for text in map(plan, (turbine_statistics(period_readings(df, RUN, START, END)), analyse(df, RUN, START, END)[1])):
        columns = "telemetry_time:timestamp,turbine_id:int,power_output:double,telemetry_day:int,telemetry_micros:bigint"
        assert text.count("ReadSchema") == text.count(f"ReadSchema: struct<{columns}>") == 1


def test_compacted_result_has_few_files(spark, folder):
    store = ParquetStore(spark, folder)
    wide = bronze(spark, QUALITY_INPUT * 50).repartition(32)
    store.write("quarantine", wide, RUN, compact=True)
    assert len(store.read("quarantine", RUN).inputFiles()) <= 8
    assert_same_rows(store.read("quarantine", RUN), wide)


# --- JDBC, without a database ---------------------------------------------------------------------


class Calls:
    """Stands in for a session's reader and a frame's writer, and keeps what they are asked for."""

    def __init__(self, frame=None):
        self.frame, self.seen, self.read, self.write = frame, [], self, self
        self.size = None

    def jdbc(self, url, table, **options):
        self.seen.append((url, table, options))
        return self.size if self.size and "pg_relation_size" in table else self.frame


CONNECTION = postgres_connection("db", 5432, "telemetry", "reader", "secret")


def test_connection():
    assert CONNECTION == {
        "url": "jdbc:postgresql://db:5432/telemetry",
        "user": "reader",
        "password": "secret",
        "driver": "org.postgresql.Driver",
    }
    with pytest.raises(ValueError):
        JdbcStore(None, {"user": "reader"})


def test_jdbc_reads(spark):
    frame = bronze(spark, QUALITY_INPUT).unionByName(bronze(spark, QUALITY_INPUT, "other"))
    calls = Calls(frame)
    store = JdbcStore(calls, CONNECTION, splits={"bronze": ["turbine_id < '5'", "turbine_id >= '5' or turbine_id is null"]})
    assert store.read("bronze", RUN).count() == 7
    assert store.read_all("bronze").count() == 14
    login = {k: v for k, v in CONNECTION.items() if k != "url"} | {"fetchsize": "10000"}
    url, table, options = calls.seen[0]
    assert (url, table) == (CONNECTION["url"], "bronze.wind_turbine_telemetry")
    assert options["properties"] == login and len(options["predicates"]) == 2
    store.read("silver", RUN, period=("2022-03-01", "2022-03-02"))
    assert calls.seen[-1][2] == {
        "predicates": None,
        "properties": login | {
            "partitionColumn": "telemetry_time", "lowerBound": "2022-03-01",
            "upperBound": "2022-03-02", "numPartitions": "8",
        },
    }
    # without a period, or with a reversed one, the table's size tells how to divide it
    calls.size = spark.createDataFrame([(1000,)], "blocks long")
    for period in (None, ("2022-03-02", "2022-03-01")):
        store.read("silver", RUN, period=period)
        assert calls.seen[-1][2] == {"predicates": block_splits(1000, 8), "properties": login}


def test_jdbc_splits_are_derived(spark):
    """PostgreSQL: a look at the size, then ranges of blocks. Other databases: hash of all columns."""
    calls = Calls(bronze(spark, QUALITY_INPUT))
    calls.size = spark.createDataFrame([(1000,)], "blocks long")
    assert JdbcStore(calls, CONNECTION, connections=4).read("bronze", RUN).count() == 7
    assert "pg_relation_size('bronze.wind_turbine_telemetry')" in calls.seen[0][1]
    assert calls.seen[-1][2]["predicates"] == block_splits(1000, 4)
    calls = Calls(bronze(spark, QUALITY_INPUT))
    JdbcStore(calls, CONNECTION | {"url": "jdbc:other://db"}, connections=5).read_all("bronze")
    (call,) = calls.seen
    assert len(call[2]["predicates"]) == 5 and '"timestamp"' in call[2]["predicates"][0]
    calls = Calls(bronze(spark, QUALITY_INPUT))
    JdbcStore(calls, CONNECTION, connections=1).read_all("bronze")
    assert [c[2]["predicates"] for c in calls.seen] == [None]


@pytest.mark.parametrize("blocks, parts", [(0, 4), (1, 4), (7, 3), (1000, 8), (5, 1)])
def test_block_splits_are_disjoint_and_complete(blocks, parts):
    splits = block_splits(blocks, parts)
    assert 1 <= len(splits) <= parts
    # any block of the table, and those that are added while it is read
    for block in range(blocks + 50):
        met = 0
        for split in splits:
            low = re.search(r">= '\((\d+),0\)'", split)
            high = re.search(r"< '\((\d+),0\)'", split)
            met += (not low or block >= int(low[1])) and (not high or block < int(high[1]))
        assert met == 1, (block, splits)


@pytest.mark.parametrize("parts", [1, 3, 8, 1000])
def test_hash_splits_are_disjoint_and_complete(parts):
    """In a database that runs in this process, over rows with NULLs, quotes and separators."""
    con = duckdb.connect()
    con.execute("create table t(id int, \"timestamp\" varchar, power double)")
    values = [None, "", "|", "a|b", "it's", "ü", "2022-03-01"]
    rows = [(i, values[i % 7], None if i % 3 == 0 else i / 7) for i in range(700)]
    con.executemany("insert into t values (?, ?, ?)", rows)
    splits = hash_splits([quoted("id"), quoted("timestamp"), quoted("power")], parts)
    counts = [con.execute(f"select count(*) from t where {split}").fetchone()[0] for split in splits]
    assert sum(counts) == 700
    assert con.execute("select count(*) from t where " + " or ".join(f"({s})" for s in splits)).fetchone()[0] == 700
    assert parts > 8 or min(counts) > 0.5 * 700 / parts


def test_jdbc_reads_many_runs(spark):
    frame = bronze(spark, QUALITY_INPUT, "a").unionByName(bronze(spark, QUALITY_INPUT, "b")).unionByName(bronze(spark, QUALITY_INPUT, None))
    store = JdbcStore(Calls(frame), CONNECTION, connections=1)
    assert [store.read_runs("bronze", runs).count() for runs in (["a"], ["a", "b"], ["a", None], [])] == [7, 14, 14, 0]
    assert store.runs("bronze") == ["a", "b"] and store.runs("turbine_daily_state") == []


def test_jdbc_write(spark, monkeypatch):
    calls = Calls()
    df = bronze(spark, QUALITY_INPUT)
    monkeypatch.setattr(type(df), "write", property(lambda self: calls))
    JdbcStore(spark, CONNECTION, connections=4).write("bronze", df, RUN)
    (url, table, options) = calls.seen[0]
    assert (url, table, options["mode"]) == (CONNECTION["url"], "bronze.wind_turbine_telemetry", "append")
    assert options["properties"]["numPartitions"] == "4" and options["properties"]["batchsize"] == "10000"


def test_failed_rerun_keeps_the_old_rows(spark, folder):
    from pyspark.sql import functions as F

    store = ParquetStore(spark, folder)
    rows = bronze(spark, [("2022-03-01 00:00:00", "1", "2.0", "1", "2.3")])
    store.write("bronze", rows, RUN)
    broken = rows.withColumn("power_output", F.raise_error(F.lit("no")).cast("string"))
    with pytest.raises(Exception):
        store.write("bronze", broken, RUN)
    assert store.read("bronze", RUN).count() == 1
    store.write("bronze", rows.limit(0), RUN)
    assert store.read("bronze", RUN).count() == 0


def test_write_runs_places_every_run(spark, folder):
    store = ParquetStore(spark, folder)
    row = [("2022-03-01 00:00:00", "1", "2.0", "1", "2.3")]
    store.write_runs("bronze", bronze(spark, row, "a").unionByName(bronze(spark, row * 2, "b")))
    store.write_runs("bronze", bronze(spark, row * 3, "b"))
    assert [store.read("bronze", run).count() for run in ("a", "b")] == [1, 3]


def test_daily_silver_is_pruned_by_folder(spark, folder):
    store = ParquetStore(spark, folder, daily=True)
    # not in time order: each task holds every day
    days = [f"2022-03-0{d}" for d in range(1, 6)]
    rows = [(f"{day} 12:00:00", turbine, 1.0) for turbine in range(4) for day in days]
    store.write("silver", readings(spark, rows).repartition(4), RUN)
    assert_same_rows(store.read("silver", RUN), readings(spark, rows))
    df = store.read("silver", RUN, period=("2022-03-02", "2022-03-02 23:00:00"))
    assert_rows(df.select("telemetry_time"), [(datetime.fromisoformat("2022-03-02 12:00:00"),)] * 4)
    filters = next(line for line in plan(df).splitlines() if "PartitionFilters" in line)
    assert "telemetry_day" in filters.split("PartitionFilters", 1)[1].split("PushedFilters")[0]
    # a reader without the option finds the same, and a rerun leaves no old day
    assert ParquetStore(spark, folder).read_all("silver").count() == 20
    store.write("silver", readings(spark, rows[:1]), RUN)
    assert store.read("silver", RUN).count() == 1
    store.write("silver", readings(spark, []), RUN)
    assert store.read("silver", RUN).count() == 0


@pytest.mark.parametrize("mode, left", [("replace", [2, 1, 1]), ("append", [2, 3, 1])])
def test_daily_silver_of_many_runs(spark, folder, mode, left):
    store = ParquetStore(spark, folder, mode, daily=True)
    rows = [("2022-03-01 12:00:00", 1, 1.0), ("2022-03-02 12:00:00", 1, 1.0)]
    store.write_runs("silver", readings(spark, rows, "a").unionByName(readings(spark, rows, "b/c")))
    store.write_runs("silver", readings(spark, rows[:1], "b/c").unionByName(readings(spark, rows[:1], None)))
    assert [store.read("silver", run).count() for run in ("a", "b/c", None)] == left
    assert store.read_all("silver").count() == sum(left)


def test_jdbc_write_takes_its_run(spark, monkeypatch):
    frames = []
    df = bronze(spark, QUALITY_INPUT).unionByName(bronze(spark, QUALITY_INPUT, "other"))
    monkeypatch.setattr(type(df), "write", property(lambda self: frames.append(self) or Calls()))
    JdbcStore(spark, CONNECTION).write("bronze", df, RUN)
    assert_same_rows(frames[0], conform(bronze(spark, QUALITY_INPUT), "bronze"))


# --- commits --------------------------------------------------------------------------------------


def test_stop_before_the_commit_keeps_the_old_rows(spark, folder, monkeypatch):
    """All data is written and the driver goes: readers see the old rows, and a sweep removes the new ones."""
    store = ParquetStore(spark, folder)
    row = ("2022-03-01 00:00:00", "1", "2.0", "1", "2.3")
    for run in ("a", "b"):
        store.write("bronze", bronze(spark, [row] * 2, run), run)
    with monkeypatch.context() as stopped:
        stopped.setattr(store, "_commit", lambda *_: (_ for _ in ()).throw(SystemExit()))
        for write in (
            lambda: store.write("bronze", bronze(spark, [row] * 5, "a"), "a"),
            lambda: store.write_runs("bronze", bronze(spark, [row] * 5, "b")),
            lambda: store.write_split(flag_quality(store.read("bronze", "a")), ["a"]),
        ):
            with pytest.raises(SystemExit):
                write()
    assert [store.read("bronze", run).count() for run in ("a", "b")] == [2, 2]
    assert store.read_all("bronze").count() == 4 and store.read_all("silver").count() == 0
    assert store.sweep() == []
    assert len(store.sweep(older_than_hours=-1)) >= 3
    assert len(glob.glob(f"{folder}/**/*.parquet", recursive=True)) == len(store.read_all("bronze").inputFiles())
    assert [store.read("bronze", run).count() for run in ("a", "b")] == [2, 2]


def test_stop_after_the_commit_shows_the_new_rows(spark, folder, monkeypatch):
    """The step is taken and the driver goes before the old rows are removed."""
    store = ParquetStore(spark, folder)
    row = ("2022-03-01 00:00:00", "1", "2.0", "1", "2.3")
    store.write("bronze", bronze(spark, [row] * 2, "a"), "a")
    with monkeypatch.context() as stopped:
        stopped.setattr(store, "_drop", lambda *_: (_ for _ in ()).throw(SystemExit()))
        with pytest.raises(SystemExit):
            store.write("bronze", bronze(spark, [row] * 5, "a"), "a")
    assert store.read("bronze", "a").count() == store.read_all("bronze").count() == 5
    assert len(store.sweep(older_than_hours=-1)) >= 1
    assert store.read("bronze", "a").count() == 5
    store.write("bronze", bronze(spark, [row], "a"), "a")
    assert store.read("bronze", "a").count() == 1
    assert len(glob.glob(f"{folder}/bronze/**/*.parquet", recursive=True)) == len(store.read("bronze", "a").inputFiles())


@pytest.mark.parametrize(
    "names, places, others",
    [
        ([], [], True),
        (["1.append.commit=a", "2.append.commit=b"], ["commit=a", "commit=b"], True),
        (["1.append.commit=a", "2.replace.commit=b", "3.append.split=c"], ["commit=b", "split=c"], False),
        # two writers that took the same number
        (["1.replace.commit=a", "2.append.commit=b", "2.append.commit=c"], ["commit=a", "commit=b", "commit=c"], False),
        (["1.replace.commit=a", "2.replace.commit=b", "2.replace.commit=c"], ["commit=c"], False),
    ],
)
def test_log(names, places, others):
    assert live(names[::-1]) == (places, others)


def test_rows_of_other_writers(spark, folder):
    """They count until the run is replaced, also beside rows that were added."""
    row = ("2022-03-01 00:00:00", "1", "2.0", "1", "2.3")
    base = ParquetStore(spark, folder).path("bronze")
    bronze(spark, [row] * 2).drop("event_id").write.parquet(f"{base}/event_id=a")
    write_replaced(spark, folder, "a", [row], mode="append")
    store = ParquetStore(spark, folder)
    assert store.read("bronze", "a").count() == store.read_all("bronze").count() == 3
    write_replaced(spark, folder, "a", [row])
    assert store.read("bronze", "a").count() == store.read_all("bronze").count() == 1


def test_runs(spark, folder):
    store = ParquetStore(spark, folder)
    for run in [*ODD_RUNS, None]:
        store.write("bronze", bronze(spark, QUALITY_INPUT[:1], run), run)
    assert store.runs("bronze") == sorted(ODD_RUNS) and store.runs("silver") == []
    assert store.read_runs("bronze", ODD_RUNS[:3]).count() == 3


# --- one pass for two tables ----------------------------------------------------------------------


def scans(df):
    return plan(df).count("FileScan")


@pytest.mark.parametrize("how", [{}, {"daily": True}, {"ordered": True}, {"daily": True, "ordered": True}, {"mode": "append"}])
def test_split_in_one_pass(spark, folder, how):
    store = ParquetStore(spark, folder, **how)
    runs = ["a", "b/c", "none"]
    rows = bronze(spark, QUALITY_INPUT, "a").unionByName(bronze(spark, QUALITY_INPUT[4:], "b/c"))
    store.write_runs("bronze", rows)
    quality = flag_quality(store.read_runs("bronze", runs))
    assert scans(split_rows(quality, "table")) == 1
    store.write_split(quality, runs)
    for run in runs:
        assert_same_rows(store.read("silver", run), to_silver(for_run(quality, run)))
        assert_same_rows(store.read("quarantine", run), to_quarantine(for_run(quality, run)))
    assert_same_rows(store.read_all("quarantine"), to_quarantine(quality))
    # beside rows that came another way
    store.write("quarantine", bronze(spark, QUALITY_INPUT[:1], "d"), "d")
    assert store.read_all("quarantine").count() == to_quarantine(quality).count() + 1
    if not how.get("mode"):
        store.write_split(flag_quality(bronze(spark, QUALITY_INPUT[:1], "a")), ["a"])
        assert (store.read("silver", "a").count(), store.read("quarantine", "a").count()) in ((1, 0), (0, 1))
        assert_same_rows(store.read("quarantine", "b/c"), to_quarantine(for_run(quality, "b/c")))


def test_split_reads_bronze_once(spark, folder, monkeypatch):
    """One job, whose only scan is that of bronze."""
    store = ParquetStore(spark, folder)
    store.write_runs("bronze", bronze(spark, QUALITY_INPUT, "a").unionByName(bronze(spark, QUALITY_INPUT, "b")))
    group = "split"
    spark.sparkContext.setJobGroup(group, group)
    run_stage_of_runs(spark, "transform", ["a", "b"], store)
    jobs = spark.sparkContext.statusTracker().getJobIdsForGroup(group)
    spark.sparkContext._jsc.clearJobGroup()
    assert len(jobs) == 1


def test_many_small_files_are_written_again(spark, folder, monkeypatch):
    monkeypatch.setattr(parquet_store, "MANY_FILES", 3)
    store = ParquetStore(spark, folder)
    quality = flag_quality(bronze(spark, QUALITY_INPUT * 8, "a").repartition(12))
    store.write_split(quality, ["a"])
    assert_same_rows(store.read("quarantine", "a"), to_quarantine(quality))
    assert len(store.read("quarantine", "a").inputFiles()) <= 8
    assert len(glob.glob(f"{folder}/split/commit=*/table=quarantine/**/*.parquet", recursive=True)) == 0


# --- time ----------------------------------------------------------------------------------------


def test_period_skips_pages_of_ordered_files(spark, with_conf, folder):
    """Input in no order: each file spans all days, and a period of an hour reads a small part of it."""
    with_conf("spark.sql.maxMetadataStringLength", "1000")
    rows = spark.range(0, 400_000, 1, 2).selectExpr(
        "timestamp_seconds(1646092800 + pmod(xxhash64(id), 864000)) as telemetry_time", "cast(id % 20 as int) as turbine_id",
        "1.0D as wind_speed", "1 as wind_direction", "cast(id as double) as power_output", f"'{RUN}' as event_id",
    )
    read = {}
    for ordered in (False, True):
        store = ParquetStore(spark, f"{folder}/{ordered}", ordered=ordered)
        store.write("silver", rows, RUN)
        df = store.read("silver", RUN, period=("2022-03-04 10:00:00", "2022-03-04 11:00:00")).select("power_output")
        assert "GreaterThanOrEqual(telemetry_micros" in plan(df)
        want = rows.filter("telemetry_time between '2022-03-04 10:00:00' and '2022-03-04 11:00:00'").count()
        assert df.count() == want
        df.collect()
        scan = df._jdf.queryExecution().executedPlan()
        while scan.children().size():
            scan = scan.children().apply(0)
        read[ordered] = scan.metrics().apply("numOutputRows").value()
    # a page of 20,000 rows of each file
    assert read[True] <= 0.1 * read[False]


# --- required columns -----------------------------------------------------------------------------

REQUIRED = {table: [f.name for f in schema.fields if not f.nullable] for table, (_, _, schema) in TABLES.items()}


@pytest.mark.parametrize("table", TABLES)
def test_required_columns(spark, folder, table):
    schema = TABLES[table][2]
    text = {"string": "'r'", "timestamp": "timestamp '2022-03-01 12:00:00'"}
    values = [f"cast({text.get(f.dataType.simpleString(), '1')} as {f.dataType.simpleString()}) as {f.name}" for f in schema]
    good = spark.range(3).selectExpr(*values)
    for name in REQUIRED[table]:
        bad = good.withColumn(name, F.when(F.rand(1) < 2, F.lit(None)).otherwise(F.col(name)).cast(schema[name].dataType))
        run = None if name == "event_id" else "r"
        ParquetStore(spark, f"{folder}/ignore").write(table, bad, run)
        counting = ParquetStore(spark, f"{folder}/count", required="count")
        counting.write(table, bad, run)
        assert counting.violations == {table: {n: 3 * (n == name) for n in REQUIRED[table]}}
        failing = ParquetStore(spark, f"{folder}/fail", required="fail")
        failing.write(table, good, "r")
        with pytest.raises(Exception, match=f"{table}.{name} is required"):
            failing.write(table, bad, run)
        assert failing.read(table, "r").count() == 3
    with pytest.raises(ValueError):
        ParquetStore(spark, folder, required="maybe")


def test_required_columns_of_a_split(spark, folder):
    quality = flag_quality(bronze(spark, QUALITY_INPUT))
    store = ParquetStore(spark, folder, required="fail")
    store.write_split(quality, [RUN])
    assert store.read("quarantine", RUN).count() == 3
    store = ParquetStore(spark, folder, required="count")
    store.write_split(quality, [RUN])
    assert set(store.violations["silver"].values()) == {0}
