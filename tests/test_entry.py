"""Every driver query against its SQL in DuckDB, and the known counts of the derived readings."""

import glob
import os

import duckdb
import pytest

import __spark_entry__ as entry
from helpers import plan
from vanewatch import analyse, to_quarantine, to_silver, with_quality

SF = "/root/testdata/sf0.01"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    for file in glob.glob(f"{SF}/*.parquet"):
        con.execute(f"create view {os.path.basename(file)[:-8]} as from '{file}'")
    return con


def ordered(rows):
    return sorted((tuple(r) for r in rows), key=lambda r: tuple((v is not None, str(v)) for v in r))


@pytest.mark.parametrize("name", entry.telemetry_queries())
def test_query_equals_sql(spark, db, name):
    df = entry.telemetry_queries()[name](spark, SF)
    sql = entry.oracle_sql()[name]
    assert sorted(df.columns) == sorted(c[0] for c in db.execute(sql).description)
    names = ", ".join(f'"{c}"' for c in df.columns)
    got, want = ordered(df.collect()), ordered(db.execute(f"select {names} from ({sql})").fetchall())
    assert got and got == want


def test_smoke(spark):
    df = entry.entry(spark)
    assert df.columns == ["telemetry_time", "turbine_id", "power_output", "event_id"]
    assert df.count() > 0


def test_no_query_runs_python(spark):
    for name, query in entry.telemetry_queries().items():
        assert "Python" not in plan(query(spark, "/root/testdata/sf0.001")), name


KNOWN = {"0.001": (27, 183, 15, 2), "0.01": (228, 1778, 20, 43), "0.1": (2465, 17398, 20, 417)}


@pytest.mark.parametrize("sf", KNOWN)
def test_known_counts_of_one_event_type(spark, sf):
    quality = with_quality(entry.bronze(spark, f"/root/testdata/sf{sf}"), "click")
    summary, anomalies = analyse(to_silver(quality), "click", entry.START, entry.END)
    parts = (to_quarantine(quality), to_silver(quality), summary, anomalies)
    assert tuple(df.count() for df in parts) == KNOWN[sf]
