"""Conversions against Spark's own casts with ANSI off, which is the behaviour to keep."""

import random

import pytest
from pyspark.sql import functions as F

from vanewatch.functions.convert import lenient_double, lenient_int, lenient_timestamp

INTS = {
    "1": 1, " 1 ": 1, "1\t": 1, "+5": 5, "007": 7, "-3": -3, "\x001\x7f": 1,
    "1.0": 1, "500.0": 500, "1.9": 1, "-1.9": -1, "-0.5": 0, ".5": 0, ".": 0, " 7.25 ": 7, "+.5": 0,
    "": None, "  ": None, "-": None, "+": None, "abc": None, "1,5": None, "1.2.3": None, "1.a": None,
    "..5": None, "1e2": None, "2147483647": 2147483647, "2147483648": None, "-2147483648": -2147483648,
    "2147483648.5": None, "1_000": None, "0x10": None, "1_0.5": None, "NaN": None, "Infinity": None,
    "1 2": None, "- 1": None, "1d": None, "1.5f": None, "T5": None, "359.9": 359, None: None,
    "00000000000000000001": 1, "1.00000000000000000000000": 1, "١": None, "1 ": None,
}
DOUBLES = [
    "1", " 1.5 ", "+5", "-0.5", ".5", ".", "", "  ", "-", "abc", "1,5", "1.2.3", "1e2", "1E-2", "1e400",
    "NaN", "nan", "Infinity", "-Infinity", "inf", "-inf", "1d", "1.5f", "1.0D", "1_000", "0x10", None,
]
TIMES = [
    "2022", "2022-03", "2022-3-1", "2022-03-01 05", "2022-3-1 5:0:0", "2022-03-01T05:06:07",
    "2022-03-01 05:06:07.123456789", "2022-03-01 05:06:07+02:00", "2022-03-01 05:06:07Z",
    " 2022-03-01 00:00:00 ", "INVALID", "01/03/2022 05:00", "2022-02-30", "2022-03-01 24:00:00",
    "1646092800", "", "aaaaaa", "0001-01-01 00:00:00", "9999-12-31 23:59:59", None,
]


def texts(spark, values):
    return spark.createDataFrame([(v,) for v in values], "text string").repartition(4)


@pytest.fixture(params=["true", "false"])
def ansi(request, with_conf):
    with_conf("spark.sql.ansi.enabled", request.param)


def legacy(spark, with_conf, df, column):
    """Rows of a cast evaluated with ANSI off."""
    with_conf("spark.sql.ansi.enabled", "false")
    return {r.text: r.value for r in df.select("text", column.alias("value")).collect()}


def values(df, column):
    return {r.text: r.value for r in df.select("text", column.alias("value")).collect()}


def test_int_matrix(spark, ansi):
    assert values(texts(spark, INTS), lenient_int(F.col("text"))) == INTS


def test_int_equals_legacy_cast_on_random_text(spark, with_conf):
    rng = random.Random(5)
    alphabet = "0123456789" * 2 + "+-.. \t\x00\x7fe,x_ "
    sample = list({"".join(rng.choices(alphabet, k=rng.randint(0, 8))) for _ in range(20_000)} | set(INTS))
    df = texts(spark, sample)
    got = values(df, lenient_int(F.col("text")))
    assert got == legacy(spark, with_conf, df, F.col("text").cast("int"))


@pytest.mark.parametrize("text", ["9" * 200_000 + "x", "1." + "0" * 200_000 + "x", " " * 200_000 + "x"])
def test_int_is_linear_on_long_text(spark, text):
    assert values(texts(spark, [text]), lenient_int(F.col("text"))) == {text: None}


def test_double_equals_legacy_cast(spark, ansi, with_conf):
    df = texts(spark, DOUBLES)
    got = values(df, lenient_double(F.col("text")))
    want = legacy(spark, with_conf, df, F.col("text").cast("double"))
    assert {k: str(v) for k, v in got.items()} == {k: str(v) for k, v in want.items()}


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Asia/Kolkata"])
def test_timestamp_equals_legacy_cast(spark, ansi, with_conf, zone):
    with_conf("spark.sql.session.timeZone", zone)
    df = texts(spark, TIMES)
    got = values(df, lenient_timestamp(F.col("text")).cast("string"))
    assert got == legacy(spark, with_conf, df, F.to_timestamp("text").cast("string"))
    assert got["INVALID"] is None and got["2022-03-01T05:06:07"] == "2022-03-01 05:06:07"


def test_line_separators_after_a_number_are_not_padding(spark):
    texts = [f"{number}{end}" for number in ("1", "1.5") for end in ("\u0085", "\u2028", "\u2029")]
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    assert [r[0] for r in df.select(lenient_int(df.text)).collect()] == [None] * len(texts)
