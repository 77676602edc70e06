from datetime import datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DoubleType, IntegerType, StringType, TimestampType

from helpers import BAD_ROWS, QUALITY_INPUT, RUN, assert_rows, assert_same_rows, bronze, plan
from vanewatch import flag_quality, for_run, to_quarantine, to_silver, with_quality
from vanewatch.operators.quality import RULES


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_conversion_and_flag(spark, with_conf, ansi):
    with_conf("spark.sql.ansi.enabled", ansi)
    expected = []
    for i, raw in enumerate(QUALITY_INPUT):
        time = datetime.fromisoformat(raw[0]) if raw[0] and raw[0] != "aaaaaa" else None
        expected.append((*raw, time, 1, 2.0, int(float(raw[3])), 2.3, RUN, i in BAD_ROWS))
    assert_rows(with_quality(bronze(spark, QUALITY_INPUT), RUN), expected)


@pytest.mark.parametrize("default", ["TIMESTAMP_LTZ", "TIMESTAMP_NTZ"])
def test_quality_layout(spark, with_conf, default):
    with_conf("spark.sql.timestampType", default)
    schema = with_quality(bronze(spark, QUALITY_INPUT), RUN).schema
    assert [(f.name, type(f.dataType)) for f in schema] == [
        ("timestamp", StringType),
        ("turbine_id", StringType),
        ("wind_speed", StringType),
        ("wind_direction", StringType),
        ("power_output", StringType),
        ("converted_timestamp", TimestampType),
        ("converted_turbine_id", IntegerType),
        ("converted_wind_speed", DoubleType),
        ("converted_wind_direction", IntegerType),
        ("converted_power_output", DoubleType),
        ("event_id", StringType),
        ("is_error", BooleanType),
    ]
    assert not schema["is_error"].nullable


def test_split(spark):
    quality = with_quality(bronze(spark, QUALITY_INPUT), RUN)
    assert_rows(to_quarantine(quality), [(*QUALITY_INPUT[i], RUN) for i in BAD_ROWS])
    valid = [r for i, r in enumerate(QUALITY_INPUT) if i not in BAD_ROWS]
    assert_rows(to_silver(quality), [(datetime.fromisoformat(r[0]), 1, 2.0, int(r[3]), 2.3, RUN) for r in valid])
    assert to_silver(quality).columns == [
        "telemetry_time", "turbine_id", "wind_speed", "wind_direction", "power_output", "event_id",
    ]


@pytest.mark.parametrize(
    "field, text, bad",
    [
        ("wind_direction", "-1", True),
        ("wind_direction", "0", False),
        ("wind_direction", "359", False),
        ("wind_direction", "359.9", False),
        ("wind_direction", "360", True),
        ("wind_direction", "north", True),
        ("wind_direction", None, True),
        ("timestamp", "INVALID", True),
        ("timestamp", None, True),
        ("turbine_id", "T1", True),
        ("turbine_id", None, True),
        ("turbine_id", "1.0", False),
        ("wind_speed", "", True),
        ("wind_speed", "-3", False),
        ("power_output", "n/a", True),
        ("power_output", None, True),
        ("power_output", "NaN", False),
        ("power_output", "Infinity", False),
        ("power_output", "1e400", False),
    ],
)
def test_each_rule(spark, field, text, bad):
    good = {
        "timestamp": "2022-03-01 00:00:00", "turbine_id": "1", "wind_speed": "2.0",
        "wind_direction": "10", "power_output": "2.3",
    }
    quality = with_quality(bronze(spark, [tuple({**good, field: text}.values())]), RUN)
    row = quality.selectExpr("is_error", *[f"{failed} as {rule}" for rule, failed in RULES.items()]).first()
    assert row.is_error is bad
    assert sum(row[rule] for rule in RULES) == int(bad)


def test_only_the_asked_run(spark):
    df = bronze(spark, QUALITY_INPUT).unionByName(bronze(spark, QUALITY_INPUT[:2], run="other"))
    df = df.unionByName(bronze(spark, QUALITY_INPUT[:3], run=None))
    assert with_quality(df, RUN).count() == 7
    assert for_run(df, "other").count() == 2
    assert for_run(df, None).count() == 3
    assert for_run(df, "absent").isEmpty()


def test_parts_make_up_the_whole(spark):
    df = bronze(spark, QUALITY_INPUT * 3)
    quality = flag_quality(df)
    kept = quality.filter(~F.col("is_error")).select(*df.columns)
    assert_same_rows(df, kept.unionByName(to_quarantine(quality)))


def test_no_conversion_is_done_twice(spark, folder):
    bronze(spark, QUALITY_INPUT).write.parquet(folder + "/b")
    text = plan(to_silver(with_quality(spark.read.parquet(folder + "/b"), RUN)))
    assert text.count("try_cast(power_output") == 1
    assert "Python" not in text and "Exchange" not in text


def test_accepts_a_stream(spark, folder):
    bronze(spark, QUALITY_INPUT).write.parquet(folder + "/b")
    stream = spark.readStream.schema(bronze(spark, []).schema).parquet(folder + "/b")
    query = (
        to_silver(with_quality(stream, RUN)).writeStream.format("memory").queryName("silver_stream")
        .trigger(availableNow=True).start()
    )
    query.awaitTermination(60)
    assert spark.table("silver_stream").count() == 4
