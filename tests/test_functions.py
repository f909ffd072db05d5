from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from eventide.functions import hashing, times


def value(spark, column):
    return spark.range(1).select(column.alias("v")).first().v


@pytest.mark.parametrize("at, floor", [(0, 0), (4_999, 0), (5_000, 5_000), (-1, -5_000), (-5_000, -5_000)])
def test_floor_to_also_before_1970(spark, at, floor):
    assert value(spark, times.floor_to(F.lit(at), timedelta(seconds=5))) == floor


def test_bounds_as_text(spark):
    assert value(spark, times.timestamp_text(F.lit(1511661600000))) == "2017-11-26 02:00:00.0"


def test_midnight_is_utc_in_any_zone(spark):
    at = F.timestamp_seconds(F.lit(1511661600))
    spark.conf.set("spark.sql.session.timeZone", "Asia/Shanghai")
    try:
        assert value(spark, F.unix_seconds(times.next_utc_midnight(at))) == 1511740800
        assert value(spark, times.utc_day(at)) == 17496
        assert value(spark, times.utc_day(F.timestamp_seconds(F.lit(-1)))) == -1
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


@pytest.mark.parametrize(
    "token, expected",
    [
        ("17/05/2015:10:05:03", datetime(2015, 5, 17, 10, 5, 3)),
        ("7/5/2015:1:5:3", datetime(2015, 5, 7, 1, 5, 3)),
        ("32/01/2015:00:00:00", datetime(2015, 2, 1)),
        ("01/13/2015:25:61:61", datetime(2016, 1, 2, 2, 2, 1)),
        ("31/02/2016:00:00:00", datetime(2016, 3, 2)),
        ("yesterday", None),
        ("17/05/2015", None),
        ("", None),
    ],
)
def test_access_log_time(spark, token, expected):
    assert value(spark, times.access_log_time(F.lit(token))) == expected


def plain_hash(text, seed, capacity):
    total = 0
    for char in text:
        total = total * seed + ord(char)
    return total & (capacity - 1)


IDS = [0, 7, 12, 999, 937166, 2**31, 2**63 - 1, -1, -(2**63)]


@pytest.mark.parametrize("seed, capacity", [(61, 1 << 27), (61, 1 << 28), (31, 64)])
def test_offsets_match_plain_computation(spark, seed, capacity):
    rows = (
        spark.createDataFrame([(i,) for i in IDS], "id long")
        .select(
            "id",
            hashing.long_offset(F.col("id"), seed, capacity).alias("a"),
            hashing.string_offset(F.col("id").cast("string"), seed, capacity).alias("b"),
        )
        .collect()
    )
    for row in rows:
        assert row.a == row.b == plain_hash(str(row.id), seed, capacity)


def test_offset_of_long_text(spark):
    text = "user-" * 500
    got = value(spark, hashing.string_offset(F.lit(text)))
    assert got == plain_hash(text, 61, 1 << 27)


def test_capacity_is_a_power_of_two():
    with pytest.raises(ValueError):
        hashing.long_offset(F.lit(1), capacity=100)
