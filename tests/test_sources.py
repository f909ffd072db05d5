from datetime import datetime
from pathlib import Path

import pytest
from pyspark.errors import PySparkException

from eventide.sources import connectors, schemas, text


def lines(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "value string")


def test_fields_are_trimmed_and_cast(spark):
    rows = text.parse_delimited(
        lines(spark, "543462, 1715\t,1464116 , pv,1511658000", "1,2,3,buy,5,ignored"),
        schemas.USER_BEHAVIOR,
    ).collect()
    assert [tuple(r) for r in rows] == [(543462, 1715, 1464116, "pv", 1511658000), (1, 2, 3, "buy", 5)]


def test_event_time(spark):
    rows = text.parse_delimited(lines(spark, "1,create,,1511658000"), schemas.ORDER_EVENT)
    assert text.with_event_time(rows).first().ts == datetime(2017, 11, 26, 1, 0)
    in_ms = text.parse_delimited(lines(spark, "u,CLICK,store,1511658000500"), schemas.MARKETING_EVENT)
    assert text.with_event_time(in_ms, "milliseconds").first().ts == datetime(2017, 11, 26, 1, 0, 0, 500000)


BAD = ["1,2,3,pv", "x,2,3,pv,5", "1,2.0,3,pv,5", "1,2,99999999999,pv,5", "", "1,2,3,pv,"]


@pytest.mark.parametrize("bad", BAD)
@pytest.mark.parametrize("ansi", ["true", "false"])
def test_strict_fails_on_a_malformed_line(spark, bad, ansi):
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        with pytest.raises(PySparkException, match="malformed line"):
            text.parse_delimited(lines(spark, bad), schemas.USER_BEHAVIOR).collect()
    finally:
        spark.conf.set("spark.sql.ansi.enabled", "true")


def test_strict_fails_even_if_the_bad_column_is_not_read(spark):
    rows = text.parse_delimited(lines(spark, "1,2,3,pv,none"), schemas.USER_BEHAVIOR)
    with pytest.raises(PySparkException, match="malformed line"):
        rows.select("user_id").collect()


def test_quarantine_keeps_malformed_lines_apart(spark):
    parsed = text.parse_delimited(
        lines(spark, "1,2,3,pv,5", *BAD), schemas.USER_BEHAVIOR, mode=text.QUARANTINE
    )
    assert [tuple(r) for r in text.good_rows(parsed).collect()] == [(1, 2, 3, "pv", 5)]
    assert sorted(r.value for r in text.bad_lines(parsed).collect()) == sorted(BAD)


def test_access_log(spark):
    line = "83.149.9.216 - - 17/05/2015:10:05:03 +0000 GET /presentations/logo.png"
    row = text.parse_access_log(lines(spark, line)).first()
    assert tuple(row) == (
        "83.149.9.216",
        "-",
        datetime(2015, 5, 17, 10, 5, 3),
        "GET",
        "/presentations/logo.png",
    )
    with pytest.raises(PySparkException, match="malformed line"):
        text.parse_access_log(lines(spark, "83.149.9.216 - - now +0000 GET /")).collect()
    parsed = text.parse_access_log(lines(spark, line, "short"), mode=text.QUARANTINE)
    assert [r.value for r in text.bad_lines(parsed).collect()] == ["short"]


def test_topic_options():
    assert connectors.topic_options("broker:9092", "behavior") == {
        "kafka.bootstrap.servers": "broker:9092",
        "subscribe": "behavior",
        "startingOffsets": "latest",
    }


def test_message_values_are_bytes_or_text(spark):
    messages = spark.createDataFrame([(bytearray(b"1,2,3,pv,5"),)], "value binary")
    parsed = text.parse_delimited(connectors.message_lines(messages), schemas.USER_BEHAVIOR)
    assert tuple(parsed.first()) == (1, 2, 3, "pv", 5)


def test_published_lines_arrive_as_a_stream(spark, folder, tmp_path):
    Path(tmp_path / "in.csv").write_text("1,2,3,pv,5\n4,5,6,buy,7\n")
    connectors.publish_lines(text.read_lines(spark, str(tmp_path)), fmt="text", path=f"{folder}/topic")
    stream = text.parse_delimited(
        text.read_lines(spark, f"{folder}/topic", stream=True, files_per_trigger=1), schemas.USER_BEHAVIOR
    )
    query = stream.writeStream.format("memory").queryName("published").trigger(availableNow=True).start()
    query.awaitTermination()
    assert sorted(r.item_id for r in spark.table("published").collect()) == [2, 5]
