"""Distinct users per window over a stream."""

from __future__ import annotations

from datetime import timedelta

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventide.functions.hashing import long_offset
from eventide.functions.times import interval_text
from eventide.operators.distinct import BITMAP_CAPACITY
from eventide.operators.windows import tumbling_end
from eventide.streaming.windows import NO_DELAY, with_watermark


def distinct_stream(
    watermarked: DataFrame, what: Column, size: timedelta, ts: str = "ts"
) -> DataFrame:
    """Different values per closed window (append mode), of rows that have a watermark.

    Counts per window and value first, which merges repeats before the
    exchange, then values per window.
    """
    value = what.alias("value")
    length = interval_text(size)
    per_value = (
        watermarked.groupBy(F.window(ts, length).alias("w"), value)
        .agg(F.count("*").alias("n"))
    )
    per_window = per_value.groupBy(F.window("w", length).alias("w")).agg(
        F.count("*").alias("uv_count")
    )
    return per_window.select(F.unix_millis("w.end").alias("window_end"), "uv_count")


def unique_visitors_stream(watermarked: DataFrame, size: timedelta, user: str = "user_id") -> DataFrame:
    return distinct_stream(watermarked, F.col(user), size)


def unique_visitors_bitmap_stream(
    watermarked: DataFrame, size: timedelta, user: str = "user_id", capacity: int = BITMAP_CAPACITY
) -> DataFrame:
    return distinct_stream(watermarked, long_offset(F.col(user), capacity=capacity), size)


def unique_visitors_sketch_stream(
    df: DataFrame,
    size: timedelta,
    user: str = "user_id",
    rsd: float = 0.02,
    delay: timedelta = NO_DELAY,
    ts: str = "ts",
) -> DataFrame:
    """Estimate with a state of bounded size per window, for any output mode."""
    window = F.window(ts, interval_text(size)).alias("w")
    counts = with_watermark(df, delay, ts).groupBy(window).agg(
        F.approx_count_distinct(user, rsd).alias("uv_count")
    )
    return counts.select(F.unix_millis("w.end").alias("window_end"), "uv_count")


def running_distinct_stream(
    df: DataFrame, what: Column, size: timedelta, delay: timedelta = NO_DELAY, ts: str = "ts"
) -> DataFrame:
    """Different values per window so far (update mode), for a table kept by window.

    Each value is let through once per window and counted, with one row of state. A
    value holding much of a batch is first reduced to one row of each Arrow batch.
    """
    rows = df.select(F.timestamp_millis(tumbling_end(F.col(ts), size)).alias("end"), what.alias("value"))

    def once_each(batches):
        for batch in batches:
            yield from pa.Table.from_batches([batch]).group_by(["end", "value"]).aggregate([]).to_batches()

    # The end runs ahead of the row times by up to one window.
    rows = rows.mapInArrow(once_each, rows.schema).withWatermark("end", interval_text(size + delay))
    once = rows.dropDuplicates(["end", "value"])
    counts = once.groupBy("end").agg(F.count("*").alias("uv_count"))
    return counts.select(F.unix_millis("end").alias("window_end"), "uv_count")
