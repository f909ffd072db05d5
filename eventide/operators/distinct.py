"""Distinct users per window, exactly or by bitmap offset."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventide.functions.hashing import long_offset
from eventide.functions.times import floor_to, millis
from eventide.operators.windows import tumbling_end, window_ends

BITMAP_CAPACITY = 1 << 28


def distinct_per_window(
    df: DataFrame, what: Column, size: timedelta, ts: str = "ts", out: str = "uv_count"
) -> DataFrame:
    """Number of different values per tumbling window.

    Spark removes duplicates before and after an exchange on (window, value)
    and counts what is left, so neither a busy window nor a busy value meets in
    one task.
    """
    end = tumbling_end(F.col(ts), size).alias("window_end")
    return df.groupBy(end).agg(F.count_distinct(what).alias(out))


def unique_visitors(df: DataFrame, size: timedelta, user: str = "user_id") -> DataFrame:
    """Different users per window."""
    return distinct_per_window(df, F.col(user), size)


def unique_visitors_bitmap(
    df: DataFrame, size: timedelta, user: str = "user_id", capacity: int = BITMAP_CAPACITY
) -> DataFrame:
    """Bits a bitmap of ``capacity`` bits would have set per window.

    Users sharing an offset count once, as in a bitmap with one hash function;
    the bitmap itself is never built.
    """
    return distinct_per_window(df, long_offset(F.col(user), capacity=capacity), size)


def unique_visitors_sketch(
    df: DataFrame, size: timedelta, user: str = "user_id", rsd: float = 0.02, ts: str = "ts"
) -> DataFrame:
    """Bounded-memory estimate; its error differs from the bitmap's."""
    end = tumbling_end(F.col(ts), size).alias("window_end")
    return df.groupBy(end).agg(F.approx_count_distinct(user, rsd).alias("uv_count"))


def bitmaps(
    df: DataFrame, size: timedelta, user: str = "user_id", capacity: int = BITMAP_CAPACITY, ts: str = "ts"
) -> DataFrame:
    """The bitmap itself, as data: ``window_end, bucket, bits``.

    A window's bitmap is cut into buckets of 4 KB, and buckets without a set bit have
    no row. Bits are set before the exchange, which is by window and bucket: a busy
    window is spread, and a bucket has one row for each task at most. A window has at
    most ``capacity / 32,768`` buckets, whatever its users.
    """
    at = long_offset(F.col(user), capacity=capacity) + 1  # places count from 1
    end = tumbling_end(F.col(ts), size).alias("window_end")
    placed = df.where(F.col(user).isNotNull()).select(
        end, F.bitmap_bucket_number(at).alias("bucket"), F.bitmap_bit_position(at).alias("bit")
    )
    return placed.groupBy("window_end", "bucket").agg(F.bitmap_construct_agg("bit").alias("bits"))


def united(*parts: DataFrame) -> DataFrame:
    """Bitmaps of the same windows from several inputs (days, sources, batches) as one."""
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    return whole.groupBy("window_end", "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))


def roll_up(by_window: DataFrame, size: timedelta) -> DataFrame:
    """Bitmaps of longer windows, a multiple of the given ones; events are not read again."""
    # The end of a window belongs to it.
    end = floor_to(F.col("window_end") - 1, size) + millis(size)
    return united(by_window.select(end.alias("window_end"), "bucket", "bits"))


def bitmap_counts(by_window: DataFrame, out: str = "uv_count") -> DataFrame:
    """Set bits per window."""
    return by_window.groupBy("window_end").agg(F.sum(F.bitmap_count("bits")).alias(out))


#: log2 of the registers of a sketch: a standard error of about 1.04 / sqrt(2 ** 14), below 1 %.
SKETCH_BITS = 14
#: An estimate is within this share of the true number (or within one), at four standard errors.
SKETCH_ERROR = 0.04


def pane_sketches(
    df: DataFrame, user: str, slide: timedelta, ts: str = "ts", bits: int = SKETCH_BITS
) -> DataFrame:
    """A mergeable sketch of the different users of each pane: ``pane_end, sketch``, some KB a row."""
    end = tumbling_end(F.col(ts), slide).alias("pane_end")
    return df.where(F.col(user).isNotNull()).groupBy(end).agg(F.hll_sketch_agg(user, F.lit(bits)).alias("sketch"))


def sliding_estimate(
    df: DataFrame,
    user: str,
    size: timedelta,
    slide: timedelta,
    ts: str = "ts",
    bits: int = SKETCH_BITS,
    out: str = "uv_count",
) -> DataFrame:
    """Estimated number of different users per sliding window: ``window_end, uv_count``.

    Users go into the sketch of one pane each, before the exchange. A pane's sketch, and no
    row, is then sent to the windows it belongs to and united there: the work after the
    panes depends on time and not on the number of users.
    """
    panes = pane_sketches(df, user, slide, ts, bits)
    ends = window_ends(F.timestamp_millis(F.col("pane_end") - 1), size, slide)
    placed = panes.select(F.explode(ends).alias("window_end"), "sketch")
    merged = placed.groupBy("window_end").agg(F.hll_union_agg("sketch").alias("sketch"))
    return merged.select("window_end", F.hll_sketch_estimate("sketch").alias(out))
