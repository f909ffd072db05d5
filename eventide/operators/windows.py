"""Tumbling and sliding counts over event time.

Windows are ``[start, end)``, aligned to the epoch, and named by their end in
epoch milliseconds (``window_end``).
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventide.functions.times import floor_to, millis

# Windows of one time slice are summed together; a slice spans this many window
# lengths. Longer slices copy fewer panes into the next slice.
SLICE_WINDOWS = 4


def tumbling_end(ts: Column, size: timedelta) -> Column:
    """End of the tumbling window a time falls in."""
    return floor_to(F.unix_millis(ts), size) + millis(size)


def tumbling_count(
    df: DataFrame, keys: Sequence[str], size: timedelta, ts: str = "ts"
) -> DataFrame:
    """Rows per key and tumbling window."""
    end = tumbling_end(F.col(ts), size).alias("window_end")
    return df.groupBy(*keys, end).agg(F.count("*").alias("count"))


def pane_count(
    df: DataFrame, keys: Sequence[str], slide: timedelta, ts: str = "ts"
) -> DataFrame:
    """Rows per key and slide-long pane, named by the pane's end.

    Counts are combined before the exchange, and the pane is part of the
    exchange key: a key holding most rows is spread over its panes.
    """
    end = tumbling_end(F.col(ts), slide).alias("pane_end")
    return df.groupBy(*keys, end).agg(F.count("*").alias("count"))


def slide_panes(
    panes: DataFrame,
    keys: Sequence[str],
    size: timedelta,
    slide: timedelta,
    sums: Sequence[str] = ("count",),
    low: int | None = None,
    high: int | None = None,
    slice_size: timedelta | None = None,
    only: DataFrame | None = None,
) -> DataFrame:
    """Turn pane counts into counts of all non-empty sliding windows.

    A pane ending at ``p`` belongs to the windows ending at ``p``, ``p+slide``,
    ..., ``p+size-slide``. Instead of emitting it once per window (up to 720
    rows here), it adds its count at the first end and takes it off after the
    last; a running sum gives all windows in one pass.

    The running sum is per key and time slice, never per key: a pane is copied
    into the next slice if its windows reach that far. A group thus has at most
    ``(SLICE_WINDOWS + 1) * size / slide`` panes, however hot its key is.

    ``sums`` names the columns to sum; the first one is positive in every pane.
    With ``low`` or ``high`` only windows ending in (low, high] are made at all, and with
    ``only`` those of the keys and slices it lists (``keys, slice``, as ``slices_of`` names
    slices of ``slice_size``).
    """
    size_ms, slide_ms = _check(size, slide)
    slice_size = slice_size or SLICE_WINDOWS * size
    slice_ms = millis(slice_size)

    first, last = F.col("pane_end"), F.col("pane_end") + (size_ms - slide_ms)
    placed = panes.select(
        *keys, "pane_end", *sums, F.explode(slices_of(size, slide, slice_size)).alias("slice")
    )
    if only is not None:
        listed = only.select(*[F.col(k).alias(f"_{k}") for k in keys], F.col("slice").alias("_slice"))
        same = placed["slice"] == listed["_slice"]
        for k in keys:  # rows without a key are one key
            same &= placed[k].eqNullSafe(listed[f"_{k}"])
        placed = placed.join(listed, same, "left_semi")
    # A stated number of partitions, so that they are not merged by their small
    # input size: each pane may turn into size / slide rows below.
    partitions = int(panes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = placed.repartition(partitions, *keys, "slice")

    slice_start = F.col("slice")
    slice_end = slice_start + slice_ms
    enters = F.struct(F.greatest(first, slice_start).alias("at"), *sums)
    leaves = F.struct((last + slide_ms).alias("at"), *[(-F.col(s)).alias(s) for s in sums])
    changes = (
        placed.select(
            *keys, "slice", slice_end.alias("slice_end"), F.explode(F.array(enters, leaves)).alias("c")
        )
        .select(*keys, "slice", "slice_end", "c.*")
        .where(F.col("at") < F.col("slice_end"))
    )

    # The slice comes first since it tells most rows apart while sorting.
    in_time = Window.partitionBy("slice", *keys).orderBy("at")
    so_far = in_time.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    running = [F.sum(s).over(so_far).alias(s) for s in sums]
    until = F.coalesce(F.lead("at").over(in_time), F.col("slice_end"))
    # Of several changes at one time only the last sees the whole sum; the
    # others have ``until == at`` and drop out.
    begin, stop = F.col("at"), F.col("until") - slide_ms
    if low is not None:
        begin = F.greatest(begin, F.lit(low - low % slide_ms + slide_ms))
    if high is not None:
        stop = F.least(stop, F.lit(high - high % slide_ms))
    return (
        changes.select(*keys, "at", *running, until.alias("until"))
        .where((F.col("until") > F.col("at")) & (F.col(sums[0]) > 0) & (begin <= stop))
        .select(*keys, F.explode(F.sequence(begin, stop, F.lit(slide_ms))).alias("window_end"), *sums)
    )


def slices_of(size: timedelta, slide: timedelta, slice_size: timedelta) -> Column:
    """Starts of the slices of time that hold ends of the windows a pane (``pane_end``) belongs to."""
    last = F.col("pane_end") + millis(size - slide)
    return F.sequence(floor_to(F.col("pane_end"), slice_size), floor_to(last, slice_size), F.lit(millis(slice_size)))


def sliding_count(
    df: DataFrame,
    keys: Sequence[str],
    size: timedelta,
    slide: timedelta,
    ts: str = "ts",
) -> DataFrame:
    """Rows per key and sliding window: ``keys, window_end, count``. Batch only."""
    _check(size, slide)
    return slide_panes(pane_count(df, keys, slide, ts), keys, size, slide)


def window_ends(ts: Column, size: timedelta, slide: timedelta) -> Column:
    """Array of the ends of all sliding windows a time falls in."""
    size_ms, slide_ms = _check(size, slide)
    first = tumbling_end(ts, slide)
    return F.sequence(first, first + (size_ms - slide_ms), F.lit(slide_ms))


def _check(size: timedelta, slide: timedelta) -> tuple[int, int]:
    size_ms, slide_ms = millis(size), millis(slide)
    if slide_ms <= 0 or size_ms % slide_ms:
        raise ValueError("size must be a multiple of slide")
    return size_ms, slide_ms
