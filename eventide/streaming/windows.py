"""Sliding and tumbling counts over a stream."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventide.functions.times import interval_text, millis
from eventide.operators.windows import pane_count, slide_panes, tumbling_end, window_ends
from eventide.streaming.carry import Increments, Note, later, newest_time, partitions_for
from eventide.streaming.sinks import BatchWriter, Handler

NO_DELAY = timedelta(0)

#: Counts of windows that a task makes; they are made in its last step, from far fewer panes.
TASK_COUNTS = 200_000


def with_watermark(df: DataFrame, delay: timedelta = NO_DELAY, ts: str = "ts") -> DataFrame:
    """Event time that may arrive ``delay`` late; 0 for ascending times."""
    return df.withWatermark(ts, interval_text(delay))


def tumbling_count_stream(
    watermarked: DataFrame, keys: Sequence[str], size: timedelta, ts: str = "ts"
) -> DataFrame:
    """Rows per key and tumbling window, as ``tumbling_count``, of rows that have a watermark."""
    window = F.window(ts, interval_text(size)).alias("w")
    counts = watermarked.groupBy(*keys, window).agg(F.count("*").alias("count"))
    return counts.select(*keys, F.unix_millis("w.end").alias("window_end"), "count")


def sliding_count_stream(
    df: DataFrame,
    keys: Sequence[str],
    size: timedelta,
    slide: timedelta,
    delay: timedelta = NO_DELAY,
    ts: str = "ts",
) -> DataFrame:
    """Rows per key and sliding window in a single query, for any output mode.

    Every row is counted in each of its ``size / slide`` windows, so state and
    work grow with that number. For large fan-outs ``sliding_in_batches`` needs
    far less.

    The watermark is on the window end: the newest end lies ``size`` after its
    row's pane, so a delay of ``size`` more closes windows by the row times.
    """
    counts = (
        df.withColumn("end", F.explode(window_ends(F.col(ts), size, slide)))
        .withColumn("end", F.timestamp_millis("end"))
        .withWatermark("end", interval_text(size + delay))
        .groupBy(*keys, "end")
        .agg(F.count("*").alias("count"))
    )
    return counts.select(*keys, F.unix_millis("end").alias("window_end"), "count")


def sliding_in_batches(
    folder: str,
    rows: DataFrame,
    keys: Sequence[str],
    size: timedelta,
    slide: timedelta,
    write: BatchWriter,
    delay: timedelta = NO_DELAY,
    lateness: timedelta = NO_DELAY,
    prepare: Callable[[DataFrame, int], DataFrame] | None = None,
    ts: str = "ts",
    late: BatchWriter | None = None,
) -> Handler:
    """Handler of the micro-batches of the stream ``rows`` that hands sliding counts to ``write``.

    A batch's rows are counted per key and pane, and these counts are written as an
    increment under ``folder``. A pane is written by
    each batch that has rows for it, and once more when increments are put together;
    increments go when no window needs them. A window is handed on by the batch with
    the first row ``delay`` past its end. For ``lateness`` more, a window that gets
    further rows is handed on again, with all its keys. Only these windows are made from
    the panes. Rows for windows past that are dropped, window by window: a row late for
    one still counts in the next.

    ``prepare`` turns a batch into the rows that count; time runs by all rows. ``late`` gets
    what is dropped: a row with ``window_end`` for each window it came too late for.

    ``close`` of the handler hands on the windows that are still open when a bounded
    input has ended, as the batch after the last one. It may be repeated; if the stream goes
    on later, its next batch takes the place of that one.
    """
    schema = ", ".join(f"`{k}` {rows.schema[k].dataType.simpleString()}" for k in keys)
    schema = f"{schema}{', ' if keys else ''}pane_end long, count long"
    panes, notes = Increments(f"{folder}/panes", schema, ["count"], "pane_end"), Note(f"{folder}/notes")
    size_ms, delay_ms, late_ms = millis(size), millis(delay), millis(lateness)
    end = F.col("pane_end")

    def handle(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        try:
            count(batch, batch_id)
        finally:
            batch.unpersist()

    def count(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        note = notes.read(spark, batch_id)
        newest, rows = newest_time(batch, ts)
        before = note.get("seen")
        now = later(before, newest)
        closed = (now if now is not None else 0) - delay_ms
        was = None if before is None else before - delay_ms
        low = None if was is None else was - late_ms
        oldest = None if low is None else low - size_ms
        with partitions_for(spark, rows):
            counted = prepare(batch, batch_id) if prepare else batch
            if late:
                late(too_late(counted, size, slide, low, ts), batch_id)
            last_pane = None if newest is None else newest + millis(slide)
            entry, new = panes.append(pane_count(counted, keys, slide, ts), batch_id, last_pane)
        within = end <= F.lit(closed)
        if oldest is not None:
            within &= end > F.lit(oldest)
        old = panes.read(spark, note, oldest).withColumn("new", F.lit(0).cast("long"))
        known = new.withColumn("new", F.col("count")).unionByName(old).where(within)
        with partitions_for(spark, _most_counts(known, keys, size, slide), TASK_COUNTS):
            known = known.groupBy(*keys, "pane_end")
            known = known.agg(F.sum("count").alias("count"), F.sum("new").alias("new"))
            again = late_ms and was is not None
            known = known.persist() if again else known
            try:
                fresh = known.where(end > F.lit(was - size_ms)) if again else known
                counts = slide_panes(fresh, keys, size, slide, low=was, high=closed)
                if again:
                    # Windows handed on before go again if some key has a new row.
                    near = known.where(end <= F.lit(was))
                    with partitions_for(spark, near.count() * max(1, late_ms // millis(slide)), TASK_COUNTS):
                        told = slide_panes(near, keys, size, slide, ["count", "new"], low, was)
                    changed = told.where(F.col("new") > 0).select("window_end").distinct()
                    told = told.join(changed, "window_end", "left_semi").select(*counts.columns)
                    counts = counts.unionByName(told)
                write(counts.select(*keys, "window_end", "count"), batch_id)
            finally:
                if again:
                    known.unpersist()
        with partitions_for(spark, rows):
            parts = panes.listed(spark, batch_id, note, entry, closed - late_ms - size_ms)
        notes.write(spark, batch_id, {"batch_id": batch_id, "seen": now, **parts})

    def close(spark: SparkSession) -> None:
        note = notes.newest(spark)
        if note.get("seen") is None:
            return
        was = note["seen"] - delay_ms
        known = panes.read(spark, note, was - size_ms).where(end > F.lit(was - size_ms))
        known = known.groupBy(*keys, "pane_end").agg(F.sum("count").alias("count"))
        write(slide_panes(known, keys, size, slide, low=was).select(*keys, "window_end", "count"), note["batch_id"] + 1)

    return Handler(handle, close)


def _most_counts(panes: DataFrame, keys: Sequence[str], size: timedelta, slide: timedelta) -> int:
    """About how many counts can come from panes: one from each for each of its windows, or one for each key and window."""
    found = panes.agg(
        F.count("*").alias("panes"),
        (F.approx_count_distinct(F.xxhash64(*keys)) if keys else F.lit(1)).alias("different"),
        F.min("pane_end").alias("first_end"),
        F.max("pane_end").alias("last_end"),
    ).first()
    if found.first_end is None:
        return 0
    windows = (found.last_end - found.first_end + millis(size)) // millis(slide)
    return min(found.panes * (size // slide), found.different * windows)


def too_late(rows: DataFrame, size: timedelta, slide: timedelta, low: int | None, ts: str = "ts") -> DataFrame:
    """Rows with ``window_end`` for each of their sliding windows that ends at ``low`` or before."""
    ends = window_ends(F.col(ts), size, slide)
    if low is None:
        return rows.select("*", F.explode(ends).alias("window_end")).limit(0)
    found = rows.where(tumbling_end(F.col(ts), slide) <= low)
    return found.select("*", F.explode(F.filter(ends, lambda e: e <= low)).alias("window_end"))


def purging_in_batches(
    folder: str,
    keys: Sequence[str],
    size: timedelta,
    slide: timedelta,
    write: BatchWriter,
    prepare: Callable[[DataFrame, int], DataFrame] | None = None,
    ts: str = "ts",
) -> BatchWriter:
    """Handler that fires with every micro-batch and keeps nothing: a window's rows since the last firing.

    Each firing hands on the counts of the batch's rows alone, for every window
    they are in, so the firings of a window add up to its count and no row is too late. A
    batch that is repeated hands on the same again. ``size`` equal to ``slide`` gives
    tumbling windows.
    """

    def handle(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        _, rows = newest_time(batch, ts)
        with partitions_for(spark, rows):
            panes = pane_count(prepare(batch, batch_id) if prepare else batch, keys, slide, ts).persist()
            try:
                most = _most_counts(panes, keys, size, slide)
                with partitions_for(spark, most, TASK_COUNTS):
                    write(slide_panes(panes, keys, size, slide), batch_id)
            finally:
                panes.unpersist()

    return handle
