"""First rows of each group, top-N per window and the ranking report."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventide.functions.times import millis, timestamp_text
from eventide.operators.windows import pane_count, slices_of, slide_panes

# Spark cuts groups before the exchange only below this rank.
GROUP_LIMIT = "spark.sql.optimizer.windowGroupLimitThreshold"
SALTS = 64


def first_n(
    df: DataFrame,
    group: Sequence[str],
    order: Sequence[Column | str],
    n: int,
    rank: str = "rank",
) -> DataFrame:
    """The first ``n`` rows of every group with their rank from 1.

    With a filter on ``row_number`` Spark keeps at most ``n`` rows of a group
    per task before the exchange (WindowGroupLimit), so a hot group arrives cut
    down. Beyond Spark's threshold the same is done by a salted first round:
    rows that are not among the first ``n`` of their salt cannot be among the
    first ``n`` of the group.
    """
    threshold = int(df.sparkSession.conf.get(GROUP_LIMIT, "1000"))
    if n >= threshold:
        salt = "_salt"
        salted = df.withColumn(salt, F.pmod(F.xxhash64(*df.columns), F.lit(SALTS)))
        df = _ranked(salted, [*group, salt], order, n, rank).drop(salt, rank)
    return _ranked(df, group, order, n, rank)


def _ranked(df, group, order, n, rank):
    within = Window.partitionBy(*group).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(within)).where(F.col(rank) <= n)


def top_n_per_window(
    counts: DataFrame, n: int, key: str, by: str = "count", count_offset: int = 0
) -> DataFrame:
    """The ``n`` keys with the highest count per window end; ties go to the smaller key.

    ``count_offset`` is added to the reported count.
    """
    ranked = first_n(counts, ["window_end"], [F.desc(by), F.asc(key)], n)
    return ranked.select(
        "window_end", "rank", key, (F.col(by) + count_offset).cast("long").alias(by)
    )


def bounds_per_slice(
    panes: DataFrame, key: str, size: timedelta, slide: timedelta, slice_size: timedelta
) -> DataFrame:
    """What the count of a key can be in the windows that end in a slice: ``key, slice, least, most``.

    The panes that lie in all these windows add up to the least, those that lie in any of
    them to the most. A pane goes to a few slices instead of all its windows, and is
    added up before the exchange.
    """
    start, end = F.col("slice"), F.col("pane_end")
    in_all = (end <= start) & (end > start + millis(slice_size - slide - size))
    placed = panes.select(key, "pane_end", "count", F.explode(slices_of(size, slide, slice_size)).alias("slice"))
    return placed.groupBy(key, "slice").agg(
        F.sum(F.when(in_all, F.col("count")).otherwise(0)).alias("least"), F.sum("count").alias("most")
    )


def contenders(bounds: DataFrame, n: int, key: str) -> DataFrame:
    """Keys and slices that can be among the first ``n`` of a window: ``key, slice``.

    In every window of a slice ``n`` keys have at least the ``n``-th largest of the least
    counts. A key that has fewer at most is behind all of them.
    """
    nth = first_n(bounds, ["slice"], [F.desc("least"), F.asc(key)], n).where(F.col("rank") == n)
    nth = nth.select(F.col("slice").alias("_slice"), F.col("least").alias("needed"))
    reach = F.col("most") >= F.coalesce("needed", F.lit(0))
    return bounds.join(nth, F.col("slice") == F.col("_slice"), "left").where(reach).select(key, "slice")


def top_n_by_bounds(
    df: DataFrame, n: int, key: str, size: timedelta, slide: timedelta, count_offset: int = 0, ts: str = "ts"
) -> DataFrame:
    """The ranking of ``top_n_per_window`` over sliding counts, without counting every key in every window.

    Windows are taken in slices of about a quarter of their length. Only keys that can
    reach the first ``n`` somewhere in a slice are counted window by window there; where
    few keys are frequent that is a small part of all. Where counts are level (all
    keys once, say) every key is a contender, and the plain ranking is the cheaper one.
    """
    steps = max(1, (size // slide) // 4)
    slice_size = steps * slide
    panes = pane_count(df, [key], slide, ts)
    chosen = contenders(bounds_per_slice(panes, key, size, slide, slice_size), n, key)
    counts = slide_panes(panes, [key], size, slide, slice_size=slice_size, only=chosen)
    return top_n_per_window(counts, n, key, count_offset=count_offset)


def ranking_report(
    ranked: DataFrame,
    key: str,
    rank_label: str,
    key_label: str,
    count_label: str,
    ruler: str,
    by: str = "count",
) -> DataFrame:
    """One text per window end: time, a line per rank, ruler.

    Gathers the lines of a window, at most N of them after ``top_n_per_window``.
    """
    line = F.format_string(
        f"{rank_label}%d: {key_label}=%s {count_label}=%d",
        F.col("rank"),
        F.col(key).cast("string"),
        F.col(by),
    )
    lines = ranked.groupBy("window_end").agg(
        F.sort_array(F.collect_list(F.struct("rank", line.alias("line")))).alias("lines")
    )
    header = F.concat(F.lit("时间："), timestamp_text(F.col("window_end")))
    return lines.select(
        "window_end",
        F.concat_ws("\n", header, F.col("lines.line"), F.lit(ruler)).alias("report"),
    )
