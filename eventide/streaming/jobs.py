"""The ten jobs as queries.

Each takes its records as a stream and a ``folder`` for its checkpoint and
tables, starts the query and returns it. The result is the table
``result_path(folder)``, if not said otherwise. With an ``interval`` the query
runs on; without one it takes what is there and stops.

Time runs by all rows of the stream, also those a job does not count. A bounded
input can thus end with a row that has only a time (``connectors.end_of_input``): it
closes all windows and deadlines before it. Jobs over sliding windows and orders need no
such row: the same call with ``closing``, once the query has ended, hands on what is
still open and returns nothing. It may be repeated, and the stream may go on after it.
"""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from eventide.operators import distinct, limits, ranking
from eventide.plans import jobs
from eventide.streaming import clicks as stream_clicks
from eventide.streaming import distinct as stream_distinct
from eventide.streaming import orders as stream_orders
from eventide.streaming import sinks, windows
from eventide.streaming.sinks import result_path

URL_DISORDER = timedelta(seconds=1)
URL_LATENESS = timedelta(seconds=60)


def _page_views(behavior: DataFrame) -> DataFrame:
    """Page views under a watermark that all rows advance.

    A filter without the time would be moved below the watermark, which then
    would see page views alone.
    """
    is_view = F.when(F.col("ts").isNotNull(), F.col("behavior") == "pv")
    return windows.with_watermark(behavior).where(is_view)


def page_views(
    behavior: DataFrame, folder: str, label: str = "pv count", interval: str | None = None
) -> StreamingQuery:
    views = _page_views(behavior)
    counts = windows.tumbling_count_stream(views, [], jobs.HOUR)
    counts = counts.select(F.lit("pv").alias("label"), "window_end", "count")
    return sinks.start_table(counts, label, folder, interval=interval)


def unique_visitors(
    behavior: DataFrame, folder: str, label: str = "uv", interval: str | None = None
) -> StreamingQuery:
    views = _page_views(behavior)
    counts = stream_distinct.unique_visitors_stream(views, jobs.HOUR)
    return sinks.start_table(counts, label, folder, interval=interval)


def unique_visitors_bitmap(
    behavior: DataFrame,
    folder: str,
    capacity: int = distinct.BITMAP_CAPACITY,
    label: str = "uv bitmap",
    interval: str | None = None,
) -> StreamingQuery:
    """Final counts once per window."""
    views = _page_views(behavior)
    counts = stream_distinct.unique_visitors_bitmap_stream(views, jobs.HOUR, capacity=capacity)
    return sinks.start_table(counts, label, folder, interval=interval)


def running_unique_visitors(
    behavior: DataFrame, folder: str, label: str = "uv so far", interval: str | None = None
) -> StreamingQuery:
    """A table by window that holds the count so far and is corrected as users arrive."""
    counts = stream_distinct.running_distinct_stream(
        jobs.page_view_rows(behavior), F.col("user_id"), jobs.HOUR
    )
    write = sinks.overwrite_windows(result_path(folder))
    return sinks.start(counts, label, folder, write, "update", interval)


def hot_items(
    behavior: DataFrame,
    folder: str,
    n: int = jobs.HOT_ITEMS_TOP,
    report: bool = False,
    label: str = "hot items",
    interval: str | None = None,
    closing: bool = False,
) -> StreamingQuery | None:
    """Top items of closed windows, as rows or as one report text per window."""

    def as_report(ranked: DataFrame) -> DataFrame:
        return ranking.ranking_report(ranked, "item_id", **jobs.ITEM_REPORT)

    write = sinks.write_top_n(result_path(folder), n, "item_id", as_report if report else None)
    size, slide = jobs.HOT_ITEMS_SIZE, jobs.HOT_ITEMS_SLIDE
    return _sliding(
        behavior, jobs.page_view_rows, ["item_id"], size, slide, write, folder, label, interval, closing=closing
    )


def hot_urls(
    access_log: DataFrame,
    folder: str,
    n: int = jobs.HOT_URLS_TOP,
    report: bool = False,
    label: str = "hot urls",
    interval: str | None = None,
    closing: bool = False,
    late_rows: bool = False,
    upsert: timedelta | None = None,
) -> StreamingQuery | None:
    """Counts and top urls of a window once it has ended, corrected by rows up to a minute late.

    A window is handed on by the first row a second past its end, and again by each batch with
    a late row for it. Counts are in ``folder/counts``, rankings (or report texts) in the
    result; the newest batch of a window holds (see ``latest_rows``). With ``late_rows``
    requests that come too late for a window are in ``folder/late``, once for each such window.
    With ``upsert``, an hour say, the result is a table of the newest rows alone; a batch rewrites
    the parts of that length that it has windows in.
    """

    def as_report(ranked: DataFrame) -> DataFrame:
        return ranking.ranking_report(ranked, "url", **jobs.URL_REPORT)

    write = sinks.write_and_pass(
        f"{folder}/counts",
        sinks.write_top_n(
            result_path(folder),
            n,
            "url",
            as_report if report else None,
            sinks.upsert_windows(result_path(folder), part=upsert) if upsert else None,
        ),
    )

    size, slide = jobs.HOT_URLS_SIZE, jobs.HOT_URLS_SLIDE
    late = sinks.write_rows(f"{folder}/late") if late_rows else None
    return _sliding(
        access_log,
        _requests,
        ["url"],
        size,
        slide,
        write,
        folder,
        label,
        interval,
        URL_DISORDER,
        URL_LATENESS,
        closing,
        late,
    )


def url_increments(
    access_log: DataFrame, folder: str, label: str = "url increments", interval: str | None = None
) -> StreamingQuery:
    """Requests per url and window since the last firing: a firing with every batch, and nothing kept."""
    return _purging(access_log, ["url"], jobs.HOT_URLS_SIZE, jobs.HOT_URLS_SLIDE, _requests, folder, label, interval)


def page_view_increments(
    behavior: DataFrame, folder: str, label: str = "pv increments", interval: str | None = None
) -> StreamingQuery:
    """Page views per hour since the last firing."""
    return _purging(behavior, [], jobs.HOUR, jobs.HOUR, jobs.page_view_rows, folder, label, interval)


def _requests(log: DataFrame) -> DataFrame:
    return log.where(F.col("url").isNotNull())


def _purging(rows, keys, size, slide, counted, folder, label, interval) -> StreamingQuery:
    write = sinks.write_rows(result_path(folder))
    handle = windows.purging_in_batches(folder, keys, size, slide, write, lambda batch, _: counted(batch))
    return sinks.start(rows, label, folder, handle, interval=interval)


def marketing_total(
    marketing: DataFrame,
    folder: str,
    label: str = "marketing total",
    interval: str | None = None,
    closing: bool = False,
) -> StreamingQuery | None:
    def write(counts: DataFrame, batch_id: int) -> None:
        rows = jobs.marketing_rows(counts, F.lit("app marketing"), F.lit("total"))
        sinks.write_rows(result_path(folder))(rows, batch_id)

    kept, size, slide = jobs.installs_and_clicks, jobs.MARKETING_SIZE, jobs.MARKETING_SLIDE
    return _sliding(marketing, kept, [], size, slide, write, folder, label, interval, closing=closing)


def marketing_by_channel(
    marketing: DataFrame,
    folder: str,
    label: str = "marketing by channel",
    interval: str | None = None,
    closing: bool = False,
) -> StreamingQuery | None:
    def write(counts: DataFrame, batch_id: int) -> None:
        rows = jobs.marketing_rows(counts, F.col("channel"), F.col("behavior"))
        sinks.write_rows(result_path(folder))(rows, batch_id)

    kept, size, slide = jobs.installs_and_clicks, jobs.MARKETING_SIZE, jobs.MARKETING_SLIDE
    keys = ["channel", "behavior"]
    return _sliding(marketing, kept, keys, size, slide, write, folder, label, interval, closing=closing)


def ad_click_limit(
    clicks: DataFrame,
    folder: str,
    limit: int = jobs.AD_LIMIT,
    order=None,
    label: str = "blacklist",
    interval: str | None = None,
) -> StreamingQuery:
    """One table of passed clicks and warnings, told apart by ``kind``."""
    tagged = stream_clicks.click_limit_stream(clicks, limit, order).where(F.col("kind").isNotNull())
    write = sinks.write_rows(result_path(folder))
    return sinks.start(tagged, label, folder, write, interval=interval, idle_batches=False)


def ad_by_province(
    clicks: DataFrame,
    folder: str,
    limit: int = jobs.AD_LIMIT,
    order=None,
    label: str = "count",
    interval: str | None = None,
    closing: bool = False,
) -> StreamingQuery | None:
    """Clicks within the limit per province; warnings (``user_id, ad_id, msg``) are in ``folder/warnings``."""
    tagged = stream_clicks.click_limit_stream(clicks, limit, order)
    warn = sinks.write_rows(f"{folder}/warnings")
    keep = sinks.write_rows(result_path(folder))

    def passed(batch: DataFrame, batch_id: int) -> DataFrame:
        warn(limits.blacklist_warnings(batch, limit), batch_id)
        return limits.passed_clicks(batch)

    handle = windows.sliding_in_batches(
        folder,
        tagged,
        ["province"],
        jobs.AD_SIZE,
        jobs.AD_SLIDE,
        lambda counts, batch_id: keep(jobs.province_rows(counts), batch_id),
        prepare=passed,
    )
    return _start_or_close(tagged, label, folder, handle, interval, closing, idle_batches=False)


def order_pay_match(
    order_events: DataFrame,
    folder: str,
    label: str = "payed and timeout",
    interval: str | None = None,
    closing: bool = False,
) -> StreamingQuery | None:
    """One table of both outputs, told apart by ``kind``."""
    handle = stream_orders.order_pay_match_in_batches(folder, sinks.write_rows(result_path(folder)))
    return _start_or_close(order_events, label, folder, handle, interval, closing)


def order_timeout_warning(
    order_events: DataFrame,
    folder: str,
    label: str = "order warning",
    interval: str | None = None,
    closing: bool = False,
) -> StreamingQuery | None:
    handle = stream_orders.order_timeout_warning_in_batches(folder, sinks.write_rows(result_path(folder)))
    return _start_or_close(order_events, label, folder, handle, interval, closing)


def _sliding(
    rows,
    counted,
    keys,
    size,
    slide,
    write,
    folder,
    label,
    interval,
    delay=windows.NO_DELAY,
    lateness=windows.NO_DELAY,
    closing=False,
    late=None,
) -> StreamingQuery | None:
    handle = windows.sliding_in_batches(
        folder, rows, keys, size, slide, write, delay, lateness, lambda batch, _: counted(batch), late=late
    )
    return _start_or_close(rows, label, folder, handle, interval, closing)


def _start_or_close(rows, label, folder, handle, interval, closing, idle_batches=True) -> StreamingQuery | None:
    if closing:
        handle.close(rows.sparkSession)
        return None
    return sinks.start(rows, label, folder, handle, interval=interval, idle_batches=idle_batches)
