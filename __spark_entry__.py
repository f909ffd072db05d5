"""Registered queries and the SQL each of them must agree with.

Inputs of the jobs are views on ``events`` and ``nation`` (``eventide.plans.views``
in Spark, the ``WITH`` clauses below in SQL). Queries named ``*_stream`` run the
streaming form over the whole table in several micro-batches, and return the table it
wrote; its SQL is that of the table form.
"""

from __future__ import annotations

import sys
import uuid
from collections.abc import Callable
from datetime import timedelta
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import DataFrame, SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from eventide.functions import hashing, times  # noqa: E402
from eventide.operators import distinct, limits, orders, windows  # noqa: E402
from eventide.plans import jobs, views  # noqa: E402
from eventide.session import configure, shared_dir, ship_package  # noqa: E402
from eventide.sources import connectors, growing, schemas, text  # noqa: E402
from eventide.streaming import jobs as streams  # noqa: E402
from eventide.streaming.sinks import latest_rows, read_windows, result_path  # noqa: E402

# The operators on documents may be left out of an installation.
try:
    import corpus_pipeline  # noqa: E402
    from eventide.llm import queries as llm  # noqa: E402
except ModuleNotFoundError as missing:
    if missing.name not in ("eventide.llm", "corpus_pipeline"):
        raise
    llm = None

# Clicks a user may make on one ad and day; low enough to be passed in these tables.
AD_LIMIT = 2
AD_ORDER = ("ts", "event_id")
SMALL_BITMAP = 64  # so small that users share bits
DAY_BITMAP = 1 << 20
DAY = timedelta(days=1)


def entry(spark: SparkSession) -> DataFrame:
    """Most viewed items per hour, every five minutes."""
    return queries()["hot_items"](spark, "/root/testdata/sf0.001")


# --- inputs -----------------------------------------------------------------


def _behavior(spark, sf_dir):
    return views.behavior(views.events(spark, sf_dir))


def _page_views(spark, sf_dir):
    """Views only, by a test that the scan can use."""
    return views.behavior(views.views_only(views.events(spark, sf_dir)))


def _access_log(spark, sf_dir):
    return views.access_log(views.events(spark, sf_dir))


def _marketing(spark, sf_dir):
    return views.marketing(views.events(spark, sf_dir))


def _kept_marketing(spark, sf_dir):
    """Without removals, by a test that the scan can use."""
    return views.marketing(views.without_removals(views.events(spark, sf_dir)))


def _clicks(spark, sf_dir):
    return views.ad_clicks(views.events(spark, sf_dir), views.nation(spark, sf_dir))


def _orders(spark, sf_dir):
    return views.orders(views.events(spark, sf_dir))


# Rows of the late feeds come up to this long after newer ones.
LATE_MS = 60_000


def _feed(spark, sf_dir, late_ms=0):
    """The events as a stream of several micro-batches; the files are written once a session."""
    feeds = spark.sparkContext.__dict__.setdefault("_eventide_feeds", {})
    if (sf_dir, late_ms) not in feeds:
        folder = f"{_folder(spark)}/feed"
        feeds[sf_dir, late_ms] = folder, views.write_feed(spark, sf_dir, folder, late_ms=late_ms)
    return views.read_feed(spark, *feeds[sf_dir, late_ms])


# Rows of the feeds with dropped requests come this much later than others.
DROPPED_MS = 900_000


def _even_feed(spark, sf_dir, late_ms=0, ended=True):
    """The events in batches of equal time, written once a session."""
    feeds = spark.sparkContext.__dict__.setdefault("_eventide_feeds", {})
    key = (sf_dir, "even", late_ms, ended)
    if key not in feeds:
        folder = f"{_folder(spark)}/feed"
        feeds[key] = folder, views.write_even_feed(spark, sf_dir, folder, late_ms=late_ms, ended=ended)
    return views.read_feed(spark, *feeds[key])


def _behavior_stream(spark, sf_dir):
    return views.behavior(_feed(spark, sf_dir))


def _marketing_stream(spark, sf_dir):
    return views.marketing(_feed(spark, sf_dir))


def _access_log_stream(spark, sf_dir):
    return views.access_log(_feed(spark, sf_dir, LATE_MS))


def _order_stream(spark, sf_dir):
    return views.orders(_feed(spark, sf_dir, LATE_MS))


def _click_stream(spark, sf_dir):
    return views.ad_clicks(_feed(spark, sf_dir), views.nation(spark, sf_dir))


# --- single operators --------------------------------------------------------


def _behavior_lines(spark, sf_dir):
    """Behavior records as delimited lines with blanks around the fields."""
    fields = ["user_id", "item_id", "category_id", "behavior", F.unix_seconds("ts")]
    return _behavior(spark, sf_dir).select(F.concat_ws(" , ", *fields).alias("value"))


def _parsed_behavior(spark, sf_dir):
    return text.parse_delimited(_behavior_lines(spark, sf_dir), schemas.USER_BEHAVIOR)


def parse_user_behavior(spark, sf_dir):
    rows = text.with_event_time(_parsed_behavior(spark, sf_dir))
    return rows.withColumn("at", F.unix_millis("ts")).drop("ts")


def parse_marketing(spark, sf_dir):
    """Marketing records as lines, with their time in milliseconds."""
    rows = _marketing(spark, sf_dir)
    line = F.concat_ws(",", "user_id", "behavior", "channel", F.unix_millis("ts"))
    parsed = text.parse_delimited(rows.select(line.alias("value")), schemas.MARKETING_EVENT)
    timed = text.with_event_time(parsed, unit="milliseconds")
    return timed.withColumn("at", F.unix_millis("ts")).drop("ts")


def parse_ad_clicks(spark, sf_dir):
    """Ad clicks as lines; the city is the province in lower case."""
    rows = _clicks(spark, sf_dir)
    line = F.concat_ws(", ", "user_id", "ad_id", "province", F.lower("province"), F.unix_seconds("ts"))
    parsed = text.parse_delimited(rows.select(line.alias("value")), schemas.AD_CLICK)
    timed = text.with_event_time(parsed)
    return timed.withColumn("at", F.unix_millis("ts")).drop("ts")


def _partly_bad_lines(spark, sf_dir):
    """Order lines in which the time of error events is no number."""
    time = F.when(F.col("event_type") == "error", "none").otherwise(
        F.unix_seconds("ts").cast("string")
    )
    line = F.concat_ws(",", F.col("event_id"), F.col("event_type"), F.lit(""), time)
    return views.events(spark, sf_dir).select(line.alias("value"))


def _quarantined(spark, sf_dir):
    return text.parse_delimited(
        _partly_bad_lines(spark, sf_dir), schemas.ORDER_EVENT, mode=text.QUARANTINE
    )


def parse_good_rows(spark, sf_dir):
    return text.good_rows(_quarantined(spark, sf_dir))


def parse_bad_lines(spark, sf_dir):
    return text.bad_lines(_quarantined(spark, sf_dir))


def _log_lines(spark, sf_dir):
    """Log lines; the time of error events has an overflowing day, as lenient parsers accept."""
    log = views.events(spark, sf_dir)
    day = F.when(F.col("event_type") == "error", F.dayofmonth("ts") + 31).otherwise(F.dayofmonth("ts"))
    time = F.concat(
        F.lpad(day.cast("string"), 2, "0"), F.date_format("ts", "/MM/yyyy:HH:mm:ss")
    )
    line = F.concat_ws(
        " ",
        F.lit("10.0.0.1"),
        F.col("user_id").cast("string"),
        F.lit("-"),
        time,
        F.lit("+0000"),
        F.lit("GET"),
        F.concat(F.lit("/p/"), F.col("event_id").cast("string")),
    )
    return log.select(line.alias("value"))


def parse_access_log(spark, sf_dir):
    rows = text.parse_access_log(_log_lines(spark, sf_dir))
    return rows.withColumn("at", F.unix_millis("ts")).drop("ts")


# How much of each file of the growing log is there when the query starts again.
GROWTH = [0.4, 0.75, 1.0]


def parse_growing_log_stream(spark, sf_dir):
    """The log lines, read by a query that is started again after each growth of the files."""
    ship_package(spark)
    folder = _folder(spark)
    files = spark.sparkContext.defaultParallelism
    _log_lines(spark, sf_dir).repartition(files).write.text(f"{folder}/whole")
    for share in GROWTH:
        views.grow_files(spark, f"{folder}/whole", f"{folder}/log", share)
        rows = text.parse_access_log(growing.read_growing_lines(spark, f"{folder}/log"))
        writer = rows.writeStream.option("checkpointLocation", f"{folder}/checkpoint")
        writer.trigger(availableNow=True).start(f"{folder}/rows", format="parquet").awaitTermination()
    return spark.read.parquet(f"{folder}/rows").withColumn("at", F.unix_millis("ts")).drop("ts")


def publish_lines(spark, sf_dir):
    """Lines published one message each, read back as a stream would get them."""
    path = f"{_folder(spark)}/topic"
    connectors.publish_lines(_behavior_lines(spark, sf_dir), fmt="parquet", path=path)
    lines = connectors.message_lines(spark.read.parquet(path))
    return text.parse_delimited(lines, schemas.USER_BEHAVIOR)


def user_offsets(spark, sf_dir):
    """Bitmap offset of each user, from the number and from its text."""
    user = F.col("user_id")
    users = views.events(spark, sf_dir).select(user).distinct()
    return users.select(
        user,
        hashing.long_offset(user).alias("offset_of_long"),
        hashing.string_offset(user.cast("string")).alias("offset_of_text"),
    )


def daily_resets(spark, sf_dir):
    """When the counters of each day's clicks are reset."""
    reset = times.next_utc_midnight(F.col("ts"))
    return (
        views.events(spark, sf_dir)
        .groupBy(F.unix_millis(reset).alias("reset_at"), times.timestamp_text(F.unix_millis(reset)).alias("reset_text"))
        .agg(F.count("*").alias("count"))
    )


def behavior_per_hour(spark, sf_dir):
    """Keyed tumbling count."""
    return windows.tumbling_count(_behavior(spark, sf_dir), ["behavior"], jobs.HOUR)


def unique_visitors_daily(spark, sf_dir):
    """Users by day from bitmaps by hour, which are kept as a table that later days are added to."""
    path = f"{_folder(spark)}/bitmaps"
    distinct.bitmaps(_page_views(spark, sf_dir), jobs.HOUR, capacity=DAY_BITMAP).write.parquet(path)
    return jobs.daily_visitors(spark.read.parquet(path))


def sliding_visitors_within_error(spark, sf_dir):
    """Windows, and whether the estimate of their users is within its stated error."""
    views = _page_views(spark, sf_dir)
    ends = windows.window_ends(F.col("ts"), jobs.HOUR, jobs.HOT_ITEMS_SLIDE)
    exact = views.select(F.explode(ends).alias("window_end"), "user_id").groupBy("window_end")
    exact = exact.agg(F.count_distinct("user_id").alias("users"))
    off = F.abs(F.col("uv_count") - F.col("users"))
    within = off <= F.greatest(F.lit(1), F.col("users") * distinct.SKETCH_ERROR)
    return jobs.sliding_visitors(views).join(exact, "window_end", "full").select("window_end", within.alias("within"))


def ad_click_limit(spark, sf_dir):
    tagged = limits.click_limit(_clicks(spark, sf_dir), AD_LIMIT, AD_ORDER)
    return tagged.select("event_id", "user_id", "ad_id", "province", "kind")


# --- streaming queries --------------------------------------------------------


def _folder(spark):
    return f"{shared_dir(spark)}/eventide/{uuid.uuid4().hex}"


def _run(spark, start) -> str:
    """Run one query over what is there; its folder."""
    folder = _folder(spark)
    start(folder).awaitTermination()
    return folder


def _stream_query(job, rows):
    def query(spark, sf_dir):
        ship_package(spark)
        folder = _run(spark, lambda folder: job(rows(spark, sf_dir), folder))
        return spark.read.parquet(result_path(folder)).drop("batch_id")

    return query


def _corrected(table, **options):
    """Newest rows of the windows of the hot urls, from the result or the counts."""

    def query(spark, sf_dir):
        folder = _run(spark, lambda folder: streams.hot_urls(_access_log_stream(spark, sf_dir), folder, **options))
        return latest_rows(spark.read.parquet(f"{folder}/{table}"))

    return query


def hot_items_report_stream(spark, sf_dir):
    rows = _behavior_stream(spark, sf_dir)
    folder = _run(spark, lambda folder: streams.hot_items(rows, folder, report=True))
    return spark.read.parquet(result_path(folder)).drop("batch_id")


def ad_click_limit_stream(spark, sf_dir):
    clicks = _click_stream(spark, sf_dir)
    folder = _run(spark, lambda folder: streams.ad_click_limit(clicks, folder, AD_LIMIT, AD_ORDER))
    table = spark.read.parquet(result_path(folder))
    return table.select("event_id", "user_id", "ad_id", "province", "kind")


def _province_folder(spark, sf_dir):
    clicks = _click_stream(spark, sf_dir)
    return _run(spark, lambda folder: streams.ad_by_province(clicks, folder, AD_LIMIT, AD_ORDER))


def ad_by_province_stream(spark, sf_dir):
    return spark.read.parquet(result_path(_province_folder(spark, sf_dir))).drop("batch_id")


def ad_blacklist_stream(spark, sf_dir):
    return spark.read.parquet(f"{_province_folder(spark, sf_dir)}/warnings").drop("batch_id")


def _dropped_folder(spark, sf_dir):
    """Hot urls of a feed in which requests come too late, with what is dropped."""
    log = views.access_log(_even_feed(spark, sf_dir, DROPPED_MS))
    return _run(spark, lambda folder: streams.hot_urls(log, folder, late_rows=True))


def dropped_urls_stream(spark, sf_dir):
    """Requests that came too late for a window, by url and window."""
    late = spark.read.parquet(f"{_dropped_folder(spark, sf_dir)}/late")
    return late.groupBy("url", "window_end").agg(F.count("*").alias("count"))


def kept_and_dropped_urls_stream(spark, sf_dir):
    """Counts of the windows and what came too late for them: together all requests."""
    folder = _dropped_folder(spark, sf_dir)
    late = spark.read.parquet(f"{folder}/late").groupBy("url", "window_end").agg(F.count("*").alias("count"))
    kept = latest_rows(spark.read.parquet(f"{folder}/counts"))
    return kept.unionByName(late).groupBy("url", "window_end").agg(F.sum("count").alias("count"))


def hot_urls_upserted_stream(spark, sf_dir):
    """Hot urls as one table that is corrected in place, read as it stands."""
    log = _access_log_stream(spark, sf_dir)
    folder = _run(spark, lambda folder: streams.hot_urls(log, folder, upsert=DAY))
    return read_windows(spark, result_path(folder))


def _summed(job, rows, keys):
    """Sums of the firings of a window."""

    def query(spark, sf_dir):
        folder = _run(spark, lambda folder: job(rows(spark, sf_dir), folder))
        fired = spark.read.parquet(result_path(folder))
        return fired.groupBy(*keys, "window_end").agg(F.sum("count").alias("count"))

    return query


def _closed(job, view):
    """A job over a feed that nothing ends, closed when the feed is at its end (twice, which changes nothing)."""

    def query(spark, sf_dir):
        rows = view(_even_feed(spark, sf_dir, ended=False))
        folder = _run(spark, lambda folder: job(rows, folder))
        for _ in range(2):
            job(rows, folder, closing=True)
        return spark.read.parquet(result_path(folder)).drop("batch_id")

    return query


# --- registry -------------------------------------------------------------------


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """All queries by name; each takes (spark, sf_dir)."""
    on = lambda job, rows: lambda spark, sf_dir: job(rows(spark, sf_dir))
    found = {
        # sources and functions
        "parse_user_behavior": parse_user_behavior,
        "parse_good_rows": parse_good_rows,
        "parse_bad_lines": parse_bad_lines,
        "parse_access_log": parse_access_log,
        "parse_growing_log_stream": parse_growing_log_stream,
        "publish_lines": publish_lines,
        "parse_marketing": parse_marketing,
        "parse_ad_clicks": parse_ad_clicks,
        "user_offsets": user_offsets,
        "daily_resets": daily_resets,
        "behavior_per_hour": behavior_per_hour,
        # jobs on tables
        "page_views": on(jobs.page_views, _behavior),
        "unique_visitors": on(jobs.unique_visitors, _page_views),
        "unique_visitors_bitmap": on(jobs.unique_visitors_bitmap, _page_views),
        "unique_visitors_small_bitmap": on(
            lambda rows: jobs.unique_visitors_bitmap(rows, SMALL_BITMAP), _page_views
        ),
        "hot_item_counts": on(jobs.hot_item_counts, _page_views),
        "hot_items": on(jobs.hot_items, _behavior),
        "hot_items_report": on(jobs.hot_items_report, _page_views),
        "url_counts": on(jobs.url_counts, _access_log),
        "hot_urls": on(jobs.hot_urls, _access_log),
        "hot_urls_count_offset": on(lambda rows: jobs.hot_urls(rows, count_offset=1), _access_log),
        "hot_urls_report": on(jobs.hot_urls_report, _access_log),
        "hot_items_by_bounds": on(lambda rows: jobs.hot_items(rows, by_bounds=True), _page_views),
        "hot_urls_by_bounds": on(lambda rows: jobs.hot_urls(rows, by_bounds=True), _access_log),
        "unique_visitors_daily": unique_visitors_daily,
        "sliding_visitors_within_error": sliding_visitors_within_error,
        "marketing_total": on(jobs.marketing_total, _marketing),
        "marketing_by_channel": on(jobs.marketing_by_channel, _kept_marketing),
        "ad_click_limit": ad_click_limit,
        "ad_blacklist": on(lambda rows: jobs.ad_blacklist(rows, AD_LIMIT, AD_ORDER), _clicks),
        "ad_by_province": on(lambda rows: jobs.ad_by_province(rows, AD_LIMIT, AD_ORDER), _clicks),
        "order_pay_match": on(jobs.order_pay_match, _orders),
        "order_timeout_warning": on(jobs.order_timeout_warning, _orders),
        # the same as streams
        "page_views_stream": _stream_query(streams.page_views, _behavior_stream),
        "unique_visitors_stream": _stream_query(streams.unique_visitors, _behavior_stream),
        "unique_visitors_bitmap_stream": _stream_query(streams.unique_visitors_bitmap, _behavior_stream),
        "running_unique_visitors_stream": _stream_query(streams.running_unique_visitors, _behavior_stream),
        "hot_items_stream": _stream_query(streams.hot_items, _behavior_stream),
        "hot_items_report_stream": hot_items_report_stream,
        "hot_urls_stream": _corrected("result"),
        "url_counts_stream": _corrected("counts"),
        "hot_urls_report_stream": _corrected("result", report=True),
        "marketing_total_stream": _stream_query(streams.marketing_total, _marketing_stream),
        "marketing_by_channel_stream": _stream_query(streams.marketing_by_channel, _marketing_stream),
        "ad_click_limit_stream": ad_click_limit_stream,
        "ad_by_province_stream": ad_by_province_stream,
        "ad_blacklist_stream": ad_blacklist_stream,
        "order_pay_match_stream": _stream_query(streams.order_pay_match, _order_stream),
        "order_timeout_warning_stream": _stream_query(streams.order_timeout_warning, _order_stream),
        # what streams drop, what they fire piece by piece, and how they end without a last row
        "dropped_urls_stream": dropped_urls_stream,
        "kept_and_dropped_urls_stream": kept_and_dropped_urls_stream,
        "hot_urls_upserted_stream": hot_urls_upserted_stream,
        "url_increments_stream": _summed(streams.url_increments, _access_log_stream, ["url"]),
        "page_view_increments_stream": _summed(streams.page_view_increments, _behavior_stream, []),
        "hot_items_closed_stream": _closed(streams.hot_items, views.behavior),
        "marketing_total_closed_stream": _closed(streams.marketing_total, views.marketing),
        "order_pay_match_closed_stream": _closed(streams.order_pay_match, views.orders),
        "order_timeout_warning_closed_stream": _closed(streams.order_timeout_warning, views.orders),
    }
    if llm:
        found |= {"pipeline": corpus_pipeline.run} | llm.queries()
    return {name: _configured(query) for name, query in found.items()}


def _configured(query):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return query(configure(spark), sf_dir)

    return run


# --- SQL ------------------------------------------------------------------------

_VIEWS = f"""
behavior AS (
    SELECT user_id, k AS item_id, CAST(k % 10 AS INTEGER) AS category_id,
           CASE WHEN event_type = 'view' THEN 'pv' ELSE event_type END AS behavior, ts
    FROM (SELECT *, CAST(regexp_extract(props, '([0-9]+)', 1) AS BIGINT) AS k FROM events)),
pv AS (SELECT * FROM behavior WHERE behavior = 'pv'),
access_log AS (SELECT '/p/' || item_id AS url, ts FROM behavior),
marketing AS (
    SELECT CASE user_id % 4 WHEN 0 THEN 'north' WHEN 1 THEN 'south'
                            WHEN 2 THEN 'store' ELSE 'direct' END AS channel,
           CASE event_type WHEN 'click' THEN 'CLICK' WHEN 'view' THEN 'DOWNLOAD'
                           WHEN 'error' THEN 'UNINSTALL' ELSE 'INSTALL' END AS behavior, user_id, ts
    FROM events),
kept AS (SELECT * FROM marketing WHERE behavior <> 'UNINSTALL'),
clicks AS (
    SELECT event_id, user_id, user_id % 10 AS ad_id, n_name AS province, ts
    FROM events JOIN nation ON n_nationkey = user_id % 25),
limited AS (
    SELECT *, row_number() OVER (PARTITION BY user_id, ad_id, CAST(ts AS DATE)
                                 ORDER BY ts, event_id) AS nth
    FROM clicks),
passed AS (SELECT * FROM limited WHERE nth <= {AD_LIMIT}),
orders_log AS (
    SELECT event_id // 2 AS order_id, event_id % 2 AS step, epoch_us(ts) // 1000 AS ms
    FROM events WHERE event_type <> 'error')
"""


def _with(*parts: str) -> str:
    """A statement over the views; the last part is the query, the others are further views."""
    return f"WITH {', '.join([_VIEWS, *parts[:-1]])} {parts[-1]}"


def _sliding(source: str, keys: str, size: int, slide: int, name: str = "counts") -> str:
    """Count per sliding window by listing every window of every row; lengths in seconds."""
    listed = f"{keys}, " if keys else ""
    size, slide = size * 1000, slide * 1000
    return f"""
{name} AS (
    SELECT {listed}window_end, count(*) AS count FROM (
        SELECT {listed}unnest(generate_series(first, first + {size - slide}, {slide})) AS window_end
        FROM (SELECT *, epoch_us(ts) // 1000 - (epoch_us(ts) // 1000) % {slide} + {slide} AS first FROM {source}))
    GROUP BY ALL)"""


def _text(ms: str) -> str:
    return f"strftime(make_timestamp(({ms}) * 1000), '%Y-%m-%d %H:%M:%S') || '.0'"


def _ranked(key: str, n: int) -> str:
    return f"""
ranked AS (
    SELECT window_end, rank, {key}, count FROM (
        SELECT *, CAST(row_number() OVER (PARTITION BY window_end
                                          ORDER BY count DESC, {key}) AS INTEGER) AS rank
        FROM counts)
    WHERE rank <= {n})"""


def _report(key: str, rank_label: str, key_label: str, count_label: str, ruler: str) -> str:
    line = f"'{rank_label}' || rank || ': {key_label}=' || {key} || ' {count_label}=' || count"
    return f"""
SELECT window_end,
       '时间：' || {_text('window_end')} || chr(10)
       || string_agg({line}, chr(10) ORDER BY rank) || chr(10) || '{ruler}' AS report
FROM ranked GROUP BY window_end"""


_HOUR_END = "epoch_us(ts) // 1000 - (epoch_us(ts) // 1000) % 3600000 + 3600000"
_HOT_ITEMS = (_sliding("pv", "item_id", 3600, 300), _ranked("item_id", 3))
_HOT_URLS = (_sliding("access_log", "url", 600, 5), _ranked("url", 5))
_TOTAL = _sliding("kept", "", 3600, 10)
_CHANNEL = _sliding("kept", "channel, behavior", 3600, 10)
_PROVINCE = _sliding("passed", "province", 3600, 5)


def _offset(user: str, capacity: int) -> str:
    return f"""list_reduce(
        list_transform(string_split(CAST({user} AS VARCHAR), ''), lambda c: CAST(ascii(c) AS BIGINT)),
        lambda a, c: (a * 61 + c) % {capacity}) % {capacity}"""


def _unique(what: str) -> str:
    return _with(f"SELECT {_HOUR_END} AS window_end, count(DISTINCT {what}) AS uv_count FROM pv GROUP BY 1")


def _marketing_rows(counts: str, channel: str, behavior: str) -> str:
    return _with(
        counts,
        f"""SELECT {_text('window_end - 3600000')} AS window_start, {_text('window_end')} AS window_end,
                   {channel} AS channel, {behavior} AS behavior, count
            FROM counts""",
    )


_CLICK_ROWS = _with(
    f"""SELECT event_id, user_id, ad_id, province,
               CASE WHEN nth <= {AD_LIMIT} THEN 'passed' ELSE 'warning' END AS kind
        FROM limited WHERE nth <= {AD_LIMIT} + 1"""
)

_MATCHED = f"""
linked AS (
    SELECT *, lead(step) OVER seq AS next_step, lead(ms) OVER seq AS next_ms,
           lag(step) OVER seq AS last_step
    FROM orders_log WINDOW seq AS (PARTITION BY order_id ORDER BY ms, step)),
settled AS (
    SELECT order_id,
           CASE WHEN step = 0 AND next_step = 1 AND next_ms < ms + 900000 THEN '{orders.MATCHED}'
                WHEN step = 0 AND next_step = 1 THEN '{orders.LATE}'
                WHEN step = 0 THEN '{orders.NOT_PAYED}'
                WHEN last_step IS NULL OR last_step = 1 THEN '{orders.NO_CREATE}' END AS result_msg
    FROM linked)"""
_MATCH_ROWS = f"""
SELECT order_id, CASE WHEN result_msg = '{orders.MATCHED}' THEN 'payed' ELSE 'timeout' END AS kind,
       result_msg
FROM settled WHERE result_msg IS NOT NULL"""

_WARNED = f"""
warned AS (
    SELECT order_id, ms,
           CASE WHEN EXISTS (SELECT 1 FROM orders_log p WHERE p.order_id = c.order_id AND p.step = 1
                             AND p.ms BETWEEN c.ms AND c.ms + 900000)
                THEN '{orders.WARN_PAYED}' ELSE '{orders.WARN_TIMEOUT}' END AS result_msg
    FROM orders_log c
    WHERE step = 0 AND NOT EXISTS (
        SELECT 1 FROM orders_log p WHERE p.order_id = c.order_id AND p.step = 1
        AND p.ms >= c.ms - 900000 AND p.ms < c.ms))"""


# Requests too late for a window: batches are equal parts of the (moved) time, and a window is
# given up 61 seconds of event time after its end.
_DROPPED = f"""
fed AS (
    SELECT '/p/' || CAST(regexp_extract(props, '([0-9]+)', 1) AS BIGINT) AS url, epoch_us(ts) // 1000 AS ms,
           epoch_us(ts) // 1000 + CASE WHEN event_id % 2 = 1 THEN {DROPPED_MS} ELSE 0 END AS moved
    FROM events),
batched AS (
    SELECT url, ms, (moved - lo) * 8 // (hi - lo + 1) AS k
    FROM fed CROSS JOIN (SELECT min(moved) AS lo, max(moved) AS hi FROM fed)),
seen AS (SELECT k, max(ms) AS newest FROM batched GROUP BY k),
given_up AS (SELECT b.k, max(s.newest) - 61000 AS low FROM seen b JOIN seen s ON s.k < b.k GROUP BY b.k),
missed AS (
    SELECT url, low, unnest(generate_series(ms - ms % 5000 + 5000, ms - ms % 5000 + 600000, 5000)) AS window_end
    FROM batched JOIN given_up USING (k) WHERE ms - ms % 5000 + 5000 <= low)"""

STREAMS = [
    "page_views_stream",
    "unique_visitors_stream",
    "unique_visitors_bitmap_stream",
    "hot_items_stream",
    "hot_items_report_stream",
    "hot_urls_stream",
    "url_counts_stream",
    "hot_urls_report_stream",
    "marketing_total_stream",
    "marketing_by_channel_stream",
    "ad_click_limit_stream",
    "ad_by_province_stream",
    "ad_blacklist_stream",
    "order_pay_match_stream",
    "order_timeout_warning_stream",
]
ALIKE = {"running_unique_visitors_stream": "unique_visitors"}


def oracle_sql() -> dict[str, str]:
    """DuckDB SQL per query, written independently of the Spark plans."""
    behavior_columns = "user_id, item_id, category_id, behavior"
    found = {
        "parse_user_behavior": _with(
            f"SELECT {behavior_columns}, epoch_us(ts) // 1000000 * 1000 AS at FROM behavior"
        ),
        "parse_good_rows": """
            SELECT event_id AS order_id, event_type, '' AS tx_id, epoch_us(ts) // 1000000 AS timestamp
            FROM events WHERE event_type <> 'error'""",
        "parse_bad_lines": """
            SELECT event_id || ',error,,none' AS value FROM events WHERE event_type = 'error'""",
        "parse_access_log": """
            SELECT '10.0.0.1' AS ip, CAST(user_id AS VARCHAR) AS user_id, 'GET' AS method,
                   '/p/' || event_id AS url,
                   epoch_us(ts) // 1000000 * 1000
                   + CASE WHEN event_type = 'error' THEN CAST(31 AS BIGINT) * 86400000 ELSE 0 END AS at
            FROM events""",
        "publish_lines": _with(
            f"SELECT {behavior_columns}, epoch_us(ts) // 1000000 AS timestamp FROM behavior"
        ),
        "user_offsets": f"""
            SELECT DISTINCT user_id, {_offset('user_id', 1 << 27)} AS offset_of_long,
                   {_offset('user_id', 1 << 27)} AS offset_of_text FROM events""",
        "daily_resets": f"""
            SELECT reset_at, {_text('reset_at')} AS reset_text, count(*) AS count
            FROM (SELECT epoch_us(ts) // 1000 - (epoch_us(ts) // 1000) % 86400000 + 86400000 AS reset_at FROM events)
            GROUP BY ALL""",
        "behavior_per_hour": _with(
            f"SELECT behavior, {_HOUR_END} AS window_end, count(*) AS count FROM behavior GROUP BY ALL"
        ),
        "page_views": _with(
            f"SELECT 'pv' AS label, {_HOUR_END} AS window_end, count(*) AS count FROM pv GROUP BY ALL"
        ),
        "unique_visitors": _unique("user_id"),
        "unique_visitors_bitmap": _unique(_offset("user_id", 1 << 28)),
        "unique_visitors_small_bitmap": _unique(_offset("user_id", SMALL_BITMAP)),
        "hot_item_counts": _with(_HOT_ITEMS[0], "SELECT * FROM counts"),
        "hot_items": _with(*_HOT_ITEMS, "SELECT * FROM ranked"),
        "hot_items_report": _with(*_HOT_ITEMS, _report("item_id", **jobs.ITEM_REPORT)),
        "url_counts": _with(_HOT_URLS[0], "SELECT * FROM counts"),
        "hot_urls": _with(*_HOT_URLS, "SELECT * FROM ranked"),
        "hot_urls_count_offset": _with(
            *_HOT_URLS, "SELECT window_end, rank, url, count + 1 AS count FROM ranked"
        ),
        "hot_urls_report": _with(*_HOT_URLS, _report("url", **jobs.URL_REPORT)),
        "hot_items_by_bounds": _with(*_HOT_ITEMS, "SELECT * FROM ranked"),
        "hot_urls_by_bounds": _with(*_HOT_URLS, "SELECT * FROM ranked"),
        "unique_visitors_daily": _with(
            f"""SELECT epoch_us(ts) // 1000 - (epoch_us(ts) // 1000) % 86400000 + 86400000 AS window_end,
                       count(DISTINCT {_offset('user_id', DAY_BITMAP)}) AS uv_count FROM pv GROUP BY 1"""
        ),
        "sliding_visitors_within_error": _with(
            _sliding("pv", "", 3600, 300), "SELECT window_end, true AS within FROM counts"
        ),
        "marketing_total": _marketing_rows(_TOTAL, "'app marketing'", "'total'"),
        "marketing_by_channel": _marketing_rows(_CHANNEL, "channel", "behavior"),
        "ad_click_limit": _CLICK_ROWS,
        "ad_blacklist": _with(
            f"""SELECT user_id, ad_id, 'Click over {AD_LIMIT} times today.' AS msg
                FROM limited WHERE nth = {AD_LIMIT} + 1"""
        ),
        "ad_by_province": _with(
            _PROVINCE, f"SELECT {_text('window_end')} AS window_end, province, count FROM counts"
        ),
        "order_pay_match": _with(_MATCHED, _MATCH_ROWS),
        "order_timeout_warning": _with(_WARNED, "SELECT order_id, result_msg FROM warned"),
        "parse_marketing": _with(
            """SELECT user_id, behavior, channel, epoch_us(ts) // 1000 AS at
               FROM (SELECT CAST(user_id AS VARCHAR) AS user_id, behavior, channel, ts FROM marketing)"""
        ),
        "parse_ad_clicks": _with(
            """SELECT user_id, ad_id, province, lower(province) AS city, epoch_us(ts) // 1000000 * 1000 AS at
               FROM clicks"""
        ),
    }
    found["dropped_urls_stream"] = _with(
        _DROPPED, "SELECT url, window_end, count(*) AS count FROM missed WHERE window_end <= low GROUP BY ALL"
    )
    found["page_view_increments_stream"] = _with(
        f"SELECT {_HOUR_END} AS window_end, count(*) AS count FROM pv GROUP BY 1"
    )
    found |= {name: found["url_counts"] for name in ("kept_and_dropped_urls_stream", "url_increments_stream")}
    found["hot_urls_upserted_stream"] = found["hot_urls"]
    found["parse_growing_log_stream"] = found["parse_access_log"]
    closed = ("hot_items", "marketing_total", "order_pay_match", "order_timeout_warning")
    found |= {f"{name}_closed_stream": found[name] for name in closed}
    # A stream that has ended gives what the table form gives.
    found |= {name: found[name.removesuffix("_stream")] for name in STREAMS if name not in ALIKE}
    found |= {name: found[other] for name, other in ALIKE.items()}
    return found | (llm.oracle_sql() if llm else {})
