"""The ten jobs on bounded tables. Each takes the records it reads and returns its result."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventide.functions.times import millis, timestamp_text
from eventide.operators import distinct, limits, orders, ranking, windows

HOUR = timedelta(hours=1)

HOT_ITEMS_SIZE, HOT_ITEMS_SLIDE = HOUR, timedelta(minutes=5)
HOT_ITEMS_TOP = 3
HOT_URLS_SIZE, HOT_URLS_SLIDE = timedelta(minutes=10), timedelta(seconds=5)
HOT_URLS_TOP = 5
MARKETING_SIZE, MARKETING_SLIDE = HOUR, timedelta(seconds=10)
AD_SIZE, AD_SLIDE = HOUR, timedelta(seconds=5)
AD_LIMIT = 100

# Wording of the two ranking reports, fixed values.
ITEM_REPORT = {
    "rank_label": "No",
    "key_label": "商品ID",
    "count_label": "浏览量",
    "ruler": "=" * 35,
}
URL_REPORT = {
    "rank_label": "NO",
    "key_label": "URL",
    "count_label": "访问量",
    "ruler": "=" * 30,
}


def page_view_rows(behavior: DataFrame) -> DataFrame:
    return behavior.where(F.col("behavior") == "pv")


def installs_and_clicks(marketing: DataFrame) -> DataFrame:
    return marketing.where(F.col("behavior") != "UNINSTALL")


def hot_item_counts(behavior: DataFrame) -> DataFrame:
    """Views per item in the last hour, every five minutes."""
    return windows.sliding_count(
        page_view_rows(behavior), ["item_id"], HOT_ITEMS_SIZE, HOT_ITEMS_SLIDE
    )


def hot_items(behavior: DataFrame, n: int = HOT_ITEMS_TOP, by_bounds: bool = False) -> DataFrame:
    """Most viewed items per window; ``by_bounds`` counts only items that can be among them."""
    if by_bounds:
        views = page_view_rows(behavior)
        return ranking.top_n_by_bounds(views, n, "item_id", HOT_ITEMS_SIZE, HOT_ITEMS_SLIDE)
    return ranking.top_n_per_window(hot_item_counts(behavior), n, "item_id")


def hot_items_report(behavior: DataFrame, n: int = HOT_ITEMS_TOP) -> DataFrame:
    return ranking.ranking_report(hot_items(behavior, n), "item_id", **ITEM_REPORT)


def url_counts(access_log: DataFrame) -> DataFrame:
    """Requests per url in the last ten minutes, every five seconds."""
    return windows.sliding_count(access_log, ["url"], HOT_URLS_SIZE, HOT_URLS_SLIDE)


def hot_urls(
    access_log: DataFrame, n: int = HOT_URLS_TOP, count_offset: int = 0, by_bounds: bool = False
) -> DataFrame:
    """Most requested urls per window; ``by_bounds`` counts only urls that can be among them."""
    if by_bounds:
        return ranking.top_n_by_bounds(access_log, n, "url", HOT_URLS_SIZE, HOT_URLS_SLIDE, count_offset)
    return ranking.top_n_per_window(url_counts(access_log), n, "url", count_offset=count_offset)


def hot_urls_report(access_log: DataFrame, n: int = HOT_URLS_TOP, count_offset: int = 0) -> DataFrame:
    return ranking.ranking_report(hot_urls(access_log, n, count_offset), "url", **URL_REPORT)


def page_views(behavior: DataFrame) -> DataFrame:
    """Views per hour."""
    counts = windows.tumbling_count(page_view_rows(behavior), [], HOUR)
    return counts.select(F.lit("pv").alias("label"), "window_end", "count")


def unique_visitors(behavior: DataFrame) -> DataFrame:
    """Different users per hour."""
    return distinct.unique_visitors(page_view_rows(behavior), HOUR)


def unique_visitors_bitmap(
    behavior: DataFrame, capacity: int = distinct.BITMAP_CAPACITY
) -> DataFrame:
    """Different users per hour by bitmap offset."""
    return distinct.unique_visitors_bitmap(page_view_rows(behavior), HOUR, capacity=capacity)


def daily_visitors(hourly_bitmaps: DataFrame) -> DataFrame:
    """Different users per day (by bitmap offset) from bitmaps by hour, without reading events."""
    return distinct.bitmap_counts(distinct.roll_up(hourly_bitmaps, timedelta(days=1)))


def sliding_visitors(behavior: DataFrame) -> DataFrame:
    """Estimate of the different users of the last hour, every five minutes."""
    return distinct.sliding_estimate(page_view_rows(behavior), "user_id", HOUR, timedelta(minutes=5))


def marketing_total(marketing: DataFrame) -> DataFrame:
    """All activity but removals in the last hour, every ten seconds."""
    counts = windows.sliding_count(
        installs_and_clicks(marketing), [], MARKETING_SIZE, MARKETING_SLIDE
    )
    return marketing_rows(counts, F.lit("app marketing"), F.lit("total"))


def marketing_by_channel(marketing: DataFrame) -> DataFrame:
    """The same per channel and behavior."""
    counts = windows.sliding_count(
        installs_and_clicks(marketing), ["channel", "behavior"], MARKETING_SIZE, MARKETING_SLIDE
    )
    return marketing_rows(counts, F.col("channel"), F.col("behavior"))


def marketing_rows(counts: DataFrame, channel: Column, behavior: Column) -> DataFrame:
    start = F.col("window_end") - millis(MARKETING_SIZE)
    return counts.select(
        timestamp_text(start).alias("window_start"),
        timestamp_text(F.col("window_end")).alias("window_end"),
        channel.alias("channel"),
        behavior.alias("behavior"),
        "count",
    )


def limited_clicks(clicks: DataFrame, limit: int = AD_LIMIT, order=None) -> DataFrame:
    """Clicks tagged as passed or as the day's warning."""
    return limits.click_limit(clicks, limit, order)


def ad_by_province(clicks: DataFrame, limit: int = AD_LIMIT, order=None) -> DataFrame:
    """Clicks within the limit per province in the last hour, every five seconds."""
    passed = limits.passed_clicks(limited_clicks(clicks, limit, order))
    return province_rows(windows.sliding_count(passed, ["province"], AD_SIZE, AD_SLIDE))


def province_rows(counts: DataFrame) -> DataFrame:
    return counts.select(
        timestamp_text(F.col("window_end")).alias("window_end"), "province", "count"
    )


def ad_blacklist(clicks: DataFrame, limit: int = AD_LIMIT, order=None) -> DataFrame:
    """Users who passed the limit on an ad, once per day."""
    return limits.blacklist_warnings(limited_clicks(clicks, limit, order), limit)


def order_pay_match(order_events: DataFrame) -> DataFrame:
    """Paid orders and orders with a problem, by ``kind``."""
    return orders.order_pay_match(order_events)


def order_timeout_warning(order_events: DataFrame) -> DataFrame:
    """One message per waiting order."""
    return orders.order_timeout_warning(order_events)
