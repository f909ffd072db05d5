import random
from datetime import timedelta

import pytest
from helpers import at_seconds
from pyspark.sql import functions as F

from eventide.operators import ranking, windows
from eventide.plans import jobs


def counts(spark, rows):
    return spark.createDataFrame(rows, "window_end long, item_id long, count long")


def test_ties_go_to_the_smaller_key(spark):
    rows = [(10, 3, 5), (10, 1, 5), (10, 2, 9), (10, 4, 1), (20, 8, 1)]
    got = ranking.top_n_per_window(counts(spark, rows), 3, "item_id").collect()
    assert sorted((r.window_end, r["rank"], r.item_id, r["count"]) for r in got) == [
        (10, 1, 2, 9),
        (10, 2, 1, 5),
        (10, 3, 3, 5),
        (20, 1, 8, 1),
    ]


def test_count_offset_only_changes_the_reported_count(spark):
    rows = [(10, 1, 5), (10, 2, 9)]
    got = ranking.top_n_per_window(counts(spark, rows), 1, "item_id", count_offset=1).collect()
    assert [(r.item_id, r["count"]) for r in got] == [(2, 10)]


def test_group_is_cut_before_the_exchange(spark):
    df = ranking.top_n_per_window(counts(spark, [(1, 1, 1)]), 3, "item_id")
    plan = df._jdf.queryExecution().executedPlan().toString()
    first, second = plan.find("WindowGroupLimit"), plan.rfind("WindowGroupLimit")
    assert first < plan.find("Exchange") < second


@pytest.mark.parametrize("n", [1, 7, 1_500])
def test_first_n_below_and_above_the_threshold(spark, n):
    rng = random.Random(n)
    rows = [(rng.choice(["hot"] * 8 + ["b"]), rng.randrange(10_000), i) for i in range(4_000)]
    df = spark.createDataFrame(rows, "g string, v long, id long")
    got = {(r.g, r["rank"]): r.id for r in ranking.first_n(df, ["g"], ["v", "id"], n).collect()}
    want = {}
    for group in ("hot", "b"):
        ordered = sorted((v, i) for g, v, i in rows if g == group)[:n]
        want.update({(group, rank): i for rank, (_, i) in enumerate(ordered, 1)})
    assert got == want


def test_item_report(spark):
    end = 1511661600000
    ranked = ranking.top_n_per_window(counts(spark, [(end, 1715, 7), (end, 20, 9)]), 3, "item_id")
    report = ranking.ranking_report(ranked, "item_id", **jobs.ITEM_REPORT).first().report
    # Wording of the report, fixed values.
    assert report.split("\n") == [
        "时间：2017-11-26 02:00:00.0",
        "No1: 商品ID=20 浏览量=9",
        "No2: 商品ID=1715 浏览量=7",
        "===================================",
    ]


def test_url_report_with_offset(spark):
    end = 1511661605000
    rows = counts(spark, [(end, 1, 2)]).withColumn("url", F.lit("/a b%s"))
    ranked = ranking.top_n_per_window(rows, 5, "url", count_offset=1)
    report = ranking.ranking_report(ranked, "url", **jobs.URL_REPORT).first().report
    # Wording of the report, fixed values.
    assert report.split("\n") == [
        "时间：2017-11-26 02:00:05.0",
        "NO1: URL=/a b%s 访问量=3",
        "==============================",
    ]


@pytest.mark.parametrize("seed, n, keys, skew", [(1, 3, 40, 3.0), (2, 5, 8, 0.0), (3, 1, 300, 2.0), (4, 20, 12, 1.0)])
def test_ranking_by_bounds_equals_the_full_ranking(spark, seed, n, keys, skew):
    rng = random.Random(seed)
    rows = []
    for _ in range(3000):
        key = int(keys * rng.random() ** (1 + skew))
        rows.append((None if key == keys - 1 else key, rng.randrange(3 * 3600) // rng.choice([1, 600]) * 1.0))
    df = at_seconds(spark, rows, ["key", "t"])
    size, slide = timedelta(hours=1), timedelta(minutes=5)
    want = ranking.top_n_per_window(windows.sliding_count(df, ["key"], size, slide), n, "key")
    got = ranking.top_n_by_bounds(df, n, "key", size, slide)
    columns = ["window_end", "rank", "key", "count"]
    key = lambda r: tuple((v is not None, v) for v in r)
    assert sorted(map(tuple, got.select(*columns).collect()), key=key) == sorted(map(tuple, want.select(*columns).collect()), key=key)


def test_bounds_hold_and_leave_few_keys_to_rank(spark):
    rng = random.Random(7)
    # Some frequent keys, and many that come once or twice.
    rows = [(rng.randrange(6) if rng.random() < 0.6 else 100 + rng.randrange(2000), rng.randrange(7200)) for _ in range(8000)]
    df = at_seconds(spark, rows, ["key", "t"])
    size, slide, part = timedelta(minutes=10), timedelta(seconds=5), timedelta(seconds=150)
    panes = windows.pane_count(df, ["key"], slide)
    bounds = ranking.bounds_per_slice(panes, "key", size, slide, part)
    counts = windows.sliding_count(df, ["key"], size, slide)
    placed = counts.withColumn("slice", F.col("window_end") - F.pmod("window_end", F.lit(150_000))).join(bounds, ["key", "slice"], "left")
    assert placed.where("least IS NULL OR count < least OR count > most").count() == 0
    chosen = ranking.contenders(bounds, 3, "key")
    ranked = windows.slide_panes(panes, ["key"], size, slide, slice_size=part, only=chosen)
    assert ranked.count() * 5 < counts.count()
