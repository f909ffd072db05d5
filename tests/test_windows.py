import random
from datetime import timedelta

import pytest
from helpers import sliding
from pyspark.sql import functions as F

from eventide.operators import windows

S = lambda n: timedelta(seconds=n)


def events(spark, rows):
    df = spark.createDataFrame(rows, "key string, at long")
    return df.select("key", F.timestamp_millis("at").alias("ts"))


def counted(df):
    return {(r.key, r.window_end): r["count"] for r in df.collect()}


@pytest.mark.parametrize(
    "size, slide",
    [(S(10), S(10)), (S(10), S(5)), (S(60), S(5)), (S(3600), S(300)), (S(3600), S(10)), (S(30), S(1))],
)
@pytest.mark.parametrize("seed", [1, 2])
def test_sliding_count_equals_window_by_window_count(spark, size, slide, seed):
    rng = random.Random(seed)
    span = 12_000_000 if slide > S(5) else 600_000
    # One key holds most rows; times go below zero and repeat.
    rows = [
        (rng.choice(["hot"] * 6 + ["b", "c", "d"]), rng.randrange(-span, span) // 10 * 10)
        for _ in range(400)
    ]
    rows += [("edge", 0), ("edge", 1_000), ("edge", 4 * 3_600_000), ("edge", -1)]
    got = counted(windows.sliding_count(events(spark, rows), ["key"], size, slide))
    assert got == sliding(rows, size, slide)


def test_sliding_count_without_key(spark):
    rows = [("x", 1_000), ("y", 4_000), ("z", 11_000)]
    got = windows.sliding_count(events(spark, rows), [], S(10), S(5)).collect()
    assert sorted((r.window_end, r["count"]) for r in got) == [
        (5_000, 2),
        (10_000, 2),
        (15_000, 1),
        (20_000, 1),
    ]


def test_sliding_count_equals_built_in_windows(spark):
    rng = random.Random(3)
    rows = [(rng.choice("ab"), rng.randrange(0, 40_000_000)) for _ in range(300)]
    df = events(spark, rows)
    built_in = (
        df.groupBy("key", F.window("ts", "1 hour", "5 minutes").alias("w"))
        .agg(F.count("*").alias("count"))
        .select("key", F.unix_millis("w.end").alias("window_end"), "count")
    )
    assert counted(windows.sliding_count(df, ["key"], S(3600), S(300))) == counted(built_in)


def test_null_key_is_a_key(spark):
    rows = [(None, 1_000), (None, 2_000), ("a", 1_000)]
    got = counted(windows.sliding_count(events(spark, rows), ["key"], S(10), S(5)))
    assert got == sliding(rows, S(10), S(5))


def test_row_on_a_boundary_belongs_to_the_later_window(spark):
    rows = [("a", 3_600_000), ("a", 3_599_999)]
    got = counted(windows.tumbling_count(events(spark, rows), ["key"], S(3600)))
    assert got == {("a", 3_600_000): 1, ("a", 7_200_000): 1}


def test_size_is_a_multiple_of_slide(spark):
    with pytest.raises(ValueError):
        windows.sliding_count(events(spark, [("a", 0)]), ["key"], S(10), S(3))


def test_counts_are_combined_before_the_first_exchange(spark):
    df = windows.sliding_count(events(spark, [("a", 0)]), ["key"], S(3600), S(5))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "partial_count" in plan
    # pane counts by key and pane, then panes by key and slice: no third exchange
    assert plan.count("Exchange hashpartitioning") == 2


def test_only_the_wanted_windows_are_made(spark):
    rng = random.Random(12)
    df = events(spark, [(rng.choice("aab"), rng.randrange(200_000)) for _ in range(150)])
    panes = windows.pane_count(df, ["key"], S(5))
    every = counted(windows.slide_panes(panes, ["key"], S(60), S(5)))
    for low, high in ((None, 90_000), (61_234, None), (60_000, 99_999), (500_000, 600_000)):
        part = counted(windows.slide_panes(panes, ["key"], S(60), S(5), low=low, high=high))
        assert part == {
            k: n for k, n in every.items() if (low is None or k[1] > low) and (high is None or k[1] <= high)
        }
