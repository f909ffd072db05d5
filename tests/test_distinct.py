import random
from datetime import timedelta

from pyspark.sql import functions as F
from helpers import at_seconds
from test_functions import plain_hash

from eventide.operators import distinct

HOUR = timedelta(hours=1)


def visits(spark, rows):
    df = spark.createDataFrame(rows, "user_id long, at long")
    return df.select("user_id", F.timestamp_millis("at").alias("ts"))


def random_visits():
    rng = random.Random(5)
    return [(rng.choice([1] * 50 + list(range(300))), rng.randrange(0, 5 * 3_600_000)) for _ in range(2_000)]


def per_window(rows, value):
    groups = {}
    for user, at in rows:
        groups.setdefault(at // 3_600_000 * 3_600_000 + 3_600_000, set()).add(value(user))
    return {end: len(users) for end, users in groups.items()}


def counted(df):
    return {r.window_end: r.uv_count for r in df.collect()}


def test_exact(spark):
    rows = random_visits()
    assert counted(distinct.unique_visitors(visits(spark, rows), HOUR)) == per_window(rows, lambda u: u)


def test_bitmap_counts_set_bits(spark):
    rows = random_visits()
    got = counted(distinct.unique_visitors_bitmap(visits(spark, rows), HOUR, capacity=64))
    assert got == per_window(rows, lambda u: plain_hash(str(u), 61, 64))
    assert got != per_window(rows, lambda u: u)


def test_sketch_is_close(spark):
    rows = random_visits()
    exact = per_window(rows, lambda u: u)
    got = counted(distinct.unique_visitors_sketch(visits(spark, rows), HOUR))
    assert got.keys() == exact.keys()
    assert all(abs(got[end] - n) <= 0.1 * n for end, n in exact.items())


def long_visits(spark, n=4000, users=900):
    rng = random.Random(12)
    rows = [(rng.randrange(users) if rng.random() < 0.98 else None, rng.randrange(50 * 3600)) for _ in range(n)]
    return rows, at_seconds(spark, rows, ["user_id", "t"])


def test_bitmaps_are_data_that_can_be_merged(spark, folder):
    rows, df = long_visits(spark)
    hourly = distinct.bitmaps(df, HOUR)
    counts = {r.window_end: r.uv_count for r in distinct.bitmap_counts(hourly).collect()}
    users = {}
    for user, at in rows:
        if user is not None:
            users.setdefault((at // 3600 + 1) * 3_600_000, set()).add(user)
    assert counts == {end: len(seen) for end, seen in users.items()}
    # Two halves written apart unite to the same, and days come from hours without the events.
    for k in (0, 1):
        distinct.bitmaps(df.where(F.pmod("user_id", F.lit(2)) == k), HOUR).write.parquet(f"{folder}/{k}")
    parts = [spark.read.parquet(f"{folder}/{k}") for k in (0, 1)]
    days = distinct.roll_up(distinct.united(*parts), timedelta(days=1))
    want = {}
    for user, at in rows:
        if user is not None:
            want.setdefault((at // 86400 + 1) * 86_400_000, set()).add(user)
    assert {r.window_end: r.uv_count for r in distinct.bitmap_counts(days).collect()} == {e: len(u) for e, u in want.items()}
    plan = distinct.bitmap_counts(days)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "SinglePartition" not in plan


def test_users_that_share_a_bit_count_once(spark):
    rows, df = long_visits(spark, users=5000)
    small = {r.window_end: r.uv_count for r in distinct.bitmap_counts(distinct.bitmaps(df, HOUR, capacity=64)).collect()}
    by_offset = {r.window_end: r.uv_count for r in distinct.unique_visitors_bitmap(df.where("user_id IS NOT NULL"), HOUR, capacity=64).collect()}
    assert small == by_offset and max(small.values()) <= 64


def test_sliding_estimates_from_sketches(spark):
    rows, df = long_visits(spark, n=20_000, users=6000)
    got = {r.window_end: r.uv_count for r in distinct.sliding_estimate(df, "user_id", 6 * HOUR, HOUR).collect()}
    exact = {}
    for user, at in rows:
        for k in range(6):
            exact.setdefault((at // 3600 + 1 + k) * 3_600_000, set()).add(user)
    exact = {end: len(users - {None}) for end, users in exact.items()}
    assert got.keys() == exact.keys()
    assert all(abs(got[e] - n) <= max(1, distinct.SKETCH_ERROR * n) for e, n in exact.items())
