import os
import random
from collections import Counter
from datetime import UTC, datetime, timedelta

import pandas as pd
import pytest
from helpers import sliding
from pyspark.sql import functions as F

from eventide.operators import limits
from eventide.plans import jobs
from eventide.streaming import jobs as streams
from eventide.streaming.sinks import result_path

START = 1511658000
DAY = 86_400


def clicks(spark, rows):
    df = spark.createDataFrame(rows, "id long, user_id long, ad_id long, province string, at long")
    return df.withColumn("ts", F.timestamp_seconds("at")).drop("at")


def run_of_clicks():
    """One user clicks an ad 121 times, a few others click in between; one day."""
    rows = [(i, 937166, 1715, "beijing", START + 30 * i) for i in range(121)]
    rows += [(1_000 + i, i, i % 3, "guangdong", START + 300 * i) for i in range(12)]
    return rows


def expected(rows, limit):
    seen, kinds = Counter(), {}
    for row_id, user, ad, _, at in sorted(rows, key=lambda r: (r[4], r[0])):
        key = user, ad, at // DAY
        seen[key] += 1
        if seen[key] <= limit + 1:
            kinds[row_id] = "passed" if seen[key] <= limit else "warning"
    return kinds


@pytest.mark.parametrize("limit", [1, 2, 100])
def test_first_clicks_of_a_day_pass(spark, limit):
    rng = random.Random(limit)
    rows = run_of_clicks()
    rows += [
        (2_000 + i, rng.randrange(3), rng.randrange(2), "x", START + rng.randrange(3 * DAY))
        for i in range(600)
    ]
    tagged = limits.click_limit(clicks(spark, rows), limit, ["ts", "id"])
    assert {r.id: r.kind for r in tagged.collect()} == expected(rows, limit)


def test_warning_comes_once_a_day(spark):
    rows = run_of_clicks() + [(5_000 + i, 937166, 1715, "beijing", START + DAY + i) for i in range(150)]
    warnings = jobs.ad_blacklist(clicks(spark, rows), 100, ["ts", "id"]).collect()
    assert [tuple(w) for w in warnings] == [(937166, 1715, "Click over 100 times today.")] * 2


def test_counts_per_province(spark):
    rows = run_of_clicks()
    got = jobs.ad_by_province(clicks(spark, rows), 100, ["ts", "id"]).collect()
    # 100 clicks of the limited user and 12 others, each in 720 windows
    assert sum(r["count"] for r in got) == 112 * 720
    by_window = {(r.window_end, r.province): r["count"] for r in got}
    assert by_window["2017-11-26 01:00:05.0", "beijing"] == 1
    assert by_window["2017-11-26 02:00:00.0", "beijing"] == 100
    assert by_window["2017-11-26 02:00:00.0", "guangdong"] == 12


def log_of_one_hour():
    """143 clicks of 17 pairs of user and ad: one of 121 clicks, and two rows out of order at the end."""
    rows = [(i, 937166, 1715, "beijing", START + 1200 + 20 * i) for i in range(121)]
    rows += [(200 + i, 100 + i, i % 10, "guangdong" if i < 5 else "zhejiang", START + 190 * i) for i in range(14)]
    rows += [(300 + i, 100, 99, "henan", START + 3000 + i) for i in range(5)]
    rows.append((400, 101, 98, "hebei", START + 3719))
    return rows + [(401, 101, 98, "hebei", START + 3710), (402, 102, 2, "hebei", START + 3711)]


def test_a_log_of_one_hour(spark):
    rows = log_of_one_hour()
    assert len(rows) == 143 and len({r[1:3] for r in rows}) == 17
    df = clicks(spark, rows)
    tagged = limits.click_limit(df, 100).collect()
    assert Counter(r.kind for r in tagged) == {"passed": 122, "warning": 1}
    assert [tuple(r) for r in jobs.ad_blacklist(df).collect()] == [(937166, 1715, "Click over 100 times today.")]
    got = {(r.province, r.window_end): r["count"] for r in jobs.ad_by_province(df).collect()}
    assert sum(got.values()) == 122 * 720 == 87_840
    passed = [(r.province, r.ts.timestamp()) for r in tagged if r.kind == "passed"]
    want = sliding([(p, round(at * 1000)) for p, at in passed], timedelta(hours=1), timedelta(seconds=5))
    text = lambda end: datetime.fromtimestamp(end // 1000, UTC).strftime("%Y-%m-%d %H:%M:%S.0")
    assert got == {(p, text(end)): n for (p, end), n in want.items()}


def test_a_log_of_one_hour_as_stream(spark, folder, tmp_path):
    """In file order, each row in a batch of its own at the end; the last two come late and still count."""
    rows = log_of_one_hour()
    columns = ["id", "user_id", "ad_id", "province", "at"]
    rows = sorted(rows[:-2], key=lambda r: r[4]) + rows[-2:]
    for k, part in enumerate([rows[:70], rows[70:140], *[[r] for r in rows[140:]], [(None, None, None, None, START + 9999)]]):
        frame = pd.DataFrame(part, columns=columns).astype({c: "string" if c == "province" else "Int64" for c in columns})
        frame.to_parquet(tmp_path / f"{k}.parquet", index=False)
        os.utime(tmp_path / f"{k}.parquet", (START + k, START + k))
    schema = "id long, user_id long, ad_id long, province string, at long"
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path))
    stream = stream.withColumn("ts", F.timestamp_seconds("at")).drop("at")
    streams.ad_by_province(stream, folder).awaitTermination()
    got = spark.read.parquet(result_path(folder)).drop("batch_id").collect()
    # All windows of the two late rows are still open but those that ended before they came.
    table = {(r.window_end, r.province): r["count"] for r in jobs.ad_by_province(clicks(spark, log_of_one_hour())).collect()}
    late = {(w, p): n for (w, p), n in table.items() if p == "hebei" and w <= "2017-11-26 02:01:55.0"}
    want = {k: n for k, n in table.items() if k not in late}
    assert {(r.window_end, r.province): r["count"] for r in got if (r.window_end, r.province) not in late} == want
    assert spark.read.parquet(f"{folder}/warnings").count() == 1


def test_hot_key_is_cut_before_the_exchange(spark):
    df = limits.click_limit(clicks(spark, run_of_clicks()), 100, ["ts", "id"])
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.rfind("WindowGroupLimit") > plan.find("Exchange") > plan.find("WindowGroupLimit") > 0
