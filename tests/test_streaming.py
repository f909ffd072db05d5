"""Streams of several micro-batches against the batch operators."""

import os
import random
from datetime import datetime, timedelta
from pathlib import Path

import pandas as pd
import pytest
from helpers import pairs, warn_orders
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from eventide.operators import distinct, limits, windows
from eventide.plans import jobs, views
from eventide.streaming import carry, clicks
from eventide.streaming import distinct as stream_distinct
from eventide.streaming import jobs as streams
from eventide.streaming import orders as stream_orders
from eventide.streaming import sinks
from eventide.streaming import windows as stream_windows
from eventide.streaming.sinks import latest_rows, result_path

HOUR = timedelta(hours=1)
BASE = 1511658000  # a full hour, UTC


TEXT = {"url", "province", "behavior", "channel", "event_type"}


class Feed:
    """A folder of files; each file is one micro-batch of a stream."""

    def __init__(self, spark, path, columns):
        self.spark, self.path, self.columns, self.files = spark, path, columns, 0
        path.mkdir()

    def add(self, *batches):
        for rows in batches:
            target = self.path / f"{self.files:04}.parquet"
            kinds = {c: "string" if c in TEXT else "Int64" for c in self.columns}
            pd.DataFrame(rows, columns=self.columns).astype(kinds).to_parquet(target, index=False)
            os.utime(target, (BASE + self.files, BASE + self.files))
            self.files += 1

    def _timed(self, df):
        return df.withColumn("ts", F.timestamp_seconds(F.lit(BASE) + F.col("at"))).drop("at")

    def table(self):
        return self._timed(self.spark.read.parquet(str(self.path)))

    def stream(self):
        schema = self.spark.read.parquet(str(self.path)).schema
        reader = self.spark.readStream.schema(schema).option("maxFilesPerTrigger", 1)
        return self._timed(reader.parquet(str(self.path)))


@pytest.fixture
def feed(spark, tmp_path):
    return lambda columns: Feed(spark, tmp_path / "feed", columns)


def behavior_batches(seed, batches=5, rows=60, minutes=100):
    """Ascending page views; a third of them on one item."""
    rng = random.Random(seed)
    out = []
    for batch in range(batches):
        times = sorted(rng.randrange(minutes * 60) + batch * minutes * 60 for _ in range(rows))
        out.append(
            [
                (rng.randrange(8), rng.choice([1, 1, 2, 3, 4]), rng.choice(["pv", "pv", "buy"]), at)
                for at in times
            ]
        )
    return out


BEHAVIOR = ["user_id", "item_id", "behavior", "at"]


def bag(df, columns=None):
    columns = columns or sorted(df.columns)
    return sorted(tuple(row[c] for c in columns) for row in df.select(*columns).collect())


def newest_time(df):
    return df.agg(F.unix_millis(F.max("ts"))).first()[0]


def finish(query):
    query.awaitTermination()


def test_page_views_and_unique_visitors(spark, feed, folder):
    source = feed(BEHAVIOR)
    source.add(*behavior_batches(1))
    ended = closed(source.table())
    finish(streams.page_views(source.stream(), f"{folder}/pv"))
    assert bag(spark.read.parquet(result_path(f"{folder}/pv"))) == bag(
        jobs.page_views(source.table()).where(ended)
    )
    finish(streams.unique_visitors(source.stream(), f"{folder}/uv"))
    assert bag(spark.read.parquet(result_path(f"{folder}/uv"))) == bag(
        jobs.unique_visitors(source.table()).where(ended)
    )
    finish(streams.unique_visitors_bitmap(source.stream(), f"{folder}/bits", capacity=4))
    assert bag(spark.read.parquet(result_path(f"{folder}/bits"))) == bag(
        jobs.unique_visitors_bitmap(source.table(), 4).where(ended)
    )


def test_running_unique_visitors_replaces_a_window(spark, feed, folder):
    source = feed(BEHAVIOR)
    source.add([(1, 1, "pv", 10), (1, 1, "pv", 20), (2, 1, "pv", 30)])
    finish(streams.running_unique_visitors(source.stream(), folder))
    end = (BASE + 3600) * 1000
    assert bag(spark.read.parquet(result_path(folder)), ["window_end", "uv_count"]) == [(end, 2)]
    source.add([(2, 1, "pv", 40), (3, 1, "pv", 50)], [(1, 1, "pv", 3700)])
    finish(streams.running_unique_visitors(source.stream(), folder))
    assert bag(spark.read.parquet(result_path(folder)), ["window_end", "uv_count"]) == [
        (end, 3),
        (end + 3_600_000, 1),
    ]


def closed(rows):
    """Windows that end by the newest row."""
    return F.col("window_end") <= newest_time(rows)


def closed_text(rows):
    """The same where window ends are text."""
    return F.col("window_end") <= F.date_format(F.lit(rows.agg(F.max("ts")).first()[0]), "yyyy-MM-dd HH:mm:ss.S")


def test_hot_items_over_batches_and_a_restart(spark, feed, folder):
    source = feed(BEHAVIOR)
    batches = behavior_batches(2, batches=6)
    source.add(*batches[:3])
    finish(streams.hot_items(source.stream(), folder, n=2))
    source.add(*batches[3:])
    finish(streams.hot_items(source.stream(), folder, n=2))
    got = spark.read.parquet(result_path(folder)).drop("batch_id")
    ended = closed(source.table())
    assert bag(got) == bag(jobs.hot_items(source.table(), 2).where(ended))


def test_hot_items_as_reports(spark, feed, folder):
    source = feed(BEHAVIOR)
    source.add([(1, 1, "pv", 10), (2, 1, "pv", 20), (1, 2, "pv", 30)], [(1, 1, "pv", 700)])
    finish(streams.hot_items(source.stream(), folder, report=True))
    reports = {r.window_end: r.report for r in spark.read.parquet(result_path(folder)).collect()}
    batch = {r.window_end: r.report for r in jobs.hot_items_report(source.table()).collect()}
    ended = [(BASE + 300) * 1000, (BASE + 600) * 1000]
    assert reports == {end: batch[end] for end in ended}


def test_sketch_on_a_stream(spark, feed, folder):
    source = feed(BEHAVIOR)
    source.add([(user, 1, "pv", user) for user in range(1000)], [(1, 1, "pv", 3700)])
    rows = stream_distinct.unique_visitors_sketch_stream(source.stream(), HOUR)
    finish(sinks.start_table(rows, "sketch", folder))
    [row] = spark.read.parquet(result_path(folder)).collect()
    assert row.window_end == (BASE + 3600) * 1000 and abs(row.uv_count - 1000) < 100


def test_a_batch_that_failed_after_writing_is_repeated(spark, feed, folder):
    source = feed(BEHAVIOR)
    source.add(*behavior_batches(3, batches=4))
    keys, size, slide = ["item_id"], jobs.HOT_ITEMS_SIZE, jobs.HOT_ITEMS_SLIDE
    keep = sinks.write_rows(result_path(folder))

    def start(fail_at):
        def write(counts, batch_id):
            keep(counts, batch_id)
            if batch_id == fail_at:
                raise RuntimeError("lost")

        rows = source.stream()
        handle = stream_windows.sliding_in_batches(folder, rows, keys, size, slide, write)
        return sinks.start(rows, "repeated", folder, handle)

    for fail_at in (1, 3):
        with pytest.raises(StreamingQueryException):
            finish(start(fail_at))
    finish(start(None))
    got = spark.read.parquet(result_path(folder)).drop("batch_id")
    want = windows.sliding_count(source.table(), keys, size, slide)
    assert bag(got) == bag(want.where(closed(source.table())))


def test_marketing(spark, feed, folder):
    rng = random.Random(4)
    source = feed(["channel", "behavior", "at"])
    for batch in range(3):
        times = sorted(rng.randrange(1800) + 1800 * batch for _ in range(40))
        source.add(
            [(rng.choice(["north", "store"]), rng.choice(["CLICK", "UNINSTALL"]), at) for at in times]
        )
    ended = closed_text(source.table())
    for stream_job, batch_job in (
        (streams.marketing_total, jobs.marketing_total),
        (streams.marketing_by_channel, jobs.marketing_by_channel),
    ):
        own = f"{folder}/{batch_job.__name__}"
        finish(stream_job(source.stream(), own))
        got = spark.read.parquet(result_path(own)).drop("batch_id")
        assert bag(got) == bag(batch_job(source.table()).where(ended))


def test_single_query_sliding_count_drops_a_row_per_window(spark, feed, folder):
    """A row late for one sliding window still counts in the next."""
    size, slide = timedelta(minutes=10), timedelta(minutes=5)
    source = feed(["url", "at"])
    # Windows close in the micro-batch after the row that passes their end.
    source.add([("a", 0), ("a", 310)], [("b", 620)], [("b", 630)], [("late", 290), ("late", 590)], [("end", 3000)])
    counts = stream_windows.sliding_count_stream(source.stream(), ["url"], size, slide)
    query = sinks.start_table(counts, "sliding", folder)
    finish(query)
    got = {
        (r.url, r.window_end // 1000 - BASE): r["count"]
        for r in spark.read.parquet(result_path(folder)).collect()
    }
    # At time 620 the windows ending at 300 and 600 are closed, the one at 900 is open.
    assert got == {
        ("a", 300): 1,
        ("a", 600): 2,
        ("a", 900): 1,
        ("b", 900): 2,
        ("b", 1200): 2,
        ("late", 900): 1,
    }


def test_panes_drop_a_late_row_per_window_too(spark, feed, folder):
    keys, size, slide = ["url"], timedelta(minutes=10), timedelta(minutes=5)
    source = feed(["url", "at"])
    source.add([("a", 0), ("a", 310)], [("b", 620)], [("late", 290), ("late", 590)], [("end", 3000)])
    rows = source.stream()
    keep = sinks.write_rows(result_path(folder))
    handle = stream_windows.sliding_in_batches(folder, rows, keys, size, slide, keep)
    finish(sinks.start(rows, "panes", folder, handle))
    got = {
        (r.url, r.window_end // 1000 - BASE): r["count"]
        for r in spark.read.parquet(result_path(folder)).collect()
    }
    assert got == {
        ("a", 300): 1,
        ("a", 600): 2,
        ("a", 900): 1,
        ("b", 900): 1,
        ("b", 1200): 1,
        ("late", 900): 1,
    }


def test_hot_urls_takes_rows_up_to_a_minute_late(spark, feed, folder):
    rng = random.Random(6)
    source = feed(["url", "at"])
    for batch in range(4):
        newest = 300 * (batch + 1)
        # Rows come up to a minute behind the newest one, across batches too.
        rows = [(rng.choice("aaabcdefg"), newest - rng.randrange(60)) for _ in range(40)]
        source.add([*rows, ("z", newest)], [(rng.choice("hij"), newest - rng.randrange(60)) for _ in range(10)])
    source.add([(None, 10_000)])
    finish(streams.hot_urls(source.stream(), folder, n=3))
    requests = source.table().where("url IS NOT NULL")
    got = latest_rows(spark.read.parquet(result_path(folder)))
    assert bag(got) == bag(jobs.hot_urls(requests, 3))
    assert bag(latest_rows(spark.read.parquet(f"{folder}/counts"))) == bag(jobs.url_counts(requests))


def test_hot_urls_drops_what_is_later(spark, feed, folder):
    source = feed(["url", "at"])
    source.add([("a", 0)], [("b", 2000)], [("b", 2001)], [("late", 1300), ("in-time", 1940)], [(None, 9000)])
    finish(streams.hot_urls(source.stream(), folder))
    got = latest_rows(spark.read.parquet(result_path(folder)))
    ends = {url: [] for url in ("late", "in-time")}
    for row in got.where(F.col("url").isin(*ends)).collect():
        ends[row.url].append(row.window_end // 1000 - BASE)
    assert ends["late"] == []  # its last window ends at 1900
    assert (min(ends["in-time"]), len(ends["in-time"])) == (1945, 120)


def test_hot_urls_waits_for_the_end_of_a_window(spark, feed, folder):
    """A window comes with the first row a second past its end, and again with each late row for it."""
    source = feed(["url", "at"])
    source.add([("a", 1)], [("a", 5)], [("a", 6)], [("b", 3)], [("a", 7)], [("b", 2)])
    finish(streams.hot_urls(source.stream(), folder))
    counts = spark.read.parquet(f"{folder}/counts").collect()
    first = [(r.batch_id, r.url, r["count"]) for r in counts if r.window_end == (BASE + 5) * 1000]
    assert sorted(first) == [(2, "a", 1), (3, "a", 1), (3, "b", 1), (5, "a", 1), (5, "b", 2)]
    assert {r.window_end for r in counts} == {(BASE + 5) * 1000}
    reports = feed_reports(spark, source, f"{folder}/reports")
    assert reports[(BASE + 5) * 1000].splitlines()[1:3] == ["NO1: URL=b 访问量=2", "NO2: URL=a 访问量=1"]


def feed_reports(spark, source, folder):
    finish(streams.hot_urls(source.stream(), folder, report=True))
    return {r.window_end: r.report for r in latest_rows(spark.read.parquet(result_path(folder))).collect()}


def test_no_window_is_made_in_vain(spark, feed, folder, monkeypatch):
    source = feed(["url", "at"])
    source.add(*[[("a", 60 * k), ("b", 60 * k + 7)] for k in range(10)])
    made = []
    slide_panes = stream_windows.slide_panes

    def counted(*args, **kwargs):
        out = slide_panes(*args, **kwargs)
        made.append(out.count())
        return out

    monkeypatch.setattr(stream_windows, "slide_panes", counted)
    rows = source.stream()
    size, slide = timedelta(minutes=10), timedelta(seconds=5)
    keep = sinks.write_rows(result_path(folder))
    handle = stream_windows.sliding_in_batches(folder, rows, ["url"], size, slide, keep)
    finish(sinks.start(rows, "slots", folder, handle))
    assert sum(made) == spark.read.parquet(result_path(folder)).count() > 0


def sizes(folder, pattern):
    """Bytes of data under each folder of increments, by the number of its batch."""
    parts = Path(folder.removeprefix("file:")).glob(pattern)
    return {int(p.name.split("=")[1]): sum(f.stat().st_size for f in p.rglob("*.parquet")) for p in parts}


def test_a_batch_writes_what_it_adds_and_old_increments_go(spark, feed, folder, monkeypatch):
    monkeypatch.setattr(carry, "FOLD", 4)
    written = []
    listed = carry.Increments.listed

    def noted(self, spark, batch_id, note, entry, oldest):
        out = listed(self, spark, batch_id, note, entry, oldest)
        written.append((sizes(self.folder, f"batch={batch_id}")[batch_id], [p["name"] for p in out["parts"]]))
        return out

    monkeypatch.setattr(carry.Increments, "listed", noted)
    source = feed(["url", "at"])
    # Thirty batches of the same size; a window reaches over ten of them.
    source.add(*[[(f"u{j}", 60 * k + j) for j in range(50)] for k in range(30)], [("end", 9000)])
    rows, keep = source.stream(), sinks.write_rows(result_path(folder))
    size, slide = timedelta(minutes=10), timedelta(minutes=1)
    finish(sinks.start(rows, "parts", folder, stream_windows.sliding_in_batches(folder, rows, ["url"], size, slide, keep)))
    bytes_written = [n for n, _ in written[:30]]
    assert max(bytes_written) < 1.2 * min(bytes_written)
    assert max(len(parts) for _, parts in written) <= 8
    left = list(Path(folder.removeprefix("file:"), "panes").iterdir())
    assert len(left) <= 2 * 8 and not any(p.name == "batch=0" for p in left)
    want = windows.sliding_count(source.table(), ["url"], size, slide).where(closed(source.table()))
    assert bag(spark.read.parquet(result_path(folder)).drop("batch_id")) == bag(want)


def test_waiting_events_are_kept_as_changes(spark, feed, folder, monkeypatch):
    monkeypatch.setattr(carry, "FOLD", 4)
    rng = random.Random(11)
    source, rows = feed(ORDER), []
    for k in range(12):
        for _ in range(40):
            order, at = rng.randrange(30), 120 * k + rng.randrange(120)
            rows.append((order, rng.choice(["create", "pay"]), at))
    rows.sort(key=lambda r: r[2])
    source.add(*[[r for r in rows if 120 * k <= r[2] < 120 * k + 120] for k in range(12)], [(None, None, 90_000)])
    finish(streams.order_pay_match(source.stream(), folder))
    left = spark.read.parquet(result_path(folder))
    events = sum(1 for r in rows)
    # Each creation is told once, and each payment that has no creation.
    pairs = left.where("result_msg IN ('payed successfully', 'payed but already timeout')").count()
    assert left.count() + pairs == events
    assert len(list(Path(folder.removeprefix("file:"), "waiting").iterdir())) <= 12


def test_a_table_of_windows_is_corrected_in_place(spark, feed, folder):
    path = f"{folder}/table"
    write, want, rng = sinks.upsert_windows(path, part=timedelta(minutes=10)), {}, random.Random(3)
    for k in range(20):
        ends = rng.sample(range(3000 * k, 3000 * k + 6000, 500), 4)
        rows = [(end * 1000, f"u{j}", k) for end in ends for j in range(rng.randint(1, 3))]
        want = {w: r for w, r in want.items() if w not in {e * 1000 for e in ends}}
        for row in rows:
            want.setdefault(row[0], []).append(row)
        batch = spark.createDataFrame(rows, "window_end long, url string, n long")
        write(batch, k)
        if k % 7 == 0:
            write(batch, k)  # repeated
        assert sorted(tuple(r) for r in sinks.read_windows(spark, path).collect()) == sorted(r for w in want.values() for r in w)
    folders = list(Path(path.removeprefix("file:")).glob("day=*/part=*"))
    assert len(folders) <= len({(w - 1) // 600_000 for w in want}) and len(list(Path(path.removeprefix("file:"), "_aside").iterdir())) == 1


def test_an_interrupted_correction_loses_no_window(spark, folder):
    path = f"{folder}/table"
    write = sinks.upsert_windows(path)
    rows = lambda *r: spark.createDataFrame(list(r), "window_end long, n long")
    write(rows((1000, 1), (2000, 1)), 0)
    write(rows((2000, 2)), 1)
    # As if the last step had removed the partition and then failed: the batch is repeated.
    carry.remove(spark, f"{path}/day=0")
    write(rows((2000, 2)), 1)
    assert pairs(sinks.read_windows(spark, path), "window_end", "n") == [(1000, 1), (2000, 2)]
    write(rows(), 2)
    assert pairs(sinks.read_windows(spark, path), "window_end", "n") == [(1000, 1), (2000, 2)]


def test_rows_too_late_are_kept_beside(spark, feed, folder):
    source = feed(["url", "at"])
    source.add([("a", 0), ("a", 900)], [("late", 700), ("late", 300), ("b", 905)], [("end", 5000)])
    finish(streams.hot_urls(source.stream(), folder, late_rows=True))
    late = spark.read.parquet(f"{folder}/late")
    # Windows up to a minute and a second before 900 are given up.
    assert {(r.url, r.window_end // 1000 - BASE) for r in late.collect()} == {
        ("late", at) for at in [*range(705, 840, 5), *range(305, 840, 5)]
    }
    kept = latest_rows(spark.read.parquet(f"{folder}/counts"))
    both = kept.unionByName(late.groupBy("url", "window_end").agg(F.count("*").alias("count")))
    both = both.groupBy("url", "window_end").agg(F.sum("count").alias("count"))
    want = jobs.url_counts(source.table()).where(closed(source.table()))
    assert bag(both.where(closed(source.table()))) == bag(want)


def test_firings_add_up_to_the_window(spark, feed, folder):
    rng = random.Random(8)
    source = feed(["url", "at"])
    source.add(*[[(rng.choice("abc"), rng.randrange(3000)) for _ in range(40)] for _ in range(4)])
    failed = []
    rows = source.stream()

    def count(size, slide, at):
        write = sinks.write_rows(result_path(at))

        def fails_once(batch, batch_id):
            write(batch, batch_id)
            if batch_id == 2 and at not in failed:
                failed.append(at)
                raise RuntimeError("after the write")

        handle = stream_windows.purging_in_batches(at, ["url"], size, slide, fails_once)
        with pytest.raises(StreamingQueryException):
            finish(sinks.start(rows, "fire", at, handle))
        finish(sinks.start(rows, "fire", at, handle))
        fired = spark.read.parquet(result_path(at))
        assert fired.select("batch_id").distinct().count() == 4
        got = fired.groupBy("url", "window_end").agg(F.sum("count").alias("count"))
        assert bag(got) == bag(windows.sliding_count(source.table(), ["url"], size, slide))

    count(timedelta(minutes=10), timedelta(minutes=10), f"{folder}/tumbling")
    count(timedelta(minutes=10), timedelta(minutes=2), f"{folder}/sliding")


def test_a_stream_is_closed_without_a_last_row_and_goes_on(spark, feed, folder):
    source = feed(["user_id", "item_id", "behavior", "at"])
    source.add([(1, 5, "pv", 10), (2, 5, "pv", 20)], [(1, 6, "pv", 4000)])
    job = lambda **o: streams.hot_items(source.stream(), folder, **o)
    finish(job())
    for _ in range(2):
        assert job(closing=True) is None
        got = spark.read.parquet(result_path(folder)).drop("batch_id")
        assert bag(got) == bag(jobs.hot_items(source.table()))
    # Later rows take the place of what was closed.
    source.add([(3, 6, "pv", 4100), (3, 7, "pv", 9000)])
    finish(job())
    job(closing=True)
    assert bag(spark.read.parquet(result_path(folder)).drop("batch_id")) == bag(jobs.hot_items(source.table()))


@pytest.mark.parametrize("name", ["order_pay_match", "order_timeout_warning"])
def test_order_streams_are_closed_without_a_last_row(spark, feed, folder, name):
    source = feed(ORDER)
    source.add([(1, "create", 100), (2, "pay", 120)], [(1, "pay", 200), (3, "create", 300)], [(4, "create", 400), (4, "pay", 400)])
    finish(getattr(streams, name)(source.stream(), folder))
    for _ in range(2):
        getattr(streams, name)(source.stream(), folder, closing=True)
        assert bag(spark.read.parquet(result_path(folder)).drop("batch_id")) == bag(getattr(jobs, name)(source.table()))


CLICK = ["id", "user_id", "ad_id", "province", "at"]


def test_a_click_from_the_future_changes_nothing(spark, feed, folder):
    source = feed(CLICK)
    future = 75 * 365 * 86_400
    source.add([(0, 1, 1, "x", 10), (1, 1, 1, "x", 20), (2, 9, 1, "x", future)], [(3, 1, 1, "x", 30)], [(4, 1, 1, "x", 40)])
    finish(streams.ad_click_limit(source.stream(), folder, 2))
    got = bag(spark.read.parquet(result_path(folder)), ["id", "kind"])
    assert got == [(0, "passed"), (1, "passed"), (2, "passed"), (3, "warning")]


def test_clicks_are_cut_in_a_task_before_they_are_sent(monkeypatch):
    import datetime

    import pyarrow as pa

    monkeypatch.setattr(clicks, "HELD_ROWS", 40)
    rng = random.Random(5)
    rows = [(i, rng.choice([1, 2, None]), rng.choice([7, 7, None]), rng.randrange(1000)) for i in range(500)]
    zone = datetime.timezone.utc
    table = pa.table(
        {
            "id": [r[0] for r in rows],
            "user_id": pa.array([r[1] for r in rows], pa.int64()),
            "ad_id": pa.array([r[2] for r in rows], pa.int64()),
            "ts": pa.array([datetime.datetime.fromtimestamp(r[3], zone) for r in rows], pa.timestamp("us", "UTC")),
            "_day": pa.array([0] * 500, pa.int64()),
        }
    )
    run = clicks._first_of_each(["user_id", "ad_id"], ["user_id", "ad_id", "_day"], ["ts", "id"], 5, "ts")
    out = [r for batch in run(iter(table.to_batches(max_chunksize=30))) for r in batch.to_pylist()]
    want = []
    for user in (1, 2, None):
        mine = sorted((r[3], r[0]) for r in rows if r[1] == user and r[2] == 7)
        want += [i for _, i in mine[:5]]
    assert sorted(r["id"] for r in out if r["id"] is not None) == sorted(want)
    (time_only,) = [r for r in out if r["id"] is None]
    assert time_only["ts"].timestamp() == max(r[3] for r in rows) and time_only["ad_id"] is None


def test_state_is_by_key_and_touches_the_batch_only(spark, feed, folder):
    source = feed(CLICK)
    source.add([(i, i, 1, "x", i) for i in range(200)], [(300, 3, 1, "x", 500)], [(301, 3, 1, "x", 600), (302, 4, 1, "x", 601)])
    query = streams.ad_click_limit(source.stream(), folder, 5)
    finish(query)
    updated = [p["stateOperators"][0]["numRowsUpdated"] for p in query.recentProgress if p["numInputRows"]]
    assert updated[0] >= 200 and updated[1:] and all(n <= 4 for n in updated[1:])


@pytest.mark.parametrize("limit", [2, 100])
def test_click_limit_over_batches_and_days(spark, feed, folder, limit):
    rng = random.Random(limit)
    source, number = feed(CLICK), 0
    for batch in range(4):
        times = sorted(batch * 40_000 + rng.randrange(40_000) for _ in range(250))
        rows = [(number + i, rng.choice([1, 1, 1, 2]), 7, "x", at) for i, at in enumerate(times)]
        source.add(rows)
        number += len(rows)
    order = ["ts", "id"]
    finish(streams.ad_click_limit(source.stream(), folder, limit, order))
    got = spark.read.parquet(result_path(folder))
    assert bag(got, ["id", "kind"]) == bag(limits.click_limit(source.table(), limit, order), ["id", "kind"])


def test_province_counts_follow_the_limiter(spark, feed, folder):
    source = feed(CLICK)
    source.add(
        [(i, 1, 1, "beijing", i * 10) for i in range(120)],
        [(500 + i, i, 1, "hebei", 2000 + i * 7) for i in range(30)],
    )
    order = ["ts", "id"]
    finish(streams.ad_by_province(source.stream(), folder, 100, order))
    want = jobs.ad_by_province(source.table(), 100, order).where(closed_text(source.table()))
    assert bag(spark.read.parquet(result_path(folder)).drop("batch_id")) == bag(want)
    warnings = spark.read.parquet(f"{folder}/warnings").drop("batch_id")
    assert bag(warnings) == bag(jobs.ad_blacklist(source.table(), 100, order)) != []


def test_late_clicks_still_count(spark, feed, folder):
    source = feed(CLICK)
    source.add([(0, 1, 1, "x", 719)], [(1, 1, 1, "x", 720)], [(2, 1, 1, "x", 710)], [(3, 1, 1, "x", 800)])
    finish(streams.ad_click_limit(source.stream(), folder, 2))
    got = bag(spark.read.parquet(result_path(folder)), ["id", "kind"])
    assert got == [(0, "passed"), (1, "passed"), (2, "warning")]


def test_clicks_with_nulls_large_ids_and_ties(spark, feed, folder):
    big = 9007199254740993
    source = feed(CLICK)
    rows = [(big + k, None if k % 2 else big, 1, p, 10) for k, p in enumerate(["b", "a", None, "a", "c", "b"])]
    # pandas would make floats of a column with a null
    frame = spark.createDataFrame(rows, "id long, user_id long, ad_id long, province string, at long")
    for k in (0, 1):
        part = frame.where(F.col("id") % 2 == k).coalesce(1)
        part.toArrow().to_pandas(types_mapper=pd.ArrowDtype).to_parquet(source.path / f"{k:04}.parquet", index=False)
    finish(streams.ad_click_limit(source.stream(), folder, 2))
    got = spark.read.parquet(result_path(folder))
    want = limits.click_limit(source.table(), 2)
    assert bag(got, ["id", "kind"]) == bag(want, ["id", "kind"])
    assert got.count() == 6 and {r.user_id for r in got.collect()} == {None, big}
    # Ties do not depend on the order of the input.
    again = limits.click_limit(source.table().orderBy(F.desc("id")).repartition(3), 2)
    assert bag(again, ["id", "kind"]) == bag(want, ["id", "kind"])


ORDER = ["order_id", "event_type", "at"]


def test_every_step_of_the_order_match(spark, feed, folder):
    source = feed(ORDER)
    source.add(
        [(1, "create", 0), (2, "create", 0), (3, "create", 0), (4, "pay", 10), (5, "refund", 0)],
        # 1 and 2 wait for a payment, in time and at the deadline; 6 has its payment first
        [(1, "pay", 899), (2, "pay", 900), (6, "pay", 890), (6, "create", 895)],
        [(7, "create", 901), (7, "create", 950), (8, "create", 902)],
        [(7, "pay", 960), (8, "refund", 961)],
        [(99, "refund", 5000)],
        [(98, "create", 6000)],
    )
    finish(streams.order_pay_match(source.stream(), folder))
    got = spark.read.parquet(result_path(folder))
    assert bag(got, ["order_id", "kind", "result_msg"]) == [
        (1, "payed", "payed successfully"),
        (2, "timeout", "payed but already timeout"),
        (3, "timeout", "order timeout"),
        (4, "timeout", "already payed but not found create log"),
        # by time its payment comes before there is a creation
        (6, "timeout", "already payed but not found create log"),
        (6, "timeout", "order timeout"),
        (7, "payed", "payed successfully"),
        (7, "timeout", "order timeout"),
        (8, "timeout", "order timeout"),
    ]


def test_payment_after_the_timeout_was_reported(spark, feed, folder):
    source = feed(ORDER)
    source.add([(1, "create", 0)], [(2, "create", 1000)], [(3, "create", 1100)], [(1, "pay", 1200)])
    source.add([(4, "create", 1300)], [(5, "create", 1400)])
    finish(streams.order_pay_match(source.stream(), folder))
    got = spark.read.parquet(result_path(folder)).where(F.col("order_id") == 1)
    assert bag(got, ["result_msg"]) == [("already payed but not found create log",), ("order timeout",)]


def test_late_payment_and_late_creation_reach_their_order(spark, feed, folder):
    source = feed(ORDER)
    source.add([(1, "create", 100)], [(2, "create", 200)], [(3, "create", 210)], [(1, "pay", 150)])
    source.add([(4, "pay", 300)], [(4, "create", 290)], [(9, "refund", 5000)])
    finish(streams.order_pay_match(source.stream(), f"{folder}/match"))
    got = spark.read.parquet(result_path(f"{folder}/match"))
    assert bag(got, ["order_id", "result_msg"]) == [
        (1, "payed successfully"),
        (2, "order timeout"),
        (3, "order timeout"),
        (4, "payed successfully"),
    ]
    finish(streams.order_timeout_warning(source.stream(), f"{folder}/warn"))
    got = spark.read.parquet(result_path(f"{folder}/warn"))
    assert bag(got, ["order_id", "result_msg"]) == [
        (1, "order payed successfully"),
        (2, "order timeout"),
        (3, "order timeout"),
        (4, "order payed successfully"),
    ]


def test_order_streams_run_no_python_on_rows(spark, feed, folder):
    source = feed(ORDER)
    source.add([(1, "create", 100), (1, "pay", 200)])
    plans = []

    def look(rows, batch_id):
        plans.append(rows._jdf.queryExecution().executedPlan().toString())

    handlers = (stream_orders.order_pay_match_in_batches, stream_orders.order_timeout_warning_in_batches)
    for k, handler in enumerate(handlers):
        finish(sinks.start(source.stream(), "plan", f"{folder}/{k}", handler(f"{folder}/{k}", look)))
    assert len(plans) == 2 and not any("Python" in p or "Pandas" in p or "Arrow" in p for p in plans)


@pytest.mark.parametrize("seed", [1, 2])
def test_order_warnings_over_batches(spark, feed, folder, seed):
    rng = random.Random(seed)
    events = sorted(
        (rng.randrange(6_000), rng.choice([0] * 6 + list(range(1, 12))), rng.randrange(2))
        for _ in range(250)
    )
    source = feed(ORDER)
    for begin in range(0, 250, 50):
        source.add([(o, ("create", "pay")[s], at) for at, o, s in events[begin : begin + 50]])
    source.add([(99, "create", 20_000)])
    finish(streams.order_timeout_warning(source.stream(), folder))
    got = bag(spark.read.parquet(result_path(folder)), ["order_id", "result_msg"])
    want = []
    for order in {o for _, o, _ in events}:
        mine = [(at, step) for at, o, step in events if o == order]
        want += [(order, message) for message in warn_orders(mine, 900)]
    assert got == sorted(want)


def test_labelled_console_output(spark, feed, folder):
    source = feed(BEHAVIOR)
    source.add([(1, 1, "pv", 10)], [(1, 1, "pv", 3700)])
    counts = stream_windows.tumbling_count_stream(stream_windows.with_watermark(source.stream()), [], HOUR)
    query = sinks.start_console(counts, "pv count", folder)
    assert query.name == "pv count"
    finish(query)
    assert query.lastProgress["sink"]["description"].startswith("org.apache.spark.sql.execution.streaming.ConsoleTable")
    assert sum(p["numInputRows"] for p in query.recentProgress) == 2


def test_streams_can_run_on_an_interval(spark, feed, folder):
    source = feed(BEHAVIOR)
    source.add([(1, 1, "pv", 10)], [(2, 1, "pv", 3700)])
    query = streams.page_views(source.stream(), folder, interval="0 seconds")
    query.processAllAvailable()
    query.stop()
    assert spark.read.parquet(result_path(folder)).first()["count"] == 1


def test_distinct_stream_needs_no_bounded_window_group(spark, feed):
    """Users are counted per window after being merged per window and user."""
    source = feed(BEHAVIOR)
    source.add([(1, 1, "pv", 10)])
    views = stream_windows.with_watermark(source.stream())
    rows = stream_distinct.unique_visitors_stream(views, HOUR)
    assert rows.isStreaming and rows.columns == ["window_end", "uv_count"]
    assert distinct.unique_visitors(source.table(), HOUR).columns == rows.columns


def test_a_row_with_only_a_time_ends_the_input(spark, feed, folder):
    source = feed(BEHAVIOR)
    source.add(*behavior_batches(7, batches=3))
    source.add([(None, None, None, 10_000_000)])
    finish(streams.page_views(source.stream(), f"{folder}/pv"))
    assert bag(spark.read.parquet(result_path(f"{folder}/pv"))) == bag(jobs.page_views(source.table()))
    finish(streams.hot_items(source.stream(), f"{folder}/hot"))
    got = spark.read.parquet(result_path(f"{folder}/hot")).drop("batch_id")
    assert bag(got) == bag(jobs.hot_items(source.table()))


def test_each_batch_of_a_feed_has_as_many_files(spark, folder, monkeypatch):
    """Also one with fewer rows than files."""
    monkeypatch.setattr(views, "FEED_FILE_ROWS", 10)
    start = datetime(2024, 1, 1)
    times = [start + timedelta(seconds=k) for k in range(396)] + [start + timedelta(days=k) for k in (8, 9, 10, 30)]
    rows = [(k, t, k, "view", 1.0, "") for k, t in enumerate(times)]
    spark.createDataFrame(rows, views.EVENTS).write.parquet(f"{folder}/in/events.parquet")
    for write, named in ((views.write_feed, "feed"), (views.write_even_feed, "even")):
        files = write(spark, f"{folder}/in", f"{folder}/{named}")
        assert files == 5
        feed = [spark.read.schema(views.EVENTS).parquet(f"{folder}/{named}/{k:04}") for k in range(8)]
        assert [len(batch.inputFiles()) for batch in feed] == [5] * 8
        assert sum(batch.count() for batch in feed) == 400


@pytest.fixture
def many_partitions(spark):
    before = spark.conf.get(carry.PARTITIONS)
    spark.conf.set(carry.PARTITIONS, "64")
    yield
    spark.conf.set(carry.PARTITIONS, before)


def test_partitions_follow_the_rows_up_to_the_setting(spark, many_partitions):
    made = []
    for rows in (0, 1, 100, 101, 10_000):
        with carry.partitions_for(spark, rows, 100):
            made.append(int(spark.conf.get(carry.PARTITIONS)))
    with pytest.raises(ValueError), carry.partitions_for(spark, 5, 100):
        raise ValueError
    assert made == [1, 1, 1, 2, 64]
    assert spark.conf.get(carry.PARTITIONS) == "64"


@pytest.mark.parametrize("lateness", [0, 60])
def test_windows_of_a_small_batch_are_made_in_few_tasks(spark, feed, folder, many_partitions, lateness):
    source = feed(["url", "at"])
    source.add(*[[(u, 60 * k + j) for j, u in enumerate("abcde")] for k in range(4)], [("end", 9000)])
    rows, keep, tasks = source.stream(), sinks.write_rows(result_path(folder)), []

    def write(counts, batch_id):
        tasks.append(counts.rdd.getNumPartitions())
        keep(counts, batch_id)

    size, slide = timedelta(minutes=10), timedelta(seconds=5)
    late = timedelta(seconds=lateness)
    handle = stream_windows.sliding_in_batches(folder, rows, ["url"], size, slide, write, lateness=late)
    finish(sinks.start(rows, "few", folder, handle))
    assert max(tasks) <= 2
    want = windows.sliding_count(source.table(), ["url"], size, slide).where(closed(source.table()))
    assert bag(latest_rows(spark.read.parquet(result_path(folder)))) == bag(want)


def test_firings_of_a_small_batch_are_made_in_few_tasks(spark, feed, folder, many_partitions):
    source, tasks = feed(["url", "at"]), []
    source.add([("a", 1), ("b", 2), (None, 3)], [])
    rows = source.stream()
    size, slide = timedelta(minutes=10), timedelta(seconds=5)
    write = lambda counts, _: tasks.append((counts.rdd.getNumPartitions(), counts.count()))
    finish(sinks.start(rows, "few", folder, stream_windows.purging_in_batches(folder, ["url"], size, slide, write)))
    assert max(t for t, _ in tasks) == 1
    assert sum(n for _, n in tasks) == 360


@pytest.mark.parametrize(
    "job", [stream_orders.order_pay_match_in_batches, stream_orders.order_timeout_warning_in_batches]
)
def test_orders_of_a_small_batch_are_settled_in_few_tasks(spark, feed, folder, many_partitions, job):
    source, set_to = feed(ORDER), []
    source.add([(1, "create", 0), (2, "create", 5)], [(1, "pay", 60)], [(None, None, 90_000)])
    rows = source.stream()
    write = lambda told, _: set_to.append((told.count(), told.sparkSession.conf.get(carry.PARTITIONS)))
    finish(sinks.start(rows, "few", folder, job(folder, write)))
    assert {n for _, n in set_to} == {"1"}
    assert sum(n for n, _ in set_to) == 2


def test_counts_are_kept_once_and_ranked_from_what_was_kept(spark, folder):
    read = []
    rows = spark.createDataFrame([("a", 1, 5)], "url string, window_end long, count long")
    sinks.write_and_pass(f"{folder}/counts", lambda batch, _: read.append((batch.inputFiles(), bag(batch))))(rows, 7)
    sinks.write_and_pass(f"{folder}/counts", lambda batch, _: read.append((batch.inputFiles(), bag(batch))))(rows.limit(0), 8)
    assert all("/counts/batch_id=7/" in f for f in read[0][0]) and read[0][0]
    assert [found for _, found in read] == [[(5, "a", 1)], []]
