"""Job inputs derived from the ``events`` and ``nation`` tables.

Works on the table and on a stream of it alike.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventide.sources import connectors, growing

EVENTS = T.StructType(
    [
        T.StructField("event_id", T.LongType()),
        T.StructField("ts", T.TimestampNTZType()),
        T.StructField("user_id", T.LongType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("value", T.DoubleType()),
        T.StructField("props", T.StringType()),
    ]
)

CHANNELS = ("north", "south", "store", "direct")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events table with a zoned time, as watermarks need it."""
    return _zoned(spark.read.schema(EVENTS).parquet(f"{sf_dir}/events.parquet"))


#: Rows of a file of a feed: each is read by a task of its own.
FEED_FILE_ROWS = 100_000


def write_feed(spark: SparkSession, sf_dir: str, folder: str, batches: int = 8, late_ms: int = 0) -> int:
    """The events table as files in order of time, for a stream of ``batches`` micro-batches; files per batch.

    With ``late_ms`` every second event goes to the batch it would belong to so much
    later: at the cuts it follows events that are newer. A row with a time only ends the feed.
    """
    rows = spark.read.schema(EVENTS).parquet(f"{sf_dir}/events.parquet")
    at = F.unix_millis(F.col("ts").cast("timestamp"))
    shares = [k / batches for k in range(1, batches)]
    cuts = rows.select(at.cast("double").alias("at")).approxQuantile("at", shares, 0.001)
    moved = at + F.when(F.col("event_id") % 2 == 1, late_ms).otherwise(0)
    total, newest = rows.agg(F.count("*"), F.max(at)).first()
    files = max(1, -(-total // batches // FEED_FILE_ROWS))
    edges = [None, *cuts, None]
    for k, (low, high) in enumerate(zip(edges[:-1], edges[1:], strict=True)):
        inside = F.lit(True)
        if low is not None:
            inside &= moved >= low
        if high is not None:
            inside &= moved < high
        # One batch after the other, since a stream takes files by their age.
        _write_batch(rows.where(inside), f"{folder}/{k:04}", files)
    end = connectors.end_of_input(spark, EVENTS, (newest or 0) + 2 * 86_400_000)
    end.coalesce(1).write.parquet(f"{folder}/{batches:04}")
    return files


def _write_batch(rows: DataFrame, path: str, files: int) -> None:
    """Write one batch of a feed as exactly ``files`` files, as the stream takes that many at a time."""
    rows.repartition(files).write.parquet(path)
    there = rows.sparkSession.read.schema(EVENTS).parquet(path)
    # A task without rows writes none.
    for _ in range(files - len(there.inputFiles())):
        there.limit(0).coalesce(1).write.mode("append").parquet(path)


def write_even_feed(
    spark: SparkSession, sf_dir: str, folder: str, batches: int = 8, late_ms: int = 0, ended: bool = True
) -> int:
    """As ``write_feed`` with batches of equal time, and with or without a row that ends the feed.

    A row's batch follows from its time alone: the time from the first (moved) event on, in
    ``batches`` equal parts.
    """
    rows = spark.read.schema(EVENTS).parquet(f"{sf_dir}/events.parquet")
    at = F.unix_millis(F.col("ts").cast("timestamp"))
    moved = at + F.when(F.col("event_id") % 2 == 1, late_ms).otherwise(0)
    total, first, last, newest = rows.agg(F.count("*"), F.min(moved), F.max(moved), F.max(at)).first()
    files = max(1, -(-total // batches // FEED_FILE_ROWS))
    part = F.floor((moved - (first or 0)) * batches / ((last or 0) - (first or 0) + 1))
    for k in range(batches):
        _write_batch(rows.where(part == k), f"{folder}/{k:04}", files)
    if ended:
        end = connectors.end_of_input(spark, EVENTS, (newest or 0) + 2 * 86_400_000)
        end.coalesce(1).write.parquet(f"{folder}/{batches:04}")
    return files


def read_feed(spark: SparkSession, folder: str, files: int) -> DataFrame:
    """The files of ``write_feed`` as a stream, one batch after the other."""
    reader = spark.readStream.schema(EVENTS).option("maxFilesPerTrigger", files)
    return _zoned(reader.parquet(f"{folder}/*"))


def grow_files(spark: SparkSession, source: str, folder: str, share: float) -> None:
    """Let ``folder`` hold the first ``share`` of the bytes of each file of ``source``, cut where it falls."""

    def copy(batches):
        for files in batches:
            for path, length in zip(files["path"], files["length"], strict=True):
                store, whole = growing.opened(path)
                _, out = growing.opened(f"{folder}/{path.rsplit('/', 1)[1]}")
                store.create_dir(out.rsplit("/", 1)[0])
                aside = f"{out.rsplit('/', 1)[0]}/_{uuid.uuid4().hex}"
                left = int(length * share)
                with store.open_input_file(whole) as reader, store.open_output_stream(aside) as writer:
                    while left:
                        data = reader.read(min(left, growing.BLOCK_BYTES))
                        writer.write(data)
                        left -= len(data)
                store.move(aside, out)
                yield files.iloc[:0]

    files = spark.read.format("binaryFile").load(source).select("path", "length")
    files.mapInPandas(copy, files.schema).write.format("noop").mode("overwrite").save()


def _zoned(df: DataFrame) -> DataFrame:
    # The stored time has no zone; the session zone is UTC (see eventide.session).
    return df.withColumn("ts", F.col("ts").cast("timestamp"))


def _number() -> Column:
    return F.regexp_extract("props", "([0-9]+)", 1).cast("long")


def behavior(df: DataFrame) -> DataFrame:
    """Views, clicks, ... of items."""
    return df.select(
        "user_id",
        _number().alias("item_id"),
        (_number() % 10).cast("int").alias("category_id"),
        F.when(F.col("event_type") == "view", "pv").otherwise(F.col("event_type")).alias("behavior"),
        "ts",
    )


def views_only(df: DataFrame) -> DataFrame:
    """Rows that become page views, by a test the parquet scan can use."""
    return df.where(F.col("event_type") == "view")


def without_removals(df: DataFrame) -> DataFrame:
    """Rows that do not become UNINSTALL, by a test the parquet scan can use."""
    return df.where(F.col("event_type") != "error")


def access_log(df: DataFrame) -> DataFrame:
    """Page requests."""
    ip = F.concat(F.lit("10.0."), F.floor(F.col("user_id") / 256), F.lit("."), F.col("user_id") % 256)
    return df.select(
        ip.alias("ip"),
        F.col("user_id").cast("string").alias("user_id"),
        "ts",
        F.lit("GET").alias("method"),
        F.concat(F.lit("/p/"), _number()).alias("url"),
    )


def marketing(df: DataFrame) -> DataFrame:
    """Clicks on and installs of an app by channel."""
    channel = F.element_at(
        F.array(*map(F.lit, CHANNELS)), (F.col("user_id") % len(CHANNELS) + 1).cast("int")
    )
    kind = F.col("event_type")
    action = (
        F.when(kind == "click", "CLICK")
        .when(kind == "view", "DOWNLOAD")
        .when(kind.isin("signup", "purchase"), "INSTALL")
        .otherwise("UNINSTALL")
    )
    return df.select(
        F.col("user_id").cast("string").alias("user_id"),
        action.alias("behavior"),
        channel.alias("channel"),
        "ts",
    )


def ad_clicks(df: DataFrame, nation: DataFrame) -> DataFrame:
    """Clicks on ads, with the user's nation as the province.

    ``nation`` is a fixed table of 25 rows in the TPC-H schema; the join type is
    left to Spark, which sees the table's size.
    """
    province = nation.select(F.col("n_nationkey").cast("long").alias("nk"), F.col("n_name").alias("province"))
    clicks = df.select(
        "event_id",
        "user_id",
        (F.col("user_id") % 10).alias("ad_id"),
        (F.col("user_id") % 25).alias("nk"),
        "ts",
    )
    # A row that ends a stream has no user and so no province.
    return clicks.join(province, "nk", "left").drop("nk")


def orders(df: DataFrame) -> DataFrame:
    """Order creations and payments; rows of type error are left out."""
    kind = F.when(F.col("event_id") % 2 == 0, "create").when(F.col("event_id") % 2 == 1, "pay")
    return df.where(F.col("event_type").isNull() | (F.col("event_type") != "error")).select(
        F.floor(F.col("event_id") / 2).cast("long").alias("order_id"),
        kind.alias("event_type"),
        F.col("event_id").cast("string").alias("tx_id"),
        "ts",
    )


def nation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/nation.parquet")
