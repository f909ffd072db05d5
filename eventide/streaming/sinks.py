"""Starting queries, and writing micro-batches so that a repeated batch changes nothing.

Each query has a folder of its own in storage all executors share, with its
checkpoint and tables (see ``eventide.session.shared_dir``). A query that is
restarted runs its last batch again, so a batch writes into places named by the
batch or by the window, and overwrites them.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from eventide.functions.times import millis
from eventide.operators.ranking import top_n_per_window
from eventide.streaming.carry import exists, remove

BatchWriter = Callable[[DataFrame, int], None]


@dataclass
class Handler:
    """What takes the micro-batches of a query, and ends what a bounded input leaves open."""

    handle: BatchWriter
    close: Callable[[SparkSession], None]

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        self.handle(batch, batch_id)


IDLE_BATCHES = "spark.sql.streaming.noDataMicroBatches.enabled"


def start(
    df: DataFrame,
    label: str,
    folder: str,
    write: BatchWriter,
    output_mode: str = "append",
    interval: str | None = None,
    idle_batches: bool = True,
) -> StreamingQuery:
    """Start a labelled query that hands each micro-batch to ``write``.

    Without ``idle_batches`` there is none without new rows. Keyed state with a lifetime
    would ask for one after the other, and a query that takes what is there would not end.
    """
    if idle_batches:
        return _run(df, label, folder, output_mode, interval, lambda w: w.foreachBatch(write))
    conf = df.sparkSession.conf
    before = conf.get(IDLE_BATCHES)
    conf.set(IDLE_BATCHES, "false")  # a query keeps the settings of its start
    try:
        return _run(df, label, folder, output_mode, interval, lambda w: w.foreachBatch(write))
    finally:
        conf.set(IDLE_BATCHES, before)


def start_table(
    df: DataFrame,
    label: str,
    folder: str,
    partition_by: Sequence[str] = (),
    interval: str | None = None,
) -> StreamingQuery:
    """Append final rows to the table ``folder/result``.

    Spark's file sink keeps a list of finished files, so another query can read
    the table as a stream and sees each row once.
    """

    def to_files(writer: DataStreamWriter) -> DataStreamWriter:
        writer = writer.format("parquet").option("path", result_path(folder))
        return writer.partitionBy(*partition_by) if partition_by else writer

    return _run(df, label, folder, "append", interval, to_files)


def start_console(
    df: DataFrame,
    label: str,
    folder: str,
    output_mode: str = "append",
    interval: str | None = None,
) -> StreamingQuery:
    """Print results under a label."""
    to_console = lambda w: w.format("console").option("truncate", "false")
    return _run(df, label, folder, output_mode, interval, to_console)


def result_path(folder: str) -> str:
    """Where a query keeps its table."""
    return f"{folder}/result"


def _run(df, label, folder, output_mode, interval, finish) -> StreamingQuery:
    # Without an interval the query takes all there is and stops.
    trigger = {"processingTime": interval} if interval else {"availableNow": True}
    writer = (
        df.writeStream.queryName(label)
        .outputMode(output_mode)
        .option("checkpointLocation", f"{folder}/checkpoint")
        .trigger(**trigger)
    )
    return finish(writer).start()


def write_rows(path: str) -> BatchWriter:
    """Keep all rows, each batch in its own folder, in files of a sensible size."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.hint("rebalance").write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    return write


def write_and_pass(path: str, *writers: BatchWriter) -> BatchWriter:
    """Keep all rows as ``write_rows``, in files as they are made, and hand on what was kept.

    For many rows: they are made once, and neither moved nor held to be written.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        kept = f"{path}/batch_id={batch_id}"
        batch.write.mode("overwrite").parquet(kept)
        rows = batch.sparkSession.read.schema(batch.schema).parquet(kept)
        for writer in writers:
            writer(rows, batch_id)

    return write


def overwrite_windows(path: str, window: str = "window_end") -> BatchWriter:
    """A table with one partition per window; a window's newest rows replace its old ones."""

    def write(batch: DataFrame, batch_id: int) -> None:
        (
            batch.write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(window)
            .parquet(path)
        )

    return write


def upsert_windows(path: str, window: str = "window_end", part: timedelta = timedelta(hours=1)) -> BatchWriter:
    """A plain table that always holds the newest rows of every window, and no folder for a batch.

    The table is partitioned by the UTC day of the window's end and by ``part`` of the day. A
    batch reads the partitions it has windows in, replaces the rows of these windows, and
    rewrites these partitions and no others. The new partitions are first written aside
    (in a folder that readers of the table do not see): a batch that is repeated
    after a failure goes on from there, so the rows of other windows cannot be lost.
    """
    day, slot = "day", "part"
    day_ms, part_ms = millis(timedelta(days=1)), millis(part)

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        end = F.col(window) - 1  # the end belongs to its window
        batch = batch.withColumn(day, F.floor(end / day_ms).cast("int"))
        batch = batch.withColumn(slot, F.floor(F.pmod(end, F.lit(day_ms)) / part_ms).cast("int")).persist()
        aside = f"{path}/_aside/batch={batch_id}"
        try:
            if not exists(spark, f"{aside}/_SUCCESS"):
                # As many rows as the batch has hours.
                touched = [(r[day], r[slot]) for r in batch.select(day, slot).distinct().collect()]
                if not touched and exists(spark, path):
                    return
                rows, there = batch, [f"{path}/{day}={d}/{slot}={k}" for d, k in touched]
                there = [folder for folder in there if exists(spark, folder)]
                if there:
                    kept = spark.read.schema(batch.schema).option("basePath", path).parquet(*there)
                    kept = kept.join(batch.select(window).distinct(), window, "left_anti")
                    rows = kept.select(*batch.columns).unionByName(batch)
                rows.repartition(F.col(day), F.col(slot)).write.mode("overwrite").partitionBy(day, slot).parquet(aside)
            made = spark.read.schema(batch.schema).parquet(aside)
            made = made.repartition(F.col(day), F.col(slot)).write.mode("overwrite")
            made.option("partitionOverwriteMode", "dynamic").partitionBy(day, slot).parquet(path)
            remove(spark, f"{path}/_aside/batch={batch_id - 1}")
        finally:
            batch.unpersist()

    return write


def read_windows(spark: SparkSession, path: str) -> DataFrame:
    """The table of ``upsert_windows`` without its partition columns."""
    return spark.read.parquet(path).drop("day", "part")


def write_top_n(
    path: str,
    n: int,
    key: str,
    shape: Callable[[DataFrame], DataFrame] | None = None,
    keep: BatchWriter | None = None,
) -> BatchWriter:
    """Top-N of the windows a batch hands on, brought into another ``shape`` if given.

    Rows are kept batch by batch, or by ``keep``.

    All keys of a window come in one batch, so the operator on tables applies as it
    is, with its cut before the exchange.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        top = top_n_per_window(batch, n, key)
        (keep or write_rows(path))(shape(top) if shape else top, batch_id)

    return write


def latest_rows(table: DataFrame, window: str = "window_end") -> DataFrame:
    """Rows of the newest batch of each window, for a table of windows that are corrected."""
    newest = table.groupBy(window).agg(F.max("batch_id").alias("batch_id"))
    return table.join(newest, [window, "batch_id"], "left_semi").drop("batch_id")

