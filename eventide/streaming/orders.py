"""Order events in micro-batches, settled by the operators on tables.

What still waits is known to the next batch and read again with its rows, so an
event that comes late reaches its order as long as that waits, and nothing is
dropped for being late. A hot order is split by time as on tables. The table of what
waits is kept as increments: a batch writes the events it adds to it and, as negative
numbers, those it takes off.

With ascending times a row of time ``t`` may be followed by more rows of time
``t``, so what ends at ``t`` is settled by the first row after it.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eventide.functions.times import millis
from eventide.operators import orders
from eventide.streaming.carry import Increments, Note, later, newest_time, partitions_for
from eventide.streaming.sinks import BatchWriter, Handler

STEPS = "order_id long, at long, step int, n long"


def _in_batches(
    folder: str,
    settle: Callable[[DataFrame, int], tuple[DataFrame, DataFrame, DataFrame]],
    write: BatchWriter,
    reach_ms: int,
    ts: str = "ts",
) -> Handler:
    """Handler that knows a batch's events and those that wait.

    Its ``close`` settles all that waits when a bounded input has ended, as the batch after
    the last one.

    ``settle(known, now)`` returns result rows, the events that wait on, and the table that both
    are read from, which is kept while they are. Nothing waits ``reach_ms`` past its time.
    """
    waiting, notes = Increments(f"{folder}/waiting", STEPS, ["n"], "at"), Note(f"{folder}/notes")

    def handle(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        try:
            match(batch, batch_id)
        finally:
            batch.unpersist()

    def match(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        note = notes.read(spark, batch_id)
        newest, rows = newest_time(batch, ts)
        now = later(note.get("seen"), newest)
        with partitions_for(spark, rows + waiting.size(note)):
            parts = matched(batch, batch_id, note, now)
        notes.write(spark, batch_id, {"batch_id": batch_id, "seen": now, **parts})

    def matched(batch: DataFrame, batch_id: int, note: dict, now: int | None) -> dict:
        spark, clock = batch.sparkSession, now if now is not None else 0
        old = waiting.read(spark, note).groupBy("order_id", "at", "step").agg(F.sum("n").alias("n")).where("n > 0")
        known = orders.counted_steps(batch).withColumn("was", F.lit(0).cast("long"))
        known = known.unionByName(old.withColumn("was", F.col("n"))).groupBy("order_id", "at", "step")
        known = known.agg(F.sum("n").alias("n"), F.sum("was").alias("was")).persist()
        try:
            told, on, both = settle(known.drop("was"), clock)
            both.persist()
            write(told, batch_id)
            change = known.select("order_id", "at", "step", (-F.col("was")).alias("n")).unionByName(on)
            change = change.groupBy("order_id", "at", "step").agg(F.sum("n").alias("n")).where("n <> 0")
            entry, _ = waiting.append(change, batch_id, now)
            both.unpersist()
        finally:
            known.unpersist()
        return waiting.listed(spark, batch_id, note, entry, clock - reach_ms - 1)

    def close(spark: SparkSession) -> None:
        note = notes.newest(spark)
        if note.get("seen") is None:
            return
        old = waiting.read(spark, note).groupBy("order_id", "at", "step").agg(F.sum("n").alias("n")).where("n > 0")
        told, *_ = settle(old, note["seen"] + 2 * reach_ms + 1)
        write(told, note["batch_id"] + 1)

    return Handler(handle, close)


def order_pay_match_in_batches(
    folder: str, write: BatchWriter, deadline: timedelta = orders.DEADLINE
) -> Handler:
    """Stream form of ``order_pay_match``.

    A pair is reported once both events are there, a creation without payment when a
    row past its deadline has come, and a payment without creation when a row
    past its own time has. An event whose counterpart was reported before stands alone.
    """

    def settle(known: DataFrame, now: int) -> tuple[DataFrame, DataFrame, DataFrame]:
        told = orders.matched_steps(known, deadline)
        # A creation that nothing follows yet waits for a payment, and a payment for a
        # creation that comes late.
        create = (F.col("step") == 0) & F.col("last") & (F.col("at") + millis(deadline) >= now)
        pay = (F.col("result_msg") == orders.NO_CREATE) & (F.col("at") >= now)
        waits = (F.col("waits") > 0) & (create | F.coalesce(pay, F.lit(False)))
        settled = told.where(~waits & F.col("result_msg").isNotNull())
        kind = orders.kind_of(F.col("result_msg")).alias("kind")
        on = told.where(waits).select("order_id", "at", "step", F.col("waits").alias("n"))
        return orders.repeated(settled, "order_id", kind, "result_msg"), on, told

    return _in_batches(folder, settle, write, millis(deadline))


def order_timeout_warning_in_batches(
    folder: str, write: BatchWriter, deadline: timedelta = orders.DEADLINE
) -> Handler:
    """Stream form of ``order_timeout_warning``: a creation is answered by the first row past its deadline.

    Payments are kept for two deadlines, as long as a waiting creation may ask for them.
    """
    wait = millis(deadline)

    def settle(known: DataFrame, now: int) -> tuple[DataFrame, DataFrame, DataFrame]:
        told = orders.warned_steps(known, deadline).where(F.col("at") + wait < now)
        at: Column = F.col("at")
        still = F.when(F.col("step") == 0, at + wait >= now).otherwise(at + 2 * wait >= now)
        return orders.repeated(told, "order_id", "result_msg"), known.where(still), known

    return _in_batches(folder, settle, write, 2 * wait)
