"""Matching of order creations and payments within a deadline.

Events of an order are read by time in milliseconds, a creation before a
payment of the same time; other event types are left out.
"""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventide.functions.times import floor_to, millis

CREATE = "create"
PAY = "pay"

PAYED = "payed"  # main output
TIMEOUT = "timeout"  # side output

# Messages of the result rows, fixed values.
MATCHED = "payed successfully"
LATE = "payed but already timeout"
NO_CREATE = "already payed but not found create log"
NOT_PAYED = "order timeout"
WARN_PAYED = "order payed successfully"
WARN_TIMEOUT = "order timeout"

DEADLINE = timedelta(minutes=15)
# Length of the time slices a single order's events are split into.
SLICE = timedelta(hours=1)


def order_pay_match(
    events: DataFrame, deadline: timedelta = DEADLINE, slice_size: timedelta | None = SLICE
) -> DataFrame:
    """One row per matched pair and per unmatched event: ``order_id, kind, result_msg``.

    A creation directly followed by a payment is a pair, in time if the payment
    comes before the deadline. Any other creation timed out; any other payment
    has no creation.

    An order id may hold a large share of all rows (a placeholder id, say), so
    equal events are counted first, and neighbours are looked up in two rounds. The first is per order and time
    slice and settles every row that has both neighbours in its slice. The
    second links the slices: only the first and last row of each slice meet
    per order. ``slice_size=None`` does it in one round, with one exchange less,
    for data known to have few events per order.
    """
    told = matched_steps(counted_steps(events), deadline, slice_size).where(F.col("result_msg").isNotNull())
    return repeated(told, "order_id", kind_of(F.col("result_msg")).alias("kind"), "result_msg")


def matched_steps(
    counted: DataFrame, deadline: timedelta = DEADLINE, slice_size: timedelta | None = SLICE
) -> DataFrame:
    """Messages of counted events: ``order_id, at, step, result_msg, times, waits, last``.

    Of equal creations all but the last are followed by one, of equal payments all
    but the first come after one; so a counted row has two messages at most.
    ``waits`` is 1 for the event that might still find a counterpart, and ``last``
    tells whether no event of its order follows.
    """
    if slice_size is None:
        linked = _with_neighbours(counted, ["order_id"])
    else:
        rows = counted.withColumn("slice", floor_to(F.col("at"), slice_size))
        inner = _with_neighbours(rows, ["order_id", "slice"]).withColumn(
            "inside", F.when(F.col("before").isNotNull() & F.col("after").isNotNull(), F.col("slice"))
        )
        outer = Window.partitionBy("order_id", "inside").orderBy("at", "step")
        linked = inner.select(
            "order_id",
            "at",
            "step",
            "n",
            F.coalesce("before", F.lag(_event()).over(outer)).alias("before"),
            F.coalesce("after", F.lead(_event()).over(outer)).alias("after"),
        )

    is_create, last = F.col("step") == 0, F.col("after").isNull()
    followed = is_create & (F.col("after.step") == 1)
    in_time = F.col("after.at") < F.col("at") + millis(deadline)
    message = (
        F.when(followed & in_time, MATCHED)
        .when(followed, LATE)
        .when(is_create, NOT_PAYED)
        # A payment after a creation is reported with that creation.
        .when(F.col("before.step").isNull() | (F.col("before.step") == 1), NO_CREATE)
    )
    alone = F.when(is_create, NOT_PAYED).otherwise(NO_CREATE)
    told = F.array(
        F.struct(message.alias("result_msg"), F.lit(1).cast("long").alias("times"), F.lit(1).cast("long").alias("waits"), last.alias("last")),
        F.struct(alone.alias("result_msg"), (F.col("n") - 1).alias("times"), F.lit(0).cast("long").alias("waits"), F.lit(False).alias("last")),
    )
    told = linked.select("order_id", "at", "step", F.explode(told).alias("m"))
    return told.select("order_id", "at", "step", "m.*").where(F.col("times") > 0)


def order_timeout_warning(
    events: DataFrame, deadline: timedelta = DEADLINE, slice_size: timedelta = SLICE
) -> DataFrame:
    """One row per waiting creation: ``order_id, result_msg``.

    A creation is answered at its deadline: paid if a payment came from its own
    time up to and including the deadline, else timed out. A creation whose
    payment came first, at most one deadline earlier, is left out.

    Looks back and ahead by one deadline only, so events are grouped per order
    and time slice; a payment is copied to the slices it can reach.
    """
    if deadline > slice_size:
        raise ValueError("a slice must be at least as long as the deadline")
    return repeated(warned_steps(counted_steps(events), deadline, slice_size), "order_id", "result_msg")


def warned_steps(
    counted: DataFrame, deadline: timedelta = DEADLINE, slice_size: timedelta = SLICE
) -> DataFrame:
    """Messages of counted creations: ``order_id, at, result_msg, times``."""
    if deadline > slice_size:
        raise ValueError("a slice must be at least as long as the deadline")
    at, wait = F.col("at"), millis(deadline)
    reach = F.when(F.col("step") == 0, F.array(floor_to(at, slice_size))).otherwise(
        F.sequence(
            floor_to(at - wait, slice_size),
            floor_to(at + wait, slice_size),
            F.lit(millis(slice_size)),
        )
    )
    placed = counted.select("order_id", "at", "step", "n", F.explode(reach).alias("slice"))

    group = Window.partitionBy("order_id", "slice")
    pay_time = F.when(F.col("step") == 1, F.col("at"))
    so_far = Window.unboundedPreceding, Window.currentRow
    forwards = group.orderBy("at", "step").rowsBetween(*so_far)
    # The same group read backwards: a running value instead of a frame per row.
    backwards = group.orderBy(F.desc("at"), F.desc("step")).rowsBetween(*so_far)
    message = F.when(F.col("next_pay") <= at + wait, WARN_PAYED).otherwise(WARN_TIMEOUT)
    return (
        placed.select(
            "order_id",
            "at",
            "step",
            "n",
            F.max(pay_time).over(forwards).alias("last_pay"),
            F.min(pay_time).over(backwards).alias("next_pay"),
        )
        .where(F.col("step") == 0)
        .where(F.col("last_pay").isNull() | (F.col("last_pay") < at - wait))
        .select("order_id", "at", message.alias("result_msg"), F.col("n").alias("times"))
    )


def repeated(told: DataFrame, *columns: Column | str) -> DataFrame:
    """``columns`` of each row, ``times`` times."""
    each = told.select(*columns, F.explode(F.sequence(F.lit(1), F.col("times"))).alias("_nth"))
    return each.drop("_nth")


def kind_of(message: Column) -> Column:
    """Output a message belongs to."""
    return F.when(message == MATCHED, PAYED).when(message.isNotNull(), TIMEOUT)


def payed_orders(tagged: DataFrame) -> DataFrame:
    """Main output of the match."""
    return tagged.where(F.col("kind") == PAYED).drop("kind")


def timeout_orders(tagged: DataFrame) -> DataFrame:
    """Side output of the match."""
    return tagged.where(F.col("kind") == TIMEOUT).drop("kind")


def order_steps(events: DataFrame) -> DataFrame:
    """``order_id, at, step``: epoch milliseconds, and 0 for a creation or 1 for a payment."""
    step = F.when(F.col("event_type") == CREATE, 0).when(F.col("event_type") == PAY, 1)
    return events.where(F.col("event_type").isin(CREATE, PAY)).select(
        "order_id", F.unix_millis("ts").alias("at"), step.alias("step")
    )


def counted_steps(events: DataFrame) -> DataFrame:
    """How many creations or payments an order has at a time: ``order_id, at, step, n``.

    Equal events are counted before the exchange, so an order and hour have at most
    7.2 million rows, however many events they have.
    """
    return order_steps(events).groupBy("order_id", "at", "step").agg(F.count("*").alias("n"))


def _event() -> Column:
    return F.struct("at", "step")


def _with_neighbours(rows: DataFrame, group: list[str]) -> DataFrame:
    in_order = Window.partitionBy(*group).orderBy("at", "step")
    return rows.select(
        *rows.columns,
        F.lag(_event()).over(in_order).alias("before"),
        F.lead(_event()).over(in_order).alias("after"),
    )
