import random
from datetime import timedelta

import pytest
from helpers import match_orders, warn_orders
from pyspark.sql import functions as F

from eventide.operators import orders

TYPES = ("create", "pay")
DEADLINE_S = 900
BASE = 1511658000


def events(spark, rows):
    df = spark.createDataFrame(rows, "order_id long, event_type string, at long")
    return df.withColumn("ts", F.timestamp_seconds("at")).drop("at")


def messages(df):
    return sorted((r.order_id, r.result_msg) for r in df.collect())


CASES = [
    ([(1, "create", 0), (1, "pay", 899)], [(1, "payed successfully")]),
    ([(2, "create", 0), (2, "pay", 900)], [(2, "payed but already timeout")]),
    ([(3, "create", 0)], [(3, "order timeout")]),
    ([(4, "pay", 10)], [(4, "already payed but not found create log")]),
    ([(5, "refund", 0)], []),
    ([(7, "pay", 5), (7, "create", 5)], [(7, "payed successfully")]),
    (
        [(8, "create", 0), (8, "create", 10), (8, "pay", 20)],
        [(8, "order timeout"), (8, "payed successfully")],
    ),
    (
        [(9, "create", 0), (9, "pay", 10), (9, "pay", 20)],
        [(9, "already payed but not found create log"), (9, "payed successfully")],
    ),
]


@pytest.mark.parametrize("rows, expected", CASES)
def test_each_case(spark, rows, expected):
    rows = [(order, kind, BASE + at) for order, kind, at in rows]
    assert messages(orders.order_pay_match(events(spark, rows))) == expected


def test_kinds(spark):
    rows = [(o, k, BASE + at) for case, _ in CASES for o, k, at in case]
    tagged = orders.order_pay_match(events(spark, rows))
    assert {r.result_msg for r in orders.payed_orders(tagged).collect()} == {"payed successfully"}
    assert "payed successfully" not in {r.result_msg for r in orders.timeout_orders(tagged).collect()}


def random_orders(seed, span):
    """Order 0 has most events; times repeat."""
    rng = random.Random(seed)
    ids = [0] * 20 + list(range(1, 30))
    return [(rng.choice(ids), rng.randrange(2), rng.randrange(span)) for _ in range(500)]


@pytest.mark.parametrize("seed, span", [(1, 300), (2, 4_000), (3, 40_000)])
@pytest.mark.parametrize("slice_s", [60, 3_600, None])
def test_match_equals_plain_reading_for_any_slice(spark, seed, span, slice_s):
    rows = random_orders(seed, span)
    df = events(spark, [(o, TYPES[s], BASE + at) for o, s, at in rows])
    slice_size = slice_s and timedelta(seconds=slice_s)
    got = messages(orders.order_pay_match(df, slice_size=slice_size))
    want = []
    for order in {o for o, _, _ in rows}:
        mine = [(at, step) for o, step, at in rows if o == order]
        want += [(order, message) for message in match_orders(mine, DEADLINE_S)]
    assert got == sorted(want)


@pytest.mark.parametrize("seed, span", [(4, 300), (5, 4_000), (6, 40_000)])
@pytest.mark.parametrize("slice_s", [900, 3_600])
def test_warning_equals_plain_reading(spark, seed, span, slice_s):
    rows = random_orders(seed, span)
    df = events(spark, [(o, TYPES[s], BASE + at) for o, s, at in rows])
    got = messages(orders.order_timeout_warning(df, slice_size=timedelta(seconds=slice_s)))
    want = []
    for order in {o for o, _, _ in rows}:
        mine = [(at, step) for o, step, at in rows if o == order]
        want += [(order, message) for message in warn_orders(mine, DEADLINE_S)]
    assert got == sorted(want)


@pytest.mark.parametrize(
    "rows, expected",
    [
        ([("create", 0), ("pay", 900)], ["order payed successfully"]),
        ([("create", 0), ("pay", 901)], ["order timeout"]),
        ([("pay", 0), ("create", 10)], []),
        ([("pay", 0), ("create", 901)], ["order timeout"]),
    ],
)
def test_warning_cases(spark, rows, expected):
    df = events(spark, [(6, kind, BASE + at) for kind, at in rows])
    assert [m for _, m in messages(orders.order_timeout_warning(df))] == expected


def test_equal_events_are_counted_before_the_exchange(spark):
    df = events(spark, [(1, "create", BASE)] * 5 + [(1, "pay", BASE)] * 3 + [(2, "pay", BASE)] * 2)
    got = orders.order_pay_match(df)
    assert messages(got) == sorted(
        [(1, "order timeout")] * 4
        + [(1, "payed successfully")]
        + [(1, "already payed but not found create log")] * 2
        + [(2, "already payed but not found create log")] * 2
    )
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert plan.rfind("partial_count") > plan.rfind("Exchange")  # the plan reads from the result down to the scan
