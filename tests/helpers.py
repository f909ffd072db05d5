"""Small inputs and plain-Python answers."""

from collections import Counter
from datetime import timedelta

from pyspark.sql import functions as F

MINUTE = timedelta(minutes=1)


def ms(duration):
    return duration // timedelta(milliseconds=1)


def at_seconds(spark, rows, columns):
    """Rows whose last field is a time in seconds, which becomes ``ts``."""
    df = spark.createDataFrame(rows, columns[:-1] + ["t"]) if rows else None
    return df.withColumn("ts", (F.col("t") * 1).cast("timestamp")).drop("t")


def sliding(rows, size, slide):
    """Count per (key, window end) of (key, milliseconds) rows, window by window."""
    size, slide = ms(size), ms(slide)
    counts = Counter()
    for key, at in rows:
        first = at // slide * slide + slide
        for end in range(first, first + size - slide + 1, slide):
            counts[key, end] += 1
    return dict(counts)


def pairs(df, *columns):
    return sorted(tuple(row[c] for c in columns) for row in df.collect())


def match_orders(events, deadline):
    """Messages of one order's (time, step) events by adjacency."""
    events, out, i = sorted(events), [], 0
    while i < len(events):
        at, step = events[i]
        if step == 1:
            out.append("already payed but not found create log")
        elif i + 1 < len(events) and events[i + 1][1] == 1:
            in_time = events[i + 1][0] < at + deadline
            out.append("payed successfully" if in_time else "payed but already timeout")
            i += 1
        else:
            out.append("order timeout")
        i += 1
    return out


def warn_orders(events, deadline):
    """Messages of one order's (time, step) events, creation by creation."""
    creates = [at for at, step in events if step == 0]
    pays = [at for at, step in events if step == 1]
    out = []
    for at in creates:
        if any(at - deadline <= p < at for p in pays):
            continue
        paid = any(at <= p <= at + deadline for p in pays)
        out.append("order payed successfully" if paid else "order timeout")
    return out
