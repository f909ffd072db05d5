"""The daily click limit as keyed state with a lifetime."""

from __future__ import annotations

import heapq
from collections.abc import Iterator, Sequence
from datetime import timedelta

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from eventide.functions.times import millis, utc_day
from eventide.operators import limits
from eventide.session import ship_package

#: How long after its last counted click a key and day is remembered, by the clock on the wall.
LIFETIME = timedelta(days=3)
#: Rows a task holds before it cuts them down.
HELD_ROWS = 50_000


def click_limit_stream(
    clicks: DataFrame,
    limit: int,
    order: Sequence[str] | None = None,
    keys: Sequence[str] = ("user_id", "ad_id"),
    ts: str = "ts",
    lifetime: timedelta = LIFETIME,
) -> DataFrame:
    """Stream form of ``click_limit``: clicks with their ``kind``, over all batches so far.

    Clicks count in the order of micro-batches, and by ``order`` within one. A key and
    UTC day has one number of state, which goes ``lifetime`` after it was last raised:
    no event time can take it away, and no click is dropped for being late. A batch
    reads and writes the keys it holds and no others. At most ``limit + 1`` clicks of a
    key and day leave a task.

    Rows without a value in the last of the ``keys``, the ad, are no clicks. For each task a
    row comes along that has nothing but the newest time of all its rows and no ``kind``.
    """
    ship_package(clicks.sparkSession)
    by = limits.total_order(clicks.columns, order, ts)
    dated = clicks.withColumn("_day", utc_day(F.col(ts)))
    group = [*keys, "_day"]
    first = dated.mapInArrow(_first_of_each(list(keys), group, by, limit + 1, ts), dated.schema)
    output = T.StructType([*clicks.schema.fields, T.StructField("kind", T.StringType())])
    limiter = _Limiter(limit, by, list(keys), clicks.columns, millis(lifetime))
    return first.groupBy(*group).transformWithState(limiter, output, "Append", "ProcessingTime")


def _first_of_each(keys, group, by, n, ts):
    """The first ``n`` rows of each group of a task, and a row with the newest time."""

    def cut(rows: pa.Table) -> pa.Table:
        order = [(c, "ascending") for c in dict.fromkeys([*group, *by])]
        rows = rows.take(pc.sort_indices(rows, sort_keys=order, null_placement="at_start"))
        new = np.zeros(rows.num_rows, bool)
        new[:1] = True
        for c in group:
            code = pc.fill_null(pc.dictionary_encode(rows.column(c)).combine_chunks().indices, -1).to_numpy()
            new[1:] |= code[1:] != code[:-1]
        index = np.arange(len(new))
        return rows.filter(pa.array(index - np.maximum.accumulate(np.where(new, index, 0)) < n))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, newest, most = None, None, HELD_ROWS
        for batch in batches:
            latest = pc.max(batch.column(ts))
            if latest.is_valid and (newest is None or latest.as_py() > newest.as_py()):
                newest = latest
            some = pa.Table.from_batches([batch])
            some = some.filter(pc.is_valid(some.column(keys[-1])))
            held = some if held is None else pa.concat_tables([held, some])
            if held.num_rows > most:
                held = cut(held)
                most = max(HELD_ROWS, 2 * held.num_rows)
        if held is None:
            return
        yield from cut(held).to_batches()
        if newest is not None:
            time_only = [pa.array([newest.as_py()], f.type) if f.name == ts else pa.nulls(1, f.type) for f in held.schema]
            yield pa.RecordBatch.from_arrays(time_only, schema=held.schema)

    return run


class _Limiter(StatefulProcessor):
    """How many clicks a key has made on a day, up to one above the limit."""

    def __init__(self, limit: int, by: list[str], keys: list[str], columns: list[str], lifetime_ms: int):
        self.limit, self.by, self.keys, self.columns, self.lifetime_ms = limit, by, keys, columns, lifetime_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.clicks = handle.getValueState("clicks", "n long", ttlDurationMs=self.lifetime_ms)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        if key[len(self.keys) - 1] is None:
            for row in rows:
                yield Row(**{c: row[c] for c in self.columns}, kind=None)
            return
        held = self.clicks.get()
        seen = held[0] if held else 0
        in_order = lambda row: [(row[c] is not None, row[c]) for c in self.by]
        first = heapq.nsmallest(self.limit + 1 - seen, rows, key=in_order)
        if first:
            self.clicks.update((seen + len(first),))
        for nth, row in enumerate(first, seen + 1):
            kind = limits.PASSED if nth <= self.limit else limits.WARNING
            yield Row(**{c: row[c] for c in self.columns}, kind=kind)

    def close(self) -> None:
        pass
