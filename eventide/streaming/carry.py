"""What one micro-batch leaves for the next: a note, and tables kept as increments.

A batch that is repeated must read what it read before. Notes lie in two alternating
files, so batch N reads the one of batch N - 1 and writes the other. An increment is a
folder named by its batch, listed in the note of the batch that wrote it; folders are
removed only by a batch after the one whose note no longer lists them.
"""

from __future__ import annotations

import json
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Increments that are put together into one, so that few folders are read.
FOLD = 16

PARTITIONS = "spark.sql.shuffle.partitions"
#: Rows of a task. A table's number of partitions is far too large for the shuffles of a small batch.
TASK_ROWS = 50_000


@contextmanager
def partitions_for(spark: SparkSession, rows: int, task_rows: int = TASK_ROWS) -> Iterator[None]:
    """Shuffles that are planned inside have as many partitions as ``rows`` fill, and as configured at most."""
    most = spark.conf.get(PARTITIONS)
    spark.conf.set(PARTITIONS, str(max(1, min(int(most), -(-rows // task_rows)))))
    try:
        yield
    finally:
        spark.conf.set(PARTITIONS, most)


class Note:
    """A small record of a stream as a JSON file, written without a Spark job."""

    def __init__(self, folder: str):
        self.folder = folder

    def read(self, spark: SparkSession, batch_id: int) -> dict:
        """What the batch before this one has left; empty for the first one."""
        return self._slot(spark, (batch_id - 1) % 2) if batch_id else {}

    def newest(self, spark: SparkSession) -> dict:
        """The note of the last batch (``batch_id`` in it tells which); empty if there was none."""
        return max((self._slot(spark, k) for k in (0, 1)), key=lambda note: note.get("batch_id", -1))

    def _slot(self, spark: SparkSession, slot: int) -> dict:
        fs, path = _path(spark, f"{self.folder}/{slot}.json")
        if not fs.exists(path):
            return {}
        stream = fs.open(path)
        try:
            return json.loads(bytes(stream.readAllBytes()).decode())
        finally:
            stream.close()

    def write(self, spark: SparkSession, batch_id: int, values: dict) -> None:
        fs, path = _path(spark, f"{self.folder}/{batch_id % 2}.json")
        stream = fs.create(path, True)
        try:
            stream.write(bytearray(json.dumps(values).encode()))
        finally:
            stream.close()


class Increments:
    """A table of ``keys``, a time ``at`` in milliseconds among them, and columns that are summed.

    A batch writes only what it adds (or takes off, with negative numbers). Reading
    adds up the increments that reach a time. ``FOLD`` of them are rewritten as one, each
    row once, without those that add up to nothing; what lies before the time that is
    still asked for is dropped by folder.
    """

    def __init__(self, folder: str, schema: str, sums: Sequence[str], at: str):
        self.folder, self.schema, self.sums, self.at = folder, schema, list(sums), at

    def read(self, spark: SparkSession, note: dict, oldest: int | None = None) -> DataFrame:
        """The increments with rows after ``oldest``, not added up; more rows may come with them."""
        names = [p["name"] for p in note.get("parts", []) if oldest is None or p["newest"] > oldest]
        return self._rows(spark, names)

    def _rows(self, spark: SparkSession, names: Sequence[str]) -> DataFrame:
        if not names:
            return spark.createDataFrame([], self.schema)
        return spark.read.schema(self.schema).parquet(*[f"{self.folder}/{name}" for name in names])

    def append(self, rows: DataFrame, batch_id: int, newest: int | None) -> tuple[dict, DataFrame]:
        """Write an increment that has nothing after ``newest``; its entry for the note, and its rows as written."""
        name = f"batch={batch_id}"
        rows.coalesce(_files(rows)).write.mode("overwrite").parquet(f"{self.folder}/{name}")
        written = self._rows(rows.sparkSession, [name])
        return {"name": name, "newest": newest, "folded": False, "rows": written.count()}, written

    @staticmethod
    def size(note: dict, oldest: int | None = None) -> int:
        """Rows that ``read`` has."""
        parts = note.get("parts", [])
        return sum(p.get("rows", 0) for p in parts if oldest is None or p["newest"] > oldest)

    def listed(self, spark: SparkSession, batch_id: int, note: dict, entry: dict, oldest: int) -> dict:
        """Parts of the next note: those with rows after ``oldest``, folded if they are many."""
        for name in note.get("dropped", []):
            remove(spark, f"{self.folder}/{name}")
        before = note.get("parts", [])
        parts = [p for p in [*before, entry] if p["newest"] is not None and p["newest"] > oldest]
        small = [p for p in parts if not p["folded"]]
        if len(small) >= FOLD:
            keys = [c for c in self._rows(spark, []).columns if c not in self.sums]
            total = self._rows(spark, [p["name"] for p in small]).where(F.col(self.at) > oldest).groupBy(*keys)
            total = total.agg(*[F.sum(s).alias(s) for s in self.sums]).where(_any_of(self.sums))
            name = f"fold={batch_id}"
            total.hint("rebalance").write.mode("overwrite").parquet(f"{self.folder}/{name}")
            parts = [p for p in parts if p["folded"]]
            rows = self._rows(spark, [name]).count()
            parts.append({"name": name, "newest": max(p["newest"] for p in small), "folded": True, "rows": rows})
        kept = {p["name"] for p in parts}
        dropped = [p["name"] for p in [*before, entry] if p["name"] not in kept]
        return {"parts": parts, "dropped": dropped}


def _any_of(columns: Sequence[str]) -> Column:
    found = F.lit(False)
    for c in columns:
        found |= F.col(c) != 0
    return found


def _files(rows: DataFrame) -> int:
    """Files of an increment: a quarter of the tasks, since a batch is small."""
    return max(1, int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")) // 4)


def _path(spark: SparkSession, name: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(name)
    return path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), path


def exists(spark: SparkSession, name: str) -> bool:
    fs, path = _path(spark, name)
    return fs.exists(path)


def remove(spark: SparkSession, name: str) -> None:
    """Remove a folder of this library's own tables, if it is there."""
    fs, path = _path(spark, name)
    fs.delete(path, True)


def newest_time(batch: DataFrame, ts: str = "ts") -> tuple[int | None, int]:
    """Newest event time of a batch in epoch milliseconds (None if it has no row with a time), and its rows."""
    found = batch.agg(F.unix_millis(F.max(ts)).alias("newest"), F.count("*").alias("rows")).first()
    return found.newest, found.rows


def later(*times: int | None) -> int | None:
    """The newest of some times, of which any may be unknown."""
    return max((t for t in times if t is not None), default=None)
