"""Lines of files that are still written to, as a stream: each appended line is read once.

Spark's file source takes a file as a whole and never looks at it again. Here an
offset holds the bytes taken of each file, up to a line feed. A half line at the
end waits for its rest, in the query's checkpoint as everywhere else, so a
restarted query goes on where it stopped.

Bytes are read by tasks, in splits, so one large file is shared among many. The
driver lists the folder and looks back from each file's end to the last line feed.
Paths are those that pyarrow opens: shared folders, ``hdfs://``, ``s3://``, ``gs://``.

Defined cases: an empty file or folder has no lines. Empty lines are lines. A
file that is gone is forgotten. A file that became shorter fails the query, since
its lines can no longer be told from those already read. Bytes that are no UTF-8
become U+FFFD.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from fnmatch import fnmatch

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

from eventide.session import ship_package

#: Bytes that a task reads, and bytes it holds at a time.
SPLIT_BYTES = 64 << 20
BLOCK_BYTES = 1 << 20

WAIT = "wait"
TAKE = "take"


def read_growing_lines(
    spark: SparkSession,
    path: str,
    pattern: str = "*",
    unfinished: str = WAIT,
    split_bytes: int = SPLIT_BYTES,
) -> DataFrame:
    """Lines of the files in a folder (or of one file) as a ``value`` column, with what is appended to them.

    ``unfinished="take"`` hands on a last line without a line feed as well; it is for
    files that are complete. If such a file grows after all, the rest comes as a line of its own.
    """
    if unfinished not in (WAIT, TAKE):
        raise ValueError(f"unfinished is {WAIT} or {TAKE}")
    ship_package(spark)
    spark.dataSource.register(GrowingLines)
    options = {"path": path, "pattern": pattern, "unfinished": unfinished, "splitbytes": split_bytes}
    return spark.readStream.format(GrowingLines.name()).options(**options).load()


def opened(path: str):
    """pyarrow's file system of a path, and the path in it."""
    from pyarrow import fs

    if path.startswith("file:/"):
        path = "/" + path.removeprefix("file:").lstrip("/")
    return fs.FileSystem.from_uri(path)


class GrowingLines(DataSource):
    @classmethod
    def name(cls) -> str:
        return "growing_lines"

    def schema(self) -> str:
        return "value string"

    def streamReader(self, schema) -> GrowingReader:
        return GrowingReader(self.options)


@dataclass
class Split(InputPartition):
    """Lines that start in [low, high); the lines taken of the file are in [first, end)."""

    path: str
    first: int
    low: int
    high: int
    end: int


class GrowingReader(DataSourceStreamReader):
    def __init__(self, options):
        self.path = options["path"]
        self.pattern = options.get("pattern", "*")
        self.take = options.get("unfinished", WAIT) == TAKE
        self.split_bytes = int(options.get("splitbytes", SPLIT_BYTES))

    def initialOffset(self) -> dict:
        return {}

    def latestOffset(self) -> dict:
        store, path = opened(self.path)
        ends = {}
        for info in sorted(self._files(store, path), key=lambda info: info.path):
            ends[info.path] = info.size if self.take else _after_last_line(store, info.path, info.size)
        return ends

    def partitions(self, start: dict, end: dict) -> list[Split]:
        splits = []
        for path, stop in end.items():
            first = start.get(path, 0)
            if stop < first:
                raise ValueError(f"{path} became shorter: {first} bytes were read, {stop} are left")
            for low in range(first, stop, self.split_bytes):
                splits.append(Split(path, first, low, min(low + self.split_bytes, stop), stop))
        return splits

    def read(self, partition: Split) -> Iterator:
        import pyarrow as pa

        store, _ = opened(self.path)
        with store.open_input_file(partition.path) as file:
            for lines in split_lines(file, partition):
                yield pa.record_batch([pa.array(lines, pa.string())], ["value"])

    def commit(self, end: dict) -> None:
        """Nothing is held for a batch."""

    def _files(self, store, path: str) -> list:
        from pyarrow import fs

        found = store.get_file_info(path)
        if found.type == fs.FileType.Directory:
            inside = store.get_file_info(fs.FileSelector(path))
        else:
            inside = [found]
        names = [i for i in inside if i.type == fs.FileType.File and not i.base_name.startswith((".", "_"))]
        return [i for i in names if fnmatch(i.base_name, self.pattern)]


def _after_last_line(store, path: str, size: int) -> int:
    """Where the last whole line of the first ``size`` bytes ends."""
    if not size:
        return 0
    with store.open_input_file(path) as file:
        high = size
        while high > 0:
            low = max(0, high - BLOCK_BYTES)
            file.seek(low)
            at = file.read(high - low).rfind(b"\n")
            if at >= 0:
                return low + at + 1
            high = low
    return 0


def split_lines(file, split: Split, block: int = BLOCK_BYTES) -> Iterator[list[str]]:
    """The lines of a split, some at a time. A line belongs to the split it starts in."""
    # A later split begins a byte early: the line found there, if only its line feed, is another's.
    begin = at = split.low - (split.low > split.first)
    foreign, held = begin < split.low, b""
    file.seek(at)
    while True:
        data = file.read(min(block, split.end - at))
        if not data and at < split.end:
            raise ValueError(f"{split.path} became shorter: no byte at {at}, {split.end} were there")
        at += len(data)
        held += data
        # The line after a feed at high - 1 or later starts in another split.
        stop = held.find(b"\n", max(0, split.high - 1 - begin))
        done = stop >= 0 or at >= split.end
        if stop < 0:
            stop = held.rfind(b"\n")
        if done and stop < split.high - 1 - begin and len(held) > stop + 1:
            stop = len(held)  # the unfinished last line
        if stop >= 0:
            lines = [line.removesuffix("\r") for line in held[:stop].decode("utf-8", "replace").split("\n")]
            yield lines[foreign:]
            foreign = False
            begin, held = begin + stop + 1, held[stop + 1 :]
        if done:
            return
