"""What the operators share: tables, intermediate results and Arrow batches of texts."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from eventide.session import shared_dir, ship_package

#: Bytes of text worked on at a time. Numpy needs some tens of bytes for each.
SLICE_BYTES = 1 << 20
#: Rows of an Arrow batch, so that a batch of long texts fits in a small worker.
BATCH_ROWS = 256


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def prepare(spark: SparkSession) -> None:
    """Settings of the operators that run numpy on Arrow batches."""
    ship_package(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))


def saved(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table in the shared folder: computed once, and safe from lost executors."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/llm/{uuid.uuid4().hex}/{name}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def byte_slices(
    texts: pa.Array, limit: int = SLICE_BYTES
) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Runs of whole texts of about ``limit`` bytes: first and last row, bytes, offsets; null is empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    n = len(texts)
    if not n:
        return
    _, offsets, data = texts.buffers()
    ends = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + n + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    first = 0
    while first < n:
        last = int(np.searchsorted(ends, ends[first] + limit, "right")) - 1
        last = min(n, max(last, first + 1))
        yield first, last, data[ends[first] : ends[last]], ends[first : last + 1] - ends[first]
        first = last


def annotate(
    rows: DataFrame,
    columns: Sequence[str],
    score: Callable[[np.ndarray, np.ndarray], Sequence],
    fields: Sequence[T.StructField],
    text: str = "text",
    keep: Callable[[pa.Table], pa.Array] | None = None,
    output: Sequence[str] | None = None,
) -> DataFrame:
    """``columns`` of ``rows`` and the ``fields`` that ``score`` finds in each text.

    ``score(bytes, offsets)`` gets whole texts and returns one sequence for
    each field. ``keep`` is a mask over the finished rows, and ``output`` names
    the columns to return.
    """
    columns = list(columns)
    schema = T.StructType([*rows.select(*columns).schema.fields, *fields])
    names = list(output or schema.names)
    from pyspark.sql.pandas.types import to_arrow_type

    kinds = [to_arrow_type(f.dataType) for f in fields]
    needed = list(dict.fromkeys([*columns, text]))

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            found = [[] for _ in fields]
            for _, _, data, offsets in byte_slices(batch.column(text)):
                for kept, values in zip(found, score(data, offsets), strict=True):
                    kept.append(values)
            arrays = [batch.column(c) for c in columns]
            for parts, kind in zip(found, kinds, strict=True):
                arrays.append(pa.chunked_array([pa.array(p, kind) for p in parts], kind).combine_chunks())
            done = pa.table(arrays, schema.names)
            if keep is not None:
                done = done.filter(keep(done))
            yield from done.select(names).to_batches()

    return rows.select(*needed).mapInArrow(run, T.StructType([schema[n] for n in names]))


# --- words -------------------------------------------------------------------

_RATIO = 0x9E3779B97F4A7C15 | 1
_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd number and of its inverse modulo 2**64."""
    if len(_powers[0]) < n:
        size = 1 << int(n - 1).bit_length()
        for k, ratio in enumerate((_RATIO, pow(_RATIO, -1, 1 << 64))):
            steps = np.full(size, ratio, np.uint64)
            steps[0] = 1
            _powers[k] = np.multiply.accumulate(steps)
    return _powers[0], _powers[1]


def mixed(h: np.ndarray) -> np.ndarray:
    """64-bit hashes with all bits stirred."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


#: Bytes with A-Z in lower case.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def word_table(pattern_excludes: Sequence[tuple[int, int]]) -> np.ndarray:
    """True for the (lower-cased) bytes of words; ranges of other bytes are excluded."""
    table = np.ones(256, bool)
    for low, high in pattern_excludes:
        table[low : high + 1] = False
    return table


def words(data: np.ndarray, offsets: np.ndarray, is_word: np.ndarray):
    """Words of lower-cased texts: starts, ends, 64-bit hashes, and how many words precede each text.

    ``data`` must be in lower case already. Words never cross texts.
    """
    n = len(data)
    inside = np.zeros(n + 1, bool)
    inside[:n] = is_word[data]
    before = np.empty(n + 1, bool)
    before[0] = False
    before[1:] = inside[:n]
    begins = inside & ~before
    ends = before & ~inside
    cuts = offsets[1:-1]
    cuts = cuts[(cuts > 0) & (cuts < n)]
    cuts = cuts[inside[cuts] & before[cuts]]
    begins[cuts] = True
    starts = np.flatnonzero(begins)
    # A text that ends inside a run of word bytes ends a word there as well.
    ends[cuts] = True
    stops = np.flatnonzero(ends)
    power, inverse = _power_tables(n + 1)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * power[:n], out=sums[1:])
    hashes = mixed((sums[stops] - sums[starts]) * inverse[starts])
    return starts, stops, hashes, np.searchsorted(starts, offsets)


def run_hashes(data: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> np.ndarray:
    """64-bit hashes of the runs of bytes from ``starts`` to ``stops``."""
    power, inverse = _power_tables(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * power[: len(data)], out=sums[1:])
    return mixed((sums[stops] - sums[starts]) * inverse[starts])
