"""Best-fit packing of documents into sequences of several permitted lengths.

Documents are measured in words (bytes that are no ASCII blank), cut into pieces
of at most the largest length, and packed shard by shard, longest pieces first. A
piece goes into the open bin with the least room that still takes it. Where none
does, a bin is opened, of the size that costs least for each token it can be
expected to hold: the piece, and as much of the shorter pieces yet to come as
fits beside it. A sequence costs its length, a share that grows with the square of
its length (attention), and ``OVERHEAD``; long bins thus pay only where short ones
would stay part empty. When all pieces are placed, each bin shrinks to the
smallest permitted length that holds its contents.

Pieces are numbered in a table and dealt to shards by a hash of the number and what
they are, in as many shards as keep them at about ``SHARD`` pieces, so the work of a
task is bounded whatever the table's size, and equal rows are spread. A shard does not
need others: best fit leaves little room once there are some thousand pieces.

Defined cases: null, empty and blank texts have no token; they get one row without
a bin. Repeated rows are packed once each. Ties go to the smaller id, then to the
earlier piece. Other columns do not matter.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventide.llm.common import annotate, prepare, saved, word_table, words

LENGTHS = (256, 512, 1024, 2048, 4096)
OVERHEAD = 16
ATTENTION = 16_384  # length at which the square's share equals the length itself
SHARD = 16_384
IS_WORD = word_table([(0x20, 0x20), (0x09, 0x0D)])


def count_words(data: np.ndarray, offsets: np.ndarray):
    return [np.diff(words(data, offsets, IS_WORD)[3])]


def cost(length: int) -> float:
    return OVERHEAD + length + length * length / ATTENTION


def pack(sizes: Sequence[int], lengths: Sequence[int] = LENGTHS):
    """Bin and offset of each piece, given in descending order, and the final length of each bin."""
    lengths = sorted(lengths)
    longest = lengths[-1]
    # Tokens of the pieces not yet placed, by piece length.
    later = np.bincount(np.asarray(sizes, np.int64), minlength=longest + 1) * np.arange(longest + 1)
    rooms: list[list[int]] = [[] for _ in range(longest + 1)]
    open_rooms = 0  # bit r: some bin has room r
    used: list[int] = []
    bins, offsets = [], []
    for size in sizes:
        later[size] -= size
        fitting = open_rooms >> size
        if fitting:
            room = size + (fitting & -fitting).bit_length() - 1
            k = rooms[room].pop()
            if not rooms[room]:
                open_rooms &= ~(1 << room)
        else:
            room = min(
                (c for c in lengths if c >= size),
                key=lambda c: (cost(c) / (size + min(c - size, int(later[: c - size + 1].sum()))), c),
            )
            k = len(used)
            used.append(0)
        bins.append(k)
        offsets.append(used[k])
        used[k] += size
        room -= size
        if room:
            rooms[room].append(k)
            open_rooms |= 1 << room
    return bins, offsets, [next(c for c in lengths if c >= u) for u in used]


def pack_documents(
    docs: DataFrame,
    lengths: Sequence[int] = LENGTHS,
    shard: int = SHARD,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """One row per piece: ``doc_id``, ``piece``, ``start`` and ``length`` in tokens, ``bin_id``, ``offset``, ``capacity``."""
    prepare(docs.sparkSession)
    longest = max(lengths)
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    sized = annotate(rows, ["doc_id"], count_words, [T.StructField("n", T.LongType())])
    last = F.greatest(F.ceil(F.col("n") / longest).cast("int") - 1, F.lit(0))
    pieces = sized.select("doc_id", "n", F.explode(F.sequence(F.lit(0), last)).alias("piece"))
    start = F.col("piece").cast("long") * longest
    pieces = saved(
        pieces.select(
            "doc_id",
            "piece",
            start.alias("start"),
            F.least(F.col("n") - start, F.lit(longest)).alias("length"),
            F.monotonically_increasing_id().alias("nr"),
        ),
        "pieces",
    )
    shards = max(1, -(-pieces.where("length > 0").count() // shard))
    dealt = pieces.where("length > 0").withColumn("shard", F.pmod(F.xxhash64("doc_id", "piece", "length", "nr"), F.lit(shards)))
    dealt = dealt.drop("nr")
    schema = T.StructType(
        [
            *dealt.select("doc_id", "piece", "start", "length").schema.fields,
            T.StructField("bin_id", T.LongType()),
            T.StructField("offset", T.LongType()),
            T.StructField("capacity", T.LongType()),
        ]
    )

    def fill(table: pa.Table) -> pa.Table:
        order = [("length", "descending"), ("doc_id", "ascending"), ("piece", "ascending")]
        table = table.sort_by(order)
        bins, offsets, final = pack(table.column("length").to_pylist(), lengths)
        number = table.column("shard").to_numpy()[:1].astype(np.int64)[0]
        bins = np.array(bins, np.int64)
        done = table.select(["doc_id", "piece", "start", "length"])
        done = done.append_column("bin_id", pa.array((number << 32) + bins))
        done = done.append_column("offset", pa.array(offsets, pa.int64()))
        return done.append_column("capacity", pa.array(np.array(final, np.int64)[bins]))

    packed = dealt.groupBy("shard").applyInArrow(fill, schema)
    none = F.lit(None).cast("long")
    blank = pieces.where("length <= 0").select(
        "doc_id", "piece", "start", "length", none.alias("bin_id"), none.alias("offset"), none.alias("capacity")
    )
    return packed.unionByName(blank).withColumnRenamed("doc_id", doc_id)
