"""Exact removal of repeated byte strings, from suffix arrays of many documents.

A byte is removed if a string of ``WINDOW`` bytes covers it that also starts earlier
(in a smaller document, or earlier in the same one). The sorted suffixes come from
the column-wise construction for collections: every round inserts one
more symbol of each string, from its end on, at the places that the Burrows-Wheeler
transform so far gives, and updates transform and common prefixes; the columns
are files that each round reads and writes in sequence (``sorted_suffixes``).

A column of the whole corpus is neither bounded nor distributed, so the strings are
pieces of documents, brought together where they can share a window at all. In
each window the smallest hashed ``GRAM``-byte string, leftmost of equal ones, is its
anchor. Equal windows have equal anchors at equal places, and neighbouring windows
that share their anchor form one piece, so every window lies in one piece, and in the
same group of pieces as all windows equal to it.

* Equal pieces are settled by hash: all but the first are removed whole. This is done
  within each task's rows before anything is sent, and once more for each bucket of
  anchors, so exact copies cost one row of a task at most.
* An anchor with different pieces is open: its pieces are cut from the texts, and the
  groups are dealt to tasks of bounded size that sort their suffixes. All pieces are
  aligned at their anchors, so the rounds insert the bytes up to the anchor, and what
  follows it (a window's length) is sorted once and stands as the last symbol. Suffixes
  whose common prefix has a window's length are equal windows.
* An anchor with more than ``HOT`` different pieces (a common line between other lines)
  would not fit one task. Its windows are taken one by one and grouped by their
  hash with a combining aggregate.

Defined cases: a null text is empty. Rows without an id take no part and keep their
text. Rows with equal id and text are treated alike and do not remove each other's
bytes; equal ids with different texts follow each other by text hash. Texts shorter
than a window lose nothing. Other columns are not read.
"""

from __future__ import annotations

import tempfile
from contextlib import ExitStack

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventide.llm.common import _power_tables, byte_slices, mixed, prepare, saved

WINDOW = 100
GRAM = 32
BLOCK = 1 << 16  # window starts handled in one numpy step
FLUSH = 1 << 18  # pieces gathered in a task before they are sent
BUCKET_BYTES = 8 << 20  # bytes of text for each bucket of anchors
HOME = 64  # different pieces of one anchor that a task sends to the anchor's bucket
HOT = 2048  # different pieces of one anchor that are sorted in one task
GROUP = 2048  # pieces whose suffixes are sorted together
MOST_TASKS = 20_000

_PLAIN, _MARKED, _MOVED, _SETTLED = range(4)
_PIECE = np.dtype([("h", "<u4"), ("f", "<u8"), ("id", "<i8"), ("row", "<i8"), ("at", "<u4"), ("n", "u1"), ("o", "u1"), ("flag", "u1")])


# --- anchors -----------------------------------------------------------------------


def pieces(data: np.ndarray, offsets: np.ndarray, window: int = WINDOW, gram: int = GRAM):
    """Pieces of texts: text number, start, number of windows, the anchor's place, and hashes of anchor and content."""
    found = []
    span = window - gram + 1
    for base in range(0, len(data), BLOCK):
        x = data[base : base + BLOCK + window - 1]
        n = len(x) - window + 1
        if n <= 0:
            break
        valid = np.zeros(n, bool)
        low = int(np.searchsorted(offsets, base, "right")) - 1
        high = int(np.searchsorted(offsets, base + n, "left"))
        for a, b in zip(offsets[low:high].tolist(), offsets[low + 1 : high + 1].tolist(), strict=True):
            valid[max(0, a - base) : max(0, b - window + 1 - base)] = True
        starts = np.flatnonzero(valid)
        if not len(starts):
            continue
        power, inverse = _power_tables(BLOCK + window)
        sums = np.zeros(len(x) + 1, np.uint64)
        np.cumsum((x.astype(np.uint64) + np.uint64(1)) * power[: len(x)], out=sums[1:])
        grams = mixed((sums[gram:] - sums[:-gram]) * inverse[: len(sums) - gram])
        # Hash and place in one number: the smallest one tells the leftmost smallest hash.
        bits = np.uint64((1 << 20) - 1)
        least = (grams & ~bits) | np.arange(len(grams), dtype=np.uint64)
        width = 1
        while width < span:
            step = min(width, span - width)
            least = np.minimum(least[:-step], least[step:])
            width += step
        place = (least[starts] & bits).astype(np.int64)
        new = np.ones(len(starts), bool)
        new[1:] = (place[1:] != place[:-1]) | (starts[1:] != starts[:-1] + 1)
        firsts = np.flatnonzero(new)
        count = np.diff(np.append(firsts, len(starts)))
        begin = starts[firsts]
        end = begin + count - 1 + window
        content = mixed((sums[end] - sums[begin]) * inverse[begin] + mixed(count.astype(np.uint64)))
        text = np.searchsorted(offsets, base + begin, "right") - 1
        found.append((text, base + begin - offsets[text], count, place[firsts] - begin, grams[place[firsts]], content))
    if not found:
        none = np.zeros(0, np.int64)
        return none, none, none, none, none.astype(np.uint64), none.astype(np.uint64)
    return tuple(np.concatenate(parts) for parts in zip(*found, strict=True))


def _by(rows: np.ndarray, *names: str) -> np.ndarray:
    return rows[np.lexsort([rows[n] for n in reversed(names)])]


def _repeats(rows: np.ndarray, *names: str) -> np.ndarray:
    """Whether a sorted row equals the one before in these fields."""
    out = np.zeros(len(rows), bool)
    out[1:] = np.logical_and.reduce([rows[n][1:] == rows[n][:-1] for n in names])
    return out


def _later(rows: np.ndarray, group: np.ndarray) -> np.ndarray:
    """Whether a sorted row lies at another place than the first of its group."""
    first = np.maximum.accumulate(np.where(group, 0, np.arange(len(rows))))
    return ~np.logical_and.reduce([rows[n] == rows[n][first] for n in ("id", "row", "at")])


class _Anchors:
    """Packed pieces of a task by bucket; rows (id, row, text) in, (bucket, data) out."""

    def __init__(self, buckets: int, window: int, gram: int):
        self.buckets, self.window, self.gram = buckets, window, gram

    def __call__(self, batches):
        kept, size = [], 0
        for batch in batches:
            ids, rows = batch.column("id").to_numpy(), batch.column("row").to_numpy()
            for first, _, data, offsets in byte_slices(batch.column("text")):
                text, at, n, o, h, f = pieces(data, offsets, self.window, self.gram)
                part = np.zeros(len(text), [*_PIECE.descr, ("bucket", "<i4")])
                part["id"], part["row"] = ids[first + text], rows[first + text]
                part["at"], part["n"], part["o"], part["f"], part["h"] = at, n, o, f, h & np.uint64(0xFFFFFFFF)
                part["bucket"] = (h >> np.uint64(32)) % np.uint64(self.buckets)
                kept.append(part)
                size += len(part)
            if size >= FLUSH:
                yield self.packed(np.concatenate(kept))
                kept, size = [], 0
        if size:
            yield self.packed(np.concatenate(kept))

    def packed(self, rows: np.ndarray) -> pa.RecordBatch:
        rows = _by(rows, "bucket", "h", "f", "id", "row", "at")
        same = _repeats(rows, "bucket", "h", "f")
        settled = same & _later(rows, same)
        rows["flag"][settled] = _SETTLED
        rows = rows[settled | ~same]
        # How many different pieces of its anchor came before.
        plain = rows["flag"] == _PLAIN
        anchor = np.cumsum(~_repeats(rows, "bucket", "h")) - 1
        order = np.cumsum(plain) - plain
        order -= order[np.flatnonzero(~_repeats(rows, "bucket", "h"))][anchor]
        many = np.bincount(anchor, plain) > HOME
        rows["flag"][plain & many[anchor]] = _MARKED
        rows["flag"][plain & (order >= HOME)] = _MOVED
        away = rows["flag"] >= _MOVED
        spread = mixed(rows["f"] + np.where(rows["flag"] == _SETTLED, rows["at"], 0).astype(np.uint64))
        rows["bucket"][away] = (spread[away] % np.uint64(self.buckets)).astype(np.int32)
        rows = rows[np.argsort(rows["bucket"], kind="stable")]
        numbers, firsts = np.unique(rows["bucket"], return_index=True)
        packs = []
        for a, b in zip(firsts.tolist(), np.append(firsts[1:], len(rows)).tolist(), strict=True):
            part = rows[a:b]
            # Column by column, with ids in order, so that they compress.
            part = _by(part, "id", "row", "at")
            packs.append(b"".join(np.ascontiguousarray(part[n]).tobytes() for n in _PIECE.names))
        codec = pa.Codec("zstd", compression_level=1)
        data = [len(p).to_bytes(8, "little") + codec.compress(p, asbytes=True) for p in packs]
        return pa.record_batch([pa.array(numbers, pa.int32()), pa.array(data, pa.binary())], ["bucket", "data"])


def _unpacked(packs: list[bytes]) -> np.ndarray:
    codec, out = pa.Codec("zstd"), []
    for pack in packs:
        size = int.from_bytes(pack[:8], "little")
        raw = codec.decompress(pack[8:], size, asbytes=True)
        rows = np.zeros(size // _PIECE.itemsize, _PIECE)
        low = 0
        for name in _PIECE.names:
            width = _PIECE[name].itemsize * len(rows)
            rows[name] = np.frombuffer(raw[low : low + width], _PIECE[name])
            low += width
        out.append(rows)
    return np.concatenate(out)


_STATES = "id long, row long, at long, n int, o int, state string, anchor long"


def _settle(table: pa.Table) -> pa.Table:
    """Pieces of one bucket that go (``gone``) or are open (``open``, ``hot``)."""
    rows = _unpacked(table.column("data").to_pylist())
    bucket = table.column("bucket")[0].as_py()
    state = []

    def add(part, name):
        if len(part):
            state.append((part, name))

    add(rows[rows["flag"] == _SETTLED], "gone")
    for moved in (True, False):
        part = _by(rows[(rows["flag"] == _MOVED) if moved else (rows["flag"] < _MOVED)], "h", "f", "id", "row", "at")
        if not len(part):
            continue
        same = _repeats(part, "h", "f")
        add(part[same & _later(part, same)], "gone")
        part = part[~same]
        anchor = np.cumsum(~_repeats(part, "h")) - 1
        count = np.bincount(anchor)
        hot = (np.bincount(anchor, part["flag"] != _PLAIN) > 0) | (count > HOT)
        add(part[hot[anchor]], "hot")
        add(part[(~hot & (count > 1))[anchor]], "open")
    columns = [[] for _ in range(7)]
    for part, name in state:
        anchor = (np.int64(bucket) << 32) | part["h"].astype(np.int64)
        for kept, values in zip(columns, (part["id"], part["row"], part["at"], part["n"], part["o"], None, anchor), strict=True):
            kept.append(np.full(len(part), name) if values is None else values)
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.string(), pa.int64()]
    arrays = [
        pa.array(np.concatenate(c).astype(k.to_pandas_dtype()) if k != pa.string() else np.concatenate(c), k)
        if c
        else pa.array([], k)
        for c, k in zip(columns, kinds, strict=True)
    ]
    return pa.table(arrays, ["id", "row", "at", "n", "o", "state", "anchor"])


# --- suffixes ----------------------------------------------------------------------


class _Columns:
    """Arrays in files that are open without a name; each is read and written as a whole, in sequence and in place."""

    def __init__(self, stack: ExitStack, **kinds: type):
        self.kinds = kinds
        self.files = {name: stack.enter_context(tempfile.TemporaryFile(buffering=0)) for name in kinds}
        self.sizes = dict.fromkeys(kinds, 0)

    def put(self, **arrays: np.ndarray) -> None:
        for name, values in arrays.items():
            self.files[name].seek(0)
            self.files[name].write(np.ascontiguousarray(values, self.kinds[name]).data)
            self.sizes[name] = len(values)

    def get(self, name: str) -> np.ndarray:
        out = np.empty(self.sizes[name], self.kinds[name])
        self.files[name].seek(0)
        self.files[name].readinto(out.data.cast("B"))
        return out


def sorted_suffixes(strings: list[bytes], tails: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """String, length, and common prefix with the one before, of all suffixes in order.

    Equal suffixes follow each other by string. ``tails`` (a row of symbols for each string)
    stand after the strings: they count in order and common prefixes as one last symbol each that
    is known by its rank, so no round is spent on them. Suffixes of one length are then in the
    order of their bytes, and what lies between two of them begins as they do. Round j places the suffixes of j
    symbols. The transform has, for every suffix placed so far, the symbol before it
    (0 where the string begins); the next suffix of a string starts with
    that symbol, and its place is that of the symbol among all symbols in stable order,
    after the empty suffixes.
    """
    n = len(strings)
    sizes = np.array([len(s) for s in strings], np.int64)
    longest = int(sizes.max(initial=0))
    symbols = np.zeros((longest + 1, n), np.uint16)  # row j: the j-th symbol from the end, from 0
    for i, s in enumerate(strings):
        symbols[: len(s), i] = np.frombuffer(s, np.uint8)[::-1].astype(np.uint16) + 1
    first, shared = np.arange(n), np.zeros(n, np.int16)
    if tails is not None and n:
        first = np.lexsort(tails.T[::-1])
        differ = tails[first[1:]] != tails[first[:-1]]
        shared[1:] = np.where(differ.any(1), differ.argmax(1), tails.shape[1])
    with ExitStack() as stack:
        files = _Columns(stack, bwt=np.uint16, lcp=np.int16, who=np.int32, size=np.int16)
        files.put(bwt=symbols[0][first], lcp=shared, who=first, size=np.zeros(n))
        pending = np.empty(n, np.int64)
        pending[first] = np.arange(n)
        for j in range(1, longest + 1):
            active = np.flatnonzero(sizes >= j)
            bwt = files.get("bwt")
            known = np.flatnonzero(bwt)
            order = known[np.argsort(bwt[known], kind="stable")]  # place k after the empty suffixes
            place = np.zeros(len(bwt), np.int64)
            place[order] = np.arange(n, n + len(order))
            new = place[pending[active]]
            old = np.ones(n + len(order), bool)
            old[new] = False

            def merged(values, inserted, old=old, new=new):
                out = np.empty(len(old), values.dtype)
                out[old] = values
                out[new] = inserted
                return out

            lcp = files.get("lcp")
            # The new suffixes and those after them have new neighbours before them.
            k = np.unique(np.concatenate([new, new + 1])) - n
            k = k[k < len(order)]
            here, before = order[k], order[np.maximum(k - 1, 0)]
            alike = (k > 0) & (bwt[here] == bwt[before])
            fresh = np.zeros(len(k), np.int16)
            if alike.any():
                bounds = np.stack([before[alike] + 1, here[alike] + 1], 1).ravel()
                low = np.minimum.reduceat(np.append(lcp, 0), bounds)[::2]
                fresh[alike] = low + 1
            lcp = merged(lcp, 0)
            lcp[k + n] = fresh
            files.put(
                bwt=merged(bwt, symbols[j][active]),
                lcp=lcp,
                who=merged(files.get("who"), active),
                size=merged(files.get("size"), j),
            )
            pending[active] = new
        return files.get("who"), files.get("size"), files.get("lcp")


_SPANS = "id long, row long, at long, stop long"


class _Sort:
    """Repeated windows among the pieces of a task, as spans."""

    def __init__(self, window: int):
        self.window = window

    def __call__(self, table: pa.Table) -> pa.Table:
        # One order for equal content, whatever order the rows come in.
        table = table.sort_by([(n, "ascending") for n in ("anchor", "id", "row", "at")])
        heads, tails = table.column("head").to_pylist(), table.column("tail").to_pylist()
        ids, rows, starts, windows = (table.column(n).to_numpy() for n in ("id", "row", "at", "n"))
        matrix = np.zeros((len(tails), self.window - 1), np.uint16)  # 0 after the end of a document
        for i, tail in enumerate(tails):
            matrix[i, : len(tail)] = np.frombuffer(tail, np.uint8).astype(np.uint16) + 1
        who, size, lcp = sorted_suffixes(heads, matrix)
        group = np.cumsum(lcp < self.window)
        place = np.array([len(h) for h in heads], np.int64)[who] - size
        # The other suffixes have no window, or one that belongs to another piece.
        own = (size > 0) & (place < windows[who])
        group, who, at = group[own], who[own], starts[who[own]] + place[own]
        ids, rows = ids[who], rows[who]
        order = np.lexsort((at, rows, ids, group))
        group, ids, rows, at = group[order], ids[order], rows[order], at[order]
        first = np.ones(len(group), bool)
        first[1:] = group[1:] != group[:-1]
        lead = np.maximum.accumulate(np.where(first, np.arange(len(group)), 0))
        gone = (ids != ids[lead]) | (rows != rows[lead]) | (at != at[lead])
        return _merge(ids[gone], rows[gone], at[gone], self.window)


def _merge(ids, rows, at, window) -> pa.Table:
    """Windows that follow each other by one byte as one span."""
    order = np.lexsort((at, rows, ids))
    ids, rows, at = ids[order], rows[order], at[order]
    new = np.ones(len(at), bool)
    new[1:] = (ids[1:] != ids[:-1]) | (rows[1:] != rows[:-1]) | (at[1:] > at[:-1] + 1)
    firsts = np.flatnonzero(new)
    lasts = np.append(firsts[1:], len(at)) - 1 if len(at) else firsts
    return pa.table(
        [pa.array(ids[firsts]), pa.array(rows[firsts]), pa.array(at[firsts]), pa.array(at[lasts] + window)],
        ["id", "row", "at", "stop"],
    )


# --- the operator ----------------------------------------------------------------------


def _cut(batches, window=WINDOW):
    """Open pieces as the bytes up to their anchor (head) and a window's length from there (tail);
    the windows of hot ones one by one."""
    for batch in batches:
        out = [[] for _ in range(8)]
        found = batch.column("found").to_pylist()
        for i, (text, row) in enumerate(zip(batch.column("text").to_pylist(), found, strict=True)):
            raw = text.encode()
            for p in row:
                at, n, hot = p["at"], p["n"], p["state"] == "hot"
                for k in range(n if hot else 1):
                    cut = at + k + window if hot else at + p["o"] + 1
                    name = (batch.column("id")[i].as_py(), batch.column("row")[i].as_py(), at + k, n)
                    values = (*name, hot, p["anchor"], raw[at + k : cut], b"" if hot else raw[cut : cut + window - 1])
                    for kept, value in zip(out, values, strict=True):
                        kept.append(value)
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.bool_(), pa.int64(), pa.binary(), pa.binary()]
        names = ["id", "row", "at", "n", "hot", "anchor", "head", "tail"]
        yield pa.record_batch([pa.array(c, k) for c, k in zip(out, kinds, strict=True)], names)


def repeated_spans(docs: DataFrame, window: int = WINDOW, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Removed spans (``at``, ``stop``) of the rows (``id``, text hash ``row``); they may overlap."""
    prepare(docs.sparkSession)
    rows = _rows(docs, doc_id, text).where(f"id IS NOT NULL AND octet_length(text) >= {window}")
    size = rows.agg(F.sum(F.octet_length("text").cast("long")).alias("n")).first().n or 0
    buckets = max(1, -(-size // BUCKET_BYTES))
    gram = min(GRAM, window)
    packs = rows.mapInArrow(_Anchors(buckets, window, gram), "bucket int, data binary")
    packs = packs.repartition(min(buckets, MOST_TASKS), "bucket")
    states = saved(packs.groupBy("bucket").applyInArrow(_settle, _STATES), "pieces")
    gone = states.where("state = 'gone'").select("id", "row", "at", (F.col("at") + F.col("n") - 1 + window).alias("stop"))
    left = states.where("state <> 'gone'")
    left = left.groupBy("id", "row").agg(F.collect_list(F.struct("at", "n", "o", "state", "anchor")).alias("found"))
    texts = rows.join(left, ["id", "row"]).dropDuplicates(["id", "row"]).select("id", "row", "text", "found")
    cut = lambda batches: _cut(batches, window)
    schema = "id long, row long, at long, n int, hot boolean, anchor long, head binary, tail binary"
    cuts = saved(texts.mapInArrow(cut, schema), "cuts")
    # Pieces of one anchor stay together; tasks get about GROUP of them.
    cold = cuts.where("NOT hot").drop("hot")
    tasks = max(1, -(-cold.count() // GROUP))
    cold = cold.withColumn("task", F.pmod(F.xxhash64("anchor"), F.lit(tasks)))
    sort = _Sort(window)
    # The work of a task is in its rounds, not its bytes: partitions are not to be merged by size.
    cold = cold.repartition(min(tasks, MOST_TASKS), "task")
    sorted_spans = cold.groupBy("task").applyInArrow(lambda table: sort(table), _SPANS)
    place = F.struct("id", "row", "at")
    hot = cuts.where("hot").select(F.sha2("head", 256).alias("name"), place.alias("place"))
    firsts = hot.groupBy("name").agg(F.min("place").alias("first"), F.count("*").alias("times")).where("times > 1")
    hot_spans = hot.join(firsts, "name").where("place > first").select("place.*")
    hot_spans = hot_spans.withColumn("stop", F.col("at") + window)
    return gone.unionByName(sorted_spans).unionByName(hot_spans)


def _rows(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    return docs.select(F.col(doc_id).alias("id"), F.xxhash64(F.col(text)).alias("row"), F.col(text).alias("text"))


class _Keep:
    """Maximal removed runs of each text, and the bytes that are left."""

    def __call__(self, batches):
        for batch in batches:
            runs, left, sizes = [], [], []
            texts = batch.column("text").to_pylist()
            for text, spans in zip(texts, batch.column("found").to_pylist(), strict=True):
                raw = (text or "").encode()
                merged = []
                for span in sorted((s["at"], s["stop"]) for s in spans or ()):
                    if merged and span[0] <= merged[-1][1]:
                        merged[-1][1] = max(merged[-1][1], span[1])
                    else:
                        merged.append(list(span))
                end, parts = 0, []
                for a, b in merged:
                    parts.append(raw[end:a])
                    end = b
                parts.append(raw[end:])
                runs.append([{"start": a, "stop": b} for a, b in merged])
                left.append(b"".join(parts))
                sizes.append(len(raw))
            kind = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))
            yield pa.record_batch(
                [batch.column("id"), pa.array(sizes, pa.int64()), pa.array(runs, kind), pa.array(left, pa.binary())],
                ["id", "n_bytes", "removed", "kept"],
            )


def remove_repeats(docs: DataFrame, window: int = WINDOW, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row ``doc_id``, ``n_bytes``, ``removed`` runs [start, stop) in bytes, and the ``kept`` bytes."""
    spans = repeated_spans(docs, window, doc_id, text)
    spans = saved(
        spans.groupBy("id", "row").agg(F.collect_list(F.struct("at", "stop")).alias("found")), "spans"
    ).withColumnsRenamed({"id": "_id", "row": "_row"})
    rows = _rows(docs, doc_id, text)
    joined = rows.join(spans, (rows.id == spans._id) & (rows.row == spans._row), "left").select("id", "text", "found")
    schema = T.StructType(
        [
            joined.schema["id"],
            T.StructField("n_bytes", T.LongType()),
            T.StructField(
                "removed",
                T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("stop", T.LongType())])),
            ),
            T.StructField("kept", T.BinaryType()),
        ]
    )
    return joined.mapInArrow(_Keep().__call__, schema).withColumnRenamed("id", doc_id)
