"""Benchmark passages in documents, found with a prefix-filtered set join.

Items and documents are words. A window is ``width`` consecutive words of an
item (the whole item, if it has fewer). For exact containment of a window its
filtering prefix is a single token: the one that is rarest over all documents.
Documents are joined with windows on that token, at the positions where the
token stands in both, so that the window must lie inside the document. Windows
with one token, position and length are told apart by hash, so a token that many
windows share costs no more; what is left is compared word by word.

The items are taken in blocks of bounded size, so an index of windows that goes
to the tasks never grows with the item table; every block is held against all
documents, and with several blocks the findings are merged by document.

Defined cases: a null or empty text has no words and is never hit. An item
without words is no window. Equal items are both reported. Rows of documents
with equal ids stay rows of their own unless there are several blocks, where
they are told apart by their text. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventide.llm.common import LOWER, _power_tables, annotate, byte_slices, mixed, prepare, saved, word_table, words

WIDTH = 10
#: Bytes of item texts of one block; an item of more is cut at this many words, overlapping by a window.
BLOCK_BYTES = 8 << 20
BLOCK_WORDS = 1 << 20
#: Pairs of a place and a kind of windows that are looked at together.
PAIRS = 1 << 18
IS_WORD = word_table([(0x00, 0x2F), (0x3A, 0x60), (0x7B, 0x7F)])

_SPAN = T.StructType([T.StructField("start", T.LongType()), T.StructField("stop", T.LongType())])
FIELDS = [
    T.StructField("n_words", T.LongType()),
    T.StructField("spans", T.ArrayType(_SPAN)),
    T.StructField("items", T.ArrayType(T.LongType())),
]


def find_passages(
    docs: DataFrame,
    benchmark: DataFrame,
    width: int = WIDTH,
    doc_id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
) -> DataFrame:
    """Per document ``n_words``, ``spans`` of hit words [start, stop) and the ``items`` that hit it."""
    prepare(docs.sparkSession)
    docs = docs.select(doc_id, text)
    blocks = _blocks(benchmark, width, item_id, item_text)
    block, following, parts = next(blocks), next(blocks, None), []
    if following is None:
        return annotate(docs, [doc_id], Scan(_index(docs, block, width, text)), FIELDS, text)
    while block is not None:
        scan = Scan(_index(docs, block, width, text))
        # Written at once, so that one index at a time is held.
        parts.append(saved(annotate(docs, [doc_id, text], scan, FIELDS, text), f"block{len(parts)}"))
        block, following = following, next(blocks, None)
    return _merged(parts, doc_id, text)


def clean_documents(
    docs: DataFrame, benchmark: DataFrame, width: int = WIDTH, text: str = "text"
) -> DataFrame:
    """Rows of ``docs`` with no word inside a benchmark window, all columns as they were."""
    prepare(docs.sparkSession)
    import pyarrow.compute as pc

    columns = docs.columns
    out = docs.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(columns)])
    names, at = out.columns, f"c{columns.index(text)}"
    for k, block in enumerate(_blocks(benchmark, width, "item_id", "text")):
        clean = lambda done: pc.equal(pc.list_value_length(done.column("spans")), 0)
        scan = Scan(_index(docs.select(text), block, width, text))
        out = saved(out, f"left{k}") if k else out
        out = annotate(out, names, scan, FIELDS, at, keep=clean, output=names)
    return out.toDF(*columns)


def _merged(parts: list[DataFrame], doc_id: str, text: str) -> DataFrame:
    """Findings of several blocks by document."""
    key = F.sha2(F.coalesce(F.col(text), F.lit("")), 256)
    rows = None
    for k, part in enumerate(parts):
        part = part.select(F.col(doc_id), key.alias("_key"), *[f.name for f in FIELDS], F.lit(k).alias("_block"))
        rows = part if rows is None else rows.unionByName(part)
    merged = rows.groupBy(doc_id, "_key").agg(
        F.first("n_words").alias("n_words"),
        F.array_sort(F.flatten(F.collect_list("spans"))).alias("spans"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
        F.sum((F.col("_block") == 0).cast("int")).alias("_rows"),
    )
    empty = F.expr("CAST(array() AS array<struct<start:bigint,stop:bigint>>)")
    joined = F.aggregate(
        "spans",
        empty,
        lambda acc, s: F.when(
            (F.size(acc) > 0) & (F.element_at(acc, -1)["stop"] >= s["start"]),
            F.concat(
                F.slice(acc, 1, F.size(acc) - 1),
                F.array(
                    F.struct(
                        F.element_at(acc, -1)["start"].alias("start"),
                        F.greatest(F.element_at(acc, -1)["stop"], s["stop"]).alias("stop"),
                    )
                ),
            ),
        ).otherwise(F.concat(acc, F.array(s))),
    )
    merged = merged.withColumn("spans", F.when(F.size("spans") > 0, joined).otherwise(empty))
    merged = merged.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_rows"))))
    return merged.select(doc_id, *[f.name for f in FIELDS])


# --- the index of one block ------------------------------------------------------


def item_words(text: str | None) -> list[bytes]:
    data = LOWER[np.frombuffer((text or "").encode(), np.uint8)]
    starts, stops, _, _ = words(data, np.array([0, len(data)]), IS_WORD)
    raw = data.tobytes()
    return [raw[a:b] for a, b in zip(starts.tolist(), stops.tolist(), strict=True)]


def _blocks(benchmark, width, item_id, item_text) -> Iterator[list[tuple[int, list[bytes]]]]:
    """Items with their words, in blocks of bounded size."""
    block, size = [], 0
    rows = benchmark.select(F.col(item_id).alias("i"), F.col(item_text).alias("t")).where("i IS NOT NULL")
    for row in rows.toLocalIterator():
        found = item_words(row.t)
        step = BLOCK_WORDS
        for at in range(0, max(1, len(found) - width + 1), step):
            part = found[at : at + step + width - 1]
            if part:
                block.append((row.i, part))
                size += sum(map(len, part)) + len(part)
            if size >= BLOCK_BYTES:
                yield block
                block, size = [], 0
    yield block


def _index(docs, block, width, text) -> Index:
    vocabulary = Vocabulary({w for _, item in block for w in item})
    return Index(block, width, vocabulary, _document_counts(docs, vocabulary, text))


class Vocabulary:
    """Words of a block by hash; ids follow the order of the hashes."""

    def __init__(self, found: set[bytes]):
        self.words = sorted(found)
        if self.words:
            data = np.frombuffer(b" ".join(self.words), np.uint8)
            _, _, hashes, _ = words(data, np.array([0, len(data)]), IS_WORD)
            order = np.argsort(hashes, kind="stable")
            self.words = [self.words[i] for i in order.tolist()]
            self.hashes = hashes[order]
        else:
            self.hashes = np.zeros(0, np.uint64)
        self.ids = {w: i for i, w in enumerate(self.words)}
        # Most words are no item words; a table of hash bits tells so at once.
        self.bits = 20
        self.maybe = np.zeros(1 << self.bits, bool)
        self.maybe[(self.hashes >> np.uint64(64 - self.bits)).astype(np.int64)] = True

    def lookup(self, hashes: np.ndarray) -> np.ndarray:
        """Id of each word, -1 if it is in no item."""
        out = np.full(len(hashes), -1, np.int32)
        if len(self.hashes):
            at = np.flatnonzero(self.maybe[(hashes >> np.uint64(64 - self.bits)).astype(np.int64)])
            near = np.searchsorted(self.hashes, hashes[at])
            near[near == len(self.hashes)] = 0
            same = self.hashes[near] == hashes[at]
            out[at[same]] = near[same]
        return out


def _document_counts(docs: DataFrame, vocabulary: Vocabulary, text: str) -> np.ndarray:
    """In how many documents each word of the block stands; counted over all documents."""
    size = len(vocabulary.words)
    counts = np.zeros(size, np.int64)
    if not size:
        return counts

    def count(batches):
        import pyarrow as pa

        total = np.zeros(size, np.int64)
        for batch in batches:
            for _, _, data, offsets in byte_slices(batch.column(text)):
                _, _, hashes, firsts = words(LOWER[data], offsets, IS_WORD)
                ids = vocabulary.lookup(hashes)
                doc = np.repeat(np.arange(len(offsets) - 1), np.diff(firsts))
                inside = ids >= 0
                both = np.unique(doc[inside] * size + ids[inside])
                total += np.bincount(both % size, minlength=size)
        seen = np.flatnonzero(total)
        yield pa.record_batch([pa.array(seen, pa.int64()), pa.array(total[seen], pa.int64())], ["word", "n"])

    rows = docs.select(text).mapInArrow(count, "word long, n long")
    # At most one row for each word of the block, whose size is bounded.
    for row in rows.groupBy("word").agg(F.sum("n").alias("n")).collect():
        counts[row.word] = row.n
    return counts


class Index:
    """Windows of a block by their rarest word."""

    def __init__(self, block, width, vocabulary: Vocabulary, counts: np.ndarray):
        self.vocabulary = vocabulary
        windows: dict[tuple[int, ...], list[int]] = {}
        for item, found in block:
            ids = [vocabulary.ids[w] for w in found]
            for at in range(max(1, len(ids) - width + 1)):
                owners = windows.setdefault(tuple(ids[at : at + width]), [])
                if not owners or owners[-1] != item:
                    owners.append(item)
        self.owners = list(windows.values())
        self.lengths = np.array([len(w) for w in windows], np.int64)
        self.width = int(self.lengths.max(initial=1))
        self.ids = np.full((len(windows), self.width), -1, np.int32)
        for k, w in enumerate(windows):
            self.ids[k, : len(w)] = w
        size = len(vocabulary.words)
        # Rarity: fewer documents first, equal counts by the word itself.
        by_word = np.argsort(np.argsort(np.array(vocabulary.words, dtype=object))) if size else np.zeros(0)
        rank = np.empty(size + 1, np.int64)
        rank[np.lexsort((by_word, counts))] = np.arange(size)
        rank[size] = np.iinfo(np.int64).max
        offset = rank[self.ids].argmin(1) if size else np.zeros(0, np.int64)
        token = self.ids[np.arange(len(self.ids)), offset] if size else np.zeros(0, np.int64)
        # Windows of one token, offset and length are of a kind; few kinds share a token, however many windows do.
        span = self.width + 1
        kinds, kind = np.unique((token * span + offset) * span + self.lengths, return_inverse=True)
        self.kind_length, self.kind_offset = kinds % span, kinds // span % span
        self.first = np.searchsorted(kinds // span**2, np.arange(size + 1))
        keys = window_keys(id_sums(self.ids), kind)
        self.order = np.argsort(keys, kind="stable")
        self.keys = keys[self.order]


def id_sums(ids: np.ndarray) -> np.ndarray:
    """Hash of each row of word ids; -1 behind the end of a row counts nothing."""
    power, _ = _power_tables(ids.shape[1])
    return ((ids + 1).astype(np.uint64) * power[: ids.shape[1]]).sum(1, dtype=np.uint64)


def window_keys(sums: np.ndarray, kind: np.ndarray) -> np.ndarray:
    return mixed(mixed(sums) + kind.astype(np.uint64))


class Scan:
    """Hits of an index in texts."""

    def __init__(self, index: Index):
        self.index = index

    def candidates(self, ids: np.ndarray, lows: np.ndarray, highs: np.ndarray):
        """(window, position) pairs that share the prefix token, lie inside one document and have one hash.

        A token's place asks for each kind of its windows, of which there are at most as many
        as offsets and lengths, so the work does not grow with the windows of a token.
        """
        x = self.index
        known = np.flatnonzero(ids >= 0)
        n = x.first[ids[known] + 1] - x.first[ids[known]]
        known, n = known[n > 0], n[n > 0]
        # Words before and after that are in items too, without a gap.
        run = np.concatenate([[0], np.cumsum(ids < 0)])
        power, inverse = _power_tables(len(ids) + 1)
        sums = np.zeros(len(ids) + 1, np.uint64)
        np.cumsum((ids + 1).astype(np.uint64) * power[: len(ids)], out=sums[1:])
        ends = np.cumsum(n)
        for low in range(0, int(n.sum()), PAIRS):
            pair = np.arange(low, min(low + PAIRS, ends[-1]))
            at = np.searchsorted(ends, pair, "right")
            place = known[at]
            kind = x.first[ids[place]] + pair - (ends[at] - n[at])
            begin = place - x.kind_offset[kind]
            end = begin + x.kind_length[kind]
            fits = (begin >= lows[place]) & (end <= highs[place])
            kind, begin, end = kind[fits], begin[fits], end[fits]
            whole = run[end] == run[begin]
            kind, begin, end = kind[whole], begin[whole], end[whole]
            keys = window_keys((sums[end] - sums[begin]) * inverse[begin], kind)
            left, right = np.searchsorted(x.keys, keys, "left"), np.searchsorted(x.keys, keys, "right")
            k = right - left
            step = np.arange(k.sum()) - np.repeat(np.cumsum(k) - k, k)
            yield x.order[np.repeat(left, k) + step], np.repeat(begin, k)

    def __call__(self, data: np.ndarray, offsets: np.ndarray):
        x = self.index
        data = LOWER[data]
        starts, stops, hashes, firsts = words(data, offsets, IS_WORD)
        n_words = np.diff(firsts)
        n_docs = len(n_words)
        spans, items = [[] for _ in range(n_docs)], [[] for _ in range(n_docs)]
        if len(x.owners) and len(hashes):
            ids = x.vocabulary.lookup(hashes)
            doc = np.repeat(np.arange(n_docs), n_words)
            raw, hits, covered = data.tobytes(), set(), []
            lows, highs = firsts[:-1][doc], firsts[1:][doc]
            for window, begin in self.candidates(ids, lows, highs):
                if not len(window):
                    continue
                places = begin[:, None] + np.arange(x.width)
                inside = np.arange(x.width) < x.lengths[window][:, None]
                same = ids[np.minimum(places, len(ids) - 1)] == x.ids[window]
                hit = (same | ~inside).all(1)
                for w, b in zip(window[hit].tolist(), begin[hit].tolist(), strict=True):
                    e = b + int(x.lengths[w])
                    # Ids are equal by hash; the words themselves decide.
                    mine = [raw[s:t] for s, t in zip(starts[b:e].tolist(), stops[b:e].tolist(), strict=True)]
                    if mine == [x.vocabulary.words[i] for i in x.ids[w, : e - b].tolist()]:
                        hits.add((int(doc[b]), w))
                        covered.append((b, e))
            if covered:
                depth = np.zeros(len(ids) + 1, np.int64)
                b, e = np.array(covered).T
                np.add.at(depth, b, 1)
                np.add.at(depth, e, -1)
                under = np.concatenate([[False], np.cumsum(depth[:-1]) > 0, [False]])
                # Runs end where their document ends.
                begins, ends = under[1:-1] & ~under[:-2], under[1:-1] & ~under[2:]
                edge = firsts[1:-1][(firsts[1:-1] > 0) & (firsts[1:-1] < len(ids))]
                begins[edge] |= under[1:-1][edge]
                ends[edge - 1] |= under[1:-1][edge - 1]
                for b, e in zip(np.flatnonzero(begins).tolist(), np.flatnonzero(ends).tolist(), strict=True):
                    k = int(doc[b])
                    spans[k].append({"start": b - int(firsts[k]), "stop": e + 1 - int(firsts[k])})
            owners = [set() for _ in range(n_docs)]
            for k, w in hits:
                owners[k].update(x.owners[w])
            items = [sorted(s) for s in owners]
        return n_words, spans, items
