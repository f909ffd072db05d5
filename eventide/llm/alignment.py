"""Alignment of two tokenizers: which tokens of the one overlap which of the other.

Both encode the same bytes, a blank and the text. Tokens of a batch of documents are
two frames of (document, first byte); ``merge_asof``, keyed by document, finds for each
token start the token of the other side that covers it. The union of both directions
is all overlapping pairs, and where starts (and so ends) are equal a group begins.

A pair of ids counts the documents that hold it linked. Workers count in blocks of
documents, so that a block and not a document or a link has a row for a pair; the
blocks' counts are added up, the greatest of each A id is found, and both go back to
the blocks that asked. A block is held in one task and has at most ``BLOCK_BYTES`` of
text beyond its last document.

Neither tokenizer joins what a blank parts: both end a token before a blank or a line
feed that follows something else. Texts are cut there, and a piece that has come before
in the same task is not encoded again. What a document's links are is written as
its pieces' numbers.

Defined cases: a null or empty text, or one that either side's tokens do not give back
(a literal U+2581, for instance), has no tokens: zeros and an empty ``groups``. Very
long texts are aligned in slices of ``SLICE_TOKENS`` that end where a piece ends.
Repeated rows are documents of their own. Ties for the greatest count all count as best.
Only the ``columns`` asked for are kept, beside the results.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Sequence
from pathlib import Path

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventide.llm.common import SLICE_BYTES, byte_slices, prepare, run_hashes, saved

TOKENIZERS = "/opt/tokenizers"
A_FILE, B_FILE = "byte_bpe_50k.json", "piece_bpe_32k.model"
#: Text of a block; a block's counts are made in one task.
BLOCK_BYTES = 8 << 20
#: Tokens of one side that are aligned at a time.
SLICE_TOKENS = 150_000
#: Text that goes into the encoders at a time, beyond its last piece.
JOINED_BYTES = 1 << 15
#: Pieces that a task remembers.
MAX_PIECES = 400_000
TEXT, SHA256 = "text", "sha256"

# How the byte-level tokenizer parts a text; a fixed value.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
# Characters that are the same classes in every version of Unicode.
_OTHER = re.compile("[^\t\n\r -~¡-ɏΑ-Ωα-ωА-я‐-‧]")
_LONG = re.compile(r"\S{400}")
_BLANK = np.isin(np.arange(256), [*range(9, 14), *range(28, 33)])


def cuts(data: np.ndarray, begins: np.ndarray) -> np.ndarray:
    """Where pieces begin in UTF-8 ``data`` of texts that begin at ``begins`` with a blank.

    That is at texts, and at blanks and line feeds after something that surely is no
    blank. Wide blanks are told by their first bytes, with others of their blocks.
    """
    at = np.flatnonzero((data == 32) | (data == 10))
    one, two, three = (data[np.maximum(at - k, 0)] for k in (1, 2, 3))
    wide = ((two == 0xC2) & ((one == 0x85) | (one == 0xA0))) | ((three == 0xE1) & (two == 0x9A))
    wide |= ((three == 0xE2) & ((two == 0x80) | (two == 0x81))) | ((three == 0xE3) & (two == 0x80))
    at = at[~_BLANK[one] & ~wide]
    return np.union1d(at, begins)


def byte_alphabet() -> dict[str, int]:
    """Character of a byte-level vocabulary -> byte: printable ones stand for themselves, others follow from 256 on."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + k): b for k, b in enumerate(others)}


class Tokenizers:
    """Both tokenizers, with the bytes of every id."""

    def __init__(self, a_json: str, b_model: bytes):
        import sentencepiece
        import tiktoken
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_str(a_json)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_proto=b_model)
        spec = json.loads(a_json)
        vocab, merges = spec["model"]["vocab"], spec["model"]["merges"]
        added = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        alphabet = byte_alphabet()
        entries = {k: bytes(alphabet[c] for c in word) for word, k in vocab.items() if word not in added}
        entries |= {k: word.encode() for word, k in added.items()}
        self.a_bytes = [entries[k] for k in range(max(entries) + 1)]
        n = self.b.get_piece_size()
        self.b_bytes = [
            bytes([int(p[3:5], 16)]) if self.b.is_byte(k) else p.replace("▁", " ").encode()
            for k in range(n)
            for p in [self.b.id_to_piece(k)]
        ]
        # The same merges in a faster engine, if ids are in the order of the merges.
        made = [vocab["".join(m if isinstance(m, list) else m.split(" "))] for m in merges]
        self.a_len, self.b_len = (np.array([len(x) for x in table]) for table in (self.a_bytes, self.b_bytes))
        self.fast = None
        if made == sorted(set(made)) and len(made) + 256 == len(vocab) - len(added.keys() & vocab.keys()):
            ranks = {entries[k]: k for word, k in vocab.items() if word not in added}
            self.fast = tiktoken.Encoding("a", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})

    def encode(self, parts: Sequence[bytes]) -> tuple[tuple[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray], np.ndarray]:
        """Ids of each side with the number of each piece's, and which pieces come back from both.

        Pieces are encoded many at a time, one after the other, as they are in a text.
        """
        sides, whole = ([], []), []
        low = 0
        while low < len(parts):
            high, size = low, 0
            while high < len(parts) and size < JOINED_BYTES:
                last = parts[high]
                size += len(last)
                high += 1
                # A piece that ends with a blank is the end of a text and has nothing after it.
                if last[-1] < 33 or (last[-1] >= 0x80 and last.decode()[-1].isspace()):
                    break
            run = parts[low:high]
            low = high
            raw = b"".join(run)
            a, b = self._encode_one(raw.decode())
            if all(b"".join(map(table.__getitem__, ids)) == raw for ids, table in ((a, self.a_bytes), (b, self.b_bytes))):
                ends = np.cumsum([len(p) for p in run])
                for side, ids, length in zip(sides, (a, b), (self.a_len, self.b_len), strict=True):
                    ids = np.array(ids, np.int32)
                    side.append((ids, np.diff(np.searchsorted(np.cumsum(length[ids]), ends, "right"), prepend=0)))
                whole.append(np.ones(len(run), bool))
                continue
            for part in run:
                found = self._encode_one(part.decode())
                same = True
                for side, ids, table in zip(sides, found, (self.a_bytes, self.b_bytes), strict=True):
                    same &= b"".join(map(table.__getitem__, ids)) == part
                    side.append((np.array(ids, np.int32), np.array([len(ids)])))
                whole.append(np.array([same]))
        joined = tuple(tuple(np.concatenate(x) for x in zip(*side, strict=True)) for side in sides)
        return *joined, np.concatenate(whole)

    def _encode_one(self, text: str) -> tuple[list[int], list[int]]:
        if self.fast and not _OTHER.search(text) and not _LONG.search(text):
            a = self.fast.encode_ordinary(text)
        else:
            a = self.a.encode_batch([text], add_special_tokens=False)[0].ids
        # The blank that B adds and a line feed stand apart before the text.
        return a, self.b.encode("\n" + text)[2:]


def _ragged(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Indices of the runs that begin at ``starts``, one after the other."""
    ends = np.cumsum(sizes)
    return np.repeat(starts - (ends - sizes), sizes) + np.arange(ends[-1] if len(ends) else 0)


def overlaps(doc_a, start_a, doc_b, start_b):
    """Overlapping tokens of two sides: pairs (i, j), and which tokens of each begin a group.

    Starts ascend through the batch. Each start finds the covering token of the
    other side; an equal start is found in both directions and kept once.
    """
    a = pd.DataFrame({"doc": doc_a, "start": start_a})
    b = pd.DataFrame({"doc": doc_b, "start": start_b})
    over_a = pd.merge_asof(a, b.assign(j=np.arange(len(b)), at=start_b), on="start", by="doc")
    over_b = pd.merge_asof(b, a.assign(i=np.arange(len(a)), at=start_a), on="start", by="doc")
    j, i = over_a["j"].to_numpy(np.int64), over_b["i"].to_numpy(np.int64)
    begins_a = over_a["at"].to_numpy() == start_a
    begins_b = over_b["at"].to_numpy() == start_b
    more = np.flatnonzero(~begins_b)
    return np.concatenate([np.arange(len(a)), i[more]]), np.concatenate([j, more]), begins_a, begins_b


class _Side:
    """Ids of all pieces, one after the other, and where each one's end."""

    def __init__(self):
        self.ids, self.end = np.zeros(0, np.int32), np.zeros(1, np.int64)

    def sizes(self, pieces: np.ndarray) -> np.ndarray:
        return self.end[pieces + 1] - self.end[pieces]


class _Task:
    """Pieces met in a task, and the block it is working on."""

    def __init__(self, tokenizers: Tokenizers, groups: str):
        self.t, self.groups = tokenizers, groups
        size = len(tokenizers.a_bytes), len(tokenizers.b_bytes)
        # Texts of ids as written into groups, with what follows them: within a side, and at its end.
        texts = [f"{k}{mark}".encode() for n, marks in zip(size, (",|", ",;"), strict=True) for k in range(n) for mark in marks]
        self.width = np.array([len(x) for x in texts])
        self.texts = np.array(texts).view(np.uint8).reshape(len(texts), -1)
        self.forget()

    def forget(self) -> None:
        self.hashes, self.ids = np.zeros(0, np.uint64), np.zeros(0, np.int64)  # of the pieces, by hash
        self.sides = _Side(), _Side()
        self.whole = np.zeros(0, bool)  # does the piece come back from both sides
        self.links = np.zeros(0, np.int64)  # pairs of ids of all pieces
        self.link_at, self.link_n = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.begin()

    def begin(self) -> None:
        self.rows, self.coded, self.counts, self.size = [], [], [], 0

    def numbers(self, texts: list[bytes]) -> list[np.ndarray]:
        """Piece numbers of texts that begin with a blank; new pieces are encoded."""
        raw = b"".join(texts)
        data = np.frombuffer(raw, np.uint8)
        ends = np.cumsum([len(t) for t in texts])
        starts = cuts(data, np.append(0, ends[:-1])[np.diff(ends, prepend=0) > 0])
        stops = np.append(starts[1:], len(data))
        hashes = np.empty(len(starts), np.uint64)
        low = 0
        while low < len(starts):  # numpy needs some tens of bytes for each byte
            high = max(low + 1, int(np.searchsorted(stops, starts[low] + SLICE_BYTES, "right")))
            hashes[low:high] = run_hashes(data[starts[low] : stops[high - 1]], starts[low:high] - starts[low], stops[low:high] - starts[low])
            low = high
        found, first, where = np.unique(hashes, return_index=True, return_inverse=True)
        at = np.searchsorted(self.hashes, found)
        known = np.append(self.hashes, 0)[at] == found if len(self.hashes) else np.zeros(len(found), bool)
        new = np.flatnonzero(~known)
        if len(new):
            # In the order of the text: the end of a text is then followed by a new one.
            new = new[np.argsort(first[new], kind="stable")]
            parts = [raw[x:y] for x, y in zip(starts[first[new]].tolist(), stops[first[new]].tolist(), strict=True)]
            *sides, whole = self.t.encode(parts)
            for side, (ids, sizes) in zip(self.sides, sides, strict=True):
                side.ids = np.append(side.ids, ids)
                side.end = np.append(side.end, side.end[-1] + np.cumsum(sizes))
            order = np.argsort(found[new])
            place = np.searchsorted(self.hashes, found[new][order])
            self.hashes = np.insert(self.hashes, place, found[new][order])
            self.ids = np.insert(self.ids, place, len(self.whole) + order)
            self.whole = np.append(self.whole, whole)
            self.link_at = np.append(self.link_at, np.full(len(new), -1))
            self.link_n = np.append(self.link_n, np.zeros(len(new), np.int64))
            at = np.searchsorted(self.hashes, found)
        ids = self.ids[at][where] if len(found) else np.zeros(0, np.int64)
        edges = np.searchsorted(starts, np.append(0, ends))
        return [ids[x:y] for x, y in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True)]

    def add(self, kept: list, texts: list[str | None]) -> None:
        """Align a batch of documents."""
        coded = [ids if self.whole[ids].all() else ids[:0] for ids in self.numbers([b" " + t.encode() if t else b"" for t in texts])]
        seq = np.concatenate(coded)
        doc = np.repeat(np.arange(len(coded)), [len(c) for c in coded])
        n_a = self.sides[0].sizes(seq)
        totals = np.zeros((4, len(coded)), np.int64)  # tokens of A and B, groups, links
        written = [hashlib.sha256() if self.groups == SHA256 else [] for _ in coded]
        edges = np.searchsorted(np.cumsum(n_a), np.arange(SLICE_TOKENS, n_a.sum() + SLICE_TOKENS, SLICE_TOKENS))
        low = 0
        for high in np.unique(np.minimum(edges + 1, len(seq))).tolist():
            self._slice(seq[low:high], doc[low:high], totals, written)
            low = high
        for k, ids in enumerate(coded):
            found = written[k]
            if self.groups == SHA256:
                found = found.hexdigest() if len(ids) else ""
            else:
                found = b";".join(found).decode()
            self.rows.append((kept[k], *totals[:, k].tolist(), found))
        self.coded += coded
        self.counts.append(self._document_counts(seq, doc))
        self.size += sum(map(len, (t for t in texts if t)))

    def _slice(self, seq, doc, totals, written):
        """Links and groups of a run of pieces."""
        n_a, n_b = (side.sizes(seq) for side in self.sides)
        a, b = (side.ids[_ragged(side.end[seq], n)] for side, n in zip(self.sides, (n_a, n_b), strict=True))
        doc_a, doc_b = np.repeat(doc, n_a), np.repeat(doc, n_b)
        len_a, len_b = self.t.a_len[a], self.t.b_len[b]
        i, j, begins_a, begins_b = overlaps(doc_a, np.cumsum(len_a) - len_a, doc_b, np.cumsum(len_b) - len_b)
        n = totals.shape[1]
        for row, docs in enumerate((doc_a, doc_b, doc_a[begins_a], doc_a[i])):
            totals[row] += np.bincount(docs, minlength=n)
        # Links of the pieces that come for the first time.
        number = np.repeat(np.arange(len(seq)), n_a)
        fresh, first = np.unique(seq, return_index=True)
        first = first[self.link_at[fresh] < 0]
        is_first = np.zeros(len(seq), bool)
        is_first[first] = True
        mine = np.flatnonzero(is_first[number[i]])
        mine = mine[np.argsort(number[i[mine]], kind="stable")]
        sizes = np.bincount(number[i[mine]], minlength=len(seq))[np.sort(first)]
        self.link_at[seq[np.sort(first)]] = len(self.links) + np.cumsum(sizes) - sizes
        self.link_n[seq[np.sort(first)]] = sizes
        self.links = np.concatenate([self.links, (a[i[mine]].astype(np.int64) << 32) | b[j[mine]]])
        # Ids in order: each group's A, then its B.
        group_a, group_b = np.cumsum(begins_a) - 1, np.cumsum(begins_b) - 1
        in_a, in_b = np.bincount(group_a), np.bincount(group_b)
        out = np.empty(len(a) + len(b), np.int64)
        out[np.arange(len(a)) + (np.cumsum(in_b) - in_b)[group_a]] = a * 2 + np.append(begins_a[1:], True)
        base = 2 * len(self.t.a_len)
        out[np.arange(len(b)) + np.cumsum(in_a)[group_b]] = base + b * 2 + np.append(begins_b[1:], True)
        flat = self.texts[out].ravel()
        flat = flat[flat != 0].tobytes()
        ends = np.cumsum(self.width[out])
        sizes = np.bincount(doc_a, minlength=n) + np.bincount(doc_b, minlength=n)
        here = np.flatnonzero(sizes)
        lasts = ends[np.cumsum(sizes[here]) - 1].tolist()
        begun = totals[0] - np.bincount(doc_a, minlength=n) > 0  # in an earlier slice
        for k, x, y in zip(here.tolist(), [0, *lasts], lasts, strict=False):
            if self.groups == SHA256:
                written[k].update((b";" if begun[k] else b"") + flat[x : y - 1])
            else:
                written[k].append(flat[x : y - 1])

    def _document_counts(self, seq, doc):
        """How many documents of a batch hold each pair."""
        if not len(seq):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        at = np.unique(doc * len(self.whole) + seq)
        doc, seq = at // len(self.whole), at % len(self.whole)
        pair, index = np.unique(self.links[_ragged(self.link_at[seq], self.link_n[seq])], return_inverse=True)
        held = np.unique(np.repeat(doc, self.link_n[seq]) * len(pair) + index)
        return pair, np.bincount(held % len(pair), minlength=len(pair))

    def finish(self, block: int, kind: pa.Schema):
        """Rows of the block: documents, one for its pieces, and its pairs."""
        if not self.rows:
            return
        seq = np.concatenate(self.coded)
        used, local = np.unique(seq, return_inverse=True)
        local = local.astype(np.int32)
        pair = np.unique(np.concatenate([p for p, _ in self.counts]))
        docs = np.zeros(len(pair), np.int64)
        for some, n in self.counts:
            docs[np.searchsorted(pair, some)] += n
        links = np.searchsorted(pair, self.links[_ragged(self.link_at[used], self.link_n[used])])
        low, codes = 0, []
        for c in self.coded:
            codes.append(local[low : low + len(c)].tobytes())
            low += len(c)
        kept, *values = zip(*self.rows, strict=True)
        yield _filled(kind, len(kept), block=[block] * len(kept), kept=kept, pieces=codes, **dict(zip(RESULTS[:5], values, strict=True)))
        sizes, index = self.link_n[used].astype(np.int32).tobytes(), links.astype(np.int32).tobytes()
        yield _filled(kind, 1, block=[block], pieces=[sizes], links=[index])
        for low in range(0, len(pair), 50_000):
            part = slice(low, low + 50_000)
            n = len(pair[part])
            yield _filled(kind, n, block=np.full(n, block), pair=pair[part], nr=np.arange(low, low + n), docs=docs[part])
        self.begin()


def _filled(kind: pa.Schema, n: int, **columns) -> pa.RecordBatch:
    """A batch of ``kind`` that has nulls in the columns that are not given."""
    arrays = [pa.array(columns[f.name], f.type) if f.name in columns else pa.nulls(n, f.type) for f in kind]
    return pa.RecordBatch.from_arrays(arrays, schema=kind)


RESULTS = ["n_a", "n_b", "n_groups", "n_links", "groups", "n_best", "count_sum"]
LONGS = [T.StructField(name, T.LongType()) for name in RESULTS if name != "groups"]


def align(
    docs: DataFrame,
    columns: Sequence[str] = ("doc_id",),
    text: str = "text",
    tokenizers: str = TOKENIZERS,
    groups: str = TEXT,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """``columns`` of ``docs``; tokens of A and B, groups and links; ``groups``; best links and the sum of their counts.

    ``groups`` are ids as ``a1,a2|b1;a3|b2,b3``, or with ``groups=SHA256`` their digest, which
    spares carrying some times the text through a shuffle.
    """
    spark = docs.sparkSession
    prepare(spark)
    coded = saved(_coded(docs, list(columns), text, tokenizers, groups, block_bytes), "alignment")
    pairs = coded.where("pair IS NOT NULL").select("block", "nr", "pair", "docs")
    totals = pairs.groupBy("pair").agg(F.sum("docs").alias("count"))
    # An A id has at most as many pairs as B has ids.
    of_a = Window.partitionBy(F.shiftright("pair", 32))
    totals = totals.select("pair", "count", (F.col("count") == F.max("count").over(of_a)).alias("best"))
    counts = pairs.join(totals, "pair").select(F.col("block").alias("of_block"), "nr", "count", "best")
    rows = coded.where("pair IS NULL").drop("pair", "nr", "docs")
    kept = coded.schema["kept"].dataType
    kind = T.StructType([T.StructField("kept", kept), T.StructField("groups", T.StringType()), *LONGS])
    done = rows.groupBy("block").cogroup(counts.groupBy("of_block")).applyInArrow(_summed, kind)
    return done.select("kept.*", *RESULTS)


def _coded(docs, columns, text, tokenizers, groups, block_bytes) -> DataFrame:
    # Two files of about 2 MB in all, whatever the documents.
    files = docs.sparkSession.sparkContext.broadcast(
        (Path(tokenizers, A_FILE).read_text(), Path(tokenizers, B_FILE).read_bytes())
    )
    rows = docs.select(F.struct(*columns).alias("kept"), F.col(text).alias("text"))
    longs = [T.StructField(name, T.LongType()) for name in RESULTS[:4]]
    schema = T.StructType(
        [
            T.StructField("block", T.LongType()),
            T.StructField("kept", rows.schema["kept"].dataType),
            *longs,
            T.StructField("groups", T.StringType()),
            T.StructField("pieces", T.BinaryType()),
            T.StructField("links", T.BinaryType()),
            T.StructField("pair", T.LongType()),
            T.StructField("nr", T.IntegerType()),
            T.StructField("docs", T.LongType()),
        ]
    )
    from pyspark.sql.pandas.types import to_arrow_schema

    kind = to_arrow_schema(schema)

    def run(batches):
        # A block's number holds in this table only, which is written once.
        first, task, block = TaskContext.get().partitionId() << 32, None, 0
        for batch in batches:
            task = task or _Task(Tokenizers(*files.value), groups)
            for low, high, _, _ in byte_slices(batch.column("text")):
                some = batch.slice(low, high - low)
                task.add(some.column("kept").to_pylist(), some.column("text").to_pylist())
                if task.size >= block_bytes or len(task.whole) > MAX_PIECES:
                    yield from task.finish(first + block, kind)
                    block += 1
                    if len(task.whole) > MAX_PIECES:
                        task.forget()
        if task:
            yield from task.finish(first + block, kind)

    return rows.mapInArrow(run, schema)


def _summed(rows: pa.Table, counts: pa.Table) -> pa.Table:
    """Best links and counts of the documents of one block."""
    count, best = np.zeros(counts.num_rows, np.int64), np.zeros(counts.num_rows, np.int64)
    nr = counts.column("nr").to_numpy()
    count[nr] = counts.column("count").to_numpy()
    best[nr] = counts.column("best").to_numpy()
    is_doc = pa.compute.is_null(rows.column("links"))
    index = rows.filter(pa.compute.invert(is_doc))
    docs = rows.filter(is_doc)
    sizes = np.frombuffer(index.column("pieces")[0].as_py(), np.int32)
    links = np.frombuffer(index.column("links")[0].as_py(), np.int32)
    ends = np.cumsum(sizes)
    of_piece = [np.diff(np.append(0, np.cumsum(v[links]))[np.append(0, ends)]) for v in (best, count)]
    codes = [np.frombuffer(x.as_py(), np.int32) for x in docs.column("pieces")]
    sums = [[int(v[c].sum()) for c in codes] for v in of_piece]
    out = docs.select(["kept", "groups", *RESULTS[:4]])
    return out.append_column("n_best", pa.array(sums[0], pa.int64())).append_column("count_sum", pa.array(sums[1], pa.int64()))
