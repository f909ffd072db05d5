"""Toxicity with a convolutional text classifier written in numpy.

Words are hashed into rows of an embedding; filters of several widths run over
the sequence, and the largest response of each filter over the whole text
goes into a logistic output. It learns from the whole text of every labelled row; the
first embedding dimension starts as the smoothed
log-odds of a word's documents, and words of few documents (``MIN_DOCS``) count as
unknown. The labelled rows are dealt by hash into parts of about ``PART_ROWS``, once,
as a table of word buckets. In each of some rounds every part trains a copy of the network
with Adam, and the copies' parameters are averaged: those of a word over the parts
that have it. The logits of all rows, each by a network that has not seen its fold,
calibrate the score (Platt), and their calibrated scores give each language a
threshold: the one of best F1 in that language, drawn to the threshold over all
languages where it has few positive rows. For both, logits are counted in steps of
1/``STEPS``, so that counts and not rows come to the driver. Scores depend on the text
alone; a language only picks the threshold of the decision.

Scoring streams over all documents and whole texts; nothing is shuffled. As
max pooling takes each position by itself, a filter's response is a sum of
table entries, one for each word it covers.

Defined cases: a null or empty text, or one without words, gets the response of
an empty text (every filter at its bias). Without labels of both classes the
score is the share of positive labels, 0.0 without any. Null labels are not
learned from; a label of a missing document is ignored; repeated labels count
as often as they occur. A null language takes the overall threshold.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventide.llm.common import LOWER, annotate, byte_slices, prepare, saved, word_table, words

PART_ROWS = 8192  # labelled rows that train one copy of the network
PART_DOCS = 8 * PART_ROWS  # documents, labelled or not, that the join may bring to a part
HELD_WORDS = 2_000_000  # words of a part that are held at a time
PIECE_WORDS = 1 << 17  # words that responses are held of at a time
BITS = 20  # buckets that words are hashed into; those of known words have an embedding
DIMENSION = 8
WIDTHS = (1, 2, 3)
FILTERS = 8  # of each width
EPOCHS = 4
RATE, WORD_RATE = 0.005, 0.2  # of the filters, and of the words relative to them
MIN_DOCS = 6  # labelled documents that a word must be in; fewer if there are few
FOLDS = 3
STEPS, MAX_LOGIT = 256, 30  # steps of the logits that are counted
IS_WORD = word_table([(0x00, 0x2F), (0x3A, 0x60), (0x7B, 0x7F)])

# Whether sides that are dealt by some of a join's keys are dealt again by all of them.
ALL_KEYS = "spark.sql.requireAllClusterKeysForCoPartition"

FIELDS = [T.StructField("score", T.DoubleType())]


@dataclass
class Model:
    """Trained network, its calibration and thresholds."""

    known: np.ndarray | None = None  # buckets of the embedding's rows; the last two rows: unknown words, blanks
    embedding: np.ndarray | None = None
    filters: list[np.ndarray] = field(default_factory=list)  # one per width: offset, dimension, filter
    bias: list[np.ndarray] = field(default_factory=list)
    out: np.ndarray | None = None
    constant: float = 0.0
    scale: tuple[float, float] = (1.0, 0.0)
    thresholds: dict[str, float] = field(default_factory=dict)
    threshold: float = 0.5

    # Made from the others where the model is used: they are several times as large, and each executor gets a copy.
    @cached_property
    def rows(self) -> np.ndarray:
        """Row of the embedding by bucket."""
        return _rows(self.known)

    @cached_property
    def tables(self) -> list[np.ndarray]:
        """What a word adds to each filter, one per width: offset, row, filter."""
        return [np.stack([self.embedding @ k for k in kernel]) for kernel in self.filters]

    def __getstate__(self) -> dict:
        return {k: v for k, v in self.__dict__.items() if k not in ("rows", "tables")}

    def pooled(self, ids: np.ndarray, firsts: np.ndarray) -> np.ndarray:
        """Largest response of every filter in each text; ``ids`` of texts end with ``max(WIDTHS)`` blanks."""
        parts, ids = [], self.rows[ids]
        blank = ids == self.rows[-1]
        for table, bias in zip(self.tables, self.bias, strict=True):
            width = len(table)
            total = table[0][ids]
            for k in range(1, width):
                total[:-k] += table[k][ids[k:]]
            total[blank] = 0  # no response reaches into the next text
            parts.append(np.maximum.reduceat(total, firsts, axis=0) + bias)
        return np.maximum(np.concatenate(parts, 1), 0)

    def __call__(self, data: np.ndarray, offsets: np.ndarray):
        if self.out is None:
            return [np.full(len(offsets) - 1, self.constant)]
        ids, firsts = word_ids(data, offsets)
        logit = self.pooled(ids, firsts) @ self.out[:-1] + self.out[-1]
        a, b = self.scale
        return [1 / (1 + np.exp(-(a * logit.astype(np.float64) + b)))]


def word_ids(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the words of each text, blanks after each, and where the texts begin."""
    _, _, hashes, counts = words(LOWER[data], offsets, IS_WORD)
    gap = max(WIDTHS)
    n_texts = len(offsets) - 1
    firsts = counts[:-1] + gap * np.arange(n_texts)
    ids = np.full(len(hashes) + gap * n_texts, 1 << BITS, np.int32)
    text = np.repeat(np.arange(n_texts), np.diff(counts))
    ids[np.arange(len(hashes)) + gap * text] = (hashes >> np.uint64(64 - BITS)).astype(np.int32)
    return ids, firsts


# --- training ------------------------------------------------------------------


class _Net:
    """The network while it is trained; the known words are the first rows of its embedding."""

    def __init__(self, known: np.ndarray, odds: np.ndarray, seed: int):
        rng = np.random.default_rng(seed)
        # Rare words would only be learned by heart: they share a row of zeros.
        self.n, self.known = len(known), known
        self.rows = _rows(known)
        self.p = {"e": rng.normal(0, 0.05, (self.n + 2, DIMENSION)).astype(np.float32)}
        self.p["e"][: self.n, 0] = odds
        self.p["e"][self.n :] = 0
        for w in WIDTHS:
            k = rng.normal(0, 0.15, (w, DIMENSION, FILTERS)).astype(np.float32)
            k[:, 0] += np.abs(rng.normal(0.3, 0.1, (w, FILTERS))) / w
            self.p[f"k{w}"] = k
            self.p[f"b{w}"] = np.zeros(FILTERS, np.float32)
        self.p["o"] = np.append(np.full(len(WIDTHS) * FILTERS, 0.1), -1).astype(np.float32)

    def start(self) -> None:
        """Begin the course of a training; the parameters stay."""
        self.m = {k: np.zeros_like(v) for k, v in self.p.items()}
        self.v = {k: np.zeros_like(v) for k, v in self.p.items()}
        self.t = 0
        self.touched = np.zeros(self.n + 2, bool)

    def packed(self) -> np.ndarray:
        """All parameters as rows of the embedding's width: the words first, then the others."""
        rest = np.concatenate([v.ravel() for k, v in self.p.items() if k != "e"])
        rest = np.append(rest, np.zeros(-len(rest) % DIMENSION, np.float32))
        return np.concatenate([self.p["e"], rest.reshape(-1, DIMENSION)])

    def unpack(self, packed: np.ndarray) -> None:
        self.p["e"] = packed[: self.n + 2].copy()
        rest, at = packed[self.n + 2 :].ravel(), 0
        for k, v in self.p.items():
            if k != "e":
                self.p[k] = rest[at : at + v.size].reshape(v.shape).copy()
                at += v.size

    def _strongest(self, ids: np.ndarray, firsts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Largest response of each filter in each text, and its first place; ``ids`` are rows of the embedding."""
        best = np.full((len(firsts), len(WIDTHS) * FILTERS), -np.inf, np.float32)
        places = np.zeros(best.shape, np.int64)
        ahead = max(WIDTHS) - 1
        for low in range(0, len(ids), PIECE_WORDS):
            high = min(low + PIECE_WORDS, len(ids))
            e = self.p["e"][ids[low : high + ahead]]
            blank = ids[low:high] == self.n + 1
            parts = []
            for w in WIDTHS:
                total = e[: high - low] @ self.p[f"k{w}"][0]
                for k in range(1, w):
                    more = e[k : k + high - low] @ self.p[f"k{w}"][k]
                    total[: len(more)] += more
                total[blank] = 0  # no response reaches into the next text
                parts.append(total)
            total = np.concatenate(parts, 1)
            text = np.arange(np.searchsorted(firsts, low, "right") - 1, np.searchsorted(firsts, high))
            begins = np.maximum(firsts[text] - low, 0)
            top = np.maximum.reduceat(total, begins, axis=0)
            lengths = np.diff(np.append(begins, high - low))
            at, which = np.nonzero(total == np.repeat(top, lengths, axis=0))
            place = np.zeros(top.shape, np.int64)
            place[np.repeat(np.arange(len(text)), lengths)[at[::-1]], which[::-1]] = at[::-1] + low
            better = top > best[text]
            best[text] = np.where(better, top, best[text])
            places[text] = np.where(better, place, places[text])
        return best, places

    def step(self, ids, firsts, y, rate):
        p, n = self.p, len(y)
        ids = self.rows[ids]
        best, places = self._strongest(ids, firsts)
        h = best + np.concatenate([p[f"b{w}"] for w in WIDTHS])
        active = np.maximum(h, 0)
        logit = active @ p["o"][:-1] + p["o"][-1]
        g = ((1 / (1 + np.exp(-logit)) - y) / n).astype(np.float32)
        grads = {"o": np.append(active.T @ g, g.sum()).astype(np.float32) + 1e-3 * p["o"]}
        back = g[:, None] * p["o"][:-1] * (h > 0)
        touched, amounts = [], []
        for i, w in enumerate(WIDTHS):
            mine = slice(i * FILTERS, (i + 1) * FILTERS)
            b, place = back[:, mine], places[:, mine]
            grads[f"b{w}"] = b.sum(0)
            dk = np.zeros_like(p[f"k{w}"])
            for k in range(w):
                word = ids[np.minimum(place + k, len(ids) - 1)]
                word = np.where(ids[place] == self.n + 1, self.n + 1, word)
                dk[k] = np.einsum("nfd,nf->df", p["e"][word], b)
                touched.append(word.ravel())
                amounts.append((b[:, :, None] * p[f"k{w}"][k].T[None]).reshape(-1, DIMENSION))
            grads[f"k{w}"] = dk + 1e-3 * p[f"k{w}"]
        rows, where = np.unique(np.concatenate(touched), return_inverse=True)
        amounts = np.concatenate(amounts)
        total = np.stack([np.bincount(where, amounts[:, d], len(rows)) for d in range(DIMENSION)], 1).astype(np.float32)
        total[rows >= self.n] = 0
        self.touched[rows[rows < self.n]] = True
        self.t += 1
        for name, grad in grads.items():
            self._adam(name, slice(None), grad, rate)
        self._adam("e", rows, total, rate * WORD_RATE)

    def _adam(self, name, rows, grad, rate):
        m, v = self.m[name], self.v[name]
        m[rows] = 0.9 * m[rows] + 0.1 * grad
        v[rows] = 0.99 * v[rows] + 0.01 * grad * grad
        fix = np.sqrt(1 - 0.99**self.t) / (1 - 0.9**self.t)
        self.p[name][rows] -= rate * fix * m[rows] / (np.sqrt(v[rows]) + 1e-7)

    def learn(self, texts: list[np.ndarray], y: np.ndarray, epochs: Sequence[int], of: int, seed: int) -> None:
        """Train on ``texts`` for the ``epochs`` out of ``of``, each in an order of its own."""
        for epoch in epochs:
            order = np.random.default_rng([seed, epoch]).permutation(len(texts))
            for low in range(0, len(order), 32):
                rows = order[low : low + 32]
                self.step(*_batch([texts[i] for i in rows]), y[rows], RATE * (1 - epoch / of) + RATE / 10)

    def model(self) -> Model:
        filters, bias = [self.p[f"k{w}"] for w in WIDTHS], [self.p[f"b{w}"] for w in WIDTHS]
        return Model(self.known, self.p["e"], filters, bias, self.p["o"])


def _unpacked(known: np.ndarray, state: np.ndarray) -> _Net:
    net = _Net(known, np.zeros(len(known)), 0)
    net.unpack(state)
    return net


def _rows(known: np.ndarray) -> np.ndarray:
    """Row of the embedding by bucket, when the buckets ``known`` have one."""
    rows = np.full((1 << BITS) + 1, len(known), np.int32)
    rows[known] = np.arange(len(known))
    rows[-1] = len(known) + 1
    return rows


def _batch(texts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    gap = np.full(max(WIDTHS), 1 << BITS, np.int32)
    firsts = np.cumsum([0, *(len(t) + len(gap) for t in texts[:-1])])
    return np.concatenate([x for t in texts for x in (t, gap)]), firsts


def _log_odds(counts: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Smoothed log-odds of words from their documents, and all documents, of label 0 and 1."""
    rate = (counts[1] + 0.5) / (n[1] + 1), (counts[0] + 0.5) / (n[0] + 1)
    # Few documents say little: shrink towards 0.
    total = counts.sum(0)
    return (np.log(rate[0] / rate[1]) * (total / (total + 5)) / 2).clip(-1, 4).astype(np.float32)


def _min_docs(n: int) -> int:
    return min(MIN_DOCS, max(3, n // 150))


def _epochs(n: int) -> int:
    """At least some hundred steps, also on few rows."""
    return max(EPOCHS, min(20, 4000 // max(1, n)))


def _fit(texts: list[np.ndarray], y: np.ndarray, seed: int = 7) -> Model:
    """The network of a few texts, without Spark."""
    counts = np.zeros((2, 1 << BITS))
    for ids, label in zip(texts, y, strict=True):
        counts[int(label), np.unique(ids)] += 1
    known = np.flatnonzero(counts.sum(0) >= _min_docs(len(texts)))
    net = _Net(known, _log_odds(counts[:, known], np.bincount(y.astype(int), minlength=2)), seed)
    net.start()
    net.learn(texts, y, range(_epochs(len(texts))), _epochs(len(texts)), seed)
    return net.model()


def _logits(model: Model, texts: list[np.ndarray]) -> np.ndarray:
    parts = []
    for low in range(0, len(texts), 64):
        pooled = model.pooled(*_batch(texts[low : low + 64]))
        parts.append(pooled @ model.out[:-1] + model.out[-1])
    return np.concatenate(parts) if parts else np.zeros(0)


def _platt(z: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """Slope and shift of the logit by Newton steps on the weighted likelihood, with a weak prior."""
    x = np.stack([z, np.ones_like(z)], 1)
    at = np.array([1.0, 0.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-(x @ at).clip(-30, 30)))
        grad = x.T @ (weight * (p - y)) + 1e-2 * (at - [1.0, 0.0])
        curve = (x * (weight * p * (1 - p))[:, None]).T @ x + 1e-2 * np.eye(2)
        step = np.linalg.solve(curve, grad).clip(-1, 1)
        at = at - step
        if abs(step).max() < 1e-6:
            break
    return float(max(at[0], 0.05)), float(at[1])


def _best_threshold(scores, y, weight) -> float:
    """Middle of the gap below the score that gives the best weighted F1."""
    order = np.argsort(-scores, kind="stable")
    s, hit, w = scores[order], y[order] > 0, weight[order]
    good = np.cumsum(w * hit)
    f1 = 2 * good / np.maximum(np.cumsum(w) + (w * hit).sum(), 1e-9)
    f1[:-1][s[:-1] == s[1:]] = -1  # a threshold does not part equal scores
    k = int(f1.argmax())
    return float((s[k] + (s[k + 1] if k + 1 < len(s) else 0)) / 2)


def _to_bytes(ids: np.ndarray) -> bytes:
    """Buckets in three bytes each."""
    return np.ascontiguousarray(ids, "<i4").view(np.uint8).reshape(-1, 4)[:, :3].tobytes()


def _from_bytes(data: bytes) -> np.ndarray:
    wide = np.zeros((len(data) // 3, 4), np.uint8)
    wide[:, :3] = np.frombuffer(data, np.uint8).reshape(-1, 3)
    return wide.view("<i4").ravel()


def _encoded(docs: DataFrame, known: DataFrame, parts: int) -> DataFrame:
    """A table of the labelled rows' word buckets and folds, in ``parts`` ordered by hash; ``docs`` has ``i, lang, text``."""

    def encode(batches):
        for batch in batches:
            out = []
            for _, _, data, offsets in byte_slices(batch.column("text")):
                ids, firsts = word_ids(data, offsets)
                lasts = np.append(firsts[1:], len(ids)) - max(WIDTHS)
                # A word's order and place matter to the filters, so all of them are kept.
                out += [_to_bytes(ids[a:b]) for a, b in zip(firsts.tolist(), lasts.tolist(), strict=True)]
            yield pa.record_batch([batch.column("i"), batch.column("lang"), pa.array(out, pa.binary())], ["i", "lang", "ids"])

    kind = T.StructType([docs.schema["i"], docs.schema["lang"], T.StructField("ids", T.BinaryType())])
    # Buckets are smaller than texts, so they are what the join moves; there may be as many labels as documents.
    deal = F.pmod(F.xxhash64(F.lit(1), "i"), F.lit(parts)).cast("int").alias("part")
    coded, known = docs.where("i IS NOT NULL").mapInArrow(encode, kind).select("*", deal), known.select("*", deal)
    order = ["part", F.xxhash64(F.lit(2), "i"), "i", "y", "ids"]

    def dealt(joined: DataFrame) -> DataFrame:
        return joined.select(
            "part",
            F.pmod(F.xxhash64("i"), F.lit(FOLDS)).cast("int").alias("fold"),
            F.col("y").cast("int").alias("y"),
            F.col("lang").cast("string").alias("lang"),
            "ids",
            "i",
        )

    if docs.select("i").count() > PART_DOCS * parts:
        # Few rows have labels: the join spreads all of them by id, and the labelled ones alone go to their parts.
        rows = dealt(coded.join(known.hint("shuffle_hash"), ["part", "i"])).repartition(parts, "part")
        return saved(rows.sortWithinPartitions(*order).drop("i"), "encoded")
    # Both sides go to the parts at once, which is where the join finds them: the buckets move only once. With fewer
    # partitions than usual Spark would deal them again; the more there are, the fewer hold several parts.
    conf = docs.sparkSession.conf
    before, spread = conf.get(ALL_KEYS), max(parts, int(conf.get("spark.sql.shuffle.partitions")))
    conf.set(ALL_KEYS, "false")
    try:
        known = known.repartition(spread, "part").hint("shuffle_hash")
        rows = dealt(coded.repartition(spread, "part").join(known, ["part", "i"]))
        return saved(rows.sortWithinPartitions(*order).drop("i"), "encoded")
    finally:
        conf.set(ALL_KEYS, before)


def _counted(encoded: DataFrame, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The buckets in enough documents, and their documents by fold and label."""

    def count(batches):
        counts = np.zeros((FOLDS * 2, 1 << BITS), np.int32)
        for batch in batches:
            for row in batch.to_pylist():
                counts[2 * row["fold"] + row["y"], np.unique(_from_bytes(row["ids"]))] += 1
        group, bucket = np.nonzero(counts)
        columns = [pa.array(bucket, pa.int32()), pa.array(group, pa.int32()), pa.array(counts[group, bucket].astype(np.int64))]
        yield from pa.table(columns, ["bucket", "group", "n"]).to_batches()

    found = encoded.select("fold", "y", "ids").mapInArrow(count, "bucket int, group int, n long")
    sums = [F.sum(F.when(F.col("group") == k, F.col("n")).otherwise(0)).alias(f"n{k}") for k in range(FOLDS * 2)]
    found = found.groupBy("bucket").agg(*sums, F.sum("n").alias("n")).where(F.col("n") >= _min_docs(n))
    # At most a row for each bucket.
    found = found.drop("n").toArrow().sort_by("bucket")
    known, *counts = [found.column(c).to_numpy() for c in found.column_names]
    return known, np.array(counts).reshape(FOLDS, 2, -1)


def _round(encoded: DataFrame, known: np.ndarray, states: dict[int, np.ndarray], epochs: Sequence[int], of: int):
    """The networks ``states``, by the fold they do not see, after each part has trained them on for ``epochs``."""
    outputs, sent = None, []
    for fold, state in states.items():
        sent.append(encoded.sparkSession.sparkContext.broadcast((known, state)))

        def learn(batches, fold=fold, sent=sent[-1]):
            net, part, texts, y = None, None, [], []
            known, state = sent.value

            def work():
                if texts:
                    net.learn(texts, np.array(y, float), epochs, of, 7 + part)
                texts.clear()
                y.clear()

            def moved():
                work()
                # Whole numbers add up to the same in any order.
                rows = np.append(np.flatnonzero(net.touched), np.arange(net.n + 2, len(state)))
                change = (net.packed()[rows].T.astype(float) - state[rows].T) * (1 << 32)
                columns = [pa.array(np.full(len(rows), fold), pa.int32()), pa.array(rows, pa.int32())]
                columns += [pa.array(np.rint(c).astype(np.int64)) for c in change]
                yield from pa.table(columns, ["net", "row", *_CHANGE]).to_batches()

            for batch in batches:
                held = sum(map(len, texts))
                for row in batch.to_pylist():
                    if row["part"] != part:
                        if net is not None:
                            yield from moved()
                        net = _unpacked(known, state)
                        net.start()
                        part, held = row["part"], 0
                    texts.append(_from_bytes(row["ids"]))
                    y.append(row["y"])
                    held += len(texts[-1])
                    if held > HELD_WORDS:
                        work()
                        held = 0
            if net is not None:
                yield from moved()

        schema = "net int, row int, " + ", ".join(f"{c} long" for c in _CHANGE)
        out = encoded.where(F.col("fold") != fold).select("part", "y", "ids").mapInArrow(learn, schema)
        outputs = out if outputs is None else outputs.unionByName(out)
    mean = [(F.sum(c) / F.count("*") / (1 << 32)).cast("float").alias(c) for c in _CHANGE]
    change = saved(outputs.groupBy("net", "row").agg(*mean), "change")
    for copy in sent:
        copy.destroy()  # its files would stay until the end
    out = {}
    for fold, state in states.items():
        # A row for each known word, of which there are at most as many as buckets.
        mine = change.where(F.col("net") == fold).drop("net").toArrow()
        out[fold] = state.copy()
        out[fold][mine.column("row").to_numpy()] += np.stack([mine.column(c).to_numpy() for c in _CHANGE], 1)
    return out


_CHANGE = [f"d{k}" for k in range(DIMENSION)]


def _counted_logits(encoded: DataFrame, known: np.ndarray, states: dict[int, np.ndarray]) -> DataFrame:
    """How many rows have a language, label and logit (in steps) by the network that has not seen them."""
    found = None
    for fold in range(FOLDS):

        def look(batches, state=states.get(fold)):
            model = None
            for batch in batches:
                z = np.zeros(batch.num_rows)
                if state is not None:
                    model = model or _unpacked(known, state).model()
                    z = _logits(model, [_from_bytes(x) for x in batch.column("ids").to_pylist()])
                steps = np.rint(z.clip(-MAX_LOGIT, MAX_LOGIT) * STEPS).astype(np.int32)
                yield pa.record_batch([batch.column("lang"), batch.column("y"), pa.array(steps)], ["lang", "y", "z"])

        mine = encoded.where(F.col("fold") == fold).select("lang", "y", "ids")
        mine = mine.mapInArrow(look, "lang string, y int, z int")
        found = mine if found is None else found.unionByName(mine)
    return saved(found.groupBy("lang", "y", "z").agg(F.count("*").alias("n")), "logits")


def train(
    docs: DataFrame,
    labels: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    lang: str = "lang",
    label: str = "toxic",
) -> Model:
    """Model from all labelled rows of ``docs``."""
    spark = docs.sparkSession
    prepare(spark)
    known = labels.select(F.col(doc_id).alias("i"), F.col(label).alias("y")).where("i IS NOT NULL AND y IN (0, 1)")
    totals = {row.y: row["count"] for row in known.groupBy("y").count().collect()}
    if len(totals) < 2:
        return Model(constant=float(1 in totals))
    share = totals[1] / (totals[0] + totals[1])
    rows = docs.select(F.col(doc_id).alias("i"), F.col(lang).alias("lang"), F.col(text).alias("text"))
    # The ids alone are read for this.
    parts = max(1, -(-rows.select("i").join(known, "i").count() // PART_ROWS))
    encoded = _encoded(rows, known, parts)
    found = np.zeros((FOLDS, 2), int)
    for row in encoded.groupBy("fold", "y").count().collect():
        found[row.fold, row.y] = row["count"]
    if not found.sum(0).all():
        return Model(constant=share)
    buckets, counts = _counted(encoded, int(found.sum()))
    states = {}
    for fold in range(FOLDS + 1):  # the last one sees all
        others = [k for k in range(FOLDS) if k != fold]
        if found[others].sum(0).all():
            states[fold] = _Net(buckets, _log_odds(counts[others].sum(0), found[others].sum(0)), 7).packed()
    # Parts are averaged after each epoch; a single one need not be.
    of = _epochs(int(found.sum()))
    for epochs in [range(of)] if parts == 1 else [[epoch] for epoch in range(of)]:
        states = _round(encoded, buckets, states, epochs, of)
    model = _unpacked(buckets, states[FOLDS]).model()
    logits = _counted_logits(encoded, buckets, states)
    total = logits.groupBy("z", "y").agg(F.sum("n").alias("n")).toArrow().sort_by([("z", "descending"), ("y", "ascending")])
    z, y, weight = (total.column(c).to_numpy().astype(float) for c in ("z", "y", "n"))
    z /= STEPS
    model.constant, model.scale = share, _platt(z, y, weight)
    a, b = model.scale
    model.threshold = _best_threshold(1 / (1 + np.exp(-(a * z + b))), y, weight)

    def of_language(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by([("z", "descending"), ("y", "ascending")])
        z, y, weight = (rows.column(c).to_numpy().astype(float) for c in ("z", "y", "n"))
        positive = (weight * y).sum()
        best = _best_threshold(1 / (1 + np.exp(-(a * z / STEPS + b))), y, weight)
        return pa.table({"lang": rows.column("lang")[:1], "positive": [float(positive)], "best": [best]})

    own = logits.where("lang IS NOT NULL").groupBy("lang").applyInArrow(of_language, "lang string, positive double, best double")
    for row in sorted(own.where("positive > 0").collect()):
        trust = row.positive / (row.positive + 50)
        model.thresholds[row.lang] = trust * row.best + (1 - trust) * model.threshold
    return model


# --- scoring -------------------------------------------------------------------


def score(docs: DataFrame, model: Model, columns: list[str], text: str = "text") -> DataFrame:
    """``columns`` of ``docs`` and the ``score`` of each text."""
    prepare(docs.sparkSession)
    return annotate(docs, columns, model, FIELDS, text)


def limit_of(model: Model, lang: str = "lang"):
    """Column: the threshold of a row's language."""
    column = F.lit(model.threshold)
    for language, value in sorted(model.thresholds.items()):
        column = F.when(F.col(lang) == language, value).otherwise(column)
    return column


def clean_documents(docs: DataFrame, model: Model, text: str = "text", lang: str = "lang") -> DataFrame:
    """Rows of ``docs`` whose score is below the threshold of their language, all columns as they were."""
    prepare(docs.sparkSession)
    columns = docs.columns
    plain = docs.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(columns)])
    at = {c: f"c{i}" for i, c in enumerate(columns)}

    def keep(done: pa.Table) -> pa.Array:
        limits = [model.thresholds.get(x, model.threshold) for x in done.column(at[lang]).to_pylist()]
        return pa.array(done.column("score").to_numpy() < np.array(limits, float), pa.bool_())

    out = annotate(plain, plain.columns, model, FIELDS, at[text], keep=keep, output=plain.columns)
    return out.toDF(*columns)
