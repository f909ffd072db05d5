"""Language of a text by sparse multinomial logistic regression on character n-grams.

Texts are lower-cased, everything but letters counts as a blank, and n-grams of
one to three code points are hashed. Their counts are damped by the square root,
weighted by inverse document frequency (counted over every document of known
language) and scaled to length 1. The regression is trained by the
follow-the-regularised-leader rule with elastic-net penalties on a bounded sample:
``MAX_TRAIN`` rows of each language, or fewer of each where all would be more than
``MAX_ROWS``, but at least one, so that every language is learned however many there
are. A part kept out of it gives the temperature of the softmax. The model has 64 KB
for a language. Predictions depend on the text alone and cover whole texts, very long
ones as well.

Defined cases: a null text or one without a letter is ``und`` with score 0.0, as
is every text when no language could be learned. With one learned language all
others get it with score 1.0. Equal probabilities go to the first name. Repeated
rows count as often as they occur. Other columns do not matter.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventide.llm.common import annotate, byte_slices, prepare

MAX_TRAIN = 1500  # rows of each language in the training sample
MAX_ROWS = 60_000  # and of all of them together
PARTS = 64  # of a language in the first round of drawing them
BITS = 13  # buckets of the hashed n-grams
ORDERS = (1, 2, 3)
EPOCHS = 3
ALPHA, BETA, L1, L2 = 1.0, 1.0, 0.05, 0.05
UNKNOWN = "und"

FIELDS = [T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())]

_letters = np.zeros(0, bool)


def _letter_table() -> np.ndarray:
    """Which code points are letters."""
    global _letters
    if not len(_letters):
        _letters = np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)
    return _letters


def gram_counts(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sparse n-gram counts of texts as (text, bucket, count), sorted by text and bucket."""
    raw = data.tobytes()
    points, lengths = [], []
    for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
        # A blank on either side marks the text's ends.
        p = np.frombuffer(f" {raw[a:b].decode(errors='replace').lower()} ".encode("utf-32-le"), np.uint32)
        points.append(p)
        lengths.append(len(p))
    text = np.repeat(np.arange(len(lengths)), lengths)
    p = np.concatenate(points)
    letter = _letter_table()[p]
    # Runs of other characters become one blank.
    keep = letter.copy()
    keep[1:] |= ~letter[1:] & (letter[:-1] | (text[1:] != text[:-1]))
    keep[0] = True
    p, letter, text = p[keep], letter[keep], text[keep]
    p = np.where(letter, p, 32).astype(np.uint64)
    n, size = len(lengths), 1 << BITS
    keys = []
    for order in ORDERS:
        h = np.full(max(0, len(p) - order + 1), order, np.uint64)
        some = np.zeros(len(h), bool)
        for k in range(order):
            h = (h * np.uint64(0x9E3779B97F4A7C15)) ^ p[k : k + len(h)]
            some |= letter[k : k + len(h)]
        h = (h * np.uint64(0xD6E8FEB86659FD93)) >> np.uint64(64 - BITS)
        # Neither across texts nor of blanks alone.
        inside = some & (text[: len(h)] == text[order - 1 : order - 1 + len(h)])
        keys.append((text[: len(h)] * size + h.astype(np.int64))[inside])
    counts = np.bincount(np.concatenate(keys), minlength=n * size)
    at = np.flatnonzero(counts)
    return at // size, at % size, counts[at]


def features(text: np.ndarray, bucket: np.ndarray, count: np.ndarray, idf: np.ndarray, n: int) -> np.ndarray:
    """TF-IDF values of sparse counts, scaled to length 1 by text."""
    value = np.sqrt(count) * idf[bucket]
    norm = np.sqrt(np.bincount(text, value * value, n))
    return value / np.maximum(norm[text], 1e-12)


@dataclass
class Model:
    """Weights by bucket and language."""

    names: list[str] = field(default_factory=list)
    idf: np.ndarray | None = None
    weights: np.ndarray | None = None
    bias: np.ndarray | None = None
    temperature: float = 1.0

    def logits(self, text, bucket, value, n) -> np.ndarray:
        out = np.empty((n, len(self.names)))
        for k in range(len(self.names)):
            out[:, k] = np.bincount(text, value * self.weights[bucket, k], n)
        return out + self.bias

    def __call__(self, data: np.ndarray, offsets: np.ndarray):
        n = len(offsets) - 1
        names, scores = [UNKNOWN] * n, np.zeros(n)
        # Few texts at a time: counts are dense in (text, bucket) while they are made.
        for low in range(0, n if self.names else 0, 128):
            high = min(n, low + 128)
            part = data[offsets[low] : offsets[high]]
            text, bucket, count = gram_counts(part, offsets[low : high + 1] - offsets[low])
            value = features(text, bucket, count, self.idf, high - low)
            p = softmax(self.logits(text, bucket, value, high - low) / self.temperature)
            known = np.bincount(text, minlength=high - low) > 0
            for i in np.flatnonzero(known).tolist():
                k = int(p[i].argmax())
                names[low + i], scores[low + i] = self.names[k], p[i, k]
        return [names, scores]


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(1, keepdims=True))
    return e / e.sum(1, keepdims=True)


def _document_frequency(rows: DataFrame, text: str) -> tuple[np.ndarray, int]:
    """Documents with each bucket, over all rows, and how many rows there are."""
    size = 1 << BITS

    def count(batches):
        total, n = np.zeros(size, np.int64), 0
        for batch in batches:
            for _, _, data, offsets in byte_slices(batch.column(text)):
                for low in range(0, len(offsets) - 1, 128):
                    part = offsets[low : low + 129]
                    _, bucket, _ = gram_counts(data[part[0] : part[-1]], part - part[0])
                    total += np.bincount(bucket, minlength=size)
                    n += len(part) - 1
        at = np.append(np.flatnonzero(total), -1)
        yield pa.record_batch([pa.array(at), pa.array(np.append(total[at[:-1]], n))], ["bucket", "n"])

    # One row for each bucket at most.
    found = rows.select(text).mapInArrow(count, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    counts, n = np.zeros(size, np.int64), 0
    for row in found.collect():
        if row.bucket < 0:
            n = row.n
        else:
            counts[row.bucket] = row.n
    return counts, n


def _ftrl(rows: list[tuple[np.ndarray, np.ndarray]], y: np.ndarray, n_classes: int):
    """Weights and bias by the follow-the-regularised-leader rule, one text at a time."""
    size = 1 << BITS
    z = np.zeros((size + 1, n_classes))
    g2 = np.zeros((size + 1, n_classes))

    def weights(at):
        zz, gg = z[at], g2[at]
        w = -(zz - np.sign(zz) * L1) / ((BETA + np.sqrt(gg)) / ALPHA + L2)
        return np.where(np.abs(zz) > L1, w, 0.0)

    rng = np.random.default_rng(5)
    for _ in range(EPOCHS):
        for i in rng.permutation(len(rows)).tolist():
            bucket, value = rows[i]
            at, x = np.append(bucket, size), np.append(value, 1.0)[:, None]
            w = weights(at)
            p = softmax((w * x).sum(0)[None])[0]
            p[y[i]] -= 1
            g = x * p
            sigma = (np.sqrt(g2[at] + g * g) - np.sqrt(g2[at])) / ALPHA
            z[at] += g - sigma * w
            g2[at] += g * g
    w = weights(np.arange(size + 1))
    return w[:-1], w[-1]


def train(
    docs: DataFrame,
    max_train: int = MAX_TRAIN,
    max_rows: int = MAX_ROWS,
    doc_id: str = "doc_id",
    text: str = "text",
    lang: str = "lang",
) -> Model:
    """Model from the rows of ``docs`` that have a text and a language."""
    spark = docs.sparkSession
    prepare(spark)
    rows = docs.select(F.col(doc_id).alias("i"), F.col(lang).alias("lang"), F.col(text).alias("text"))
    rows = rows.where("lang IS NOT NULL AND text IS NOT NULL")
    names = sorted(row.lang for row in rows.select("lang").distinct().collect())
    if not names:
        return Model()
    counts, n = _document_frequency(rows, "text")
    idf = np.log((1 + n) / (1 + counts)) + 0.1
    # The sample: ids first, by hash order. Tasks keep as many of each language before the exchange, and
    # a first round in parts keeps what the last one reads of a language from growing with the tasks.
    most = max(1, min(max_train, max_rows // len(names)))
    sample = rows.select("i", "lang", F.pmod(F.xxhash64("i", F.lit(1)), F.lit(PARTS)).alias("part"))
    for keys in (["lang", "part"], ["lang"]):
        by_hash = Window.partitionBy(*keys).orderBy(F.xxhash64("i"), "i")
        sample = sample.withColumn("rank", F.row_number().over(by_hash)).where(F.col("rank") <= most).drop("rank")
    sample = sample.where("i IS NOT NULL").select("i", "lang").distinct()
    size = 1 << BITS

    def encode(batches):
        for batch in batches:
            kept = []
            for _, _, data, offsets in byte_slices(batch.column("text")):
                for low in range(0, len(offsets) - 1, 128):
                    part = offsets[low : low + 129]
                    found, bucket, count = gram_counts(data[part[0] : part[-1]], part - part[0])
                    firsts = np.searchsorted(found, np.arange(len(part)))
                    for a, b in zip(firsts[:-1].tolist(), firsts[1:].tolist(), strict=True):
                        pairs = np.stack([bucket[a:b], np.minimum(count[a:b], 1 << 30)]).astype(np.int32)
                        kept.append(pairs.tobytes())
            yield pa.record_batch([batch.column("i"), batch.column("lang"), pa.array(kept, pa.binary())], ["i", "lang", "grams"])

    chosen = rows.join(F.broadcast(sample), ["i", "lang"]).select("i", "lang", "text")
    kind = T.StructType([chosen.schema["i"], T.StructField("lang", T.StringType()), T.StructField("grams", T.BinaryType())])
    # Sparse counts: at most one pair for each bucket and row of the sample.
    found = sorted(chosen.mapInArrow(encode, kind).collect(), key=lambda r: (r.i, r.lang, bytes(r.grams)))
    data, y = [], []
    for row in found:
        bucket, count = np.frombuffer(row.grams, np.int32).reshape(2, -1)
        if len(bucket):
            value = features(np.zeros(len(bucket), np.int64), bucket, count, idf, 1)
            data.append((bucket.astype(np.int64), value))
            y.append(names.index(row.lang))
    y = np.array(y, np.int64)
    if not len(y):
        return Model()
    names_seen = sorted(set(y.tolist()))
    y = np.searchsorted(names_seen, y)
    names = [names[k] for k in names_seen]
    apart = np.arange(len(y)) % 5 == 4
    inside = np.flatnonzero(~apart)
    weights, bias = _ftrl([data[i] for i in inside], y[inside], len(names))
    model = Model(names, idf.astype(np.float64), weights, bias)
    logits = np.array([(data[i][1][:, None] * weights[data[i][0]]).sum(0) + bias for i in np.flatnonzero(apart)])
    if len(logits):
        model.temperature = _temperature(logits, y[apart])
    return model


def _temperature(logits: np.ndarray, y: np.ndarray) -> float:
    """Temperature of least log loss on rows that were not trained on.

    One further row, counted as spread evenly over the languages, keeps a set
    without a mistake from asking for certainty.
    """
    choices = np.exp(np.linspace(np.log(0.05), np.log(20), 121))
    spread = 1 / (len(y) + 1)

    def loss_at(t):
        logs = np.log(softmax(logits / t) + 1e-300)
        return -((1 - spread) * logs[np.arange(len(y)), y] + spread * logs.mean(1)).mean()

    loss = [loss_at(t) for t in choices]
    return float(choices[int(np.argmin(loss))])


def identify(docs: DataFrame, model: Model, columns: list[str], text: str = "text") -> DataFrame:
    """``columns`` of ``docs``, and ``lang_pred`` with its ``score``."""
    prepare(docs.sparkSession)
    return annotate(docs, columns, model, FIELDS, text)
