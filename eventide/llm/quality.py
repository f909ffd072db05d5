"""Quality of a text by Bradley-Terry ranking.

A document's strength is a weighted sum of its features, and the better of two
documents wins with the logistic probability of the difference of their strengths. The
weights are learned from preference pairs, a document labelled 1 over one labelled 0,
by the logistic loss on feature differences (AdaGrad steps on small batches of pairs).
Features are shares and means over the whole text (letters, upper case, digits, marks,
lengths of words and lines, repeated words and lines), and hashed sequences of three
characters by their kind: letters, digits and blanks are one kind each, runs of a kind
are drawn together, every other ASCII character is itself. Names of words are no
features.

A model is learned from a bounded sample (``MAX_TRAIN`` labelled rows of each class).
Strengths of the sample out of fold, weighted back to the class counts of all labelled
rows, give the share of documents to reject: the quantile of the scores that parts
the classes with the fewest weighted mistakes. The strength at that quantile becomes
a score of ``CUT``, with a slope from the same rows. ``above_quantile`` draws the line
at the same quantile of a whole corpus instead, found by a mergeable sketch.

Scoring streams over all documents and whole texts; nothing is shuffled.

Defined cases: a null or empty text has all features 0. Very long texts are worked on in
slices of whole texts. Without labels of both classes every score is the share of
positive labels, 0.0 without any. Null labels are not learned from; a label of a
missing document is ignored; repeated labels and rows count as often as they occur.
Equal scores are on one side of a threshold. Only the ``columns`` asked for are
kept, beside the score.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventide.llm.common import LOWER, annotate, byte_slices, prepare, run_hashes

MAX_TRAIN = 4000  # rows of each class in the training sample
BITS = 10  # buckets of the hashed sequences
FOLDS = 3
PAIRS = 120_000  # preference pairs of a fit
BATCH = 64  # pairs of a step
RATE, L2 = 0.1, 1e-4
CUT = 0.7  # score of the strength at the quantile
#: Relative rank error of the corpus quantile is at most one over this.
ACCURACY = 10_000

FIELDS = [T.StructField("score", T.DoubleType())]

# Kinds of bytes: 0 blank, 1 line feed, 2 lower, 3 upper, 4 digit, 5 beyond ASCII (letters mostly), then marks.
_KIND = np.arange(256) + 6
_KIND[[9, 11, 12, 13, 32]] = 0
_KIND[10] = 1
_KIND[97:123] = 2
_KIND[65:91] = 3
_KIND[48:58] = 4
_KIND[128:] = 5
_KIND = _KIND.astype(np.int64)

SHAPES = 16
SIZE = SHAPES + (1 << BITS)


def _distinct(text: np.ndarray, hashes: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """How many different hashes each text has, and how often its most frequent one comes."""
    order = np.lexsort((hashes, text))
    text, hashes = text[order], hashes[order]
    new = np.append(True, (text[1:] != text[:-1]) | (hashes[1:] != hashes[:-1]))[: len(text)]
    sizes = np.diff(np.append(np.flatnonzero(new), len(text)))
    most = np.zeros(n, np.int64)
    np.maximum.at(most, text[new], sizes)
    return np.bincount(text[new], minlength=n), most


def _runs(inside: np.ndarray, text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and stops of the runs of marked bytes within a text."""
    cut = np.append(True, text[1:] != text[:-1])[: len(text)]
    before = np.append(False, inside[:-1])
    after = np.append(inside[1:], False)
    ends_text = np.append(cut[1:], True)
    return np.flatnonzero(inside & (~before | cut)), np.flatnonzero(inside & (~after | ends_text)) + 1


def features(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """A row of features for each text."""
    n = len(offsets) - 1
    out = np.zeros((n, SIZE), np.float32)
    if not len(data):
        return out
    sizes = np.diff(offsets)
    text = np.repeat(np.arange(n), sizes)
    kind = _KIND[data]
    lead = (data & 0xC0) != 0x80  # bytes that begin a character
    chars = np.maximum(np.bincount(text[lead], minlength=n), 1)
    share = lambda mask, of=chars: np.bincount(text[mask], minlength=n) / of
    letters = np.maximum(np.bincount(text[lead & (kind >= 2) & (kind != 4) & (kind <= 5)], minlength=n), 1)
    starts, stops = _runs(kind > 1, text)
    of_word = text[starts]
    n_words = np.bincount(of_word, minlength=n)
    some_words = np.maximum(n_words, 1)
    lower = LOWER[data]
    unique, most = _distinct(of_word, run_hashes(lower, starts, stops), n)
    line_starts, line_stops = _runs(kind != 1, text)
    of_line = text[line_starts]
    n_lines = np.bincount(of_line, minlength=n)
    some_lines = np.maximum(n_lines, 1)
    unique_lines, most_lines = _distinct(of_line, run_hashes(lower, line_starts, line_stops), n)
    capital = kind[starts] == 3
    marked = kind[stops - 1] >= 6
    mean_word = np.bincount(of_word, stops - starts, n) / some_words
    shapes = [
        np.log1p(n_words) / 10,
        share(kind == 0) * 2,
        share(kind == 1) * 10,
        share(lead & (kind == 5)) * 3,
        share(kind == 3, letters) * 2,
        share(kind == 4) * 5,
        share(kind >= 6) * 5,
        np.minimum(mean_word, 40) / 10,
        np.bincount(of_word[capital], minlength=n) / some_words,
        np.bincount(of_word[marked], minlength=n) / some_words,
        unique / some_words,
        most / some_words * 3,
        np.where(n_words > 0, np.log1p(unique) / np.maximum(np.log1p(n_words), 1e-9), 0),
        unique_lines / some_lines,
        most_lines / some_lines,
        np.minimum(n_words / some_lines, 60) / 30,
    ]
    out[:, :SHAPES] = np.stack(shapes, 1) * (sizes > 0)[:, None]
    # Kinds with runs drawn together, three at a time within a text.
    new = np.append(True, (kind[1:] != kind[:-1]) | (text[1:] != text[:-1]))
    kind, text = kind[new].astype(np.uint64), text[new]
    code = (kind[:-2] * np.uint64(262) + kind[1:-1]) * np.uint64(262) + kind[2:]
    bucket = ((code * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - BITS)).astype(np.int64)
    inside = text[2:] == text[:-2]
    counts = np.bincount(text[2:][inside] * (1 << BITS) + bucket[inside], minlength=n << BITS).reshape(n, -1)
    grams = np.sqrt(counts)
    out[:, SHAPES:] = grams / np.maximum(np.sqrt(counts.sum(1)), 1)[:, None]
    return out


@dataclass
class Model:
    """Weights of the features, and the line that strengths are scored by."""

    weights: np.ndarray | None = None
    at: float = 0.0  # strength that scores CUT
    slope: float = 1.0
    quantile: float = 0.0  # share of documents below it
    constant: float = 0.0

    def strength(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        parts = []
        for low in range(0, len(offsets) - 1, 128):  # rows of features are dense
            part = offsets[low : low + 129]
            parts.append(features(data[part[0] : part[-1]], part - part[0]) @ self.weights)
        return np.concatenate(parts).astype(np.float64)

    def scored(self, strength: np.ndarray) -> np.ndarray:
        z = self.slope * (strength - self.at) + np.log(CUT / (1 - CUT))
        score = 1 / (1 + np.exp(-z.clip(-500, 500)))
        # On the line itself rounding must not decide.
        return np.where(strength >= self.at, np.maximum(score, CUT), np.minimum(score, np.nextafter(CUT, 0)))

    def __call__(self, data: np.ndarray, offsets: np.ndarray):
        if self.weights is None:
            return [np.full(len(offsets) - 1, self.constant)]
        return [self.scored(self.strength(data, offsets))]


def fit(x: np.ndarray, y: np.ndarray, seed: int = 11) -> np.ndarray:
    """Weights from preference pairs of rows labelled 1 over rows labelled 0."""
    rng = np.random.default_rng(seed)
    better, worse = np.flatnonzero(y == 1), np.flatnonzero(y == 0)
    w, g2 = np.zeros(x.shape[1], np.float64), np.full(x.shape[1], 1e-8)
    mean = np.zeros_like(w)
    steps = PAIRS // BATCH
    for step in range(steps):
        difference = x[rng.choice(better, BATCH)] - x[rng.choice(worse, BATCH)]
        lost = 1 / (1 + np.exp((difference @ w).clip(-30, 30)))
        grad = -(lost @ difference) / BATCH + L2 * w
        g2 += grad * grad
        w -= RATE * grad / np.sqrt(g2)
        if step >= steps // 2:  # the mean of the later steps
            mean += (w - mean) / (step - steps // 2 + 1)
    return mean.astype(np.float32)


def best_cut(z: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """Strength, and quantile of all strengths, that part the classes with the fewest weighted mistakes."""
    order = np.argsort(z, kind="stable")
    z, y, weight = z[order], y[order], weight[order]
    # Mistakes with the first k rejected, for each k where strengths differ.
    lost = np.append(0, np.cumsum(weight * (y == 1)))
    passed = np.append(0, np.cumsum((weight * (y == 0))[::-1]))[::-1]
    mistakes = lost + passed
    mistakes[1:-1][z[1:] == z[:-1]] = np.inf
    # Several cuts may be as good: the middle of the widest gap is the safest.
    good = np.flatnonzero(mistakes <= mistakes.min() * (1 + 1e-9))
    edges = np.concatenate([[z[0] - 1], z, [z[-1] + 1]])
    k = int(good[np.argmax(edges[good + 1] - edges[good])])
    share = np.append(0, np.cumsum(weight)) / weight.sum()
    return float((edges[k] + edges[k + 1]) / 2), float(share[k])


def _slope(z: np.ndarray, y: np.ndarray, weight: np.ndarray) -> float:
    """Slope of the logit by a search on the weighted likelihood around the cut.

    It leaves the sample's logits within 25, so that scores stay apart as strengths do.
    """
    choices = np.exp(np.linspace(np.log(0.01), np.log(20), 81))
    choices = choices[: max(1, int((choices * np.abs(z).max() <= 25).sum()))]
    losses = [(weight * np.logaddexp(0, np.where(y == 1, -1, 1) * (c * z + np.log(CUT / (1 - CUT))))).sum() for c in choices]
    return float(choices[int(np.argmin(losses))])


def train(
    docs: DataFrame,
    labels: DataFrame,
    max_train: int = MAX_TRAIN,
    doc_id: str = "doc_id",
    text: str = "text",
    label: str = "quality",
) -> Model:
    """Model from the labelled rows of ``docs``; at most ``max_train`` rows of each class are used."""
    prepare(docs.sparkSession)
    known = labels.select(F.col(doc_id).alias("i"), F.col(label).alias("y")).where("i IS NOT NULL AND y IN (0, 1)")
    totals = {row.y: row["count"] for row in known.groupBy("y").count().collect()}
    if len(totals) < 2:
        return Model(constant=float(1 in totals))
    order = [F.xxhash64("i"), "i"]
    sample = known.where("y = 1").orderBy(*order).limit(max_train)
    sample = sample.unionByName(known.where("y = 0").orderBy(*order).limit(max_train))
    rows = docs.select(F.col(doc_id).alias("i"), F.col(text).alias("text"))
    # The sample has at most 2 * max_train rows of a few bytes.
    rows = rows.join(F.broadcast(sample), "i").select("i", "y", "text")
    schema = T.StructType([rows.schema["i"], rows.schema["y"], T.StructField("x", T.BinaryType())])

    def encode(batches):
        for batch in batches:
            out = []
            for _, _, data, offsets in byte_slices(batch.column("text")):
                for low in range(0, len(offsets) - 1, 128):
                    part = offsets[low : low + 129]
                    out += [x.tobytes() for x in features(data[part[0] : part[-1]], part - part[0]).astype(np.float16)]
            yield pa.record_batch([batch.column("i"), batch.column("y"), pa.array(out, pa.binary())], ["i", "y", "x"])

    # About 2 KB for each row of the sample, whatever the length of its text.
    found = sorted(rows.mapInArrow(encode, schema).collect(), key=lambda r: (r.i, r.y, bytes(r.x)))
    y = np.array([r.y for r in found], np.int64)
    share = totals[1] / (totals[0] + totals[1])
    if not 0 < y.sum() < len(y):
        return Model(constant=share)
    x = np.stack([np.frombuffer(r.x, np.float16) for r in found]).astype(np.float32)
    weight = np.where(y == 1, totals[1] / y.sum(), totals[0] / (len(y) - y.sum()))
    weights = fit(x, y)
    z = (x @ weights).astype(np.float64)
    fold = np.arange(len(y)) % FOLDS
    for k in range(FOLDS):
        inside, outside = fold != k, fold == k
        if 0 < y[inside].sum() < inside.sum():
            z[outside] = x[outside] @ fit(x[inside], y[inside])
    at, quantile = best_cut(z, y, weight)
    return Model(weights, at, _slope(z - at, y, weight), quantile, share)


def score(docs: DataFrame, model: Model, columns: Sequence[str], text: str = "text") -> DataFrame:
    """``columns`` of ``docs`` and the ``score`` of each text."""
    prepare(docs.sparkSession)
    return annotate(docs, columns, model, FIELDS, text)


def above_quantile(scored: DataFrame, quantile: float, name: str = "kept") -> DataFrame:
    """``scored`` with a column that tells whether the score reaches this quantile of all scores.

    ``scored`` is read twice, so it should be a written table. Equal scores are
    kept or rejected together; at a quantile of 0 all are kept.
    """
    line = scored.agg(F.percentile_approx("score", F.lit(quantile), F.lit(ACCURACY)).alias("line")).first().line
    reached: Column = F.lit(True) if line is None or quantile <= 0 else F.col("score") >= F.lit(line)
    return scored.withColumn(name, reached)
