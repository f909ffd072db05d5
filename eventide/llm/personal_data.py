"""Personal data: candidate spans, scored by gradient-boosted trees.

Generators of high recall propose spans that may overlap: the strict formats
(email, ip, card, phone; see ``strict_spans``), strings of their shape that fail a
check, written-out mail addresses and any longer grouping of digits. Boosted trees
over features of format and context give each candidate a probability. There are no
labels for personal data, so the trees learn from what the strict formats and their
checks decide, on all candidates of all texts, by shape and
context alone: features do not show what tells a strict span from its loose kind
(the sign before a phone number, ``@`` or its words, the outcome of a check). Strict
spans count as personal examples of their loose kind. Loose spans outside strict ones
count as not personal if they fail a check, or are a plain number without a hint near
it; what is left (written-out addresses, numbers with a hint) has no label. Thresholds
by kind are calibrated on a quarter of the candidates that was not trained on, at
``PRECISION``; a kind without a personal example there has the threshold of all kinds
together. Strict spans are always selected; loose ones are if they pass their
threshold and overlap no selected span (the likelier one first).

Texts are searched whole and once: candidates with their features are written to a
table, from which both the training and the selection are made. Cuts are quantiles of
all candidates; candidates that no cut tells apart become one row with their number. Trees grow
level by level on sums over these rows, which the tasks add up where there are more than
``HELD_ROWS`` of them. Thresholds are exact to ``STEPS`` of the probability.

Defined cases: null and empty texts have no spans. Positions are code points, the
end exclusive. A very long text is searched whole, and the time it takes grows with its length
and, but for sorting, its number of spans. Repeated rows are treated alike. Without a candidate of both
outcomes only strict spans are selected. Other columns do not matter.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterable
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventide.llm.common import annotate, prepare, saved

STRICT = ("email", "ip", "card", "phone")
LOOSE = ("mail_words", "ip_like", "card_like", "number")
KINDS = STRICT + LOOSE
HELD_ROWS = 50_000  # rows of the training that are held in one place
STEPS = 1 << 16  # of a probability, for the thresholds
PRECISION = 0.95
CONTEXT = 32  # code points looked at on either side

_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
# A match of these starts where a run of digits does, and no shorter part of a run
# would match where the whole does not, so they need not go back.
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_NUMBER = re.compile(r"(?<![A-Za-z0-9])\(?[0-9](?:[\x20().-]{0,2}[0-9])++(?![A-Za-z0-9])")
_MAIL = re.compile(
    r"[A-Za-z0-9._%+-]{1,64}\x20?[(\[]at[)\]]\x20?[A-Za-z0-9-]{1,64}"
    r"(?:(?:\x20?[(\[]dot[)\]]\x20?|\.)[A-Za-z0-9-]{1,64})+"
)
_AT = re.compile(r"\x20?[(\[]at[)\]]\x20?")
_DOT = re.compile(r"\x20?[(\[]dot[)\]]\x20?")
_HINTS = tuple(
    re.compile(p, re.IGNORECASE)
    for p in (r"phone|tel|call|fax|mobil|cell", r"mail|contact|write", r"card|visa|credit|pay|account", r"\bip\b|host|server|addr")
)


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c) * (1 + k % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def _emails(text: str):
    end, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            end = domain.end()
            yield start, end
        at = text.find("@", max(at + 1, end))


def candidates(text: str, n_digits: int) -> list[tuple[int, int, int]]:
    """(start, kind, stop) of all candidates; a loose kind takes what fails the strict one's check."""
    out = []
    if "@" in text:
        out += [(a, 0, b) for a, b in _emails(text)]
    if n_digits >= 4:
        for m in _IP.finditer(text):
            good = all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in m[0].split("."))
            out.append((m.start(), 1 if good else 5, m.end()))
    if n_digits >= 7:
        for m in _CARD.finditer(text):
            digits = _digits(m[0])
            if len(digits) >= 12:
                out.append((m.start(), 2 if len(digits) <= 19 and luhn(digits) else 6, m.end()))
        if "+" in text:
            for m in _PHONE.finditer(text):
                if 9 <= len(_digits(m[0])) <= 15:
                    out.append((m.start(), 3, m.end()))
        for m in _NUMBER.finditer(text):
            if 7 <= len(_digits(m[0])) <= 19:
                out.append((m.start(), 7, m.end()))
    if "at)" in text or "at]" in text:
        out += [(m.start(), 4, m.end()) for m in _MAIL.finditer(text)]
    return sorted(out)


def features(text: str, start: int, stop: int) -> list[float]:
    """Format of a span and hints around it; the same for a strict span and one of its loose kind."""
    span = _DOT.sub(".", _AT.sub("@", text[start:stop][:256])).lstrip("+")
    before, after = text[max(0, start - CONTEXT) : start], text[stop : stop + CONTEXT]
    n = len(_digits(span))
    groups = [len(g) for g in re.findall(r"[0-9]+", span)]
    return [
        float(len(span)),
        float(n),
        n / len(span),
        float(len(groups)),
        float(max(groups, default=0)),
        float(min(groups, default=0)),
        float(span.count(".")),
        float(span.count("-")),
        float(span.count(" ")),
        float("(" in span),
        float("@" in span),
        float(before[-1:].isalnum()),
        float(after[:1].isalnum()),
        *[float(bool(hint.search(before) or hint.search(after[:12]))) for hint in _HINTS],
    ]


_CANDIDATE = T.StructType(
    [
        T.StructField("start", T.LongType()),
        T.StructField("kind", T.IntegerType()),
        T.StructField("stop", T.LongType()),
        T.StructField("features", T.ArrayType(T.FloatType())),
    ]
)
_SPAN = T.StructType(
    [T.StructField("start", T.LongType()), T.StructField("kind", T.StringType()), T.StructField("stop", T.LongType())]
)


def _found(data: np.ndarray, offsets: np.ndarray):
    """Decoded text and candidates of each text; text is empty where there are none."""
    digit = np.concatenate([[0], np.cumsum((data >= 48) & (data <= 57))])
    n_digits = digit[offsets[1:]] - digit[offsets[:-1]]
    at = np.concatenate([[0], np.cumsum(data == 64)])
    n_at = at[offsets[1:]] - at[offsets[:-1]]
    raw = data.tobytes()
    for a, b, d, m in zip(offsets[:-1].tolist(), offsets[1:].tolist(), n_digits.tolist(), n_at.tolist(), strict=True):
        part = raw[a:b]
        if d < 4 and not m and b"at)" not in part and b"at]" not in part:
            yield "", []
        else:
            text = part.decode(errors="replace")
            yield text, candidates(text, d)


def _propose(data: np.ndarray, offsets: np.ndarray):
    return [
        [
            [
                {"start": a, "kind": k, "stop": b, "features": features(text, a, b)}
                for a, k, b in found
            ]
            for text, found in _found(data, offsets)
        ]
    ]


# --- boosted trees ---------------------------------------------------------------


@dataclass
class Model:
    """Trees of depth 3 as arrays (feature, cut, leaf values), and thresholds by kind."""

    trees: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = field(default_factory=list)
    base: float = 0.0
    thresholds: dict[int, float] = field(default_factory=dict)
    common: float = 2.0  # of kinds without one of their own

    def probability(self, x: np.ndarray) -> np.ndarray:
        z = np.full(len(x), self.base)
        for feature, cut, leaf in self.trees:
            z += leaf[_leaf(x, feature, cut)]
        return 1 / (1 + np.exp(-z))


def _leaf(x, feature, cut, depth: int = 3):
    """Leaf of each row, or its node at ``depth``; inner node k has the children 2k + 1 and 2k + 2."""
    node = np.zeros(len(x), np.int64)
    for _ in range(depth):
        node = 2 * node + 1 + (x[np.arange(len(x)), feature[node]] > cut[node])
    return node - (2**depth - 1)


def _cuts(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Where a feature is cut: between all of few values, at quantiles of many; ``values`` ascend."""
    if len(values) <= 32:
        return values[:-1].astype(float)
    places = np.linspace(0, 1, 33)[1:-1] * (counts.sum() - 1)
    ends = np.cumsum(counts)
    low = values[np.searchsorted(ends, np.floor(places), "right")].astype(float)
    high = values[np.searchsorted(ends, np.ceil(places), "right")].astype(float)
    return np.unique(low + (high - low) * (places - np.floor(places)))


def _places(x: np.ndarray, cuts: list[np.ndarray]) -> np.ndarray:
    """How many cuts of its feature a value is above."""
    return np.stack([np.searchsorted(values, x[:, f]) for f, values in enumerate(cuts)], 1).astype(np.uint8)


_NO_CUT = 255  # no value is above as many cuts


def _logit(places: np.ndarray, base: float, trees: list) -> np.ndarray:
    z = np.full(len(places), base)
    for feature, place, leaf in trees:
        z += leaf[_leaf(places, feature, place)]
    return z


def _sums(places, y, n, base, trees, feature, place, depth, width) -> np.ndarray:
    """Gradient and curvature by node at ``depth``, feature and place, in whole numbers: the same in any order."""
    p = 1 / (1 + np.exp(-_logit(places, base, trees)))
    node = _leaf(places, feature, place, depth) * width
    out = np.zeros((2, 2**depth, places.shape[1], width), np.int64)
    for k, value in enumerate((p - y, p * (1 - p))):
        value = np.rint(value * (1 << 24)) * n
        for f in range(places.shape[1]):
            out[k, :, f] = np.bincount(node + places[:, f], value, 2**depth * width).reshape(-1, width).astype(np.int64)
    return out


def _boosted(cuts: list[np.ndarray], base: float, sums, rounds: int) -> list:
    """Trees on gradients, by place; the best cut of each node by gain. ``sums`` is ``_sums`` over all rows."""
    trees, width = [], max(map(len, cuts)) + 1
    for _ in range(rounds):
        feature, place, leaf = np.zeros(7, np.int64), np.full(7, _NO_CUT), np.zeros(8)
        for depth in range(3):
            found = sums(base=base, trees=trees, feature=feature, place=place, depth=depth, width=width) / (1 << 24)
            feature, place = feature.copy(), place.copy()
            for node in range(2**depth):
                k, best = 2**depth - 1 + node, 1e-6
                g, h = found[:, node, 0].sum(1)
                left = g, h
                for f, values in enumerate(cuts):
                    if not len(values):
                        continue
                    gl, hl = np.cumsum(found[:, node, f, : len(values)], 1)
                    gain = gl**2 / (hl + 1) + (g - gl) ** 2 / (h - hl + 1) - g**2 / (h + 1)
                    gain[(hl < 1) | (h - hl < 1)] = 0
                    if gain.max() > best:
                        at = int(gain.argmax())
                        best, feature[k], place[k], left = gain[at], f, at, (gl[at], hl[at])
                if depth == 2:
                    leaf[2 * node] = -0.2 * left[0] / (left[1] + 1)
                    leaf[2 * node + 1] = -0.2 * (g - left[0]) / (h - left[1] + 1)
        trees.append((feature, place, leaf))
    return trees


def _model(cuts, totals, sums, scored, rounds, precision) -> Model:
    """Model from ``totals`` (rows of label 0 and 1 that are trained on), their ``_sums``, and what ``scored`` says.

    ``scored(base, trees)`` has kind, label, probability and number of the rows set apart.
    """
    share = (totals[1] / max(1, sum(totals))).clip(1e-3, 1 - 1e-3)
    model = Model(base=float(np.log(share / (1 - share))))
    trees = _boosted(cuts, model.base, sums, rounds)
    for feature, place, leaf in trees:
        cut = [np.inf if k == _NO_CUT else cuts[f][k] for f, k in zip(feature, place, strict=True)]
        model.trees.append((feature, np.array(cut), leaf))
    kind, y, p, n = scored(model.base, trees)
    model.common = _threshold(p, y, n, precision)
    for k in np.unique(kind).tolist():
        mine = kind == k
        if y[mine].any():
            model.thresholds[k] = _threshold(p[mine], y[mine], n[mine], precision)
    return model


def _fit_held(places, y, kind, n, apart, cuts, rounds=40, precision=PRECISION) -> Model:
    """Model from rows that are all here, ``n`` of each."""

    def sums(**at):
        return _sums(places[~apart], y[~apart], n[~apart], **at)

    def scored(base, trees):
        p = 1 / (1 + np.exp(-_logit(places[apart], base, trees)))
        return kind[apart], y[apart], np.rint(p * STEPS) / STEPS, n[apart]

    totals = np.bincount(y[~apart].astype(int), n[~apart], 2)
    return _model(cuts, totals, sums, scored, rounds, precision)


def fit(x: np.ndarray, y: np.ndarray, kind: np.ndarray, rounds: int = 40, precision: float = PRECISION) -> Model:
    """Boosted trees for y (0 or 1), and the least threshold of each kind that keeps the precision; without Spark."""
    if not 0 < y.sum() < len(y):
        return Model()
    cuts = [_cuts(*np.unique(x[:, f], return_counts=True)) for f in range(x.shape[1])]
    n = np.ones(len(y), np.int64)
    return _fit_held(_places(x, cuts), y, kind, n, np.arange(len(y)) % 4 == 3, cuts, rounds, precision)


def _threshold(p: np.ndarray, y: np.ndarray, n: np.ndarray, precision: float) -> float:
    """Halfway between the least probability that keeps the precision and the next one below; 2 if none keeps it."""
    order = np.argsort(-p, kind="stable")
    p, y, n = p[order], y[order], n[order]
    good = np.cumsum(y * n) / np.maximum(np.cumsum(n), 1)
    # Equal ones pass together.
    last = np.append(p[1:] != p[:-1], True)[: len(order)]
    reached = np.flatnonzero((good >= precision) & last)
    if not len(reached):
        return 2.0
    return float(p[reached[-1]] + np.append(p, 0.0)[reached[-1] + 1]) / 2


class _Covered:
    """The places that spans cover, as sorted stretches apart from each other."""

    def __init__(self, spans: Iterable[tuple[int, int]]):
        self.starts: list[int] = []
        self.stops: list[int] = []
        for start, stop in sorted(spans):
            if self.stops and start <= self.stops[-1]:
                self.stops[-1] = max(self.stops[-1], stop)
            else:
                self.starts.append(start)
                self.stops.append(stop)

    def overlaps(self, start: int, stop: int) -> bool:
        k = bisect_left(self.starts, stop) - 1
        return k >= 0 and self.stops[k] > start

    def add(self, start: int, stop: int) -> None:
        """A further span, which must overlap none."""
        k = bisect_left(self.starts, start)
        self.starts.insert(k, start)
        self.stops.insert(k, stop)


def _labels(found: list) -> list[tuple[int, float, list[float]]]:
    """(loose kind, label, features) of strict spans and of the loose ones outside them that have a label."""
    strict = [c for c in found if c["kind"] < len(STRICT)]
    covered = _Covered((c["start"], c["stop"]) for c in strict)
    failed = _Covered((c["start"], c["stop"]) for c in found if KINDS[c["kind"]] in ("ip_like", "card_like"))
    out = [(c["kind"] + len(STRICT), 1.0, c["features"]) for c in strict]
    for c in found:
        if c["kind"] < len(STRICT) or covered.overlaps(c["start"], c["stop"]):
            continue
        plain = KINDS[c["kind"]] == "number" and not any(c["features"][-len(_HINTS) :])
        if plain or KINDS[c["kind"]] != "mail_words" and failed.overlaps(c["start"], c["stop"]):
            out.append((c["kind"], 0.0, c["features"]))
    return out


def _examples(proposed: DataFrame) -> DataFrame:
    """What has a label of the rows that ``propose`` has written: kind, label, whether set apart, features, number."""
    rows = proposed.where(F.size("found") > 0)

    def listed(batches):
        kind = pa.struct([("kind", pa.int32()), ("label", pa.int32()), ("features", pa.binary())])
        for batch in batches:
            out = [
                [{"kind": k, "label": int(y), "features": np.array(x, np.float32).tobytes()} for k, y, x in _labels(row)]
                for row in batch.column("found").to_pylist()
            ]
            yield pa.record_batch([batch.column("doc_id"), pa.array(out, pa.list_(kind))], ["doc_id", "c"])

    example = T.ArrayType(
        T.StructType(
            [
                T.StructField("kind", T.IntegerType()),
                T.StructField("label", T.IntegerType()),
                T.StructField("features", T.BinaryType()),
            ]
        )
    )
    schema = T.StructType([rows.schema["doc_id"], T.StructField("c", example)])
    each = rows.select("doc_id", "found").mapInArrow(listed, schema).select("doc_id", F.posexplode("c").alias("nr", "c"))
    # Every fourth row in the order of a hash is set apart, so also few rows are shared out evenly.
    ordered = each.orderBy(F.xxhash64("doc_id", "nr"), "doc_id", "nr")
    ordered = saved(ordered.select("c.*", F.monotonically_increasing_id().alias("at")), "ordered")
    part, starts, before = F.shiftright("at", 33), [], 0
    for row in sorted(ordered.groupBy(part.alias("part")).count().collect()):
        starts += [F.lit(row.part), F.lit(before % 4)]
        before += row["count"]
    place = F.element_at(F.create_map(*starts), part) + F.col("at") % 4 if starts else F.lit(0)
    return ordered.select("kind", "label", "features", (place % 4 == 3).alias("apart")).groupBy(
        "kind", "label", "apart", "features"
    ).agg(F.count("*").alias("n"))


def _gathered(batches, width: int, kind):
    """Columns of Arrow batches, of many rows at a time; ``features`` as an array of ``width`` columns."""
    held = []

    def done():
        rows = pa.Table.from_batches(held)
        held.clear()
        x = np.frombuffer(b"".join(rows.column("features").to_pylist()), kind).reshape(-1, width)
        return x, rows

    for batch in batches:
        held.append(batch)
        if sum(b.num_rows for b in held) >= HELD_ROWS:
            yield done()
    if held:
        yield done()


def _value_counts(examples: DataFrame, width: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Values and their number by feature; a span's 256 code points give few of them."""

    def count(batches):
        for x, rows in _gathered(batches, width, np.float32):
            for f in range(width):
                values, where = np.unique(x[:, f], return_inverse=True)
                n = np.bincount(where, rows.column("n").to_numpy()).astype(np.int64)
                columns = [pa.array(np.full(len(values), f), pa.int32()), pa.array(values), pa.array(n)]
                yield from pa.table(columns, ["f", "value", "n"]).to_batches()

    found = examples.select("features", "n").mapInArrow(count, "f int, value float, n long")
    found = found.groupBy("f", "value").agg(F.sum("n").alias("n")).toArrow().sort_by([("f", "ascending"), ("value", "ascending")])
    f, value, n = (found.column(c).to_numpy() for c in found.column_names)
    return [(value[f == k], n[f == k]) for k in range(width)]


def train(proposed: DataFrame) -> Model:
    """Model from all candidates with a label of the rows that ``propose`` has written."""
    examples = saved(_examples(proposed), "examples")
    labels = {row.label for row in examples.select("label").distinct().collect()}
    if len(labels) < 2:
        return Model()
    width = len(features("0", 0, 1))
    cuts = [_cuts(*counts) for counts in _value_counts(examples, width)]

    def place(batches):
        for x, rows in _gathered(batches, width, np.float32):
            placed = pa.array([row.tobytes() for row in _places(x, cuts)], pa.binary())
            for batch in rows.set_column(rows.column_names.index("features"), "features", placed).to_batches():
                yield batch

    placed = examples.mapInArrow(place, examples.schema).groupBy("kind", "label", "apart", "features")
    placed = saved(placed.agg(F.sum("n").alias("n")), "placed")
    if placed.count() <= HELD_ROWS:
        rows = placed.toArrow()
        x = np.frombuffer(b"".join(rows.column("features").to_pylist()), np.uint8).reshape(-1, width)
        kind, y, n = (rows.column(c).to_numpy() for c in ("kind", "label", "n"))
        return _fit_held(x, y, kind, n, np.array(rows.column("apart").to_pylist(), bool), cuts)
    return _fit_spread(placed, cuts)


def _fit_spread(placed: DataFrame, cuts: list[np.ndarray], rounds: int = 40, precision: float = PRECISION) -> Model:
    """As ``_fit_held``, of a table of rows: the tasks add up theirs, and the sums come to the driver."""
    inside, outside = placed.where("NOT apart").select("label", "features", "n"), placed.where("apart")

    def sums(**at):
        def run(batches):
            total = 0
            for x, rows in _gathered(batches, len(cuts), np.uint8):
                total = total + _sums(x, rows.column("label").to_numpy(), rows.column("n").to_numpy(), **at)
            if not np.isscalar(total):
                yield pa.record_batch([pa.array([total.tobytes()])], ["sums"])

        parts = [np.frombuffer(row.sums, np.int64) for row in inside.mapInArrow(run, "sums binary").collect()]
        zeros = np.zeros((2, 2 ** at["depth"], len(cuts), at["width"]), np.int64)
        return sum((part.reshape(zeros.shape) for part in parts), zeros)

    def scored(base, trees):
        def run(batches):
            for x, rows in _gathered(batches, len(cuts), np.uint8):
                p = np.rint(STEPS / (1 + np.exp(-_logit(x, base, trees)))).astype(np.int32)
                yield from pa.table([*(rows.column(c) for c in ("kind", "label", "n")), pa.array(p)], ["kind", "label", "n", "p"]).to_batches()

        found = outside.mapInArrow(run, "kind int, label int, n long, p int")
        # At most a row for each kind, label and step.
        found = found.groupBy("kind", "label", "p").agg(F.sum("n").alias("n")).toArrow()
        kind, y, p, n = (found.column(c).to_numpy() for c in ("kind", "label", "p", "n"))
        return kind, y, p / STEPS, n

    totals = np.zeros(2)
    for row in inside.groupBy("label").agg(F.sum("n").alias("n")).collect():
        totals[row.label] = row.n
    return _model(cuts, totals, sums, scored, rounds, precision)


def selected(found: list[tuple[int, int, int]], p: np.ndarray, model: Model) -> list[tuple[int, int, int]]:
    """Strict spans, and loose ones over their threshold that overlap no span selected before."""
    out = [c for c in found if c[1] < len(STRICT)]
    taken = _Covered((a, b) for a, _, b in out)
    loose = [
        (-p[i], c) for i, c in enumerate(found) if c[1] >= len(STRICT) and p[i] >= model.thresholds.get(c[1], model.common)
    ]
    for _, (a, k, b) in sorted(loose):
        if not taken.overlaps(a, b):
            out.append((a, k, b))
            taken.add(a, b)
    return sorted(out)


def propose(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Candidates of every text with their features, as a table."""
    prepare(docs.sparkSession)
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    return saved(annotate(rows, ["doc_id"], _propose, [T.StructField("found", T.ArrayType(_CANDIDATE))]), "candidates")


def select_spans(proposed: DataFrame, model: Model) -> DataFrame:
    """``doc_id`` and the selected ``spans`` of the rows that ``propose`` has written."""

    def choose(batches):
        for batch in batches:
            out = []
            for row in batch.column("found").to_pylist():
                found = [(c["start"], c["kind"], c["stop"]) for c in row]
                p = model.probability(np.array([c["features"] for c in row], np.float32)) if row else np.zeros(0)
                out.append([{"start": a, "kind": KINDS[k], "stop": b} for a, k, b in selected(found, p, model)])
            kind = pa.list_(pa.struct([("start", pa.int64()), ("kind", pa.string()), ("stop", pa.int64())]))
            yield pa.record_batch([batch.column("doc_id"), pa.array(out, kind)], ["doc_id", "spans"])

    schema = T.StructType([proposed.schema["doc_id"], T.StructField("spans", T.ArrayType(_SPAN))])
    return proposed.select("doc_id", "found").mapInArrow(choose, schema)


def redact(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``docs`` with every selected span replaced by its kind in brackets; overlapping ones as one span."""
    prepare(docs.sparkSession)
    columns = docs.columns
    plain = docs.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(columns)])
    at = f"c{columns.index(text)}"

    def replace(data, offsets):
        raw = data.tobytes()
        bounds = zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)
        out = []
        for (low, high), (body, found) in zip(bounds, _found(data, offsets), strict=True):
            if not found:
                out.append(raw[low:high].decode(errors="replace"))
                continue
            x = np.array([features(body, a, b) for a, _, b in found], np.float32)
            parts, end = [], 0
            for a, k, b in selected(found, model.probability(x), model):
                if a >= end:
                    parts += [body[end:a], f"[{KINDS[k]}]"]
                end = max(end, b)
            out.append("".join([*parts, body[end:]]))
        return [out]

    done = annotate(plain, plain.columns, replace, [T.StructField("redacted", T.StringType())], at)
    new = [F.when(F.col(at).isNotNull(), F.col("redacted")) if c == text else F.col(f"c{i}") for i, c in enumerate(columns)]
    return done.select(*[n.alias(c) for n, c in zip(new, columns, strict=True)])
