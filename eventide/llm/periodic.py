"""Runs of repeating words in a text, by uniting suffix classes in order of falling common prefix.

A run is a stretch of words with smallest period q, at least ``LEAST`` words and
``TIMES`` periods long, that no neighbouring word extends with the same period.
Suffixes of a text that share a prefix of l words are a class of positions. Starting
from single positions, classes are united by falling l (Kruskal's order over the
suffix array, with union-find and an ordered set of positions for each class). Two
positions that become neighbours in a set have exactly l words in common; if their
distance d is at most l, the stretch from the first one has smallest period d and
ends l words after the second. The pair at a run's first word and one period on
becomes a neighbour pair exactly once, so a pair is a run if no word before it goes on
with the period.

A run of interest has neighbours with at least a few words in common, so the suffix
array (by prefix doubling) is refined only where that many words come twice in a text.
Each text is worked on by itself, many short ones together in numpy; nothing is
shuffled.

Defined cases: words are separated by ASCII blanks; a null or empty text, or one of
blanks, has no words, no runs and an empty collapsed text. Very long texts are
worked on whole, with about a hundred bytes for each word. Runs may overlap and lie
in each other. Repeated rows and null ids are rows of their own. Only the ``columns``
asked for are kept, beside the results.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Sequence
from itertools import chain

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from eventide.llm.common import annotate, prepare

LEAST, TIMES = 6, 4

RUN = T.StructType([T.StructField(name, T.LongType()) for name in ("start", "length", "period")])
FIELDS = [
    T.StructField("n_words", T.LongType()),
    T.StructField("runs", T.ArrayType(RUN)),
    T.StructField("collapsed", T.StringType()),
]


def least_common(least: int = LEAST, times: int = TIMES) -> int:
    """Words that the first neighbours of every run have in common."""
    return max(1, min(max(least - d, (times - 1) * d) for d in range(1, least + 1)))


def _joined(first: np.ndarray, second: np.ndarray, at: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Order-keeping numbers of the pairs of ``first`` here and ``second`` at ``at``; past the text's end is lowest."""
    after = np.where(at < ends, second[np.minimum(at, len(second) - 1)], -1) + 1
    return np.unique(first * (after.max() + 1) + after, return_inverse=True)[1]


def _ranks(ids: np.ndarray, ends: np.ndarray, length: int) -> np.ndarray:
    """Numbers of the stretches of ``length`` words that begin at each position, in the order of their words."""
    here = np.arange(len(ids))
    rank, now = ids, 1
    while now < length:
        step = min(now, length - now)
        rank = _joined(rank, rank, here + step, ends)
        now += step
    return rank


def common_prefixes(ids: np.ndarray, ends: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes that share ``least`` words with another, in order, and what each shares with the one before it.

    ``ids`` are numbers of words that differ between texts, ``ends`` the end of each
    position's text. What is below ``least`` is 0.
    """
    rank = _ranks(ids, ends, least)
    counts = np.bincount(rank)
    active = np.flatnonzero(counts[rank] > 1)
    if not len(active):
        return active, active
    n = len(ids)
    # A stretch is numbered by its place in the order, so that refining one moves no other.
    rank = (np.cumsum(counts) - counts)[rank]
    begun = active[np.argsort(rank[active], kind="stable")]
    levels = [(least, rank.astype(np.int32 if n < 1 << 31 else np.int64))]
    width = least
    while len(active):
        at = active + width
        key = rank[active] * (n + 1) + np.where(at < ends[active], rank[np.minimum(at, n - 1)] + 1, 0)
        order = np.argsort(key, kind="stable")
        active, key = active[order], key[order]
        group = key // (n + 1)  # place of the old stretch
        index = np.arange(len(key))
        first_old = np.maximum.accumulate(np.where(np.append(True, group[1:] != group[:-1]), index, 0))
        new = np.append(True, key[1:] != key[:-1])
        first_new = np.maximum.accumulate(np.where(new, index, 0))
        rank[active] = group + first_new - first_old
        number = np.cumsum(new) - 1
        active = active[np.bincount(number)[number] > 1]
        width *= 2
        if len(active):
            levels.append((width, rank.astype(levels[0][1].dtype)))
    begun = begun[np.argsort(rank[begun], kind="stable")]
    x, y = begun[:-1].copy(), begun[1:].copy()
    shared = np.zeros(len(x), np.int64)
    same_text = ends[x] == ends[y]
    last = ends[begun[:-1]]
    for width, level in [*reversed(levels), *[(1, ids)] * (least - 1)]:
        equal = same_text & (np.maximum(x, y) < last)
        equal &= level[np.minimum(x, n - 1)] == level[np.minimum(y, n - 1)]
        if width == 1:  # words go on one by one, and stop at the first difference
            same_text &= equal
        step = np.where(equal, width, 0)
        x, y, shared = x + step, y + step, shared + step
    shared[shared < least] = 0
    return begun, np.append(0, shared)


def unite(suffixes: np.ndarray, shared: np.ndarray, least: int = LEAST, times: int = TIMES):
    """Neighbours (position, distance, words in common) that may seed a run, as classes are united."""
    edges = np.flatnonzero(shared)
    edges = edges[np.argsort(-shared[edges], kind="stable")]
    members = [[p] for p in suffixes.tolist()]
    root = list(range(len(members)))
    found = []

    def find(k):
        while root[k] != k:
            root[k] = root[root[k]]
            k = root[k]
        return k

    for k, l in zip(edges.tolist(), shared[edges].tolist(), strict=True):
        a, b = find(k - 1), find(k)
        if len(members[a]) < len(members[b]):
            a, b = b, a
        root[b] = a
        large, small = members[a], members[b]
        members[b] = None
        reach = l // (times - 1)  # farthest neighbours that seed
        if len(small) > 8 and len(small) * 16 > len(large):
            mine = set(small)
            large = members[a] = sorted(large + small)
            pairs = [(p, q) for p, q in zip(large, large[1:]) if q - p <= reach and (p in mine) != (q in mine)]
        else:
            pairs = []
            for nr, p in enumerate(small):
                i = bisect_left(large, p)
                if i and p - large[i - 1] <= reach and not (nr and large[i - 1] == small[nr - 1]):
                    pairs.append((large[i - 1], p))
                if i < len(large) and large[i] - p <= reach and not (nr + 1 < len(small) and small[nr + 1] < large[i]):
                    pairs.append((p, large[i]))
                large.insert(i, p)
        found += [(p, q - p, l) for p, q in pairs if l >= least - (q - p)]
    return found


def find_runs(texts: Sequence[Sequence[bytes]], least: int = LEAST, times: int = TIMES) -> list[list[tuple[int, int, int]]]:
    """Runs (start, length, period) of each text's words, in order."""
    sizes = np.array([len(t) for t in texts], np.int64)
    out = [[] for _ in texts]
    number: dict[bytes, int] = {}
    add = number.setdefault
    words = np.fromiter((add(w, len(number)) for w in chain.from_iterable(texts)), np.int64, sizes.sum())
    if not len(words):
        return out
    lasts = np.cumsum(sizes)
    text = np.repeat(np.arange(len(texts)), sizes)
    ids = np.unique(text * len(number) + words, return_inverse=True)[1]
    suffixes, shared = common_prefixes(ids, lasts[text], least_common(least, times))
    begins = lasts - sizes
    for p, d, l in unite(suffixes, shared, least, times):
        k = int(text[p])
        if p == begins[k] or ids[p - 1] != ids[p + d - 1]:
            out[k].append((p - int(begins[k]), d + l, d))
    return [sorted(r, key=lambda run: (run[0], run[2])) for r in out]


def collapse(words: Sequence[bytes], runs: Sequence[tuple[int, int, int]]) -> bytes:
    """The words but those that a run holds after its first period, joined by blanks."""
    if not runs:
        return b" ".join(words)
    gone = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        gone[start + period] += 1
        gone[start + length] -= 1
    return b" ".join([words[k] for k in np.flatnonzero(np.cumsum(gone[:-1]) == 0).tolist()])


def periodic_runs(
    docs: DataFrame,
    columns: Sequence[str] = ("doc_id",),
    text: str = "text",
    least: int = LEAST,
    times: int = TIMES,
) -> DataFrame:
    """``columns`` of ``docs``, ``n_words``, all ``runs`` and the text ``collapsed`` to each run's first period."""
    prepare(docs.sparkSession)

    def score(data, offsets):
        raw = data.tobytes()
        # Without arguments bytes are split at exactly the ASCII blanks.
        words = [raw[a:b].split() for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)]
        runs = find_runs(words, least, times)
        kept = [collapse(w, r).decode() for w, r in zip(words, runs, strict=True)]
        named = [[dict(zip(RUN.names, run, strict=True)) for run in r] for r in runs]
        return [len(w) for w in words], named, kept

    return annotate(docs, columns, score, FIELDS, text)
