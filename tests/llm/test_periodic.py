"""Runs of words against every period tried at every place."""

import hashlib
import random
import re
import zlib
from pathlib import Path

import pytest
from brute import no_docs, odd_docs
from hypothesis import given, settings
from hypothesis import strategies as st

import __spark_entry__ as entry
from eventide.llm import periodic

TABLES = "/root/testdata/sf0.001"


def plain_runs(words, least=6, times=4):
    """Maximal stretches for each period, without those that a smaller period has as well."""
    n, found, seen = len(words), [], set()
    for q in range(1, n // times + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            length = j - i + q
            if j > i and length >= max(least, times * q):
                inside = words[i : i + length]
                if not any(inside[d:] == inside[:-d] for d in range(1, q)) and (i, length) not in seen:
                    seen.add((i, length))
                    found.append((i, length, q))
            i = j + 1
    return sorted(found, key=lambda r: (r[0], r[2]))


def split(text):
    return [w.encode() for w in re.findall("[^\x20\x09-\x0d]+", text or "")]


def plain_collapse(words, runs):
    gone = {k for s, n, q in runs for k in range(s + q, s + n)}
    return b" ".join(w for k, w in enumerate(words) if k not in gone)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.lists(st.sampled_from([b"a", b"b", b"c"]), max_size=60), max_size=5), st.sampled_from([(6, 4), (2, 2), (5, 3), (9, 2)]))
def test_all_runs_are_found(texts, sizes):
    got = periodic.find_runs(texts, *sizes)
    assert got == [plain_runs(t, *sizes) for t in texts]


def test_periodic_texts():
    rng = random.Random(4)
    texts = []
    for _ in range(150):
        words = []
        for _ in range(rng.randint(1, 5)):
            base = [rng.choice([b"x", b"y", b"z", b"w"]) for _ in range(rng.randint(1, 12))]
            n = rng.randint(1, 60)
            words += (base * 60)[:n] + [rng.choice([b"q", b"r"]) for _ in range(rng.randint(0, 3))]
        texts.append(words * rng.choice([1, 1, 2, 5]))
    assert periodic.find_runs(texts) == [plain_runs(t) for t in texts]
    for words in texts:
        runs = plain_runs(words)
        assert periodic.collapse(words, runs) == plain_collapse(words, runs)


def test_long_texts_are_linear():
    n = 300_000
    assert periodic.find_runs([[b"a"] * n]) == [[(0, n, 1)]]
    blocks = ([b"a"] * 300 + [b"b"]) * 1000
    runs = periodic.find_runs([blocks])[0]
    assert (0, len(blocks), 301) in runs and len(runs) == 1001


def rows(df):
    return sorted(((r.doc_id, r.n_words, [tuple(x) for x in r.runs], r.collapsed) for r in df.collect()), key=repr)


def test_defined_cases(spark):
    odd = odd_docs(spark, clashing=True)
    want = []
    for r in odd.collect():
        words = split(r.text)
        runs = [(0, 40_000, 2)] if r.doc_id == 8 else plain_runs(words)
        want.append((r.doc_id, len(words), runs, plain_collapse(words, runs).decode()))
    assert rows(periodic.periodic_runs(odd)) == sorted(want, key=repr)
    assert periodic.periodic_runs(no_docs(spark)).count() == 0


def sha(raw):
    return hashlib.sha256(raw).hexdigest()


def contract(doc_id, text):
    words = split(text)
    n = len(words)
    h = zlib.crc32(str(doc_id).encode())
    g = h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = plain_runs(words)
    s, length, q = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else (None,) * 3
    listed = "".join(f"{a},{b},{c}\n" for a, b, c in runs)
    exponent = 1000 * length // q if runs else None
    return doc_id, len(runs), s, length, q, exponent, sha(listed.encode()), sha(plain_collapse(words, runs))


@pytest.mark.skipif(not Path(TABLES).exists(), reason="no tables here")
def test_query(spark):
    docs = spark.read.parquet(f"{TABLES}/documents.parquet").select("doc_id", "text").collect()
    got = {r.doc_id: tuple(r) for r in entry.queries()["op12_periodic_runs"](spark, TABLES).select(*NAMES).collect()}
    checked = [r for r in docs if len(r.text or "") < 6000 or zlib.crc32(str(r.doc_id).encode()) % 10 == 0]
    assert len(got) == len(docs) and len(checked) > 100
    for r in checked:
        assert got[r.doc_id] == contract(r.doc_id, r.text)
    assert sum(row[1] > 0 for row in got.values()) > 5


NAMES = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]


def test_query_on_odd_rows(spark, tmp_path):
    texts = {20: None, 21: "", 22: "a " * 9, 9: "x y z " * 5, 23: "alone"}
    # Some ids whose texts the query makes periodic.
    texts |= {i: " ".join(f"w{k}" for k in range(i % 37)) for i in range(100, 400) if zlib.crc32(str(i).encode()) % 10 == 0}
    spark.createDataFrame([(i, t, 1) for i, t in texts.items()], "doc_id long, text string, runs int").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: tuple(r) for r in entry.queries()["op12_periodic_runs"](spark, str(tmp_path)).select(*NAMES).collect()}
    assert got == {i: contract(i, t) for i, t in texts.items()}
