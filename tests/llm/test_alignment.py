"""Alignment of two tokenizers against whole texts encoded at once and compared token by token."""

import hashlib
import random
from collections import Counter
from pathlib import Path

import numpy as np
import pytest
from brute import SCHEMA, no_docs, odd_docs

import __spark_entry__ as entry
from eventide.llm import alignment

TABLES = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(alignment.TOKENIZERS, alignment.A_FILE).exists(), reason="no tokenizers here")


@pytest.fixture(scope="module")
def both():
    folder = Path(alignment.TOKENIZERS)
    return alignment.Tokenizers((folder / alignment.A_FILE).read_text(), (folder / alignment.B_FILE).read_bytes())


def one(both, text):
    """Tokens of both sides, groups as text, and links as pairs of ids; by whole texts and byte by byte."""
    if not text:
        return 0, 0, "", []
    a = both.a.encode(" " + text, add_special_tokens=False).ids
    b = both.b.encode(text)
    raw = (" " + text).encode()
    if b"".join(both.a_bytes[k] for k in a) != raw or b"".join(both.b_bytes[k] for k in b) != raw:
        return 0, 0, "", []
    spans = []
    for ids, table in ((a, both.a_bytes), (b, both.b_bytes)):
        ends = np.cumsum([len(table[k]) for k in ids]).tolist()
        spans.append(list(zip(ids, [0, *ends[:-1]], ends)))
    links, j = [], 0
    for x, low, high in spans[0]:
        while spans[1][j][2] <= low:
            j += 1
        k = j
        while k < len(b) and spans[1][k][1] < high:
            links.append((x, spans[1][k][0]))
            k += 1
    both_end = {e for _, _, e in spans[0]} & {e for _, _, e in spans[1]}
    sides = []
    for side in spans:
        groups, now = [], []
        for k, _, e in side:
            now.append(str(k))
            if e in both_end:
                groups.append(",".join(now))
                now = []
        sides.append(groups)
    return len(a), len(b), ";".join(map("|".join, zip(*sides, strict=True))), links


def whole(both, docs):
    """Rows of every (id, text), with counts over all of them."""
    found = [(i, *one(both, t)) for i, t in docs]
    counts = Counter(p for *_, links in found for p in set(links))
    top = {}
    for (a, _), n in counts.items():
        top[a] = max(top.get(a, 0), n)
    rows = []
    for i, n_a, n_b, groups, links in found:
        best = sum(counts[p] == top[p[0]] for p in links)
        n_groups = groups.count(";") + 1 if groups else 0
        rows.append((i, n_a, n_b, n_groups, len(links), groups, best, sum(counts[p] for p in links)))
    return sorted(rows, key=repr)


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


ODD = [
    "  two  blanks \n\n lines\r\n\ttabs  ",
    "\n",
    " ",
    "a",
    "▁ lower block",
    "<|endoftext|> <s></s> <unk> <0x0A>",
    "wide blank　here and\u0085 there   end ",
    "nul\0inside \0 of it",
    "日本語 の テキスト、 ελληνικά русский العربية \U0001f600 \U0001f468‍\U0001f469 é é",
    "don't we'll I'VE 12345 3.14 ... !!!\n- x",
    "x" * 1500 + " y",
    "word\n word \nword\x1c word\x1f x",
]


def test_pieces_are_cut_where_both_end(both):
    rng = random.Random(3)
    alphabet = [" ", " ", "\n", "\t", "a", "B", "é", "0", "'s", ".", " ", " ", "日", "▁", "the", "\U0001f600", "\r", "\x1d"]
    texts = ODD + ["".join(rng.choice(alphabet) for _ in range(rng.randint(1, 60))) for _ in range(600)]
    task = alignment._Task(both, alignment.TEXT)
    for text, ids in zip(texts, task.numbers([b" " + t.encode() for t in texts]), strict=True):
        want = one(both, text)
        if not task.whole[ids].all():
            assert want[:2] == (0, 0), text
            continue
        for side, whole_text in zip(task.sides, (both.a.encode(" " + text, add_special_tokens=False).ids, both.b.encode(text)), strict=True):
            got = [int(k) for p in ids for k in side.ids[side.end[p] : side.end[p + 1]]]
            assert got == whole_text, repr(text)


def test_the_faster_engine_gives_the_same_ids(both):
    assert both.fast is not None
    # Every entry of the vocabulary that is a text by itself, and pairs of entries.
    words = [w.decode() for w in both.a_bytes[:-1] if w.isascii()]
    rng = random.Random(1)
    words += [rng.choice(words) + rng.choice(words) for _ in range(20_000)]
    want = [e.ids for e in both.a.encode_batch(words, add_special_tokens=False)]
    assert [both.fast.encode_ordinary(w) for w in words] == want


@pytest.mark.parametrize("block", [1, 1 << 25])
def test_equal_to_whole_texts(spark, both, block):
    rng = random.Random(6)
    words = ["der", "Hund", "unbelievable", "tokenization", "x1", "é", "...", "\n"]
    texts = ODD + [" ".join(rng.choice(words) for _ in range(rng.randint(0, 40))) for _ in range(40)] + [None, "", "same text", "same text"]
    docs = list(enumerate(texts)) + [(0, "again under an id"), (None, "no id")]
    df = spark.createDataFrame([(i, t, None) for i, t in docs], SCHEMA).repartition(3)
    assert rows_of(alignment.align(df, ["doc_id"], block_bytes=block).select(*SELECTED)) == whole(both, docs)


SELECTED = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups", "n_best", "count_sum"]


def test_long_texts_in_slices(both, monkeypatch):
    monkeypatch.setattr(alignment, "SLICE_TOKENS", 50)
    rng = random.Random(2)
    texts = [" ".join(rng.choice(["alpha", "betagamma", "Zürich", "42"]) for _ in range(n)) for n in (0, 400, 3, 90)]
    for mode in (alignment.TEXT, alignment.SHA256):
        task = alignment._Task(both, mode)
        task.add(list(range(4)), texts)
        for row, text in zip(task.rows, texts, strict=True):
            n_a, n_b, groups, links = one(both, text)
            want = groups if mode == alignment.TEXT else hashlib.sha256(groups.encode()).hexdigest() if groups else ""
            assert row[1:] == (n_a, n_b, groups.count(";") + 1 if groups else 0, len(links), want)


def test_defined_cases(spark, both):
    odd = odd_docs(spark, clashing=True)
    docs = [(r.doc_id, r.text) for r in odd.collect()]
    assert rows_of(alignment.align(odd).select(*SELECTED)) == whole(both, docs)
    assert alignment.align(no_docs(spark)).count() == 0


@pytest.mark.skipif(not Path(TABLES).exists(), reason="no tables here")
def test_query(spark, both):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{TABLES}/documents.parquet").select("doc_id", "text").collect()]
    want = [(*r[:5], hashlib.sha256(r[5].encode()).hexdigest() if r[5] else "", *r[6:]) for r in whole(both, docs)]
    got = entry.queries()["op13_alignment"](spark, TABLES)
    names = ["groups_sha256" if n == "groups" else n for n in SELECTED]
    assert rows_of(got.select(*names)) == sorted(want, key=repr)
