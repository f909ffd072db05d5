"""Suffix, line and near-duplicate operators against brute force."""

import random
import time

import pytest
from brute import components, no_docs, odd_docs, one_edit, removed_lines, repeats, sha

from eventide.llm import line_dedup, near_dedup, suffix_dedup
from eventide.llm.components import components as connected


def texts(seed, n=60):
    """Documents that share passages, with single words changed here and there."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdeé") for _ in range(rng.randint(2, 7)))
    passages = [" ".join(word() for _ in range(rng.randint(5, 60))) for _ in range(12)]
    out = []
    for i in range(n):
        lines = [rng.choice(passages) for _ in range(rng.randint(0, 5))]
        lines += [" ".join(word() for _ in range(rng.randint(1, 30))) for _ in range(rng.randint(0, 3))]
        rng.shuffle(lines)
        text = "\n".join(lines)
        if text and rng.random() < 0.5:
            k = rng.randrange(len(text))
            text = text[:k] + rng.choice(["", "x", "xy "]) + text[k + rng.randint(0, 1) :]
        out.append((i * 3 - 7, text))
    out += [(1000 + i, t) for i, t in enumerate(["ab" * 300, "a" * 500, "a" * 450, None, "", "ab" * 310])]
    return out


# --- suffix arrays ----------------------------------------------------------------


def test_sorted_suffixes_are_all_suffixes_in_order():
    rng = random.Random(3)
    for _ in range(20):
        strings = [bytes(rng.choice(b"ab\x00\xff") for _ in range(rng.randint(1, 12))) for _ in range(rng.randint(1, 8))]
        who, size, lcp = suffix_dedup.sorted_suffixes(strings)
        found = [(strings[w][len(strings[w]) - s :], w) for w, s in zip(who.tolist(), size.tolist(), strict=True)]
        assert found == sorted((s[k:], i) for i, s in enumerate(strings) for k in range(len(s) + 1))
        for (a, _), (b, _), shared in zip(found[:-1], found[1:], lcp.tolist()[1:], strict=True):
            same = next((k for k, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), min(len(a), len(b)))
            assert shared == same


@pytest.mark.parametrize("window, hot", [(100, False), (40, False), (40, True)])
def test_repeated_bytes_go(spark, monkeypatch, window, hot):
    if hot:  # so that few pieces already count as many
        monkeypatch.setattr(suffix_dedup, "HOME", 2)
        monkeypatch.setattr(suffix_dedup, "HOT", 3)
        monkeypatch.setattr(suffix_dedup, "GROUP", 8)
    monkeypatch.setattr(suffix_dedup, "BUCKET_BYTES", 4000)
    docs = texts(window)
    rows = suffix_dedup.remove_repeats(spark.createDataFrame(docs, "doc_id long, text string").repartition(5), window).collect()
    found = {r.doc_id: (sum(s.stop - s.start for s in r.removed), len(r.removed), bytes(r.kept)) for r in rows}
    assert found == repeats(docs, window)


def test_long_text_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "BLOCK", 64)
    docs = texts(5)
    rows = suffix_dedup.remove_repeats(spark.createDataFrame(docs, "doc_id long, text string"), 40).collect()
    assert {r.doc_id: sha(bytes(r.kept)) for r in rows} == {i: sha(k) for i, (_, _, k) in repeats(docs, 40).items()}


def test_suffix_odd_cases(spark):
    rows = suffix_dedup.remove_repeats(odd_docs(spark, clashing=True), 40).collect()
    assert len(rows) == odd_docs(spark).count()
    by_id = {}
    for r in rows:
        by_id.setdefault(r.doc_id, []).append(r)
    assert by_id[None][0].removed == [] and by_id[1][0].n_bytes == 0
    # A row does not remove from its own copy, but both remove from a later document.
    assert [r.removed for r in by_id[5]] == [[], []] and bytes(by_id[6][0].kept) == b""
    assert len(by_id[8][0].kept) < 60
    assert suffix_dedup.remove_repeats(no_docs(spark)).count() == 0


# --- lines ------------------------------------------------------------------------


def test_lines_near_an_earlier_one_go(spark):
    rng = random.Random(11)
    base = ["".join(rng.choice("abcd ") for _ in range(rng.randint(18, 60))).strip(" ") for _ in range(25)]
    docs = []
    for i in range(70):
        lines = []
        for _ in range(rng.randint(0, 6)):
            line = rng.choice(base)
            if rng.random() < 0.6:
                k = rng.randrange(len(line))
                line = rng.choice([line[:k] + line[k + 1 :], line[:k] + "é" + line[k:], line[:k] + "Z" + line[k + 1 :]])
            lines.append(rng.choice(["", " ", "\t"]) + line + rng.choice(["", "\r"]))
        docs.append((i, "\n".join(lines)))
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    rows = line_dedup.dedup_lines(df).collect()
    expected = removed_lines(docs)
    assert {r.doc_id: r.removed for r in rows} == expected
    texts_by_id = dict(docs)
    for r in rows:
        kept = [x for k, x in enumerate(texts_by_id[r.doc_id].split("\n")) if k not in expected[r.doc_id]]
        assert r.text == "\n".join(kept) or not expected[r.doc_id]


def test_a_shorter_line_between_longer_ones_is_met(spark):
    short = "abcdefghijklmnopqrstuvwxyz012345"
    longer = [short[:k] + c + short[k:] for k, c in ((1, "X"), (3, "Y"), (2, "Z"), (32, "Q"), (31, "R"))]
    for lines in ([longer[0], short, *longer[1:]], [*longer[:2], short, longer[2]], [short, *longer], [*longer, short]):
        docs = list(enumerate(lines))
        df = spark.createDataFrame(docs, "doc_id long, text string")
        assert {r.doc_id: r.removed for r in line_dedup.dedup_lines(df).collect()} == removed_lines(docs)


def test_equal_short_lines_go_if_asked(spark):
    docs = [(1, "x\n\n y \nx"), (2, "X\nz\n \nabcdefghij klmnopqrstu"), (3, "w\nabcdefghij klmnopqrst\nY")]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    rows = line_dedup.dedup_lines(df, min_equal=1).collect()
    # One edit away counts from 20 characters on only: z and w stay.
    assert {r.doc_id: r.removed for r in rows} == {1: [3], 2: [0], 3: [1, 2]}
    assert {r.doc_id: r.text for r in rows} == {1: "x\n\n y ", 2: "z\n \nabcdefghij klmnopqrstu", 3: "w"}
    assert {r.doc_id: r.removed for r in line_dedup.dedup_lines(df).collect()} == {1: [], 2: [], 3: [1]}


def test_a_text_of_very_many_repeated_lines(spark):
    same = "the same line again and again"
    docs = spark.createDataFrame([(1, same), (2, "\n".join([same] * 60_000 + ["x"]))], "doc_id long, text string")
    begun = time.monotonic()
    rows = {r.doc_id: r for r in line_dedup.dedup_lines(docs).collect()}
    assert time.monotonic() - begun < 60  # a search through all removed lines for each line takes minutes
    assert rows[1].text == same and rows[2].text == "x" and len(rows[2].removed) == 60_000


def test_one_edit_of_brute_force():
    assert one_edit("abc", "abd") and one_edit("abc", "ab") and one_edit("abc", "aabc")
    assert not one_edit("abc", "abc") and not one_edit("abc", "acb") and not one_edit("abc", "a")


def test_line_odd_cases(spark):
    df = odd_docs(spark, clashing=True)
    rows = line_dedup.dedup_lines(df, removed="gone").collect()
    by_id = {}
    for r in rows:
        by_id.setdefault(r.doc_id, []).append(r)
    assert len(rows) == df.count() and rows[0].__fields__ == [*df.columns, "gone"]
    assert by_id[None][0].gone == [] and by_id[1][0].text is None and by_id[2][0].text == ""
    assert [r.gone for r in by_id[5]] == [[], []]
    assert by_id[6][0].gone == [0, 1] and by_id[6][0].text == ""
    assert by_id[6][0].removed == 3  # a column of the input
    kept = line_dedup.clean_documents(df)
    assert kept.columns == df.columns and 6 not in {r.doc_id for r in kept.collect()}
    assert {r.doc_id for r in kept.collect()} >= {None, 1, 2, 3, 4, 5, 7, 8}
    assert line_dedup.dedup_lines(no_docs(spark)).count() == 0


# --- near duplicates ---------------------------------------------------------------


def near_texts(seed, n=120):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randint(1, 5)))
    groups = [[word() for _ in range(rng.randint(1, 150))] for _ in range(12)]
    docs = []
    for i in range(n):
        words = list(rng.choice(groups))
        for _ in range(rng.choice([0, 0, 1, 1, 2, 3, 5])):
            words[rng.randrange(len(words))] = word()
        docs.append((i, " ".join(words).title() if rng.random() < 0.3 else "\t".join(words)))
    return [*docs, (500, None), (501, ""), (502, " \n ")]


@pytest.mark.parametrize("limit", [2000, 6])
def test_components_are_those_of_all_pairs(spark, monkeypatch, limit):
    monkeypatch.setattr(near_dedup, "LIMIT", limit)
    docs = near_texts(limit)
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    rows = near_dedup.near_duplicates(df).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in rows} == components(docs)
    assert all(r.kept == (r.doc_id == r.component_id) for r in rows)


@pytest.mark.parametrize("depth", [48, 2])
def test_bridges_to_a_large_group_are_found(spark, monkeypatch, depth):
    monkeypatch.setattr(near_dedup, "LIMIT", 8)
    monkeypatch.setattr(near_dedup, "PATIENCE", 1)
    monkeypatch.setattr(near_dedup, "DEPTH", depth)
    base = [f"w{k}" for k in range(400)]
    docs = [(i, " ".join([*base[:385], *(f"m{i}x{k}" for k in range(15))])) for i in range(150)]
    for i in range(12):  # 0.86 of one member, 0.8 of no other
        docs.append((1000 + i, " ".join([*(f"b{i}x{k}" for k in range(30)), *docs[i * 11][1].split()[30:]])))
    df = spark.createDataFrame(docs, "doc_id long, text string")
    rows = near_dedup.near_duplicates(df).collect()
    want = components(docs)
    assert {root for _, root in want.values()} == {0}
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in rows} == want


def test_near_odd_cases(spark):
    df = odd_docs(spark, clashing=True)
    rows = near_dedup.near_duplicates(df).collect()
    found = {(r.doc_id, r.n_shingles > 0, r.component_id, r.kept) for r in rows}
    assert len(rows) == df.count()
    assert {(None, True, None, True), (1, False, 1, True), (4, True, 4, True), (5, True, 5, True)} <= found
    assert (6, True, 5, False) in found
    kept = near_dedup.clean_documents(df)
    assert kept.columns == df.columns
    assert sorted(r.doc_id for r in kept.collect() if r.doc_id) == [1, 2, 3, 4, 5, 5, 7, 8]
    assert near_dedup.near_duplicates(no_docs(spark)).count() == 0


def test_texts_of_equal_ids_have_links_of_their_own(spark):
    rng = random.Random(12)
    bodies = [[f"{k}w{rng.randrange(10**6)}" for _ in range(200)] for k in range(8)]
    docs = [(7, " ".join(body)) for body in bodies]
    for k, body in enumerate(bodies):
        docs.append((20 + k, " ".join([*body[:100], "other", *body[101:]])))
    docs += [(7, docs[0][1]), (30, "a text of its own"), (None, docs[0][1]), (31, ""), (31, "")]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    rows = near_dedup.near_duplicates(df).collect()
    assert len(rows) == len(docs)
    assert all(r.component_id == 7 for r in rows if r.doc_id in {7, *range(20, 28)})
    kept = sorted((r.doc_id or 0, r.text) for r in near_dedup.clean_documents(df).collect())
    # Eight texts of id 7 stay, one of them in two equal rows; rows without words or id stay as well.
    stay = [(7, " ".join(b)) for b in bodies] + [(7, docs[0][1]), (30, "a text of its own"), (31, ""), (31, ""), (0, docs[0][1])]
    assert kept == sorted(stay)


def test_components_of_a_long_path(spark):
    links = [(k, k + 1) for k in range(40)] + [(100, 101), (101, 102), (7, 7)]
    rows = connected(spark.createDataFrame(links, "a long, b long")).collect()
    assert {r.node: r.component for r in rows} == {**{k: 0 for k in range(41)}, 100: 100, 101: 100, 102: 100}
