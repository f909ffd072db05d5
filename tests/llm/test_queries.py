"""The registered queries of the subpackage on the smallest tables."""

from pathlib import Path

import pytest
from brute import personal, repeats, secrets, sha
from compare import check

import __spark_entry__ as entry
from eventide.llm import queries

TABLES = "/root/testdata/sf0.001"
needs_tables = pytest.mark.skipif(not Path(TABLES).exists(), reason="no tables here")


@pytest.fixture(scope="module")
def docs(spark):
    rows = spark.read.parquet(f"{TABLES}/documents.parquet").select("doc_id", "text").collect()
    return {r.doc_id: r.text for r in rows}


def test_one_query_for_each_operator():
    names = sorted(queries.queries(), key=lambda n: int(n[2:].split("_")[0]))
    assert [n.split("_")[0] for n in names] == [f"op{k}" for k in range(1, 14)]
    assert {"pipeline", *names} <= entry.queries().keys()


@needs_tables
@pytest.mark.parametrize("name", list(queries.oracle_sql()))
def test_query_equals_its_sql(spark, name):
    problem, rows = check(spark, TABLES, name)
    assert problem is None and rows > 0


def spans_text(spans):
    return ",".join(f"{kind}:{a}:{b}" for a, b, kind in spans)


@needs_tables
def test_digests_of_the_contracts(spark, docs):
    rows = entry.queries()["op1_suffix_dedup"](spark, TABLES).collect()
    want = repeats(docs.items(), 100)
    assert {r.doc_id: (r.n_removed, r.n_spans, r.kept_sha256) for r in rows} == {
        i: (n, runs, sha(kept)) for i, (n, runs, kept) in want.items()
    }
    for name, found in (("op6_secrets", secrets), ("op10_personal_data", personal)):
        rows = entry.queries()[name](spark, TABLES).collect()
        assert {r.doc_id: r.base_sha256 for r in rows} == {i: sha(spans_text(found(t))) for i, t in docs.items()}


@needs_tables
@pytest.mark.parametrize("name, fold, of", [("op3_toxicity", 1, 3), ("op5_language", 2, 4)])
def test_held_out_rows(spark, docs, name, fold, of):
    import zlib

    rows = entry.queries()[name](spark, TABLES).collect()
    assert {r.doc_id: r.held_out for r in rows} == {i: zlib.crc32(str(i).encode()) % of == fold for i in docs}
    assert all(0 <= r.score <= 1 for r in rows)


@needs_tables
@pytest.mark.parametrize("name", ["op6_secrets", "op8_line_dedup"])
def test_native_queries_run_no_python(spark, name):
    plan = entry.queries()[name](spark, TABLES)._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("Python", "Pandas", "Arrow", "Cartesian"))
