"""Registered queries against their SQL on the smallest tables.

Streaming queries take longer; ``python tests/compare.py`` checks all of them.
"""

import os
import subprocess
import sys
from pathlib import Path

import pytest
from compare import check

import __spark_entry__ as entry

ROOT = Path(__file__).resolve().parents[1]
TABLES = "/root/testdata/sf0.001"
OWN = [n for n in entry.queries() if n != "pipeline" and not n.startswith("op")]
ON_TABLES = [name for name in OWN if not name.endswith("_stream")]

needs_tables = pytest.mark.skipif(not Path(TABLES).exists(), reason="no tables here")


def test_every_query_has_sql():
    assert set(OWN) <= entry.oracle_sql().keys() <= entry.queries().keys()


@needs_tables
@pytest.mark.parametrize("name", ON_TABLES)
def test_query_equals_its_sql(spark, name):
    problem, rows = check(spark, TABLES, name)
    assert problem is None
    assert rows > 0


@needs_tables
@pytest.mark.parametrize("name", ["order_timeout_warning_stream", "hot_urls_stream", "ad_blacklist_stream"])
def test_streaming_query_equals_its_sql(spark, name):
    assert check(spark, TABLES, name)[0] is None


def test_functions_reach_workers_from_any_folder(tmp_path):
    """Another working folder, and no package on the workers' path."""
    code = f"""
import sys
sys.path.insert(0, {str(ROOT)!r})
from pyspark.sql import SparkSession
from eventide.session import configure, ship_package
from eventide.streaming.distinct import running_distinct_stream
import eventide.operators.orders
sys.path.pop(0)
spark = SparkSession.builder.master("local[1]").config("spark.ui.enabled", "false").getOrCreate()
ship_package(configure(spark))
from eventide.functions import times
def days(batches):
    for b in batches:
        yield b.assign(n=times.millis(b.n.iloc[0] * times.timedelta(days=1)))
print("answer", spark.createDataFrame([(2,)], "n long").mapInPandas(days, "n long").first().n)
"""
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    ran = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True)
    assert "answer 172800000" in ran.stdout, ran.stderr[-2000:]


@needs_tables
def test_filters_and_columns_reach_the_scan(spark):
    df = entry.queries()["unique_visitors"](spark, TABLES)
    plan = df._jdf.queryExecution().explainString(
        spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )
    assert "EqualTo(event_type,view)" in plan
    assert "ReadSchema: struct<ts:timestamp_ntz,user_id:bigint,event_type:string>" in plan


@needs_tables
@pytest.mark.parametrize("name", ON_TABLES)
def test_no_plan_pairs_all_rows_or_uses_python(spark, name):
    plan = entry.queries()[name](spark, TABLES)._jdf.queryExecution().executedPlan().toString()
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "Pandas", "SinglePartition"):
        assert operator not in plan


@needs_tables
def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == ["window_end", "rank", "item_id", "count"]
    assert df.count() > 0
