"""Runs registered queries and their SQL over the same tables and compares all rows.

``python tests/compare.py [sf_dir] [query ...]``
"""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb
import pandas as pd

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = ("events", "nation", "documents", "embeddings", "benchmark", "labels")


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        con.sql(f"CREATE VIEW {table} AS FROM '{sf_dir}/{table}.parquet'")
    return con


def difference(ours: pd.DataFrame, theirs: pd.DataFrame) -> str | None:
    """What differs between two results as bags of rows, or nothing."""
    if sorted(ours.columns) != sorted(theirs.columns):
        return f"columns {sorted(ours.columns)} against {sorted(theirs.columns)}"
    if len(ours) != len(theirs):
        return f"{len(ours)} rows against {len(theirs)}"
    columns = sorted(ours.columns)
    for column in columns:
        if (ours[column].dtype.kind == "O") != (theirs[column].dtype.kind == "O") or (
            ours[column].dtype.kind != "O" and ours[column].dtype != theirs[column].dtype
        ):
            return f"type of {column}: {ours[column].dtype} against {theirs[column].dtype}"
    hashes = [
        pd.util.hash_pandas_object(df[columns], index=False).sort_values(ignore_index=True)
        for df in (ours, theirs)
    ]
    return None if hashes[0].equals(hashes[1]) else "values differ"


def check(spark, sf_dir: str, name: str, con=None) -> tuple[str | None, int]:
    import __spark_entry__ as entry

    ours = entry.queries()[name](spark, sf_dir).toPandas()
    theirs = (con or connect(sf_dir)).sql(entry.oracle_sql()[name]).df()
    return difference(ours, theirs), len(ours)


def main() -> None:
    from pyspark.sql import SparkSession

    import __spark_entry__ as entry

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(entry.queries())
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    for name in [n for n in names if n in entry.oracle_sql()]:
        begun = time.time()
        problem, rows = check(spark, sf_dir, name, con)
        print(f"{problem or 'same':12} {name:32} {rows:9} rows {time.time() - begun:6.1f} s", flush=True)


if __name__ == "__main__":
    main()
