"""Compare registered queries with their SQL: ``python tests/oracle_check.py SF_DIR [query ...]``."""

from __future__ import annotations

import math
import sys
import tempfile
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value + 0.0)
    return repr(value)


def _rows(names: list[str], rows) -> list[tuple]:
    order = sorted(range(len(names)), key=names.__getitem__)
    return sorted(tuple(_plain(row[i]) for i in order) for row in rows)


def compare(df, con: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """None when rows, column names and values agree, else what differs."""
    got = df.collect()
    rel = con.sql(sql)
    if sorted(df.columns) != sorted(rel.columns):
        return f"columns {sorted(df.columns)} != {sorted(rel.columns)}"
    want = rel.fetchall()
    left, right = _rows(df.columns, got), _rows(rel.columns, want)
    if len(left) != len(right):
        return f"{len(left)} rows != {len(right)}"
    wrong = [(a, b) for a, b in zip(left, right) if a != b]
    return f"{len(wrong)} rows differ, first {wrong[0]}" if wrong else None


if __name__ == "__main__":
    from pyspark.sql import SparkSession

    import __spark_entry__ as entry

    spark = (
        SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false").config("spark.driver.memory", "8g")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="kerbside-check-")).getOrCreate()
    )
    spark.sparkContext.setLogLevel("OFF")
    sf_dir, names = sys.argv[1], sys.argv[2:]
    con, queries, sql = connect(sf_dir), entry.queries(), entry.oracle_sql()
    for name in names or queries:
        start = time.time()
        verdict = compare(queries[name](spark, sf_dir), con, sql[name])
        print(f"{name}: {verdict or 'ok'} ({time.time() - start:.2f}s)", flush=True)
