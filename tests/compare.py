"""Run registered queries against their SQL and report differences.

python -m tests.compare [sf] [key prefix ...]
"""

from __future__ import annotations

import sys
import tempfile
import time

import duckdb
from pyspark.sql import SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()
KINDS = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "boolean": "BOOLEAN",
    "date": "DATE",
    "timestamp_ntz": "TIMESTAMP",
}


def session() -> SparkSession:
    return (
        SparkSession.builder.master("local[8]")
        .appName("fleetwatt")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="compare-"))
        .getOrCreate()
    )


def database(sf_dir: str):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def difference(df, con, sql: str) -> str | None:
    """None when both give the same columns, types and rows."""
    names = sorted(df.columns)
    relation = con.sql(sql)
    if sorted(relation.columns) != names:
        return f"columns {sorted(set(relation.columns) ^ set(names))}"
    theirs = dict(zip(relation.columns, map(str, relation.types)))
    ours = {f.name: KINDS.get(f.dataType.simpleString(), f.dataType.simpleString()) for f in df.schema}
    if ours != theirs:
        return f"types { {n: (ours[n], theirs[n]) for n in names if ours[n] != theirs[n]} }"
    quoted = ", ".join(f'"{n}"' for n in names)
    left = sorted(map(repr, (tuple(r) for r in df.select(*names).collect())))
    right = sorted(map(repr, con.sql(f"SELECT {quoted} FROM ({sql})").fetchall()))
    if len(left) != len(right):
        return f"rows {len(left)} against {len(right)}"
    if left != right:
        a, b = next((a, b) for a, b in zip(left, right) if a != b)
        off = sum(a != b for a, b in zip(left, right))
        return f"{off} of {len(left)} rows differ, first\n   {a}\n   {b}"
    return None


def main() -> int:
    from __spark_entry__ import oracle_sql, queries

    sf = sys.argv[1] if len(sys.argv) > 1 else "0.01"
    prefixes = tuple(sys.argv[2:])
    sf_dir = f"/root/testdata/sf{sf}"
    spark, con = session(), database(sf_dir)
    spark.sparkContext.setLogLevel("ERROR")
    oracle, failed = oracle_sql(), 0
    for key, run in queries().items():
        if prefixes and not key.startswith(prefixes):
            continue
        started = time.time()
        try:
            df = run(spark, sf_dir)
            problem = difference(df, con, oracle[key]) if key in oracle else None
            note = "ok" if key in oracle else f"rows only: {df.count()}"
        except Exception as error:  # report and go on with the next query
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        failed += problem is not None
        print(f"{key:32s} {time.time() - started:6.2f}s {problem or note}", flush=True)
    print("failed:", failed)
    return failed


if __name__ == "__main__":
    sys.exit(main() > 0)
