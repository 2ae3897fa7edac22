"""Run registered queries beside their SQL and report differences.

``python -m fundflow_checks.compare SF_DIR [NAME ...]``
"""

from __future__ import annotations

import glob
import sys
import time
from collections import Counter
from pathlib import Path

import duckdb
from pyspark.sql import DataFrame, SparkSession

from fundflow_checks.oracle import oracle_sql
from fundflow_checks.queries import REGISTRY

# Spark type name to the SQL types it may meet.
_TYPES = {
    "int": "INTEGER",
    "bigint": "BIGINT",
    "double": "DOUBLE",
    "boolean": "BOOLEAN",
    "string": "VARCHAR",
    "date": "DATE",
    "timestamp_ntz": "TIMESTAMP",
}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        con.execute(f"CREATE VIEW {Path(path).stem} AS SELECT * FROM '{path}'")
    return con


def difference(frame: DataFrame, con: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """What differs in columns, types or rows (as multisets), or None."""
    expected = con.execute(sql)
    theirs = {c[0]: str(c[1]) for c in expected.description}
    ours = dict(frame.dtypes)
    if sorted(ours) != sorted(theirs):
        return f"columns {sorted(ours)} against {sorted(theirs)}"
    odd = {c: (ours[c], theirs[c]) for c in ours if _TYPES.get(ours[c]) != theirs[c]}
    if odd:
        return f"types {odd}"
    names = sorted(ours)
    at = [list(theirs).index(c) for c in names]
    want = Counter(tuple(row[i] for i in at) for row in expected.fetchall())
    have = Counter(tuple(row) for row in frame.select(*[f"`{c}`" for c in names]).collect())
    if want != have:
        extra, missing = have - want, want - have
        return (
            f"{sum(have.values())} against {sum(want.values())} rows;"
            f" extra {list(extra.items())[:3]}; missing {list(missing.items())[:3]}"
        )
    return None


def main(sf_dir: str, *names: str) -> int:
    from tests.conftest import local_session

    spark: SparkSession = local_session()
    con = connect(sf_dir)
    failed = 0
    for name in names or REGISTRY:
        start = time.perf_counter()
        problem = difference(REGISTRY[name](spark, sf_dir), con, oracle_sql()[name])
        failed += problem is not None
        print(f"{name:32} {time.perf_counter() - start:6.2f}s {problem or 'ok'}", flush=True)
    return failed


if __name__ == "__main__":
    sys.exit(main(*sys.argv[1:]))
