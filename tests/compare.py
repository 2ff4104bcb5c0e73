"""Runs a named query on Spark and its SQL on DuckDB and compares all rows exactly.

    python tests/compare.py [sf-dir] [name ...]
"""

from __future__ import annotations

import glob
import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

FAMILY = {"BIGINT": "int", "INTEGER": "int", "bigint": "int", "DOUBLE": "float", "double": "float",
          "VARCHAR": "text", "string": "text", "BOOLEAN": "bool", "boolean": "bool"}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM read_parquet('{path}')")
    return con


def _key(row: tuple) -> tuple:
    return tuple((v is None, str(type(v)), v if v is not None else 0) for v in row)


def difference(con, sql: str, df) -> str | None:
    """None if names, types and rows agree, else a short description."""
    relation = con.sql(sql)
    names = sorted(relation.columns)
    if names != sorted(df.columns):
        return f"columns {names} != {sorted(df.columns)}"
    left_types = {n: FAMILY.get(str(t), str(t)) for n, t in zip(relation.columns, relation.types)}
    right_types = {n: FAMILY.get(t, t) for n, t in df.dtypes}
    if left_types != right_types:
        return f"types {[(n, left_types[n], right_types[n]) for n in names if left_types[n] != right_types[n]]}"
    order = [relation.columns.index(n) for n in names]
    expected = sorted((tuple(r[i] for i in order) for r in relation.fetchall()), key=_key)
    actual = sorted((tuple(r) for r in df.select(*[f"`{n}`" for n in names]).collect()), key=_key)
    if len(expected) != len(actual):
        return f"rows {len(expected)} != {len(actual)}"
    for a, b in zip(expected, actual):
        if a != b and not all(x == y or (isinstance(x, float) and isinstance(y, float) and math.isnan(x)
                                         and math.isnan(y)) for x, y in zip(a, b)):
            return f"first difference {[(n, x, y) for n, x, y in zip(names, a, b) if x != y]}"
    return None


def main() -> None:
    from cardwatch.plans import ORACLES, QUERIES
    from cardwatch.session import build_session
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(QUERIES)
    spark = build_session(master="local[8]", shuffle_partitions=8, **{"spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    bad = 0
    for name in names:
        start = time.time()
        try:
            df = QUERIES[name](spark, sf_dir)
            if name in ORACLES:
                problem = difference(con, ORACLES[name], df)
            else:
                problem = f"rows only: {df.count()}"
        except Exception as error:  # report and go on with the next query
            problem = f"{type(error).__name__}: {str(error)[:700]}"
        bad += problem is not None and not problem.startswith("rows only")
        print(f"{name:32s} {time.time() - start:6.2f}s {problem or 'ok'}", flush=True)
    print(f"{len(names)} queries, {bad} differ")


if __name__ == "__main__":
    main()
