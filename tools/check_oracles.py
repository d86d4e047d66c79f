"""Run registered queries in Spark and their SQL twins in DuckDB and compare the rows.

Usage: python tools/check_oracles.py [sf_dir] [query ...]
"""

from __future__ import annotations

import sys
import time
from collections import Counter
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from stratafile.plans.facts import BASE_TABLES  # noqa: E402
from stratafile.plans.oracles import ORACLES  # noqa: E402
from stratafile.plans.queries import QUERIES  # noqa: E402
from stratafile.session import local_session  # noqa: E402


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for table in BASE_TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return con


def plain(value):
    return round(value, 9) if isinstance(value, float) else value


def rows_of(columns: list[str], rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(plain(row[i]) for i in order) for row in rows)


def compare(spark, con, sf_dir: str, name: str) -> str:
    df = QUERIES[name](spark, sf_dir)
    left = rows_of(df.columns, df.collect())
    result = con.execute(ORACLES[name])
    columns = [c[0] for c in result.description]
    right = rows_of(columns, result.fetchall())
    if sorted(df.columns) != sorted(columns):
        return f"columns differ: {sorted(set(df.columns) ^ set(columns))}"
    if left != right:
        only_spark, only_sql = left - right, right - left
        text = f"{sum(left.values())} vs {sum(right.values())} rows; {sum(only_spark.values())} only in Spark, {sum(only_sql.values())} only in SQL"
        return f"{text}\n  {sorted(columns)}\n  spark {sorted(only_spark, key=str)[:2]}\n  sql   {sorted(only_sql, key=str)[:2]}"
    return ""


def main() -> int:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(QUERIES)
    spark, con = local_session(), duck(sf_dir)
    bad = 0
    for name in names:
        start = time.time()
        if name not in ORACLES:
            print(f"ROWS {name} {QUERIES[name](spark, sf_dir).count()}", flush=True)
            continue
        try:
            problem = compare(spark, con, sf_dir, name)
        except Exception as error:  # report and go on with the other queries
            problem = str(error)[:700]
        bad += bool(problem)
        print(f"{'FAIL' if problem else 'OK'} {name} {time.time() - start:.1f}s {problem}", flush=True)
    print(f"{len(names) - bad} of {len(names)} agree")
    return bad


if __name__ == "__main__":
    sys.exit(main())
