"""Run every registered query next to its SQL and report differences.

    python tests/check_oracles.py [sf_dir] [query ...]
"""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def duck(sf_dir: str):
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return connection


def plain(value):
    if isinstance(value, float) and math.isnan(value):
        return "nan"
    return repr(value)


def rows_of(columns, rows) -> list:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(plain(r[i]) for i in order) for r in rows)


def compare(spark, connection, name: str, query, sql: str | None, sf_dir: str) -> str:
    df = query(spark, sf_dir)
    plan = df._jdf.queryExecution().executedPlan().toString()
    if "CartesianProduct" in plan or "NestedLoop" in plan:
        return "DIFF the plan pairs rows without a key"
    table = df.toArrow()
    found = rows_of(df.columns, list(zip(*[table.column(i).to_pylist() for i in range(table.num_columns)])))
    if sql is None:
        return f"rows {len(found)}"
    other = connection.execute(sql).to_arrow_table()
    wanted = rows_of(other.column_names, list(zip(*[other.column(i).to_pylist() for i in range(other.num_columns)])))
    if sorted(df.columns) != sorted(other.column_names):
        return f"DIFF columns {sorted(df.columns)} / {sorted(other.column_names)}"
    kinds = [(c, str(table.schema.field(c).type), str(other.schema.field(c).type)) for c in sorted(df.columns)]
    odd = [k for k in kinds if k[1] != k[2]]
    if found != wanted:
        only_spark = [r for r in found if r not in set(wanted)][:3]
        only_sql = [r for r in wanted if r not in set(found)][:3]
        return f"DIFF rows {len(found)} / {len(wanted)}: {only_spark} / {only_sql}"
    return f"ok {len(found)}" + (f" types {odd}" if odd else "")


def main(argv: list[str]) -> int:
    from __spark_entry__ import oracle_sql, queries

    from indicata.session import local_session

    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    wanted = argv[1:]
    spark = local_session(8, **{"spark.sql.execution.arrow.pyspark.enabled": "true"})
    connection, failed = duck(sf_dir), 0
    sqls = oracle_sql()
    for name, query in queries().items():
        if wanted and name not in wanted:
            continue
        started = time.time()
        try:
            outcome = compare(spark, connection, name, query, sqls.get(name), sf_dir)
        except Exception as problem:  # report and go on to the next query
            outcome = f"ERROR {type(problem).__name__} {str(problem)[:400]}"
        failed += not outcome.startswith(("ok", "rows"))
        print(f"{name:24s} {time.time() - started:6.2f}s {outcome}", flush=True)
    return failed


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
