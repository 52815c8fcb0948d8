"""Compare every named query with its SQL: names, types and rows.

    python tests/oracle_check.py /root/testdata/sf0.01 [name ...]
"""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()

_SAME_TYPE = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "boolean": "BOOLEAN",
    "date": "DATE",
    "timestamp_ntz": "TIMESTAMP",
}


def connect(path: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    connection.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        file = os.path.join(path, f"{name}.parquet")
        if os.path.exists(file):
            connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{file}'")
    return connection


def _key(row):
    return tuple((value is None, str(type(value)), value if value is not None else 0) for value in row)


def _norm(rows):
    out = []
    for row in rows:
        out.append(tuple(-0.0 + v + 0.0 if isinstance(v, float) and not math.isnan(v) else v for v in row))
    return sorted(out, key=_key)


def compare(spark_df, connection, sql: str) -> list[str]:
    """Differences between a Spark result and a SQL result; empty when they are the same."""
    cursor = connection.execute(sql)
    sql_names = [column[0] for column in cursor.description]
    sql_types = {column[0]: str(column[1]) for column in cursor.description}
    sql_rows = cursor.fetchall()
    problems = []
    if sorted(sql_names) != sorted(spark_df.columns):
        return [f"columns differ: spark {sorted(spark_df.columns)} sql {sorted(sql_names)}"]
    for name, kind in spark_df.dtypes:
        if _SAME_TYPE.get(kind) != sql_types[name]:
            problems.append(f"type of {name}: spark {kind} sql {sql_types[name]}")
    names = sorted(sql_names)
    left = _norm([tuple(row[n] for n in names) for row in spark_df.collect()])
    order = [sql_names.index(n) for n in names]
    right = _norm([tuple(row[i] for i in order) for row in sql_rows])
    if len(left) != len(right):
        problems.append(f"rows: spark {len(left)} sql {len(right)}")
    wrong = [(a, b) for a, b in zip(left, right) if a != b]
    if wrong:
        problems.append(f"{len(wrong)} rows differ, first: spark {wrong[0][0]} sql {wrong[0][1]}")
    return problems


def main() -> int:
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    from __spark_entry__ import oracle_sql, queries
    from odsflow.session import local_session

    path, names = sys.argv[1], sys.argv[2:]
    spark = local_session()
    connection = connect(path)
    sqls, failed = oracle_sql(), 0
    for name, run in queries().items():
        if names and name not in names:
            continue
        start = time.time()
        try:
            df = run(spark, path)
            problems = compare(df, connection, sqls[name]) if name in sqls else [] if df.count() else ["no rows"]
        except Exception as error:  # report and go on with the next query
            problems = [f"{type(error).__name__}: {str(error)[:1500]}"]
        failed += bool(problems)
        print(f"{'FAIL' if problems else 'ok  '} {name} {time.time() - start:.2f}s {' | '.join(problems)}", flush=True)
    print(f"{failed} failed")
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main())
