"""Compare registered queries with DuckDB on the same Parquet files.

    python tests/compare.py [sf_dir] [query ...]
"""

from __future__ import annotations

import datetime as dt
import decimal
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        path = f"{sf_dir}/{name}.parquet"
        if os.path.isdir(path):
            path += "/*.parquet"
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return connection


def _plain(value):
    """One type for values that Spark and DuckDB box differently."""
    if isinstance(value, decimal.Decimal):
        return float(value)
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None).isoformat()
    return value


def sorted_rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    plain = [tuple(_plain(row[i]) for i in order) for row in rows]
    return sorted(plain, key=repr)


def spark_rows(frame):
    return sorted(frame.columns), sorted_rows(frame.columns, frame.collect())


def duckdb_rows(connection, sql):
    relation = connection.sql(sql)
    return sorted(relation.columns), sorted_rows(relation.columns, relation.fetchall())


def kinds(frame, connection, sql):
    """Columns whose types do not correspond."""
    pairs = {
        "bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE",
        "date": "DATE", "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP",
    }
    relation = connection.sql(sql)
    theirs = dict(zip(relation.columns, map(str, relation.types)))
    return {
        name: (kind, theirs.get(name)) for name, kind in frame.dtypes if pairs.get(kind, kind) != theirs.get(name)
    }


def main() -> int:
    from conftest import make_session

    import __spark_entry__ as entry

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    wanted = sys.argv[2:] or list(entry.queries())
    spark, connection = make_session(), connect(sf_dir)
    failures = 0
    for name in wanted:
        start = time.perf_counter()
        try:
            frame = entry.queries()[name](spark, sf_dir)
            ours = spark_rows(frame)
            took = time.perf_counter() - start
            sql = entry.oracle_sql().get(name)
            if sql is None:
                verdict = "rows only"
            else:
                theirs = duckdb_rows(connection, sql)
                verdict = "same" if ours == theirs else "DIFFERENT"
                if ours != theirs:
                    failures += 1
                    print(ours[0], theirs[0], len(ours[1]), len(theirs[1]))
                    print([(a, b) for a, b in zip(ours[1], theirs[1]) if a != b][:3])
                odd = kinds(frame, connection, sql)
                if odd:
                    failures += 1
                    verdict += f" types {odd}"
            print(f"{name}: {verdict}, {len(ours[1])} rows, {took:.2f} s", flush=True)
        except Exception as error:
            failures += 1
            print(f"{name}: FAILED {str(error)[:1500]}", flush=True)
    spark.stop()
    return failures


if __name__ == "__main__":
    sys.exit(main())
