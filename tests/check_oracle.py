"""Compare registered queries with their SQL twins: ``python tests/check_oracle.py DIR [NAME...]``."""

from __future__ import annotations

import sys
import tempfile
import time
from decimal import Decimal
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.sql("SET TimeZone = 'UTC'")
    for path in sorted(Path(folder).glob("*.parquet")):
        con.sql(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return con


def plain(value):
    if isinstance(value, Decimal):
        return float(value)
    return value


def rows_of(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in rows), key=repr)


def differences(spark_rows, spark_columns, duck_rows, duck_columns):
    if sorted(spark_columns) != sorted(duck_columns):
        return f"columns differ: {sorted(spark_columns)} / {sorted(duck_columns)}"
    left, right = rows_of(spark_rows, spark_columns), rows_of(duck_rows, duck_columns)
    if left == right:
        return None
    only_left = [r for r in left if r not in set(right)][:2]
    only_right = [r for r in right if r not in set(left)][:2]
    return f"rows {len(left)} / {len(right)}; first only in spark {only_left}; only in sql {only_right}"


# the engines' names of the same types
SAME_TYPE = {"string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "boolean": "BOOLEAN",
             "double": "DOUBLE"}


def type_differences(df, relation):
    theirs = dict(zip(relation.columns, map(str, relation.types)))
    return [f"{name}: {kind} / {theirs.get(name)}" for name, kind in df.dtypes
            if SAME_TYPE.get(kind, kind) != theirs.get(name)]


def compare(spark, con, folder, name, query, sql):
    df = query(spark, folder)
    relation = con.sql(sql)
    duck_columns = list(relation.columns)
    types = type_differences(df, relation)
    if types:
        return f"types differ: {types}"
    return differences([tuple(r) for r in df.collect()], df.columns,
                       relation.fetchall(), duck_columns)


def main() -> int:
    from wardline.plans.oracle import ORACLE_SQL
    from wardline.plans.queries import QUERIES
    from wardline.session import local_session
    folder, names = sys.argv[1], sys.argv[2:]
    shared = tempfile.TemporaryDirectory(prefix="wardline-oracle-")
    spark, con, bad = local_session(8, shared=shared.name, pieces=8), connect(folder), 0
    for name, query in QUERIES.items():
        if names and name not in names:
            continue
        if name not in ORACLE_SQL:
            print("NO SQL", name)
            continue
        started = time.time()
        try:
            problem = compare(spark, con, folder, name, query, ORACLE_SQL[name])
        except Exception as error:  # report and go on with the others
            problem = f"{type(error).__name__}: {str(error)[:500]}"
        bad += problem is not None
        print("ok  " if problem is None else "DIFF", f"{time.time() - started:6.2f}", name,
              (problem or "")[:900], flush=True)
    print("different:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(main())
