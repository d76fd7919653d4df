"""Rows of a Spark query against rows of its SQL in DuckDB, without regard to order."""

import os

import duckdb


def _plain(x):
    if x is None or (isinstance(x, float) and x != x):
        return "NULL"
    if isinstance(x, bool):
        return str(x)
    if isinstance(x, (int, float)) or hasattr(x, "as_tuple"):
        return f"{float(x):.9g}"
    return str(x)


def duck(sf: str) -> duckdb.DuckDBPyConnection:
    c = duckdb.connect()
    for p in sorted(os.listdir(sf)):
        at = f"{sf}/{p}"
        at = at if os.path.isfile(at) else f"{at}/*.parquet"
        c.execute(f"CREATE VIEW {p.split('.')[0]} AS SELECT * FROM read_parquet('{at}')")
    return c


def rows_of_spark(df) -> list:
    cols = sorted(df.columns)
    return sorted(tuple(_plain(r[c]) for c in cols) for r in df.collect())


def rows_of_sql(connection, sql: str) -> tuple[list[str], list]:
    cur = connection.execute(sql)
    names = [d[0] for d in cur.description]
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(names), sorted(tuple(_plain(r[i]) for i in order) for r in cur.fetchall())
