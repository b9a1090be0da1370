"""Order-free comparison of a Spark result with a DuckDB result."""

from __future__ import annotations

from decimal import Decimal

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def open_duckdb(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return con


def _plain(value):
    if isinstance(value, bool) or value is None:
        return repr(value)
    if isinstance(value, (int, float, Decimal)):
        return f"{float(value):.9g}"
    if isinstance(value, (list, tuple)):
        return "[" + ",".join(_plain(v) for v in value) + "]"
    if isinstance(value, (bytes, bytearray)):
        return bytes(value).hex()
    return str(value)


def _table(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(_plain(r[i]) for i in order) for r in rows)


def differences(spark_df, con, sql: str) -> str | None:
    """None when equal, else a short description."""
    cur = con.execute(sql)
    want = _table([c[0] for c in cur.description], cur.fetchall())
    got = _table(spark_df.columns, [tuple(r) for r in spark_df.collect()])
    if got[0] != want[0]:
        return f"columns {got[0]} != {want[0]}"
    if not want[1]:
        return "the oracle result is empty"
    if got[1] != want[1]:
        extra = [r for r in got[1] if r not in set(want[1])][:2]
        lost = [r for r in want[1] if r not in set(got[1])][:2]
        return f"{len(got[1])} rows != {len(want[1])} rows; only Spark {extra}; only oracle {lost}"
    return None
