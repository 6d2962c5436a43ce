"""Compare a Spark result with its oracle SQL run by DuckDB on the same tables:
row count, column names, and an order-insensitive hash of the values (columns
sorted by name, floats at 6 digits)."""

from __future__ import annotations

import hashlib
import math

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def duckdb_views(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir.rstrip('/')}/{t}.parquet')")
    return con


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(round(v, 6))
    if hasattr(v, "item"):
        return _norm(v.item())
    return repr(v)


def digest(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    lines = sorted("|".join(_norm(r[i]) for i in order) for r in rows)
    return hashlib.sha1("\n".join(lines).encode()).hexdigest(), lines


def compare(df, con, sql: str) -> dict:
    rows = [tuple(r) for r in df.collect()]
    rel = con.execute(sql)
    ocols = [d[0] for d in rel.description]
    orows = rel.fetchall()
    h1, l1 = digest(df.columns, rows)
    h2, l2 = digest(ocols, orows)
    return {"ok": sorted(df.columns) == sorted(ocols) and len(rows) == len(orows) and h1 == h2,
            "rows": (len(rows), len(orows)), "cols": (df.columns, ocols),
            "spark_only": sorted(set(l1) - set(l2))[:3], "oracle_only": sorted(set(l2) - set(l1))[:3]}
