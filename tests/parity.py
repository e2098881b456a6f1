"""Compares a query's rows with those of its SQL in DuckDB."""

import duckdb
import pandas as pd

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def plain(x):
    if hasattr(x, "asDict"):
        x = x.asDict()
    if isinstance(x, dict):
        return {k: plain(v) for k, v in x.items()}
    if hasattr(x, "tolist") and getattr(x, "ndim", 0) or isinstance(x, (list, tuple)):
        return [plain(v) for v in x]
    if hasattr(x, "item"):
        x = x.item()
    if x is None or x is pd.NaT or x is pd.NA or x != x:
        return None
    if isinstance(x, bool):
        return x
    if isinstance(x, (int, float)):
        return f"{x:.9g}" if float(x) != int(x) else str(int(x))
    return str(x)


def rows(frame):
    frame = frame[sorted(frame.columns)]
    return sorted(repr([plain(x) for x in r]) for r in frame.itertuples(index=False))


def duck(folder):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{folder}/{t}.parquet')")
    return con
