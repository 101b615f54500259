"""Comparison of a query's rows with those of its SQL in DuckDB."""

import os

import duckdb
import pandas as pd

DATA = "/root/testdata"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def database(sf: str) -> duckdb.DuckDBPyConnection:
    c = duckdb.connect()
    for t in TABLES:
        path = f"{DATA}/{sf}/{t}.parquet"
        c.sql(f"create view {t} as select * from '{path}{'/*.parquet' if os.path.isdir(path) else ''}'")
    return c


def _plain(x):
    if x is None or x is pd.NaT or x is pd.NA or (isinstance(x, float) and x != x):
        return None
    if isinstance(x, bool):
        return x
    if isinstance(x, float) or type(x).__name__ == "Decimal":
        x = round(float(x), 6)
        return int(x) if x.is_integer() else x  # a column with nulls comes as floats from one side only
    return x if isinstance(x, int) else str(x)


def rows(df: pd.DataFrame) -> list[str]:
    df = df[sorted(df.columns)]
    return sorted(repr(tuple(_plain(x.item() if hasattr(x, "item") else x) for x in r)) for r in df.itertuples(index=False, name=None))


def same(got: pd.DataFrame, want: pd.DataFrame) -> None:
    assert sorted(got.columns) == sorted(want.columns)
    a, b = rows(got), rows(want)
    assert len(a) == len(b)
    assert a == b, f"only got {[x for x in a if x not in set(b)][:3]}, only wanted {[x for x in b if x not in set(a)][:3]}"
