"""Comparison of a query with its DuckDB SQL."""

import os

import duckdb
import pandas as pd

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(sf):
    c = duckdb.connect()
    for t in TABLES:
        p = f"{sf}/{t}.parquet"
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}{'/*.parquet' if os.path.isdir(p) else ''}')")
    return c


def same(got, want):
    assert sorted(got.columns) == sorted(want.columns)
    columns = sorted(got.columns)
    assert len(got) == len(want)

    def plain(df):
        rows = [tuple(None if (not isinstance(v, (list, dict)) and pd.isna(v)) else v for v in r) for r in df[columns].itertuples(index=False)]
        return sorted(rows, key=lambda r: tuple((v is not None, str(type(v).__name__), v) if not isinstance(v, (int, float)) else (True, "n", v) for v in r))

    assert plain(got) == plain(want)
