"""Compare a query's rows with DuckDB's for its SQL."""

import glob
import os

import duckdb
import pandas as pd

SF = "/root/testdata/sf0.001"


def database(sf_dir=SF):
    db = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        files = f"{path}/*.parquet" if os.path.isdir(path) else path
        db.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{files}'")
    return db


def rows(df: pd.DataFrame):
    def plain(x):
        if x is None or x is pd.NA or (isinstance(x, float) and x != x):
            return ""
        return str(round(float(x), 6)) if isinstance(x, (int, float)) or hasattr(x, "dtype") and x.dtype.kind in "iuf" else str(x)

    return sorted(tuple(plain(x) for x in r) for r in df[sorted(df.columns)].astype(object).itertuples(index=False))
