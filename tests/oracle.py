"""Compare a query with its SQL in DuckDB on the same tables."""

import duckdb
import pandas as pd

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def normal(df: pd.DataFrame) -> list[tuple]:
    def one(v):
        if v is None or v is pd.NA or v is pd.NaT or (isinstance(v, float) and v != v):
            return ""
        if isinstance(v, bool):
            return str(v)
        try:
            return f"{float(v):.8g}" if not isinstance(v, str) else v
        except (TypeError, ValueError):
            return str(v)

    cols = sorted(df.columns)
    return sorted(tuple(one(v) for v in row) for row in df[cols].astype(object).itertuples(index=False))
