"""Compares a query's rows with those of its SQL in DuckDB."""

import os

import pandas as pd

DIR = "/root/testdata/sf0.001"


def rows_of(frame):
    def plain(v):
        if hasattr(v, "__len__") and not isinstance(v, (str, bytes)):
            return str([plain(x) for x in v])
        if pd.isna(v):
            return None
        if isinstance(v, float):
            # Nullable integers come as floats from one side.
            return str(int(v)) if v.is_integer() else repr(round(v, 9))
        return str(v)

    names = sorted(frame.columns)
    return names, sorted((tuple(plain(v) for v in row) for row in frame[names].astype(object).itertuples(index=False)), key=repr)


def both(spark, query, sql):
    import duckdb

    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in os.listdir(DIR):
        con.execute(f"CREATE VIEW {name.removesuffix('.parquet')} AS SELECT * FROM '{DIR}/{name}'")
    return rows_of(query(spark, DIR).toPandas()), rows_of(con.execute(sql).df())
