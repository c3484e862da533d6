"""Rows of a Spark query against rows of its DuckDB form."""

import os

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(sf_dir):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        path = f"{sf_dir}/{t}.parquet"
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{path + '/*.parquet' if os.path.isdir(path) else path}'")
    return con


def plain(value):
    if value is None:
        return ""
    return repr(value) if isinstance(value, float) else str(value)


def spark_rows(df):
    cols = sorted(df.columns)
    return cols, sorted(tuple(plain(r[c]) for c in cols) for r in df.collect())


def duck_rows(con, sql):
    got = con.execute(sql)
    names = [d[0] for d in got.description]
    at = [names.index(c) for c in sorted(names)]
    return sorted(names), sorted(tuple(plain(r[i]) for i in at) for r in got.fetchall())
