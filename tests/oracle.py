"""Compares a query with its SQL in DuckDB."""

import os

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(sf_dir):
    c = duckdb.connect()
    for t in TABLES:
        path = f"{sf_dir}/{t}.parquet"
        if os.path.exists(path):
            c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{path}'")
    return c


def rows(frame, columns):
    plain = lambda v: None if v is None or (isinstance(v, float) and v != v) else v.item() if hasattr(v, "item") else v
    return sorted(repr([plain(v) for v in r]) for r in frame[columns].astype(object).where(frame[columns].notna(), None).itertuples(index=False))


def compare(spark, sf_dir, query, sql):
    got = query(spark, sf_dir).toPandas()
    want = connect(sf_dir).execute(sql).df()
    columns = sorted(got.columns)
    assert columns == sorted(want.columns)
    assert rows(got, columns) == rows(want, columns)
