"""Rows of a Spark query against rows of its SQL in DuckDB."""

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(sf_dir):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def rows(frame, columns):
    clean = frame[columns].astype(object).where(frame[columns].notna(), None)
    return sorted(repr(tuple(r)) for r in clean.values.tolist())


def check(spark, sf_dir, query, sql):
    ours = query(spark, sf_dir).toPandas()
    theirs = connect(sf_dir).execute(sql).df()
    columns = sorted(ours.columns)
    assert columns == sorted(theirs.columns)
    assert rows(ours, columns) == rows(theirs, columns)
