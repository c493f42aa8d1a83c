"""Comparison of queries with DuckDB."""

from pathlib import Path


def duck(sf_dir):
    import duckdb

    c = duckdb.connect()
    for f in Path(sf_dir).glob("*.parquet"):
        c.sql(f"CREATE VIEW {f.stem} AS SELECT * FROM '{f}'")
    return c


def rows_of(frame):
    columns = sorted(frame.columns)
    return sorted((tuple(r[c] for c in columns) for r in frame.collect()), key=repr)


def same_as_sql(spark, sf_dir, query, sql):
    frame = query(spark, sf_dir)
    columns = sorted(frame.columns)
    c = duck(sf_dir)
    assert sorted(c.sql(sql).columns) == columns
    want = sorted(c.execute(f"SELECT {', '.join(columns)} FROM ({sql})").fetchall(), key=repr)
    assert rows_of(frame) == want
