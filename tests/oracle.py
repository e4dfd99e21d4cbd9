"""Rows of a query and of its SQL, made comparable."""

import glob
import os

import duckdb


def connect(sf_dir):
    con = duckdb.connect()
    con.sql("SET TimeZone = 'UTC'")
    for f in glob.glob(f"{sf_dir}/*.parquet"):
        con.sql(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM '{f}'")
    return con


def cell(x):
    if isinstance(x, float):
        return round(x, 9)
    return str(x.replace(tzinfo=None)) if hasattr(x, "tzinfo") else x


def same(df, con, sql):
    names = sorted(df.columns)
    rel = con.sql(sql)
    assert sorted(rel.columns) == names, (sorted(rel.columns), names)
    ours = sorted((tuple(cell(r[n]) for n in names) for r in df.collect()), key=repr)
    at = [rel.columns.index(n) for n in names]
    theirs = sorted((tuple(cell(r[i]) for i in at) for r in rel.fetchall()), key=repr)
    assert len(ours) == len(theirs), (len(ours), len(theirs))
    bad = [(a, b) for a, b in zip(ours, theirs) if a != b]
    assert not bad, (len(bad), bad[:2])
