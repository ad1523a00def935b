"""Runs a query and its SQL side by side."""

import os

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def oracle(sf):
    con = duckdb.connect()
    for t in TABLES:
        path = f"{sf}/{t}.parquet"
        con.execute(f"create view {t} as select * from '{path + '/*.parquet' if os.path.isdir(path) else path}'")
    return con


def _value(x):
    """Lists of either engine as plain Python lists: NumPy's scalars print with their type."""
    return str([getattr(v, "item", lambda v=v: v)() for v in x]) if hasattr(x, "__iter__") and not isinstance(x, (str, dict, bytes)) else str(x).removesuffix(" 00:00:00")


def plain(frame):
    frame = frame[sorted(frame.columns)].copy()
    for c in frame.columns:
        if str(frame[c].dtype).startswith("float"):
            frame[c] = frame[c].round(6)
        frame[c] = [_value(x) for x in frame[c]]
    return sorted(map(tuple, frame.itertuples(index=False)))


def assert_same(spark, sf, query, sql):
    ours, theirs = query(spark, sf).toPandas(), oracle(sf).sql(sql).df()
    assert sorted(ours.columns) == sorted(theirs.columns)
    assert plain(ours) == plain(theirs)
