"""Compare a query with its SQL on the same folder."""

import glob
import math
import os

import duckdb

DATA = "/root/testdata/sf0.001"


def plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(round(v, 6) + 0.0)
    if isinstance(v, (list, tuple)):
        return [plain(x) for x in v]
    return "~" if v is None else str(v)


def connect(folder=DATA):
    con = duckdb.connect()
    con.execute("SET timezone = 'UTC'")
    for f in glob.glob(f"{folder}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM '{f}'")
    return con


def compare(spark, query, sql, con, folder=DATA):
    df = query(spark, folder)
    columns = sorted(df.columns)
    rows = sorted([plain(r[c]) for c in columns] for r in df.collect())
    done = con.execute(sql)
    names = [d[0] for d in done.description]
    assert sorted(names) == columns
    expected = sorted([plain(r[names.index(c)]) for c in columns] for r in done.fetchall())
    assert rows == expected
