"""Hold a query against its SQL on DuckDB."""

import math
import os
from collections import Counter

import duckdb

SF = "/root/testdata/sf0.001"


def plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v + 0.0)
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(map(plain, v)) + "]"
    return "null" if v is None else str(v)


def differences(spark, query, sql, sf=SF):
    """Rows on one side only, as (spark's, DuckDB's)."""
    con = duckdb.connect()
    for name in os.listdir(sf):
        con.execute(f"CREATE VIEW {name.removesuffix('.parquet')} AS SELECT * FROM '{sf}/{name}'")
    df = query(spark, sf)
    names = sorted(df.columns)
    mine = Counter(tuple(plain(r[c]) for c in names) for r in df.collect())
    got = con.execute(sql)
    at = [d[0] for d in got.description]
    assert sorted(at) == names, (sorted(at), names)
    theirs = Counter(tuple(plain(r[at.index(c)]) for c in names) for r in got.fetchall())
    return list((mine - theirs).items())[:3], list((theirs - mine).items())[:3]
