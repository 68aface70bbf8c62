"""Order-free comparison of a Spark result with DuckDB's."""

import datetime
import decimal

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def plain(v):
    if isinstance(v, (list, tuple)):
        return tuple(plain(x) for x in v)
    if isinstance(v, bool) or v is None:
        return v
    if isinstance(v, (float, decimal.Decimal)):
        return None if v != v else round(float(v), 6)
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None)
    return v


def database(sf_dir):
    con = duckdb.connect()
    con.execute("SET timezone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def both(df, con, sql):
    names = sorted(df.columns)
    ours = [tuple(plain(r[c]) for c in names) for r in df.collect()]
    found = con.execute(sql)
    have = [d[0] for d in found.description]
    assert sorted(have) == names
    theirs = [tuple(plain(r[have.index(c)]) for c in names) for r in found.fetchall()]
    return sorted(ours, key=repr), sorted(theirs, key=repr)
