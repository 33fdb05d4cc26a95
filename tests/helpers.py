import math
import os

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def duck(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        p = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 9)
    if isinstance(v, (list, tuple)):
        return tuple(norm(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, norm(x)) for k, x in v.items()))
    if hasattr(v, "asDict"):
        return tuple(norm(x) for x in v)
    return v


def rows_key(rows):
    return sorted((tuple(norm(v) for v in r) for r in rows), key=repr)


def same_rows(df, con, sql):
    cols = df.columns
    srows = [tuple(r) for r in df.collect()]
    res = con.execute(sql)
    ocols = [d[0] for d in res.description]
    orows = res.fetchall()
    assert sorted(cols) == sorted(ocols), (cols, ocols)
    idx = [ocols.index(c) for c in cols]
    orows = [tuple(r[i] for i in idx) for r in orows]
    assert len(srows) == len(orows)
    assert rows_key(srows) == rows_key(orows)
    return len(srows)
