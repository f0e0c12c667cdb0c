import math
from collections import Counter

import duckdb

from hourgrid.llm.queries import QUERIES, SQL


def _value(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 4)
    return v


def compare(spark, sf, name):
    """The query's rows equal those of its SQL, whatever their order."""
    con = duckdb.connect()
    for t in ("documents", "pages", "labels", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    got = QUERIES[name](spark, sf)
    cols = sorted(got.columns)
    rel = con.sql(SQL[name])
    assert sorted(rel.columns) == cols
    want = Counter(tuple(map(_value, r)) for r in rel.project(", ".join(cols)).fetchall())
    assert Counter(tuple(map(_value, r)) for r in got.select(*cols).collect()) == want
