"""Every query runs; those with SQL give the same rows as it."""

import glob
import math
import os
from collections import Counter

import duckdb
import pytest

from plumbline.plans import registry


@pytest.fixture(scope="module")
def duck(sf):
    c = duckdb.connect()
    for f in glob.glob(f"{sf}/*.parquet"):
        c.execute(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM '{f}'")
    return c


def plain(v):
    return (None if math.isnan(v) else round(v, 6) + 0.0) if isinstance(v, float) else v


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_query(spark, sf, duck, name):
    df = registry.QUERIES[name](spark, sf)
    columns = sorted(df.columns)
    got = Counter(tuple(map(plain, r)) for r in df.select(*[f"`{c}`" for c in columns]).collect())
    if name in registry.ORACLE_SQL:
        found = duck.execute(registry.ORACLE_SQL[name])
        names = [d[0] for d in found.description]
        assert sorted(names) == columns
        at = [names.index(c) for c in columns]
        assert got == Counter(tuple(plain(r[i]) for i in at) for r in found.fetchall())
    else:
        assert got
