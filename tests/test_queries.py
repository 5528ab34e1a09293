"""Every registered query with SQL against DuckDB, on the smallest tables."""

import glob
import math
import os

import pytest

DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="needs the driver's tables")

from strandline.plans import registry  # noqa: E402


@pytest.fixture(scope="module")
def duck():
    duckdb = pytest.importorskip("duckdb")
    held = duckdb.connect()
    for f in glob.glob(f"{DATA}/*.parquet"):
        held.execute(f"create view {os.path.basename(f)[:-8]} as select * from '{f}'")
    return held


def rows(names, values):
    order = sorted(range(len(names)), key=names.__getitem__)

    def plain(v):
        if v is None or isinstance(v, float) and math.isnan(v):
            return None
        return round(float(v), 5) if not isinstance(v, (str, bool)) else v

    return sorted((tuple(plain(r[i]) for i in order) for r in values), key=str)


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_query(spark, duck, name):
    got = registry.queries()[name](spark, DATA)
    want = duck.execute(registry.oracle_sql()[name])
    names = [c[0] for c in want.description]
    assert sorted(got.columns) == sorted(names)
    assert rows(got.columns, got.collect()) == rows(names, want.fetchall())
