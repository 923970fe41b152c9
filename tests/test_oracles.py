"""Every query against its SQL on the smallest tables."""

import glob
import math
import os

import duckdb
import pytest

from stakeflow.plans import registry
from tests.conftest import SF


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for f in glob.glob(f"{SF}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM read_parquet('{f}')")
    return con


def rows(table):
    names = sorted(table.column_names)
    clean = lambda v: None if isinstance(v, float) and math.isnan(v) else round(v, 6) if isinstance(v, float) else v
    return names, sorted(str([clean(r[c]) for c in names]) for r in table.to_pylist())


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_query(spark, duck, name):
    got = registry.QUERIES[name](spark, SF).toArrow()
    if name not in registry.ORACLES:
        assert got.num_rows > 0
        return
    assert rows(got) == rows(duck.sql(registry.ORACLES[name]).to_arrow_table())
