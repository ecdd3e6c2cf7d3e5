"""Every registered query of the engine against its SQL."""

import os

import duckdb
import pytest

from chronogeo.plans.oracle_sql import ORACLES
from chronogeo.plans.queries import QUERIES


@pytest.fixture(scope="module")
def duck(sf):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for f in os.listdir(sf):
        con.execute(f"CREATE VIEW {f[:-8]} AS SELECT * FROM '{sf}/{f}'")
    return con


def canon(rows, cols):
    order = sorted(range(len(cols)), key=cols.__getitem__)
    return sorted(tuple(repr(round(r[i], 9)) if isinstance(r[i], float) else repr(r[i]) for i in order) for r in rows)


def test_every_query_has_its_sql():
    assert set(ORACLES) == set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query(spark, sf, duck, name):
    df = QUERIES[name](spark, sf)
    rel = duck.execute(ORACLES[name])
    cols = [c[0] for c in rel.description]
    assert sorted(cols) == sorted(df.columns)
    assert canon(map(tuple, df.collect()), df.columns) == canon(rel.fetchall(), cols)
