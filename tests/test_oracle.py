"""Every query at the smallest scale; those with SQL must give the same rows as the database."""
import math
import os

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from boxloom.plans import fixtures

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")
TYPES = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN"}


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    for t in fixtures.TABLES:
        con.execute(f"create view {t} as select * from '{FOLDER}/{t}.parquet'")
    return con


def clean(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 9) + 0.0
    return v


def in_order(rows):
    return sorted(rows, key=lambda r: tuple((v is None, str(v)) for v in r))


@pytest.mark.parametrize("name", sorted(queries()))
def test_query(spark, db, name):
    df = queries()[name](spark, FOLDER)
    cols = sorted(df.columns)
    rows = [tuple(clean(r[c]) for c in cols) for r in df.collect()]
    if name not in oracle_sql():
        assert rows or name == "lvis_ap"
        return
    cur = db.execute(oracle_sql()[name])
    names = [c[0] for c in cur.description]
    assert sorted(names) == cols
    kinds = {c[0]: str(c[1]) for c in cur.description}
    assert {c: TYPES.get(df.schema[c].dataType.simpleString()) for c in cols} == {c: kinds[c] for c in cols}
    at = [names.index(c) for c in cols]
    assert in_order(rows) == in_order([tuple(clean(r[i]) for i in at) for r in cur.fetchall()])


def test_entry(spark):
    assert entry(spark).count() > 0
