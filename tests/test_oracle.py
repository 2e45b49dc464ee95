"""Differential test: each registered query vs its DuckDB SQL twin (sf0.001)."""

import datetime as dt
import math
import os

import duckdb
import pytest

from tradelens.plans.registry import load_all
from tradelens.sources.tables import TABLES

SF = os.environ.get("TRADELENS_TEST_SF", "/root/testdata/sf0.001")
QUERIES = {n: q for n, q in load_all().items() if q.sql}
# DuckDB type -> Spark simpleString, for the schema part of the comparison
TYPES = {"BIGINT": "bigint", "INTEGER": "int", "DOUBLE": "double", "VARCHAR": "string",
         "DATE": "date", "BOOLEAN": "boolean", "TIMESTAMP": "timestamp_ntz", "FLOAT": "float"}


def _norm(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return None
    if isinstance(v, float):
        return float(f"{v:.9g}")
    if isinstance(v, dt.datetime):
        return v.date() if v.time() == dt.time(0) else v
    if hasattr(v, "item"):
        return _norm(v.item())
    return v


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(_norm(r[i]) for i in order) for r in rows), key=repr)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    q = QUERIES[name]
    sdf = q.fn(spark, SF)
    srows = [tuple(r) for r in sdf.collect()]
    rel = con.sql(q.sql)
    dtypes = {c: TYPES.get(str(t), str(t).lower()) for c, t in zip(rel.columns, rel.types)}
    stypes = {f.name: f.dataType.simpleString() for f in sdf.schema.fields}
    assert stypes == dtypes
    res = con.execute(q.sql)
    dcols = [d[0] for d in res.description]
    drows = res.fetchall()
    assert sorted(sdf.columns) == sorted(dcols)
    assert len(srows) == len(drows)
    assert _rows(sdf.columns, srows) == _rows(dcols, drows)
