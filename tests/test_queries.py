"""Every registered query outside the training-data subpackage against its SQL on the smallest tables."""

import decimal
from pathlib import Path

import duckdb
import pytest

from urbanlake.plans import columns, queries, state  # noqa: F401

DIR = "/root/testdata/sf0.001"


def norm(v):
    if v is None or v != v:
        return "-"
    if isinstance(v, decimal.Decimal):
        v = float(v)
    return f"{v:.9g}" if isinstance(v, float) or isinstance(v, int) and not isinstance(v, bool) and abs(v) < 1e9 else str(v)


@pytest.fixture(scope="module")
def db():
    c = duckdb.connect()
    for p in Path(DIR).glob("*.parquet"):
        c.execute(f"create view {p.stem} as select * from '{p}'")
    return c


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query(spark, db, name):
    df = queries.QUERIES[name](spark, DIR)
    names = sorted(df.columns)
    found = sorted(tuple(norm(v) for v in r) for r in df.select(*(f"`{c}`" for c in names)).collect())
    cur = db.execute(queries.ORACLES[name])
    order = [[x[0] for x in cur.description].index(c) for c in names]
    assert found == sorted(tuple(norm(r[i]) for i in order) for r in cur.fetchall())
