"""Every registered query against its DuckDB oracle (sf0.001)."""
import datetime as dt
import decimal
import math
from collections import Counter

import pytest

from veilset import registry

SF = "/root/testdata/sf0.001"

registry.load_all()


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 6)
    if isinstance(v, decimal.Decimal):
        return round(float(v), 6)
    if isinstance(v, (bytes, bytearray)):
        return bytes(v).hex()
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    return v


def _bag(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return Counter(tuple(_norm(r[i]) for i in order) for r in rows)


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_query_matches_oracle(spark, duck, name):
    df = registry.QUERIES[name](spark, SF)
    rows = df.collect()
    sql = registry.ORACLE.get(name)
    if sql is None:
        assert len(rows) >= 0
        return
    cur = duck.execute(sql)
    dcols = [d[0] for d in cur.description]
    drows = cur.fetchall()
    assert sorted(df.columns) == sorted(dcols)
    assert len(rows) == len(drows)
    assert _bag(df.columns, [tuple(r) for r in rows]) == _bag(dcols, drows)


def test_every_query_has_an_oracle():
    assert set(registry.QUERIES) == set(registry.ORACLE)
