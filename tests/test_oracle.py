"""Every registered query against its DuckDB oracle on the smallest test tables
(the driver runs the same comparison at sf0.01)."""

import math

import pytest

from __spark_entry__ import entry
from spendwatch.plans.oracle import oracle_sql
from spendwatch.plans.registry import queries

from .conftest import SF0001


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else float(f"{v:.9g}")
    return v


def _rows(records, cols):
    return sorted((tuple(_norm(r[c]) for c in cols) for r in records), key=repr)


def test_every_query_has_an_oracle():
    assert set(queries()) == set(oracle_sql())
    assert len(queries()) >= 35


@pytest.mark.parametrize("name", sorted(queries()))
def test_query_matches_oracle(spark, duck0001, name):
    df = queries()[name](spark, SF0001)
    s_rows = [r.asDict() for r in df.collect()]
    res = duck0001.execute(oracle_sql()[name])
    o_cols = [d[0] for d in res.description]
    o_rows = [dict(zip(o_cols, r)) for r in res.fetchall()]
    assert sorted(df.columns) == sorted(o_cols)
    cols = sorted(o_cols)
    assert _rows(s_rows, cols) == _rows(o_rows, cols)


def test_entry_runs(spark):
    df = entry(spark)
    assert df.count() > 0
    assert "fraud_risk_level" in df.columns
