"""Every core query runs on the smallest tables and equals its SQL twin."""

from __future__ import annotations

import pytest
from conftest import SF, same

from litweft.plans import core, filters, general, more, roundtrip, serving, stream, text

MODULES = [core, filters, general, more, roundtrip, serving, stream, text]
NAMES = [(m, n) for m in MODULES for n in m.QUERIES]


@pytest.mark.parametrize(("module", "name"), NAMES, ids=[n for _, n in NAMES])
def test_query(spark, duck, module, name):
    df = module.QUERIES[name](spark, SF)
    if name in module.ORACLE:
        same(df, duck.sql(module.ORACLE[name]))
    else:
        assert df.count() > 0


def test_every_sql_twin_has_a_query():
    for m in MODULES:
        assert set(m.ORACLE) <= set(m.QUERIES)


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())
