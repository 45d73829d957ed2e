"""Every registered query of the core against its SQL, on the smallest tables."""

import functools

import __spark_entry__ as e
import compare
import pytest

BASE = "/root/testdata/sf0.001"
CORE = [n for m in e._MODULES if ".llm" not in m.__name__ for n in m.QUERIES]


@functools.cache
def connection():
    return compare.connect(BASE)


@pytest.mark.parametrize("name", CORE)
def test_query(spark, name):
    ok, rows, _, why = compare.check(spark, BASE, name, e.queries()[name], e.oracle_sql().get(name), connection())
    assert ok is not False, why


def test_entry(spark):
    assert e.entry(spark).count() > 0


def test_names():
    assert set(e.oracle_sql()) <= set(e.queries())
    assert set(CORE) <= set(e.oracle_sql())
