"""Every registered training-data query against its SQL, on the smallest tables."""

import functools

import compare
import pytest
from genoloom.llm import queries

BASE = "/root/testdata/sf0.001"


@functools.cache
def connection():
    return compare.connect(BASE)


@pytest.mark.parametrize("name", list(queries.QUERIES))
def test_query(spark, name):
    ok, rows, _, why = compare.check(spark, BASE, name, queries.QUERIES[name], queries.SQL.get(name), connection())
    assert ok is not False, why


def test_no_other_module_needs_this_one():
    import pathlib

    import genoloom

    root = pathlib.Path(genoloom.__file__).parent
    assert not [p for p in root.rglob("*.py") if "llm" not in p.parts and "llm" in p.read_text(encoding="utf-8")]
