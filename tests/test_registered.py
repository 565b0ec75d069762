"""Every registered query against its SQL on the smallest driver tables."""

from __future__ import annotations

import importlib.util
from pathlib import Path

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from obsloom.registered.catalog import REGISTRY

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="driver tables absent")

_spec = importlib.util.spec_from_file_location("compare", Path(__file__).parent.parent / "tools" / "compare.py")
compare = importlib.util.module_from_spec(_spec)
_spec.loader.exec_module(compare)


@pytest.fixture(scope="module")
def oracle():
    return compare.connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(REGISTRY.queries))
def test_query_equals_its_sql(spark, oracle, name):
    assert name in oracle_sql()
    result = queries()[name](spark, SF_DIR)
    assert compare.difference(result, oracle.sql(oracle_sql()[name])) is None


def test_entry(spark):
    assert entry(spark).count() > 0
