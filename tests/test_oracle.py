"""Every query with SQL against DuckDB; every other query gives rows. TEST_SF chooses the data."""

import os

import oracle
import pytest

from tileplan import registry

registry.load()
ROOT = f"/root/testdata/{os.environ.get('TEST_SF', 'sf0.001')}"


@pytest.fixture(scope="module")
def con():
    return oracle.connect(ROOT)


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_query(spark, con, name):
    df = registry.QUERIES[name](spark, ROOT)
    if name in registry.ORACLE:
        assert oracle.difference(df, con, registry.ORACLE[name]) is None
    else:
        assert df.count() > 0
