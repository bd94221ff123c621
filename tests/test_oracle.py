"""Every registered query against its SQL, over whole tables."""

from __future__ import annotations

import os

import pytest

from countertide.catalog import REGISTRY
from tests.oracle import compare, connect

FOLDER = os.environ.get("ORACLE_DIR", "/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test tables are not here")


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


@pytest.mark.parametrize("name", [n for n, q in REGISTRY.items() if q.sql])
def test_query_equals_sql(spark, con, name):
    verdict, _rows, _took = compare(spark, con, FOLDER, REGISTRY[name])
    assert verdict.startswith("ok"), verdict


def test_entry_has_rows(spark):
    import __spark_entry__ as driver

    result = driver.entry(spark)
    assert result.count() > 0
    assert set(driver.oracle_sql()) <= set(driver.queries())


@pytest.mark.parametrize("name", [n for n, q in REGISTRY.items() if not q.sql])
def test_query_without_sql_runs(spark, name):
    rows = REGISTRY[name](spark, FOLDER).toPandas()
    assert len(rows.columns) > 0
    # The smallest tables have too few texts to choose components.
    assert len(rows) > 0 or name == "choose_svd_k"
