"""Every registered query against its SQL counterpart on the smallest tables."""

import importlib.util
import os

import pytest
from conftest import ROOT
from oracle import compare, connect

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")

spec = importlib.util.spec_from_file_location("entry", os.path.join(ROOT, "__spark_entry__.py"))
entry = importlib.util.module_from_spec(spec)
spec.loader.exec_module(entry)

# The SQL of these states the limit law of the KS statistic, which holds for
# samples of more than 10 000 rows; smaller ones get exact p-values.
NEEDS_ROWS = {n for n in entry.queries() if n.startswith("drift") and "ks" in n}
LARGER_DIR = SF_DIR.replace("sf0.001", "sf0.01")

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_query(spark, con, name):
    if name in NEEDS_ROWS:
        con = connect(LARGER_DIR)
    df = entry.queries()[name](spark, LARGER_DIR if name in NEEDS_ROWS else SF_DIR)
    sql = entry.oracle_sql().get(name)
    if sql is None:
        assert df.count() > 0
    else:
        assert compare(df, con, sql) is None


def test_oracles_belong_to_queries():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry(spark):
    assert entry.entry(spark).count() == 4
