"""Every registered query against its SQL on the smallest tables."""

from pathlib import Path

import pytest
from oracle import compare, connect

from tidemark.plans import catalog

FOLDER = Path("/root/testdata/sf0.001")
SQL = catalog.oracle_sql()
pytestmark = pytest.mark.skipif(not FOLDER.exists(), reason="no test tables")


@pytest.fixture(scope="module")
def db():
    return connect(FOLDER)


@pytest.mark.parametrize("name", list(catalog.queries()))
def test_query_matches_sql(spark, db, name):
    problem, _ = compare(spark, db, name, catalog.queries()[name], SQL.get(name), str(FOLDER))
    assert problem == ""


def test_only_clustering_has_no_sql():
    assert set(catalog.queries()) - set(SQL) == {"regional_clusters"}
