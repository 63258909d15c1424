"""Every registered query of the library next to DuckDB on the smallest tables."""

import pytest
from compare import compare, duck

from tidemark.plans import catalog

ROOT = "/root/testdata/sf0.001"
#: SQL can't say what these give; the tests named hold them against a plain version.
OWN_TEST = {
    "J37_als_recommender": "test_jobs.py", "N7_product_codes": "test_search.py", "N9_recall_by_probes": "test_search.py",
    "N11_parameter_grid": "test_search.py", "O16_graph_embedding": "test_graph.py",
}


@pytest.fixture(scope="module")
def con():
    return duck(ROOT)


@pytest.mark.parametrize("name", sorted(set(catalog.queries()) - set(OWN_TEST)))
def test_query(spark, con, name):
    verdict, detail = compare(spark, con, ROOT, name, catalog.queries()[name], catalog.check_sql().get(name))
    assert verdict == "ok", f"{verdict} {detail}"


def test_queries_without_sql_are_tested_elsewhere():
    assert set(catalog.queries()) - set(catalog.check_sql()) == set(OWN_TEST)


def test_entry(spark):
    import __spark_entry__ as driver

    assert driver.entry(spark).count() > 0
