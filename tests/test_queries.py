import os

import pytest

import __spark_entry__ as entry
import check_queries

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
needs_data = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables here")


def test_every_query_has_sql():
    own = {key for module, _ in entry.MODULES for key in module.QUERIES}
    assert own <= set(entry.oracle_sql())
    assert set(entry.oracle_sql()) <= set(entry.queries())


@needs_data
def test_flagship_query(spark):
    assert entry.entry(spark).count() >= 5


@needs_data
@pytest.mark.parametrize(
    "keys", [["quality_ledger", "clean_records", "daily_error_counts"], ["chunk_export", "search_current"], ["compare_fields", "inventory_diff", "secret_scan"]]
)
def test_queries_equal_their_sql(spark, keys):
    assert check_queries.compare(spark, FOLDER, keys) == []
