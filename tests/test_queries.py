"""Every named query against its SQL."""

import pytest

from freshet.catalog import all_queries
from tests.compare import compare, connect

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(all_queries()))
def test_query(spark, con, name):
    query = all_queries()[name]
    if query.sql is None:
        assert query.run(spark, SF).count() > 0
        return
    ours, theirs, *_ = compare(spark, con, query.run, query.sql, SF)
    assert ours == theirs and ours[1] > 0


def test_entry_file(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).columns[:2] == ["doc_id", "chunk_id"]
    assert set(entry.oracle_sql()) <= set(entry.queries())
