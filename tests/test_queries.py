"""Every registered query against its SQL."""

import oracle
import pytest

import __spark_entry__ as entry
from sluice.plans import QUERIES


@pytest.fixture(scope="module")
def con(sf_dir):
    return oracle.connect(sf_dir)


@pytest.mark.parametrize("name", list(QUERIES))
def test_matches_sql(spark, sf_dir, con, name):
    assert oracle.differences(QUERIES[name].run(spark, sf_dir), QUERIES[name].sql, con) is None


def test_every_query_has_sql():
    assert all(entry.oracle_sql()[name] for name in QUERIES)
    assert set(QUERIES) <= set(entry.queries())


def test_flagship(spark):
    df = entry.entry(spark)
    assert df.columns == ["batch_id", "file_name", "n_records", "min_offset", "max_offset", "n_bytes"]
    assert df.count() > 0
