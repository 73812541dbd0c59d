"""Every registered query against its SQL statement, on the smallest tables."""

import pytest

from tests.oracle import compare, connect
from tidemark.queries import ORACLES, QUERIES

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def connection():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, connection, name):
    assert compare(spark, connection, SF_DIR, name) is None


def test_every_query_has_a_statement():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize(
    "name", ["latest_record", "load_contracts", "lifecycle_pivot", "key_events_all", "setup_cascade", "save_moments"]
)
def test_result_does_not_depend_on_the_partitioning(spark, name):
    def result(partitions):
        before = spark.conf.get("spark.sql.shuffle.partitions")
        spark.conf.set("spark.sql.shuffle.partitions", partitions)
        try:
            df = QUERIES[name](spark, SF_DIR)
            return sorted(map(str, df.collect()))
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", before)

    assert result("1") == result("13")
