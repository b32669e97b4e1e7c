"""Every registered query against its DuckDB oracle (sf0.001 by default; KEYFLOW_ORACLE_SF to change)."""

import pytest

from support import SF_ORACLE
from keyflow.plans import ORACLES, all_queries
from oracle_compare import compare, duck

QUERIES = all_queries()


@pytest.fixture(scope="module")
def con():
    return duck(SF_ORACLE)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    assert name in ORACLES, f"{name} has no oracle"
    ok, msg = compare(spark, name, QUERIES[name], ORACLES[name], SF_ORACLE, con)
    assert ok, msg


CHUNKED = ["rolling_word_count", "running_event_count", "running_average", "parity_counter",
           "fraud_pairs", "rolling_cooccurrence", "sales_changelog"]


@pytest.mark.parametrize("name", CHUNKED)
def test_chunked_path_matches_oracle(spark, con, name):
    """The same queries with tiny chunks, so every hot key is split across tasks."""
    from keyflow.operators.scan import ROWS_PER_CHUNK_CONF
    spark.conf.set(ROWS_PER_CHUNK_CONF, "97")
    try:
        ok, msg = compare(spark, name, QUERIES[name], ORACLES[name], SF_ORACLE, con)
    finally:
        spark.conf.unset(ROWS_PER_CHUNK_CONF)
    assert ok, msg
