"""Every registered query against its SQL on the smallest tables."""

import os

import pytest
from oracle import connect, difference

import __spark_entry__ as entry

SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")
SQL = entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    if not os.path.isdir(SF_DIR):
        pytest.skip("test tables are not here")
    return connect(SF_DIR)


# The training-data queries are compared in tests/llm.
NAMES = [n for n in entry.queries() if n in SQL and not n.startswith("op") and n != "pipeline"]


@pytest.mark.parametrize("name", NAMES)
def test_query_agrees_with_sql(spark, con, name):
    assert difference(entry.queries()[name](spark, SF_DIR), con, SQL[name]) is None


@pytest.fixture
def generated(spark):
    """Run with generated code, as a cluster does; the other tests interpret their plans."""
    off = {k: spark.conf.get(k) for k in ("spark.sql.codegen.wholeStage", "spark.sql.codegen.factoryMode")}
    spark.conf.set("spark.sql.codegen.wholeStage", "true")
    spark.conf.set("spark.sql.codegen.factoryMode", "CODEGEN_ONLY")
    yield spark
    for key, value in off.items():
        spark.conf.set(key, value)


GENERATED = [
    "a2_normalise",
    "c1_parse_ts",
    "d2_latest_per_key",
    "d9_staged_requests",
    "e5_fct_service_requests",
    "e6_fct_status_history",
    "f2_resolution_time",
    "h9_duplicate_rate",
]


@pytest.mark.parametrize("name", GENERATED)
def test_generated_code_agrees_with_sql(generated, con, name):
    assert difference(entry.queries()[name](generated, SF_DIR), con, SQL[name]) is None
