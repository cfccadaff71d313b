"""Every registered query equals its DuckDB oracle SQL (the driver's gate), and
the entry point returns a stable schema."""

import pytest

import __spark_entry__ as E
from oracle_harness import compare, duck
from conftest import SF_SMALL

QUERIES = E.queries()
ORACLE = E.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


def test_every_query_has_oracle_or_is_file_op():
    missing = sorted(n for n in set(QUERIES) - set(ORACLE) if n != "pipeline" and not n.startswith("op"))
    assert missing == ["file_checks", "storage_report"]


@pytest.mark.parametrize("name", sorted(n for n in ORACLE if not n.startswith("op")))
def test_query_matches_oracle(spark, con, name):
    ok, msg = compare(spark, name, QUERIES[name], ORACLE[name], SF_SMALL, con)
    assert ok, msg


@pytest.mark.parametrize("name", ["file_checks", "storage_report"])
def test_file_queries_run(spark, name):
    assert QUERIES[name](spark, SF_SMALL).count() >= 1


def test_entry_schema(spark):
    df = E.entry(spark)
    assert df.columns == ["risk_tier", "loan_count", "avg_risk_score", "avg_loan_amount", "avg_ltv",
                          "avg_dti", "avg_interest_rate"]
    assert 1 <= df.count() <= 4
