"""Every catalog query equals its SQL oracle (DuckDB) on the smallest folder."""

import pytest

from oracle_compare import compare, duck
from starloom.plans.catalog import queries
from starloom.plans.oracle import oracle_sql

SF = "/root/testdata/sf0.001"
QUERIES = queries()
SQL = oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(SQL)


@pytest.mark.parametrize("name", [
    "fact_rejects_earlier_departments", "dq_foreign_key_earlier_departments", "dq_one_current_unclosed",
    "scd2_rejects", "active_projects_later", "active_projects_none_open", "role_change_rejects",
    "onboard_rejects", "dq_not_null", "dq_unique", "dq_check", "scd2_integrity"])
def test_rules_act_on_the_staged_rows(con, name):
    assert con.execute(f"select count(*) from ({SQL[name]})").fetchall()[0][0] > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    ok, msg = compare(spark, con, name, QUERIES[name], SQL[name], SF)
    assert ok, msg
