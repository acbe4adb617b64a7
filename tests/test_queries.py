"""Every registered query against its SQL text; queries without one must return rows."""

import pytest

import __spark_entry__ as contract
from riskmart.queries import ORACLE, QUERIES
from tests.compare import compare


def test_contract_has_all():
    assert set(QUERIES) <= set(contract.queries()) and set(ORACLE) <= set(contract.oracle_sql())


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_query(key, spark, sf_dir, duck):
    df = QUERIES[key](spark, sf_dir)
    if key in ORACLE:
        assert compare(df, duck, ORACLE[key]) == []
    else:
        assert df.count() > 0


def test_entry(spark):
    df = contract.entry(spark)
    assert df.count() > 0
    assert df.columns[:2] == ["CustomerSK", "DateID"]


def test_only_queries_without_sql_form_lack_sql():
    assert set(QUERIES) - set(ORACLE) == {"e1_quality_before_after", "e3_later_load"}
