"""Plans of the registered queries: no pair-wise joins, no row-wise Python, pruned scans."""

from collections import Counter

import pytest

from riskmart.operators.keys import upsert
from riskmart.operators.scd import scd2_apply, scd2_start
from riskmart.plans import marts
from riskmart.queries import QUERIES
from riskmart.queries.compose import staged as staged_tables
from riskmart.queries.registry import Inputs

PYTHON_BY_DESIGN = {"e2_register_strategies", "p6_impute_numeric", "p7_knn_impute"}


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def keyless(text: str) -> list[str]:
    """Outer, semi and anti joins without a key; inner ones attach a row of statistics."""
    return [x.strip() for x in text.splitlines() if "NestedLoopJoin" in x and " Inner" not in x and " Cross" not in x]


@pytest.mark.parametrize("key", ["s7_risk_profile", "i9_ecl", "w7_ecl_staging_summary", "w14_ecl_summary", "v10_validate_staging", "w12_ifrs9_vs_ias39", "r4_fix_loan", "m6_aggregate_customer_snapshot", "v13_fraud_rate_drift"])
def test_no_cartesian_products(key, spark, sf_dir):
    text = plan(QUERIES[key](spark, sf_dir))
    assert "CartesianProduct" not in text
    assert not keyless(text)
    for python in ("BatchEvalPython", "ArrowEvalPython", "MapInPandas", "FlatMapGroups"):
        assert python not in text


def test_scans_read_only_what_is_needed(spark, sf_dir):
    df = QUERIES["v9_check_constraints"](spark, sf_dir)
    text = plan(df)
    scans = [line for line in text.splitlines() if "events" in line and "ReadSchema" in line]
    assert scans and all("props" not in line.split("ReadSchema")[1] for line in scans)


def test_filters_reach_the_files(spark, sf_dir):
    text = plan(QUERIES["k3_upsert"](spark, sf_dir))
    assert "PushedFilters: [IsNotNull(o_orderdate), GreaterThanOrEqual(o_orderdate" in text


def test_gate_lists_what_it_broadcasts(spark, sf_dir):
    # Everything joined without a key is a single row of counts.
    text = plan(QUERIES["v12_validate_pre_production"](spark, sf_dir))
    assert "CartesianProduct" not in text
    assert not keyless(text)


def test_upsert_moves_the_source_once(spark):
    """The join takes the grouped source as it lies: one exchange of the source, one of the target (before: two and one)."""
    was = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        target = spark.createDataFrame([(1, 1, "a"), (None, 2, "b"), (3, None, "c")], "k long, d long, v string")
        source = spark.createDataFrame([(1, 1, "x", 1), (1, 1, "y", 2), (None, 2, "z", 1), (4, 4, "w", 1)], "k long, d long, v string, n long")
        out = upsert(target, source, ["k", "d"], ["v"], latest_by=["k", "n"])
        assert out._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning(") == 2
        assert Counter(map(tuple, out.collect())) == Counter(
            [(1, 1, "y"), (None, 2, "b"), (3, None, "c"), (None, 2, "z"), (4, 4, "w")])
        with pytest.raises(Exception, match='duplicate source key: \\{"k":1,"d":1\\}'):
            upsert(target, source, ["k", "d"], ["v"]).collect()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", was)


def test_a_load_reads_staged_tables_that_are_built_once(spark, sf_dir):
    """Before: orders and customers were joined anew by every step."""
    for df in staged_tables(Inputs(spark, sf_dir)).values():
        assert df.inputFiles() and not any(f.startswith(f"file://{sf_dir}") for f in df.inputFiles())


def test_a_changed_batch_is_grouped_once(spark):
    """Kept and new rows come from one settled batch: the plan of the result reads it without grouping it again (before: twice)."""
    first = scd2_start(spark.createDataFrame([(1, "a"), (2, "b")], "k long, v string"), "k", ["v"], "2024-01-01", "sk")
    batch = spark.createDataFrame([(1, "a"), (2, "c"), (3, "d")], "k long, v string")
    out = scd2_apply(first, batch, "k", ["v"], "2024-02-01", "sk")
    assert "any_value" not in out._jdf.queryExecution().optimizedPlan().toString()
    assert {(r["k"], r["v"], r["IsCurrent"]) for r in out.collect()} == {(1, "a", 1), (2, "b", 0), (2, "c", 1), (3, "d", 1)}


def test_keys_of_customers_are_not_broadcast(spark):
    """Small or not: a size by compressed files decides before a join has run, and millions of keys then fill the driver. Days alone are broadcast."""
    customers = spark.createDataFrame([(1, 1, 1), (2, 2, 1)], "CustomerSK long, CustomerID long, IsCurrent int")
    accounts = spark.createDataFrame([(1, "a"), (2, "b")], "AccountSK long, AccountID string")
    loans = spark.createDataFrame([("a", 5.0), ("b", 6.0)], "AccountID string, AccountBalance double")
    old = spark.createDataFrame([(1, "a", 4.0)], "AccountSK long, AccountID string, AccountBalance double")
    balances = marts.fact_account(loans, accounts, old)
    assert "Broadcast" not in plan(balances) and {tuple(r) for r in balances.collect()} == {(1, "a", 4.0), (2, "b", 6.0)}
    fraud = spark.createDataFrame([("t", 1, 0), ("u", 2, 1), ("v", 9, 1)], "TransactionID string, CustomerID long, IsFraudulent int")
    days = spark.createDataFrame([("t", 20240101), ("u", 20240102), ("v", 20240102)], "TransactionID string, TransactionDateID int")
    first = marts.fact_fraud(fraud, customers, days)
    again = marts.fact_fraud(fraud, customers, days, first)
    assert "Broadcast" not in plan(first) + plan(again)
    assert {tuple(r) for r in again.collect()} == {("t", 20240101, 1, 0), ("u", 20240102, 2, 1)}
