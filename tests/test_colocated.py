"""Facts in buckets of the customer: no shuffle below the joins, hot keys apart, the same scores."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from riskmart.adapters import AS_OF
from riskmart.plans import scoring as S
from riskmart.plans.compose import stage_to_mart
from riskmart.queries import QUERIES
from riskmart.queries.compose import staged
from riskmart.queries.registry import Inputs
from riskmart.queries.scores import COUNTRY, customers_of, fraud_of, history_of, loans_of, market_of
from riskmart.sources.colocated import save_colocated


def rows(df):
    return Counter(tuple(r) for r in df.select(sorted(df.columns)).collect())


def facts_of(t):
    return {"customers": customers_of(t), "loans": loans_of(t), "fraud": fraud_of(t), "profile": history_of(t)}


def profile(f, t):
    return S.risk_profile(f["customers"], f["loans"], f["loans"], f["fraud"], market_of(t), t.stg_macro, AS_OF, COUNTRY, profile=f["profile"], exact_date=False)


def test_no_shuffle_below_the_joins(spark, sf_dir):
    t = Inputs(spark, sf_dir)
    kept = save_colocated(facts_of(t), "CustomerSK", 4)
    assert kept.hot is None
    was = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = profile(kept.cold, t)._jdf.queryExecution().executedPlan().toString()
        plain = profile(facts_of(t), t)._jdf.queryExecution().executedPlan().toString()
        assert "hashpartitioning(CustomerSK" in plain and "SortMergeJoin" in text
        assert "hashpartitioning(CustomerSK" not in text
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", was)


def test_hot_customers_lie_apart(spark, sf_dir):
    """A customer with a third of the loans, and loans without one."""
    t = Inputs(spark, sf_dir)
    facts = facts_of(t)
    n = facts["loans"].count()
    some = facts["loans"].select(F.min("CustomerSK")).first()[0]
    more = facts["loans"].limit(n // 2).withColumn("CustomerSK", F.lit(some).cast(facts["loans"].schema["CustomerSK"].dataType))
    none = facts["loans"].limit(n // 4).withColumn("CustomerSK", F.lit(None).cast(facts["loans"].schema["CustomerSK"].dataType))
    facts["loans"] = facts["loans"].unionByName(more).unionByName(none)
    kept = save_colocated(facts, "CustomerSK", 4, least_rows=10)
    hot = {r[0] for r in kept.hot["loans"].select("CustomerSK").distinct().collect()}
    assert {some, None} <= hot and len(hot) < 8 * 4
    for name, df in kept.cold.items():
        assert not {r[0] for r in df.select("CustomerSK").distinct().collect()} & hot
        assert df.count() + kept.hot[name].count() == facts[name].count()


def test_scores_of_both_sides(spark, sf_dir):
    t = Inputs(spark, sf_dir)
    kept = save_colocated(facts_of(t), "CustomerSK", 4, least_rows=1)
    assert kept.hot is not None or kept.cold["loans"].count() == facts_of(t)["loans"].count()
    assert rows(kept.each(lambda f: profile(f, t))) == rows(profile(facts_of(t), t))


def test_empty_tables_and_several_types(spark):
    df = spark.createDataFrame([], "k long, v int")
    kept = save_colocated({"a": df, "b": df}, "k", 2)
    assert kept.hot is None and kept.each(lambda f: f["a"].join(f["b"], "k")).count() == 0
    with pytest.raises(TypeError):
        save_colocated({"a": df, "b": df.withColumn("k", F.col("k").cast("int"))}, "k", 2)


def test_a_load_with_buckets_scores_the_same(spark, sf_dir):
    t = Inputs(spark, sf_dir)
    want = QUERIES["e3_stage_to_mart"](spark, sf_dir)
    got = stage_to_mart(staged(t), AS_OF, COUNTRY, customer_buckets=4)["FactRiskProfile"]
    assert rows(got.drop("DateID").withColumns({c: F.col(c).cast("double") for c in want.columns if c.endswith("Score")})) == rows(want)
