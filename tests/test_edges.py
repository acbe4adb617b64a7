"""Bad values, repeated rows, hot keys and failures in the middle."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskmart.functions.expr import null_apart
from riskmart.functions.stats import quantiles
from riskmart.operators import clean, conform, keys, profile, repair
from riskmart.plans import ifrs9, marts, runlog
from riskmart.sources import files


def largest_share(df, spark):
    n = [r["n"] for r in df.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()]
    return max(n) / (sum(n) / 8)


@pytest.fixture
def plain_joins(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.adaptive.enabled")
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_upsert_of_two_literal_dates_keeps_its_keys(spark, plain_joins):
    target = spark.range(5).select("id", F.lit("2024-01-01").cast("date").alias("day"), F.lit(1).alias("v"))
    source = spark.range(3, 8).select("id", F.lit("2024-02-01").cast("date").alias("day"), F.lit(2).alias("v"))
    out = keys.upsert(target, source, ["id", "day"], ["v"])
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "SortMergeJoin" in plan
    assert out.count() == 10
    again = keys.upsert(out, source.withColumn("v", F.lit(3)), ["id", "day"], ["v"])
    assert again.count() == 10 and again.where("v = 3").count() == 5
    nulls = spark.createDataFrame([(None, None, 1)], "id long, day date, v int")
    assert keys.upsert(nulls, nulls, ["id", "day"], ["v"]).count() == 2


def test_bad_numbers_become_zero(spark):
    df = spark.createDataFrame([("3000000000", float("nan")), ("NaN", float("inf")), ("12", 7.0), (None, None)], "t string, d double")
    out = df.select(conform.convert_type(df, "t", T.IntegerType()).alias("a"), conform.convert_type(df, "t", T.LongType()).alias("b"),
                    conform.convert_type(df, "d", T.LongType()).alias("c"), conform.convert_type(df, "t", T.DecimalType(5, 2)).alias("e"))
    assert [tuple(map(float, r)) for r in out.collect()] == [(0, 3e9, 0, 0), (0, 0, 0, 0), (12, 12, 7, 12), (0, 0, 0, 0)]


def test_whole_numbers_from_infinity(spark):
    df = spark.createDataFrame([(float("inf"),), (float("nan"),), (3.0,), (None,)], "LoanCount double")
    assert [r[0] for r in clean.float_to_int(df).collect()] == [0, 0, 3, 0]


def test_values_beyond_a_type_are_dropped_by_repair(spark):
    df = spark.createDataFrame([(1,)], "a int")
    assert repair._put(df, {"a": F.lit(1e12)}).first()["a"] is None


def test_quantiles_of_huge_spans_end(spark):
    df = spark.createDataFrame([(x,) for x in (-1e308, 1.0, 2.0, 1e308)], "v double")
    assert quantiles(df, ["v"], (0.0, 1.0))["v"] == {0.0: -1e308, 1.0: 1e308}
    assert quantiles(df, ["v"], (0.5,))["v"][0.5] == 1.5


def test_reports_have_all_columns_and_groups(spark):
    df = spark.range(20).select(*[(F.col("id") * i % 7).alias(f"c{i}") for i in range(1, 14)])
    assert profile.histograms(df).select("column_name").distinct().count() == 13
    assert profile.correlation_matrix(df).count() == 13 * 12 // 2
    log = spark.range(150).select(F.concat(F.lit("p"), "id").alias("ProcedureName"), F.lit("Success").alias("Status"), F.lit(1).alias("ExecutionTimeSeconds"))
    assert runlog.etl_dashboard(log).count() == 150 and runlog.etl_dashboard(log, top=7).count() == 7


def test_many_scenarios(spark):
    scenarios = spark.range(130).select(F.col("id").cast("int").alias("ScenarioID"), F.concat(F.lit("s"), "id").alias("ScenarioName"), F.lit(0.5).alias("ScenarioWeight"),
                                        F.lit(1).alias("IsActive"), F.lit("2020-01-01").cast("date").alias("EffectiveDate"), F.lit(None).cast("date").alias("ExpiryDate"))
    day = F.lit("2024-01-30").cast("date")
    key = [F.lit(1).alias("CustomerSK"), F.lit(1).alias("AccountSK")]
    params = spark.range(1).select(*key, day.alias("AsOfDate"), *[F.lit(0.1).alias(c) for c in ("PD_12Month", "PD_Lifetime", "LGD", "EIR")], F.lit(100.0).alias("EAD"),
                                   F.lit(24).alias("Maturity"), F.lit(120).alias("MacroeconomicScenarioID"))
    stages = spark.range(1).select(*key, day.alias("AsOfDate"), F.lit(1).alias("ECLStage"))
    loans = spark.range(1).select(*key, F.lit(50.0).alias("CurrentBalance"), F.lit(1).alias("IsActive"))
    assert ifrs9.ecl(params, stages, loans, scenarios, "2024-01-30", scenario_mode="all").count() == 130
    assert [r["ScenarioID"] for r in ifrs9.ecl(params, stages, loans, scenarios, "2024-01-30", include_all=True).collect()] == [120]


def test_repeated_transactions_and_days_load_once(spark):
    customers = spark.createDataFrame([(1, 10, 1)], "CustomerID int, CustomerSK int, IsCurrent int")
    transactions = spark.createDataFrame([(5, 20240101)], "TransactionID int, TransactionDateID int")
    fraud = spark.createDataFrame([(5, 1, 3.0), (5, 1, 4.0)], "TransactionID int, CustomerID int, DistanceFromLastTransaction double")
    assert [r["DistanceFromLastTransaction"] for r in marts.fact_fraud(fraud, customers, transactions).collect()] == [4.0]
    dates = spark.createDataFrame([("2024-01-01", 20240101)], "d string, DateID int").select(F.col("d").cast("date").alias("FullDate"), "DateID")
    countries = spark.createDataFrame([(1, "USA")], "CountryID int, CountryName string")
    macro = spark.createDataFrame([("2024-01-01", "USA", 1.0), ("2024-01-01", "USA", 2.0)], "ReportDate string, CountryName string, InflationRate double")
    assert marts.fact_economic(macro, countries, dates).count() == 1


def test_rank_within_keeps_a_hot_group_spread(spark, plain_joins):
    df = spark.range(20_000).select(F.when(F.col("id") % 3 > 0, F.lit(-1)).otherwise(F.col("id")).alias("g"), "id").repartition(8)
    out = keys.rank_within(df, ["g"], ["id"], "rn")
    assert largest_share(out, spark) <= 2
    hot = sorted(r["rn"] for r in out.where("g = -1").collect())
    assert hot == list(range(1, len(hot) + 1)) and out.where("g >= 0 AND rn <> 1").count() == 0


def test_null_keys_stay_apart(spark, plain_joins):
    left = spark.range(20_000).select("id", F.when(F.col("id") % 10 == 0, F.col("id")).alias("k")).repartition(8)
    right = spark.range(0, 20_000, 10).select(F.col("id").cast("string").alias("rk"), F.lit(1).alias("hit"))
    out = left.withColumn("_apart", null_apart("k")).join(right, F.col("_apart") == F.col("rk"), "left")
    assert largest_share(out, spark) <= 2 and out.where("hit = 1").count() == 2000 and out.count() == 20_000


def test_reload_survives_a_failure_in_the_middle(spark, tmp_path):
    bad = spark.range(3).select(F.raise_error(F.lit("stop")).alias("x"))
    with pytest.raises(Exception, match="stop"):
        files.reload_tables({"A": spark.range(2), "B": bad}, str(tmp_path), "b1")
    with pytest.raises(Exception):
        files.published(spark, str(tmp_path), "b1")
    files.reload_tables({"A": spark.range(2), "B": spark.range(4)}, str(tmp_path), "b1")
    assert {k: v.count() for k, v in files.published(spark, str(tmp_path), "b1").items()} == {"A": 2, "B": 4}


def test_movements_of_all_periods_are_kept(spark):
    loans = spark.createDataFrame([(1, 10, 700, 0, 12), (2, 20, 500, 95, 48)], "CustomerSK int, AccountSK int, CreditScore int, DaysPastDue int, TermMonths int").withColumns({
        "IsActive": F.lit(1), "CreditScoreDecreasePercent": F.lit(0.0), "CurrentBalance": F.lit(500.0), "InterestRate": F.lit(5.0), "MaturityDate": F.lit("2030-01-01").cast("date"),
        **{c: F.lit(0) for c in ("IsDefaulted", "BankruptcyFlag", "ChargeOffFlag", "WatchListFlag", "ModifiedLoanFlag", "ForbearanceFlag")}})
    accounts = spark.createDataFrame([(1, 10, "Loan"), (2, 20, "Loan")], "CustomerSK int, AccountSK int, AccountType string")
    state = None
    for day in ("2024-01-01", "2024-02-01", "2024-03-01", "2024-03-01"):
        state = ifrs9.run_ifrs9(accounts, loans, ifrs9.seed_scenarios(spark), day, state)
    periods = sorted((str(r["FromDate"]), str(r["ToDate"])) for r in state["movement"].select("FromDate", "ToDate").distinct().collect())
    assert periods == [("2024-01-01", "2024-02-01"), ("2024-02-01", "2024-03-01")]
    assert state["movement"].count() == 4


def test_ids_of_several_columns_share_a_dictionary(spark):
    rows = [("b", "x", 10, None, 1.5), ("a", None, 9, None, 2.5), ("b", "y", 10, None, 3.5), (None, "x", None, None, None), ("a", "b", 100, None, 4.5)] * 3
    df = spark.createDataFrame(rows, "p string, `q.r` string, n long, nothing string, rest double").repartition(4)
    out = conform.ids_to_int(df, ["p", "q.r", "n", "nothing"])
    assert out.columns == df.columns
    want = {(2, 2, 2, 0, 1.5), (1, 0, 1, 0, 2.5), (2, 3, 2, 0, 3.5), (0, 2, 0, 0, None), (1, 1, 3, 0, 4.5)}
    got = [tuple(r) for r in out.collect()]
    assert set(got) == want and len(got) == len(rows)
    empty = conform.ids_to_int(df.limit(0), ["p", "q.r"])
    assert empty.count() == 0 and empty.columns == df.columns


def test_ids_of_a_hot_value(spark):
    df = spark.range(5000).select("id", F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("a"), F.lit("one").alias("b"))
    out = conform.ids_to_int(df, ["a", "b"])
    distinct = df.select("a").distinct().count()
    assert out.agg(F.count("*"), F.countDistinct("a"), F.min("a"), F.max("a"), F.max("b"), F.countDistinct("id")).first() == (5000, distinct, 1, distinct, 1, 5000)
