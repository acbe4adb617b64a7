"""Whole runs and strategies (E family)."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskmart.adapters import AS_OF
from riskmart.operators import repair
from riskmart.operators.validate import quality_score
from riskmart.plans.compose import Strategies, cook_dataset, stage_to_mart
from riskmart.plans.runlog import table_counts
from riskmart.queries.keys import DIM_CUSTOMER
from riskmart.queries.registry import Inputs, ctes, query
from riskmart.queries.scores import ADAPTERS_ALL, BASE, COUNTRY, SCORES, AGG, SCORE_COLS
from riskmart.schemas import MACRO
from riskmart.session import staged as saved

LATER = "2024-03-01"
MACRO_MAPPING = {c: c for c in ("ReportDate", "CountryName", "UnemploymentRate", "GDP", "DebtRatio", "DeficitRatio", "InflationRate", "ConsumerPriceIndex")}


def cooked_macro(t: Inputs):
    return cook_dataset(t.stg_macro, "Macro", MACRO, MACRO_MAPPING, ["ReportDate", "CountryName"], AS_OF, seed=7, clean_first=False)


def scaled(c: str, digits: int = 2) -> str:
    return f"ROUND_EVEN(({c} - MIN({c}) OVER ()) / (MAX({c}) OVER () - MIN({c}) OVER ()), {digits})"


@query("e1_cook_dataset", ctes(f"""
SELECT ReportDate, CountryName, {scaled('UnemploymentRate')} AS UnemploymentRate, GDP, {scaled('DebtRatio')} AS DebtRatio, {scaled('DeficitRatio')} AS DeficitRatio, InflationRate, ConsumerPriceIndex FROM stg_macro""", "stg_macro"))
def e1(t):
    """The macro table: its missing house price index is generated, ratios are scaled, then it is checked and conformed."""
    done, _ = cooked_macro(t)
    return done.drop("HousePriceIndex")


@query("e1_quality_before_after")
def e1_quality(t):
    return quality_score(cooked_macro(t)[1])


def strategies() -> Strategies:
    s = Strategies()
    s.register("fix", "online_flags", repair.fix_online_flags)
    s.register("fix", "fraud_ranges", lambda df: repair.fix_fraud(df, AS_OF))
    s.register("process", "keys_only", lambda df: df.select("TransactionID", "CustomerID", "IsOnlineTransaction", "IsUsedChip", "IsUsedPIN", "DistanceFromLastTransaction"))
    s.register("transform", "double_distance", lambda df: df.withColumn("DistanceFromLastTransaction", F.col("DistanceFromLastTransaction") * 2))
    return s


@query("e2_register_strategies", ctes("""
SELECT TransactionID, CustomerID, IsOnlineTransaction, CASE WHEN IsOnlineTransaction = 1 THEN 0 ELSE IsUsedChip END AS IsUsedChip, CASE WHEN IsOnlineTransaction = 1 THEN 0 ELSE IsUsedPIN END AS IsUsedPIN,
 LEAST(ABS(DistanceFromLastTransaction * 2), 20000) AS DistanceFromLastTransaction FROM stg_fraud""", "stg_fraud"))
def e2(t):
    s = strategies()
    df = s.apply("process", ["keys_only"], t.stg_fraud)
    df = s.apply("transform", ["double_distance"], df)
    return s.apply("fix", ["online_flags", "fraud_ranges"], df)


FIRST_PROFILE = """
SELECT d.CustomerSK, CreditRiskScore, FraudRiskScore, MarketRiskScore, AggregateRiskScore, 0 AS PreviousAggregateRiskScore, CASE WHEN AggregateRiskScore > 0 THEN 'Increasing' ELSE 'Stable' END AS RiskTrend,
 CASE WHEN AggregateRiskScore >= 80 THEN 'Very High' WHEN AggregateRiskScore >= 60 THEN 'High' WHEN AggregateRiskScore >= 40 THEN 'Medium' ELSE 'Low' END AS RiskCategory
FROM agg a JOIN dim_customer d ON d.CustomerID = a.CustomerSK"""


def staged(t: Inputs):
    """The staged tables, each built once: a load reads them in a dozen places."""
    tables = {"Loan": t.stg_loan, "Fraud": t.stg_fraud, "Market": t.stg_market, "Macro": t.stg_macro}
    return {name: saved(df, f"staged-{name}") for name, df in tables.items()}


@query("e3_later_load")
def e3_later(t):
    """Rows of every table after a first load, after a second load of the same data a month later, and what the second load logged."""
    given = staged(t)
    first = stage_to_mart(given, AS_OF, COUNTRY)
    second = stage_to_mart(given, LATER, COUNTRY, existing=first)
    counts = [table_counts({k: v for k, v in out.items() if k.startswith(("Dim", "Fact"))}) for out in (first, second)]
    both = counts[0].withColumnRenamed("RowCount", "FirstLoad").join(counts[1].withColumnRenamed("RowCount", "SecondLoad"), "TableName", "full")
    log = second["etl_log"].select(F.col("StepName").alias("TableName"), F.col("RowsProcessed").alias("Logged"))
    return both.join(log, "TableName", "left")


@query("e3_stage_to_mart", ctes("SELECT CustomerSK, RiskTrend, RiskCategory, " + ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in SCORE_COLS) + " FROM profile",
                                *ADAPTERS_ALL, **BASE, scores=SCORES, agg=AGG, dim_customer=DIM_CUSTOMER, profile=FIRST_PROFILE))
def e3(t):
    """Scores at the end of a whole load into an empty mart."""
    out = stage_to_mart(staged(t), AS_OF, COUNTRY)["FactRiskProfile"].drop("DateID")
    return out.withColumns({c: F.col(c).cast("double") for c in SCORE_COLS})
