"""Scores and measures (C and S families)."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskmart.adapters import AS_OF, AS_OF_ID
from riskmart.functions.expr import date_id
from riskmart.plans import measures as M
from riskmart.plans import scoring as S
from riskmart.queries.registry import Inputs, ctes, query
from riskmart.sources.colocated import save_colocated

COUNTRY = "NATION_1"


def loans_of(t: Inputs):
    return t.stg_loan.withColumnRenamed("CustomerID", "CustomerSK")


def customers_of(t: Inputs):
    """Daily snapshot of the staged loans, customer id used as key."""
    return loans_of(t).groupBy("CustomerSK", date_id("LoanDate").alias("DateSK")).agg(
        F.avg("DebtToIncomeRatio").alias("DebtToIncomeRatio"))


def fraud_of(t: Inputs):
    return t.stg_fraud.withColumnRenamed("CustomerID", "CustomerSK")


def market_of(t: Inputs):
    return M.market_measures(t.stg_market)


def double(df, *cols, digits: int = 6):
    return df.withColumns({c: F.round(F.col(c).cast("double"), digits) for c in cols})


# --- C: measures -------------------------------------------------------------------------------------------------

CUSTOMER_SNAPSHOT = """
SELECT CustomerID AS CustomerSK, CAST(EXTRACT(YEAR FROM LoanDate) * 10000 + EXTRACT(MONTH FROM LoanDate) * 100 + EXTRACT(DAY FROM LoanDate) AS INT) AS DateSK,
 AVG(DebtToIncomeRatio) AS DebtToIncomeRatio
FROM stg_loan GROUP BY 1, 2"""


@query("c1_customer_measures", ctes("""
SELECT LoanID, CAST(TotalAssets - TotalLiabilities AS DOUBLE) AS NetWorth,
 ROUND(CAST(MonthlySavings AS DOUBLE) * 12 / NULLIF(CAST(AnnualIncome AS DOUBLE), 0), 6) AS SavingsRatio,
 ROUND(CAST(TotalAssets AS DOUBLE) / NULLIF(CAST(TotalLiabilities AS DOUBLE), 0), 6) AS LiquidityRatio,
 CAST(CASE WHEN DebtToIncomeRatio > 0.43 THEN 100 WHEN DebtToIncomeRatio > 0.36 THEN 80
  WHEN DebtToIncomeRatio > 0.28 THEN 60 WHEN DebtToIncomeRatio > 0.20 THEN 40 ELSE 20 END AS INT) AS FinancialStressIndex
FROM stg_loan""", "stg_loan"))
def c1(t):
    df = M.customer_measures(t.stg_loan).select("LoanID", "NetWorth", "SavingsRatio", "LiquidityRatio", "FinancialStressIndex")
    return double(df, "NetWorth", "SavingsRatio", "LiquidityRatio")


@query("c2_loan_measures", ctes("""
SELECT LoanID, ROUND(CAST(LoanAmount AS DOUBLE) * (POWER(1 + InterestRate / 1200, LoanDurationMonths) - 1), 4) AS TotalInterestAmount,
 ROUND(1 - CAST(Balance AS DOUBLE) / NULLIF(CAST(LoanAmount AS DOUBLE), 0), 6) AS PaymentProgress,
 ROUND(CAST(Balance AS DOUBLE) * CAST(CASE PaymentStatus WHEN 'Late' THEN 1.2 WHEN 'Defaulted' THEN 1.5 ELSE 1.0 END AS DOUBLE), 4) AS RiskWeightedBalance,
 CAST(CEIL(CAST(Balance AS DOUBLE) / NULLIF(CAST(MonthlyPayment AS DOUBLE), 0)) AS BIGINT) AS MonthsRemaining
FROM stg_loan""", "stg_loan"))
def c2(t):
    df = M.loan_measures(t.stg_loan).select(
        "LoanID", "TotalInterestAmount", "PaymentProgress", "RiskWeightedBalance", "MonthsRemaining")
    return double(double(df, "TotalInterestAmount", "RiskWeightedBalance", digits=4), "PaymentProgress")


MARKET_MEASURES = """
SELECT *, CASE WHEN OpenValue > 0 THEN (CloseValue - OpenValue) / OpenValue * 100 ELSE 0 END AS DailyChangePercent,
 HighestValue - LowestValue AS PriceRange,
 CASE WHEN OpenValue > 0 THEN (HighestValue - LowestValue) / OpenValue ELSE 0 END AS VolatilityRatio
FROM stg_market"""


@query("c3_market_measures", ctes("""
SELECT MarketDate, MarketName, ROUND(DailyChangePercent, 6) AS DailyChangePercent, ROUND(PriceRange, 6) AS PriceRange,
 ROUND(VolatilityRatio, 6) AS VolatilityRatio FROM m""", "stg_market", m=MARKET_MEASURES))
def c3(t):
    df = market_of(t).select("MarketDate", "MarketName", "DailyChangePercent", "PriceRange", "VolatilityRatio")
    return double(df, "DailyChangePercent", "PriceRange", "VolatilityRatio")


# --- S: scores ---------------------------------------------------------------------------------------------------

SNAP_AS_OF = f"""
SELECT CustomerSK, DateSK, DebtToIncomeRatio FROM (
 SELECT *, ROW_NUMBER() OVER (PARTITION BY CustomerSK ORDER BY DateSK DESC) AS rn FROM fact_customer WHERE DateSK <= {AS_OF_ID}) WHERE rn = 1"""


def credit_sql(snap: str) -> str:
    return f"""
SELECT c.CustomerSK, CAST(COALESCE(MAX(CAST(
  (100 - l.CreditScore * 0.1) * 0.30
  + CASE WHEN s.DebtToIncomeRatio > 0.43 THEN 100 WHEN s.DebtToIncomeRatio > 0.36 THEN 80 WHEN s.DebtToIncomeRatio > 0.28 THEN 50 ELSE 20 END * 0.25
  + CASE WHEN h.defaulted > 0 THEN 100 WHEN h.late > 3 THEN 90 WHEN h.late > 0 THEN 70 ELSE 10 END * 0.30
  + CASE WHEN l.CreditUtilizationRatio > 0.9 THEN 100 WHEN l.CreditUtilizationRatio > 0.7 THEN 80 WHEN l.CreditUtilizationRatio > 0.5 THEN 50
     WHEN l.CreditUtilizationRatio > 0.3 THEN 30 ELSE 10 END * 0.15 AS DECIMAL(5,2))), 50) AS DECIMAL(5,2)) AS CreditRiskScore
FROM (SELECT DISTINCT CustomerSK FROM fact_customer WHERE DateSK <= {AS_OF_ID}) c
LEFT JOIN {snap} s ON s.CustomerSK = c.CustomerSK
LEFT JOIN stg_loan l ON l.CustomerID = s.CustomerSK
LEFT JOIN (SELECT CustomerID, SUM(CASE WHEN PaymentStatus = 'Defaulted' THEN 1 ELSE 0 END) AS defaulted,
  SUM(CASE WHEN PaymentStatus = 'Late' THEN 1 ELSE 0 END) AS late FROM stg_loan GROUP BY CustomerID) h ON h.CustomerID = c.CustomerSK
GROUP BY c.CustomerSK"""


CREDIT_AS_OF = credit_sql("snap")
CREDIT_EXACT = credit_sql(f"(SELECT * FROM fact_customer WHERE DateSK = {AS_OF_ID})")

FRAUD_SCORE = f"""
SELECT CustomerID AS CustomerSK, CAST(
  CASE WHEN COUNT(DISTINCT CASE WHEN IsFraudulent = 1 THEN TransactionID END) > 3 THEN 100
       WHEN COUNT(DISTINCT CASE WHEN IsFraudulent = 1 THEN TransactionID END) > 0 THEN 80 ELSE 20 END * 0.40
  + CASE WHEN AVG(DistanceFromHome) > 1000 THEN 80 WHEN AVG(DistanceFromHome) > 500 THEN 60 WHEN AVG(DistanceFromHome) > 100 THEN 30 ELSE 10 END * 0.20
  + CASE WHEN AVG(RatioToMedianTransactionAmount) > 5 THEN 80 WHEN AVG(RatioToMedianTransactionAmount) > 3 THEN 60
      WHEN AVG(RatioToMedianTransactionAmount) > 2 THEN 40 ELSE 20 END * 0.25
  + CASE WHEN MIN(IsUsedChip + IsUsedPIN) = 0 THEN 80 WHEN AVG(IsUsedChip + IsUsedPIN) < 1 THEN 50 ELSE 15 END * 0.15 AS DECIMAL(5,2)) AS FraudRiskScore
FROM stg_fraud
WHERE CAST(TransactionDate AS DATE) BETWEEN DATE '{AS_OF}' - 90 AND DATE '{AS_OF}'
GROUP BY CustomerID"""

MARKET_SCORE = f"""
SELECT h.CustomerSK, CAST(
  CASE WHEN v > 0.05 THEN 100 WHEN v > 0.03 THEN 80 WHEN v > 0.02 THEN 60 WHEN v > 0.01 THEN 40 ELSE 20 END * 0.30
  + CASE WHEN r > 8 THEN 90 WHEN r > 6 THEN 70 WHEN r > 4 THEN 50 WHEN r > 2 THEN 30 ELSE 20 END * 0.25
  + CASE WHEN u > 8 THEN 90 WHEN u > 6 THEN 70 WHEN u > 4 THEN 40 ELSE 20 END * 0.25
  + CASE WHEN c > 3 THEN 100 WHEN c > 2 THEN 80 WHEN c > 1 THEN 60 WHEN c > 0.5 THEN 40 ELSE 20 END * 0.20 AS DECIMAL(5,2)) AS MarketRiskScore
FROM (SELECT DISTINCT CustomerID AS CustomerSK FROM stg_loan) h
CROSS JOIN (SELECT AVG(VolatilityRatio) AS v, AVG(m.InterestRate) AS r, AVG(ABS(DailyChangePercent)) AS c, AVG(e.UnemploymentRate) AS u
  FROM market m JOIN stg_macro e ON e.ReportDate = m.MarketDate AND e.CountryName = '{COUNTRY}'
  WHERE m.MarketDate BETWEEN DATE '{AS_OF}' - 30 AND DATE '{AS_OF}') x"""

ADAPTERS_ALL = ("stg_loan", "stg_fraud", "stg_market", "stg_macro")
BASE = dict(fact_customer=CUSTOMER_SNAPSHOT, snap=SNAP_AS_OF, market=MARKET_MEASURES, credit=CREDIT_AS_OF, fraud=FRAUD_SCORE, mkt=MARKET_SCORE)

SCORES = """
SELECT c.CustomerSK, c.CreditRiskScore, COALESCE(f.FraudRiskScore, 25) AS FraudRiskScore, COALESCE(m.MarketRiskScore, 50) AS MarketRiskScore
FROM credit c LEFT JOIN fraud f ON f.CustomerSK = c.CustomerSK LEFT JOIN mkt m ON m.CustomerSK = c.CustomerSK"""
AGG = """
SELECT *, CAST(CreditRiskScore * 0.60 + FraudRiskScore * 0.15 + MarketRiskScore * 0.25 AS DECIMAL(5,2)) AS AggregateRiskScore FROM scores"""


@query("s1_credit_score", ctes("SELECT CustomerSK, CAST(CreditRiskScore AS DOUBLE) AS CreditRiskScore FROM credit",
                               "stg_loan", fact_customer=CUSTOMER_SNAPSHOT, snap=SNAP_AS_OF, credit=CREDIT_AS_OF))
def s1(t):
    snap = customers_of(t).filter(F.col("DateSK") <= AS_OF_ID)
    return double(S.credit_score(loans_of(t), snap, loans_of(t), AS_OF_ID, exact_date=False), "CreditRiskScore")


@query("s1_credit_score_exact", ctes("SELECT CustomerSK, CAST(CreditRiskScore AS DOUBLE) AS CreditRiskScore FROM credit",
                                     "stg_loan", fact_customer=CUSTOMER_SNAPSHOT, credit=CREDIT_EXACT))
def s1_exact(t):
    snap = customers_of(t).filter(F.col("DateSK") <= AS_OF_ID)
    return double(S.credit_score(loans_of(t), snap, loans_of(t), AS_OF_ID), "CreditRiskScore")


@query("s2_fraud_score", ctes("SELECT CustomerSK, CAST(FraudRiskScore AS DOUBLE) AS FraudRiskScore FROM f",
                              "stg_fraud", f=FRAUD_SCORE))
def s2(t):
    return double(S.fraud_score(fraud_of(t), AS_OF), "FraudRiskScore")


@query("s3_market_score", ctes("SELECT CustomerSK, CAST(MarketRiskScore AS DOUBLE) AS MarketRiskScore FROM mkt",
                               "stg_loan", "stg_market", "stg_macro", market=MARKET_MEASURES, mkt=MARKET_SCORE))
def s3(t):
    return double(S.market_score(market_of(t), t.stg_macro, loans_of(t), AS_OF, COUNTRY), "MarketRiskScore")


def profile_of(t: Inputs, **kw):
    return S.risk_profile(customers_of(t), loans_of(t), loans_of(t), fraud_of(t), market_of(t), t.stg_macro, AS_OF, COUNTRY,
                          exact_date=False, **kw)


@query("s4_aggregate_score", ctes(
    "SELECT CustomerSK, CAST(AggregateRiskScore AS DOUBLE) AS AggregateRiskScore FROM agg",
    *ADAPTERS_ALL, **BASE, scores=SCORES, agg=AGG))
def s4(t):
    return double(profile_of(t).select("CustomerSK", "AggregateRiskScore"), "AggregateRiskScore")


@query("s5_latest_snapshot", ctes(
    "SELECT CustomerSK, DateSK, ROUND(DebtToIncomeRatio, 6) AS DebtToIncomeRatio FROM snap",
    "stg_loan", fact_customer=CUSTOMER_SNAPSHOT, snap=SNAP_AS_OF))
def s5(t):
    return double(S.latest_snapshot(customers_of(t), "CustomerSK", "DateSK", AS_OF_ID), "DebtToIncomeRatio")


PROFILE_HISTORY = """
SELECT CustomerID AS CustomerSK, CAST(EXTRACT(YEAR FROM LoanDate) * 10000 + EXTRACT(MONTH FROM LoanDate) * 100 + EXTRACT(DAY FROM LoanDate) AS INT) AS DateID,
 CAST(MAX(RowKey % 9000) / CAST(100 AS DOUBLE) AS DECIMAL(5,2)) AS AggregateRiskScore FROM stg_loan WHERE HomeOwnershipStatus <> 'Rent' GROUP BY 1, 2"""


def history_of(t: Inputs):
    """Earlier profile rows: a score per customer and loan day; customers who rent have none."""
    day = date_id("LoanDate").alias("DateID")
    worst = (F.max(F.col("RowKey") % 9000) / F.lit(100.0)).cast("decimal(5,2)").alias("AggregateRiskScore")
    return loans_of(t).filter("HomeOwnershipStatus <> 'Rent'").groupBy("CustomerSK", day).agg(worst)


PREVIOUS = f"""
SELECT CustomerSK, AggregateRiskScore AS PreviousAggregateRiskScore FROM (
 SELECT *, ROW_NUMBER() OVER (PARTITION BY CustomerSK ORDER BY DateID DESC) AS rn FROM hist WHERE DateID < {AS_OF_ID}) WHERE rn = 1"""


@query("s6_previous_score", ctes(
    "SELECT CustomerSK, CAST(PreviousAggregateRiskScore AS DOUBLE) AS PreviousAggregateRiskScore FROM prev",
    "stg_loan", hist=PROFILE_HISTORY, prev=PREVIOUS))
def s6(t):
    return double(S.previous_score(history_of(t), AS_OF_ID), "PreviousAggregateRiskScore")


PROFILE = f"""
SELECT a.CustomerSK, CAST({AS_OF_ID} AS INT) AS DateID, CreditRiskScore, FraudRiskScore, MarketRiskScore, AggregateRiskScore,
 COALESCE(p.PreviousAggregateRiskScore, 0) AS PreviousAggregateRiskScore,
 CASE WHEN AggregateRiskScore > COALESCE(p.PreviousAggregateRiskScore, 0) * 1.1 THEN 'Increasing'
  WHEN AggregateRiskScore < COALESCE(p.PreviousAggregateRiskScore, 0) * 0.9 THEN 'Decreasing' ELSE 'Stable' END AS RiskTrend,
 CASE WHEN AggregateRiskScore >= 80 THEN 'Very High' WHEN AggregateRiskScore >= 60 THEN 'High' WHEN AggregateRiskScore >= 40 THEN 'Medium' ELSE 'Low' END AS RiskCategory
FROM agg a LEFT JOIN prev p ON p.CustomerSK = a.CustomerSK"""
SCORE_COLS = ("CreditRiskScore", "FraudRiskScore", "MarketRiskScore", "AggregateRiskScore", "PreviousAggregateRiskScore")
PROFILE_OUT = "SELECT CustomerSK, DateID, " + ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in SCORE_COLS) + ", RiskTrend, RiskCategory FROM profile"
PROFILE_CTES = dict(BASE, scores=SCORES, agg=AGG, hist=PROFILE_HISTORY, prev=PREVIOUS, profile=PROFILE)


@query("s7_risk_profile", ctes(PROFILE_OUT, *ADAPTERS_ALL, **PROFILE_CTES))
def s7(t):
    return double(profile_of(t, profile=history_of(t)), *SCORE_COLS)


@query("s7_colocated_facts", ctes(PROFILE_OUT, *ADAPTERS_ALL, **PROFILE_CTES))
def s7_colocated(t):
    """The same profile over facts saved in buckets of the customer."""
    facts = {"customers": customers_of(t), "loans": loans_of(t), "fraud": fraud_of(t), "profile": history_of(t)}
    kept = save_colocated(facts, "CustomerSK")
    return double(kept.each(lambda f: S.risk_profile(f["customers"], f["loans"], f["loans"], f["fraud"], market_of(t), t.stg_macro, AS_OF, COUNTRY,
                                                     profile=f["profile"], exact_date=False)), *SCORE_COLS)


@query("s7_risk_profile_upsert", ctes("""
SELECT CustomerSK, DateID, CAST(AggregateRiskScore AS DOUBLE) AS AggregateRiskScore, RiskCategory FROM profile
UNION ALL SELECT CustomerSK, DateID, CAST(AggregateRiskScore AS DOUBLE), NULL FROM hist h
WHERE NOT EXISTS (SELECT 1 FROM profile p WHERE p.CustomerSK = h.CustomerSK AND p.DateID = h.DateID)""",
                                      *ADAPTERS_ALL, **PROFILE_CTES))
def s7_upsert(t):
    stored = history_of(t)
    rows = profile_of(t, profile=stored)
    target = stored.withColumn("RiskCategory", F.lit(None).cast("string"))
    out = S.update_risk_profile(target, rows.select(*target.columns))
    return double(out.select("CustomerSK", "DateID", "AggregateRiskScore", "RiskCategory"), "AggregateRiskScore")


@query("c4_risk_change", ctes("""
SELECT CustomerSK, CAST(AggregateRiskScore - PreviousAggregateRiskScore AS DOUBLE) AS RiskChangeAmount,
 ROUND(CASE WHEN PreviousAggregateRiskScore = 0 THEN 0 ELSE (CAST(AggregateRiskScore AS DOUBLE) - CAST(PreviousAggregateRiskScore AS DOUBLE))
  / CAST(PreviousAggregateRiskScore AS DOUBLE) * 100 END, 6) AS RiskChangePercent FROM profile""", *ADAPTERS_ALL, **PROFILE_CTES))
def c4(t):
    df = M.risk_change(profile_of(t, profile=history_of(t)))
    return double(df.select("CustomerSK", "RiskChangeAmount", "RiskChangePercent"), "RiskChangeAmount", "RiskChangePercent")
