"""Repair (R family)."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskmart.operators import repair as R
from riskmart.queries.registry import Inputs, ctes, query
from riskmart.queries.validate import BAD_FRAUD, BAD_MACRO, LINE_COLS, SKEWED, bad_fraud, bad_macro, skewed

GAPS = """
SELECT RowKey, CASE WHEN RowKey % 9 = 0 THEN NULL ELSE CAST(LoanAmount AS DOUBLE) END AS LoanAmount,
 CASE WHEN RowKey % 8 = 0 THEN NULL ELSE CreditScore END AS CreditScore, CASE WHEN RowKey % 7 = 0 THEN NULL ELSE MaritalStatus END AS MaritalStatus,
 CASE WHEN RowKey % 6 = 0 THEN NULL ELSE JobTitle END AS JobTitle, CASE WHEN RowKey % 5 = 0 THEN NULL ELSE LoanID END AS LoanName,
 CASE WHEN RowKey % 10 = 0 THEN NULL ELSE LoanDate END AS LoanDate, CASE WHEN RowKey % 3 > 0 THEN NULL ELSE Age END AS MostlyMissing FROM stg_loan"""


def gaps(t: Inputs):
    """Loans with missing values in every kind of column."""
    n = F.col("RowKey")

    def without(every, c):
        return F.when(n % every != 0, c if not isinstance(c, str) else F.col(c))

    return t.stg_loan.select(
        "RowKey", without(9, F.col("LoanAmount").cast("double")).alias("LoanAmount"), without(8, "CreditScore").alias("CreditScore"),
        without(7, "MaritalStatus").alias("MaritalStatus"), without(6, "JobTitle").alias("JobTitle"), without(5, "LoanID").alias("LoanName"),
        without(10, "LoanDate").alias("LoanDate"), F.when(n % 3 == 0, F.col("Age")).alias("MostlyMissing"))


@query("r1_fill_missing", ctes("""
SELECT RowKey, ROUND(COALESCE(LoanAmount, (SELECT QUANTILE_CONT(LoanAmount, 0.5) FROM g)), 4) AS LoanAmount,
 COALESCE(CAST(CreditScore AS DOUBLE), (SELECT QUANTILE_CONT(CreditScore, 0.5) FROM g)) AS CreditScore, COALESCE(MaritalStatus, 'Unknown') AS MaritalStatus,
 COALESCE(JobTitle, (SELECT JobTitle FROM g WHERE JobTitle IS NOT NULL GROUP BY JobTitle ORDER BY COUNT(*) DESC, JobTitle LIMIT 1)) AS JobTitle,
 COALESCE(LoanName, 'Not Specified') AS LoanName,
 COALESCE(LoanDate, CAST((SELECT QUANTILE_CONT(CAST(LoanDate AS TIMESTAMP), 0.5) FROM g) AS DATE)) AS LoanDate, MostlyMissing FROM g""", "stg_loan", g=GAPS))
def r1(t):
    return R.fill_missing(gaps(t)).withColumn("LoanAmount", F.round("LoanAmount", 4))


CONSENSUS_COLS = ("NumDependents", "LoanDurationMonths")
SPOILED = "SELECT RowKey, CustomerID, CASE WHEN RowKey % 11 = 0 THEN 99 WHEN RowKey % 13 = 0 THEN NULL ELSE NumDependents END AS NumDependents, LoanDurationMonths FROM stg_loan"


def consensus_sql(c: str) -> str:
    return f"""SELECT CustomerID, v AS {c} FROM (SELECT CustomerID, {c} AS v, COUNT(*) AS n, ROW_NUMBER() OVER (PARTITION BY CustomerID ORDER BY COUNT(*) DESC, {c}) AS rn FROM s
 WHERE {c} IS NOT NULL GROUP BY CustomerID, {c}) JOIN (SELECT CustomerID, COUNT(*) AS size FROM s GROUP BY CustomerID) USING (CustomerID) WHERE rn = 1 AND size >= 3 AND n >= size - 2"""


@query("r2_consensus_by_group", ctes("""
SELECT s.RowKey, s.CustomerID, COALESCE(a.NumDependents, s.NumDependents) AS NumDependents, COALESCE(b.LoanDurationMonths, s.LoanDurationMonths) AS LoanDurationMonths
FROM s LEFT JOIN a ON a.CustomerID = s.CustomerID LEFT JOIN b ON b.CustomerID = s.CustomerID""", "stg_loan", s=SPOILED,
                                     a=consensus_sql("NumDependents"), b=consensus_sql("LoanDurationMonths")))
def r2(t):
    n = F.col("RowKey")
    spoiled = t.stg_loan.select(
        "RowKey", "CustomerID", F.when(n % 11 == 0, 99).when(n % 13 == 0, None).otherwise(F.col("NumDependents")).alias("NumDependents"), "LoanDurationMonths")
    return R.consensus_by_group(spoiled, "CustomerID", CONSENSUS_COLS)


def capped_sql(c: str, k: float) -> str:
    q1, q3 = f"(SELECT QUANTILE_CONT({c}, 0.25) FROM skewed)", f"(SELECT QUANTILE_CONT({c}, 0.75) FROM skewed)"
    return f"CAST(SUM(CAST(LEAST(GREATEST({c}, {q1} - {k} * ({q3} - {q1})), {q3} + {k} * ({q3} - {q1})) AS DECIMAL(18,4))) AS DOUBLE) AS {c}"


@query("r3_cap_outliers_iqr", ctes("SELECT " + ", ".join(capped_sql(c, 3) for c in LINE_COLS) + ", COUNT(*) AS rows FROM skewed", skewed=SKEWED))
def r3(t):
    out = R.cap_outliers_iqr(skewed(t), 3.0)
    return out.agg(*[F.sum(F.col(c).cast("decimal(18,4)")).cast("double").alias(c) for c in LINE_COLS], F.count("*").alias("rows"))


WILD = """SELECT RowKey, CASE WHEN RowKey % 10 = 0 THEN -Age ELSE Age END AS Age, CASE WHEN RowKey % 4 = 0 THEN -LoanAmount WHEN RowKey % 5 = 0 THEN LoanAmount * 1000 ELSE LoanAmount END AS LoanAmount,
 CASE WHEN RowKey % 6 = 0 THEN InterestRate * 10 ELSE InterestRate END AS InterestRate, CASE WHEN RowKey % 3 = 0 THEN 0 WHEN RowKey % 7 = 0 THEN -CreditScore ELSE CreditScore END AS CreditScore,
 CASE WHEN RowKey % 8 = 0 THEN -AnnualIncome WHEN RowKey % 9 = 0 THEN AnnualIncome * 10000 ELSE AnnualIncome END AS AnnualIncome,
 CASE WHEN RowKey % 50 = 0 THEN 150 WHEN RowKey % 11 = 0 THEN -3 ELSE NumLoans END AS NumLoans, CASE WHEN RowKey % 9 = 1 THEN -1.5 ELSE RowKey % 5 + 0.5 END AS AccountNumber FROM stg_loan"""


def wild(t):
    n = F.col("RowKey")
    c = F.col
    return t.stg_loan.select(
        "RowKey", F.when(n % 10 == 0, -c("Age")).otherwise(c("Age")).alias("Age"),
        F.when(n % 4 == 0, -c("LoanAmount")).when(n % 5 == 0, c("LoanAmount") * 1000).otherwise(c("LoanAmount")).cast("double").alias("LoanAmount"),
        F.when(n % 6 == 0, c("InterestRate") * 10).otherwise(c("InterestRate")).alias("InterestRate"),
        F.when(n % 3 == 0, 0).when(n % 7 == 0, -c("CreditScore")).otherwise(c("CreditScore")).alias("CreditScore"),
        F.when(n % 8 == 0, -c("AnnualIncome")).when(n % 9 == 0, c("AnnualIncome") * 10000).otherwise(c("AnnualIncome")).cast("double").alias("AnnualIncome"),
        F.when(n % 50 == 0, 150).when(n % 11 == 0, -3).otherwise(c("NumLoans")).alias("NumLoans"),
        F.when(n % 9 == 1, -1.5).otherwise(n % 5 + 0.5).alias("AccountNumber"))


@query("r4_fix_loan", ctes("""
SELECT RowKey, CAST(CASE WHEN Age < 0 THEN TRUNC((SELECT QUANTILE_CONT(Age, 0.5) FROM w)) WHEN Age > 100 THEN 100 WHEN Age > 0 AND Age < 18 THEN 18 ELSE Age END AS INT) AS Age,
 LEAST(ABS(CAST(LoanAmount AS DOUBLE)), 10000000) AS LoanAmount, LEAST(ABS(InterestRate), 100) AS InterestRate,
 CAST(CASE WHEN CreditScore = 0 THEN 0 ELSE LEAST(GREATEST(CreditScore, 300), 850) END AS INT) AS CreditScore, LEAST(ABS(CAST(AnnualIncome AS DOUBLE)), 100000000) AS AnnualIncome,
 CAST(CASE WHEN NumLoans > 100 THEN LEAST((SELECT QUANTILE_CONT(GREATEST(NumLoans, 0), 0.99) FROM w), 20) ELSE GREATEST(NumLoans, 0) END AS INT) AS NumLoans,
 CAST(CASE WHEN AccountNumber < 0 THEN 0 ELSE ROUND_EVEN(CAST(AccountNumber AS DOUBLE), 0) END AS DOUBLE) AS AccountNumber FROM w""", "stg_loan", w=WILD))
def r4(t):
    return R.fix_loan(wild(t))


@query("r5_fix_fraud", ctes("""
SELECT TransactionID, CASE WHEN IsUsedChip IN (0, 1) THEN IsUsedChip WHEN IsUsedChip >= 0.5 THEN 1 ELSE 0 END AS IsUsedChip, IsUsedPIN, IsFraudulent, IsOnlineTransaction,
 LEAST(ABS(DistanceFromHome), 20000) AS DistanceFromHome, LEAST(ABS(DistanceFromLastTransaction), 20000) AS DistanceFromLastTransaction,
 CAST(LEAST(TransactionDate, TIMESTAMP '2024-01-20 00:00:00') AS DATE) AS TransactionDate FROM f""", "stg_fraud", f=BAD_FRAUD))
def r5(t):
    out = R.fix_fraud(bad_fraud(t), "2024-01-20").withColumn("TransactionDate", F.to_date("TransactionDate"))
    return out.select("TransactionID", "IsUsedChip", "IsUsedPIN", "IsFraudulent", "IsOnlineTransaction", "DistanceFromHome", "DistanceFromLastTransaction", "TransactionDate")


MIXED_MARKET = """SELECT * REPLACE (CASE WHEN MarketName = 'click' THEN LowestValue ELSE HighestValue END AS HighestValue, CASE WHEN MarketName = 'click' THEN HighestValue ELSE LowestValue END AS LowestValue,
 CASE WHEN MarketName = 'view' THEN OpenValue * 20 ELSE OpenValue END AS OpenValue, CASE WHEN MarketName = 'error' THEN NULL ELSE CloseValue END AS CloseValue, InterestRate * 6 - 3 AS InterestRate) FROM stg_market"""
SWAPPED = """SELECT *, (CloseValue IS NOT NULL) AS complete, CASE WHEN CloseValue IS NOT NULL THEN GREATEST(HighestValue, LowestValue) ELSE HighestValue END AS h,
 CASE WHEN CloseValue IS NOT NULL THEN LEAST(HighestValue, LowestValue) ELSE LowestValue END AS l FROM m"""


def fence(c: str, k: str) -> str:
    a, b = f"(SELECT QUANTILE_CONT({c}, 0.25) FROM w)", f"(SELECT QUANTILE_CONT({c}, 0.75) FROM w)"
    return f"CASE WHEN {c} IS NOT NULL THEN LEAST(GREATEST({c}, GREATEST(0, {a} - {k} * ({b} - {a}))), {b} + {k} * ({b} - {a})) END"


FENCED = f"SELECT MarketDate, MarketName, complete, InterestRate, {fence('h', '1.0')} AS h, {fence('l', '1.5')} AS l, {fence('OpenValue', '1.5')} AS o, {fence('CloseValue', '1.5')} AS c FROM w"


def mixed_market(t):
    name, c = F.col("MarketName"), F.col
    return t.stg_market.withColumns({
        "HighestValue": F.when(name == "click", c("LowestValue")).otherwise(c("HighestValue")),
        "LowestValue": F.when(name == "click", c("HighestValue")).otherwise(c("LowestValue")),
        "OpenValue": F.when(name == "view", c("OpenValue") * 20).otherwise(c("OpenValue")),
        "CloseValue": F.when(name != "error", c("CloseValue")),
        "InterestRate": c("InterestRate") * 6 - 3,
    })


@query("r6_fix_market", ctes("""
SELECT LEAST(MarketDate, DATE '2024-01-25') AS MarketDate, MarketName, ROUND(ABS(h), 6) AS HighestValue, ROUND(ABS(l), 6) AS LowestValue,
 ROUND(ABS(CASE WHEN complete THEN GREATEST(LEAST(o, h), l) ELSE o END), 6) AS OpenValue, ROUND(ABS(CASE WHEN complete THEN GREATEST(LEAST(c, h), l) ELSE c END), 6) AS CloseValue,
 LEAST(GREATEST(InterestRate, 0), 30) AS InterestRate FROM x""", "stg_market", m=MIXED_MARKET, w=SWAPPED, x=FENCED))
def r6(t):
    out = R.fix_market(mixed_market(t), "2024-01-25")
    return out.select("MarketDate", "MarketName", *[F.round(c, 6).alias(c) for c in ("HighestValue", "LowestValue", "OpenValue", "CloseValue")], "InterestRate")


@query("r7_fix_macro", ctes("""
SELECT LEAST(ReportDate, DATE '2024-01-25') AS ReportDate, CountryName, LEAST(ABS(UnemploymentRate), 50) AS UnemploymentRate, ABS(GDP) AS GDP, LEAST(ABS(DebtRatio), 200) AS DebtRatio,
 LEAST(ABS(DeficitRatio), 200) AS DeficitRatio, InflationRate, ABS(ConsumerPriceIndex) AS ConsumerPriceIndex FROM m""", "stg_macro", m=BAD_MACRO))
def r7(t):
    return R.fix_macro(bad_macro(t), "2024-01-25")


@query("r8_fix_payment", ctes("""
SELECT LoanID, ROUND(CASE WHEN p > e * 2 OR p * 2 < e THEN e ELSE p END, 6) AS MonthlyPayment
FROM (SELECT LoanID, CAST(MonthlyPayment AS DOUBLE) AS p, CAST(LoanAmount AS DOUBLE) / LoanDurationMonths AS e FROM stg_loan)""", "stg_loan"))
def r8(t):
    loans = t.stg_loan.withColumn("MonthlyPayment", F.col("MonthlyPayment").cast("double"))
    return R.fix_payment(loans).select("LoanID", F.round("MonthlyPayment", 6).alias("MonthlyPayment"))


@query("r9_fix_utilization", ctes("""
SELECT LoanID, ROUND(LEAST(ABS(CASE WHEN ABS(u - e) > 10 THEN e ELSE u END), 100), 6) AS CreditUtilizationRatio
FROM (SELECT LoanID, CreditUtilizationRatio * 100 - 5 AS u, CAST(Balance AS DOUBLE) / NULLIF(CAST(LoanAmount AS DOUBLE) / 2 - 5000, 0) * 100 AS e FROM stg_loan)""", "stg_loan"))
def r9(t):
    loans = t.stg_loan.withColumns({
        "CreditUtilizationRatio": F.col("CreditUtilizationRatio") * 100 - 5, "CreditLimit": F.col("LoanAmount").cast("double") / 2 - 5000})
    return R.fix_utilization(loans).select("LoanID", F.round("CreditUtilizationRatio", 6).alias("CreditUtilizationRatio"))


@query("r10_fix_vix_ted", ctes("""
SELECT MarketDate, MarketName, ROUND(VIX, 6) AS VIX, ROUND(CASE WHEN TEDSpread > 2 AND VIX < 20 THEN 0.5 + VIX * 0.025 ELSE TEDSpread END, 6) AS TEDSpread
FROM (SELECT MarketDate, MarketName, TEDSpread, CASE WHEN VIX > 50 AND TEDSpread < 0.5 THEN 30 + TEDSpread * 40 ELSE VIX END AS VIX FROM stg_market)""", "stg_market"))
def r10(t):
    return R.fix_vix_ted(t.stg_market).select("MarketDate", "MarketName", F.round("VIX", 6).alias("VIX"), F.round("TEDSpread", 6).alias("TEDSpread"))


@query("r11_fix_online_flags", ctes("""
SELECT TransactionID, IsOnlineTransaction, CASE WHEN IsOnlineTransaction = 1 THEN 0 ELSE IsUsedChip END AS IsUsedChip, CASE WHEN IsOnlineTransaction = 1 THEN 0 ELSE IsUsedPIN END AS IsUsedPIN FROM stg_fraud""",
                                    "stg_fraud"))
def r11(t):
    return R.fix_online_flags(t.stg_fraud).select("TransactionID", "IsOnlineTransaction", "IsUsedChip", "IsUsedPIN")


@query("r12_cap_zscore", """
SELECT o_orderkey, ROUND(LEAST(GREATEST(o_totalprice, m - 1.5 * s), m + 1.5 * s), 4) AS o_totalprice
FROM orders CROSS JOIN (SELECT AVG(o_totalprice) AS m, STDDEV_SAMP(o_totalprice) AS s FROM orders)""")
def r12(t):
    return R.cap_zscore(t.orders.select("o_orderkey", "o_totalprice"), "o_totalprice", 1.5).withColumn("o_totalprice", F.round("o_totalprice", 4))


@query("r13_repair_report", ctes("""
SELECT * FROM (SELECT 'IsUsedChip' AS column_name, SUM((IsOnlineTransaction = 1 AND IsUsedChip <> 0)::INT)::BIGINT AS rows_changed FROM stg_fraud
UNION ALL SELECT 'IsUsedPIN', SUM((IsOnlineTransaction = 1 AND IsUsedPIN <> 0)::INT)::BIGINT FROM stg_fraud) WHERE rows_changed > 0""", "stg_fraud"))
def r13(t):
    return R.repair_report(t.stg_fraud, R.fix_online_flags(t.stg_fraud), ["TransactionID"])
