"""Report tables (W family)."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskmart.adapters import AS_OF
from riskmart.plans import ifrs9 as I
from riskmart.plans import marts, measures
from riskmart.plans import reports as R
from riskmart.queries.ifrs9 import ACCOUNTS_SQL, BASIC, BEFORE, CLASSIFIED, HISTORY, RUNS, accounts, loans_now, loss, two_runs
from riskmart.queries.keys import dates, dim_customer
from riskmart.queries.marts import FACT_CUSTOMER, FACT_LOAN, STAR, as_double, loan_types
from riskmart.queries.registry import Inputs, ctes, query


def rounded(df, *cols, digits=4):
    return df.withColumns({c: F.round(F.col(c).cast("double"), digits) for c in cols})


def fact_customer(t: Inputs, cust):
    return marts.fact_customer(t.stg_loan, cust, dates(t))


# --- risk ----------------------------------------------------------------------------------------------------------

@query("w1_customer_risk", ctes("""
SELECT c.CustomerSK, c.CustomerID, c.Age, c.EmploymentStatus, c.JobTitle, c.HomeOwnershipStatus, c.MaritalStatus, c.PreviousLoanDefault, f.i AS AnnualIncome, f.a AS TotalAssets, f.l AS TotalLiabilities,
 ROUND(f.l / NULLIF(f.a, 0), 4) AS LeverageRatio, ROUND(f.l / NULLIF(f.i, 0), 4) AS DebtToIncomeRatio, COALESCE(l.n, 0) AS ActiveLoansCount, l.amount AS TotalLoanAmount, l.balance AS TotalOutstandingBalance,
 COALESCE(l.late, 0) AS LatePaymentsCount, l.delays AS TotalDelayedPayments
FROM dim_customer c
LEFT JOIN (SELECT CustomerID, SUM(CAST(income AS DECIMAL(18,2)))::DOUBLE AS i, SUM(assets)::DOUBLE AS a, SUM(liabilities)::DOUBLE AS l FROM (
  SELECT CustomerID, LoanDate, MAX(AnnualIncome) AS income, SUM(TotalAssets) AS assets, SUM(TotalLiabilities) AS liabilities FROM stg_loan GROUP BY 1, 2) GROUP BY CustomerID) f ON f.CustomerID = c.CustomerID
LEFT JOIN (SELECT CustomerSK, COUNT(*) AS n, SUM(LoanAmount)::DOUBLE AS amount, SUM(Balance)::DOUBLE AS balance, SUM((PaymentStatus = 'Late')::INT)::BIGINT AS late, SUM(DelayedPayments)::BIGINT AS delays FROM fact_loan GROUP BY 1) l
 ON l.CustomerSK = c.CustomerSK WHERE c.IsCurrent = 1""", "stg_loan", **STAR, fact_loan=FACT_LOAN))
def w1(t):
    cust = dim_customer(t)
    facts = marts.fact_loan(t.stg_loan, cust, loan_types(t), dates(t))
    out = R.customer_risk(cust, fact_customer(t, cust), facts)
    return rounded(as_double(out, "AnnualIncome", "TotalAssets", "TotalLiabilities", "TotalLoanAmount", "TotalOutstandingBalance"), "LeverageRatio", "DebtToIncomeRatio")


@query("w2_loan_performance", ctes("""
SELECT l.LoanID, d.Year AS LoanYear, d.Quarter AS LoanQuarter, d.MonthNumber AS LoanMonth, lt.LoanType, CAST(l.LoanAmount AS DOUBLE) AS LoanAmount, l.InterestRate, l.LoanDurationMonths, CAST(l.Balance AS DOUBLE) AS Balance,
 l.DelayedPayments, l.PaymentStatus, c.CustomerID, c.EmploymentStatus, c.HomeOwnershipStatus, f.AnnualIncome, f.DebtToIncomeRatio,
 CASE WHEN l.PaymentStatus = 'On Time' THEN 'Good Standing' WHEN l.PaymentStatus = 'Late' AND l.DelayedPayments <= 3 THEN 'Moderate Risk' WHEN l.PaymentStatus = 'Late' THEN 'High Risk'
  WHEN l.PaymentStatus = 'Defaulted' THEN 'Default' ELSE 'Other' END AS RiskCategory
FROM fact_loan l JOIN dates d ON d.DateID = l.LoanDateID JOIN loan_types lt ON lt.LoanTypeID = l.LoanTypeID JOIN dim_customer c ON c.CustomerSK = l.CustomerSK
LEFT JOIN fact_customer f ON f.CustomerSK = l.CustomerSK AND f.DateSK = l.LoanDateID""", "stg_loan", **STAR, fact_loan=FACT_LOAN, fact_customer=FACT_CUSTOMER))
def w2(t):
    cust, types, days = dim_customer(t), loan_types(t), dates(t)
    out = R.loan_performance(marts.fact_loan(t.stg_loan, cust, types, days), days, types, cust, fact_customer(t, cust))
    return rounded(as_double(out, "LoanAmount", "Balance", "AnnualIncome"), "DebtToIncomeRatio", digits=6)


FRAUD_CASES = """
SELECT f.TransactionID AS FraudID, CAST(EXTRACT(YEAR FROM f.TransactionDate) * 10000 + EXTRACT(MONTH FROM f.TransactionDate) * 100 + EXTRACT(DAY FROM f.TransactionDate) AS INT) AS DetectionDateID,
 CAST(f.CustomerID AS BIGINT) AS CustomerID, CASE WHEN f.IsFraudulent = 1 OR f.IsUsedPIN = 1 THEN CONCAT('L-', CAST(f.TransactionID AS VARCHAR(20))) END AS LoanID, f.TransactionTypeName AS FraudType,
 f.RatioToMedianTransactionAmount * 100 AS FraudAmount, f.RatioToMedianTransactionAmount * 25 AS RecoveredAmount FROM {stg_fraud} f"""
FRAUD_CASES_SQL = FRAUD_CASES.format(stg_fraud="stg_fraud")


def fraud_cases(t):
    return t.spark.sql(FRAUD_CASES, stg_fraud=t.stg_fraud)


@query("w3_fraud_analysis", ctes("""
SELECT f.FraudID, d.FullDate AS DetectionDate, d.Year AS DetectionYear, d.Quarter AS DetectionQuarter, d.MonthNumber AS DetectionMonth, f.FraudType, ROUND(f.FraudAmount, 4) AS FraudAmount,
 ROUND(f.RecoveredAmount, 4) AS RecoveredAmount, ROUND(f.FraudAmount - f.RecoveredAmount, 4) AS LossAmount, c.CustomerID, c.Age, c.EmploymentStatus, c.HomeOwnershipStatus,
 CAST(l.LoanAmount AS DOUBLE) AS LoanAmount, l.LoanDurationMonths, l.InterestRate, lt.LoanType
FROM cases f JOIN dates d ON d.DateID = f.DetectionDateID JOIN dim_customer c ON c.CustomerID = f.CustomerID LEFT JOIN fact_loan l ON l.LoanID = f.LoanID LEFT JOIN loan_types lt ON lt.LoanTypeID = l.LoanTypeID""",
                                 "stg_loan", "stg_fraud", **STAR, fact_loan=FACT_LOAN, cases=FRAUD_CASES_SQL))
def w3(t):
    cust, types, days = dim_customer(t), loan_types(t), dates(t)
    cases = fraud_cases(t).join(cust.select("CustomerID", "CustomerSK"), "CustomerID").drop("CustomerID")
    out = R.fraud_analysis(cases, days, cust, marts.fact_loan(t.stg_loan, cust, types, days), types)
    return rounded(as_double(out, "LoanAmount"), "FraudAmount", "RecoveredAmount", "LossAmount")


REGION = "CASE MarketName WHEN 'click' THEN 'North America' WHEN 'view' THEN 'Europe' WHEN 'purchase' THEN 'Asia' ELSE 'Other' END"
COUNTRY = "CASE CountryName WHEN 'NATION_1' THEN 'USA' WHEN 'NATION_2' THEN 'EU' WHEN 'NATION_3' THEN 'China' WHEN 'NATION_4' THEN 'Global' ELSE CountryName END"
DAY_ID = "CAST(EXTRACT(YEAR FROM {0}) * 10000 + EXTRACT(MONTH FROM {0}) * 100 + EXTRACT(DAY FROM {0}) AS INT)"


def economy(t):
    return t.stg_macro.select(F.expr(DAY_ID.format("ReportDate")).alias("DateID"), F.expr(COUNTRY).alias("Country"), "UnemploymentRate", "InflationRate", "DeficitRatio")


@query("w4_market_analysis", ctes(f"""
SELECT m.MarketDate, CAST(EXTRACT(YEAR FROM m.MarketDate) AS INT) AS Year, CAST(EXTRACT(QUARTER FROM m.MarketDate) AS INT) AS Quarter, CAST(EXTRACT(MONTH FROM m.MarketDate) AS INT) AS Month, m.Region, m.MarketName, m.Volume,
 ROUND(m.DailyChangePercent, 4) AS DailyChangePercent, e.UnemploymentRate, e.InflationRate, e.DeficitRatio
FROM (SELECT MarketDate, MarketName, Volume, CASE WHEN OpenValue > 0 THEN (CloseValue - OpenValue) / OpenValue * 100 ELSE 0 END AS DailyChangePercent, {REGION} AS Region FROM stg_market) m
LEFT JOIN (SELECT *, {COUNTRY} AS Country FROM stg_macro) e ON e.ReportDate = m.MarketDate
 AND e.Country = CASE m.Region WHEN 'North America' THEN 'USA' WHEN 'Europe' THEN 'EU' WHEN 'Asia' THEN 'China' ELSE 'Global' END""", "stg_market", "stg_macro"))
def w4(t):
    market = measures.market_measures(t.stg_market).select(
        F.expr(DAY_ID.format("MarketDate")).alias("DateID"), F.expr(REGION).alias("Region"), "MarketName", "Volume", "DailyChangePercent")
    return rounded(R.market_analysis(market, dates(t), economy(t)), "DailyChangePercent")


@query("w5_risk_dashboard", ctes(f"""
SELECT d.Year, d.Quarter, d.MonthNumber AS Month, lt.LoanType, COUNT(*) AS TotalLoans, CAST(SUM(l.LoanAmount) AS DOUBLE) AS TotalLoanAmount, CAST(SUM(l.Balance) AS DOUBLE) AS TotalOutstandingBalance,
 SUM((l.PaymentStatus = 'Late')::INT)::BIGINT AS LatePaymentsCount, SUM((l.PaymentStatus = 'Defaulted')::INT)::BIGINT AS DefaultsCount, CAST(COALESCE(SUM(CASE WHEN l.PaymentStatus = 'Defaulted' THEN l.Balance END), 0) AS DOUBLE) AS DefaultedBalance,
 COALESCE(SUM(f.n), 0)::BIGINT AS FraudCases, ROUND(COALESCE(SUM(f.amount), 0), 4) AS TotalFraudAmount, ROUND(AVG(e.UnemploymentRate), 4) AS AvgUnemploymentRate, ROUND(AVG(e.InflationRate), 4) AS AvgInflationRate
FROM fact_loan l JOIN dates d ON d.DateID = l.LoanDateID JOIN loan_types lt ON lt.LoanTypeID = l.LoanTypeID
LEFT JOIN (SELECT LoanID, COUNT(*) AS n, SUM(FraudAmount) AS amount FROM cases GROUP BY LoanID) f ON f.LoanID = l.LoanID
LEFT JOIN (SELECT *, {DAY_ID.format('ReportDate')} AS DateID FROM stg_macro WHERE CountryName = 'NATION_1') e ON e.DateID = l.LoanDateID GROUP BY ALL""",
                                 "stg_loan", "stg_fraud", "stg_macro", **STAR, fact_loan=FACT_LOAN, cases=FRAUD_CASES_SQL))
def w5(t):
    types, days = loan_types(t), dates(t)
    out = R.risk_dashboard(marts.fact_loan(t.stg_loan, dim_customer(t), types, days), days, types, fraud_cases(t), economy(t), "USA")
    return rounded(as_double(out, "TotalLoanAmount", "TotalOutstandingBalance", "DefaultedBalance"), "TotalFraudAmount", "AvgUnemploymentRate", "AvgInflationRate")


# --- IFRS 9 --------------------------------------------------------------------------------------------------------

PEOPLE = "SELECT DISTINCT o_custkey AS CustomerSK, o_custkey + 1000 AS CustomerID, CONCAT('C', o_custkey) AS CustomerName FROM orders"
BOOKS = "SELECT AccountSK, CONCAT('N', AccountSK) AS AccountNumber, AccountType, CASE WHEN AccountType IN ('LOAN', 'MORTGAGE') THEN 'Credit' ELSE 'Security' END AS ProductCategory FROM accounts"
RUN_CTES = dict(accounts=ACCOUNTS_SQL, **RUNS, hist=HISTORY, people=PEOPLE, books=BOOKS)
CALC_ALL = "(SELECT * FROM c1 UNION ALL SELECT * FROM c2)"


def people(t):
    k = F.col("CustomerSK")
    owners = t.orders.select(F.col("o_custkey").alias("CustomerSK")).distinct()
    return owners.select(k, (k + 1000).alias("CustomerID"), F.concat(F.lit("C"), k.cast("string")).alias("CustomerName"))


def books(t):
    kind = F.col("AccountType")
    return accounts(t).select("AccountSK", F.concat(F.lit("N"), F.col("AccountSK").cast("string")).alias("AccountNumber"), kind,
                              F.when(kind.isin("LOAN", "MORTGAGE"), "Credit").otherwise("Security").alias("ProductCategory"))


@query("w6_instrument_classification", ctes(f"""
SELECT p.CustomerID, p.CustomerName, b.AccountNumber, b.AccountType, c.ClassificationCategory, c.BusinessModelAssessment, c.CashflowCharacteristics, DATE '{AS_OF}' AS ClassificationDate, CAST(NULL AS DATE) AS LastReassessmentDate
FROM cls c JOIN people p ON p.CustomerSK = c.CustomerSK JOIN books b ON b.AccountSK = c.AccountSK""", "ifrs_loan", accounts=ACCOUNTS_SQL, cls=CLASSIFIED, people=PEOPLE, books=BOOKS))
def w6(t):
    return R.instrument_classification(I.classify_instruments(accounts(t), None, AS_OF), people(t), books(t))


@query("w7_ecl_staging_summary", ctes(f"""
SELECT s.AsOfDate AS ReportDate, s.ECLStage, COUNT(*) AS AccountCount, ROUND(SUM(l.CurrentBalance), 2) AS GrossCarryingAmount, ROUND(SUM(c.AppliedECL), 2) AS TotalECL, SUM(CASE WHEN s.StageChangeDate = s.AsOfDate THEN 1 ELSE 0 END)::BIGINT AS StageChangesCount,
 ROUND(SUM(c.AppliedECL) / NULLIF(SUM(l.CurrentBalance), 0) * 100, 6) AS ECLRatio
FROM hist s JOIN l2 l ON l.CustomerSK = s.CustomerSK AND l.AccountSK = s.AccountSK JOIN {CALC_ALL} c ON c.CustomerSK = s.CustomerSK AND c.AccountSK = s.AccountSK AND c.AsOfDate = s.AsOfDate
GROUP BY s.AsOfDate, s.ECLStage""", "ifrs_loan", **RUN_CTES))
def w7(t):
    s = two_runs(t)
    out = R.ecl_staging_summary(s["stages"], s["loans"], s["calc"])
    return rounded(rounded(out, "GrossCarryingAmount", "TotalECL", digits=2), "ECLRatio", digits=6)


@query("w8_ecl_detail", ctes(f"""
SELECT c.AsOfDate AS ReportDate, p.CustomerID, p.CustomerName, b.AccountNumber, b.AccountType, c.ECLStage, ROUND(c.Gross, 2) AS GrossCarryingAmount, c.AppliedECL, ROUND(c.Gross - c.AppliedECL, 4) AS NetCarryingAmount, ROUND(c.PD_Applied, 8) AS PD_Applied,
 c.LGD_Applied, ROUND(c.EAD_Applied, 4) AS EAD_Applied, ROUND(c.DiscountFactor, 8) AS DiscountFactor, l.CurrentBalance, l.InterestRate, l.MaturityDate, l.DaysPastDue, 'Base' AS ScenarioName, CAST(0.6 AS DOUBLE) AS ScenarioWeight
FROM {CALC_ALL} c JOIN people p ON p.CustomerSK = c.CustomerSK JOIN books b ON b.AccountSK = c.AccountSK JOIN l2 l ON l.CustomerSK = c.CustomerSK AND l.AccountSK = c.AccountSK""", "ifrs_loan", **RUN_CTES))
def w8(t):
    s = two_runs(t)
    out = R.ecl_detail(s["calc"], people(t), books(t), s["loans"], I.seed_scenarios(t.spark))
    return rounded(rounded(rounded(out, "NetCarryingAmount", "EAD_Applied"), "PD_Applied", "DiscountFactor", digits=8), "GrossCarryingAmount", digits=2)


@query("w9_macro_impact", ctes(f"""
SELECT c.AsOfDate AS ReportDate, c.ScenarioName, c.w AS ScenarioWeight, c.w * 5 AS GDPGrowth, COUNT(DISTINCT c.AccountSK) AS AccountCount, ROUND(SUM(c.Gross), 2) AS TotalExposure, ROUND(SUM(c.AppliedECL), 2) AS TotalECL,
 ROUND(SUM(c.AppliedECL) / NULLIF(SUM(c.Gross), 0) * 100, 6) AS ECLRatio FROM (SELECT c2.*, s.w FROM c2 JOIN scen s ON s.ScenarioID = c2.ScenarioID) c GROUP BY 1, 2, 3, 4""", "ifrs_loan",
                               **{k: RUNS[k] for k in ("l2", "s2", "p2", "scen")}, c2=RUNS["c2"].replace("CROSS JOIN base w", "CROSS JOIN scen w")))
def w9(t):
    scenarios = I.seed_scenarios(t.spark)
    indicators = scenarios.select("ScenarioID", F.lit(20240130).alias("DateID"), (F.col("ScenarioWeight") * 5).alias("GDPGrowth"))
    out = R.macro_impact(loss(t, "all"), scenarios, indicators)
    return rounded(rounded(out, "TotalExposure", "TotalECL", digits=2), "ECLRatio", digits=6)


@query("w10_sicr_monitoring", ctes(f"""
SELECT * FROM (SELECT s.AsOfDate AS ReportDate, p.CustomerID, b.AccountNumber, s.ECLStage AS CurrentStage, o.ECLStage AS PreviousStage, ROUND(c.PD_Applied, 8) AS CurrentPD, ROUND(oc.PD_Applied, 8) AS PreviousPD,
 ROUND((c.PD_Applied - oc.PD_Applied) / NULLIF(oc.PD_Applied, 0) * 100, 4) AS PD_PercentChange, l.DaysPastDue, l.CurrentBalance AS ExposureAmount
FROM (SELECT * FROM s1 UNION ALL SELECT * FROM s2) s
LEFT JOIN s1 o ON o.CustomerSK = s.CustomerSK AND o.AccountSK = s.AccountSK AND o.AsOfDate < s.AsOfDate
LEFT JOIN {CALC_ALL} c ON c.CustomerSK = s.CustomerSK AND c.AccountSK = s.AccountSK AND c.AsOfDate = s.AsOfDate
LEFT JOIN c1 oc ON oc.CustomerSK = o.CustomerSK AND oc.AccountSK = o.AccountSK
JOIN people p ON p.CustomerSK = s.CustomerSK JOIN books b ON b.AccountSK = s.AccountSK JOIN l2 l ON l.CustomerSK = s.CustomerSK AND l.AccountSK = s.AccountSK)
WHERE PreviousStage IS NULL OR PreviousStage <> CurrentStage""", "ifrs_loan", **RUN_CTES))
def w10(t):
    s = two_runs(t)
    out = R.sicr_monitoring(s["stages"], s["calc"], people(t), books(t), s["loans"]).drop("CustomerName", "AccountType")
    return rounded(rounded(out, "CurrentPD", "PreviousPD", digits=8), "PD_PercentChange")


@query("w11_classification_changes", ctes(f"""
SELECT p.CustomerID, p.CustomerName, k.AccountNumber, k.AccountType, c.ClassificationCategory AS CurrentClassification, b.ClassificationCategory AS PreviousClassification, DATE '{AS_OF}' AS ClassificationDate, c.BusinessModelAssessment, c.CashflowCharacteristics
FROM cls c JOIN people p ON p.CustomerSK = c.CustomerSK JOIN books k ON k.AccountSK = c.AccountSK LEFT JOIN (SELECT b.* FROM basic b JOIN accounts a USING (CustomerSK, AccountSK) WHERE a.CollateralType <> 'OTHER') b ON b.CustomerSK = c.CustomerSK AND b.AccountSK = c.AccountSK
WHERE b.ClassificationCategory IS NULL OR b.ClassificationCategory <> c.ClassificationCategory""", "ifrs_loan", accounts=ACCOUNTS_SQL, cls=CLASSIFIED, basic=BASIC, people=PEOPLE, books=BOOKS))
def w11(t):
    everything = accounts(t)
    history = I.classify_instruments_basic(everything.filter("CollateralType <> 'OTHER'"), None, BEFORE).withColumn("EffectiveEndDate", F.lit(AS_OF).cast("date"))
    return R.classification_changes(I.classify_instruments(everything, None, AS_OF), history, people(t), books(t))


@query("w12_ifrs9_vs_ias39", ctes("""
SELECT AsOfDate AS ReportDate, b.AccountType, b.ProductCategory, COUNT(DISTINCT c.AccountSK) AS AccountCount, ROUND(SUM(Gross), 2) AS TotalExposure, ROUND(SUM(AppliedECL), 2) AS IFRS9_ECL, ROUND(SUM(v.p), 2) AS IAS39_Provision,
 ROUND(SUM(AppliedECL - v.p), 2) AS ProvisionDifference, ROUND(SUM(AppliedECL) / NULLIF(SUM(v.p), 0) * 100 - 100, 4) AS PercentageChange
FROM c2 c JOIN (SELECT CustomerSK, AccountSK, CurrentBalance * CAST(0.03 AS DOUBLE) AS p FROM l2) v ON v.CustomerSK = c.CustomerSK AND v.AccountSK = c.AccountSK JOIN books b ON b.AccountSK = c.AccountSK GROUP BY 1, 2, 3""",
                                  "ifrs_loan", accounts=ACCOUNTS_SQL, **{k: RUNS[k] for k in ("l2", "s2", "p2", "base", "c2")}, books=BOOKS))
def w12(t):
    provisions = loans_now(t).select("CustomerSK", "AccountSK", F.lit(20240130).alias("DateID"), (F.col("CurrentBalance") * 0.03).alias("HistoricalProvision"))
    out = R.ifrs9_vs_ias39(loss(t, "param"), provisions, books(t))
    return rounded(rounded(out, "TotalExposure", "IFRS9_ECL", "IAS39_Provision", "ProvisionDifference", digits=2), "PercentageChange")


@query("w13_modifications", ctes("""
SELECT DATE '2024-01-15' AS ModificationDate, p.CustomerID, p.CustomerName, b.AccountNumber, b.AccountType, 'Term' AS ModificationType, l.CurrentBalance AS OriginalGrossCarryingAmount, ROUND(l.CurrentBalance * CAST(0.9 AS DOUBLE), 4) AS ModifiedGrossCarryingAmount
FROM ifrs_loan l JOIN people p ON p.CustomerSK = l.CustomerSK JOIN books b ON b.AccountSK = l.AccountSK WHERE l.ModifiedLoanFlag = 1""", "ifrs_loan", accounts=ACCOUNTS_SQL, people=PEOPLE, books=BOOKS))
def w13(t):
    events = t.ifrs_loan.filter("ModifiedLoanFlag = 1").select(
        "CustomerSK", "AccountSK", F.lit(20240115).alias("ModificationDateID"), F.lit("Term").alias("ModificationType"), F.col("CurrentBalance").alias("OriginalGrossCarryingAmount"),
        (F.col("CurrentBalance") * 0.9).alias("ModifiedGrossCarryingAmount"))
    return rounded(R.modifications(events, dates(t), people(t), books(t)), "ModifiedGrossCarryingAmount")


@query("w14_ecl_summary", ctes(f"""
SELECT c.AsOfDate, CAST(EXTRACT(YEAR FROM c.AsOfDate) AS INT) AS Year, CAST(EXTRACT(QUARTER FROM c.AsOfDate) AS INT) AS Quarter, STRFTIME(c.AsOfDate, '%B') AS MonthName, c.ECLStage, c.ScenarioName, COUNT(DISTINCT AccountSK) AS AccountCount,
 ROUND(SUM(Gross), 2) AS TotalExposure, ROUND(SUM(AppliedECL), 2) AS TotalECL, ROUND(SUM(AppliedECL) / NULLIF(SUM(Gross), 0) * 100, 6) AS ECLCoverageRatio, ROUND(AVG(PD_Applied) * 100, 6) AS AvgPD, ROUND(AVG(LGD_Applied) * 100, 6) AS AvgLGD
FROM {CALC_ALL} c GROUP BY c.AsOfDate, c.ECLStage, c.ScenarioName""", "ifrs_loan", **RUN_CTES))
def w14(t):
    out = R.ecl_summary(two_runs(t)["calc"], dates(t), I.seed_scenarios(t.spark))
    return rounded(rounded(out, "TotalExposure", "TotalECL", digits=2), "ECLCoverageRatio", "AvgPD", "AvgLGD", digits=6)

