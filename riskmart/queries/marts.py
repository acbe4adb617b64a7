"""Facts of the star schema (F family)."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskmart.plans import marts
from riskmart.queries.keys import (
    DIM_ACCOUNT, DIM_CUSTOMER, DIM_TXN, TXN_TYPES, dates, dim_customer, dim_transaction)
from riskmart.queries.load import DATE_DIM
from riskmart.queries.registry import ORACLE, Inputs, ctes, query
from riskmart.session import stage_path

LOAN_TYPES = "SELECT ROW_NUMBER() OVER (ORDER BY LoanType) AS LoanTypeID, LoanType FROM (SELECT DISTINCT TRIM(LoanType) AS LoanType FROM stg_loan)"
FACT_LOAN = """
SELECT * EXCLUDE (rn) FROM (
SELECT c.CustomerSK, d.DateID AS LoanDateID, lt.LoanTypeID, l.LoanAmount, l.LoanDurationMonths, l.InterestRate, l.DelayedPayments, l.Balance,
 l.MonthlyPayment, l.PaymentStatus, l.LoanID,
 MD5(CAST(c.CustomerSK AS VARCHAR) || '|' || CAST(d.DateID AS VARCHAR) || '|' || CAST(lt.LoanTypeID AS VARCHAR) || '|' || CAST(l.LoanAmount AS VARCHAR)) AS NaturalKeyHash,
 ROW_NUMBER() OVER (PARTITION BY c.CustomerSK, d.DateID, lt.LoanTypeID, l.LoanAmount ORDER BY l.LoanID DESC) AS rn
FROM stg_loan l JOIN dates d ON l.LoanDate = d.FullDate JOIN dim_customer c ON c.CustomerID = l.CustomerID AND c.IsCurrent = 1
JOIN loan_types lt ON TRIM(l.LoanType) = TRIM(lt.LoanType)) WHERE rn = 1"""
STAR = dict(dates=DATE_DIM, dim_customer=DIM_CUSTOMER, loan_types=LOAN_TYPES)


def loan_types(t: Inputs):
    return marts.small_dim(t.stg_loan, "LoanType", "LoanTypeID", loose=True)


def fact_loan(t: Inputs):
    return marts.fact_loan(t.stg_loan, dim_customer(t), loan_types(t), dates(t))


def as_double(df, *cols):
    return df.withColumns({c: F.col(c).cast("double") for c in cols})


LOAN_OUT = ["LoanAmount", "Balance", "MonthlyPayment"]
LOAN_DOUBLES = "* REPLACE (CAST(LoanAmount AS DOUBLE) AS LoanAmount, CAST(Balance AS DOUBLE) AS Balance, CAST(MonthlyPayment AS DOUBLE) AS MonthlyPayment)"


@query("f1_fact_loan", ctes(f"SELECT {LOAN_DOUBLES} FROM fact_loan", "stg_loan", **STAR, fact_loan=FACT_LOAN))
def f1(t):
    return as_double(fact_loan(t), *LOAN_OUT)


@query("f1_fact_loan_update", ctes(f"""
SELECT {LOAN_DOUBLES} FROM (
SELECT f.* REPLACE (CASE WHEN d.FullDate >= DATE '2020-01-01' THEN f.Balance - f.Balance ELSE f.Balance END AS Balance,
 CASE WHEN d.FullDate >= DATE '2020-01-01' THEN 'On Time' ELSE f.PaymentStatus END AS PaymentStatus)
FROM fact_loan f JOIN dates d ON d.DateID = f.LoanDateID WHERE d.FullDate >= DATE '2020-01-01' OR d.FullDate < DATE '2021-01-01')""",
                                   "stg_loan", **STAR, fact_loan=FACT_LOAN))
def f1_update(t):
    """Loans up to 2020 are loaded; a later delivery repeats those of 2020 with new balances and adds the following years."""
    stg, cust, types, days = t.stg_loan, dim_customer(t), loan_types(t), dates(t)
    old = marts.fact_loan(stg.filter("LoanDate < DATE '2021-01-01'"), cust, types, days)
    later = stg.filter("LoanDate >= DATE '2020-01-01'").withColumns({
        "Balance": F.lit(0).cast("decimal(18,2)"), "PaymentStatus": F.lit("On Time")})
    return as_double(marts.fact_loan(later, cust, types, days, existing=old), *LOAN_OUT)


@query("e3_two_loads", ORACLE["f1_fact_loan_update"])
def e3_two_loads(t):
    """The two deliveries of ``f1_fact_loan_update`` into a kept table, whose second load rewrites its own months only."""
    stg, cust, types, days = t.stg_loan, dim_customer(t), loan_types(t), dates(t)
    store = marts.loan_store(t.spark, stage_path(t.spark, "fact-loan"))
    marts.merge_fact_loan(store, stg.filter("LoanDate < DATE '2021-01-01'"), cust, types, days)
    later = stg.filter("LoanDate >= DATE '2020-01-01'").withColumns({
        "Balance": F.lit(0).cast("decimal(18,2)"), "PaymentStatus": F.lit("On Time")})
    return as_double(marts.merge_fact_loan(store, later, cust, types, days), *LOAN_OUT)


FACT_CUSTOMER = """
SELECT c.CustomerSK, d.DateID AS DateSK, CAST(MAX(AnnualIncome) AS DOUBLE) AS AnnualIncome, CAST(SUM(TotalAssets) AS DOUBLE) AS TotalAssets,
 CAST(SUM(TotalLiabilities) AS DOUBLE) AS TotalLiabilities, CAST(SUM(AnnualExpenses) AS DOUBLE) AS AnnualExpenses,
 ((2 * SUM(CAST(MonthlySavings * 100 AS BIGINT)) + COUNT(*)) // (2 * COUNT(*))) / CAST(100 AS DOUBLE) AS MonthlySavings,
 CAST(SUM(AnnualBonus) AS DOUBLE) AS AnnualBonus, ROUND(AVG(DebtToIncomeRatio), 6) AS DebtToIncomeRatio, MAX(PaymentHistoryYears) AS PaymentHistoryYears,
 MAX(JobTenureMonths) AS JobTenureMonths, MAX(NumDependents) AS NumDependents
FROM stg_loan l JOIN dim_customer c ON c.CustomerID = l.CustomerID AND c.IsCurrent = 1 JOIN dates d ON l.LoanDate = d.FullDate
GROUP BY c.CustomerSK, d.DateID"""
CUSTOMER_MONEY = ["AnnualIncome", "TotalAssets", "TotalLiabilities", "AnnualExpenses", "MonthlySavings", "AnnualBonus"]


@query("f2_fact_customer", ctes("SELECT * FROM fact_customer", "stg_loan", **STAR, fact_customer=FACT_CUSTOMER))
def f2(t):
    df = marts.fact_customer(t.stg_loan, dim_customer(t), dates(t))
    return as_double(df, *CUSTOMER_MONEY).withColumn("DebtToIncomeRatio", F.round("DebtToIncomeRatio", 6))


@query("f3_fact_credit", ctes("""
SELECT ROW_NUMBER() OVER (ORDER BY c.CustomerSK, l.LoanID) AS CreditID, c.CustomerSK, a.AccountSK, l.CreditScore, l.NumBankAccounts, l.NumCreditCards,
 l.NumLoans, l.NumCreditInquiries, l.CreditUtilizationRatio, l.CreditHistoryLengthMonths
FROM stg_loan l JOIN dim_customer c ON c.CustomerID = l.CustomerID AND c.IsCurrent = 1 LEFT JOIN dim_account a ON a.AccountID = l.AccountID""",
                              "stg_loan", dim_customer=DIM_CUSTOMER, dim_account=DIM_ACCOUNT))
def f3(t):
    cust = dim_customer(t)
    return marts.fact_credit(t.stg_loan, cust, marts.load_dim_account(t.stg_loan, cust))


@query("f3_fact_credit_added", ctes("""
SELECT ROW_NUMBER() OVER (ORDER BY renting, CustomerSK, LoanID) AS CreditID, CustomerSK, CreditScore FROM (
SELECT CASE WHEN l.HomeOwnershipStatus = 'Rent' THEN 1 ELSE 2 END AS renting, c.CustomerSK, l.LoanID, l.CreditScore
FROM stg_loan l JOIN dim_customer c ON c.CustomerID = l.CustomerID)""", "stg_loan", dim_customer=DIM_CUSTOMER))
def f3_added(t):
    """Customers who rent are loaded first; the second load leaves them alone and numbers the others after them."""
    cust = dim_customer(t)
    first = marts.fact_credit(t.stg_loan.filter("HomeOwnershipStatus = 'Rent'"), cust)
    return marts.fact_credit(t.stg_loan, cust, existing=first).select("CreditID", "CustomerSK", "CreditScore")


@query("f4_fact_account", ctes("""
SELECT a.AccountSK, a.AccountID, CAST(l.Balance AS DOUBLE) AS AccountBalance FROM dim_account a JOIN stg_loan l ON l.AccountID = a.AccountID
WHERE a.AccountType <> 'BOND' UNION ALL SELECT AccountSK, AccountID, 0 FROM dim_account WHERE AccountType = 'BOND'""",
                               "stg_loan", dim_customer=DIM_CUSTOMER, dim_account=DIM_ACCOUNT))
def f4(t):
    accounts = marts.load_dim_account(t.stg_loan, dim_customer(t))
    loaded = accounts.filter("AccountType = 'BOND'").select(
        "AccountSK", "AccountID", F.lit(0).cast("decimal(18,2)").alias("AccountBalance"))
    stg = t.stg_loan.withColumn("AccountBalance", F.col("Balance"))
    return as_double(marts.fact_account(stg, accounts, existing=loaded), "AccountBalance")


FACT_FRAUD = """
SELECT f.TransactionID, x.TransactionDateID, c.CustomerSK, f.DistanceFromHome, f.DistanceFromLastTransaction, f.RatioToMedianTransactionAmount,
 f.IsOnlineTransaction, f.IsUsedChip, f.IsUsedPIN, f.IsFraudulent
FROM stg_fraud f JOIN dim_customer c ON c.CustomerID = f.CustomerID AND c.IsCurrent = 1 JOIN dim_txn x ON x.TransactionID = f.TransactionID"""


@query("f5_fact_fraud", ctes("SELECT * FROM fact_fraud", "stg_loan", "stg_fraud", dates=DATE_DIM, dim_customer=DIM_CUSTOMER, txn_types=TXN_TYPES,
                             dim_txn=DIM_TXN, fact_fraud=FACT_FRAUD))
def f5(t):
    """Frauds are loaded before the rest, which is then added without repeating them."""
    cust, txn = dim_customer(t), dim_transaction(t)
    first = marts.fact_fraud(t.stg_fraud.filter("IsFraudulent = 1"), cust, txn)
    return marts.fact_fraud(t.stg_fraud, cust, txn, existing=first)


INDEXES = "SELECT ROW_NUMBER() OVER (ORDER BY MarketName) AS MarketIndexSK, MarketName FROM (SELECT DISTINCT MarketName FROM stg_market)"
FACT_MARKET = """
SELECT ROW_NUMBER() OVER (ORDER BY d.DateID, i.MarketIndexSK) AS MarketID, d.DateID, i.MarketIndexSK, m.OpenValue, m.CloseValue, m.HighestValue, m.LowestValue,
 m.Volume, m.InterestRate, m.VIX, m.TEDSpread
FROM stg_market m JOIN dates d ON d.FullDate = m.MarketDate JOIN indexes i ON i.MarketName = m.MarketName"""
MARKET_STAR = dict(dates=DATE_DIM, indexes=INDEXES, fact_market=FACT_MARKET)


def indexes(t):
    return marts.small_dim(t.stg_market, "MarketName", "MarketIndexSK")


@query("f6_fact_market", ctes("""
SELECT * REPLACE (CASE WHEN DateID <= 20240110 THEN Volume ELSE Volume + 1 END AS Volume) FROM fact_market""", "stg_market", **MARKET_STAR))
def f6(t):
    """The first 20 days are loaded; the next delivery starts at day 11 with corrected volumes."""
    idx, days = indexes(t), dates(t)
    first = marts.fact_market(t.stg_market.filter("MarketDate <= DATE '2024-01-20'"), idx, days)
    later = t.stg_market.filter("MarketDate >= DATE '2024-01-11'").withColumn("Volume", F.col("Volume") + 1)
    return marts.fact_market(later, idx, days, existing=first)


COUNTRIES = "SELECT ROW_NUMBER() OVER (ORDER BY CountryName) AS CountryID, CountryName FROM (SELECT DISTINCT CountryName FROM stg_macro)"
FACT_ECONOMIC = """
SELECT ROW_NUMBER() OVER (ORDER BY d.DateID, c.CountryID) AS EconomicID, d.DateID AS ReportDateID, c.CountryID, m.UnemploymentRate, m.GDP, m.DebtRatio,
 m.DeficitRatio, m.InflationRate, m.ConsumerPriceIndex
FROM stg_macro m JOIN dates d ON d.FullDate = m.ReportDate JOIN countries c ON c.CountryName = m.CountryName"""
ECONOMIC_STAR = dict(countries=COUNTRIES, fact_economic=FACT_ECONOMIC)


def countries(t):
    return marts.small_dim(t.stg_macro, "CountryName", "CountryID")


@query("f7_fact_economic", ctes("SELECT * FROM fact_economic", "stg_macro", dates=DATE_DIM, **ECONOMIC_STAR))
def f7(t):
    where, days = countries(t), dates(t)
    first = marts.fact_economic(t.stg_macro.filter("ReportDate <= DATE '2024-01-15'"), where, days)
    return marts.fact_economic(t.stg_macro, where, days, existing=first)


__all__ = ["fact_loan", "loan_types", "indexes", "countries"]
