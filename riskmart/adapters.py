"""Domain inputs derived from the given tables.

Portable SQL: Spark runs it over DataFrames, the comparison engine runs the same text as common table expressions.
Ids that grow with the data are BIGINT.
"""

from __future__ import annotations

AS_OF = "2024-01-30"
AS_OF_ID = 20240130

STG_LOAN = """
SELECT CAST(c.c_custkey AS BIGINT) AS CustomerID, o.o_orderkey AS RowKey,
 CONCAT('L-', CAST(o.o_orderkey AS VARCHAR(20))) AS LoanID,
 CAST(16 + c.c_custkey % 90 AS INT) AS Age, c.c_mktsegment AS JobTitle,
 CAST(CASE WHEN c.c_custkey % 5 = 0 THEN 0 ELSE 1 END AS INT) AS EmploymentStatus,
 CASE c.c_custkey % 3 WHEN 0 THEN 'Rent' WHEN 1 THEN 'Own' ELSE 'Mortgage' END AS HomeOwnershipStatus,
 CASE c.c_custkey % 4 WHEN 0 THEN 'Single' WHEN 1 THEN 'Married' WHEN 2 THEN 'Divorced' ELSE 'Widowed' END AS MaritalStatus,
 CAST(CASE WHEN c.c_custkey % 11 = 0 THEN 1 ELSE 0 END AS INT) AS PreviousLoanDefault,
 CAST(20000 + c.bal_cents * 12 / CAST(100 AS DOUBLE) AS DECIMAL(18,2)) AS AnnualIncome,
 CAST(o.cents * 2 / CAST(100 AS DOUBLE) AS DECIMAL(18,2)) AS TotalAssets,
 CAST(FLOOR(o.cents * (o.o_orderkey % 7) / CAST(4 AS DOUBLE)) / CAST(100 AS DOUBLE) AS DECIMAL(18,2)) AS TotalLiabilities,
 CAST(c.bal_cents * 5 / CAST(100 AS DOUBLE) AS DECIMAL(18,2)) AS AnnualExpenses,
 CAST(FLOOR(c.bal_cents / CAST(4 AS DOUBLE)) / CAST(100 AS DOUBLE) AS DECIMAL(18,2)) AS MonthlySavings,
 CAST(FLOOR(c.bal_cents / CAST(8 AS DOUBLE)) / CAST(100 AS DOUBLE) AS DECIMAL(18,2)) AS AnnualBonus,
 CAST(c.c_custkey % 25 AS INT) AS PaymentHistoryYears, CAST((c.c_custkey * 7) % 240 AS INT) AS JobTenureMonths,
 CAST(c.c_custkey % 6 AS INT) AS NumDependents,
 CAST((c.c_custkey % 70) / CAST(100 AS DOUBLE) AS DOUBLE) AS DebtToIncomeRatio,
 CASE SUBSTRING(o.o_orderpriority,1,1) WHEN '1' THEN 'Personal' WHEN '2' THEN 'Auto' WHEN '3' THEN 'Home' WHEN '4' THEN 'Student' ELSE 'Business' END AS LoanType,
 CAST(o.o_orderdate AS DATE) + 8217 AS LoanDate,
 CAST(o.o_totalprice AS DECIMAL(18,2)) AS LoanAmount,
 CAST(12 * (1 + o.o_orderkey % 5) AS INT) AS LoanDurationMonths,
 CAST((o.o_orderkey % 340) / CAST(10 AS DOUBLE) - 1 AS DOUBLE) AS InterestRate,
 CAST(o.o_orderkey % 6 AS INT) AS DelayedPayments,
 CAST(FLOOR(o.cents * (o.o_orderkey % 100) / CAST(100 AS DOUBLE)) / CAST(100 AS DOUBLE) AS DECIMAL(18,2)) AS Balance,
 CAST(FLOOR(o.cents * (40 + (o.o_orderkey % 9) * 25) / CAST(1200 * (1 + o.o_orderkey % 5) AS DOUBLE)) / CAST(100 AS DOUBLE) AS DECIMAL(18,2)) AS MonthlyPayment,
 CASE o.o_orderstatus WHEN 'F' THEN 'On Time' WHEN 'O' THEN 'Late' ELSE 'Defaulted' END AS PaymentStatus,
 CONCAT('A-', CAST(c.c_custkey AS VARCHAR(20))) AS AccountID,
 CASE c.c_custkey % 6 WHEN 0 THEN 'LOAN' WHEN 1 THEN 'BOND' WHEN 2 THEN 'EQUITY' WHEN 3 THEN 'DERIVATIVE' WHEN 4 THEN 'MORTGAGE' ELSE 'Savings' END AS AccountType,
 CAST(280 + (c.c_custkey * 37) % 600 AS INT) AS CreditScore,
 CAST(c.c_custkey % 8 AS INT) AS NumBankAccounts, CAST(c.c_custkey % 9 AS INT) AS NumCreditCards,
 CAST(c.c_custkey % 7 AS INT) AS NumLoans, CAST(c.c_custkey % 13 AS INT) AS NumCreditInquiries,
 CAST((c.c_custkey * 5) % 360 AS INT) AS CreditHistoryLengthMonths,
 CAST((c.c_custkey % 110) / CAST(100 AS DOUBLE) AS DOUBLE) AS CreditUtilizationRatio
FROM (SELECT *, CAST(ROUND(o_totalprice * 100) AS BIGINT) AS cents FROM {orders}) o
JOIN (SELECT *, CAST(ROUND(ABS(c_acctbal) * 100) AS BIGINT) AS bal_cents FROM {customer}) c ON o.o_custkey = c.c_custkey
"""

STG_FRAUD = """
SELECT e.event_id AS TransactionID, e.user_id AS CustomerID, e.ts AS TransactionDate,
 CASE e.event_type WHEN 'purchase' THEN 'Purchase' WHEN 'click' THEN 'Withdrawal' WHEN 'view' THEN 'Deposit' ELSE 'Transfer' END AS TransactionTypeName,
 CAST(e.value * (e.user_id % 40) AS DOUBLE) AS DistanceFromHome, CAST(e.value * 3 - 20 AS DOUBLE) AS DistanceFromLastTransaction,
 CAST(e.value / CAST(12.5 AS DOUBLE) AS DOUBLE) AS RatioToMedianTransactionAmount,
 CAST(CASE WHEN e.event_id % 3 = 0 THEN 1 ELSE 0 END AS INT) AS IsOnlineTransaction,
 CAST(CASE WHEN e.event_id % 2 = 0 OR e.user_id % 3 = 0 THEN 1 ELSE 0 END AS INT) AS IsUsedChip,
 CAST(CASE WHEN e.event_id % 5 < 2 THEN 1 ELSE 0 END AS INT) AS IsUsedPIN,
 CAST(CASE WHEN e.event_type = 'error' AND e.value > 120 THEN 1 ELSE 0 END AS INT) AS IsFraudulent
FROM {events} e
"""

STG_MARKET = """
SELECT CAST(e.ts AS DATE) AS MarketDate, e.event_type AS MarketName,
 MIN_BY(e.value, e.event_id) AS OpenValue, MAX_BY(e.value, e.event_id) AS CloseValue,
 MAX(e.value) AS HighestValue, MIN(e.value) AS LowestValue,
 CAST(COUNT(*) AS DOUBLE) AS Volume, CAST(COUNT(*) % 9 AS DOUBLE) AS InterestRate,
 CAST(10 + COUNT(*) % 50 AS DOUBLE) AS VIX, CAST((COUNT(*) % 30) / CAST(10 AS DOUBLE) AS DOUBLE) AS TEDSpread
FROM {events} e GROUP BY CAST(e.ts AS DATE), e.event_type
"""

STG_MACRO = """
SELECT d.ReportDate, n.n_name AS CountryName,
 CAST(((n.n_nationkey * 7 + EXTRACT(DAY FROM d.ReportDate)) % 23) / CAST(2 AS DOUBLE) AS DOUBLE) AS UnemploymentRate,
 CAST(100000 + n.n_nationkey * 5000 AS BIGINT) AS GDP,
 CAST(20 + n.n_nationkey * 9 AS DOUBLE) AS DebtRatio, CAST(n.n_nationkey % 6 - 1 AS DOUBLE) AS DeficitRatio,
 CAST(n.n_nationkey % 12 - 2 AS DOUBLE) AS InflationRate, CAST(100 + n.n_nationkey AS DOUBLE) AS ConsumerPriceIndex
FROM {nation} n CROSS JOIN (SELECT DISTINCT CAST(ts AS DATE) AS ReportDate FROM {events}) d
"""

IFRS_LOAN = """
SELECT o.o_custkey AS CustomerSK, o.o_orderkey AS AccountSK,
 CAST(CASE WHEN o.o_orderkey % 10 = 0 THEN 0 ELSE 1 END AS INT) AS IsActive,
 CAST((o.o_orderkey * 13) % 130 AS INT) AS DaysPastDue, CAST(CASE WHEN o.o_orderkey % 41 = 0 THEN 1 ELSE 0 END AS INT) AS IsDefaulted,
 CAST(CASE WHEN o.o_orderkey % 29 = 0 THEN 1 ELSE 0 END AS INT) AS ForbearanceFlag, CAST(CASE WHEN o.o_orderkey % 53 = 0 THEN 1 ELSE 0 END AS INT) AS ChargeOffFlag,
 CAST(CASE WHEN o.o_orderkey % 31 = 0 THEN 1 ELSE 0 END AS INT) AS ModifiedLoanFlag,
 CAST(DATE '2024-01-30' + CAST((o.o_orderkey % 60) * 31 AS INT) AS DATE) AS MaturityDate, CAST(12 * (1 + o.o_orderkey % 10) AS INT) AS TermMonths,
 CASE o.o_orderkey % 5 WHEN 0 THEN 'REAL_ESTATE' WHEN 1 THEN 'VEHICLE' WHEN 2 THEN 'SECURITIES' WHEN 3 THEN 'NONE' ELSE 'OTHER' END AS CollateralType,
 CASE WHEN o.o_orderkey % 4 = 0 THEN 'REVOLVING' ELSE 'TERM' END AS LoanType,
 CAST(o.o_totalprice AS DOUBLE) AS CurrentBalance, o.o_totalprice * CAST(1.5 AS DOUBLE) AS CreditLimit,
 CAST((o.o_orderkey % 90) / CAST(10 AS DOUBLE) AS DOUBLE) AS InterestRate,
 CAST(300 + (o.o_custkey * 37) % 551 AS INT) AS CreditScore, CAST((o.o_custkey * 3) % 25 AS DOUBLE) AS CreditScoreDecreasePercent,
 CAST(CASE WHEN o.o_custkey % 97 = 0 THEN 1 ELSE 0 END AS INT) AS BankruptcyFlag, CAST(CASE WHEN o.o_custkey % 61 = 0 THEN 1 ELSE 0 END AS INT) AS WatchListFlag
FROM {orders} o
"""

RUN_LOG = """
SELECT CONCAT('load_', e.event_type) AS ProcedureName, 'Load' AS StepName,
 CASE WHEN COUNT(*) % 7 = 0 THEN 'Failed' ELSE 'Success' END AS Status,
 COUNT(*) AS RowsProcessed, CAST(COUNT(*) % 60 AS BIGINT) AS ExecutionTimeSeconds, MAX(e.ts) AS ExecutionDateTime
FROM {events} e GROUP BY CAST(e.ts AS DATE), e.event_type
"""

TABLES = (
    "region nation customer supplier part orders lineitem events "
    "documents embeddings pages benchmark labels conversations"
).split()

ADAPTERS = {
    "stg_loan": STG_LOAN,
    "stg_fraud": STG_FRAUD,
    "stg_market": STG_MARKET,
    "stg_macro": STG_MACRO,
    "ifrs_loan": IFRS_LOAN,
    "run_log": RUN_LOG,
}


def plain(name: str) -> str:
    """Adapter text over bare table names."""
    return ADAPTERS[name].format(**{t: t for t in TABLES})
