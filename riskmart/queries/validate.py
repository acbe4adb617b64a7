"""Validation, profiling and quality score (V family)."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskmart.operators import profile as P
from riskmart.operators import validate as V
from riskmart.plans import gate
from riskmart.queries.marts import FACT_CUSTOMER, FACT_LOAN, STAR, fact_loan
from riskmart.queries.registry import Inputs, ctes, query
from riskmart.schemas import LOAN
from riskmart.session import stage_path


def rounded(df, *cols, digits=6):
    return df.withColumns({c: F.round(F.col(c), digits) for c in cols})


def tests_sql(table: str, *tests: tuple[str, str | None, str, str]) -> str:
    """UNION ALL of (check, field, condition, base condition) tests over one table."""
    rows = []
    for check, field, bad, base in tests:
        f = f"'{field}'" if field else "CAST(NULL AS VARCHAR)"
        n = f"SUM(CASE WHEN {bad} THEN 1 ELSE 0 END)"
        rows.append(f"SELECT '{check}' AS check, {f} AS field, 'warning' AS severity, CAST(CASE WHEN {n} > 0 THEN 1 ELSE 0 END AS INT) AS failed, "
                    f"CAST({n} AS BIGINT) AS n_bad, ROUND({n} * 100.0 / SUM(CASE WHEN {base} THEN 1 ELSE 0 END), 6) AS pct FROM {table}")
    return "\nUNION ALL ".join(rows).replace(" AS check,", ' AS "check",')


def issues(df):
    return rounded(df.drop("details"), "pct")


# --- generic checks ------------------------------------------------------------------------------------------------

@query("v1_check_schema", ctes("""
SELECT 'missing_column' AS "check", 'PaymentBehavior' AS field, 'critical' AS severity, CAST(1 AS INT) AS failed, CAST(1 AS BIGINT) AS n_bad
UNION ALL SELECT 'empty_dataset', NULL, 'critical', CAST(CASE WHEN COUNT(*) = 0 THEN 1 ELSE 0 END AS INT), CAST(CASE WHEN COUNT(*) = 0 THEN 1 ELSE 0 END AS BIGINT) FROM stg_loan
UNION ALL SELECT 'column_type', 'LoanDate', 'warning', CAST(1 AS INT), CAST(1 AS BIGINT)""", "stg_loan"))
def v1(t: Inputs):
    """A text date and a missing column in the staged loans; passed column tests are left out of the comparison."""
    df = t.stg_loan.withColumn("LoanDate", F.col("LoanDate").cast("string"))
    out = V.check_schema(df, LOAN).drop("details", "pct")
    return out.filter("failed = 1 or check = 'empty_dataset'")


BLANKED = """SELECT o_orderkey, CASE WHEN o_orderstatus <> 'P' THEN NULL ELSE o_custkey END AS o_custkey,
 CASE WHEN o_orderpriority = '5-LOW' OR o_orderstatus = 'F' THEN NULL ELSE o_totalprice END AS o_totalprice, CASE WHEN o_orderstatus = 'O' THEN NULL ELSE o_orderpriority END AS o_orderpriority FROM orders"""


def blanked(t):
    status, prio = F.col("o_orderstatus"), F.col("o_orderpriority")
    return t.orders.select(
        "o_orderkey", F.when(status == "P", F.col("o_custkey")).alias("o_custkey"),
        F.when(~((prio == "5-LOW") | (status == "F")), F.col("o_totalprice")).alias("o_totalprice"),
        F.when(status != "O", prio).alias("o_orderpriority"))


@query("v2_check_missing", ctes("""
SELECT 'high_missing_values' AS "check", CAST(n > 0 AS INT) AS failed, n AS n_bad, ROUND(n * 100.0 / 4, 6) AS pct FROM (
 SELECT CAST((AVG(CASE WHEN o_orderkey IS NULL THEN 1.0 ELSE 0 END) > 0.5)::INT + (AVG(CASE WHEN o_custkey IS NULL THEN 1.0 ELSE 0 END) > 0.5)::INT
 + (AVG(CASE WHEN o_totalprice IS NULL THEN 1.0 ELSE 0 END) > 0.5)::INT + (AVG(CASE WHEN o_orderpriority IS NULL THEN 1.0 ELSE 0 END) > 0.5)::INT AS BIGINT) AS n FROM b)
UNION ALL
SELECT 'high_missing_rows', CAST(r * 100.0 / n > 10 AS INT), r, ROUND(r * 100.0 / n, 6) FROM (
 SELECT COUNT(*) AS n, CAST(SUM(CASE WHEN ((o_custkey IS NULL)::INT + (o_totalprice IS NULL)::INT + (o_orderpriority IS NULL)::INT) / 4.0 > 0.5 THEN 1 ELSE 0 END) AS BIGINT) AS r FROM b)""",
                                b=BLANKED))
def v2(t):
    return issues(V.check_missing(blanked(t))).drop("field", "severity")


@query("v3_check_duplicates", """
SELECT 'duplicates' AS "check", CAST(COUNT(*) > COUNT(DISTINCT (text, lang, source)) AS INT) AS failed, COUNT(*) - COUNT(DISTINCT (text, lang, source)) AS n_bad,
 ROUND((COUNT(*) - COUNT(DISTINCT (text, lang, source))) * 100.0 / COUNT(*), 6) AS pct FROM documents""")
def v3(t):
    return issues(V.check_duplicates(t.documents.select("text", "lang", "source"))).drop("field", "severity")


LINE_COLS = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")
FENCES = "SELECT * FROM (" + " UNION ALL ".join(
    f"SELECT '{c}' AS field, QUANTILE_CONT({c}, 0.25) AS q1, QUANTILE_CONT({c}, 0.75) AS q3 FROM skewed" for c in LINE_COLS) + ")"
SKEWED = """SELECT l_quantity, CASE WHEN l_returnflag = 'R' AND l_linestatus = 'F' THEN l_extendedprice * 100 ELSE l_extendedprice END AS l_extendedprice,
 l_discount, CASE WHEN l_linenumber = 1 THEN l_tax + 9 ELSE l_tax END AS l_tax FROM lineitem"""


def skewed(t):
    """Line items with far values in two columns."""
    return t.lineitem.select(
        "l_quantity",
        F.when((F.col("l_returnflag") == "R") & (F.col("l_linestatus") == "F"), F.col("l_extendedprice") * 100)
        .otherwise(F.col("l_extendedprice")).alias("l_extendedprice"),
        "l_discount", F.when(F.col("l_linenumber") == 1, F.col("l_tax") + 9).otherwise(F.col("l_tax")).alias("l_tax"))


def outlier_sql(k: str) -> str:
    return " UNION ALL ".join(f"""
SELECT 'outliers' AS "check", '{c}' AS field, 'warning' AS severity, CAST(COUNT(CASE WHEN {c} < q1 - {k} * (q3 - q1) OR {c} > q3 + {k} * (q3 - q1) THEN 1 END) > 0.05 * COUNT({c}) AS INT) AS failed,
 COUNT(CASE WHEN {c} < q1 - {k} * (q3 - q1) OR {c} > q3 + {k} * (q3 - q1) THEN 1 END) AS n_bad,
 ROUND(COUNT(CASE WHEN {c} < q1 - {k} * (q3 - q1) OR {c} > q3 + {k} * (q3 - q1) THEN 1 END) * 100.0 / COUNT({c}), 6) AS pct
FROM skewed CROSS JOIN (SELECT * FROM fences WHERE field = '{c}')""" for c in LINE_COLS)


@query("v4_check_outliers", ctes(outlier_sql("3"), skewed=SKEWED, fences=FENCES))
def v4(t):
    return issues(V.check_outliers(skewed(t)))


@query("v5_check_dates_ages", ctes(tests_sql(
    "stg_loan", ("future_dates", "LoanDate", "LoanDate > DATE '2023-06-30'", "LoanDate IS NOT NULL"),
    ("invalid_ages", "Age", "Age < 18 OR Age > 100", "Age IS NOT NULL")), "stg_loan"))
def v5(t):
    return issues(V.check_dates_ages(t.stg_loan, "2023-06-30"))


# --- domain checks -------------------------------------------------------------------------------------------------

@query("v6_check_loan", ctes(tests_sql(
    "stg_loan", ("invalid_credit_scores", "CreditScore", "CreditScore < 300 OR CreditScore > 850", "TRUE"),
    ("high_loan_to_income_ratio", None, "LoanAmount > 10 * AnnualIncome AND AnnualIncome > 0", "TRUE"),
    ("invalid_interest_rates", "InterestRate", "InterestRate < 0 OR InterestRate > 100", "TRUE")), "stg_loan"))
def v6(t):
    return issues(V.check_loan(t.stg_loan))


FLAG_TESTS = [("invalid_binary_indicators", c, f"{c} IS NULL OR {c} NOT IN (0, 1)", "TRUE") for c in V.FRAUD_FLAGS]
BAD_FRAUD = "SELECT * REPLACE (CASE WHEN DistanceFromHome > 500 THEN 3 WHEN DistanceFromHome < 10 THEN NULL ELSE IsUsedChip END AS IsUsedChip) FROM stg_fraud"


def bad_fraud(t):
    d = F.col("DistanceFromHome")
    return t.stg_fraud.withColumn("IsUsedChip", F.when(d > 500, 3).when(d < 10, None).otherwise(F.col("IsUsedChip")))


@query("v7_check_fraud", ctes(tests_sql("f", *FLAG_TESTS), "stg_fraud", f=BAD_FRAUD))
def v7_fraud(t):
    return issues(V.check_fraud(bad_fraud(t)))


BAD_MARKET = """SELECT * REPLACE (CASE WHEN MarketName = 'click' THEN LowestValue - 5 ELSE HighestValue END AS HighestValue,
 CASE WHEN MarketName = 'view' THEN -CloseValue ELSE CloseValue END AS CloseValue, CASE WHEN MarketName = 'error' THEN NULL ELSE OpenValue END AS OpenValue) FROM stg_market"""


def bad_market(t):
    name = F.col("MarketName")
    return t.stg_market.withColumns({
        "HighestValue": F.when(name == "click", F.col("LowestValue") - 5).otherwise(F.col("HighestValue")),
        "CloseValue": F.when(name == "view", -F.col("CloseValue")).otherwise(F.col("CloseValue")),
        "OpenValue": F.when(name != "error", F.col("OpenValue")),
    })


MARKET_TESTS = [("negative_prices", c, f"{c} < 0", "TRUE") for c in V.PRICES] + [
    ("invalid_high_low_relationship", None, "HighestValue < LowestValue", "TRUE"),
    ("prices_out_of_range", None, "OpenValue IS NOT NULL AND (OpenValue > HighestValue OR OpenValue < LowestValue OR CloseValue > HighestValue OR CloseValue < LowestValue)",
     "OpenValue IS NOT NULL")]


@query("v7_check_market", ctes(tests_sql("m", *MARKET_TESTS), "stg_market", m=BAD_MARKET))
def v7_market(t):
    return issues(V.check_market(bad_market(t)))


BAD_MACRO = "SELECT * REPLACE (UnemploymentRate * 10 AS UnemploymentRate, GDP - 105000 AS GDP, InflationRate * 12 AS InflationRate) FROM stg_macro"


def bad_macro(t):
    return t.stg_macro.withColumns({
        "UnemploymentRate": F.col("UnemploymentRate") * 10, "GDP": F.col("GDP") - 105000, "InflationRate": F.col("InflationRate") * 12})


@query("v7_check_macro", ctes(tests_sql(
    "m", ("invalid_unemployment_rates", "UnemploymentRate", "UnemploymentRate < 0 OR UnemploymentRate > 100", "TRUE"),
    ("negative_gdp", "GDP", "GDP <= 0", "TRUE"), ("extreme_inflation_rates", "InflationRate", "InflationRate < -20 OR InflationRate > 100", "TRUE")),
    "stg_macro", m=BAD_MACRO))
def v7_macro(t):
    return issues(V.check_macro(bad_macro(t)))


@query("v8_quality_score", ctes("""
SELECT 'Market' AS dataset, 'pre' AS stage, CAST(0 AS BIGINT) AS critical, SUM(failed)::BIGINT AS warnings, SUM(1 - failed)::BIGINT AS tests_passed, SUM(failed)::BIGINT AS tests_failed,
 GREATEST(0, 100 - 2 * SUM(failed))::BIGINT AS quality_score, CASE WHEN SUM(failed) > 0 THEN 'warning' ELSE 'passed' END AS status FROM issues""",
                                "stg_market", m=BAD_MARKET, issues=tests_sql("m", *MARKET_TESTS)))
def v8(t):
    rows = V.check_market(bad_market(t)).select(F.lit("Market").alias("dataset"), F.lit("pre").alias("stage"), "*")
    return V.quality_score(rows)


@query("v9_check_constraints", ctes("""
SELECT 'check_constraint' AS "check", 'rate' AS field, CAST(COUNT(*) > 0 AS INT) AS failed, COUNT(*) AS n_bad FROM stg_loan WHERE NOT (InterestRate >= 0 AND InterestRate <= 30)
UNION ALL SELECT 'check_constraint', 'amount', CAST(COUNT(*) > 0 AS INT), COUNT(*) FROM stg_loan WHERE NOT (LoanAmount > 0)
UNION ALL SELECT 'unique_key', 'CustomerID,LoanDate', CAST(COUNT(*) > COUNT(DISTINCT (CustomerID, LoanDate)) AS INT), COUNT(*) - COUNT(DISTINCT (CustomerID, LoanDate)) FROM stg_loan
UNION ALL SELECT 'foreign_key', 'CustomerID', CAST(COUNT(*) > 0 AS INT), COUNT(*) FROM stg_loan WHERE CustomerID NOT IN (SELECT user_id FROM events)""", "stg_loan"))
def v9(t):
    out = V.check_constraints(
        t.stg_loan, {"rate": "InterestRate >= 0 AND InterestRate <= 30", "amount": "LoanAmount > 0"},
        keys=[["CustomerID", "LoanDate"]], fks=[(["CustomerID"], t.events, ["user_id"])])
    return issues(out).drop("pct", "severity")


STAGING_ERRORS = f"""
SELECT * FROM (
SELECT 'Loan' AS DataSource, 'Null CustomerIDs' AS ErrorType, COUNT(*) AS ErrorCount, 'Missing Values' AS ValidationCategory FROM stg_loan WHERE CustomerID IS NULL
UNION ALL SELECT 'Fraud', 'Null TransactionIDs', COUNT(*), 'Missing Values' FROM f WHERE TransactionID IS NULL
UNION ALL SELECT 'Loan', 'Negative Interest Rates', COUNT(*), 'Range Validation' FROM stg_loan WHERE InterestRate < 0
UNION ALL SELECT 'Loan', 'Suspiciously High Loan Amounts', COUNT(*), 'Outlier Detection' FROM stg_loan WHERE LoanAmount > 1000000
UNION ALL SELECT 'Loan', 'Invalid Monthly Payment', COUNT(*), 'Business Rules' FROM stg_loan WHERE MonthlyPayment > LoanAmount
UNION ALL SELECT 'Fraud', 'Duplicate Transactions', COUNT(TransactionID) - COUNT(DISTINCT TransactionID), 'Uniqueness Check' FROM f
UNION ALL SELECT 'Market', 'Future Dates', COUNT(*), 'Date Validation' FROM stg_market WHERE MarketDate > DATE '2024-01-20'
UNION ALL SELECT 'Loan', 'Statistical Interest Rate Outliers', COUNT(*), 'Statistical Validation' FROM stg_loan CROSS JOIN (SELECT AVG(InterestRate) AS m, STDDEV_SAMP(InterestRate) AS s FROM stg_loan)
 WHERE ABS(InterestRate - m) > 3 * s) WHERE ErrorCount > 0"""
REPEATED = "SELECT CASE WHEN IsFraudulent = 1 THEN NULL WHEN IsUsedPIN = 1 THEN TransactionID // 10 ELSE TransactionID END AS TransactionID FROM stg_fraud"


def staging_errors(t):
    repeated = t.stg_fraud.select(F.when(F.col("IsFraudulent") == 1, None).when(F.col("IsUsedPIN") == 1, F.expr("TransactionID div 10"))
                                  .otherwise(F.col("TransactionID")).alias("TransactionID"))
    return V.validate_staging(t.stg_loan, repeated, t.stg_market, "2024-01-20")


@query("v10_validate_staging", ctes("SELECT * FROM errors", "stg_loan", "stg_fraud", "stg_market", f=REPEATED, errors=STAGING_ERRORS))
def v10(t):
    return staging_errors(t)


@query("v10_staging_totals", ctes("SELECT COUNT(*) AS TotalIssueTypes, CAST(SUM(ErrorCount) AS BIGINT) AS TotalIssueCount FROM errors", "stg_loan", "stg_fraud", "stg_market",
                                  f=REPEATED, errors=STAGING_ERRORS))
def v10_totals(t):
    return V.staging_totals(staging_errors(t))


@query("v11_sample_values", ctes("""
SELECT '[' || STRING_AGG('{"LoanID":"' || LoanID || '","InterestRate":' || CAST(InterestRate AS VARCHAR) || '}', ',' ORDER BY LoanID) || ']' AS SampleValues
FROM (SELECT * FROM stg_loan WHERE InterestRate < 0 ORDER BY LoanID LIMIT 5)""", "stg_loan"))
def v11(t):
    return V.sample_values(t.stg_loan, F.col("InterestRate") < 0, "LoanID", ["InterestRate"])


# --- gate ----------------------------------------------------------------------------------------------------------

STAGE_LOG = """SELECT CASE ProcedureName WHEN 'load_click' THEN 'LoadLoanData' WHEN 'load_view' THEN 'LoadFraudData' WHEN 'load_purchase' THEN 'LoadMarketData'
 WHEN 'load_error' THEN 'LoadMacroData' ELSE 'StagingLoad' END AS StepName, CASE WHEN ProcedureName IN ('load_click', 'load_view', 'load_purchase', 'load_error') THEN 'Loaded' ELSE Status END AS Status,
 RowsProcessed, ExecutionDateTime FROM run_log"""
GATE_TIME = "2024-01-31 02:00:00"


def stage_log(t):
    name = F.col("ProcedureName")
    step = (F.when(name == "load_click", "LoadLoanData").when(name == "load_view", "LoadFraudData").when(name == "load_purchase", "LoadMarketData")
            .when(name == "load_error", "LoadMacroData").otherwise("StagingLoad"))
    return t.run_log.select(
        step.alias("StepName"), F.when(name.isin("load_click", "load_view", "load_purchase", "load_error"), "Loaded").otherwise(F.col("Status")).alias("Status"),
        "RowsProcessed", "ExecutionDateTime")


DRIFT = f"""
SELECT AVG(f.RowsProcessed * 1.0 / l.RowsProcessed * 100) AS historical_rate
FROM (SELECT * FROM stage_log WHERE StepName = 'LoadFraudData' AND Status = 'Loaded' AND ExecutionDateTime > TIMESTAMP '{GATE_TIME}' - INTERVAL 1 MONTH) f
JOIN (SELECT * FROM stage_log WHERE StepName = 'LoadLoanData' AND Status = 'Loaded' AND ExecutionDateTime > TIMESTAMP '{GATE_TIME}' - INTERVAL 1 MONTH) l
 ON DATE_DIFF('hour', f.ExecutionDateTime, l.ExecutionDateTime) BETWEEN -12 AND 12"""


def gate_results(t):
    tables = {"Loan": t.stg_loan, "Fraud": t.stg_fraud, "Market": t.stg_market, "Macro": t.stg_macro}
    return gate.validate_pre_production(tables, stage_log(t), GATE_TIME, historical_loan_average=200000.0)


def count_check(name: str, table: str) -> str:
    low = name.lower()
    return f"""
SELECT 'Data Completeness', '{name} Data Count', CASE WHEN ABS(n - p) > p * 5.0 / 100 THEN 'WARN' ELSE 'PASS' END,
 CASE WHEN ABS(n - p) > p * 5.0 / 100 THEN 'Current {low} count (' || n || ') differs from average (' || p || ') by more than 5.00%'
  ELSE '{name} count within expected range: ' || n || ' records' END, n, CASE WHEN ABS(n - p) > p * 5.0 / 100 THEN 'Medium' ELSE 'Low' END
FROM (SELECT COUNT(*) AS n FROM {table}) CROSS JOIN (SELECT CAST(FLOOR(AVG(RowsProcessed)) AS BIGINT) AS p FROM stage_log
 WHERE StepName = 'Load{name}Data' AND Status = 'Loaded' AND ExecutionDateTime > TIMESTAMP '{GATE_TIME}' - INTERVAL 1 MONTH)"""


def zero_check(category: str, check: str, status: str, severity: str, count: str, bad: str, good: str) -> str:
    return f"""
SELECT '{category}', '{check}', CASE WHEN n > 0 THEN '{status}' ELSE 'PASS' END, CASE WHEN n > 0 THEN 'Found ' || n || ' {bad}' ELSE '{good}' END,
 CASE WHEN n > 0 THEN n END, CASE WHEN n > 0 THEN '{severity}' ELSE 'Low' END FROM ({count}) AS c(n)"""


GATE = "\nUNION ALL ".join([
    """SELECT 'ETL Process' AS ValidationCategory, 'Required Tables' AS ValidationCheck, 'PASS' AS Status, 'All required staging tables exist' AS Description,
 CAST(NULL AS BIGINT) AS AffectedRows, 'Low' AS Severity""",
    f"""SELECT 'ETL Process', 'ETL Completion', CASE WHEN COUNT(*) = 0 THEN 'WARN' ELSE 'PASS' END,
 CASE WHEN COUNT(*) = 0 THEN 'No successful staging ETL completion found in the last 24 hours' ELSE 'Staging ETL completed successfully within the last 24 hours' END, NULL,
 CASE WHEN COUNT(*) = 0 THEN 'Medium' ELSE 'Low' END FROM stage_log WHERE StepName = 'StagingLoad' AND Status = 'Success' AND ExecutionDateTime > TIMESTAMP '{GATE_TIME}' - INTERVAL 1 DAY""",
    count_check("Loan", "stg_loan"), count_check("Fraud", "stg_fraud"), count_check("Market", "stg_market"), count_check("Macro", "stg_macro"),
    zero_check("Data Quality", "Future Fraud Dates", "FAIL", "High", f"SELECT COUNT(*) FROM stg_fraud WHERE TransactionDate > TIMESTAMP '{GATE_TIME}'",
               "fraud records with future dates", "No fraud records with future dates"),
    zero_check("Data Quality", "Negative Unemployment Rates", "FAIL", "High", "SELECT COUNT(*) FROM stg_macro WHERE UnemploymentRate < 0",
               "macro records with negative unemployment rates", "No negative unemployment rates found"),
    """SELECT 'Statistical Patterns', 'Fraud Rate', CASE WHEN ABS(c - h) > h * 5.0 / 100 THEN 'WARN' ELSE 'PASS' END,
 CASE WHEN ABS(c - h) > h * 5.0 / 100 THEN 'Current fraud rate (' || FORMAT('{:,.2f}', c) || '%) differs from historical rate (' || FORMAT('{:,.2f}', h) || '%) by more than 5.00%'
  ELSE 'Fraud rate (' || FORMAT('{:,.2f}', c) || '%) within expected range of historical average' END, NULL, CASE WHEN ABS(c - h) > h * 5.0 / 100 THEN 'Medium' ELSE 'Low' END
FROM (SELECT (SELECT COUNT(*) FROM stg_fraud) * CAST(100 AS DOUBLE) / (SELECT COUNT(*) FROM stg_loan) AS c, historical_rate AS h FROM drift)""",
    """SELECT 'Statistical Patterns', 'Unemployment Volatility', CASE WHEN b - a > 5 THEN 'WARN' ELSE 'PASS' END,
 CASE WHEN b - a > 5 THEN 'High unemployment volatility detected: range from ' ELSE 'Unemployment rates within reasonable range: ' END || FORMAT('{:,.2f}', a) || '% to ' || FORMAT('{:,.2f}', b) || '%',
 NULL, CASE WHEN b - a > 5 THEN 'Medium' ELSE 'Low' END FROM (SELECT MIN(UnemploymentRate) AS a, MAX(UnemploymentRate) AS b FROM stg_macro)""",
    zero_check("Data Quality", "Negative Loan Amounts", "FAIL", "High", "SELECT COUNT(*) FROM stg_loan WHERE LoanAmount <= 0",
               "loans with negative or zero amounts", "No loans with negative or zero amounts found"),
    zero_check("Data Quality", "Unusual Interest Rates", "WARN", "Medium", "SELECT COUNT(*) FROM stg_loan WHERE InterestRate > 30 OR InterestRate < 0",
               "loans with interest rates < 0% or > 30%", "All interest rates within reasonable range"),
    zero_check("Referential Integrity", "Orphaned Customer IDs", "WARN", "Medium",
               "SELECT COUNT(DISTINCT CustomerID) FROM stg_fraud WHERE CustomerID NOT IN (SELECT CustomerID FROM stg_loan)",
               "customers in Fraud table not in Loan table", "All Customer IDs have matching records"),
    """SELECT 'Statistical Patterns', 'Loan Amount Distribution', CASE WHEN ABS(a - 200000) > 10000 THEN 'WARN' ELSE 'PASS' END,
 CASE WHEN ABS(a - 200000) > 10000 THEN 'Current average loan amount ($' || FORMAT('{:,.2f}', a) || ') differs from historical average ($200,000.00) by more than 5.00%'
  ELSE 'Average loan amount ($' || FORMAT('{:,.2f}', a) || ') within expected range of historical average' END, NULL, CASE WHEN ABS(a - 200000) > 10000 THEN 'Medium' ELSE 'Low' END
FROM (SELECT AVG(CAST(LoanAmount AS DOUBLE)) AS a FROM stg_loan)""",
])
GATE_CTES = dict(stage_log=STAGE_LOG, drift=DRIFT, gate=GATE)
GATE_ADAPTERS = ("stg_loan", "stg_fraud", "stg_market", "stg_macro", "run_log")


@query("v12_validate_pre_production", ctes("SELECT * FROM gate", *GATE_ADAPTERS, **GATE_CTES))
def v12(t):
    return gate_results(t)


@query("v12_overall_status", ctes("""
SELECT CASE WHEN SUM((Status = 'FAIL')::INT) > 0 THEN 'FAIL' WHEN SUM((Status = 'WARN')::INT) > 0 THEN 'WARN' ELSE 'PASS' END AS Status,
 COUNT(*) FILTER (Status = 'FAIL') AS failed, COUNT(*) FILTER (Status = 'WARN') AS warned, COUNT(*) FILTER (Status = 'PASS') AS passed,
 COALESCE(STRING_AGG(CASE WHEN Status = 'FAIL' THEN ValidationCheck || ': ' || Description END, CHR(13) ORDER BY ValidationCheck), '') AS message FROM gate""",
                                  *GATE_ADAPTERS, **GATE_CTES))
def v12_status(t):
    return gate.overall_status(gate_results(t))


@query("v12_blocking_log", ctes("""
SELECT 'batch-1' AS BatchID, ValidationCategory, ValidationCheck AS DataSource, Description AS ErrorType, Severity, AffectedRows AS ErrorCount,
 CAST(Status = 'FAIL' AND Severity = 'Critical' AS INT) AS IsBlocking FROM gate WHERE Status <> 'PASS'""", *GATE_ADAPTERS, **GATE_CTES))
def v12_log(t):
    return gate.blocking_log(gate_results(t), "batch-1", GATE_TIME).drop("ExecutionDateTime")


@query("v13_fraud_rate_drift", ctes("SELECT ROUND(historical_rate, 6) AS historical_rate FROM drift", "run_log", stage_log=STAGE_LOG, drift=DRIFT))
def v13(t):
    return rounded(V.fraud_rate_drift(stage_log(t), GATE_TIME), "historical_rate")


@query("v14_check_orphans", ctes("SELECT COUNT(DISTINCT CustomerID) AS orphans FROM stg_loan WHERE CustomerID NOT IN (SELECT CustomerID FROM stg_fraud)", "stg_loan", "stg_fraud"))
def v14(t):
    return V.check_orphans(t.stg_loan, t.stg_fraud, "CustomerID")


@query("v15_reconcile_counts", ctes("""
SELECT 'customers' AS "check", (SELECT COUNT(*) FROM customer) AS expected, COUNT(DISTINCT CustomerSK) AS actual,
 CASE WHEN ABS((SELECT COUNT(*) FROM customer) - COUNT(DISTINCT CustomerSK)) > (SELECT COUNT(*) FROM customer) * 0.05 THEN 'Warning' ELSE 'Success' END AS status FROM fact_customer
UNION ALL SELECT 'loans', (SELECT COUNT(*) FROM stg_loan), COUNT(*),
 CASE WHEN ABS((SELECT COUNT(*) FROM stg_loan) - COUNT(*)) > (SELECT COUNT(*) FROM stg_loan) * 0.05 THEN 'Warning' ELSE 'Success' END FROM fact_loan""",
                                    "stg_loan", **STAR, fact_customer=FACT_CUSTOMER, fact_loan=FACT_LOAN))
def v15(t):
    facts = fact_loan(t)
    customers = V.reconcile_counts("customers", t.customer, facts.select("CustomerSK").distinct())
    return customers.unionByName(V.reconcile_counts("loans", t.stg_loan, facts))


# --- profile -------------------------------------------------------------------------------------------------------

def profile_sql(col: str, kind: str, number: bool) -> str:
    num = ([f"ROUND(AVG({col}), 4)", f"ROUND(STDDEV_SAMP({col}), 4)", f"MIN({col})"] + [f"ROUND(QUANTILE_CONT({col}, {p}), 6)" for p in (0.25, 0.5, 0.75)]
           + [f"MAX({col})"]) if number else ["NULL"] * 7
    names = ("mean", "std", '"min"', "p25", "p50", "p75", '"max"')
    nums = ", ".join(f"CAST({e} AS DOUBLE) AS {n}" for e, n in zip(num, names, strict=True))
    text = f"CAST({col} AS VARCHAR)"
    return f"""SELECT '{col}' AS column_name, '{kind}' AS data_type, COUNT({col}) AS "count", COUNT(*) - COUNT({col}) AS nulls,
 ROUND((COUNT(*) - COUNT({col})) * 100.0 / COUNT(*), 6) AS null_pct, {nums}, COUNT(DISTINCT {col}) AS "distinct",
 (SELECT {text} FROM part WHERE {col} IS NOT NULL GROUP BY {text} ORDER BY COUNT(*) DESC, {text} LIMIT 1) AS top,
 (SELECT COUNT(*) FROM part WHERE {col} IS NOT NULL GROUP BY {text} ORDER BY COUNT(*) DESC LIMIT 1) AS freq FROM part"""


PART_COLS = (("p_partkey", "bigint", True), ("p_name", "string", False), ("p_brand", "string", False), ("p_type", "string", False), ("p_size", "int", True),
             ("p_retailprice", "double", True))


@query("v16_profile", "\nUNION ALL ".join(profile_sql(*c) for c in PART_COLS))
def v16(t):
    df = P.profile(t.part)
    return rounded(rounded(df, "mean", "std", digits=4), "null_pct", "p25", "p50", "p75")


def histogram_sql(col: str) -> str:
    return f"""SELECT '{col}' AS column_name, CAST(LEAST(FLOOR(({col} - lo) * bins / (hi - lo)), bins - 1) AS INT) AS bin, COUNT(*) AS n
FROM lineitem CROSS JOIN (SELECT MIN({col}) AS lo, MAX({col}) AS hi, CAST(LEAST(30, COUNT(DISTINCT {col})) AS DOUBLE) AS bins FROM lineitem) GROUP BY 1, 2"""


@query("v17_histograms", "\nUNION ALL ".join(histogram_sql(c) for c in LINE_COLS))
def v17(t):
    return P.histograms(t.lineitem, LINE_COLS).select("column_name", "bin", F.col("n"))


@query("v18_correlation_matrix", "\nUNION ALL ".join(
    f"SELECT '{b}' AS column_a, '{a}' AS column_b, ROUND(CORR({a}, {b}), 6) AS r FROM lineitem"
    for i, a in enumerate(LINE_COLS) for b in LINE_COLS[i + 1:]))
def v18(t):
    return rounded(P.correlation_matrix(t.lineitem, LINE_COLS), "r")


@query("v19_missing_report", ctes("SELECT * FROM (" + " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, ROUND(AVG(CASE WHEN {c} IS NULL THEN 1.0 ELSE 0 END) * 100, 6) AS missing_pct FROM b"
    for c in ("o_orderkey", "o_custkey", "o_totalprice", "o_orderpriority")) + ") WHERE missing_pct > 0", b=BLANKED))
def v19(t):
    return rounded(P.missing_report(blanked(t).withColumn("LastUpdated", F.lit(None).cast("timestamp"))), "missing_pct")


STATE = "CASE MaritalStatus WHEN 'Single' THEN 'NY' WHEN 'Married' THEN 'CA' WHEN 'Divorced' THEN 'TX' ELSE 'FL' END"
# Legal maximum rate in percent by state.
USURY = (("NY", 16.0), ("CA", 12.0), ("TX", 18.0))


@query("v20_usury_check", ctes(f"""
SELECT s AS state, m AS max_rate, SUM((InterestRate > m)::INT)::BIGINT AS violations FROM (SELECT {STATE} AS s, InterestRate FROM stg_loan) l
JOIN (VALUES ('NY', CAST(16 AS DOUBLE)), ('CA', CAST(12 AS DOUBLE)), ('TX', CAST(18 AS DOUBLE))) AS u(state, m) ON u.state = l.s GROUP BY 1, 2""", "stg_loan"))
def v20(t):
    limits = t.spark.createDataFrame(list(USURY), "state string, max_rate double")
    return V.usury_check(t.stg_loan.withColumn("State", F.expr(STATE)), limits)


@query("v21_save_issue_report", ctes("SELECT 'Loan' AS dataset, (SELECT COUNT(*) FROM stg_loan) AS row_count, i.* EXCLUDE (pct) FROM i", "stg_loan", i=tests_sql(
    "stg_loan", ("invalid_credit_scores", "CreditScore", "CreditScore < 300 OR CreditScore > 850", "TRUE"),
    ("high_loan_to_income_ratio", None, "LoanAmount > 10 * AnnualIncome AND AnnualIncome > 0", "TRUE"),
    ("invalid_interest_rates", "InterestRate", "InterestRate < 0 OR InterestRate > 100", "TRUE"))))
def v21(t):
    loans = t.stg_loan
    out = P.save_issue_report(V.check_loan(loans), loans, "Loan", stage_path(t.spark, "issues"))
    return out.drop("pct", "details", "column_count")

