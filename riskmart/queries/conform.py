"""Schema mapping and conformance (M family)."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskmart.operators import conform as M
from riskmart.queries.registry import ctes, query
from riskmart.schemas import LOAN, MACRO

CUSTOMER_TARGET = T.StructType([
    T.StructField("CustomerID", T.LongType()), T.StructField("CustomerName", T.VarcharType(12)), T.StructField("Balance", T.DecimalType(18, 2)),
    T.StructField("Segment", T.VarcharType(50)), T.StructField("CreditScore", T.IntegerType()), T.StructField("LoadBatchID", T.StringType()),
])
CUSTOMER_MAPPING = {"CustomerID": "C_CustKey", "CustomerName": "c_name", "Balance": "c_acctbal", "Segment": "c_mktsegment", "CreditScore": "c_score"}


@query("m1_map_to_schema", """
SELECT c_custkey AS CustomerID, LEFT(c_name, 12) AS CustomerName, c_acctbal AS Balance, c_mktsegment AS Segment, CAST(NULL AS INT) AS CreditScore, 'CreditScore' AS missing FROM customer""")
def m1(t):
    out, absent = M.map_to_schema(t.customer, CUSTOMER_TARGET, CUSTOMER_MAPPING)
    return out.withColumns({"Balance": F.col("Balance").cast("double"), "missing": F.lit(",".join(absent))})


@query("m2_ids_to_int", "SELECT p_partkey, DENSE_RANK() OVER (ORDER BY p_brand) AS p_brand FROM part")
def m2(t):
    return M.ids_to_int(t.part.select("p_partkey", "p_brand"), ["p_brand"])


@query("m2_shared_dictionary", """
WITH o AS (SELECT o_orderkey, o_orderpriority, o_clerk, CASE WHEN o_orderkey % 5 > 0 THEN o_clerk END AS some_clerk, o_custkey FROM (
  SELECT o_orderkey, o_orderpriority, o_orderstatus || '-' || o_custkey AS o_clerk, o_custkey FROM orders))
SELECT o_orderkey, DENSE_RANK() OVER (ORDER BY o_orderpriority) AS o_orderpriority, DENSE_RANK() OVER (ORDER BY o_clerk) AS o_clerk,
 CASE WHEN some_clerk IS NULL THEN 0 ELSE DENSE_RANK() OVER (ORDER BY some_clerk NULLS LAST) END AS some_clerk, DENSE_RANK() OVER (ORDER BY o_custkey) AS o_custkey FROM o""")
def m2_shared(t):
    clerk = F.concat_ws("-", "o_orderstatus", F.col("o_custkey").cast("string"))
    raw = t.orders.select("o_orderkey", "o_orderpriority", clerk.alias("o_clerk"), F.when(F.col("o_orderkey") % 5 > 0, clerk).alias("some_clerk"), "o_custkey")
    return M.ids_to_int(raw, ["o_orderpriority", "o_clerk", "some_clerk", "o_custkey"])


@query("m3_convert_type", """
SELECT o_orderkey, CASE WHEN o_orderkey % 7 = 0 THEN '' ELSE LEFT(o_orderpriority, 4) END AS short_text, CASE WHEN o_orderkey % 5 = 0 THEN 0 ELSE CAST(TRUNC(o_totalprice) AS BIGINT) END AS whole,
 CASE WHEN o_orderkey % 5 = 0 THEN 0 ELSE o_totalprice END AS money, CASE WHEN o_orderkey % 11 = 0 THEN DATE '2024-01-30' ELSE CAST(o_orderdate AS DATE) END AS day,
 o_orderstatus = 'F' OR o_orderstatus = 'P' AS flag, CAST(EXTRACT(YEAR FROM o_orderdate) || '-01-01' AS DATE) AS year_start FROM orders""")
def m3(t):
    n = F.col("o_orderkey")
    raw = t.orders.select(
        n, F.when(n % 7 != 0, F.col("o_orderpriority")).alias("short_text"), F.when(n % 5 == 0, "bad").otherwise(F.col("o_totalprice").cast("string")).alias("price"),
        F.when(n % 11 == 0, "never").otherwise(F.date_format("o_orderdate", "yyyy-MM-dd")).alias("day"),
        F.when(F.col("o_orderstatus") == "F", "Enabled").when(F.col("o_orderstatus") == "O", "off").otherwise("maybe").alias("flag"),
        F.year("o_orderdate").cast("string").alias("report_date"))
    return raw.select(
        n, M.convert_type(raw, "short_text", T.VarcharType(4)).alias("short_text"), M.convert_type(raw, "price", T.LongType()).alias("whole"),
        M.convert_type(raw, "price", T.DecimalType(18, 2)).cast("double").alias("money"), M.convert_type(raw, "day", T.DateType(), "2024-01-30").alias("day"),
        M.convert_type(raw, "flag", T.BooleanType()).alias("flag"), M.convert_type(raw, "report_date", T.DateType()).alias("year_start"))


TWICE = """SELECT ReportDate, CountryName, UnemploymentRate, GDP, 1 AS part FROM stg_macro
 UNION ALL SELECT ReportDate, CountryName, UnemploymentRate + 100, GDP + 0.4, 2 FROM stg_macro"""


@query("m4_conform_constraints_macro", ctes("""
SELECT ReportDate, CountryName, ROUND(UnemploymentRate, 2) AS UnemploymentRate, CAST(ROUND(GDP) AS BIGINT) AS GDP, CAST(part AS INT) AS part FROM x WHERE part = 1""", "stg_macro", x=TWICE))
def m4_macro(t):
    first = t.stg_macro.select("ReportDate", "CountryName", "UnemploymentRate", F.col("GDP").cast("double").alias("GDP"), F.lit(1).alias("part"))
    second = first.withColumns({"UnemploymentRate": F.col("UnemploymentRate") + 100, "GDP": F.col("GDP") + 0.4, "part": F.lit(2)})
    return M.conform_constraints(first.unionByName(second), "Macro", MACRO, ["part"])


@query("m4_conform_constraints_loan", ctes("""
SELECT LoanID, LEAST(GREATEST(ROUND(InterestRate, 2), 0), 30) AS InterestRate, CAST(Balance AS DOUBLE) AS Balance FROM stg_loan""", "stg_loan"))
def m4_loan(t):
    return M.conform_constraints(t.stg_loan.select("LoanID", "InterestRate", "Balance"), "Loan", LOAN)


@query("m5_suffix_duplicate_ids", ctes("""
SELECT RowKey, CASE WHEN rn = 0 THEN AccountID ELSE AccountID || '_' || CASE WHEN rn < 10 THEN '0' ELSE '' END || rn END AS AccountID
FROM (SELECT RowKey, AccountID, ROW_NUMBER() OVER (PARTITION BY AccountID ORDER BY RowKey) - 1 AS rn FROM stg_loan)""", "stg_loan"))
def m5(t):
    return M.suffix_duplicate_ids(t.stg_loan.select("RowKey", "AccountID"), "AccountID", ["RowKey"])


@query("m6_aggregate_customer_snapshot", ctes("""
SELECT CustomerID, LoanDate, CAST(SUM(TotalAssets) AS DOUBLE) AS TotalAssets, ROUND(AVG(DebtToIncomeRatio), 6) AS DebtToIncomeRatio, MAX(CreditScore) AS CreditScore,
 MIN_BY(LoanID, RowKey) AS LoanID, MIN_BY(PaymentStatus, RowKey) AS PaymentStatus FROM stg_loan GROUP BY CustomerID, LoanDate""", "stg_loan"))
def m6(t):
    df = t.stg_loan.select("CustomerID", "LoanDate", "RowKey", "TotalAssets", "DebtToIncomeRatio", "CreditScore", "LoanID", "PaymentStatus")
    out = M.aggregate_customer_snapshot(df, "CustomerID", "LoanDate", ["RowKey"]).drop("RowKey")
    return out.withColumns({"TotalAssets": F.col("TotalAssets").cast("double"), "DebtToIncomeRatio": F.round("DebtToIncomeRatio", 6)})
