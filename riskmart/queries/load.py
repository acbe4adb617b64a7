"""Scans, sinks and calendar (L family)."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskmart.queries.registry import Inputs, ctes, query
from riskmart.session import stage_path
from riskmart.sources import date_dim, files, staging

ORDERS_SCHEMA = ("o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
                 "o_orderdate timestamp, o_orderpriority string")
ORDERS_SQL = "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, CAST(o_orderdate AS DATE) AS o_orderdate, o_orderpriority FROM orders"


def _orders(df):
    return df.withColumn("o_orderdate", F.to_date("o_orderdate"))


@query("l1_read_source", ORDERS_SQL)
def l1(t: Inputs):
    return _orders(files.read_source(t.spark, t.path("orders")))


@query("l7_write_output_csv", ORDERS_SQL)
def l7(t):
    path = stage_path(t.spark, "orders_cooked")
    files.write_output(t.orders, path, "csv")
    return _orders(files.read_source(t.spark, path, "csv", ORDERS_SCHEMA))


@query("l7_write_output_json", ORDERS_SQL)
def l7_json(t):
    path = stage_path(t.spark, "orders_cooked")
    files.write_output(t.orders, path, "json")
    return _orders(files.read_source(t.spark, path, "json", ORDERS_SCHEMA))


RAW_SCHEMA = T.StructType([
    T.StructField("o_orderkey", T.LongType(), False), T.StructField("o_totalprice", T.DecimalType(18, 2)),
    T.StructField("o_orderdate", T.DateType()), T.StructField("paid", T.BooleanType()),
    T.StructField("o_orderpriority", T.StringType()),
])


def raw_orders(t: Inputs):
    """Orders as text, with unreadable values in between."""
    n = F.col("o_orderkey")
    return t.orders.select(
        n.cast("string").alias("o_orderkey"),
        F.when(n % 50 == 0, "n/a").when(n % 51 == 0, "").otherwise(F.col("o_totalprice").cast("decimal(18,2)").cast("string")).alias("o_totalprice"),
        F.when(n % 50 == 1, "n/a").otherwise(F.date_format("o_orderdate", "yyyy-MM-dd")).alias("o_orderdate"),
        F.when(n % 50 == 2, "perhaps").when(F.col("o_orderstatus") == "F", " YES ").when(F.col("o_orderstatus") == "O", "off").otherwise("t").alias("paid"),
        "o_orderpriority",
        F.lit("x").alias("unknown_column"),
    )


@query("l2_coerce_staging", """
SELECT o_orderkey, CASE WHEN o_orderkey % 50 = 0 OR o_orderkey % 51 = 0 THEN NULL ELSE CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS DOUBLE) END AS o_totalprice,
 CASE WHEN o_orderkey % 50 = 1 THEN NULL ELSE CAST(o_orderdate AS DATE) END AS o_orderdate,
 CAST(CASE WHEN o_orderkey % 50 = 2 THEN NULL WHEN o_orderstatus = 'O' THEN 0 ELSE 1 END AS INT) AS paid, o_orderpriority FROM orders""")
def l2(t):
    df = staging.coerce_staging(raw_orders(t), RAW_SCHEMA)
    return df.withColumn("o_totalprice", F.col("o_totalprice").cast("double"))


@query("l2_staging_rejects", """
SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, 'o_totalprice' AS column_name, 'n/a' AS raw_value FROM orders WHERE o_orderkey % 50 = 0
UNION ALL SELECT CAST(o_orderkey AS VARCHAR), 'o_orderdate', 'n/a' FROM orders WHERE o_orderkey % 50 = 1
UNION ALL SELECT CAST(o_orderkey AS VARCHAR), 'paid', 'perhaps' FROM orders WHERE o_orderkey % 50 = 2""")
def l2_rejects(t):
    return staging.staging_rejects(raw_orders(t), RAW_SCHEMA, ["o_orderkey"])


@query("l3_load_typed_csv", """
SELECT o_orderkey, CAST(o_totalprice AS DOUBLE) AS o_totalprice, CAST(o_orderdate AS DATE) AS o_orderdate FROM orders
WHERE o_orderkey % 50 NOT IN (0, 1)""")
def l3(t):
    path = stage_path(t.spark, "typed")
    raw = raw_orders(t).select("o_orderkey", F.when(F.col("o_totalprice") != "n/a", F.lit(None)).otherwise("n/a").alias("_bad"), "o_orderdate")
    price = t.orders.select(F.col("o_orderkey").cast("string").alias("o_orderkey"), F.col("o_totalprice").cast("string").alias("_price"))
    lines = raw.join(price, "o_orderkey").select("o_orderkey", F.coalesce("_bad", "_price").alias("o_totalprice"), "o_orderdate")
    files.write_output(lines, path, "csv")
    schema = T.StructType.fromDDL("o_orderkey bigint, o_totalprice double, o_orderdate date")
    good, _ = files.load_typed_csv(t.spark, path, schema, max_errors=t.orders.count() // 20)
    return good


@query("l4_reload_table", """
SELECT 'customer' AS table_name, COUNT(*) AS row_count FROM customer UNION ALL SELECT 'orders', COUNT(*) FROM orders
UNION ALL SELECT 'part', COUNT(*) FROM part UNION ALL SELECT 'events', COUNT(*) FROM events""")
def l4(t):
    names = ("customer", "orders", "part", "events")
    _, counts = files.reload_tables({n: getattr(t, n) for n in names}, stage_path(t.spark, "reload"), "batch-1", names)
    return counts


@query("l5_zip_sources", """
SELECT a.o_orderkey, a.o_totalprice, b.p_partkey, b.p_retailprice
FROM (SELECT *, ROW_NUMBER() OVER (ORDER BY o_orderkey) AS rn FROM orders) a
FULL JOIN (SELECT *, ROW_NUMBER() OVER (ORDER BY p_partkey) AS rn FROM part) b ON a.rn = b.rn""")
def l5(t):
    return files.zip_sources(
        [t.orders.select("o_orderkey", "o_totalprice"), t.part.select("p_partkey", "p_retailprice")],
        [["o_orderkey"], ["p_partkey"]])


@query("l6_with_row_index", "SELECT event_id, ts, ROW_NUMBER() OVER (ORDER BY ts, event_id) - 1 AS row_index FROM events")
def l6(t):
    return files.with_row_index(t.events.select("event_id", "ts"), ["ts", "event_id"], "row_index")


@query("l8_checkpoint_step", "SELECT p_brand, COUNT(*) AS parts, ROUND(SUM(p_retailprice), 2) AS price FROM part GROUP BY p_brand")
def l8(t):
    kept = files.checkpoint_step(t.part.select("p_brand", "p_retailprice"), "part_step")
    return kept.groupBy("p_brand").agg(F.count("*").alias("parts"), F.round(F.sum("p_retailprice"), 2).alias("price"))


@query("l9_add_lineage", """
SELECT c_custkey, 'batch-1' AS LoadBatchID, CAST(TIMESTAMP '2024-01-30 06:00:00' AS DATE) AS LoadDate,
 CAST(NULL AS DATE) AS LastUpdated FROM customer""")
def l9(t):
    df = files.add_lineage(t.customer.select("c_custkey"), "batch-1", "2024-01-30 06:00:00")
    return df.withColumns({"LoadDate": F.to_date("LoadDate"), "LastUpdated": F.to_date("LastUpdated")})


DATE_DIM = """
SELECT CAST(EXTRACT(YEAR FROM d) * 10000 + EXTRACT(MONTH FROM d) * 100 + EXTRACT(DAY FROM d) AS INT) AS DateID, d AS FullDate,
 CAST(EXTRACT(DAY FROM d) AS INT) AS DayOfMonth, STRFTIME(d, '%A') AS DayName, CAST(DAYOFWEEK(d) + 1 AS INT) AS DayOfWeek,
 CAST(DAYOFYEAR(d) AS INT) AS DayOfYear,
 CAST(FLOOR((DAYOFYEAR(d) + DAYOFWEEK(DATE_TRUNC('year', d)) - 1) / 7.0) + 1 AS INT) AS WeekOfYear,
 CAST(EXTRACT(MONTH FROM d) AS INT) AS MonthNumber, STRFTIME(d, '%B') AS MonthName, CAST(EXTRACT(QUARTER FROM d) AS INT) AS Quarter,
 CAST(EXTRACT(YEAR FROM d) AS INT) AS Year, CAST(CASE WHEN DAYOFWEEK(d) IN (0, 6) THEN 1 ELSE 0 END AS INT) AS IsWeekend,
 CAST(CASE WHEN STRFTIME(d, '%m-%d') IN ('01-01', '07-04', '12-25') THEN 1 ELSE 0 END AS INT) AS IsHoliday,
 CASE STRFTIME(d, '%m-%d') WHEN '01-01' THEN 'New Year''s Day' WHEN '07-04' THEN 'Independence Day' WHEN '12-25' THEN 'Christmas Day' END AS HolidayName,
 CAST(CASE WHEN DAYOFWEEK(d) NOT IN (0, 6) AND STRFTIME(d, '%m-%d') NOT IN ('01-01', '07-04', '12-25') THEN 1 ELSE 0 END AS INT) AS IsBusinessDay
FROM (SELECT CAST(UNNEST(GENERATE_SERIES(DATE '1999-01-01', DATE '2030-12-31', INTERVAL 1 DAY)) AS DATE) AS d)"""


@query("l10_build_date_dim", ctes("""
SELECT d.DateID, d.FullDate, d.DayName, d.DayOfWeek, d.DayOfYear, d.WeekOfYear, d.MonthName, d.Quarter, d.IsWeekend, d.IsHoliday, d.HolidayName,
 d.IsBusinessDay, COUNT(*) AS loans
FROM stg_loan l JOIN dates d ON l.LoanDate = d.FullDate GROUP BY ALL""", "stg_loan", dates=DATE_DIM))
def l10(t):
    """Loans per calendar day with the attributes of the day."""
    dim = date_dim.build_date_dim(t.spark)
    cols = ["DateID", "FullDate", "DayName", "DayOfWeek", "DayOfYear", "WeekOfYear", "MonthName", "Quarter", "IsWeekend",
            "IsHoliday", "HolidayName", "IsBusinessDay"]
    per_day = t.stg_loan.groupBy("LoanDate").agg(F.count("*").alias("loans"))
    return per_day.join(dim, F.col("LoanDate") == F.col("FullDate")).select(*cols, "loans")


@query("l11_date_key", """
SELECT o_orderkey, CAST(EXTRACT(YEAR FROM o_orderdate) * 10000 + EXTRACT(MONTH FROM o_orderdate) * 100 + EXTRACT(DAY FROM o_orderdate) AS INT) AS DateID
FROM orders""")
def l11(t):
    dim = date_dim.build_date_dim(t.spark, "1999-01-01", "2030-12-31")
    return date_dim.date_key(t.orders.select("o_orderkey", "o_orderdate"), "o_orderdate", dim).select("o_orderkey", "DateID")
