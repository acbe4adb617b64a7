"""Generated columns (G family)."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskmart.adapters import AS_OF
from riskmart.operators import generate as G
from riskmart.queries.registry import Inputs, ctes, query

SEED = 7


def u(key: str, name: str, draw: int = 0) -> str:
    """Uniform number of a key in SQL."""
    return f"((CAST('0x' || SUBSTR(MD5({key} || '|{name}|{SEED}|{draw}'), 1, 13) AS BIGINT) + CAST(0.5 AS DOUBLE)) / POWER(16, 13))"


def z(key: str, name: str) -> str:
    return f"(SQRT(-2 * LN({u(key, name, 1)})) * COS(CAST(6.283185307179586 AS DOUBLE) * {u(key, name, 2)}))"


def beta(key: str, name: str) -> str:
    return "LIST_SORT([" + ", ".join(u(key, name, d) for d in range(1, 7)) + "])[2]"


def pick(key: str, name: str, values, draw: int = 0) -> str:
    listed = ", ".join(f"'{v}'" for v in values)
    return f"([{listed}])[CAST(FLOOR({u(key, name, draw)} * {len(values)}) AS INT) + 1]"


TABLE_COLUMNS = {
    "orders": ("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"),
    "customer": ("c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"),
    "events": ("event_id", "ts", "user_id", "event_type", "value", "props"),
}
COLUMN_DOMAINS = {
    "o_orderkey": "id", "o_custkey": "id", "o_orderstatus": "status", "o_totalprice": "price", "o_orderdate": "date", "o_orderpriority": "generic",
    "c_custkey": "id", "c_name": "person", "c_nationkey": "id", "c_acctbal": "generic", "c_mktsegment": "category",
    "event_id": "id", "ts": "generic", "user_id": "person", "event_type": "category", "value": "price", "props": "generic",
}


@query("g1_infer_domain", "\nUNION ALL ".join(
    f"SELECT '{t}' AS table_name, '{c}' AS column_name, '{COLUMN_DOMAINS[c]}' AS domain, COUNT({c}) AS n FROM {t}" for t, cols in TABLE_COLUMNS.items() for c in cols))
def g1(t: Inputs):
    """Number of values per column with the domain its name suggests."""
    out = None
    for name, cols in TABLE_COLUMNS.items():
        row = getattr(t, name).agg(*[F.count(c).alias(c) for c in cols])
        part = row.select(F.inline(F.array(*[F.struct(
            F.lit(name).alias("table_name"), F.lit(c).alias("column_name"), F.lit(G.infer_domain(c)).alias("domain"), F.col(c).alias("n")) for c in cols])))
        out = part if out is None else out.unionByName(part)
    return out


K = "CAST(o_orderkey AS VARCHAR)"


@query("g2_gen_column", f"""
SELECT o_orderkey, {pick(K, 'PaymentStatus', G.CHOICES['status'])} AS PaymentStatus, {pick(K, 'AccountClass', G.CHOICES['category'])} AS AccountClass,
 {pick(K, 'CustomerName', G.FIRST_NAMES, 1)} || ' ' || {pick(K, 'CustomerName', G.LAST_NAMES, 2)} AS CustomerName,
 CAST(FLOOR(EXP(10 + {z(K, 'TradeVolume')})) AS BIGINT) AS TradeVolume, CAST(GREATEST(1, CEIL(LN({u(K, 'NumCards')}) / LN(CAST(0.8 AS DOUBLE)))) AS BIGINT) AS NumCards,
 CAST(ROUND_EVEN(GREATEST(1, LEAST(10, 5 + 2 * {z(K, 'RiskScore')})), 0) AS BIGINT) AS RiskScore, CAST(FLOOR({u(K, 'Quota')} * 999) + 1 AS BIGINT) AS Quota,
 ROUND_EVEN(EXP(6 + 1.2::DOUBLE * {z(K, 'FeeAmount')}), 2) AS FeeAmount, ROUND_EVEN({beta(K, 'UsageRatio')}, 2) AS UsageRatio, ROUND({beta(K, 'InterestRate')} * 29 + 1, 4) AS InterestRate,
 ROUND_EVEN(ABS(0.05::DOUBLE + 0.02::DOUBLE * {z(K, 'Volatility')}), 2) AS Volatility FROM orders""")
def g2(t):
    key = ["o_orderkey"]
    spec = {"PaymentStatus": T.StringType(), "AccountClass": T.StringType(), "CustomerName": T.StringType(), "TradeVolume": T.LongType(), "NumCards": T.LongType(),
            "RiskScore": T.LongType(), "Quota": T.LongType(), "FeeAmount": T.DoubleType(), "UsageRatio": T.DoubleType(), "InterestRate": T.DoubleType(), "Volatility": T.DoubleType()}
    out = t.orders.select("o_orderkey", *[G.gen_column(n, k, key, SEED).alias(n) for n, k in spec.items()])
    return out.withColumn("InterestRate", F.round("InterestRate", 4))


@query("g2_gen_ids", f"""
SELECT o_orderkey, 'ACC' || CAST(99999 + ROW_NUMBER() OVER (ORDER BY MD5({K} || '|AccountID|{SEED}|0'), o_orderkey) AS VARCHAR) AS AccountID FROM orders""")
def g2_ids(t):
    return G.gen_ids(t.orders.select("o_orderkey"), "AccountID", ["o_orderkey"], SEED, "ACC")


DAY = f"DATE '{AS_OF}'"


@query("g3_gen_dates", f"""
SELECT o_orderkey, {DAY} - CAST(LEAST(FLOOR(-180 * LN({u(K, 'LoanDate')})), 730) AS INT) AS LoanDate, {DAY} + CAST(FLOOR({u(K, 'Maturity')} * 3285) + 365 AS INT) AS Maturity,
 LAST_DAY(CAST({DAY} - 1825 + TO_MONTHS(CAST(FLOOR({u(K, 'ReportPeriod')} * 60) AS INT)) AS DATE)) AS ReportPeriod, {DAY} - 1825 + CAST(FLOOR({u(K, 'Opened')} * 1825) AS INT) AS Opened FROM orders""")
def g3(t):
    return t.orders.select("o_orderkey", *[G.gen_dates(n, ["o_orderkey"], AS_OF, SEED).alias(n) for n in ("LoanDate", "Maturity", "ReportPeriod", "Opened")])


HOUR = u(K, "TransactionDate", 11)
HOUR_SQL = "CASE " + " ".join(f"WHEN {HOUR} < {round(sum(w for _, w in G.TRADING_HOURS[:i + 1]), 10)} THEN {h}" for i, (h, _) in enumerate(G.TRADING_HOURS)) + " ELSE 16 END"


@query("g3_gen_timestamps", f"""
SELECT o_orderkey, CAST({HOUR_SQL} AS INT) AS hour, CAST(FLOOR({u(K, 'TransactionDate', 12)} * 60) AS INT) AS minute,
 {DAY} - CAST(LEAST(FLOOR(-180 * LN({u(K, 'TransactionDate')})), 730) AS INT) AS day FROM orders""")
def g3_time(t):
    out = t.orders.select("o_orderkey", G.gen_dates("TransactionDate", ["o_orderkey"], AS_OF, SEED, with_time=True).alias("ts"))
    return out.select("o_orderkey", F.hour("ts").alias("hour"), F.minute("ts").alias("minute"), F.to_date("ts").alias("day"))


@query("g4_gen_bool", f"""
SELECT o_orderkey, {u(K, 'IsActive')} < 0.8 AS IsActive, {u(K, 'HasFailed')} < 0.1 AS HasFailed, {u(K, 'Verified')} < 0.4 AS Verified, {u(K, 'Other')} < 0.5 AS Other FROM orders""")
def g4(t):
    return t.orders.select("o_orderkey", *[G.gen_bool(n, ["o_orderkey"], SEED).alias(n) for n in ("IsActive", "HasFailed", "Verified", "Other")])


@query("g5_borrow_ids", f"""
WITH ids AS (SELECT c_custkey, ROW_NUMBER() OVER (ORDER BY MD5(CAST(c_custkey AS VARCHAR) || '|CustomerID|{SEED}|0'), c_custkey) - 1 AS slot, COUNT(*) OVER () AS m FROM customer),
 numbered AS (SELECT event_id, ROW_NUMBER() OVER (ORDER BY MD5(CAST(event_id AS VARCHAR) || '|CustomerID|{SEED}|1'), event_id) - 1 AS n FROM events)
SELECT e.event_id, i.c_custkey AS CustomerID FROM numbered e JOIN ids i ON i.slot = e.n % i.m""")
def g5(t):
    return G.borrow_ids(t.events.select("event_id"), t.customer, "CustomerID", ["event_id"], SEED, "c_custkey")


@query("g6_relate_columns", ctes("""
SELECT MarketDate, MarketName, ROUND(LEAST(GREATEST(h, OpenValue, CloseValue), m + m * 0.1::DOUBLE), 6) AS HighestValue, ROUND(GREATEST(LEAST(l, OpenValue, CloseValue), m - m * 0.1::DOUBLE), 6) AS LowestValue,
 ROUND_EVEN((ChangePercent - a) / (b - a), 2) AS ChangePercent, ROUND_EVEN(InterestRate, 2) AS InterestRate
FROM (SELECT *, (h + l + OpenValue + CloseValue) / 4 AS m FROM (SELECT MarketDate, MarketName, OpenValue, CloseValue, InterestRate, CloseValue - OpenValue AS ChangePercent,
 GREATEST(HighestValue, LowestValue) AS h, LEAST(HighestValue, LowestValue) AS l FROM stg_market)) CROSS JOIN (SELECT MIN(CloseValue - OpenValue) AS a, MAX(CloseValue - OpenValue) AS b FROM stg_market)""", "stg_market"))
def g6(t):
    raw = t.stg_market.withColumn("ChangePercent", F.col("CloseValue") - F.col("OpenValue"))
    out = G.relate_columns(raw, ["MarketDate", "MarketName"], SEED)
    return out.select("MarketDate", "MarketName", F.round("HighestValue", 6).alias("HighestValue"), F.round("LowestValue", 6).alias("LowestValue"), "ChangePercent", "InterestRate")


TERMS = "SELECT RowKey, (RowKey * 37 % 1000) / 1000::DOUBLE AS x FROM stg_loan"


@query("g6_loan_terms", ctes("SELECT RowKey, CAST(CASE " + " ".join(
    f"WHEN x <= (SELECT QUANTILE_CONT(x, {i}::DOUBLE / 7) FROM s) THEN {term}" for i, term in enumerate(G.LOAN_TERMS[:-1], 1)) + " ELSE 60 END AS INT) AS LoanDurationMonths FROM s", "stg_loan", s=TERMS))
def g6_terms(t):
    return G.loan_terms(t.stg_loan.select("RowKey", ((F.col("RowKey") * 37 % 1000) / F.lit(1000.0)).alias("LoanDurationMonths")))


@query("g7_amortized_payment", ctes("""
SELECT LoanID, ROUND_EVEN(CASE WHEN r > 0 THEN a * r * POWER(1 + r, n) / (POWER(1 + r, n) - 1) ELSE a / n END, 2) AS MonthlyPayment
FROM (SELECT LoanID, CAST(LoanAmount AS DOUBLE) AS a, InterestRate / 100 / 12 AS r, LoanDurationMonths AS n FROM stg_loan)""", "stg_loan"))
def g7(t):
    loans = t.stg_loan.drop("MonthlyPayment")
    return G.amortized_payment(loans).select("LoanID", "MonthlyPayment")
