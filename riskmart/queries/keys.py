"""Keys, upserts and versioned dimensions (K family)."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskmart.adapters import AS_OF
from riskmart.operators import keys as K
from riskmart.operators import scd
from riskmart.operators.snapshot import KeyedTable
from riskmart.plans import marts
from riskmart.queries.load import DATE_DIM
from riskmart.queries.registry import Inputs, ctes, query
from riskmart.session import stage_path
from riskmart.sources.date_dim import build_date_dim

FIRST_LOAD = "2023-06-30"
NEW_IDS = 1_000_000_000_000

CUSTOMER_ATTRS = "Age, EmploymentStatus, JobTitle, HomeOwnershipStatus, MaritalStatus, PreviousLoanDefault"
DIM_CUSTOMER = f"""
SELECT ROW_NUMBER() OVER (ORDER BY CustomerID) AS CustomerSK, *, CAST(1 AS INT) AS IsCurrent, DATE '{FIRST_LOAD}' AS effective_start,
 CAST(NULL AS DATE) AS effective_end FROM (SELECT DISTINCT CustomerID, {CUSTOMER_ATTRS} FROM stg_loan)"""
BATCH = f"""
SELECT CustomerID, Age, EmploymentStatus, CASE WHEN CustomerID % 13 = 0 THEN NULL ELSE JobTitle END AS JobTitle, HomeOwnershipStatus,
 CASE WHEN CustomerID % 7 = 0 THEN 'Separated' ELSE MaritalStatus END AS MaritalStatus, PreviousLoanDefault
FROM dim_customer WHERE JobTitle <> 'MACHINERY'
UNION ALL SELECT CustomerID + {NEW_IDS}, {CUSTOMER_ATTRS} FROM dim_customer WHERE JobTitle = 'BUILDING'"""
CHANGED = " OR ".join(f"d.{c.strip()} IS DISTINCT FROM b.{c.strip()}" for c in CUSTOMER_ATTRS.split(","))
DIM_CUSTOMER_2 = f"""
SELECT d.* REPLACE (CASE WHEN b.CustomerID IS NOT NULL AND ({CHANGED}) THEN 0 ELSE 1 END AS IsCurrent,
 CASE WHEN b.CustomerID IS NOT NULL AND ({CHANGED}) THEN DATE '{AS_OF}' END AS effective_end)
FROM dim_customer d LEFT JOIN batch b ON b.CustomerID = d.CustomerID
UNION ALL
SELECT (SELECT MAX(CustomerSK) FROM dim_customer) + ROW_NUMBER() OVER (ORDER BY b.CustomerID), b.*, 1, DATE '{AS_OF}', NULL
FROM batch b LEFT JOIN dim_customer d ON b.CustomerID = d.CustomerID WHERE d.CustomerID IS NULL OR {CHANGED}"""


def dim_customer(t: Inputs):
    return scd.scd2_start(t.stg_loan, "CustomerID", marts.TRACKED, FIRST_LOAD, "CustomerSK", ["LoanDate", "LoanID"])


def batch(dim):
    """Second delivery: some attributes changed, one segment missing, one segment registered again under new ids."""
    n = F.col("CustomerID")
    known = dim.filter("JobTitle <> 'MACHINERY'").select(
        n, "Age", "EmploymentStatus", F.when(n % 13 == 0, None).otherwise(F.col("JobTitle")).alias("JobTitle"),
        "HomeOwnershipStatus", F.when(n % 7 == 0, "Separated").otherwise(F.col("MaritalStatus")).alias("MaritalStatus"),
        "PreviousLoanDefault")
    fresh = dim.filter("JobTitle = 'BUILDING'").select(
        (n + NEW_IDS).alias("CustomerID"), "Age", "EmploymentStatus", "JobTitle", "HomeOwnershipStatus", "MaritalStatus",
        "PreviousLoanDefault")
    return known.unionByName(fresh)


def dim_customer_2(t: Inputs):
    first = dim_customer(t)
    return scd.scd2_apply(first, batch(first), "CustomerID", marts.TRACKED, AS_OF, "CustomerSK")


@query("k1_dense_key", "SELECT c_custkey, c_name, ROW_NUMBER() OVER (ORDER BY c_custkey) AS CustomerSK FROM customer")
def k1(t):
    return K.dense_key(t.customer.select("c_custkey", "c_name"), ["c_custkey"], "CustomerSK")


@query("k1_dense_key_many_columns", """
SELECT o_orderkey, ROW_NUMBER() OVER (ORDER BY o_orderpriority, o_orderdate DESC, o_orderkey) + 99 AS rank_id FROM orders""")
def k1_many(t):
    df = t.orders.select("o_orderkey", "o_orderpriority", "o_orderdate")
    return K.dense_key(df, ["o_orderpriority", F.col("o_orderdate").desc(), "o_orderkey"], "rank_id", 100).select("o_orderkey", "rank_id")


@query("k1_rank_within", """
SELECT event_id, event_type, ROW_NUMBER() OVER (PARTITION BY event_type ORDER BY ts, event_id) AS rank_id FROM events""")
def k1_rank(t):
    return K.rank_within(t.events.select("event_id", "event_type", "ts"), ["event_type"], ["ts", "event_id"], "rank_id").drop("ts")


@query("k2_natural_key_hash", """
SELECT o_orderkey, MD5(CAST(o_custkey AS VARCHAR) || '|' || CAST(CAST(o_orderdate AS DATE) AS VARCHAR) || '|' || o_orderpriority) AS key_hash FROM orders""")
def k2(t):
    return t.orders.select("o_orderkey", K.natural_key_hash(["o_custkey", F.to_date("o_orderdate"), "o_orderpriority"]).alias("key_hash"))


OLD_ORDERS = "SELECT o_orderkey, o_orderstatus, o_totalprice, o_orderpriority FROM orders WHERE o_orderdate < TIMESTAMP '2000-01-01'"
NEW_ORDERS = """SELECT o_orderkey, 'X' AS o_orderstatus, o_totalprice * 2 AS o_totalprice, 'changed' AS o_orderpriority FROM orders
 WHERE o_orderdate >= TIMESTAMP '1998-01-01'"""


@query("k3_upsert", ctes("""
SELECT COALESCE(t.o_orderkey, s.o_orderkey) AS o_orderkey, COALESCE(s.o_orderstatus, t.o_orderstatus) AS o_orderstatus,
 COALESCE(s.o_totalprice, t.o_totalprice) AS o_totalprice, COALESCE(t.o_orderpriority, s.o_orderpriority) AS o_orderpriority
FROM t FULL JOIN s ON t.o_orderkey = s.o_orderkey""", t=OLD_ORDERS, s=NEW_ORDERS))
def k3(t):
    o = t.orders
    cols = ["o_orderkey", "o_orderstatus", "o_totalprice", "o_orderpriority"]
    old = o.filter(F.col("o_orderdate") < "2000-01-01").select(*cols)
    new = o.filter(F.col("o_orderdate") >= "1998-01-01").select(
        "o_orderkey", F.lit("X").alias("o_orderstatus"), (F.col("o_totalprice") * 2).alias("o_totalprice"), F.lit("changed").alias("o_orderpriority"))
    return K.upsert(old, new, ["o_orderkey"], ["o_orderstatus", "o_totalprice"])


@query("k3_snapshot_merge", ctes("""
SELECT COALESCE(t.o_orderkey, s.o_orderkey) AS o_orderkey, COALESCE(t.o_orderdate, s.o_orderdate) AS o_orderdate, COALESCE(s.o_orderstatus, t.o_orderstatus) AS o_orderstatus,
 COALESCE(s.o_totalprice, t.o_totalprice) AS o_totalprice, COALESCE(t.o_orderpriority, s.o_orderpriority) AS o_orderpriority
FROM t FULL JOIN s ON t.o_orderkey = s.o_orderkey AND t.o_orderdate = s.o_orderdate""",
    t=OLD_ORDERS.replace("o_orderkey,", "o_orderkey, o_orderdate,"), s=NEW_ORDERS.replace("o_orderkey,", "o_orderkey, o_orderdate,")))
def k3_snapshot(t):
    """Orders kept by month; a batch of the later months is merged into a second version."""
    o = t.orders
    cols = ["o_orderkey", "o_orderdate", "o_orderstatus", "o_totalprice", "o_orderpriority"]
    store = KeyedTable(t.spark, stage_path(t.spark, "orders"), ["o_orderkey", "o_orderdate"], [F.date_format("o_orderdate", "yyyyMM")], 2)
    store.create(o.filter(F.col("o_orderdate") < "2000-01-01").select(*cols))
    return store.merge(o.filter(F.col("o_orderdate") >= "1998-01-01").select(
        "o_orderkey", "o_orderdate", F.lit("X").alias("o_orderstatus"), (F.col("o_totalprice") * 2).alias("o_totalprice"), F.lit("changed").alias("o_orderpriority")),
        ["o_orderstatus", "o_totalprice"])


@query("k4_insert_missing", """
WITH have AS (SELECT ROW_NUMBER() OVER (ORDER BY p_brand) AS BrandID, p_brand FROM (SELECT DISTINCT p_brand FROM part WHERE p_size < 3)),
 seen AS (SELECT MIN(b) AS p_brand FROM (SELECT ' ' || LOWER(p_brand) || ' ' AS b FROM part) GROUP BY UPPER(TRIM(b)))
SELECT * FROM have UNION ALL
SELECT (SELECT MAX(BrandID) FROM have) + ROW_NUMBER() OVER (ORDER BY p_brand), p_brand FROM seen
WHERE UPPER(TRIM(p_brand)) NOT IN (SELECT UPPER(TRIM(p_brand)) FROM have)""")
def k4(t):
    have = K.dense_key(t.part.filter("p_size < 3").select("p_brand").distinct(), ["p_brand"], "BrandID").select("BrandID", "p_brand")
    seen = t.part.select(F.concat(F.lit(" "), F.lower("p_brand"), F.lit(" ")).alias("p_brand")).distinct()
    return K.insert_missing(have, seen, ["p_brand"], "BrandID", lambda c: F.upper(F.trim(c)))


@query("k5_scd2_apply", ctes("SELECT * FROM dim2", "stg_loan", dim_customer=DIM_CUSTOMER, batch=BATCH, dim2=DIM_CUSTOMER_2))
def k5(t):
    return dim_customer_2(t)


THREE = " OR ".join(f"d.{c} IS DISTINCT FROM b.{c}" for c in ("EmploymentStatus", "HomeOwnershipStatus", "MaritalStatus"))


@query("k5_update_customer", ctes(DIM_CUSTOMER_2.replace(CHANGED, THREE), "stg_loan", dim_customer=DIM_CUSTOMER, batch=BATCH))
def k5_update(t):
    """Three attributes decide whether there is a new version, which then takes all attributes of the batch."""
    first = dim_customer(t)
    return scd.scd2_apply(first, batch(first), "CustomerID", ["EmploymentStatus", "HomeOwnershipStatus", "MaritalStatus"], AS_OF,
                          "CustomerSK", attributes=marts.TRACKED)


@query("k6_scd2_as_of", ctes("""
SELECT CustomerSK, CustomerID, MaritalStatus, JobTitle, 'before' AS state FROM dim2
WHERE effective_start <= DATE '2024-01-29' AND (effective_end IS NULL OR DATE '2024-01-29' < effective_end)
UNION ALL SELECT CustomerSK, CustomerID, MaritalStatus, JobTitle, 'after' FROM dim2
WHERE effective_start <= DATE '2024-01-30' AND (effective_end IS NULL OR DATE '2024-01-30' < effective_end)""",
                             "stg_loan", dim_customer=DIM_CUSTOMER, batch=BATCH, dim2=DIM_CUSTOMER_2))
def k6(t):
    dim = dim_customer_2(t)
    cols = ["CustomerSK", "CustomerID", "MaritalStatus", "JobTitle"]
    before = scd.scd2_as_of(dim, "2024-01-29").select(*cols, F.lit("before").alias("state"))
    return before.unionAll(scd.scd2_as_of(dim, "2024-01-30").select(*cols, F.lit("after").alias("state")))


TXN_TYPES = "SELECT ROW_NUMBER() OVER (ORDER BY TransactionTypeName) AS TransactionTypeID, TransactionTypeName FROM (SELECT DISTINCT TransactionTypeName FROM stg_fraud)"
DIM_TXN = """
SELECT f.TransactionID, d.DateID AS TransactionDateID, tt.TransactionTypeID FROM stg_fraud f
JOIN dates d ON CAST(f.TransactionDate AS DATE) = d.FullDate JOIN txn_types tt ON tt.TransactionTypeName = f.TransactionTypeName"""
DIM_ACCOUNT = """
SELECT ROW_NUMBER() OVER (ORDER BY AccountID) AS AccountSK, CustomerSK, AccountID, AccountType
FROM (SELECT DISTINCT AccountID, AccountType, c.CustomerSK FROM stg_loan l JOIN dim_customer c ON c.CustomerID = l.CustomerID AND c.IsCurrent = 1)"""


def dates(t):
    return build_date_dim(t.spark, "2015-01-01", "2030-12-31")


def txn_types(t):
    return marts.small_dim(t.stg_fraud, "TransactionTypeName", "TransactionTypeID")


def dim_transaction(t):
    return marts.load_dim_transaction(t.stg_fraud, txn_types(t), dates(t))


@query("k7_load_dim_transaction", ctes("SELECT * FROM dim_txn", "stg_fraud", dates=DATE_DIM, txn_types=TXN_TYPES, dim_txn=DIM_TXN))
def k7_txn(t):
    return dim_transaction(t)


@query("k7_load_dim_account", ctes("SELECT * FROM dim_account", "stg_loan", dim_customer=DIM_CUSTOMER, dim_account=DIM_ACCOUNT))
def k7_account(t):
    return marts.load_dim_account(t.stg_loan, dim_customer(t))
