"""Cleaning (P family)."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskmart.operators import clean as C
from riskmart.operators import knn as K
from riskmart.queries.registry import Inputs, ctes, query


@query("p1_dedupe_column_names", "SELECT p_partkey, p_size AS p_partkey_1, p_retailprice AS p_partkey_2, p_brand FROM part")
def p1(t: Inputs):
    raw = t.part.select("p_partkey", "p_size", "p_retailprice", "p_brand")
    return raw.toDF(*C.dedupe_column_names(["p_partkey", "p_partkey", "p_partkey", "p_brand"]))


@query("p2_clean_text", """
SELECT doc_id, CASE WHEN REGEXP_MATCHES(text, '[^\\x20-\\x7E]') THEN NULL ELSE REPLACE(text, '_', '') END AS text,
 CASE WHEN REGEXP_MATCHES(source, '[^\\x20-\\x7E]') THEN NULL ELSE REPLACE(source, '_', '') END AS source FROM documents""")
def p2(t):
    return C.clean_text(t.documents.select("doc_id", "text", "source"))


MESSY = """SELECT o_orderkey, CASE WHEN o_orderkey % 50 = 0 THEN 'n/a' ELSE CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR) END AS price_text,
 CASE WHEN o_orderkey % 3 > 0 THEN 'n/a' ELSE CAST(o_custkey AS VARCHAR) END AS mostly_text, CASE WHEN o_orderkey % 50 = 1 THEN 'n/a' ELSE STRFTIME(o_orderdate, '%Y-%m-%d') END AS order_date,
 CASE WHEN o_orderkey % 3 > 0 THEN 'n/a' ELSE STRFTIME(o_orderdate, '%Y-%m-%d') END AS doubtful_date FROM orders"""


def messy(t):
    n, day = F.col("o_orderkey"), F.date_format("o_orderdate", "yyyy-MM-dd")
    return t.orders.select(
        n, F.when(n % 50 == 0, "n/a").otherwise(F.col("o_totalprice").cast("decimal(18,2)").cast("string")).alias("price_text"),
        F.when(n % 3 > 0, "n/a").otherwise(F.col("o_custkey").cast("string")).alias("mostly_text"),
        F.when(n % 50 == 1, "n/a").otherwise(day).alias("order_date"), F.when(n % 3 > 0, "n/a").otherwise(day).alias("doubtful_date"))


@query("p3_infer_numeric", ctes("SELECT o_orderkey, TRY_CAST(price_text AS DOUBLE) AS price_text, mostly_text FROM messy", messy=MESSY))
def p3(t):
    return C.infer_numeric(messy(t).select("o_orderkey", "price_text", "mostly_text"))


@query("p4_parse_dates", ctes("SELECT o_orderkey, TRY_CAST(order_date AS DATE) AS order_date, doubtful_date FROM messy", messy=MESSY))
def p4(t):
    out = C.parse_dates(messy(t).select("o_orderkey", "order_date", "doubtful_date"))
    return out.withColumn("order_date", F.to_date("order_date"))


@query("p5_parse_durations", """
SELECT p_partkey, CAST((p_size % 9) * 12 + p_partkey % 12 AS BIGINT) AS loan_term_Months, CAST(ROUND_EVEN((p_size % 5) * CAST(7 AS DOUBLE) + p_partkey % 30, 0) AS BIGINT) AS holding_period_Days,
 CASE WHEN p_size % 2 = 0 THEN 'open' ELSE CAST(CAST(ROUND_EVEN(p_size * CAST(0.25 AS DOUBLE), 0) AS BIGINT) AS VARCHAR) END AS history_Months FROM part""")
def p5(t):
    size, n = F.col("p_size"), F.col("p_partkey")
    raw = t.part.select(
        n, F.concat((size % 9).cast("string"), F.lit(" Years and "), (n % 12).cast("string"), F.lit(" Months")).alias("loan_term"),
        F.concat((size % 5).cast("string"), F.lit(" weeks "), (n % 30).cast("string"), F.lit(" days")).alias("holding_period"),
        F.when(size % 2 == 0, "open").otherwise(F.concat(size.cast("string"), F.lit(" wk"))).alias("history"))
    return C.parse_durations(raw)


@query("p8_impute_binary", """
SELECT event_id, CASE WHEN event_id % 4 = 0 THEN CASE WHEN (CAST('0x' || SUBSTR(MD5(event_id || '|flag|7|0'), 1, 13) AS BIGINT) + 0.5::DOUBLE) / POWER(16, 13) < 0.5 THEN 0 ELSE 1 END
 WHEN event_type = 'error' THEN 1 ELSE 0 END AS flag FROM events""")
def p8(t):
    raw = t.events.select("event_id", F.when(F.col("event_id") % 4 != 0, (F.col("event_type") == "error").cast("int")).alias("flag"))
    return C.impute_binary(raw, ["event_id"], 7, ["flag"])


@query("p9_zscore_normalize", """
SELECT event_id, ROUND((v - m) / s, 6) AS skewed_value, event_id % 100 AS even_value FROM (SELECT event_id, EXP(value / 30) AS v FROM events)
CROSS JOIN (SELECT AVG(EXP(value / 30)) AS m, STDDEV_SAMP(EXP(value / 30)) AS s FROM events)""")
def p9(t):
    raw = t.events.select("event_id", F.exp(F.col("value") / 30).alias("skewed_value"), (F.col("event_id") % 100).alias("even_value"))
    return C.zscore_normalize(raw).withColumn("skewed_value", F.round("skewed_value", 6))


@query("p10_round_numeric", "SELECT p_partkey, ROUND_EVEN(p_retailprice * 1.125::DOUBLE, 1) AS price FROM part")
def p10(t):
    return C.round_numeric(t.part.select("p_partkey", (F.col("p_retailprice") * 1.125).alias("price")), 1)


@query("p11_float_to_int", """
SELECT o_orderkey, CAST(CASE WHEN o_orderkey % 10 = 0 THEN 0 ELSE o_custkey END AS BIGINT) AS whole, CAST(TRUNC(o_totalprice) AS BIGINT) AS item_count, o_totalprice AS price FROM orders""")
def p11(t):
    raw = t.orders.select("o_orderkey", F.when(F.col("o_orderkey") % 10 != 0, F.col("o_custkey").cast("double")).alias("whole"),
                          F.col("o_totalprice").alias("item_count"), F.col("o_totalprice").alias("price"))
    return C.float_to_int(raw)


@query("p12_drop_redundant_columns", "SELECT l_orderkey, l_partkey, l_quantity, l_discount, l_tax * 2 AS kept_copy, l_tax FROM lineitem")
def p12(t):
    raw = t.lineitem.select(
        "l_orderkey", "l_partkey", "l_quantity", (F.col("l_quantity") * 3 + 1).alias("scaled"), "l_discount", F.coalesce("l_discount", F.lit(0.0)).alias("same"),
        (F.col("l_tax") * 2).alias("kept_copy"), "l_tax", F.lit(5).alias("constant_a"), F.lit(5).alias("constant_b"))
    out = C.drop_redundant_columns(raw, keep=["kept_copy", "l_orderkey", "l_partkey"])
    return out.drop("constant_a")


@query("p13_binarize", """
SELECT o_orderkey, CAST(CASE WHEN LOWER(o_orderstatus) = 'p' THEN 1 ELSE 0 END AS INT) AS o_orderstatus, o_orderpriority,
 CASE WHEN o_orderkey % 3 = 0 THEN 'left' ELSE 'right' END AS side, CAST(CASE WHEN o_orderkey % 4 = 1 THEN 1 ELSE 0 END AS INT) AS answer FROM orders""")
def p13(t):
    n = F.col("o_orderkey")
    return C.binarize(t.orders.select(n, "o_orderstatus", "o_orderpriority", F.when(n % 3 == 0, "left").otherwise("right").alias("side"),
                                      F.when(n % 4 == 0, None).when(n % 4 == 1, "Yes").when(n % 4 == 2, "").otherwise("No").alias("answer")))


SEGMENTS = ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY")


@query("p14_one_hot", "SELECT c_custkey, c_name, " + ", ".join(
    f"CAST(CASE WHEN c_mktsegment = '{s}' THEN 1 ELSE 0 END AS INT) AS \"c_mktsegment_{s}\"" for s in SEGMENTS) + " FROM customer")
def p14(t):
    return C.one_hot(t.customer.select("c_custkey", "c_name", "c_mktsegment"))


LISTED = """
SELECT o_orderkey, o_custkey, CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE CASE o_custkey % 4 WHEN 0 THEN 'Auto Loan, Student Loan, and Home Loan' WHEN 1 THEN 'Personal Loan and Auto Loan' WHEN 2 THEN 'Not Specified' ELSE 'Home Loan, Auto Loan, Auto Loan, Travel Loan' END END AS kind,
 CASE WHEN o_orderstatus = 'P' THEN o_totalprice ELSE 0 END AS "AutoLoanBalance", CASE WHEN o_orderpriority = '1-URGENT' THEN 5 ELSE -1 END AS "StudentLoanBalance" FROM orders"""
SPREAD = """
WITH listed AS ({listed}),
 claims AS (SELECT *, CASE WHEN StudentLoanBalance > 0 THEN 'Student' WHEN AutoLoanBalance > 0 THEN 'Auto' END AS own FROM listed),
 owners AS (SELECT o_custkey, COUNT(*) AS size, MIN_BY(kind, o_orderkey) FILTER (kind IS NOT NULL) AS txt, SUM((own = 'Auto')::INT) AS ca, SUM((own = 'Student')::INT) AS cs,
  MAX((AutoLoanBalance > 0)::INT) AS aa, MAX((StudentLoanBalance > 0)::INT) AS an FROM claims GROUP BY o_custkey),
 lists AS (SELECT *, LIST_FILTER(LIST_TRANSFORM(LIST_FILTER(LIST_TRANSFORM(STRING_SPLIT(REPLACE(COALESCE(txt, ''), ' and ', ', '), ','), lambda p: TRIM(p)), lambda p: p <> ''), lambda p: CASE WHEN p = 'and' THEN p ELSE TRIM(REPLACE(p, ' Loan', '')) END),
   lambda p: LOWER(p) <> 'not specified') AS parts FROM owners),
 full_lists AS (SELECT *, CASE WHEN LEN(parts) > 0 THEN parts ELSE LIST_FILTER([CASE WHEN aa = 1 THEN 'Auto' END, CASE WHEN an = 1 THEN 'Student' END], lambda p: p IS NOT NULL) END AS items FROM lists),
 exploded AS (SELECT o_custkey, size, items, UNNEST(items) AS item, GENERATE_SUBSCRIPTS(items, 1) AS pos, ca, cs FROM full_lists),
 numbered AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY o_custkey, item ORDER BY pos) AS nth FROM exploded),
 leftover AS (SELECT o_custkey, item, ROW_NUMBER() OVER (PARTITION BY o_custkey ORDER BY pos) AS slot FROM numbered
  WHERE nth > CASE item WHEN 'Auto' THEN COALESCE(ca, 0) WHEN 'Student' THEN COALESCE(cs, 0) ELSE 0 END),
 ranked AS (SELECT c.*, f.size, ROW_NUMBER() OVER (PARTITION BY c.o_custkey, c.own ORDER BY c.o_orderkey) AS nth, LEN(LIST_FILTER(f.items, lambda p: p = c.own)) AS offered FROM claims c JOIN full_lists f USING (o_custkey)),
 marked AS (SELECT *, COALESCE(own IS NOT NULL AND nth <= offered, FALSE) AS takes FROM ranked),
 slots AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY o_custkey, takes ORDER BY o_orderkey) AS slot FROM marked)
SELECT s.o_orderkey, s.o_custkey, CASE WHEN s.size = 1 THEN s.kind WHEN takes THEN own ELSE COALESCE(l.item, 'Not Specified') END AS kind
FROM slots s LEFT JOIN leftover l ON l.o_custkey = s.o_custkey AND l.slot = s.slot AND NOT s.takes"""


@query("p15_split_multivalue", SPREAD.format(listed=LISTED))
def p15(t):
    n, c = F.col("o_orderkey"), F.col("o_custkey") % 4
    text = (F.when(c == 0, "Auto Loan, Student Loan, and Home Loan").when(c == 1, "Personal Loan and Auto Loan").when(c == 2, "Not Specified")
            .otherwise("Home Loan, Auto Loan, Auto Loan, Travel Loan"))
    raw = t.orders.select(
        n, "o_custkey", F.when(n % 3 != 0, text).alias("kind"), F.when(F.col("o_orderstatus") == "P", F.col("o_totalprice")).otherwise(0.0).alias("AutoLoanBalance"),
        F.when(F.col("o_orderpriority") == "1-URGENT", 5).otherwise(-1).alias("StudentLoanBalance"))
    return C.split_multivalue(raw, "kind", "o_custkey", ["o_orderkey"], unwanted=["loan"]).select("o_orderkey", "o_custkey", "kind")


@query("p16_common_words", r"""
WITH w AS (SELECT word, COUNT(*) AS n FROM (SELECT UNNEST(STRING_SPLIT(TRANSLATE(LOWER(text), '-_/' || CHR(9) || CHR(10) || CHR(11) || CHR(12) || CHR(13), '        '), ' ')) AS word FROM documents) WHERE word <> '' GROUP BY word),
 f AS (SELECT n, ROW_NUMBER() OVER (ORDER BY n) - 1 AS i, COUNT(*) OVER () AS k FROM w),
 s AS (SELECT (MAX(n) FILTER (i = (k - 1) // 2) + MAX(n) FILTER (i = k // 2)) / 2.0 AS med, MAX(n) FILTER (i = CAST(FLOOR(k * 0.95) AS BIGINT)) AS up FROM f)
SELECT word, n FROM w CROSS JOIN s WHERE n >= GREATEST(2, FLOOR(med + (up - med) * 0.5)) AND LENGTH(word) > 3""")
def p16(t):
    return C.common_words(t.documents, "text")


BLANKS = """SELECT RowKey, CustomerID, CASE WHEN RowKey % 9 = 0 THEN '' WHEN RowKey % 7 = 0 THEN NULL ELSE MaritalStatus END AS MaritalStatus,
 CASE WHEN CustomerID % 5 = 0 THEN NULL ELSE HomeOwnershipStatus END AS HomeOwnershipStatus, CASE WHEN RowKey % 4 = 0 THEN NULL ELSE LoanID END AS LoanID FROM stg_loan"""


def filled_sql(c: str, mode: bool) -> str:
    fallback = f", (SELECT {c} FROM b WHERE TRIM({c}) <> '' GROUP BY {c} ORDER BY COUNT(*) DESC, {c} LIMIT 1)" if mode else ""
    return f"COALESCE(NULLIF(TRIM(b.{c}), ''), (f.{c}){fallback}) AS {c}"


@query("p17_fill_categorical", ctes(f"""
SELECT b.RowKey, b.CustomerID, {filled_sql('MaritalStatus', True)}, {filled_sql('HomeOwnershipStatus', True)}, {filled_sql('LoanID', False)} FROM b
LEFT JOIN (SELECT CustomerID, MIN_BY(MaritalStatus, RowKey) FILTER (TRIM(MaritalStatus) <> '') AS MaritalStatus, MIN_BY(HomeOwnershipStatus, RowKey) FILTER (TRIM(HomeOwnershipStatus) <> '') AS HomeOwnershipStatus,
 MIN_BY(LoanID, RowKey) FILTER (TRIM(LoanID) <> '') AS LoanID FROM b GROUP BY CustomerID) f ON f.CustomerID = b.CustomerID""", "stg_loan", b=BLANKS))
def p17(t):
    n = F.col("RowKey")
    raw = t.stg_loan.select(
        "RowKey", "CustomerID", F.when(n % 9 == 0, "").when(n % 7 == 0, None).otherwise(F.col("MaritalStatus")).alias("MaritalStatus"),
        F.when(F.col("CustomerID") % 5 != 0, F.col("HomeOwnershipStatus")).alias("HomeOwnershipStatus"), F.when(n % 4 != 0, F.col("LoanID")).alias("LoanID"))
    return C.fill_categorical(raw, "CustomerID", ["RowKey"])


@query("p18_cleanup", """
WITH raw AS (SELECT o_custkey % 50 AS k, CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE o_orderstatus END AS a, CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE o_orderpriority END AS b,
 CASE WHEN o_orderkey % 5 > 0 OR o_custkey % 10 > 0 THEN NULL ELSE 'seldom' END AS c, CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE 1 END AS d FROM orders)
SELECT DISTINCT k, a, b, d FROM (SELECT DISTINCT * FROM raw WHERE (k IS NOT NULL)::INT + (a IS NOT NULL)::INT + (b IS NOT NULL)::INT + (c IS NOT NULL)::INT + (d IS NOT NULL)::INT >= 2)""")
def p18(t):
    n = F.col("o_orderkey")
    raw = t.orders.select(
        (F.col("o_custkey") % 50).alias("k"), F.when(n % 3 != 0, F.col("o_orderstatus")).alias("a"), F.when(n % 3 != 0, F.col("o_orderpriority")).alias("b"),
        F.when((n % 5 == 0) & (F.col("o_custkey") % 10 == 0), "seldom").alias("c"), F.when(n % 3 != 0, 1).alias("d"))
    return C.cleanup(raw).distinct()


# --- neighbours ----------------------------------------------------------------------------------------------------

HOLES = """SELECT o_orderkey, CASE WHEN o_orderkey % 20 = 0 THEN NULL ELSE o_totalprice / 1000 END AS a, CASE WHEN o_orderkey % 25 = 1 THEN NULL ELSE CAST(o_custkey % 100 AS DOUBLE) END AS b,
 CASE WHEN o_orderkey % 30 < 2 THEN NULL ELSE CAST(DATE_DIFF('day', TIMESTAMP '1995-01-01', o_orderdate) AS DOUBLE) END AS c FROM orders"""
FEATURES = ("a", "b", "c")


def nearest_sql(target: str, k: str) -> str:
    """Brute force over distinct rows."""
    total = " + ".join(f"COALESCE((q.{f} - d.{f}) * (q.{f} - d.{f}), 0)" for f in FEATURES)
    both = " + ".join(f"(q.{f} IS NOT NULL AND d.{f} IS NOT NULL)::INT" for f in FEATURES)
    same = " AND ".join(f"q.{f} IS NOT DISTINCT FROM r.{f}" for f in FEATURES)
    return f"""SELECT {', '.join('q.' + f for f in FEATURES)}, AVG(v) AS v FROM (
 SELECT q.*, d.{target} AS v, ROW_NUMBER() OVER (PARTITION BY {', '.join('q.' + f for f in FEATURES)} ORDER BY SQRT(({total}) * 3 / ({both})), d.{target}) AS rn
 FROM (SELECT DISTINCT {', '.join(FEATURES)} FROM h WHERE {target} IS NULL) q JOIN h d ON d.{target} IS NOT NULL AND ({both}) > 0) q WHERE rn <= {k} GROUP BY ALL""".replace("{same}", same)


def filled(target: str) -> str:
    same = " AND ".join(f"n{target}.{f} IS NOT DISTINCT FROM h.{f}" for f in FEATURES)
    return f"LEFT JOIN n{target} ON {same}"


@query("p7_knn_impute", ctes(f"""
SELECT h.o_orderkey, ROUND(COALESCE(h.a, na.v, (SELECT AVG(a) FROM h)), 6) AS a, ROUND(COALESCE(h.b, nb.v, (SELECT AVG(b) FROM h)), 6) AS b, ROUND(COALESCE(h.c, nc.v, (SELECT AVG(c) FROM h)), 6) AS c
FROM h {filled('a')} {filled('b')} {filled('c')}""", h=HOLES, na=nearest_sql("a", "5"), nb=nearest_sql("b", "5"), nc=nearest_sql("c", "5")))
def p7(t):
    n = F.col("o_orderkey")
    raw = t.orders.select(
        n, F.when(n % 20 != 0, F.col("o_totalprice") / 1000).alias("a"), F.when(n % 25 != 1, (F.col("o_custkey") % 100).cast("double")).alias("b"),
        F.when(n % 30 >= 2, F.date_diff("o_orderdate", F.lit("1995-01-01").cast("date")).cast("double")).alias("c"))
    out = K.knn_impute(raw, FEATURES, FEATURES, 5)
    return out.withColumns({f: F.round(f, 6) for f in FEATURES})


RAW_CUSTOMER = """SELECT c_custkey, CASE WHEN c_custkey % 5 = 0 THEN NULL ELSE c_acctbal END AS balance, CASE WHEN c_custkey % 7 = 1 THEN NULL ELSE c_acctbal / 10 + c_nationkey END AS related,
 c_nationkey AS nation, CASE WHEN c_custkey % 6 = 0 THEN NULL WHEN c_mktsegment = 'BUILDING' THEN 1 ELSE 0 END AS flag FROM customer"""
PLACES = 3


def near_customer(target: str, other: str) -> str:
    return f"""SELECT c_custkey, AVG(v) AS v FROM (SELECT q.c_custkey, d.{target} AS v, ROW_NUMBER() OVER (PARTITION BY q.c_custkey ORDER BY ABS(q.{other} - d.{other}), d.{target}) AS rn
 FROM r q JOIN r d ON q.{target} IS NULL AND d.{target} IS NOT NULL AND q.{other} IS NOT NULL AND d.{other} IS NOT NULL) WHERE rn <= {PLACES} GROUP BY c_custkey"""


@query("p6_impute_numeric", ctes(f"""
SELECT r.c_custkey, ROUND(COALESCE(r.balance, a.v, (SELECT AVG(balance) FROM r)), 4) AS balance, ROUND(COALESCE(r.related, b.v, (SELECT AVG(related) FROM r)), 4) AS related, r.nation,
 CAST(COALESCE(r.flag, CASE WHEN (CAST('0x' || SUBSTR(MD5(r.c_custkey || '|flag|7|0'), 1, 13) AS BIGINT) + 0.5::DOUBLE) / POWER(16, 13) < 0.5 THEN 0 ELSE 1 END) AS INT) AS flag
FROM r LEFT JOIN na a ON a.c_custkey = r.c_custkey LEFT JOIN nb b ON b.c_custkey = r.c_custkey""", r=RAW_CUSTOMER, na=near_customer("balance", "related"), nb=near_customer("related", "balance")))
def p6(t):
    n = F.col("c_custkey")
    raw = t.customer.select(
        n, F.when(n % 5 != 0, F.col("c_acctbal")).when(n % 10 == 0, F.lit(float("inf"))).alias("balance"), F.when(n % 7 != 1, F.col("c_acctbal") / 10 + F.col("c_nationkey")).alias("related"),
        F.col("c_nationkey").alias("nation"), F.when(n % 6 != 0, (F.col("c_mktsegment") == "BUILDING").cast("int")).alias("flag"))
    out = K.impute_numeric(raw, ["c_custkey"], PLACES, seed=7)
    return out.withColumns({"balance": F.round("balance", 4), "related": F.round("related", 4)})
