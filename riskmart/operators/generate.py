"""Columns the source does not have, as deterministic functions of a row key, and relations between them."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskmart.functions.expr import attach_stats, round_even
from riskmart.functions.stats import quantiles
from riskmart.functions.uniform import between, beta_2_5, choice, digest, normal, uniform
from riskmart.operators.keys import dense_key

# Domain -> words in a column name, first match wins.
DOMAINS = {
    "price": ("price", "amount", "cost", "value", "fee", "balance"),
    "percentage": ("rate", "percent", "ratio", "yield", "return", "interest", "discount"),
    "currency": ("currency", "curr", "iso_code"),
    "transaction": ("transaction",),
    "market": ("market", "exchange", "index", "ticker", "symbol"),
    "stock": ("open", "close", "high", "low", "volume", "adj"),
    "volatility": ("volatility", "deviation", "var", "risk"),
    "risk": ("risk", "score", "rating", "grade", "level"),
    "probability": ("probability", "likelihood", "chance"),
    "status": ("status", "state", "flag", "indicator"),
    "date": ("date", "time", "day", "month", "year", "quarter"),
    "person": ("name", "customer", "client", "user", "person"),
    "contact": ("email", "phone", "address", "contact"),
    "id": ("id", "key", "code", "number", "no", "uuid", "guid"),
    "category": ("category", "type", "class", "group", "segment"),
}
# Texts drawn per domain.
CHOICES = {
    "currency": ("USD",),
    "market": ("NASDAQ",),
    "status": ("On Time", "Late", "Defaulted"),
    "category": ("Corporate", "Personal", "Checking", "Savings", "Investment", "Fund"),
    "transaction": ("Deposit", "Withdrawal", "Transfer", "Payment", "Refund"),
}
FIRST_NAMES = ("John", "Emma", "Michael", "Sophia", "William", "Olivia", "James", "Ava", "Robert", "Isabella")
LAST_NAMES = ("Smith", "Johnson", "Williams", "Jones", "Brown", "Davis", "Miller", "Wilson", "Taylor", "Anderson")
# Probability of true by words in the name, hours of transactions with their weight, loan terms.
TRUE_SHARE = ((("active", "valid", "available"), 0.8), (("deleted", "failed", "error"), 0.1), (("verified", "premium"), 0.4))
TRADING_HOURS = ((9, 0.10), (10, 0.15), (11, 0.15), (12, 0.20), (13, 0.15), (14, 0.10), (15, 0.10), (16, 0.05))
LOAN_TERMS = (3, 6, 12, 24, 36, 48, 60)
PRICES = ("OpenValue", "CloseValue", "HighestValue", "LowestValue")


def infer_domain(name: str) -> str:
    """Domain of a column by the words in its name."""
    low = name.lower()
    return next((d for d, parts in DOMAINS.items() if any(p in low for p in parts)), "generic")


def _text(name: str, domain: str, key: Sequence[str], seed: int, length: int) -> Column:
    if domain in CHOICES:
        return choice(key, name, seed, CHOICES[domain])
    if domain == "id":
        return F.concat(F.lit(name[:3].upper()), between(key, name, seed, 100000, 999999).cast("string"))
    if domain == "person":
        last = choice(key, name, seed, LAST_NAMES, 2)
        return last if length < 15 else F.concat_ws(" ", choice(key, name, seed, FIRST_NAMES, 1), last)
    code = digest(key, name, seed, 1)
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

    def letter(alphabet: str, i: int) -> Column:
        at = F.conv(F.substring(code, 2 * i + 1, 2), 16, 10).cast("int") % 26
        return F.substring(F.lit(alphabet), at + 1, F.lit(1))

    word = F.concat(letter(upper, 0), *[letter(lower, i) for i in range(1, 10)])
    return F.substring(word, F.lit(1), F.least(F.lit(length), between(key, name, seed, 3, 10) + 1).cast("int"))


def _whole(name: str, domain: str, key: Sequence[str], seed: int) -> Column:
    low = name.lower()
    if domain == "stock" and "volume" in low:
        return F.floor(F.exp(10 + normal(key, name, seed)))
    if any(w in low for w in ("count", "num", "qty")):
        return F.greatest(F.lit(1), F.ceil(F.log(uniform(key, name, seed)) / F.log(F.lit(0.8))))
    if domain == "risk" or "score" in low:
        if "percent" in low:
            return F.floor(F.greatest(F.lit(0.0), F.least(F.lit(100.0), 70 + 15 * normal(key, name, seed))))
        return F.rint(F.greatest(F.lit(1.0), F.least(F.lit(10.0), 5 + 2 * normal(key, name, seed))))
    return between(key, name, seed, 1, 1000)


def _fraction(name: str, domain: str, key: Sequence[str], seed: int, scale: int) -> Column:
    low = name.lower()
    if any(w in low for w in ("ratio", "rate", "percent")):
        scale = min(scale, 2)
    if name == "GDP":
        return between(key, name, seed, 100000, 10000000).cast("double")
    high = F.exp(4 + 0.5 * normal(key, "highest", seed))
    if domain == "price":
        out = F.exp(4 + 0.5 * normal(key, name, seed)) if "price" in low else F.exp(6 + 1.2 * normal(key, name, seed))
    elif domain == "stock" and "high" in low:
        out = high
    elif domain == "stock" and "low" in low:
        # One to fifteen percent below the row's high.
        out = high * (1 - (0.01 + 0.14 * uniform(key, name, seed)))
    elif "interestrate" in low:
        return beta_2_5(key, name, seed) * 29 + 1
    elif domain == "percentage":
        out = beta_2_5(key, name, seed) * (1 if "ratio" in low else 100)
    elif domain in ("risk", "volatility"):
        out = F.abs(0.05 + 0.02 * normal(key, name, seed))
    else:
        out = uniform(key, name, seed) * 100
    return round_even(out, scale)


def gen_dates(name: str, key: Sequence[str], as_of, seed: int = 0, with_time: bool = False) -> Column:
    """Date (or timestamp) of a kind that the name suggests, relative to ``as_of``."""
    low, day = name.lower(), F.lit(as_of).cast("date")
    if any(w in low for w in ("date", "created", "transaction")):
        back = F.least(F.floor(-180 * F.log(uniform(key, name, seed))), F.lit(730)).cast("int")
        out = F.date_sub(day, back)
    elif any(w in low for w in ("maturity", "expiry", "due")):
        out = F.date_add(day, between(key, name, seed, 365, 3650).cast("int"))
    elif "report" in low or "as_of" in low:
        out = F.last_day(F.add_months(F.date_sub(day, 365 * 5), between(key, name, seed, 0, 60).cast("int")))
    else:
        out = F.date_sub(day, (365 * 5 - between(key, name, seed, 0, 365 * 5)).cast("int"))
    if not with_time:
        return out
    if "transaction" in low or "timestamp" in low:
        u, hour, reach = uniform(key, name, seed, 11), F.lit(TRADING_HOURS[-1][0]), 1.0
        for h, weight in reversed(TRADING_HOURS):
            reach -= weight
            hour = F.when(u < round(reach + weight, 10), h).otherwise(hour)
    else:
        hour = between(key, name, seed, 0, 24, 11)
    seconds = hour * 3600 + between(key, name, seed, 0, 60, 12) * 60 + between(key, name, seed, 0, 60, 13)
    return F.timestamp_seconds(F.unix_date(out) * 86400 + seconds)


def gen_bool(name: str, key: Sequence[str], seed: int = 0) -> Column:
    """True with a probability that the name suggests."""
    low = name.lower()
    share = next((p for parts, p in TRUE_SHARE if any(w in low for w in parts)), 0.2 if infer_domain(name) == "flag" else 0.5)
    return uniform(key, name, seed) < share


def gen_column(name: str, to: T.DataType, key: Sequence[str], seed: int = 0, as_of=None) -> Column:
    """Expression for a missing column from its name and type; ``key`` identifies the row."""
    domain = infer_domain(name)
    if isinstance(to, T.VarcharType):
        return _text(name, domain, key, seed, to.length)
    if isinstance(to, T.StringType):
        return _text(name, domain, key, seed, 50)
    if isinstance(to, T.IntegralType):
        return _whole(name, domain, key, seed).cast(to)
    if isinstance(to, T.DecimalType):
        return _fraction(name, domain, key, seed, to.scale).cast(to)
    if isinstance(to, (T.DoubleType, T.FloatType)):
        return _fraction(name, domain, key, seed, 2).cast(to)
    if isinstance(to, T.DateType):
        return gen_dates(name, key, as_of, seed)
    if isinstance(to, T.TimestampType):
        return gen_dates(name, key, as_of, seed, with_time=True)
    if isinstance(to, T.BooleanType):
        return gen_bool(name, key, seed)
    raise TypeError(f"cannot generate {to.simpleString()}")


def _is_account(name: str) -> bool:
    return name == "AccountID" or (name.lower().endswith("id") and "account" in name.lower())


def gen_ids(df: DataFrame, name: str, key: Sequence[str], seed: int = 0, prefix: str | None = None, start: int = 100000) -> DataFrame:
    """Unique ids: dense numbers in hash order of the rows, as text with a prefix (``ACC100000``) or as integers."""
    ordered = df.drop(name).withColumn("_h", digest(key, name, seed))
    out = dense_key(ordered, ["_h", *key], name, start).drop("_h")
    return out.withColumn(name, F.concat(F.lit(prefix), F.col(name).cast("string"))) if prefix else out


def borrow_ids(df: DataFrame, donor: DataFrame, col: str, key: Sequence[str], seed: int = 0, donor_col: str | None = None) -> DataFrame:
    """Fill a foreign key with ids of another table, each about equally often; every id at most once if there are enough.

    Both sides are numbered in hash order and meet in an equi-join on the number modulo the count of ids, so no id and no
    row is special.
    """
    ids = donor.select(F.col(donor_col or col).alias("_id")).distinct().filter("_id is not null")
    ids = dense_key(ids.withColumn("_h", digest(["_id"], col, seed)), ["_h", "_id"], "_slot", 0).select("_id", "_slot")
    rows = dense_key(df.drop(col).withColumn("_h", digest(key, col, seed, 1)), ["_h", *key], "_n", 0).drop("_h")
    size = ids.agg(F.count("*").alias("_m"))
    rows = attach_stats(rows, size).withColumn("_slot", F.when(F.col("_m") > 0, F.pmod("_n", F.when(F.col("_m") > 0, F.col("_m")).otherwise(1))))
    return rows.join(ids, "_slot", "left").withColumnRenamed("_id", col).drop("_slot", "_n", "_m")


def generate_missing(df: DataFrame, schema: T.StructType, absent: Sequence[str], key: Sequence[str], seed: int = 0, as_of=None,
                     donors: dict[str, DataFrame] | None = None) -> DataFrame:
    """Fill the columns named in ``absent``: borrowed ids, unique ids, then all the others as expressions."""
    donors = donors or {}
    plain = {}
    for f in schema.fields:
        if f.name not in absent:
            continue
        if f.name in donors:
            df = borrow_ids(df, donors[f.name], f.name, key, seed)
        elif isinstance(f.dataType, (T.StringType, T.VarcharType)) and _is_account(f.name):
            df = gen_ids(df, f.name, key, seed, "ACC")
        elif isinstance(f.dataType, T.IntegralType) and (infer_domain(f.name) == "id" or f.name.lower().endswith("id")):
            df = gen_ids(df, f.name, key, seed, start=1000)
        else:
            plain[f.name] = gen_column(f.name, f.dataType, key, seed, as_of)
    return df.withColumns(plain)


# --- relations -----------------------------------------------------------------------------------------------------

def relate_prices(df: DataFrame) -> DataFrame:
    """High at or above open and close, low at or below them, both within 10 % of the mean of the four prices."""
    v = {c: F.col(c).cast("double") for c in PRICES}
    high, low = F.greatest(v["HighestValue"], v["LowestValue"]), F.least(v["HighestValue"], v["LowestValue"])
    mean = (high + low + v["OpenValue"] + v["CloseValue"]) / 4
    return df.withColumns({
        "HighestValue": F.least(F.greatest(high, v["OpenValue"], v["CloseValue"]), mean + 0.1 * mean).cast(df.schema["HighestValue"].dataType),
        "LowestValue": F.greatest(F.least(low, v["OpenValue"], v["CloseValue"]), mean - 0.1 * mean).cast(df.schema["LowestValue"].dataType),
    })


def relate_dates(df: DataFrame, key: Sequence[str], seed: int = 0) -> DataFrame:
    """An end date lies 1 to 29 days after its start date."""
    changes = {}
    for start in df.columns:
        if re.search("start.*date", start, re.I):
            wanted = re.sub("start.*date", "end_date", start.lower())
            end = next((c for c in df.columns if c.lower() == wanted), None)
            if end:
                changes[end] = F.date_add(F.to_date(start), between(key, end, seed, 1, 30).cast("int"))
    return df.withColumns(changes)


def scale_ratios(df: DataFrame) -> DataFrame:
    """Ratio, rate and percent columns with values outside 0..1 are min-max scaled to two decimals (constant: 0.5).

    Interest rates, inflation, indexes, durations and month counts keep their scale.
    """
    cols = []
    for f in df.schema.fields:
        low = f.name.lower()
        if isinstance(f.dataType, T.NumericType) and re.search("ratio|rate|percent", low) and not re.search(
                "duration|months$|interest.*rate|inflation|^index|index$|price.*index", low):
            cols.append(f.name)
    if not cols:
        return df
    row = df.agg(*[g(F.col(c).cast("double")).alias(f"{k}{i}") for i, c in enumerate(cols) for k, g in (("a", F.min), ("b", F.max))]).first()
    changes = {}
    for i, c in enumerate(cols):
        low, high = row[f"a{i}"], row[f"b{i}"]
        if low is None or (low >= 0 and high <= 1):
            continue
        v = F.col(c).cast("double")
        scaled = round_even((v - low) / F.lit(high - low), 2) if high > low else F.lit(0.5)
        out = F.when(v.isNotNull(), scaled)
        changes[c] = out.cast(df.schema[c].dataType) if isinstance(df.schema[c].dataType, T.DecimalType) else out
    return df.withColumns(changes)


def loan_terms(df: DataFrame, col: str = "LoanDurationMonths") -> DataFrame:
    """Terms of at least three months; values scaled to 0..1 become one of seven usual terms by septile."""
    top = df.agg(F.max(F.col(col).cast("double")).alias("m")).first()["m"]
    if top is None:
        return df
    if top > 1:
        return df.withColumn(col, F.when(F.col(col).isNotNull(), F.greatest(F.col(col), F.lit(LOAN_TERMS[0]).cast(df.schema[col].dataType))))
    cuts = quantiles(df, [col], [i / len(LOAN_TERMS) for i in range(1, len(LOAN_TERMS))])[col]
    out = F.lit(LOAN_TERMS[-1])
    for p, term in reversed(list(zip(sorted(cuts), LOAN_TERMS, strict=False))):
        out = F.when(F.col(col) <= cuts[p], term).otherwise(out)
    return df.withColumn(col, F.when(F.col(col).isNotNull(), out).cast("int"))


def amortized_payment(df: DataFrame) -> DataFrame:
    """Monthly payment of an annuity loan; amount / term without interest."""
    amount, n = F.col("LoanAmount").cast("double"), F.col("LoanDurationMonths").cast("double")
    r = F.col("InterestRate").cast("double") / 100 / 12
    growth = F.pow(1 + r, n)
    flat = F.try_divide(amount, n)
    annuity = F.when((r > 0) & (n > 0), F.try_divide(amount * r * growth, growth - 1))
    out = round_even(F.coalesce(annuity, flat), 2)
    kind = df.schema["MonthlyPayment"].dataType if "MonthlyPayment" in df.columns else T.DoubleType()
    return df.withColumn("MonthlyPayment", out.cast(kind))


def relate_columns(df: DataFrame, key: Sequence[str], seed: int = 0) -> DataFrame:
    """All relations after generation, then two decimals for ratios and rates and a whole GDP."""
    have = set(df.columns)
    if set(PRICES) <= have:
        df = relate_prices(df)
    df = scale_ratios(relate_dates(df, key, seed))
    if {"LoanAmount", "LoanDurationMonths"} <= have:
        df = loan_terms(df)
        if {"MonthlyPayment", "InterestRate"} <= have:
            df = amortized_payment(df)
    changes = {}
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)) and re.search("ratio|rate", f.name.lower()):
            changes[f.name] = round_even(f.name, 2)
        if f.name == "GDP" and isinstance(f.dataType, T.NumericType):
            changes[f.name] = round_even(F.col(f.name).cast("double")).cast("bigint")
    return df.withColumns(changes)
