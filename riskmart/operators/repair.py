"""Automatic repair. Each step returns the repaired table; statistics it needs are taken from the table first."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskmart.functions.expr import clamp, null_apart, numeric_columns, string_columns
from riskmart.functions.stats import modes, null_rates, quantiles
from riskmart.operators.knn import knn_impute
from riskmart.operators.validate import FRAUD_FLAGS, PRICES, outlier_bounds

# Columns left to the domain rules of each dataset.
DOMAIN_OWNED = {
    "Loan": ("Age", "AnnualIncome", "CreditScore", "InterestRate", "LoanAmount", "DebtToIncomeRatio"),
    "Fraud": ("TransactionAmount", "DistanceFromHome"),
    "Market": ("OpenValue", "CloseValue", "HighestValue", "LowestValue", "VIX", "TEDSpread"),
    "Macro": ("UnemploymentRate", "GDP", "InflationRate"),
}
# Columns that identify the owner of a row, in order of preference.
GROUP_KEYS = ("Customer_ID", "CustomerID", "ID", "User_ID", "UserID", "UserName")
MAX_AMOUNT, MAX_INCOME, MAX_RATE, SCORE_BOUNDS = 10_000_000, 100_000_000, 100, (300, 850)
MAX_DISTANCE, MAX_AGE_DAYS = 20_000, 3650
MACRO_CAPS = {"UnemploymentRate": 50, "DebtRatio": 200, "DeficitRatio": 200}


def _type(df: DataFrame, c: str) -> T.DataType:
    return df.schema[c].dataType


def _put(df: DataFrame, changes: dict[str, Column]) -> DataFrame:
    """Replace columns and keep their types; what a type cannot hold is NULL."""
    return df.withColumns({c: v.try_cast(_type(df, c)) for c, v in changes.items()})


def fill_missing(df: DataFrame, max_missing: float = 0.5, knn=None, knn_columns: Sequence[str] = ()) -> DataFrame:
    """Fill NULL in columns with at most ``max_missing`` of it.

    Numbers and timestamps take the median, text named *Type* or *Status* 'Unknown', *Name* 'Not Specified', other
    text its most frequent value. ``knn``, a callable ``(df, columns) -> df``, fills those of ``knn_columns`` that have gaps, all at
    once and from the original values; no size of the table decides.
    """
    rates = {c: r for c, r in null_rates(df).items() if 0 < r <= max_missing}
    numbers = [c for c in numeric_columns(df) if c in rates]
    times = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType, T.DateType)) and f.name in rates]
    texts = [c for c in string_columns(df) if c in rates]
    near = [c for c in numbers if c in knn_columns]
    if knn is not None and near:
        df = knn(df, near)
        numbers = [c for c in numbers if c not in near]
    stats = df.select(
        *[F.col(c) for c in numbers], *[F.unix_micros(F.col(c).cast("timestamp")).cast("double").alias(c) for c in times])
    medians = quantiles(stats, [*numbers, *times], (0.5,))
    free = [c for c in texts if not any(w in c for w in ("Type", "Status", "Name"))]
    common = modes(df, free)
    changes = {}
    for c in numbers:
        changes[c] = F.coalesce(F.col(c).cast("double"), F.lit(medians[c][0.5]))
    for c in times:
        changes[c] = F.coalesce(F.col(c).cast("timestamp"), F.timestamp_micros(F.lit(int(medians[c][0.5]))))
    for c in texts:
        fixed = "Unknown" if "Type" in c or "Status" in c else "Not Specified" if "Name" in c else common[c] or "Unknown"
        changes[c] = F.coalesce(F.col(c), F.lit(fixed))
    return df.withColumns({
        c: v.cast(_type(df, c)) if not isinstance(_type(df, c), T.IntegralType) or c in texts else v for c, v in changes.items()})


def group_key(df: DataFrame) -> str | None:
    """The column that identifies the owner of a row, if there is one."""
    low = {k.lower() for k in GROUP_KEYS}
    return next((c for c in sorted(df.columns) if c.lower() in low), None)


def consensus_by_group(df: DataFrame, key: str, cols: Sequence[str]) -> DataFrame:
    """Per group of three or more rows: a value held by all but at most two rows replaces every other value and NULL.

    Counts per (key, column, value) are combined map-side and reduced to one small row per key before the join back.
    """
    cells = [F.struct(F.lit(c).alias("c"), F.col(c).cast("string").alias("v"), F.col(c).cast("double").alias("d")) for c in cols]
    counts = df.filter(F.col(key).isNotNull()).select(F.col(key).alias("_k"), F.explode(F.array(*cells)).alias("x"))
    counts = counts.groupBy("_k", "x.c", "x.v", "x.d").agg(F.count("*").alias("n"))
    valued = F.when(F.col("v").isNotNull(), F.struct((-F.col("n")).alias("n"), "d", "v"))
    best = counts.groupBy("_k", "c").agg(F.sum("n").alias("size"), F.min(valued).alias("top"))
    best = best.filter((F.col("size") >= 3) & (-F.col("top.n") >= F.col("size") - 2))
    agreed = best.groupBy("_k").agg(F.map_from_entries(F.collect_list(F.struct("c", "top.v"))).alias("_agreed"))
    agreed = agreed.withColumn("_k", F.col("_k").cast("string"))
    joined = df.withColumn("_apart", null_apart(key)).join(agreed, F.col("_apart") == F.col("_k"), "left")
    out = [F.coalesce(F.col("_agreed")[c].cast(_type(df, c)), F.col(c)).alias(c) if c in cols else F.col(c) for c in df.columns]
    return joined.select(*out)


def cap_outliers_iqr(df: DataFrame, k: float = 3.0, skip: Sequence[str] = (), cols: Sequence[str] | None = None) -> DataFrame:
    """Clamp numbers to their IQR fences; ids (unless ratios), narrow, mostly empty and ``skip`` columns are left alone."""
    ratios = [c for c in df.columns if "ratio" in c.lower()]
    names = [c for c in (cols if cols is not None else numeric_columns(df)) if c not in skip]
    changes = {}
    for c, (low, high) in outlier_bounds(df, k, names, keep_ids=ratios).items():
        capped = clamp(F.col(c).cast("double"), low, high)
        changes[c] = capped.cast(_type(df, c)) if isinstance(_type(df, c), T.DecimalType) else capped
    return df.withColumns(changes)


def fix_loan(df: DataFrame) -> DataFrame:
    """Ages, amounts, rates, scores, incomes and counts of loans."""
    have, changes = set(df.columns), {}
    if "Age" in have:
        age = F.col("Age")
        middle = quantiles(df, ["Age"], (0.5,))["Age"][0.5]
        changes["Age"] = F.when(age < 0, middle).when(age > 100, 100).when((age > 0) & (age < 18), 18).otherwise(age)
    for c, cap in (("LoanAmount", MAX_AMOUNT), ("InterestRate", MAX_RATE), ("AnnualIncome", MAX_INCOME)):
        if c in have:
            changes[c] = clamp(F.abs(c), high=cap)
    if "CreditScore" in have:
        changes["CreditScore"] = F.when(F.col("CreditScore") == 0, 0).otherwise(clamp(F.col("CreditScore"), *SCORE_BOUNDS))
    if "NumLoans" in have:
        n = clamp(F.col("NumLoans"), low=0)
        top = quantiles(df.withColumn("NumLoans", n), ["NumLoans"], (0.99,))["NumLoans"][0.99]
        changes["NumLoans"] = F.when(F.col("NumLoans") > 100, min(top, 20) if top is not None else 20).otherwise(n)
    for c in numeric_columns(df):
        if c.startswith("Num_") or "Count" in c or "Number" in c:
            changes[c] = F.rint(clamp(F.col(c).cast("double"), low=0))
    return _put(df, changes)


def fix_fraud(df: DataFrame, as_of) -> DataFrame:
    """Flags become 0 or 1, distances are bounded, dates lie in the ten years before ``as_of``."""
    have, changes = set(df.columns), {}
    for c in FRAUD_FLAGS:
        if c in have:
            changes[c] = F.when(F.col(c).isin(0, 1), F.col(c)).when(F.col(c) >= 0.5, 1).otherwise(0)
    for c in ("DistanceFromHome", "DistanceFromLastTransaction"):
        if c in have:
            changes[c] = clamp(F.abs(c), high=MAX_DISTANCE)
    if "TransactionDate" in have:
        now = F.lit(as_of).cast("timestamp")
        changes["TransactionDate"] = clamp(F.col("TransactionDate").cast("timestamp"), now - F.make_dt_interval(F.lit(MAX_AGE_DAYS)), now)
    return _put(df, changes)


def fix_market(df: DataFrame, as_of) -> DataFrame:
    """Order of high and low, price fences, open and close inside the day's range, rates, dates."""
    have = set(df.columns)
    if set(PRICES) <= have:
        complete = F.col(PRICES[0]).isNotNull()
        for c in PRICES[1:]:
            complete = complete & F.col(c).isNotNull()
        high, low = F.col("HighestValue"), F.col("LowestValue")
        df = df.withColumns({
            "HighestValue": F.when(complete, F.greatest(high, low)).otherwise(high),
            "LowestValue": F.when(complete, F.least(high, low)).otherwise(low),
        })
        # The fences are taken after the swap.
        fences = {}
        for c, q in quantiles(df, PRICES, (0.25, 0.75)).items():
            if q[0.25] is not None:
                reach = (1.0 if c == "HighestValue" else 1.5) * (q[0.75] - q[0.25])
                fences[c] = clamp(F.col(c).cast("double"), max(0.0, q[0.25] - reach), q[0.75] + reach)
        df = _put(df, fences)
        inside = {
            c: F.when(complete, F.greatest(F.least(F.col(c), F.col("HighestValue")), F.col("LowestValue"))).otherwise(F.col(c))
            for c in ("OpenValue", "CloseValue")
        }
        df = _put(df, inside)
    changes = {c: F.abs(c) for c in PRICES if c in have}
    if "InterestRate" in have:
        changes["InterestRate"] = clamp(F.col("InterestRate"), 0, 30)
    if "MarketDate" in have:
        changes["MarketDate"] = clamp(F.col("MarketDate").cast("timestamp"), high=F.lit(as_of).cast("timestamp"))
    return _put(df, changes)


def fix_macro(df: DataFrame, as_of) -> DataFrame:
    """Rates and ratios bounded (inflation may be negative), indexes and GDP positive, dates not in the future."""
    have = set(df.columns)
    changes = {c: clamp(F.abs(c), high=cap) for c, cap in MACRO_CAPS.items() if c in have}
    changes |= {c: F.abs(c) for c in ("GDP", "ConsumerPriceIndex", "HousePriceIndex") if c in have}
    if "ReportDate" in have:
        changes["ReportDate"] = clamp(F.col("ReportDate").cast("timestamp"), high=F.lit(as_of).cast("timestamp"))
    return _put(df, changes)


def fix_payment(df: DataFrame) -> DataFrame:
    """Payments over twice or under half of amount / duration become amount / duration."""
    paid = F.col("MonthlyPayment").cast("double")
    expected = F.try_divide(F.col("LoanAmount").cast("double"), F.col("LoanDurationMonths"))
    off = (paid > expected * 2) | (paid * 2 < expected)
    return _put(df, {"MonthlyPayment": F.when(off, expected).otherwise(paid)})


def fix_utilization(df: DataFrame) -> DataFrame:
    """Utilisation further than 10 points from 100 x balance / limit becomes that; then it is bounded to 0..100."""
    have, used = F.col("CreditUtilizationRatio"), F.col("CreditUtilizationRatio")
    if {"Balance", "CreditLimit"} <= set(df.columns):
        expected = F.try_divide(F.col("Balance").cast("double"), F.col("CreditLimit").cast("double")) * 100
        used = F.when(F.abs(have - expected) > 10, expected).otherwise(have)
    return _put(df, {"CreditUtilizationRatio": clamp(F.abs(used), high=100)})


def fix_vix_ted(df: DataFrame) -> DataFrame:
    """An extreme VIX beside a calm TED spread is lowered, then the reverse."""
    vix, ted = F.col("VIX"), F.col("TEDSpread")
    df = _put(df, {"VIX": F.when((vix > 50) & (ted < 0.5), 30 + ted * 40).otherwise(vix)})
    return _put(df, {"TEDSpread": F.when((ted > 2) & (vix < 20), 0.5 + vix * 0.025).otherwise(ted)})


def fix_online_flags(df: DataFrame) -> DataFrame:
    """Online transactions use neither chip nor PIN."""
    online = F.col("IsOnlineTransaction") == 1
    return _put(df, {c: F.when(online, 0).otherwise(F.col(c)) for c in ("IsUsedChip", "IsUsedPIN")})


def cap_zscore(df: DataFrame, col: str, z: float = 3.0) -> DataFrame:
    """Clamp a column to mean plus or minus ``z`` standard deviations."""
    row = df.agg(F.avg(F.col(col).cast("double")).alias("m"), F.stddev_samp(F.col(col).cast("double")).alias("s")).first()
    if row["s"] is None:
        return df
    return _put(df, {col: clamp(F.col(col).cast("double"), row["m"] - z * row["s"], row["m"] + z * row["s"])})


def fill_by_neighbours(df: DataFrame, cols: Sequence[str], k: int = 5) -> DataFrame:
    """Fill numeric columns from the nearest rows over all numeric columns but ids."""
    return knn_impute(df, cols, [c for c in numeric_columns(df) if c in cols or "id" not in c.lower()], k)


def repair_dataset(df: DataFrame, dataset: str, as_of, max_missing: float = 0.5, k: float = 3.0, knn=None, knn_columns: Sequence[str] = ()) -> DataFrame:
    """Missing values, then outliers, then domain rules, then consistency between columns.

    Numbers take the median, which needs no joins, but for ``knn_columns`` if ``knn`` is given (:func:`fill_by_neighbours`).
    """
    df = fill_missing(df, max_missing, knn, knn_columns)
    owned = DOMAIN_OWNED.get(dataset, ())
    key = group_key(df)
    if key is not None:
        cols = [c for c in numeric_columns(df) if c not in owned and c != key and ("id" not in c.lower() or "ratio" in c.lower())]
        df = consensus_by_group(df, key, cols)
    df = cap_outliers_iqr(df, k, owned)
    if dataset == "Loan":
        df = fix_loan(df)
        if {"MonthlyPayment", "LoanAmount", "LoanDurationMonths"} <= set(df.columns):
            df = fix_payment(df)
        if {"CreditUtilizationRatio", "Balance", "CreditLimit"} <= set(df.columns):
            df = fix_utilization(df)
    elif dataset == "Fraud":
        df = fix_fraud(df, as_of)
        if {"IsOnlineTransaction", "IsUsedChip", "IsUsedPIN"} <= set(df.columns):
            df = fix_online_flags(df)
    elif dataset == "Market":
        df = fix_market(df, as_of)
        if {"VIX", "TEDSpread"} <= set(df.columns):
            df = fix_vix_ted(df)
    elif dataset == "Macro":
        df = fix_macro(df, as_of)
    return df


def repair_report(before: DataFrame, after: DataFrame, key: Sequence[str]) -> DataFrame:
    """Rows changed per column (columns without a change are left out); rows are matched by ``key``."""
    cols = [c for c in before.columns if c in after.columns and c not in key]
    joined = before.alias("b").join(after.alias("a"), [F.col(f"b.{k}") == F.col(f"a.{k}") for k in key])
    row = joined.agg(*[F.count_if(~F.col(f"b.{c}").eqNullSafe(F.col(f"a.{c}"))).alias(f"c{i}") for i, c in enumerate(cols)])
    cells = [F.struct(F.lit(c).alias("column_name"), F.col(f"c{i}").alias("rows_changed")) for i, c in enumerate(cols)]
    return row.select(F.inline(F.array(*cells))).filter("rows_changed > 0")
