"""Validation rules.

Every check returns rows ``(check, field, severity, failed, n_bad, pct, details)``, one per test, passed tests
included. All tests of one table share one aggregate pass.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskmart.functions.expr import attach_stats, numeric_columns
from riskmart.functions.stats import distinct_counts, quantiles

ISSUE_SCHEMA = "check string, field string, severity string, failed int, n_bad bigint, pct double, details string"
# Plausible ranges used by the domain rules.
SCORE_RANGE, RATE_RANGE, UNEMPLOYMENT_RANGE, INFLATION_RANGE, AGE_RANGE = (300, 850), (0, 100), (0, 100), (-20, 100), (18, 100)
FRAUD_FLAGS = ("IsFraudulent", "IsOnlineTransaction", "IsUsedChip", "IsUsedPIN")
PRICES = ("OpenValue", "CloseValue", "HighestValue", "LowestValue")


@dataclass(frozen=True)
class Rule:
    """A row is bad when ``bad`` is true; NULL counts as good. ``base`` marks the rows the percentage refers to."""

    check: str
    bad: Column
    field: str | None = None
    severity: str = "warning"
    base: Column | None = None


def run_rules(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Evaluate row rules in one aggregate and return one row per rule."""
    if not rules:
        return df.sparkSession.createDataFrame([], ISSUE_SCHEMA)
    aggs = []
    for i, r in enumerate(rules):
        base = r.base if r.base is not None else F.lit(True)
        aggs += [F.count_if(r.bad).alias(f"b{i}"), F.count_if(base).alias(f"n{i}")]
    rows = [
        issue(r.check, r.field, r.severity, F.col(f"b{i}") > 0, F.col(f"b{i}"), F.try_divide(F.col(f"b{i}") * 100.0, F.col(f"n{i}")))
        for i, r in enumerate(rules)
    ]
    return df.agg(*aggs).select(F.inline(F.array(*rows)))


def issue(check: str, field: str | None, severity: str, failed: Column, n_bad: Column, pct: Column,
          details: Column | None = None) -> Column:
    return F.struct(
        F.lit(check).alias("check"), F.lit(field).cast("string").alias("field"), F.lit(severity).alias("severity"),
        failed.cast("int").alias("failed"), n_bad.cast("bigint").alias("n_bad"), pct.cast("double").alias("pct"),
        (details if details is not None else F.lit(None)).cast("string").alias("details"))


def outside(name: str, bounds: tuple[float, float]) -> Column:
    return (F.col(name) < bounds[0]) | (F.col(name) > bounds[1])


_FAMILIES = (("number", T.NumericType), ("date", (T.DateType, T.TimestampType, T.TimestampNTZType)), ("text", T.StringType), ("bool", T.BooleanType))


def _family(t: T.DataType) -> str:
    return next((n for n, cls in _FAMILIES if isinstance(t, cls)), "other")


def check_schema(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Missing required columns and an empty table are critical, another type family is a warning."""
    rows, have = [], dict(zip(df.columns, df.schema.fields, strict=True))
    for f in schema.fields:
        if f.name not in have:
            if not f.nullable:
                rows.append(("missing_column", f.name, "critical", 1, 1, None, None))
            continue
        want, got = _family(f.dataType), _family(have[f.name].dataType)
        rows.append(("column_type", f.name, "warning", int(want != got), int(want != got), None,
                     None if want == got else f"expected {f.dataType.simpleString()}, got {have[f.name].dataType.simpleString()}"))
    empty = int(df.limit(1).count() == 0)
    rows.append(("empty_dataset", None, "critical", empty, empty, None, None))
    return df.sparkSession.createDataFrame(rows, ISSUE_SCHEMA)


def check_missing(df: DataFrame, max_missing: float = 0.5) -> DataFrame:
    """Columns with more than the allowed share of NULL; rows with it, when they are over 10 % of all rows."""
    cols = df.columns
    nulls = reduce(lambda a, b: a + b, [F.col(c).isNull().cast("int") for c in cols])
    row = df.agg(
        F.count("*").alias("n"), F.count_if(nulls / len(cols) > max_missing).alias("r"),
        *[F.avg(F.col(c).isNull().cast("double")).alias(f"c{i}") for i, c in enumerate(cols)])
    worst = F.filter(
        F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"c{i}").alias("share")) for i, c in enumerate(cols)]),
        lambda x: x["share"] > max_missing)
    share = F.try_divide(F.col("r") * 100.0, F.col("n"))
    return row.select(F.inline(F.array(
        issue("high_missing_values", None, "warning", F.size(worst) > 0, F.size(worst), F.size(worst) * 100.0 / len(cols), F.to_json(worst)),
        issue("high_missing_rows", None, "warning", F.coalesce(share > 10, F.lit(False)), F.col("r"), share))))


def row_digest(cols: Sequence[str]) -> Column:
    """SHA-256 over all columns (whole texts), so that the shuffle of a duplicate check carries 64 characters a row."""
    return F.sha2(F.to_json(F.struct(*cols), {"ignoreNullFields": "false"}), 256)


def check_duplicates(df: DataFrame) -> DataFrame:
    """Rows that repeat an earlier row exactly. Copies are counted map-side, so a huge group of copies is cheap."""
    groups = df.select(row_digest(df.columns).alias("k")).groupBy("k").agg(F.count("*").alias("n"))
    total = groups.agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("d"), F.coalesce(F.sum("n"), F.lit(0)).alias("n"))
    return total.select(F.inline(F.array(
        issue("duplicates", None, "warning", F.col("d") > 0, F.col("d"), F.try_divide(F.col("d") * 100.0, F.col("n"))))))


def outlier_bounds(df: DataFrame, k: float = 3.0, cols: Sequence[str] | None = None,
                   keep_ids: Sequence[str] = ()) -> dict[str, tuple[float, float]]:
    """IQR fences of numeric columns that are not ids, have over two values, at most half NULL and a positive IQR."""
    names = [c for c in numeric_columns(df) if cols is None or c in cols]
    names = [c for c in names if "id" not in c.lower() or c in keep_ids]
    if not names:
        return {}
    # Approximate counts settle the wide columns; only narrow ones are counted exactly.
    rough = df.agg(F.count("*").alias("n"), *[f(c).alias(f"{k}{i}") for i, c in enumerate(names) for k, f in (("c", F.approx_count_distinct), ("v", F.count))]).first()
    kept = [(i, c) for i, c in enumerate(names) if 2 * rough[f"v{i}"] >= rough["n"]]
    names, index = [c for _, c in kept], {c: i for i, c in kept}
    narrow = distinct_counts(df, [c for c in names if rough[f"c{index[c]}"] <= 10])
    names = [c for c in names if narrow.get(c, 3) > 2]
    out = {}
    for c, q in quantiles(df, names, (0.25, 0.75)).items():
        iqr = q[0.75] - q[0.25]
        if iqr > 0:
            out[c] = (q[0.25] - k * iqr, q[0.75] + k * iqr)
    return out


def check_outliers(df: DataFrame, k: float = 3.0, max_share: float = 0.05) -> DataFrame:
    """Columns with over 5 % of their values outside the IQR fences; one row per tested column."""
    bounds = outlier_bounds(df, k)
    if not bounds:
        return df.sparkSession.createDataFrame([], ISSUE_SCHEMA)
    aggs = []
    for i, (c, b) in enumerate(bounds.items()):
        aggs += [F.count_if(outside(c, b)).alias(f"b{i}"), F.count(c).alias(f"n{i}")]
    rows = []
    for i, (c, b) in enumerate(bounds.items()):
        bad, n = F.col(f"b{i}"), F.col(f"n{i}")
        detail = F.to_json(F.struct(F.lit(b[0]).alias("lower_bound"), F.lit(b[1]).alias("upper_bound")))
        rows.append(issue("outliers", c, "warning", F.coalesce(bad > n * max_share, F.lit(False)), bad, F.try_divide(bad * 100.0, n), detail))
    return df.agg(*aggs).select(F.inline(F.array(*rows)))


def check_dates_ages(df: DataFrame, as_of) -> DataFrame:
    """Dates after ``as_of`` in columns named *date*; ages outside 18 to 100."""
    now = F.lit(as_of).cast("timestamp")
    rules = [
        Rule("future_dates", F.col(f.name) > now, f.name, base=F.col(f.name).isNotNull())
        for f in df.schema.fields if "date" in f.name.lower() and _family(f.dataType) == "date"
    ]
    if "Age" in df.columns:
        rules.append(Rule("invalid_ages", outside("Age", AGE_RANGE), "Age", base=F.col("Age").isNotNull()))
    return run_rules(df, rules)


def check_loan(df: DataFrame) -> DataFrame:
    """Credit score, loan to income and interest rate."""
    have, rules = set(df.columns), []
    if "CreditScore" in have:
        rules.append(Rule("invalid_credit_scores", outside("CreditScore", SCORE_RANGE), "CreditScore"))
    if {"LoanAmount", "AnnualIncome"} <= have:
        high = (F.col("LoanAmount") > 10 * F.col("AnnualIncome")) & (F.col("AnnualIncome") > 0)
        rules.append(Rule("high_loan_to_income_ratio", high))
    if "InterestRate" in have:
        rules.append(Rule("invalid_interest_rates", outside("InterestRate", RATE_RANGE), "InterestRate"))
    return run_rules(df, rules)


def check_fraud(df: DataFrame) -> DataFrame:
    """Negative amounts; flags other than 0 and 1 (NULL included)."""
    rules = []
    if "TransactionAmount" in df.columns:
        rules.append(Rule("negative_transaction_amounts", F.col("TransactionAmount") < 0, "TransactionAmount"))
    for c in FRAUD_FLAGS:
        if c in df.columns:
            rules.append(Rule("invalid_binary_indicators", ~F.coalesce(F.col(c).isin(0, 1), F.lit(False)), c))
    return run_rules(df, rules)


def check_market(df: DataFrame) -> DataFrame:
    """Negative prices, high below low, open or close outside the day's range on complete rows."""
    rules = [Rule("negative_prices", F.col(c) < 0, c) for c in (*PRICES, "GoldPrice", "OilPrice") if c in df.columns]
    if {"HighestValue", "LowestValue"} <= set(df.columns):
        rules.append(Rule("invalid_high_low_relationship", F.col("HighestValue") < F.col("LowestValue")))
    if set(PRICES) <= set(df.columns):
        complete = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in PRICES])
        off = reduce(lambda a, b: a | b, [
            (F.col(c) > F.col("HighestValue")) | (F.col(c) < F.col("LowestValue")) for c in ("OpenValue", "CloseValue")])
        rules.append(Rule("prices_out_of_range", complete & off, base=complete))
    return run_rules(df, rules)


def check_macro(df: DataFrame) -> DataFrame:
    """Unemployment, GDP and inflation."""
    rules = []
    if "UnemploymentRate" in df.columns:
        rules.append(Rule("invalid_unemployment_rates", outside("UnemploymentRate", UNEMPLOYMENT_RANGE), "UnemploymentRate"))
    if "GDP" in df.columns:
        rules.append(Rule("negative_gdp", F.col("GDP") <= 0, "GDP"))
    if "InflationRate" in df.columns:
        rules.append(Rule("extreme_inflation_rates", outside("InflationRate", INFLATION_RANGE), "InflationRate"))
    return run_rules(df, rules)


DOMAIN_CHECKS = {"Loan": check_loan, "Fraud": check_fraud, "Market": check_market, "Macro": check_macro}


def validate_dataset(df: DataFrame, dataset: str, as_of, stage: str = "pre", schema: T.StructType | None = None,
                     max_missing: float = 0.5, k: float = 3.0) -> DataFrame:
    """All checks of one dataset, labelled with dataset and stage (``pre`` or ``post`` repair)."""
    parts = [check_missing(df, max_missing), check_duplicates(df), check_outliers(df, k), check_dates_ages(df, as_of)]
    if schema is not None:
        parts.insert(0, check_schema(df, schema))
    if dataset in DOMAIN_CHECKS:
        parts.append(DOMAIN_CHECKS[dataset](df))
    rows = reduce(DataFrame.unionByName, parts)
    return rows.select(F.lit(dataset).alias("dataset"), F.lit(stage).alias("stage"), "*")


def quality_score(issues: DataFrame) -> DataFrame:
    """Per dataset and stage: 100 less 10 per critical and 2 per warning, overall status, passed and failed tests."""
    critical = F.count_if((F.col("failed") == 1) & (F.col("severity") == "critical"))
    warning = F.count_if((F.col("failed") == 1) & (F.col("severity") == "warning"))
    summed = issues.groupBy("dataset", "stage").agg(
        critical.alias("critical"), warning.alias("warnings"),
        F.count_if(F.col("failed") == 0).alias("tests_passed"), F.count_if(F.col("failed") == 1).alias("tests_failed"))
    return summed.withColumns({
        "quality_score": F.greatest(F.lit(0), 100 - 10 * F.col("critical") - 2 * F.col("warnings")),
        "status": F.when(F.col("critical") > 0, "failed").when(F.col("warnings") > 0, "warning").otherwise("passed"),
    })


def check_constraints(df: DataFrame, checks: Mapping[str, str], keys: Sequence[Sequence[str]] = (),
                      fks: Sequence[tuple[Sequence[str], DataFrame, Sequence[str]]] = ()) -> DataFrame:
    """CHECK conditions (SQL text), unique keys and foreign keys as tests. A NULL condition holds, as in SQL."""
    parts = [run_rules(df, [Rule("check_constraint", ~F.expr(sql), name, "critical") for name, sql in checks.items()])]
    for key in keys:
        groups = df.groupBy(*key).agg(F.count("*").alias("n"))
        total = groups.agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("d"), F.sum("n").alias("n"))
        parts.append(total.select(F.inline(F.array(issue(
            "unique_key", ",".join(key), "critical", F.col("d") > 0, F.col("d"), F.try_divide(F.col("d") * 100.0, F.col("n")))))))
    for cols, parent, parent_cols in fks:
        # Child rows are counted per key before the anti join, so a hot key crosses the shuffle once.
        child = df.groupBy(*[F.col(c).alias(f"k{i}") for i, c in enumerate(cols)]).agg(F.count("*").alias("n"))
        known = parent.select(*[F.col(c).alias(f"k{i}") for i, c in enumerate(parent_cols)]).distinct()
        names = [f"k{i}" for i in range(len(cols))]
        present = reduce(lambda a, b: a & b, [F.col(n).isNotNull() for n in names])
        lost = child.filter(present).join(known, names, "left_anti").agg(F.coalesce(F.sum("n"), F.lit(0)).alias("d"))
        parts.append(lost.select(F.inline(F.array(issue(
            "foreign_key", ",".join(cols), "critical", F.col("d") > 0, F.col("d"), F.lit(None))))))
    return reduce(DataFrame.unionByName, parts)


# --- staged data before the mart load ------------------------------------------------------------------------------

# Word in the error name -> category, first match wins.
CATEGORIES = (
    ("Null", "Missing Values"), ("Negative", "Range Validation"), ("High", "Outlier Detection"), ("Invalid", "Business Rules"),
    ("Duplicate", "Uniqueness Check"), ("Future", "Date Validation"), ("Statistical", "Statistical Validation"),
)


def _error(source: str, name: str, count: Column) -> Column:
    return F.struct(F.lit(source).alias("DataSource"), F.lit(name).alias("ErrorType"), count.cast("bigint").alias("ErrorCount"))


def validate_staging(loan: DataFrame, fraud: DataFrame, market: DataFrame, as_of) -> DataFrame:
    """Error counts over the staged tables, largest first, with their category; errors that do not occur are left out."""
    rate = F.col("InterestRate").cast("double")
    stats = loan.agg(F.avg(rate).alias("_mean"), F.stddev_samp(rate).alias("_dev"))
    loans = attach_stats(loan, stats).agg(
        F.count_if(F.col("CustomerID").isNull()).alias("a"),
        F.count_if(rate < 0).alias("b"),
        F.count_if(F.col("LoanAmount") > 1000000).alias("c"),
        F.count_if(F.col("MonthlyPayment") > F.col("LoanAmount")).alias("d"),
        F.count_if(F.abs(rate - F.col("_mean")) > 3 * F.col("_dev")).alias("e"),
    ).select(F.inline(F.array(
        _error("Loan", "Null CustomerIDs", F.col("a")),
        _error("Loan", "Negative Interest Rates", F.col("b")),
        _error("Loan", "Suspiciously High Loan Amounts", F.col("c")),
        _error("Loan", "Invalid Monthly Payment", F.col("d")),
        _error("Loan", "Statistical Interest Rate Outliers", F.col("e")))))
    per_id = fraud.groupBy("TransactionID").agg(F.count("*").alias("n"))
    known = F.col("TransactionID").isNotNull()
    frauds = per_id.agg(
        F.coalesce(F.sum(F.when(~known, F.col("n"))), F.lit(0)).alias("a"),
        F.coalesce(F.sum(F.when(known, F.col("n") - 1)), F.lit(0)).alias("b"),
    ).select(F.inline(F.array(
        _error("Fraud", "Null TransactionIDs", F.col("a")), _error("Fraud", "Duplicate Transactions", F.col("b")))))
    future = F.to_date("MarketDate") > F.to_date(F.lit(as_of))
    markets = market.agg(F.count_if(future).alias("a")).select(F.inline(F.array(_error("Market", "Future Dates", F.col("a")))))
    category = F.lit("Other")
    for word, name in reversed(CATEGORIES):
        category = F.when(F.col("ErrorType").contains(word), name).otherwise(category)
    errors = loans.unionByName(frauds).unionByName(markets).filter("ErrorCount > 0")
    return errors.withColumn("ValidationCategory", category).orderBy(F.desc("ErrorCount"), "DataSource", "ErrorType")


def staging_totals(errors: DataFrame) -> DataFrame:
    """Number of error kinds and of errors."""
    return errors.agg(F.count("*").alias("TotalIssueTypes"), F.coalesce(F.sum("ErrorCount"), F.lit(0)).alias("TotalIssueCount"))


def sample_values(df: DataFrame, bad: Column, key: str, cols: Sequence[str], n: int = 5) -> DataFrame:
    """The first ``n`` offenders by key as one JSON text (NULL when there are none)."""
    worst = df.filter(bad).select(key, *[c for c in cols if c != key]).orderBy(key).limit(n)
    # At most n rows reach the array.
    rows = F.sort_array(F.collect_list(F.struct(key, *[c for c in cols if c != key])))
    return worst.agg(F.when(F.count("*") > 0, F.to_json(rows)).alias("SampleValues"))


def check_orphans(child: DataFrame, parent: DataFrame, key: str) -> DataFrame:
    """Number of distinct child keys without a parent."""
    return child.select(key).distinct().join(parent.select(key).distinct(), key, "left_anti").agg(F.count("*").alias("orphans"))


def reconcile_counts(name: str, expected: DataFrame, actual: DataFrame, tolerance: float = 0.05) -> DataFrame:
    """Warn when two row counts differ by more than ``tolerance`` of the first."""
    both = expected.agg(F.count("*").alias("expected")).crossJoin(F.broadcast(actual.agg(F.count("*").alias("actual"))))
    off = F.abs(F.col("expected") - F.col("actual")) > F.col("expected") * tolerance
    return both.select(F.lit(name).alias("check"), "expected", "actual", F.when(off, "Warning").otherwise("Success").alias("status"))


def usury_check(df: DataFrame, limits: DataFrame, state: str = "State", rate: str = "InterestRate") -> DataFrame:
    """Per state with a legal maximum: loans above it. ``limits`` has columns ``state`` and ``max_rate``."""
    rates = df.groupBy(F.col(state).alias("state"), F.col(rate).alias("rate")).agg(F.count("*").alias("n"))
    return (
        rates.join(limits, "state")
        .groupBy("state", "max_rate")
        .agg(F.coalesce(F.sum(F.when(F.col("rate") > F.col("max_rate"), F.col("n"))), F.lit(0)).alias("violations"))
    )


def fraud_rate_drift(log: DataFrame, as_of, hours: int = 12) -> DataFrame:
    """Mean of fraud rows per loan row in percent over all pairs of loads at most ``hours`` hour marks apart, last month.

    The distance counts hour marks, so both sides are summed per hour first. The pairs are never built: the mean of
    the ratios is (sum of fraud rows) x (sum of 1 / loan rows) over the hours in reach, divided by the pair count.
    """
    now = F.lit(as_of).cast("timestamp")
    recent = log.filter((F.col("Status") == "Loaded") & (F.col("ExecutionDateTime") > F.add_months(now, -1)))
    hour = F.floor(F.unix_timestamp("ExecutionDateTime") / 3600).alias("hour")
    rows = F.col("RowsProcessed")
    fraud = recent.filter("StepName = 'LoadFraudData'").groupBy(hour).agg(F.sum(rows).alias("f"), F.count(rows).alias("nf"))
    loan = recent.filter("StepName = 'LoadLoanData' and RowsProcessed <> 0").groupBy(hour).agg(
        F.sum(1.0 / rows).alias("inv"), F.count("*").alias("nl"))
    near = loan.select(F.explode(F.sequence(F.col("hour") - hours, F.col("hour") + hours)).alias("hour"), "inv", "nl")
    sums = near.join(fraud, "hour").agg(F.sum(F.col("f") * F.col("inv")).alias("s"), F.sum(F.col("nf") * F.col("nl")).alias("n"))
    return sums.select((F.try_divide(F.col("s"), F.col("n")) * 100).alias("historical_rate"))
