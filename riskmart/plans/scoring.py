"""Risk scores, computed for all customers in one plan.

Every fact is aggregated per customer before it is joined, so the joins are one row to one row and a customer with a
third of all rows costs no more than any other.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskmart.functions.expr import attach_stats, band, floor_band, large
from riskmart.operators.keys import upsert

SCORE = "decimal(5,2)"

# Thresholds and points of the four scores.
CREDIT_DTI = ((0.43, 100), (0.36, 80), (0.28, 50))
CREDIT_UTILISATION = ((0.9, 100), (0.7, 80), (0.5, 50), (0.3, 30))
FRAUD_CASES = ((3, 100), (0, 80))
FRAUD_DISTANCE = ((1000, 80), (500, 60), (100, 30))
FRAUD_RATIO = ((5, 80), (3, 60), (2, 40))
MARKET_VOLATILITY = ((0.05, 100), (0.03, 80), (0.02, 60), (0.01, 40))
MARKET_RATE = ((8, 90), (6, 70), (4, 50), (2, 30))
MARKET_UNEMPLOYMENT = ((8, 90), (6, 70), (4, 40))
MARKET_CHANGE = ((3, 100), (2, 80), (1, 60), (0.5, 40))
CATEGORY = ((80, "Very High"), (60, "High"), (40, "Medium"))
DEFAULT_CREDIT, DEFAULT_FRAUD, DEFAULT_MARKET = Decimal("50.00"), Decimal("25.00"), Decimal("50.00")


def _w(text: str) -> Column:
    return F.lit(Decimal(text))


def _day(date) -> Column:
    return F.lit(date).cast("date")


def latest_snapshot(fact: DataFrame, key: str, date_col: str, date, strict: bool = False) -> DataFrame:
    """As-of read: per key the row with the highest date at or (``strict``) before ``date``."""
    limit = F.lit(date)
    reach = fact.filter(F.col(date_col) < limit if strict else F.col(date_col) <= limit)
    rest = [c for c in fact.columns if c != key]
    order = [date_col, *[c for c in rest if c != date_col]]
    return reach.groupBy(key).agg(F.max(F.struct(*order)).alias("_r")).select(key, *[F.col(f"_r.{c}") for c in rest])


def _loan_history(loans: DataFrame) -> DataFrame:
    """Defaulted and late loans per customer; a customer without loans has no row."""
    return loans.groupBy("CustomerSK").agg(
        F.count_if(F.col("PaymentStatus") == "Defaulted").alias("_defaulted"),
        F.count_if(F.col("PaymentStatus") == "Late").alias("_late"),
    )


def _credit_parts(credit: DataFrame, customers: DataFrame, date_key: int, exact_date: bool) -> DataFrame:
    """Per customer of the snapshots: the part of the score that comes from the cards, and the snapshot that counts."""
    own = F.col("CreditScore") * _w("0.1")
    card = (100 - own) * _w("0.30") + band("CreditUtilizationRatio", CREDIT_UTILISATION, 10) * _w("0.15")
    cards = credit.groupBy("CustomerSK").agg(F.max(card).alias("_card"))
    reached = F.col("DateSK") == date_key if exact_date else F.col("DateSK") <= date_key
    snap = F.max(F.when(reached, F.struct("DateSK", "DebtToIncomeRatio")))
    return customers.groupBy("CustomerSK").agg(snap.alias("_snap")).join(large(cards), "CustomerSK", "left")


def _credit_total() -> Column:
    behaviour = F.when(F.col("_defaulted") > 0, 100).when(F.col("_late") > 3, 90).when(F.col("_late") > 0, 70).otherwise(10)
    total = (
        F.col("_card")
        + band("_snap.DebtToIncomeRatio", CREDIT_DTI, 20) * _w("0.25")
        + behaviour * _w("0.30")
    ).cast(SCORE)
    return F.coalesce(F.when(F.col("_snap").isNotNull(), total), F.lit(DEFAULT_CREDIT)).cast(SCORE)


def credit_score(credit: DataFrame, customers: DataFrame, loans: DataFrame, date_key: int,
                 exact_date: bool = True) -> DataFrame:
    """30 % credit score, 25 % debt-to-income, 30 % payment history, 15 % utilisation; 50 when it cannot be computed.

    ``exact_date=True`` needs a customer snapshot on the very day, ``False`` takes the latest one up to it.
    """
    parts = _credit_parts(credit, customers, date_key, exact_date).join(large(_loan_history(loans)), "CustomerSK", "left")
    return parts.select("CustomerSK", _credit_total().alias("CreditRiskScore"))


def fraud_score(fraud: DataFrame, date, days: int = 90) -> DataFrame:
    """Score of customers with transactions in the ``days`` up to ``date``: cases, distance, amount ratio, chip/PIN use.

    ``fraud`` holds one row per transaction with ``TransactionDate``; customers without any take the default when the
    profile is assembled.
    """
    when = F.to_date("TransactionDate")
    secure = F.col("IsUsedChip") + F.col("IsUsedPIN")
    window = fraud.filter((when <= _day(date)) & (when >= F.date_sub(_day(date), days)))
    stats = window.groupBy("CustomerSK").agg(
        F.count_if(F.col("IsFraudulent") == 1).alias("_cases"),
        F.avg("DistanceFromHome").alias("_distance"),
        F.avg("RatioToMedianTransactionAmount").alias("_ratio"),
        F.min(secure).alias("_least"),
        F.avg(secure).alias("_mean"),
    )
    security = F.when(F.col("_least") == 0, 80).when(F.col("_mean") < 1, 50).otherwise(15)
    score = (
        band("_cases", FRAUD_CASES, 20) * _w("0.40")
        + band("_distance", FRAUD_DISTANCE, 10) * _w("0.20")
        + band("_ratio", FRAUD_RATIO, 20) * _w("0.25")
        + security * _w("0.15")
    )
    return stats.select("CustomerSK", score.cast(SCORE).alias("FraudRiskScore"))


def market_conditions(market: DataFrame, economy: DataFrame, date, country, days: int = 30) -> DataFrame:
    """One row of averages over the ``days`` up to ``date`` for market days that have an economic row of ``country``."""
    inside = market.filter((F.col("MarketDate") <= _day(date)) & (F.col("MarketDate") >= F.date_sub(_day(date), days)))
    # One row per day of the look-back for one country.
    macro = economy.filter(F.col("CountryName") == F.lit(country)).select(
        F.col("ReportDate").alias("MarketDate"), F.col("UnemploymentRate").alias("_unemployment"))
    return inside.join(macro, "MarketDate").agg(
        F.avg("VolatilityRatio").alias("_volatility"),
        F.avg("InterestRate").alias("_rate"),
        F.avg(F.abs("DailyChangePercent")).alias("_change"),
        F.avg("_unemployment").alias("_jobless"),
    )


def _market_total() -> Column:
    return (
        band("_volatility", MARKET_VOLATILITY, 20) * _w("0.30")
        + band("_rate", MARKET_RATE, 20) * _w("0.25")
        + band("_jobless", MARKET_UNEMPLOYMENT, 20) * _w("0.25")
        + band("_change", MARKET_CHANGE, 20) * _w("0.20")
    ).cast(SCORE)


def market_score(market: DataFrame, economy: DataFrame, loans: DataFrame, date, country, days: int = 30) -> DataFrame:
    """Market score of customers with loans; the conditions are the same for all of them."""
    holders = loans.select("CustomerSK").distinct()
    scored = attach_stats(holders, market_conditions(market, economy, date, country, days))
    return scored.select("CustomerSK", _market_total().alias("MarketRiskScore"))


def aggregate_score(df: DataFrame) -> DataFrame:
    """60 % credit, 15 % fraud, 25 % market."""
    total = (
        F.col("CreditRiskScore") * _w("0.60")
        + F.col("FraudRiskScore") * _w("0.15")
        + F.col("MarketRiskScore") * _w("0.25")
    )
    return df.withColumn("AggregateRiskScore", total.cast(SCORE))


def previous_score(profile: DataFrame, date_key: int) -> DataFrame:
    """Aggregate score of each customer's latest profile row strictly before the date."""
    before = latest_snapshot(
        profile.select("CustomerSK", "DateID", "AggregateRiskScore"), "CustomerSK", "DateID", date_key, strict=True)
    return before.select("CustomerSK", F.col("AggregateRiskScore").cast(SCORE).alias("PreviousAggregateRiskScore"))


def trend_and_category(df: DataFrame) -> DataFrame:
    now, was = F.col("AggregateRiskScore"), F.col("PreviousAggregateRiskScore")
    return df.withColumns({
        "RiskTrend": F.when(now > was * _w("1.1"), "Increasing").when(now < was * _w("0.9"), "Decreasing").otherwise("Stable"),
        "RiskCategory": floor_band("AggregateRiskScore", CATEGORY, "Low"),
    })


def risk_profile(customers: DataFrame, credit: DataFrame, loans: DataFrame, fraud: DataFrame, market: DataFrame,
                 economy: DataFrame, date, country, profile: DataFrame | None = None,
                 exact_date: bool = True) -> DataFrame:
    """Profile rows of one day for every customer with a snapshot up to it: four scores, previous score, trend, category."""
    key = int(str(date).replace("-", ""))
    known = customers.filter(F.col("DateSK") <= key)
    # All parts are keyed by customer, so they meet on one partitioning; the loans are aggregated once for two scores.
    base = _credit_parts(credit, known, key, exact_date).join(large(_loan_history(loans)), "CustomerSK", "left")
    base = base.join(large(fraud_score(fraud, date)), "CustomerSK", "left")
    base = attach_stats(base, market_conditions(market, economy, date, country))
    base = base.select(
        "CustomerSK", F.lit(key).alias("DateID"), _credit_total().alias("CreditRiskScore"),
        F.coalesce("FraudRiskScore", F.lit(DEFAULT_FRAUD)).cast(SCORE).alias("FraudRiskScore"),
        F.when(F.col("_late").isNotNull(), _market_total()).otherwise(F.lit(DEFAULT_MARKET)).cast(SCORE).alias("MarketRiskScore"))
    base = aggregate_score(base)
    if profile is None:
        base = base.withColumn("PreviousAggregateRiskScore", F.lit(Decimal("0.00")).cast(SCORE))
    else:
        base = base.join(large(previous_score(profile, key)), "CustomerSK", "left").withColumn(
            "PreviousAggregateRiskScore",
            F.coalesce("PreviousAggregateRiskScore", F.lit(Decimal("0.00"))).cast(SCORE))
    return trend_and_category(base).select(
        "CustomerSK", "DateID", "CreditRiskScore", "FraudRiskScore", "MarketRiskScore", "AggregateRiskScore",
        "PreviousAggregateRiskScore", "RiskTrend", "RiskCategory")


def update_risk_profile(profile: DataFrame, rows: DataFrame) -> DataFrame:
    """New profile snapshot with the day's rows upserted."""
    values = [c for c in rows.columns if c not in ("CustomerSK", "DateID")]
    return upsert(profile, rows, ["CustomerSK", "DateID"], values)


__all__ = [
    "latest_snapshot", "credit_score", "fraud_score", "market_score", "market_conditions", "aggregate_score",
    "previous_score", "trend_and_category", "risk_profile", "update_risk_profile",
]
