from decimal import Decimal

from pyspark.sql import functions as F

from riskmart.plans import scoring as S
from riskmart.queries.registry import Inputs
from riskmart.queries.scores import profile_of

SNAP = "CustomerSK bigint, DateSK int, DebtToIncomeRatio double"


def credit(spark, rows):
    return spark.createDataFrame(rows, "CustomerSK bigint, CreditScore int, CreditUtilizationRatio double")


def test_credit_score_by_hand(spark):
    # 0.30 * (100 - 59) + 0.25 * 100 + 0.30 * 100 + 0.15 * 80
    snap = spark.createDataFrame([(1, 20231012, 0.58), (2, 20231012, 0.1)], SNAP)
    loans = spark.createDataFrame([(1, "Defaulted"), (1, "Late"), (2, "Late"), (2, "Late"), (2, "Late"), (2, "Late")], "CustomerSK bigint, PaymentStatus string")
    out = {r[0]: r[1] for r in S.credit_score(credit(spark, [(1, 590, 0.88), (2, 800, 0.2)]), snap, loans, 20231012).collect()}
    assert out == {1: Decimal("79.30"), 2: Decimal("39.50")}


def test_credit_score_needs_the_day_unless_as_of(spark):
    snap = spark.createDataFrame([(1, 20231012, 0.58)], SNAP)
    loans = spark.createDataFrame([(1, "Defaulted")], "CustomerSK bigint, PaymentStatus string")
    cards = credit(spark, [(1, 590, 0.88), (1, 850, 0.0)])
    assert S.credit_score(cards, snap, loans, 20231013).first()[1] == Decimal("50.00")
    # Several credit rows: the highest score counts.
    assert S.credit_score(cards, snap, loans, 20231013, exact_date=False).first()[1] == Decimal("79.30")


def test_market_score_without_market_days_takes_the_lowest_bands(spark, sf_dir):
    t = Inputs(spark, sf_dir)
    market = t.stg_market.withColumns({"VolatilityRatio": F.lit(1.0), "DailyChangePercent": F.lit(1.0)}).limit(0)
    loans = spark.createDataFrame([(5,)], "CustomerSK bigint")
    assert S.market_score(market, t.stg_macro, loans, "2024-01-30", "NATION_1").first()[1] == Decimal("20.00")


def test_fraud_window_bounds(spark):
    rows = [(1, 100, "2023-11-01", 0.0, 0.0, 1, 1, 1), (1, 101, "2023-11-02", 0.0, 0.0, 1, 1, 0), (1, 102, "2024-01-30", 2000.0, 9.0, 0, 0, 1), (1, 103, "2024-01-31", 0.0, 0.0, 1, 1, 1)]
    df = spark.createDataFrame(rows, "CustomerSK bigint, TransactionID bigint, TransactionDate string, DistanceFromHome double, RatioToMedianTransactionAmount double, IsUsedChip int, IsUsedPIN int, IsFraudulent int")
    # Days 2 November to 30 January: one fraud (80), mean distance 1000 (60), mean ratio 4.5 (60), a row with neither chip nor PIN (80).
    assert S.fraud_score(df, "2024-01-31", 90).count() == 1
    assert S.fraud_score(df.filter("TransactionID <> 103"), "2024-01-30", 89).first()[1] == Decimal("71.00")


def test_profile_is_complete_and_bounded(spark, sf_dir):
    out = profile_of(Inputs(spark, sf_dir)).cache()
    n = out.count()
    assert n == out.select("CustomerSK").distinct().count() > 0
    for c in ("CreditRiskScore", "FraudRiskScore", "MarketRiskScore", "AggregateRiskScore"):
        assert out.filter(F.col(c).isNull() | (F.col(c) < 0) | (F.col(c) > 100)).count() == 0
    out.unpersist()
