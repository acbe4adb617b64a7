"""Derived measures stored with the facts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskmart.functions.expr import band

# Debt-to-income thresholds of the stress index.
STRESS_STEPS = ((0.43, 100), (0.36, 80), (0.28, 60), (0.20, 40))
# Balance weight by payment status.
STATUS_WEIGHT = (("On Time", 1.0), ("Late", 1.2), ("Defaulted", 1.5))


def _d(c: str):
    return F.col(c).cast("double")


def customer_measures(df: DataFrame) -> DataFrame:
    """Net worth, savings and liquidity ratios, financial stress index."""
    return df.withColumns({
        "NetWorth": F.col("TotalAssets") - F.col("TotalLiabilities"),
        "SavingsRatio": F.try_divide(_d("MonthlySavings") * 12, _d("AnnualIncome")),
        "LiquidityRatio": F.try_divide(_d("TotalAssets"), _d("TotalLiabilities")),
        "FinancialStressIndex": band("DebtToIncomeRatio", STRESS_STEPS, 20),
    })


def loan_measures(df: DataFrame) -> DataFrame:
    """Total interest, payment progress, status-weighted balance, months remaining."""
    growth = F.pow(1 + _d("InterestRate") / 1200, F.col("LoanDurationMonths"))
    weighted = _d("Balance")
    for status, weight in reversed(STATUS_WEIGHT):
        weighted = F.when(F.col("PaymentStatus") == status, _d("Balance") * weight).otherwise(weighted)
    return df.withColumns({
        "TotalInterestAmount": _d("LoanAmount") * (growth - 1),
        "PaymentProgress": 1 - F.try_divide(_d("Balance"), _d("LoanAmount")),
        "RiskWeightedBalance": weighted,
        "MonthsRemaining": F.ceil(F.try_divide(_d("Balance"), _d("MonthlyPayment"))),
    })


def market_measures(df: DataFrame) -> DataFrame:
    """Daily change in percent, price range, volatility ratio (0 where the opening value is not positive)."""
    opened = _d("OpenValue")
    spread = _d("HighestValue") - _d("LowestValue")
    return df.withColumns({
        "DailyChangePercent": F.when(opened > 0, F.try_divide(_d("CloseValue") - opened, opened) * 100).otherwise(0.0),
        "PriceRange": spread,
        "VolatilityRatio": F.when(opened > 0, F.try_divide(spread, opened)).otherwise(0.0),
    })


def risk_change(df: DataFrame, new: str = "AggregateRiskScore", old: str = "PreviousAggregateRiskScore") -> DataFrame:
    """Change of the score in points and percent (0 percent without an earlier score)."""
    now, was = _d(new), _d(old)
    return df.withColumns({
        "RiskChangeAmount": F.col(new) - F.col(old),
        "RiskChangePercent": F.when(was.isNull() | (was == 0), F.lit(0.0)).otherwise(F.try_divide(now - was, was) * 100),
    })
