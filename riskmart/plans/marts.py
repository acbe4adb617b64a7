"""Dimensions and facts of the star schema.

Loads take the staged table, the dimensions and the existing target (or ``None``) and return the new target snapshot.
Joins are plain equi-joins, so the optimizer broadcasts a dimension of few names or days and splits skewed partitions otherwise. Sides that
grow with the data are joined by sorting (:func:`riskmart.functions.expr.large`).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskmart.functions.expr import large
from riskmart.operators.keys import (
    dense_key, insert_missing, natural_key_hash, next_key, one_per_key, upsert)
from riskmart.operators.snapshot import KeyedTable
from riskmart.session import settle

TRACKED = ["Age", "EmploymentStatus", "JobTitle", "HomeOwnershipStatus", "MaritalStatus", "PreviousLoanDefault"]
LOAN_KEY = ["CustomerSK", "LoanDateID", "LoanTypeID", "LoanAmount"]
LOAN_UPDATES = ["Balance", "DelayedPayments", "PaymentStatus"]
LOAN_VALUES = ["LoanDurationMonths", "InterestRate", "DelayedPayments", "Balance", "MonthlyPayment", "LoanToValueRatio",
               "PaymentStatus"]
CREDIT_VALUES = ["CreditScore", "NumBankAccounts", "NumCreditCards", "NumLoans", "NumCreditInquiries",
                 "CreditUtilizationRatio", "CreditHistoryLengthMonths", "CreditMixRatio"]
FRAUD_VALUES = ["DistanceFromHome", "DistanceFromLastTransaction", "RatioToMedianTransactionAmount",
                "IsOnlineTransaction", "IsUsedChip", "IsUsedPIN", "IsFraudulent"]
MARKET_VALUES = ["OpenValue", "CloseValue", "HighestValue", "LowestValue", "Volume", "InterestRate", "ExchangeRate",
                 "GoldPrice", "OilPrice", "VIX", "TEDSpread", "EFFR"]
MACRO_VALUES = ["UnemploymentRate", "GDP", "DebtRatio", "DeficitRatio", "InflationRate", "ConsumerPriceIndex",
                "HousePriceIndex"]


def _present(df: DataFrame, cols: Sequence[str]) -> list[str]:
    return [c for c in cols if c in df.columns]


def small_dim(source: DataFrame, name_col: str, id_col: str, existing: DataFrame | None = None,
              loose: bool = False) -> DataFrame:
    """Name dimension with dense ids; ``loose`` compares trimmed upper-case names."""
    names = source.select(F.trim(name_col).alias(name_col) if loose else F.col(name_col)).distinct()
    if existing is None:
        existing = source.sparkSession.createDataFrame([], f"{id_col} bigint, {name_col} string")
    return insert_missing(existing, names, [name_col], id_col, (lambda c: F.upper(F.trim(c))) if loose else (lambda c: c))


def load_dim_transaction(fraud: DataFrame, types: DataFrame, dates: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    """Transactions with date and type key; ids already present stay as they are."""
    days = dates.select(F.col("FullDate").alias("_day"), F.col("DateID").alias("TransactionDateID"))
    rows = (
        fraud.join(days, F.to_date("TransactionDate") == F.col("_day"))
        .join(types, "TransactionTypeName")
        .select("TransactionID", "TransactionDateID", "TransactionTypeID")
    )
    rows = one_per_key(rows, ["TransactionID"], ["TransactionDateID"])
    if existing is None:
        return rows
    return existing.unionByName(rows.join(large(existing), "TransactionID", "left_anti"))


def load_dim_account(loans: DataFrame, customers: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    """Accounts with their owner's current customer key, upserted by AccountID; new ones get dense keys."""
    values = _present(loans, ["AccountType", "PaymentBehavior"])
    latest = one_per_key(loans.select("AccountID", "CustomerID", *values, "LoanDate", "LoanID"), ["AccountID"],
                         ["LoanDate", "LoanID"])
    owned = latest.join(large(customers.filter("IsCurrent = 1").select("CustomerID", "CustomerSK")), "CustomerID").select(
        "AccountID", *values, "CustomerSK")
    if existing is None:
        return dense_key(owned, ["AccountID"], "AccountSK").select("AccountSK", "CustomerSK", "AccountID", *values)
    owned = settle(owned)  # known and new accounts both come from it
    updated = upsert(existing, owned.join(large(existing.select("AccountID")), "AccountID", "left_semi"), ["AccountID"],
                     [*values, "CustomerSK"])
    fresh = owned.join(large(existing), "AccountID", "left_anti")
    fresh = dense_key(fresh, ["AccountID"], "AccountSK", next_key(existing, "AccountSK"))
    return updated.unionByName(fresh, allowMissingColumns=True)


def stage_loans(loans: DataFrame, customers: DataFrame, types: DataFrame, dates: DataFrame) -> DataFrame:
    """Loans with resolved keys and the natural-key hash."""
    days = dates.select(F.col("FullDate").alias("_day"), F.col("DateID").alias("LoanDateID"))
    kinds = types.select(F.trim("LoanType").alias("_type"), "LoanTypeID")
    owners = large(customers.filter("IsCurrent = 1").select("CustomerID", "CustomerSK"))
    return (
        loans.join(days, F.to_date("LoanDate") == F.col("_day"))
        .join(kinds, F.trim("LoanType") == F.col("_type"))
        .join(owners, "CustomerID")
        .select(*LOAN_KEY, *_present(loans, LOAN_VALUES), "LoanID")
        .withColumn("NaturalKeyHash", natural_key_hash(LOAN_KEY))
    )


def fact_loan(loans: DataFrame, customers: DataFrame, types: DataFrame, dates: DataFrame,
              existing: DataFrame | None = None, on_duplicate: str = "latest") -> DataFrame:
    """Loans upserted on (customer, date, type, amount): known ones take balance, delays and status.

    Several staged rows with one natural key: the highest LoanID wins, or an error with ``on_duplicate='error'``.
    """
    latest = ["LoanID"] if on_duplicate == "latest" else None
    staged = stage_loans(loans, customers, types, dates)
    if existing is None:
        return one_per_key(staged, LOAN_KEY, latest)
    return upsert(existing, staged, LOAN_KEY, LOAN_UPDATES, latest_by=latest)


def loan_store(spark: SparkSession, root: str, buckets: int = 4) -> KeyedTable:
    """The fact of loans by month of the loan date, so that a later load rewrites the months it delivers."""
    return KeyedTable(spark, root, LOAN_KEY, [F.floor(F.col("LoanDateID") / 100)], buckets)


def merge_fact_loan(store: KeyedTable, loans: DataFrame, customers: DataFrame, types: DataFrame, dates: DataFrame, on_duplicate: str = "latest") -> DataFrame:
    """:func:`fact_loan` into a kept table: the first load creates it, later ones rewrite only the partitions of their loans."""
    latest = ["LoanID"] if on_duplicate == "latest" else None
    rows = stage_loans(loans, customers, types, dates)
    if not store.versions():
        return store.create(one_per_key(rows, LOAN_KEY, latest))
    return store.merge(rows, LOAN_UPDATES, latest_by=latest)


def fact_customer(loans: DataFrame, customers: DataFrame, dates: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    """Financial snapshot per customer and day. Aggregated on the raw customer id first, joined to the keys afterwards."""
    cents = "decimal(18,2)"

    def mean(c):
        return (F.sum(c) / F.count(c)).cast(cents)

    daily = loans.groupBy("CustomerID", F.to_date("LoanDate").alias("_day")).agg(
        F.max("AnnualIncome").alias("AnnualIncome"),
        F.sum("TotalAssets").cast(cents).alias("TotalAssets"),
        F.sum("TotalLiabilities").cast(cents).alias("TotalLiabilities"),
        F.sum("AnnualExpenses").cast(cents).alias("AnnualExpenses"),
        mean("MonthlySavings").alias("MonthlySavings"),
        F.sum("AnnualBonus").cast(cents).alias("AnnualBonus"),
        F.avg("DebtToIncomeRatio").alias("DebtToIncomeRatio"),
        F.max("PaymentHistoryYears").alias("PaymentHistoryYears"),
        F.max("JobTenureMonths").alias("JobTenureMonths"),
        F.max("NumDependents").alias("NumDependents"),
    )
    days = dates.select(F.col("FullDate").alias("_day"), F.col("DateID").alias("DateSK"))
    owners = large(customers.filter("IsCurrent = 1").select("CustomerID", "CustomerSK"))
    rows = daily.join(days, "_day").join(owners, "CustomerID").drop("_day", "CustomerID")
    rows = rows.select("CustomerSK", "DateSK", *[c for c in rows.columns if c not in ("CustomerSK", "DateSK")])
    if existing is None:
        return rows
    return upsert(existing, rows, ["CustomerSK", "DateSK"], [c for c in rows.columns if c not in ("CustomerSK", "DateSK")])


def fact_credit(loans: DataFrame, customers: DataFrame, accounts: DataFrame | None = None,
                existing: DataFrame | None = None) -> DataFrame:
    """One credit row per staged loan of customers that have none yet; the account is the loan's own."""
    owners = large(customers.filter("IsCurrent = 1").select("CustomerID", "CustomerSK"))
    rows = loans.join(owners, "CustomerID")
    if existing is not None:
        rows = rows.join(large(existing.select("CustomerSK").distinct()), "CustomerSK", "left_anti")
    if accounts is not None:
        rows = rows.join(large(accounts.select("AccountID", "AccountSK")), "AccountID", "left")
    else:
        rows = rows.withColumn("AccountSK", F.lit(None).cast("bigint"))
    rows = rows.select("CustomerSK", "AccountSK", *_present(loans, CREDIT_VALUES), "LoanID")
    start = 1 if existing is None else next_key(existing, "CreditID")
    rows = dense_key(rows, ["CustomerSK", "LoanID"], "CreditID", start).drop("LoanID")
    rows = rows.select("CreditID", *[c for c in rows.columns if c != "CreditID"])
    return rows if existing is None else existing.unionByName(rows, allowMissingColumns=True)


def fact_account(loans: DataFrame, accounts: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    """Balances of accounts that have no balance row yet."""
    rows = accounts.select("AccountSK", "AccountID")
    if existing is not None:
        rows = rows.join(large(existing.select("AccountSK")), "AccountSK", "left_anti")
    rows = loans.select("AccountID", "AccountBalance").join(large(rows), "AccountID").select("AccountSK", "AccountID", "AccountBalance")
    return rows if existing is None else existing.unionByName(rows)


def fact_fraud(fraud: DataFrame, customers: DataFrame, transactions: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    """One row per transaction of a current customer that is not loaded yet; of a transaction staged twice, the row that sorts last."""
    owners = large(customers.filter("IsCurrent = 1").select("CustomerID", "CustomerSK"))
    rows = (
        fraud.join(owners, "CustomerID")
        .join(large(transactions.select("TransactionID", "TransactionDateID")), "TransactionID")
        .select("TransactionID", "TransactionDateID", "CustomerSK", *_present(fraud, FRAUD_VALUES))
    )
    rows = one_per_key(rows, ["CustomerSK", "TransactionID"], ["TransactionDateID"]).select(*rows.columns)
    if existing is None:
        return rows
    return existing.unionByName(rows.join(large(existing), ["CustomerSK", "TransactionID"], "left_anti"), allowMissingColumns=True)


def fact_market(market: DataFrame, indexes: DataFrame, dates: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    """Market days upserted on (day, index); new rows get dense ids in that order."""
    values = _present(market, MARKET_VALUES)
    days = dates.select(F.col("FullDate").alias("_day"), "DateID")
    rows = (
        market.join(days, F.to_date("MarketDate") == F.col("_day"))
        .join(indexes, "MarketName")
        .select("DateID", "MarketIndexSK", *values)
    )
    key = ["DateID", "MarketIndexSK"]
    if existing is None:
        rows = dense_key(rows, key, "MarketID")
        return rows.select("MarketID", *key, *values)
    updated = upsert(existing, rows.join(existing.select(*key), key, "left_semi"), key, values)
    fresh = dense_key(rows.join(existing, key, "left_anti"), key, "MarketID", next_key(existing, "MarketID"))
    return updated.unionByName(fresh, allowMissingColumns=True)


def fact_economic(macro: DataFrame, countries: DataFrame, dates: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    """Economic indicators inserted where (day, country) is absent; of a pair staged twice, the row that sorts last."""
    values = _present(macro, MACRO_VALUES)
    days = dates.select(F.col("FullDate").alias("_day"), F.col("DateID").alias("ReportDateID"))
    key = ["ReportDateID", "CountryID"]
    rows = (
        macro.join(days, F.to_date("ReportDate") == F.col("_day"))
        .join(countries, "CountryName")
        .select(*key, *values)
    )
    rows = one_per_key(rows, key, []).select(*rows.columns)
    if existing is None:
        return dense_key(rows, key, "EconomicID").select("EconomicID", *key, *values)
    fresh = dense_key(rows.join(existing, key, "left_anti"), key, "EconomicID", next_key(existing, "EconomicID"))
    return existing.unionByName(fresh, allowMissingColumns=True)


__all__ = [
    "TRACKED", "small_dim", "load_dim_transaction", "load_dim_account", "stage_loans", "fact_loan", "loan_store", "merge_fact_loan", "fact_customer",
    "fact_credit", "fact_account", "fact_fraud", "fact_market", "fact_economic",
]
