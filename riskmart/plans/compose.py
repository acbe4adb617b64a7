"""Whole runs composed from the operators, and named strategies."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskmart.operators import clean, conform, generate, repair, scd, validate
from riskmart.operators.knn import impute_numeric
from riskmart.plans import gate, marts, measures, scoring
from riskmart.plans.runlog import step_log
from riskmart.session import settle
from riskmart.session import staged as write_staged
from riskmart.sources.colocated import save_colocated
from riskmart.sources.date_dim import build_date_dim
from riskmart.sources.files import add_lineage

#: Facts without which a load is no load.
REQUIRED_FACTS = ("FactLoan", "FactCustomer", "FactCredit", "FactFraud", "FactMarket", "FactEconomicIndicators")
KINDS = ("process", "transform", "validate", "fix")


class EmptyResult(RuntimeError):
    """A step left no rows, or a required table has none."""


# --- strategies ----------------------------------------------------------------------------------------------------

class Strategies:
    """Named, replaceable steps ``DataFrame -> DataFrame`` of the four kinds."""

    def __init__(self):
        self._steps: dict[tuple[str, str], Callable[[DataFrame], DataFrame]] = {}

    def register(self, kind: str, name: str, step: Callable[[DataFrame], DataFrame]) -> None:
        if kind not in KINDS:
            raise ValueError(f"unknown kind of strategy: {kind}")
        self._steps[(kind, name)] = step

    def get(self, kind: str, name: str) -> Callable[[DataFrame], DataFrame]:
        try:
            return self._steps[(kind, name)]
        except KeyError:
            raise KeyError(f"no {kind} strategy named {name}") from None

    def names(self, kind: str) -> list[str]:
        return [n for k, n in self._steps if k == kind]

    def apply(self, kind: str, names: Sequence[str], df: DataFrame) -> DataFrame:
        """The named steps in order."""
        return reduce(lambda d, n: d.transform(self.get(kind, n)), names, df)


# --- from raw to cooked --------------------------------------------------------------------------------------------

def clean_dataset(df: DataFrame, key: Sequence[str], owner: str | None = None, seed: int = 0, keep: Sequence[str] = (), k: int | None = None) -> DataFrame:
    """Text, dates, numbers, categories and a first clean-up. Numbers take the median, or the mean of ``k`` neighbours."""
    df = clean.infer_numeric(clean.clean_text(df))
    df = clean.parse_durations(clean.parse_dates(df))
    df = settle(impute_numeric(df, key, k, seed=seed))
    df = clean.float_to_int(clean.round_numeric(df))
    df = clean.drop_redundant_columns(df, keep=[*key, *keep])
    return clean.cleanup(clean.fill_categorical(clean.binarize(df), owner, key))


def cook_dataset(df: DataFrame, dataset: str, schema: T.StructType, mapping: Mapping[str, str], key: Sequence[str], as_of,
                 donors: dict[str, DataFrame] | None = None, seed: int = 0, batch_id: str | None = None, clean_first: bool = True) -> tuple[DataFrame, DataFrame]:
    """(finished table, test rows before and after repair) of one dataset.

    Clean, map to the schema, generate what is missing, validate, repair, validate again, conform. ``key`` names target
    columns that identify a row; the table is saved once after the mapping, because the checks, statistics and repairs
    all read it.
    """
    if clean_first:
        sources = [mapping[k] for k in key if k in mapping]
        df = clean_dataset(df, sources or key, seed=seed, keep=list(mapping.values()))
    mapped, absent = conform.map_to_schema(df, schema, mapping, as_of)
    filled = generate.relate_columns(generate.generate_missing(mapped, schema, absent, key, seed, as_of, donors), key, seed)
    filled = settle(filled)
    before = validate.validate_dataset(filled, dataset, as_of, "pre", schema)
    fixed = settle(repair.repair_dataset(filled, dataset, as_of))
    after = validate.validate_dataset(fixed, dataset, as_of, "post", schema)
    done = conform.conform_constraints(clean.cleanup(fixed), dataset, schema, key)
    if dataset == "Loan" and "AccountID" in done.columns:
        done = conform.suffix_duplicate_ids(done, "AccountID", key)
    if batch_id is not None:
        done = add_lineage(done, batch_id, as_of)
    if done.isEmpty():
        raise EmptyResult(f"no rows left of {dataset}")
    return done, before.unionByName(after)


# --- from staged tables to the mart --------------------------------------------------------------------------------

def keep_columns(df: DataFrame) -> DataFrame:
    """``df`` saved by columns, of which a later step reads only its own."""
    return write_staged(df, "mart")


def stage_to_mart(staged: Mapping[str, DataFrame], as_of, country: str, log: DataFrame | None = None, existing: Mapping[str, DataFrame] | None = None,
                  exact_date: bool = False, save=keep_columns, fail_on_error: bool = False, loan_store=None,
                  customer_buckets: int | None = None) -> dict[str, DataFrame]:
    """One load: gate, dimensions, facts, scores, reconciliation.

    ``staged`` holds Loan, Fraud, Market and Macro, ``existing`` the mart tables of earlier loads. Tables used by several
    later steps are saved once. The load stops when the loans or a required fact are empty, and with ``fail_on_error`` when a check of
    the gate fails. ``etl_log`` has a row per saved table. With ``loan_store`` (:func:`riskmart.plans.marts.loan_store`) the fact of loans is kept there, and a
    later load rewrites only the months it delivers. With ``customer_buckets`` the facts that the scores read are saved in that many buckets of the customer
    and scored without shuffling them (:mod:`riskmart.sources.colocated`).
    """
    old = dict(existing or {})
    loan, fraud, market, macro = (staged[n] for n in gate.REQUIRED)
    if loan.isEmpty():
        raise EmptyResult("the staged loans are empty")
    out: dict[str, DataFrame] = {}
    if log is not None:
        out["gate"] = save(gate.validate_pre_production(staged, log, as_of))
        if fail_on_error:
            gate.require_pass(out["gate"])
    days = out["DimDate"] = old.get("DimDate", build_date_dim(loan.sparkSession, "2015-01-01", "2030-12-31"))
    types = out["DimLoanType"] = save(marts.small_dim(loan, "LoanType", "LoanTypeID", old.get("DimLoanType"), loose=True))
    latest = ["LoanDate", "LoanID"]
    if "DimCustomer" in old:
        customers = scd.scd2_apply(old["DimCustomer"], loan, "CustomerID", marts.TRACKED, as_of, "CustomerSK", latest)
    else:
        customers = scd.scd2_start(loan, "CustomerID", marts.TRACKED, as_of, "CustomerSK", latest)
    customers = out["DimCustomer"] = save(customers)
    places = out["DimCountry"] = save(marts.small_dim(macro, "CountryName", "CountryID", old.get("DimCountry")))
    kinds = out["DimTransactionType"] = save(marts.small_dim(fraud, "TransactionTypeName", "TransactionTypeID", old.get("DimTransactionType")))
    indexes = out["DimMarketIndex"] = save(marts.small_dim(market, "MarketName", "MarketIndexSK", old.get("DimMarketIndex")))
    transactions = out["DimTransaction"] = save(marts.load_dim_transaction(fraud, kinds, days, old.get("DimTransaction")))
    accounts = out["DimAccount"] = save(marts.load_dim_account(loan, customers, old.get("DimAccount")))

    if loan_store is not None:
        out["FactLoan"] = marts.merge_fact_loan(loan_store, loan, customers, types, days)
    else:
        out["FactLoan"] = save(marts.fact_loan(loan, customers, types, days, old.get("FactLoan")))
    out["FactCustomer"] = save(marts.fact_customer(loan, customers, days, old.get("FactCustomer")))
    out["FactCredit"] = save(marts.fact_credit(loan, customers, accounts, old.get("FactCredit")))
    if "AccountBalance" in loan.columns:
        out["FactAccount"] = marts.fact_account(loan, accounts, old.get("FactAccount"))
    out["FactFraud"] = save(marts.fact_fraud(fraud, customers, transactions, old.get("FactFraud")))
    out["FactMarket"] = save(marts.fact_market(market, indexes, days, old.get("FactMarket")))
    out["FactEconomicIndicators"] = save(marts.fact_economic(macro, places, days, old.get("FactEconomicIndicators")))
    for name in REQUIRED_FACTS:
        if out[name].isEmpty():
            raise EmptyResult(f"{name} is empty after the load")

    dated = days.select("DateID", F.col("FullDate"))
    cases = out["FactFraud"].join(dated, F.col("TransactionDateID") == F.col("DateID")).withColumn("TransactionDate", F.col("FullDate"))
    prices = measures.market_measures(out["FactMarket"].join(dated, "DateID").withColumnRenamed("FullDate", "MarketDate"))
    economy = (out["FactEconomicIndicators"].join(dated, F.col("ReportDateID") == F.col("DateID")).withColumnRenamed("FullDate", "ReportDate")
               .join(places, "CountryID"))
    facts = {"customers": out["FactCustomer"], "credit": out["FactCredit"], "loans": out["FactLoan"], "fraud": cases}
    if "FactRiskProfile" in old:
        facts["profile"] = old["FactRiskProfile"]

    def score(f: Mapping[str, DataFrame]) -> DataFrame:
        return scoring.risk_profile(f["customers"], f["credit"], f["loans"], f["fraud"], prices, economy, as_of, country, f.get("profile"), exact_date)

    rows = save_colocated(facts, "CustomerSK", customer_buckets).each(score) if customer_buckets else score(facts)
    out["FactRiskProfile"] = save(scoring.update_risk_profile(old["FactRiskProfile"], rows) if "FactRiskProfile" in old else rows)

    current = scd.current_rows(customers)
    out["reconciliation"] = validate.reconcile_counts("customers", current, out["FactCustomer"].select("CustomerSK").distinct()).unionByName(
        validate.reconcile_counts("loans", loan, out["FactLoan"]))
    steps = [step_log(df, "stage_to_mart", name, 0, as_of) for name, df in out.items() if name.startswith(("Dim", "Fact"))]
    out["etl_log"] = reduce(DataFrame.unionByName, steps)
    return out
