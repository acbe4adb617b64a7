"""Report tables. Facts are reduced to the grain of the report before they are joined, so no sum is inflated."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from riskmart.functions.expr import null_apart

# Market region -> country of the economic row.
REGION_COUNTRY = {"North America": "USA", "Europe": "EU", "Asia": "China"}
CUSTOMER_COLS = ["CustomerSK", "CustomerID", "Age", "EmploymentStatus", "JobTitle", "HomeOwnershipStatus", "MaritalStatus", "PreviousLoanDefault"]


def _pct(a: Column, b: Column) -> Column:
    return F.try_divide(a.cast("double"), b.cast("double")) * 100


def _ratio(a: Column, b: Column) -> Column:
    return F.try_divide(a.cast("double"), b.cast("double"))


def _have(df: DataFrame, *cols: str) -> list[str]:
    return [c for c in cols if c in df.columns]


# --- risk ----------------------------------------------------------------------------------------------------------

def customer_risk(customers: DataFrame, fact_customer: DataFrame, fact_loan: DataFrame) -> DataFrame:
    """Per current customer: income, assets, liabilities and their ratios, loans, balances, delays."""
    money = fact_customer.groupBy("CustomerSK").agg(*[F.sum(c).alias(c) for c in ("AnnualIncome", "TotalAssets", "TotalLiabilities")])
    loans = fact_loan.groupBy("CustomerSK").agg(
        F.count("*").alias("ActiveLoansCount"), F.sum("LoanAmount").alias("TotalLoanAmount"), F.sum("Balance").alias("TotalOutstandingBalance"),
        F.count_if(F.col("PaymentStatus") == "Late").alias("LatePaymentsCount"), F.sum("DelayedPayments").alias("TotalDelayedPayments"))
    out = customers.filter("IsCurrent = 1").select(*_have(customers, *CUSTOMER_COLS)).join(money, "CustomerSK", "left").join(loans, "CustomerSK", "left")
    return out.withColumns({
        "LeverageRatio": _ratio(F.col("TotalLiabilities"), F.col("TotalAssets")),
        "DebtToIncomeRatio": _ratio(F.col("TotalLiabilities"), F.col("AnnualIncome")),
        "ActiveLoansCount": F.coalesce("ActiveLoansCount", F.lit(0)),
        "LatePaymentsCount": F.coalesce("LatePaymentsCount", F.lit(0)),
    })


def loan_performance(fact_loan: DataFrame, dates: DataFrame, types: DataFrame, customers: DataFrame, fact_customer: DataFrame) -> DataFrame:
    """One row per loan with calendar, type, owner, the owner's snapshot of that day and a risk label."""
    late = F.col("PaymentStatus") == "Late"
    label = (
        F.when(F.col("PaymentStatus") == "On Time", "Good Standing")
        .when(late & (F.col("DelayedPayments") <= 3), "Moderate Risk").when(late & (F.col("DelayedPayments") > 3), "High Risk")
        .when(F.col("PaymentStatus") == "Defaulted", "Default").otherwise("Other"))
    days = dates.select(F.col("DateID").alias("LoanDateID"), F.col("Year").alias("LoanYear"), F.col("Quarter").alias("LoanQuarter"), F.col("MonthNumber").alias("LoanMonth"))
    owners = customers.select("CustomerSK", "CustomerID", "EmploymentStatus", "HomeOwnershipStatus")
    money = fact_customer.select("CustomerSK", F.col("DateSK").alias("LoanDateID"), "AnnualIncome", "DebtToIncomeRatio")
    return (
        fact_loan.join(days, "LoanDateID").join(types.select("LoanTypeID", "LoanType"), "LoanTypeID").join(owners, "CustomerSK")
        .join(money, ["CustomerSK", "LoanDateID"], "left")
        .select("LoanID", "LoanYear", "LoanQuarter", "LoanMonth", "LoanType", "LoanAmount", "InterestRate", "LoanDurationMonths", "Balance", "DelayedPayments",
                "PaymentStatus", *_have(fact_loan, "LoanToValueRatio"), "CustomerID", "EmploymentStatus", "HomeOwnershipStatus", "AnnualIncome", "DebtToIncomeRatio",
                label.alias("RiskCategory")))


def fraud_analysis(fraud: DataFrame, dates: DataFrame, customers: DataFrame, fact_loan: DataFrame, types: DataFrame) -> DataFrame:
    """Fraud cases with calendar, owner, loan if known, and the loss after recovery."""
    days = dates.select(F.col("DateID").alias("DetectionDateID"), F.col("FullDate").alias("DetectionDate"), F.col("Year").alias("DetectionYear"),
                        F.col("Quarter").alias("DetectionQuarter"), F.col("MonthNumber").alias("DetectionMonth"))
    loans = fact_loan.select(F.col("LoanID").cast("string").alias("_loan_key"), "LoanAmount", "LoanDurationMonths", "InterestRate", "LoanTypeID")
    kinds = types.select(F.col("LoanTypeID").cast("string").alias("_type_key"), "LoanType")
    owners = customers.select("CustomerSK", "CustomerID", "Age", "EmploymentStatus", "HomeOwnershipStatus")
    return (
        fraud.join(days, "DetectionDateID").join(owners, "CustomerSK")
        .withColumn("_loan", null_apart("LoanID")).join(loans, F.col("_loan") == F.col("_loan_key"), "left")
        .withColumn("_type", null_apart("LoanTypeID")).join(kinds, F.col("_type") == F.col("_type_key"), "left")
        .select("FraudID", "DetectionDate", "DetectionYear", "DetectionQuarter", "DetectionMonth",
                *_have(fraud, "FraudType", "DetectionMethod", "InvestigationStatus", "Resolution"), "FraudAmount", "RecoveredAmount",
                (F.col("FraudAmount") - F.col("RecoveredAmount")).alias("LossAmount"), "CustomerID", "Age", "EmploymentStatus", "HomeOwnershipStatus",
                "LoanAmount", "LoanDurationMonths", "InterestRate", "LoanType"))


def market_analysis(market: DataFrame, dates: DataFrame, macro: DataFrame, region: str = "Region",
                    countries: Mapping[str, str] = REGION_COUNTRY, fallback: str = "Global") -> DataFrame:
    """Market rows with calendar and the economic row of the region's country."""
    place = F.lit(fallback)
    for area, country in countries.items():
        place = F.when(F.col(region) == area, country).otherwise(place)
    days = dates.select("DateID", F.col("FullDate").alias("MarketDate"), "Year", "Quarter", F.col("MonthNumber").alias("Month"))
    econ = macro.withColumnRenamed("InterestRate", "MacroInterestRate") if "InterestRate" in macro.columns else macro
    joined = market.join(days, "DateID").withColumn("Country", place).join(econ, ["DateID", "Country"], "left")
    return joined.select("MarketDate", "Year", "Quarter", "Month", *[c for c in market.columns if c != "DateID"],
                         *[c for c in econ.columns if c not in ("DateID", "Country")])


def risk_dashboard(fact_loan: DataFrame, dates: DataFrame, types: DataFrame, fraud: DataFrame, macro: DataFrame, country: str) -> DataFrame:
    """By year, quarter, month and loan type: loans, amounts, late, defaults, fraud, mean economic rates."""
    cases = fraud.filter(F.col("LoanID").isNotNull()).groupBy("LoanID").agg(F.count("*").alias("_cases"), F.sum("FraudAmount").alias("_fraud"))
    days = dates.select(F.col("DateID").alias("LoanDateID"), "Year", "Quarter", F.col("MonthNumber").alias("Month"))
    rates = ["UnemploymentRate", "InterestRate", "InflationRate"]
    rates = _have(macro, *rates)
    econ = macro.filter(F.col("Country") == country).groupBy(F.col("DateID").alias("LoanDateID")).agg(*[F.avg(r).alias(f"_{r}") for r in rates])
    defaulted = F.col("PaymentStatus") == "Defaulted"
    return (
        fact_loan.join(cases, "LoanID", "left").join(days, "LoanDateID").join(types.select("LoanTypeID", "LoanType"), "LoanTypeID").join(econ, "LoanDateID", "left")
        .groupBy("Year", "Quarter", "Month", "LoanType")
        .agg(
            F.count("*").alias("TotalLoans"), F.sum("LoanAmount").alias("TotalLoanAmount"), F.sum("Balance").alias("TotalOutstandingBalance"),
            F.count_if(F.col("PaymentStatus") == "Late").alias("LatePaymentsCount"), F.count_if(defaulted).alias("DefaultsCount"),
            F.coalesce(F.sum(F.when(defaulted, F.col("Balance"))), F.lit(0)).alias("DefaultedBalance"),
            F.coalesce(F.sum("_cases"), F.lit(0)).alias("FraudCases"), F.coalesce(F.sum("_fraud"), F.lit(0)).alias("TotalFraudAmount"),
            *[F.avg(f"_{r}").alias(f"Avg{r}") for r in rates]))


# --- IFRS 9 --------------------------------------------------------------------------------------------------------

def _people(customers: DataFrame) -> DataFrame:
    return customers.select("CustomerSK", "CustomerID", *_have(customers, "CustomerName"))


def _accounts(accounts: DataFrame) -> DataFrame:
    return accounts.select("AccountSK", "AccountNumber", "AccountType")


def instrument_classification(classification: DataFrame, customers: DataFrame, accounts: DataFrame) -> DataFrame:
    """Classification with owner and account."""
    return classification.join(_people(customers), "CustomerSK").join(_accounts(accounts), "AccountSK").select(
        *_people(customers).columns[1:], "AccountNumber", "AccountType", "ClassificationCategory", "BusinessModelAssessment", "CashflowCharacteristics",
        "ClassificationDate", "LastReassessmentDate")


def ecl_staging_summary(stages: DataFrame, loans: DataFrame, calc: DataFrame) -> DataFrame:
    """By date and stage: accounts, gross amount, loss, ratio, stage changes."""
    key = ["CustomerSK", "AccountSK"]
    joined = stages.join(loans.select(*key, "CurrentBalance"), key).join(calc.select(*key, "AsOfDate", "AppliedECL"), [*key, "AsOfDate"])
    out = joined.groupBy(F.col("AsOfDate").alias("ReportDate"), "ECLStage").agg(
        F.count("*").alias("AccountCount"), F.sum("CurrentBalance").alias("GrossCarryingAmount"), F.sum("AppliedECL").alias("TotalECL"),
        F.count_if(F.col("StageChangeDate") == F.col("AsOfDate")).alias("StageChangesCount"))
    return out.withColumn("ECLRatio", _pct(F.col("TotalECL"), F.col("GrossCarryingAmount")))


def ecl_detail(calc: DataFrame, customers: DataFrame, accounts: DataFrame, loans: DataFrame, scenarios: DataFrame) -> DataFrame:
    """One row per calculation with loan and scenario.

    Loans meet their owners and accounts first: there are fewer of them than calculations, which are wide and cross one shuffle only.
    """
    key = ["CustomerSK", "AccountSK"]
    loans = loans.select(*key, "CurrentBalance", "InterestRate", "MaturityDate", "DaysPastDue")
    return (
        calc.join(loans.join(_accounts(accounts), "AccountSK").join(_people(customers), "CustomerSK"), key)
        .join(scenarios.select("ScenarioID", "ScenarioName", "ScenarioWeight"), "ScenarioID")
        .select(F.col("AsOfDate").alias("ReportDate"), *_people(customers).columns[1:], "AccountNumber", "AccountType", "ECLStage", "GrossCarryingAmount", "AppliedECL",
                "NetCarryingAmount", "PD_Applied", "LGD_Applied", "EAD_Applied", "DiscountFactor", "CurrentBalance", "InterestRate", "MaturityDate", "DaysPastDue",
                "ScenarioName", "ScenarioWeight"))


def macro_impact(calc: DataFrame, scenarios: DataFrame, indicators: DataFrame) -> DataFrame:
    """By date, scenario and its indicators: accounts, exposure, loss, ratio.

    ``indicators`` has one row per scenario and date, so the calculations are summed per scenario and date first.
    """
    sums = calc.groupBy("AsOfDate", "DateID", "ScenarioID").agg(
        F.countDistinct("AccountSK").alias("AccountCount"), F.sum("GrossCarryingAmount").alias("TotalExposure"), F.sum("AppliedECL").alias("TotalECL"))
    extra = [c for c in indicators.columns if c not in ("ScenarioID", "DateID")]
    joined = sums.join(scenarios.select("ScenarioID", "ScenarioName", "ScenarioWeight"), "ScenarioID").join(indicators, ["ScenarioID", "DateID"])
    return joined.select(F.col("AsOfDate").alias("ReportDate"), "ScenarioName", "ScenarioWeight", *extra, "AccountCount", "TotalExposure", "TotalECL",
                         _pct(F.col("TotalECL"), F.col("TotalExposure")).alias("ECLRatio"))


def sicr_monitoring(stages: DataFrame, calc: DataFrame, customers: DataFrame, accounts: DataFrame, loans: DataFrame) -> DataFrame:
    """Stage and PD against the account's previous run, only where the stage changed or the account is new."""
    key = ["CustomerSK", "AccountSK"]
    rows = stages.select(*key, "AsOfDate", F.col("ECLStage").alias("CurrentStage")).join(
        calc.select(*key, "AsOfDate", F.col("PD_Applied").alias("CurrentPD")), [*key, "AsOfDate"], "left")
    # An account has one row per run date, so a window partition is as long as the number of runs.
    runs = W.partitionBy(*key).orderBy("AsOfDate")
    rows = rows.withColumns({"PreviousStage": F.lag("CurrentStage").over(runs), "PreviousPD": F.lag("CurrentPD").over(runs)})
    rows = rows.filter(F.col("PreviousStage").isNull() | (F.col("PreviousStage") != F.col("CurrentStage")))
    return (
        rows.join(_people(customers), "CustomerSK").join(_accounts(accounts), "AccountSK")
        .join(loans.select(*key, "DaysPastDue", F.col("CurrentBalance").alias("ExposureAmount")), key)
        .select(F.col("AsOfDate").alias("ReportDate"), *_people(customers).columns[1:], "AccountNumber", "AccountType", "CurrentStage", "PreviousStage", "CurrentPD", "PreviousPD",
                (F.try_divide(F.col("CurrentPD") - F.col("PreviousPD"), F.col("PreviousPD")) * 100).alias("PD_PercentChange"), "DaysPastDue", "ExposureAmount"))


def classification_changes(classification: DataFrame, history: DataFrame, customers: DataFrame, accounts: DataFrame) -> DataFrame:
    """Classifications that differ from the history row ending on their date, or have none."""
    key = ["CustomerSK", "AccountSK"]
    old = history.select(*key, F.col("EffectiveEndDate").alias("ClassificationDate"), F.col("ClassificationCategory").alias("PreviousClassification"))
    joined = classification.join(old, [*key, "ClassificationDate"], "left")
    changed = F.col("PreviousClassification").isNull() | (F.col("PreviousClassification") != F.col("ClassificationCategory"))
    return joined.filter(changed).join(_people(customers), "CustomerSK").join(_accounts(accounts), "AccountSK").select(
        *_people(customers).columns[1:], "AccountNumber", "AccountType", F.col("ClassificationCategory").alias("CurrentClassification"), "PreviousClassification",
        "ClassificationDate", "BusinessModelAssessment", "CashflowCharacteristics")


def ifrs9_vs_ias39(calc: DataFrame, provisions: DataFrame, accounts: DataFrame) -> DataFrame:
    """Loss against the earlier provision by date, account type and product category."""
    joined = calc.join(provisions, ["CustomerSK", "AccountSK", "DateID"]).join(accounts.select("AccountSK", "AccountType", "ProductCategory"), "AccountSK")
    out = joined.groupBy(F.col("AsOfDate").alias("ReportDate"), "AccountType", "ProductCategory").agg(
        F.countDistinct("AccountSK").alias("AccountCount"), F.sum("GrossCarryingAmount").alias("TotalExposure"), F.sum("AppliedECL").alias("IFRS9_ECL"),
        F.sum("HistoricalProvision").alias("IAS39_Provision"), F.sum(F.col("AppliedECL") - F.col("HistoricalProvision")).alias("ProvisionDifference"))
    return out.withColumn("PercentageChange", _pct(F.col("IFRS9_ECL"), F.col("IAS39_Provision")) - 100)


def modifications(events: DataFrame, dates: DataFrame, customers: DataFrame, accounts: DataFrame) -> DataFrame:
    """Modification events with date, owner and account."""
    days = dates.select(F.col("DateID").alias("ModificationDateID"), F.col("FullDate").alias("ModificationDate"))
    extra = [c for c in events.columns if c not in ("CustomerSK", "AccountSK", "ModificationDateID")]
    return events.join(days, "ModificationDateID").join(_people(customers), "CustomerSK").join(_accounts(accounts), "AccountSK").select(
        "ModificationDate", *_people(customers).columns[1:], "AccountNumber", "AccountType", *extra)


def ecl_summary(calc: DataFrame, dates: DataFrame, scenarios: DataFrame) -> DataFrame:
    """By date, stage and scenario: accounts, exposure, loss, coverage, mean PD and LGD in percent."""
    sums = calc.groupBy("AsOfDate", "DateID", "ECLStage", "ScenarioID").agg(
        F.countDistinct("AccountSK").alias("AccountCount"), F.sum("GrossCarryingAmount").alias("TotalExposure"), F.sum("AppliedECL").alias("TotalECL"),
        (F.avg("PD_Applied") * 100).alias("AvgPD"), (F.avg("LGD_Applied") * 100).alias("AvgLGD"))
    joined = sums.join(dates.select("DateID", "Year", "Quarter", "MonthName"), "DateID").join(scenarios.select("ScenarioID", "ScenarioName"), "ScenarioID")
    return joined.select("AsOfDate", "Year", "Quarter", "MonthName", "ECLStage", "ScenarioName", "AccountCount", "TotalExposure", "TotalECL",
                         _pct(F.col("TotalECL"), F.col("TotalExposure")).alias("ECLCoverageRatio"), "AvgPD", "AvgLGD")
