"""IFRS 9: instrument classification, ECL stages, risk parameters, expected credit loss and its movement."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskmart.functions.expr import attach_stats, floor_band, month_gap
from riskmart.operators.keys import upsert
from riskmart.session import settle

KEY = ["CustomerSK", "AccountSK"]
DATED = [*KEY, "AsOfDate"]

# Probability of default by credit score, multiplier by days past due, loss given default by collateral.
PD_12M_BY_SCORE = ((750, 0.005), (700, 0.01), (650, 0.02), (600, 0.05), (550, 0.10))
PD_LIFE_BY_SCORE = ((750, 0.015), (700, 0.03), (650, 0.06), (600, 0.15), (550, 0.30))
PD_12M_WORST, PD_LIFE_WORST, PD_12M_DEFAULT, PD_LIFE_DEFAULT = 0.20, 0.50, 0.02, 0.05
PAST_DUE_FACTOR = ((90, 9.0), (60, 6.0), (30, 3.0), (1, 1.5))
LGD_BY_COLLATERAL = (("REAL_ESTATE", 0.15), ("VEHICLE", 0.35), ("SECURITIES", 0.25), ("NONE", 0.75))
LGD_OTHER, LGD_NONE, LGD_DEFAULT = 0.50, 0.75, 0.45
EAD_DEFAULT, EIR_DEFAULT, MATURITY_DEFAULT = 10000.0, 0.05, 36
SCENARIOS = ((1, "Base", 0.60), (2, "Upside", 0.15), (3, "Downside", 0.15), (4, "Severe", 0.10))


def _day(d) -> Column:
    return F.lit(d).cast("date")


def _flag(c: str) -> Column:
    return F.coalesce(F.col(c) == 1, F.lit(False))


def _cents(c: Column) -> Column:
    """Money to cents, half up on eight decimals (binary noise below that must not decide a tie)."""
    return F.round(c.cast("decimal(28,8)"), 2).cast("double")


# --- classification ------------------------------------------------------------------------------------------------

def classify_instruments(accounts: DataFrame, existing: DataFrame | None, as_of, force: bool = False) -> DataFrame:
    """Classification table after classifying open accounts that have none yet (all of them with ``force``)."""
    kind = F.col("AccountType")
    hold, sell, trade = _flag("HoldToMaturityFlag"), _flag("HoldToCollectAndSellFlag"), _flag("TradingFlag")
    category = (
        F.when(kind.isin("LOAN", "BOND") & hold, "Amortized Cost")
        .when((kind == "BOND") & sell, "FVOCI")
        .when(kind.isin("EQUITY", "DERIVATIVE") | trade, "FVTPL")
        .otherwise("Amortized Cost"))
    model = F.when(hold, "Hold to Collect").when(sell, "Hold to Collect and Sell").when(trade, "Other").otherwise("Hold to Collect")
    plain = kind.isin("LOAN", "BOND") & (F.col("HasNonSPPIFeatures") == 0)
    cashflow = F.when(plain, "SPPI").when(kind.isin("EQUITY", "DERIVATIVE") | _flag("HasNonSPPIFeatures"), "Non-SPPI").otherwise("SPPI")
    rows = accounts.filter((F.col("IsActive") == 1) & F.col("AccountClosedDate").isNull()).select(
        *KEY, kind.alias("InstrumentTypeCode"), category.alias("ClassificationCategory"), model.alias("BusinessModelAssessment"),
        cashflow.alias("CashflowCharacteristics"), _day(as_of).alias("ClassificationDate"),
        _day(as_of).alias("LastReassessmentDate"), F.lit("Initial classification or reclassification").alias("JustificationText"))
    return _merge_classification(rows, existing, force)


def classify_instruments_basic(accounts: DataFrame, existing: DataFrame | None, as_of, force: bool = False) -> DataFrame:
    """Classification by account type only, for accounts without business-model flags."""
    kind = F.col("AccountType")
    credit = kind.isin("LOAN", "MORTGAGE", "BOND")
    rows = accounts.select(
        *KEY, kind.alias("InstrumentTypeCode"),
        F.when(kind.isin("LOAN", "MORTGAGE"), "Amortized Cost").when(kind == "BOND", "FVOCI").otherwise("FVTPL").alias("ClassificationCategory"),
        F.when(credit, "Hold to Collect").otherwise("Other").alias("BusinessModelAssessment"),
        F.when(credit, "SPPI").otherwise("Non-SPPI").alias("CashflowCharacteristics"), _day(as_of).alias("ClassificationDate"),
        _day(as_of).alias("LastReassessmentDate"), F.lit("Initial default classification").alias("JustificationText"))
    return _merge_classification(rows, existing, force)


def _merge_classification(rows: DataFrame, existing: DataFrame | None, force: bool) -> DataFrame:
    fresh = rows.withColumn("LastReassessmentDate", F.lit(None).cast("date"))
    if existing is None:
        return fresh
    if not force:
        return existing.unionByName(fresh.join(existing.select(*KEY), KEY, "left_anti"), allowMissingColumns=True)
    updates = ["InstrumentTypeCode", "ClassificationCategory", "BusinessModelAssessment", "CashflowCharacteristics", "LastReassessmentDate"]
    merged = upsert(existing, rows, KEY, updates)
    # A new row has not been reassessed yet.
    known = existing.select(*KEY, F.lit(1).alias("_known"))
    return merged.join(known, KEY, "left").withColumn(
        "LastReassessmentDate", F.when(F.col("_known").isNotNull(), F.col("LastReassessmentDate"))).select(*existing.columns)


# --- stages --------------------------------------------------------------------------------------------------------

def ecl_stage(loans: DataFrame, as_of) -> DataFrame:
    """Stage 1, 2 or 3 of active loans on open accounts, with the two indicator flags."""
    late = F.col("DaysPastDue")
    impaired = _flag("IsDefaulted") | (late >= 90) | _flag("BankruptcyFlag") | _flag("ChargeOffFlag")
    risen = ((F.col("CreditScoreDecreasePercent") >= 15) | late.between(30, 89) | _flag("WatchListFlag")
             | _flag("ModifiedLoanFlag") | _flag("ForbearanceFlag"))
    active = loans.filter("IsActive = 1")
    if "AccountClosedDate" in loans.columns:
        active = active.filter("AccountClosedDate is null")
    return active.select(
        *KEY, _day(as_of).alias("AsOfDate"), F.when(impaired, 3).when(risen, 2).otherwise(1).alias("ECLStage"),
        F.when(risen, 1).otherwise(0).alias("SignificantIncreaseInCreditRisk"), F.when(impaired, 1).otherwise(0).alias("CreditImpaired"), "DaysPastDue")


def stage_history(stages: DataFrame, history: DataFrame | None, as_of) -> DataFrame:
    """Stages with the stage of the latest earlier run and the date of a change; the first run starts at stage 1."""
    if history is None:
        return stages.withColumns({
            "PreviousStage": F.lit(1), "StageChangeDate": _day(as_of), "StageChangeReason": F.lit("Initial Classification")})
    earlier = history.filter(F.col("AsOfDate") < _day(as_of)).select(*KEY, F.col("AsOfDate").alias("_run"), F.col("ECLStage").alias("_was"))
    last = earlier.agg(F.max("_run").alias("_last"))
    before = attach_stats(earlier, last).filter("_run = _last").select(*KEY, "_was")
    joined = attach_stats(stages.join(before, KEY, "left"), last)
    first = F.col("_last").isNull()
    return joined.select(
        *[F.col(c) for c in stages.columns],
        F.when(first, 1).otherwise(F.col("_was")).alias("PreviousStage"),
        F.when(first | (F.col("_was") != F.col("ECLStage")), _day(as_of)).alias("StageChangeDate"),
        F.when(first, "Initial Classification").otherwise("Classification Update").alias("StageChangeReason"))


def update_stages(target: DataFrame, rows: DataFrame) -> DataFrame:
    """Stage table with the rows of one run upserted."""
    return upsert(target, rows, DATED, [c for c in rows.columns if c not in DATED])


def _run_upserted(target: DataFrame, rows: DataFrame, as_of) -> tuple[DataFrame, DataFrame]:
    """(whole table, its part of the date) after the upsert of the rows of one date: rows of other dates match nothing and cross no shuffle."""
    same = F.coalesce(F.col("AsOfDate") == _day(as_of), F.lit(False))
    part = update_stages(target.filter(same), rows)
    return target.filter(~same).unionByName(part), part


# --- parameters ----------------------------------------------------------------------------------------------------

def _past_due(df: DataFrame) -> Column:
    return floor_band("DaysPastDue", PAST_DUE_FACTOR, 1.0) if "DaysPastDue" in df.columns else F.lit(1.0)


def pd_12m(df: DataFrame, cap: bool = False) -> Column:
    """Probability of default within 12 months from credit score and days past due."""
    base = floor_band("CreditScore", PD_12M_BY_SCORE, PD_12M_WORST) if "CreditScore" in df.columns else F.lit(PD_12M_DEFAULT)
    out = base * _past_due(df)
    return F.least(out, F.lit(1.0)) if cap else out


def pd_lifetime(df: DataFrame, cap: bool = False) -> Column:
    """Probability of default over the whole term; 20 % more per full five years of term."""
    base = floor_band("CreditScore", PD_LIFE_BY_SCORE, PD_LIFE_WORST) if "CreditScore" in df.columns else F.lit(PD_LIFE_DEFAULT)
    out = base * _past_due(df)
    if "TermMonths" in df.columns:
        out = out * (1 + F.floor(F.col("TermMonths") / 60) * 0.2)
    return F.least(out, F.lit(1.0)) if cap else out


def lgd(df: DataFrame) -> Column:
    """Loss given default by collateral."""
    if "CollateralType" not in df.columns:
        return F.lit(LGD_DEFAULT)
    out = F.when(F.col("CollateralType").isNull(), LGD_NONE)
    for kind, value in LGD_BY_COLLATERAL:
        out = out.when(F.col("CollateralType") == kind, value)
    return out.otherwise(LGD_OTHER)


def ead(df: DataFrame) -> Column:
    """Exposure at default; revolving loans add half of the unused limit."""
    if "CurrentBalance" not in df.columns:
        return F.lit(EAD_DEFAULT)
    balance = F.col("CurrentBalance").cast("double")
    if {"LoanType", "CreditLimit"} <= set(df.columns):
        drawn = balance + (F.col("CreditLimit").cast("double") - balance) * 0.5
        return F.when(F.col("LoanType") == "REVOLVING", drawn).otherwise(balance)
    return balance


def ecl_parameters(loans: DataFrame, stages: DataFrame, as_of, scenario_id: int = 1, model_version: str = "1.0",
                   cap_pd: bool = False) -> DataFrame:
    """PD, LGD, EAD, EIR and maturity of staged, active loans that mature after ``as_of``; absent columns use defaults."""
    df = loans
    if "IsActive" in df.columns:
        df = df.filter("IsActive = 1")
    if "MaturityDate" in df.columns:
        df = df.filter(F.col("MaturityDate") > _day(as_of))
    staged = stages.filter(F.col("AsOfDate") == _day(as_of)).select(*KEY)
    df = df.join(staged, KEY, "left_semi")
    return df.select(
        *KEY, _day(as_of).alias("AsOfDate"), pd_12m(df, cap_pd).alias("PD_12Month"), pd_lifetime(df, cap_pd).alias("PD_Lifetime"),
        lgd(df).alias("LGD"), ead(df).alias("EAD"),
        ((F.col("InterestRate").cast("double") / 100) if "InterestRate" in df.columns else F.lit(EIR_DEFAULT)).alias("EIR"),
        (month_gap(_day(as_of), "MaturityDate") if "MaturityDate" in df.columns else F.lit(MATURITY_DEFAULT)).alias("Maturity"),
        F.lit(scenario_id).alias("MacroeconomicScenarioID"), F.lit(model_version).alias("ModelVersion"))


# --- expected credit loss ------------------------------------------------------------------------------------------

def seed_scenarios(spark: SparkSession, effective="2020-01-01") -> DataFrame:
    """The four standard scenarios."""
    rows = spark.createDataFrame(list(SCENARIOS), "ScenarioID int, ScenarioName string, ScenarioWeight double")
    return rows.withColumns({"IsActive": F.lit(1), "EffectiveDate": _day(effective), "ExpiryDate": F.lit(None).cast("date")})


def active_scenarios(scenarios: DataFrame, as_of, include_all: bool = False) -> DataFrame:
    """Active scenarios valid on the date; only 'Base' unless all are asked for."""
    day = _day(as_of)
    keep = (F.col("IsActive") == 1) & (F.col("EffectiveDate") <= day) & (F.col("ExpiryDate").isNull() | (F.col("ExpiryDate") >= day))
    if not include_all:
        keep = keep & (F.col("ScenarioName") == "Base")
    return scenarios.filter(keep).select("ScenarioID", "ScenarioName", "ScenarioWeight")


def ecl(params: DataFrame, stages: DataFrame, loans: DataFrame, scenarios: DataFrame, as_of, include_all: bool = False,
        scenario_mode: str = "param") -> DataFrame:
    """Expected credit loss per account. Without balances the gross amount is a fixed default, without an active flag no loan is left out.

    ``scenario_mode='param'`` takes the one scenario a parameter row names, ``'all'`` weighs every active scenario.
    """
    active = active_scenarios(scenarios, as_of, include_all or scenario_mode == "all")
    day = _day(as_of)
    rows = params.filter(F.col("AsOfDate") == day)
    scenario = F.struct(F.col("ScenarioID").cast("int").alias("ScenarioID"), F.col("ScenarioWeight").cast("double").alias("ScenarioWeight"))
    # One array of the few scenarios on every row: a join on a scenario that is a literal would fold into a product.
    rows = attach_stats(rows, active.agg(F.collect_list(scenario).alias("_all")))
    named = F.filter("_all", lambda s: s["ScenarioID"] == F.col("MacroeconomicScenarioID"))
    rows = rows.withColumn("_s", F.explode(named if scenario_mode == "param" else F.col("_all"))).drop("_all")
    rows = rows.join(stages.filter(F.col("AsOfDate") == day).select(*KEY, "ECLStage"), KEY)
    balance = F.col("CurrentBalance").cast("double") if "CurrentBalance" in loans.columns else F.lit(GROSS_DEFAULT)
    balances = loans.select(*KEY, balance.alias("_balance"), (F.col("IsActive") if "IsActive" in loans.columns else F.lit(1)).alias("_active"))
    rows = rows.join(balances, KEY, "left").filter("_active = 1 or _active is null")
    growth, months = 1 / (1 + F.col("EIR")), F.col("Maturity")
    short = F.pow(growth, months / 12.0)
    discount_12 = F.when(months <= 12, short).otherwise(F.pow(growth, F.lit(1.0)))
    discount_life = F.when(months <= 12, short).otherwise(F.pow(growth, months / 24.0))
    weight, first = F.col("_s.ScenarioWeight"), F.col("ECLStage") == 1
    loss_12 = _cents(F.col("PD_12Month") * F.col("LGD") * F.col("EAD") * discount_12 * weight)
    loss_life = _cents(F.col("PD_Lifetime") * F.col("LGD") * F.col("EAD") * discount_life * weight)
    applied = F.when(first, loss_12).otherwise(loss_life)
    return rows.select(
        *KEY, "AsOfDate", (F.year("AsOfDate") * 10000 + F.month("AsOfDate") * 100 + F.dayofmonth("AsOfDate")).alias("DateID"), "ECLStage",
        loss_12.alias("ECL_12Month"), loss_life.alias("ECL_Lifetime"), applied.alias("AppliedECL"), F.col("_balance").alias("GrossCarryingAmount"),
        (F.col("_balance") - applied).alias("NetCarryingAmount"), F.col("_s.ScenarioID").alias("ScenarioID"),
        F.when(first, F.col("PD_12Month")).otherwise(F.col("PD_Lifetime")).alias("PD_Applied"), F.col("LGD").alias("LGD_Applied"),
        F.col("EAD").alias("EAD_Applied"), F.when(first, discount_12).otherwise(discount_life).alias("DiscountFactor"))


def replace_date(target: DataFrame | None, rows: DataFrame, as_of) -> DataFrame:
    """Table in which the rows of one date are replaced."""
    return rows if target is None else target.filter(F.col("AsOfDate") != _day(as_of)).unionByName(rows)


# --- movement ------------------------------------------------------------------------------------------------------

def _side(calc: DataFrame, stages: DataFrame, params: DataFrame, date, p: str) -> DataFrame:
    day = _day(date)
    loss = calc.filter(F.col("AsOfDate") == day).groupBy(*KEY).agg(F.sum("AppliedECL").alias(f"{p}ecl"))
    stage = stages.filter(F.col("AsOfDate") == day).select(*KEY, F.col("ECLStage").alias(f"{p}stage"))
    risk = params.filter(F.col("AsOfDate") == day).select(
        *KEY, F.struct(*[F.coalesce(c, F.lit(0)).alias(c) for c in ("PD_12Month", "PD_Lifetime", "LGD", "EAD")]).alias(f"{p}risk"),
        F.col("MacroeconomicScenarioID").alias(f"{p}scenario"))
    out = loss.join(stage, KEY, "left").join(risk, KEY, "left")
    return out.withColumn(f"{p}in", F.lit(True))


def ecl_movement(calc: DataFrame, stages: DataFrame, params: DataFrame, from_date, to_date, loans_from: DataFrame | None = None,
                 loans_to: DataFrame | None = None, exclusive: bool = False) -> DataFrame:
    """Change of the applied loss per account between two dates, split into its causes.

    Both sides are cut to their date before the outer join. The default columns follow the reporting rules and may
    overlap; with ``exclusive=True`` every change is booked to exactly one cause, so that the opening value plus all
    components equals the closing value.
    """
    a, b = (calc, stages, params), (calc, stages, params)
    return _movement(a, b, from_date, to_date, loans_from, loans_to, exclusive)


def _movement(before: Sequence[DataFrame], after: Sequence[DataFrame], from_date, to_date, loans_from: DataFrame | None, loans_to: DataFrame | None,
              exclusive: bool = False) -> DataFrame:
    """:func:`ecl_movement` from the calculations, stages and parameters that hold each of the two dates."""
    a = _side(*before, from_date, "a_")
    b = _side(*after, to_date, "b_")
    j = a.join(b, KEY, "full")
    if loans_from is not None and loans_to is not None and "WriteOffFlag" in loans_to.columns:
        j = j.join(loans_from.select(*KEY, F.col("IsActive").alias("_a1")), KEY, "left")
        j = j.join(loans_to.select(*KEY, F.col("IsActive").alias("_a2"), F.col("WriteOffFlag").alias("_wo")), KEY, "left")
        written = F.coalesce((F.col("_a1") == 1) & (F.col("_a2") == 0) & (F.col("_wo") == 1), F.lit(False))
    else:
        written = F.lit(False)
    zero = F.lit(0.0)
    opening, closing = F.coalesce("a_ecl", zero), F.coalesce("b_ecl", zero)
    s1, s2 = F.coalesce("a_stage", F.lit(0)), F.coalesce("b_stage", F.lit(0))
    m1, m2 = F.coalesce("a_scenario", F.lit(0)), F.coalesce("b_scenario", F.lit(0))
    nothing = F.struct(*[F.lit(0.0).alias(c) for c in ("PD_12Month", "PD_Lifetime", "LGD", "EAD")])
    same_risk = F.coalesce("a_risk", nothing) == F.coalesce("b_risk", nothing)
    new, gone, delta = F.col("a_in").isNull(), F.col("b_in").isNull(), closing - opening

    def book(cond: Column, value: Column = delta) -> Column:
        return F.when(cond, value).otherwise(zero)

    moved = [book((s1 != k) & (s2 == k)) for k in (1, 2, 3)]
    parts = {
        "NewLoansECL": book(new, closing),
        "DerecognizedLoansECL": book(gone, opening),
        "TransferToStage1ECL": moved[0], "TransferToStage2ECL": moved[1], "TransferToStage3ECL": moved[2],
        "ModelParameterChangesECL": book((s1 == s2) & ~same_risk),
        "MacroeconomicChangesECL": book(m1 != m2),
        "OtherChangesECL": book(((s1 == s2) & same_risk & (m1 == m2) & (delta != 0)) | (~new & ~gone & (delta != 0))),
        "WriteOffsECL": book(written, opening),
    }
    if exclusive:
        stay = ~new & ~gone
        same = stay & (s1 == s2)
        parts = {
            "NewLoansECL": book(new), "DerecognizedLoansECL": book(gone & ~written), "WriteOffsECL": book(gone & written),
            **{f"TransferToStage{k}ECL": book(stay & (s1 != s2) & (s2 == k)) for k in (1, 2, 3)},
            "ModelParameterChangesECL": book(same & ~same_risk), "MacroeconomicChangesECL": book(same & same_risk & (m1 != m2)),
            "OtherChangesECL": book((same & same_risk & (m1 == m2)) | (stay & (s1 != s2) & ~s2.isin(1, 2, 3))),
        }
    return j.select(*KEY, _day(from_date).alias("FromDate"), _day(to_date).alias("ToDate"), opening.alias("OpeningECL"), closing.alias("ClosingECL"),
                    *[v.alias(c) for c, v in parts.items()])


# --- whole run -----------------------------------------------------------------------------------------------------

def previous_run(calc: DataFrame | None, as_of):
    """Date of the latest calculation before ``as_of``, if there is one."""
    if calc is None:
        return None
    return calc.filter(F.col("AsOfDate") < _day(as_of)).agg(F.max("AsOfDate").alias("d")).first()["d"]


def run_ifrs9(accounts: DataFrame, loans: DataFrame, scenarios: DataFrame, as_of, state: dict[str, DataFrame] | None = None,
              include_all: bool = False, scenario_mode: str = "param", save=settle) -> dict[str, DataFrame]:
    """One run: classification, stages, parameters, loss and, when there was an earlier run, its movement.

    ``state`` holds the tables of earlier runs (classification, stages, params, calc, loans) and is not changed; the
    result is the state after this run. Stages, parameters and losses feed several later steps, so each is computed
    once and saved (``save``: by default to the shared checkpoint folder).
    """
    old = state or {}
    has_flags = "HoldToMaturityFlag" in accounts.columns
    classify = classify_instruments if has_flags else classify_instruments_basic
    out = {"classification": classify(accounts, old.get("classification"), as_of), "loans": loans}
    rows = save(stage_history(ecl_stage(loans, as_of), old.get("stages"), as_of))
    out["stages"], stages = _run_upserted(old["stages"], rows, as_of) if "stages" in old else (rows, rows)
    params = save(ecl_parameters(loans, rows, as_of))
    out["params"], params = _run_upserted(old["params"], params, as_of) if "params" in old else (params, params)
    loss = save(ecl(params, rows, loans, scenarios, as_of, include_all, scenario_mode))
    out["calc"] = replace_date(old.get("calc"), loss, as_of)
    before = previous_run(old.get("calc"), as_of)
    if "movement" in old:
        out["movement"] = old["movement"]
    if before is not None:
        # the upserts of this run leave the rows of the earlier date as they are
        earlier = (old["calc"], old.get("stages", stages), old.get("params", params))
        moved = _movement(earlier, (loss, stages, params), before, as_of, old.get("loans"), loans)
        if "movement" in old:  # every period once, the latest calculation of it
            same = (F.col("FromDate") == _day(before)) & (F.col("ToDate") == _day(as_of))
            moved = old["movement"].filter(~same).unionByName(moved)
        out["movement"] = save(moved)
    return out
