"""IFRS 9 (I family)."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskmart.adapters import AS_OF
from riskmart.plans import ifrs9 as I
from riskmart.queries.registry import Inputs, ctes, query

BEFORE = "2023-12-31"

ACCOUNTS = """
SELECT CustomerSK, AccountSK, CASE AccountSK % 6 WHEN 0 THEN 'LOAN' WHEN 1 THEN 'BOND' WHEN 2 THEN 'EQUITY' WHEN 3 THEN 'DERIVATIVE' WHEN 4 THEN 'MORTGAGE' ELSE 'BOND' END AS AccountType,
 CAST(CASE WHEN AccountSK % 5 < 2 THEN 1 ELSE 0 END AS INT) AS HoldToMaturityFlag, CAST(CASE WHEN AccountSK % 7 < 3 THEN 1 ELSE 0 END AS INT) AS HoldToCollectAndSellFlag,
 CAST(CASE WHEN AccountSK % 11 = 0 THEN 1 ELSE 0 END AS INT) AS TradingFlag, CAST(CASE WHEN AccountSK % 8 = 0 THEN 1 ELSE 0 END AS INT) AS HasNonSPPIFeatures, IsActive,
 CAST(CASE WHEN WatchListFlag = 1 THEN DATE '2023-06-30' END AS DATE) AS AccountClosedDate, CollateralType FROM {ifrs_loan}"""
ACCOUNTS_SQL = ACCOUNTS.format(ifrs_loan="ifrs_loan")


def accounts(t: Inputs):
    return t.spark.sql(ACCOUNTS, ifrs_loan=t.ifrs_loan)


CATEGORY_SQL = """CASE WHEN AccountType IN ('LOAN', 'BOND') AND HoldToMaturityFlag = 1 THEN 'Amortized Cost' WHEN AccountType = 'BOND' AND HoldToCollectAndSellFlag = 1 THEN 'FVOCI'
 WHEN AccountType IN ('EQUITY', 'DERIVATIVE') OR TradingFlag = 1 THEN 'FVTPL' ELSE 'Amortized Cost' END"""
CLASSIFIED = f"""
SELECT CustomerSK, AccountSK, AccountType AS InstrumentTypeCode, {CATEGORY_SQL} AS ClassificationCategory,
 CASE WHEN HoldToMaturityFlag = 1 THEN 'Hold to Collect' WHEN HoldToCollectAndSellFlag = 1 THEN 'Hold to Collect and Sell' WHEN TradingFlag = 1 THEN 'Other' ELSE 'Hold to Collect' END AS BusinessModelAssessment,
 CASE WHEN AccountType IN ('LOAN', 'BOND') AND HasNonSPPIFeatures = 0 THEN 'SPPI' WHEN AccountType IN ('EQUITY', 'DERIVATIVE') OR HasNonSPPIFeatures = 1 THEN 'Non-SPPI' ELSE 'SPPI' END AS CashflowCharacteristics
FROM accounts WHERE IsActive = 1 AND AccountClosedDate IS NULL"""
BASIC = """
SELECT CustomerSK, AccountSK, AccountType AS InstrumentTypeCode, CASE WHEN AccountType IN ('LOAN', 'MORTGAGE') THEN 'Amortized Cost' WHEN AccountType = 'BOND' THEN 'FVOCI' ELSE 'FVTPL' END AS ClassificationCategory,
 CASE WHEN AccountType IN ('LOAN', 'MORTGAGE', 'BOND') THEN 'Hold to Collect' ELSE 'Other' END AS BusinessModelAssessment,
 CASE WHEN AccountType IN ('LOAN', 'MORTGAGE', 'BOND') THEN 'SPPI' ELSE 'Non-SPPI' END AS CashflowCharacteristics FROM accounts"""
CLASS_OUT = "c.CustomerSK, c.AccountSK, c.InstrumentTypeCode, c.ClassificationCategory, c.BusinessModelAssessment, c.CashflowCharacteristics"


def classified(t, force=False):
    """Vehicle loans were classified by type in an earlier run."""
    everything = accounts(t)
    earlier = I.classify_instruments_basic(everything.filter("CollateralType = 'VEHICLE'"), None, BEFORE)
    return I.classify_instruments(everything, earlier, AS_OF, force)


@query("i1_classify_instruments", ctes(f"""
SELECT {CLASS_OUT}, DATE '{AS_OF}' AS ClassificationDate, CAST(NULL AS DATE) AS LastReassessmentDate FROM cls c JOIN accounts USING (CustomerSK, AccountSK) WHERE CollateralType <> 'VEHICLE'
UNION ALL SELECT {CLASS_OUT}, DATE '{BEFORE}', NULL FROM basic c JOIN accounts USING (CustomerSK, AccountSK) WHERE CollateralType = 'VEHICLE'""",
                                       "ifrs_loan", accounts=ACCOUNTS_SQL, cls=CLASSIFIED, basic=BASIC))
def i1(t):
    return classified(t).drop("JustificationText")


@query("i1_classify_instruments_force", ctes(f"""
SELECT {CLASS_OUT}, CASE WHEN CollateralType = 'VEHICLE' THEN DATE '{BEFORE}' ELSE DATE '{AS_OF}' END AS ClassificationDate,
 CASE WHEN CollateralType = 'VEHICLE' THEN DATE '{AS_OF}' END AS LastReassessmentDate FROM cls c JOIN accounts USING (CustomerSK, AccountSK)
UNION ALL SELECT {CLASS_OUT}, DATE '{BEFORE}', NULL FROM basic c JOIN accounts USING (CustomerSK, AccountSK)
WHERE CollateralType = 'VEHICLE' AND NOT (IsActive = 1 AND AccountClosedDate IS NULL)""", "ifrs_loan", accounts=ACCOUNTS_SQL, cls=CLASSIFIED, basic=BASIC))
def i1_force(t):
    return classified(t, force=True).drop("JustificationText")


@query("i2_classify_instruments_basic", ctes(f"SELECT {CLASS_OUT}, DATE '{AS_OF}' AS ClassificationDate FROM basic c", "ifrs_loan", accounts=ACCOUNTS_SQL, basic=BASIC))
def i2(t):
    return I.classify_instruments_basic(accounts(t), None, AS_OF).drop("JustificationText", "LastReassessmentDate")


# Two runs: before, terms of 24 months do not exist yet and delays are shorter; by now terms of 36 months have ended.
LOANS_BEFORE = "SELECT * REPLACE (CAST(GREATEST(DaysPastDue - 20, 0) AS INT) AS DaysPastDue), CAST(0 AS INT) AS WriteOffFlag FROM ifrs_loan WHERE TermMonths <> 24"
LOANS_NOW = """SELECT * REPLACE (CASE WHEN TermMonths = 36 THEN 0 ELSE IsActive END AS IsActive),
 CAST(CASE WHEN TermMonths = 36 AND LoanType = 'REVOLVING' THEN 1 ELSE 0 END AS INT) AS WriteOffFlag FROM ifrs_loan"""


def loans_before(t):
    return t.ifrs_loan.filter("TermMonths <> 24").withColumns({
        "DaysPastDue": F.greatest(F.col("DaysPastDue") - 20, F.lit(0)), "WriteOffFlag": F.lit(0)})


def loans_now(t):
    ended = F.col("TermMonths") == 36
    return t.ifrs_loan.withColumns({
        "IsActive": F.when(ended, 0).otherwise(F.col("IsActive")),
        "WriteOffFlag": F.when(ended & (F.col("LoanType") == "REVOLVING"), 1).otherwise(0)})


def stage_sql(loans: str, date: str) -> str:
    bad = "(IsDefaulted = 1 OR DaysPastDue >= 90 OR BankruptcyFlag = 1 OR ChargeOffFlag = 1)"
    risen = "(CreditScoreDecreasePercent >= 15 OR DaysPastDue BETWEEN 30 AND 89 OR WatchListFlag = 1 OR ModifiedLoanFlag = 1 OR ForbearanceFlag = 1)"
    return f"""SELECT CustomerSK, AccountSK, DATE '{date}' AS AsOfDate, CAST(CASE WHEN {bad} THEN 3 WHEN {risen} THEN 2 ELSE 1 END AS INT) AS ECLStage,
 CAST(CASE WHEN {risen} THEN 1 ELSE 0 END AS INT) AS SignificantIncreaseInCreditRisk, CAST(CASE WHEN {bad} THEN 1 ELSE 0 END AS INT) AS CreditImpaired, DaysPastDue FROM {loans} WHERE IsActive = 1"""


def param_sql(loans: str, stages: str, date: str) -> str:
    def score(steps, worst):
        return "CAST(CASE " + " ".join(f"WHEN CreditScore >= {s} THEN {p}" for s, p in steps) + f" ELSE {worst} END AS DOUBLE)"

    due = "CAST(CASE WHEN DaysPastDue = 0 THEN 1.0 WHEN DaysPastDue BETWEEN 1 AND 29 THEN 1.5 WHEN DaysPastDue BETWEEN 30 AND 59 THEN 3.0 WHEN DaysPastDue BETWEEN 60 AND 89 THEN 6.0 ELSE 9.0 END AS DOUBLE)"
    return f"""SELECT CustomerSK, AccountSK, DATE '{date}' AS AsOfDate, {score(I.PD_12M_BY_SCORE, 0.2)} * {due} AS PD_12Month,
 {score(I.PD_LIFE_BY_SCORE, 0.5)} * {due} * (1 + (TermMonths // 60) * CAST(0.2 AS DOUBLE)) AS PD_Lifetime,
 CAST(CASE CollateralType WHEN 'REAL_ESTATE' THEN 0.15 WHEN 'VEHICLE' THEN 0.35 WHEN 'SECURITIES' THEN 0.25 WHEN 'NONE' THEN 0.75 ELSE 0.5 END AS DOUBLE) AS LGD,
 CASE WHEN LoanType = 'REVOLVING' THEN CurrentBalance + (CreditLimit - CurrentBalance) * CAST(0.5 AS DOUBLE) ELSE CurrentBalance END AS EAD, InterestRate / 100 AS EIR,
 CAST(DATE_DIFF('month', DATE '{date}', MaturityDate) AS INT) AS Maturity FROM {loans} l WHERE IsActive = 1 AND MaturityDate > DATE '{date}'
 AND EXISTS (SELECT 1 FROM {stages} s WHERE s.CustomerSK = l.CustomerSK AND s.AccountSK = l.AccountSK)"""


def ecl_sql(params: str, stages: str, loans: str, weights: str) -> str:
    short = "POWER(1 / (1 + EIR), Maturity / CAST(12 AS DOUBLE))"
    d12 = f"CASE WHEN Maturity <= 12 THEN {short} ELSE POWER(1 / (1 + EIR), 1) END"
    life = f"CASE WHEN Maturity <= 12 THEN {short} ELSE POWER(1 / (1 + EIR), Maturity / CAST(24 AS DOUBLE)) END"
    return f"""SELECT *, CASE WHEN ECLStage = 1 THEN ECL_12Month ELSE ECL_Lifetime END AS AppliedECL FROM (
 SELECT p.CustomerSK, p.AccountSK, p.AsOfDate, s.ECLStage, w.ScenarioID, w.ScenarioName, CAST(ROUND(CAST(PD_12Month * LGD * EAD * {d12} * w.w AS DECIMAL(28,8)), 2) AS DOUBLE) AS ECL_12Month, CAST(ROUND(CAST(PD_Lifetime * LGD * EAD * {life} * w.w AS DECIMAL(28,8)), 2) AS DOUBLE) AS ECL_Lifetime,
  l.CurrentBalance AS Gross, CASE WHEN s.ECLStage = 1 THEN PD_12Month ELSE PD_Lifetime END AS PD_Applied, LGD AS LGD_Applied, EAD AS EAD_Applied, CASE WHEN s.ECLStage = 1 THEN {d12} ELSE {life} END AS DiscountFactor
 FROM {params} p JOIN {stages} s ON p.CustomerSK = s.CustomerSK AND p.AccountSK = s.AccountSK JOIN {loans} l ON p.CustomerSK = l.CustomerSK AND p.AccountSK = l.AccountSK CROSS JOIN {weights} w)"""


BASE = "SELECT 1 AS ScenarioID, 'Base' AS ScenarioName, CAST(0.6 AS DOUBLE) AS w"
ALL = """SELECT * FROM (VALUES (1, 'Base', CAST(0.6 AS DOUBLE)), (2, 'Upside', CAST(0.15 AS DOUBLE)), (3, 'Downside', CAST(0.15 AS DOUBLE)), (4, 'Severe', CAST(0.1 AS DOUBLE))) AS v(ScenarioID, ScenarioName, w)"""
RUNS = dict(
    l1=LOANS_BEFORE, l2=LOANS_NOW, s1=stage_sql("l1", BEFORE), s2=stage_sql("l2", AS_OF), p1=param_sql("l1", "s1", BEFORE), p2=param_sql("l2", "s2", AS_OF),
    base=BASE, scen=ALL, c1=ecl_sql("p1", "s1", "l1", "base"), c2=ecl_sql("p2", "s2", "l2", "base"))


def two_runs(t: Inputs):
    """State after the runs at the two dates."""
    scenarios, every = I.seed_scenarios(t.spark), accounts(t)
    first = I.run_ifrs9(every, loans_before(t), scenarios, BEFORE)
    return I.run_ifrs9(every, loans_now(t), scenarios, AS_OF, first)


@query("i3_ecl_stage", ctes("SELECT * FROM s2", "ifrs_loan", l2=LOANS_NOW, s2=RUNS["s2"]))
def i3(t):
    return I.ecl_stage(loans_now(t), AS_OF)


HISTORY = f"""
SELECT CustomerSK, AccountSK, AsOfDate, ECLStage, CAST(1 AS INT) AS PreviousStage, AsOfDate AS StageChangeDate, 'Initial Classification' AS StageChangeReason FROM s1
UNION ALL SELECT n.CustomerSK, n.AccountSK, n.AsOfDate, n.ECLStage, o.ECLStage, CASE WHEN o.ECLStage <> n.ECLStage THEN DATE '{AS_OF}' END, 'Classification Update'
FROM s2 n LEFT JOIN s1 o ON o.CustomerSK = n.CustomerSK AND o.AccountSK = n.AccountSK"""


@query("i4_stage_history", ctes("SELECT * FROM hist", "ifrs_loan", **{k: RUNS[k] for k in ("l1", "l2", "s1", "s2")}, hist=HISTORY))
def i4(t):
    first = I.stage_history(I.ecl_stage(loans_before(t), BEFORE), None, BEFORE)
    second = I.stage_history(I.ecl_stage(loans_now(t), AS_OF), first, AS_OF)
    out = I.update_stages(first, second)
    return out.drop("SignificantIncreaseInCreditRisk", "CreditImpaired", "DaysPastDue")


@query("i5_probability_of_default", ctes("SELECT CustomerSK, AccountSK, ROUND(PD_12Month, 8) AS PD_12Month, ROUND(PD_Lifetime, 8) AS PD_Lifetime FROM p2", "ifrs_loan",
                                         l2=LOANS_NOW, s2=RUNS["s2"], p2=RUNS["p2"]))
def i5(t):
    loans = loans_now(t).filter(f"IsActive = 1 and MaturityDate > DATE '{AS_OF}'")
    return loans.select("CustomerSK", "AccountSK", F.round(I.pd_12m(loans), 8).alias("PD_12Month"), F.round(I.pd_lifetime(loans), 8).alias("PD_Lifetime"))


@query("i6_lgd_ead", ctes("SELECT CustomerSK, AccountSK, LGD, ROUND(EAD, 4) AS EAD FROM p2", "ifrs_loan", l2=LOANS_NOW, s2=RUNS["s2"], p2=RUNS["p2"]))
def i6(t):
    loans = loans_now(t).filter(f"IsActive = 1 and MaturityDate > DATE '{AS_OF}'")
    return loans.select("CustomerSK", "AccountSK", I.lgd(loans).alias("LGD"), F.round(I.ead(loans), 4).alias("EAD"))


@query("i7_ecl_parameters", ctes("""
SELECT CustomerSK, AccountSK, AsOfDate, ROUND(PD_12Month, 8) AS PD_12Month, ROUND(PD_Lifetime, 8) AS PD_Lifetime, LGD, ROUND(EAD, 4) AS EAD, ROUND(EIR, 8) AS EIR, Maturity,
 CAST(1 AS INT) AS MacroeconomicScenarioID, '1.0' AS ModelVersion FROM p2""", "ifrs_loan", l2=LOANS_NOW, s2=RUNS["s2"], p2=RUNS["p2"]))
def i7(t):
    loans = loans_now(t)
    df = I.ecl_parameters(loans, I.ecl_stage(loans, AS_OF), AS_OF)
    return df.withColumns({"PD_12Month": F.round("PD_12Month", 8), "PD_Lifetime": F.round("PD_Lifetime", 8), "EAD": F.round("EAD", 4), "EIR": F.round("EIR", 8)})


@query("i8_active_scenarios", ctes("""
SELECT ScenarioID, ScenarioName, ROUND(SUM(CurrentBalance * w), 2) AS weighted_balance FROM ifrs_loan CROSS JOIN scen GROUP BY 1, 2""", "ifrs_loan", scen=ALL))
def i8(t):
    """Balance weighted by each active scenario."""
    active = I.active_scenarios(I.seed_scenarios(t.spark), AS_OF, include_all=True)
    total = t.ifrs_loan.agg(F.sum("CurrentBalance").alias("b"))
    return active.crossJoin(F.broadcast(total)).select("ScenarioID", "ScenarioName", F.round(F.col("b") * F.col("ScenarioWeight"), 2).alias("weighted_balance"))


ECL_OUT = """CustomerSK, AccountSK, AsOfDate, ECLStage, CAST(ScenarioID AS INT) AS ScenarioID, ECL_12Month, ECL_Lifetime, AppliedECL, ROUND(Gross, 2) AS GrossCarryingAmount, ROUND(Gross - AppliedECL, 4) AS NetCarryingAmount,
 ROUND(PD_Applied, 8) AS PD_Applied, LGD_Applied, ROUND(EAD_Applied, 4) AS EAD_Applied, ROUND(DiscountFactor, 8) AS DiscountFactor"""


def ecl_out(df):
    return df.drop("DateID").withColumns({
        "GrossCarryingAmount": F.round("GrossCarryingAmount", 2), "NetCarryingAmount": F.round("NetCarryingAmount", 4), "PD_Applied": F.round("PD_Applied", 8),
        "EAD_Applied": F.round("EAD_Applied", 4), "DiscountFactor": F.round("DiscountFactor", 8)})


def loss(t, mode):
    loans = loans_now(t)
    stages = I.ecl_stage(loans, AS_OF)
    return I.ecl(I.ecl_parameters(loans, stages, AS_OF), stages, loans, I.seed_scenarios(t.spark), AS_OF, scenario_mode=mode)


@query("i9_ecl", ctes(f"SELECT {ECL_OUT} FROM c2", "ifrs_loan", **{k: RUNS[k] for k in ("l2", "s2", "p2", "base", "c2")}))
def i9(t):
    return ecl_out(loss(t, "param"))


@query("i9_ecl_all_scenarios", ctes(f"SELECT {ECL_OUT} FROM c2", "ifrs_loan", **{k: RUNS[k] for k in ("l2", "s2", "p2", "scen")}, c2=ecl_sql("p2", "s2", "l2", "scen")))
def i9_all(t):
    return ecl_out(loss(t, "all"))


JOINED = """
SELECT COALESCE(a.CustomerSK, b.CustomerSK) AS CustomerSK, COALESCE(a.AccountSK, b.AccountSK) AS AccountSK, a.CustomerSK IS NULL AS is_new, b.CustomerSK IS NULL AS is_gone,
 COALESCE(a.AppliedECL, 0) AS o, COALESCE(b.AppliedECL, 0) AS c, COALESCE(a.ECLStage, 0) AS x, COALESCE(b.ECLStage, 0) AS y,
 COALESCE(pa.PD_12Month, 0) = COALESCE(pb.PD_12Month, 0) AND COALESCE(pa.PD_Lifetime, 0) = COALESCE(pb.PD_Lifetime, 0) AND COALESCE(pa.LGD, 0) = COALESCE(pb.LGD, 0) AND COALESCE(pa.EAD, 0) = COALESCE(pb.EAD, 0) AS same_risk,
 (pa.CustomerSK IS NULL) = (pb.CustomerSK IS NULL) AS same_scenario
FROM c1 a FULL JOIN c2 b ON a.CustomerSK = b.CustomerSK AND a.AccountSK = b.AccountSK
LEFT JOIN p1 pa ON pa.CustomerSK = a.CustomerSK AND pa.AccountSK = a.AccountSK LEFT JOIN p2 pb ON pb.CustomerSK = b.CustomerSK AND pb.AccountSK = b.AccountSK"""
MOVEMENT = """
SELECT j.CustomerSK, j.AccountSK, o AS OpeningECL, c AS ClosingECL, CASE WHEN is_new THEN c ELSE 0 END AS NewLoansECL, CASE WHEN is_gone THEN o ELSE 0 END AS DerecognizedLoansECL,
 ROUND(CASE WHEN x <> 1 AND y = 1 THEN c - o ELSE 0 END, 4) AS TransferToStage1ECL, ROUND(CASE WHEN x <> 2 AND y = 2 THEN c - o ELSE 0 END, 4) AS TransferToStage2ECL, ROUND(CASE WHEN x <> 3 AND y = 3 THEN c - o ELSE 0 END, 4) AS TransferToStage3ECL,
 ROUND(CASE WHEN x = y AND NOT same_risk THEN c - o ELSE 0 END, 4) AS ModelParameterChangesECL, ROUND(CASE WHEN NOT same_scenario THEN c - o ELSE 0 END, 4) AS MacroeconomicChangesECL,
 ROUND(CASE WHEN (x = y AND same_risk AND same_scenario AND o <> c) OR (NOT is_new AND NOT is_gone AND o <> c) THEN c - o ELSE 0 END, 4) AS OtherChangesECL,
 CASE WHEN la.IsActive = 1 AND lb.IsActive = 0 AND lb.WriteOffFlag = 1 THEN o ELSE 0 END AS WriteOffsECL
FROM j LEFT JOIN l1 la ON la.CustomerSK = j.CustomerSK AND la.AccountSK = j.AccountSK LEFT JOIN l2 lb ON lb.CustomerSK = j.CustomerSK AND lb.AccountSK = j.AccountSK"""
EXCLUSIVE = """
SELECT j.CustomerSK, j.AccountSK, o AS OpeningECL, c AS ClosingECL, ROUND(CASE WHEN is_new THEN c ELSE 0 END, 4) AS NewLoansECL,
 ROUND(CASE WHEN is_gone AND COALESCE(lb.WriteOffFlag, 0) = 0 THEN -o ELSE 0 END, 4) AS DerecognizedLoansECL, ROUND(CASE WHEN is_gone AND lb.WriteOffFlag = 1 THEN -o ELSE 0 END, 4) AS WriteOffsECL,
 ROUND(CASE WHEN NOT is_new AND NOT is_gone AND x <> y THEN c - o ELSE 0 END, 4) AS transferred, ROUND(CASE WHEN NOT is_new AND NOT is_gone AND x = y AND NOT same_risk THEN c - o ELSE 0 END, 4) AS ModelParameterChangesECL,
 ROUND(CASE WHEN NOT is_new AND NOT is_gone AND x = y AND same_risk THEN c - o ELSE 0 END, 4) AS OtherChangesECL
FROM j LEFT JOIN l2 lb ON lb.CustomerSK = j.CustomerSK AND lb.AccountSK = j.AccountSK"""
MOVED = ["TransferToStage1ECL", "TransferToStage2ECL", "TransferToStage3ECL", "ModelParameterChangesECL", "MacroeconomicChangesECL", "OtherChangesECL"]


@query("i10_ecl_movement", ctes(MOVEMENT, "ifrs_loan", **RUNS, j=JOINED))
def i10(t):
    out = two_runs(t)["movement"].drop("FromDate", "ToDate")
    return out.withColumns({c: F.round(c, 4) for c in MOVED})


@query("i10_ecl_movement_exclusive", ctes(EXCLUSIVE, "ifrs_loan", **RUNS, j=JOINED))
def i10_exclusive(t):
    s = two_runs(t)
    out = I.ecl_movement(s["calc"], s["stages"], s["params"], BEFORE, AS_OF, loans_before(t), loans_now(t), exclusive=True)
    moved = sum((F.col(f"TransferToStage{k}ECL") for k in (2, 3)), F.col("TransferToStage1ECL"))
    return out.select("CustomerSK", "AccountSK", "OpeningECL", "ClosingECL", F.round("NewLoansECL", 4).alias("NewLoansECL"), F.round("DerecognizedLoansECL", 4).alias("DerecognizedLoansECL"),
                      F.round("WriteOffsECL", 4).alias("WriteOffsECL"), F.round(moved, 4).alias("transferred"), F.round("ModelParameterChangesECL", 4).alias("ModelParameterChangesECL"),
                      F.round("OtherChangesECL", 4).alias("OtherChangesECL"))


@query("i11_run_ifrs9", ctes("""
SELECT AsOfDate, ECLStage, COUNT(*) AS accounts, ROUND(SUM(AppliedECL), 2) AS applied FROM (SELECT AsOfDate, ECLStage, AppliedECL FROM c1 UNION ALL SELECT AsOfDate, ECLStage, AppliedECL FROM c2)
GROUP BY AsOfDate, ECLStage""", "ifrs_loan", **RUNS))
def i11(t):
    return two_runs(t)["calc"].groupBy("AsOfDate", "ECLStage").agg(F.count("*").alias("accounts"), F.round(F.sum("AppliedECL"), 2).alias("applied"))
