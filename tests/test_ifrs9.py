import pytest
from pyspark.sql import functions as F

from riskmart.plans import ifrs9 as I
from riskmart.queries.ifrs9 import AS_OF, BEFORE, accounts, loans_before, loans_now, two_runs
from riskmart.queries.registry import Inputs


@pytest.fixture(scope="module")
def runs(spark, sf_dir):
    return two_runs(Inputs(spark, sf_dir))


def test_net_is_gross_less_loss(runs):
    off = runs["calc"].filter(F.abs(F.col("GrossCarryingAmount") - F.col("AppliedECL") - F.col("NetCarryingAmount")) > 1e-6)
    assert off.count() == 0


def test_exclusive_movement_adds_up(runs, spark, sf_dir):
    t = Inputs(spark, sf_dir)
    out = I.ecl_movement(runs["calc"], runs["stages"], runs["params"], BEFORE, AS_OF, loans_before(t), loans_now(t), exclusive=True)
    parts = [c for c in out.columns if c.endswith("ECL") and c not in ("OpeningECL", "ClosingECL")]
    total = sum((F.col(c) for c in parts[1:]), F.col(parts[0]))
    assert out.filter(F.abs(F.col("OpeningECL") + total - F.col("ClosingECL")) > 1e-6).count() == 0
    assert out.filter("WriteOffsECL <> 0").count() > 0


def test_rerun_replaces_the_day(runs, spark, sf_dir):
    t = Inputs(spark, sf_dir)
    from riskmart.queries.ifrs9 import accounts
    again = I.run_ifrs9(accounts(t), loans_now(t), I.seed_scenarios(spark), AS_OF, runs)
    assert again["calc"].count() == runs["calc"].count()
    assert again["stages"].count() == runs["stages"].count()


def test_fallbacks_for_absent_columns(spark):
    df = spark.createDataFrame([(1, 1)], "CustomerSK bigint, AccountSK bigint")
    row = df.select(I.pd_12m(df).alias("a"), I.pd_lifetime(df).alias("b"), I.lgd(df).alias("c"), I.ead(df).alias("d")).first()
    assert tuple(row) == (0.02, 0.05, 0.45, 10000.0)


def test_pd_may_exceed_one_unless_capped(spark):
    df = spark.createDataFrame([(500, 95)], "CreditScore int, DaysPastDue int")
    assert df.select(I.pd_12m(df)).first()[0] == pytest.approx(1.8)
    assert df.select(I.pd_12m(df, cap=True)).first()[0] == 1.0


def test_movement_joins_the_rows_of_its_dates_only(spark, sf_dir):
    """Two runs unsaved: the movement needs its own full join and at most one for each upsert of the second run, not one for each date too (5 in all)."""
    t = Inputs(spark, sf_dir)
    scenarios, every = I.seed_scenarios(spark), accounts(t)
    first = I.run_ifrs9(every, loans_before(t), scenarios, BEFORE, save=lambda df: df)
    second = I.run_ifrs9(every, loans_now(t), scenarios, AS_OF, first, save=lambda df: df)
    plan = second["movement"]._jdf.queryExecution().optimizedPlan().toString()
    assert 1 <= plan.count("Join FullOuter") <= 3
