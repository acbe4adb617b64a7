import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskmart.operators import clean, conform, generate, repair, validate
from riskmart.plans.compose import EmptyResult, Strategies, clean_dataset, cook_dataset
from riskmart.queries.registry import Inputs
from riskmart.schemas import LOAN


def test_duration_texts(spark):
    df = spark.createDataFrame([("2 Years and 3 Months", 27), ("1 yr 2 mo", 14), ("6 weeks", 2), ("10 days", 0), ("none", None)], "t string, n bigint")
    out = df.select(clean.duration(F.col("t"), False).alias("m"), "n").collect()
    assert [r["m"] for r in out] == [r["n"] for r in out]


def test_duplicate_names():
    assert clean.dedupe_column_names(["x", "y", "x", "x"]) == ["x", "y", "x_1", "x_2"]


def test_numbers_in_text(spark):
    df = spark.createDataFrame([("1",), (" 2.5 ",), ("-1e3",), (".5",), ("1d",), ("x",), (None,)], "t string")
    assert [r[0] for r in df.select(clean.to_number("t")).collect()] == [1.0, 2.5, -1000.0, 0.5, None, None, None]


def test_split_multivalue_with_one_hot_owner(spark):
    rows = [(i, 1 if i < 300 else i, "Auto Loan, Home Loan and Auto Loan", 5.0 if i in (2, 7, 9) else 0.0) for i in range(310)]
    df = spark.createDataFrame(rows, "n int, owner int, kind string, AutoLoanBalance double")
    out = {r["n"]: r["kind"] for r in clean.split_multivalue(df, "kind", "owner", ["n"], ["loan"]).collect()}
    assert len(out) == 310
    # Two rows prove a car loan and the list has two of them; the third claim finds none left.
    assert (out[2], out[7], out[0], out[1]) == ("Auto", "Auto", "Home", "Not Specified")
    assert out[9] == "Not Specified" and out[299] == "Not Specified"
    assert out[305] == "Auto Loan, Home Loan and Auto Loan"


def test_domains_of_names():
    names = {"LoanAmount": "price", "InterestRate": "percentage", "HighestValue": "price", "TransactionTypeName": "transaction", "AccountType": "category", "CountryName": "person", "Abc": "generic"}
    assert {n: generate.infer_domain(n) for n in names} == names


def test_generation_does_not_depend_on_partitions(spark):
    schema = T.StructType([T.StructField("CustomerID", T.LongType()), T.StructField("AccountID", T.StringType()), T.StructField("CreditScore", T.IntegerType()), T.StructField("DebtRatio", T.DecimalType(18, 2))])
    donors = {"CustomerID": spark.range(40).select((F.col("id") + 5).alias("CustomerID"))}
    df = spark.range(300).withColumnRenamed("id", "RowKey")
    runs = [generate.generate_missing(df.repartition(n), schema, schema.fieldNames(), ["RowKey"], 3, "2024-01-30", donors) for n in (1, 9)]
    a, b = (sorted(map(tuple, r.collect())) for r in runs)
    assert a == b
    out = runs[0].toPandas()
    assert out["AccountID"].is_unique and out["CustomerID"].between(5, 44).all()
    assert out.groupby("CustomerID").size().max() - out.groupby("CustomerID").size().min() <= 1
    assert out["CreditScore"].between(1, 10).all() and out["DebtRatio"].between(0, 1).all()


def test_repair_is_idempotent_and_never_adds_issues(spark, sf_dir):
    loans = Inputs(spark, sf_dir).stg_loan
    once = repair.fix_loan(loans)
    assert repair.repair_report(once, repair.fix_loan(once), ["LoanID"]).count() == 0
    bad = lambda df: validate.check_loan(df).agg(F.sum("n_bad")).first()[0]
    assert bad(once) <= bad(loans)
    fraud = Inputs(spark, sf_dir).stg_fraud
    fixed = repair.fix_fraud(fraud, "2024-01-20")
    assert repair.repair_report(fixed, repair.fix_fraud(fixed, "2024-01-20"), ["TransactionID"]).count() == 0


def test_consensus_keeps_small_groups(spark):
    rows = [(1, 5), (1, 5), (1, 9), (2, 1), (2, 2), (3, 1), (3, 2), (3, 3), (3, 4), (4, None), (4, 7), (4, 7), (4, 7)]
    df = spark.createDataFrame(rows, "k int, v int")
    out = sorted((r["k"], r["v"]) for r in repair.consensus_by_group(df, "k", ["v"]).collect())
    assert out == [(1, 5)] * 3 + [(2, 1), (2, 2), (3, 1), (3, 2), (3, 3), (3, 4)] + [(4, 7)] * 4


def test_schema_issues(spark):
    out = validate.check_schema(spark.createDataFrame([("x",)], "CustomerID string"), LOAN)
    found = {(r["check"], r["field"]) for r in out.filter("failed = 1").collect()}
    assert ("column_type", "CustomerID") in found and ("missing_column", "LoanAmount") in found


def test_quality_score_counts_severities(spark):
    rows = [("Loan", "pre", "critical", 1), ("Loan", "pre", "warning", 1), ("Loan", "pre", "warning", 0)]
    out = validate.quality_score(spark.createDataFrame(rows, "dataset string, stage string, severity string, failed int")).first()
    assert (out["quality_score"], out["status"], out["tests_passed"], out["tests_failed"]) == (88, "failed", 1, 2)


def test_macro_keeps_the_first_of_a_day_and_country(spark):
    df = spark.createDataFrame([("2024-01-01", "A", 2.0, 1), ("2024-01-01", "A", 1.0, 2)], "ReportDate string, CountryName string, UnemploymentRate double, n int")
    from riskmart.schemas import MACRO
    assert conform.conform_constraints(df, "Macro", MACRO, ["n"]).first()["UnemploymentRate"] == 2.0


def test_raw_file_to_cooked_table(spark):
    """A raw text table with empty cells in later years goes through the whole chain."""
    from riskmart.schemas import MACRO
    rows = [("Land", str(1990 + i), str(4.0 + i % 5) if i < 28 else None, str(1000 + 10 * i), str(50 + i), "2.5", f"{1 + i % 3}.25" if i < 29 else None, "100") for i in range(40)]
    raw = spark.createDataFrame(rows, "countryname string, report_date string, unemp string, GDP_USD string, govdebt string, govdef string, infl string, CPI string")
    mapping = {"ReportDate": "report_date", "CountryName": "countryname", "UnemploymentRate": "unemp", "GDP": "GDP_USD", "DebtRatio": "govdebt", "DeficitRatio": "govdef", "InflationRate": "infl", "ConsumerPriceIndex": "CPI"}
    out, checks = cook_dataset(raw, "Macro", MACRO, mapping, ["ReportDate", "CountryName"], "2024-01-30", seed=1, batch_id="b-1")
    assert out.count() > 30
    assert {"LoadBatchID", "HousePriceIndex"} <= set(out.columns)
    assert {r["stage"] for r in checks.select("stage").distinct().collect()} == {"pre", "post"}
    with pytest.raises(EmptyResult):
        cook_dataset(raw.limit(0), "Macro", MACRO, mapping, ["ReportDate", "CountryName"], "2024-01-30")


def test_clean_dataset_converts_columns(spark):
    rows = [(i, f"{i}.5", "Yes" if i % 2 else "No", "2024-01-0%d" % (1 + i % 9), "2 years") for i in range(60)]
    out = clean_dataset(spark.createDataFrame(rows, "id int, price string, active string, open_date string, loan_term string"), ["id"])
    assert dict(out.dtypes) == {"id": "int", "price": "double", "active": "int", "open_date": "timestamp", "loan_term_Months": "bigint"}


def test_strategies_by_name(spark):
    s = Strategies()
    s.register("fix", "double", lambda df: df.withColumn("id", F.col("id") * 2))
    assert s.names("fix") == ["double"]
    assert [r[0] for r in s.apply("fix", ["double", "double"], spark.range(3)).collect()] == [0, 4, 8]
    with pytest.raises(KeyError):
        s.get("fix", "other")
    with pytest.raises(ValueError):
        s.register("draw", "x", lambda df: df)
