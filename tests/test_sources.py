import pytest
from pyspark.sql import types as T

from riskmart.sources import date_dim, files, staging


def test_unknown_format(spark):
    with pytest.raises(ValueError, match="unsupported"):
        files.read_source(spark, "/nowhere/data.xyz")


def test_round_trip_counts_rows(spark, tmp_path):
    path = str(tmp_path / "t.csv")
    assert files.write_output(spark.range(25), path) == 25
    assert files.read_source(spark, path, schema="id bigint").count() == 25
    assert files.read_source(spark, path, max_rows=3, schema="id bigint").count() == 3


def test_bad_lines_go_to_the_rejects_and_too_many_stop_the_load(spark, tmp_path):
    path = tmp_path / "in.csv"
    path.write_text("id,amount,day\n1,2.5,2024-01-01\n2,x,2024-01-02\n3,1.0,never\n4,4.0,2024-01-04\n")
    schema = T.StructType.fromDDL("id int, amount double, day date")
    good, rejects = files.load_typed_csv(spark, str(path), schema, max_errors=2, reject_path=str(tmp_path / "rejects"))
    assert sorted(r["id"] for r in good.collect()) == [1, 4]
    assert sorted(r["id"] for r in rejects.collect()) == [2, 3]
    assert spark.read.json(str(tmp_path / "rejects")).count() == 2
    assert good.select("id").count() == good.groupBy().count().first()[0] == 2
    with pytest.raises(files.TooManyErrors):
        files.load_typed_csv(spark, str(path), schema, max_errors=1)


def test_reload_is_all_or_nothing(spark, tmp_path):
    with pytest.raises(FileNotFoundError, match="Fraud"):
        files.reload_tables({"Loan": spark.range(2)}, str(tmp_path), "b1", ["Loan", "Fraud"])
    assert not (tmp_path / "b1").exists()
    paths, counts = files.reload_tables({"Loan": spark.range(2), "Fraud": spark.range(3)}, str(tmp_path), "b1", ["Loan", "Fraud"])
    assert {r[0]: r[1] for r in counts.collect()} == {"Loan": 2, "Fraud": 3}
    assert spark.read.parquet(paths["Fraud"]).count() == 3
    with pytest.raises(Exception, match="(?i)already exists"):
        files.reload_tables({"Loan": spark.range(2), "Fraud": spark.range(3)}, str(tmp_path), "b1")


def test_bit_tokens_and_dates(spark):
    df = spark.createDataFrame([(" On ", "2024-03-05 9:07"), ("N", "3/5/2024"), ("perhaps", "x"), ("", "")], "b string, d string")
    schema = T.StructType([T.StructField("b", T.BooleanType()), T.StructField("d", T.TimestampType()), T.StructField("gone", T.StringType(), False)])
    out = staging.coerce_staging(df, schema).collect()
    assert [r["b"] for r in out] == [1, 0, None, None]
    assert [str(r["d"]) for r in out] == ["2024-03-05 09:07:00", "2024-03-05 00:00:00", "None", "None"]
    lost = {(r["column_name"], r["raw_value"]) for r in staging.staging_rejects(df, schema, []).collect()}
    assert lost == {("b", "perhaps"), ("d", "x")}
    assert staging.column_gaps(df, schema) == {"unknown": [], "missing": ["gone"]}


def test_week_one_holds_the_first_of_january(spark):
    weeks = {str(r["FullDate"]): r["WeekOfYear"] for r in date_dim.build_date_dim(spark, "2022-12-30", "2023-01-09").collect()}
    assert (weeks["2022-12-31"], weeks["2023-01-01"], weeks["2023-01-07"], weeks["2023-01-08"]) == (53, 1, 1, 2)


def test_typed_csv_is_parsed_once(spark, tmp_path):
    path = tmp_path / "in.csv"
    path.write_text("id,amount\n1,2.5\nx,1\n3,4\n")
    good, rejects = files.load_typed_csv(spark, str(path), T.StructType.fromDDL("id int, amount double"), max_errors=1)
    for df in (good, rejects):
        text = df._jdf.queryExecution().executedPlan().toString()
        assert "csv" not in text.lower().replace("typed-csv", "") and "FileScan parquet" in text
    assert [r["id"] for r in good.orderBy("id").collect()] == [1, 3] and rejects.count() == 1
