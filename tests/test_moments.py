"""Moments of all column pairs against pandas and the built-in aggregate."""

import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from riskmart.functions import moments
from riskmart.functions.expr import pearson
from riskmart.operators.clean import drop_redundant_columns
from riskmart.operators.profile import correlation_matrix




def test_five_hundred_columns_in_one_scan_equal_the_built_in(spark, tmp_path):
    path = tmp_path / "wide"
    path.mkdir()
    rng = np.random.default_rng(3)
    table = pd.DataFrame(rng.normal(size=(3000, 500)), columns=[f"c{i}" for i in range(500)])
    table.iloc[:, ::5] += 1e9
    table.iloc[:, 2::3] = table.iloc[:, 2::3].mask(rng.random((3000, 166)) < 0.1)
    table["c499"] += table["c497"]
    for at in range(6):
        table.iloc[500 * at:500 * (at + 1)].to_parquet(path / f"{at}.parquet")
    df = spark.read.parquet(str(path))
    got = moments.correlations(df, df.columns)
    assert len(got) == 500 * 499 // 2
    some = [(f"c{a}", f"c{b}") for a, b in ((0, 1), (3, 300), (5, 10), (123, 456), (497, 499), (0, 495))]
    want = df.agg(*[pearson(a, b).alias(f"{a}_{b}") for a, b in some]).first()
    for a, b in some:
        assert got[(a, b)][1] == pytest.approx(want[f"{a}_{b}"], abs=1e-7)
        assert got[(a, b)][0] is False


def test_one_scan_of_the_files(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(100).select(*[(F.col("id") * i % 17).alias(f"c{i}") for i in range(1, 41)]).write.parquet(path)
    df = spark.read.parquet(path)
    text = df.select(*df.columns).mapInArrow(moments._states(40, range(40), range(40)), moments.STATE)._jdf.queryExecution().executedPlan().toString()
    assert text.count("FileScan") == 1 and "Exchange" not in text
    again = moments.pair_moments(df, df.columns)._jdf.queryExecution().optimizedPlan().toString()
    assert path not in again  # what follows reads the staged states only


def test_groups_of_columns_give_the_same(spark, monkeypatch):
    df = spark.range(200).select(*[F.when(F.col("id") % 7 != i, F.col("id") * (i + 2) % 23).alias(f"c{i}") for i in range(9)]).repartition(4)
    one = moments.correlations(df, df.columns)
    monkeypatch.setattr(moments, "GROUP", 4)
    more = moments.correlations(df, df.columns)
    assert one.keys() == more.keys()
    for k, (same, r) in one.items():
        assert more[k][0] == same and more[k][1] == pytest.approx(r, abs=1e-12)


def test_far_from_zero_and_values_that_start_late(spark):
    rows = [(1e12 + i, 2e12 - i, None if i < 900 else float(i), 1e15, 0.1) for i in range(1000)]
    df = spark.createDataFrame(rows, "a double, b double, late double, constant double, tenth double").repartitionByRange(5, "a")
    got = moments.correlations(df, df.columns)
    assert got[("a", "b")][1] == pytest.approx(-1.0, abs=1e-9)
    assert got[("a", "late")][1] == pytest.approx(1.0, abs=1e-9)
    assert got[("a", "constant")][1] is None and got[("constant", "tenth")][1] is None


def test_equal_columns_count_null_as_zero_and_nan_as_itself(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1.0, 1, 1.0, nan, nan, 5.0, inf), (None, 0, -0.0, 2.0, 2.0, 6.0, 3.0), (3.0, 3, 3.0, None, 0.0, None, 4.0)]
    df = spark.createDataFrame(rows, "a double, b int, c double, d double, e double, f double, g double").repartition(3)
    got = moments.correlations(df, df.columns)
    equal = {k for k, (same, _) in got.items() if same}
    assert equal == {("a", "b"), ("a", "c"), ("b", "c"), ("d", "e")}
    assert math.isnan(got[("d", "e")][1]) and math.isnan(got[("a", "g")][1])
    # the value that is not finite lies where the other column is unknown
    rest = spark.createDataFrame([(nan, None), (1.0, 1.0), (2.0, 2.0), (4.0, 3.0)], "x double, y double")
    assert moments.correlations(rest, ["x", "y"])[("x", "y")][1] == pytest.approx(pd.Series([1.0, 2, 4]).corr(pd.Series([1.0, 2, 3])))


def test_random_tables_equal_pandas(spark):
    rng = np.random.default_rng(5)
    table = pd.DataFrame(rng.normal(size=(400, 6)), columns=list("abcdef"))
    table["b"] = table["a"] * 2 + rng.normal(size=400) * 0.01
    table = table.mask(rng.random(table.shape) < 0.2)
    df = spark.createDataFrame([tuple(None if pd.isna(v) else float(v) for v in row) for row in table.to_numpy()], ", ".join(f"{c} double" for c in table.columns))
    want = table.corr()
    for (a, b), (_, r) in moments.correlations(df.repartition(7), df.columns).items():
        assert r == pytest.approx(want.loc[a, b], abs=1e-12)
    assert "b" not in drop_redundant_columns(df).columns and "c" in drop_redundant_columns(df).columns


def test_empty_table_and_few_columns(spark):
    empty = spark.createDataFrame([], "x double, y double")
    assert correlation_matrix(empty).collect() == [("y", "x", None)]
    assert drop_redundant_columns(empty).columns == ["x"]
    one = spark.range(3)
    assert correlation_matrix(one).count() == 0 and drop_redundant_columns(one).columns == ["id"]
    odd = spark.range(3).select(F.col("id").alias("a.b"), (F.col("id") * 2).alias("with space"))
    assert moments.correlations(odd, odd.columns)[("a.b", "with space")][1] == pytest.approx(1.0)
