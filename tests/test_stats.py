import numpy as np
import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from riskmart.functions import stats
from riskmart.functions.uniform import beta_2_5, normal, uniform

PROBS = (0.0, 0.25, 0.5, 0.75, 0.99, 1.0)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.one_of(st.none(), st.floats(-1e12, 1e12), st.integers(-3, 3).map(float)), min_size=1, max_size=60))
def test_quantiles_equal_pandas(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "x double")
    got = stats.quantiles(df, ["x"], PROBS)["x"]
    known = pd.Series([v for v in values if v is not None], dtype=float)
    for p in PROBS:
        if known.empty:
            assert got[p] is None
        else:
            assert got[p] == pytest.approx(known.quantile(p), rel=1e-12, abs=1e-12)


def test_quantiles_with_hot_value_and_far_outlier(spark):
    df = spark.range(3000).select(F.when(F.col("id") % 3 > 0, 5.0).when(F.col("id") == 0, 1e300).otherwise(F.col("id") * 1e-9).alias("x"))
    want = df.toPandas()["x"]
    got = stats.quantiles(df, ["x"], PROBS)["x"]
    assert [got[p] for p in PROBS] == pytest.approx([want.quantile(p) for p in PROBS])


def test_modes_take_the_lowest_on_ties(spark):
    df = spark.createDataFrame([("b", None), ("a", "x"), ("b", "x"), ("a", None)], "p string, q string")
    assert stats.modes(df, ["p", "q"]) == {"p": "a", "q": "x"}


def test_small_domains_leaves_wide_columns_out(spark):
    df = spark.range(500).select((F.col("id") % 3).cast("string").alias("few"), F.col("id").cast("string").alias("many"))
    assert stats.small_domains(df, ["few", "many"], 3) == {"few": ["0", "1", "2"]}


def test_random_numbers_have_their_distribution_and_do_not_depend_on_partitions(spark):
    df = spark.range(20000)
    cols = [uniform(["id"], "a", 1).alias("u"), normal(["id"], "b", 1).alias("z"), beta_2_5(["id"], "c", 1).alias("b")]
    one = df.repartition(3).select("id", *cols).toPandas().sort_values("id")
    two = df.repartition(11).select("id", *cols).toPandas().sort_values("id")
    assert np.array_equal(one.to_numpy(), two.to_numpy())
    assert one["u"].between(0, 1, inclusive="neither").all() and abs(one["u"].mean() - 0.5) < 0.01
    assert abs(one["z"].mean()) < 0.03 and abs(one["z"].std() - 1) < 0.03
    assert abs(one["b"].mean() - 2 / 7) < 0.01
