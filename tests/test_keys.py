import pytest
from pyspark.sql import functions as F

from riskmart.operators import conform, keys, scd


def test_dense_key_equals_row_number_under_skew(spark):
    # One value holds most rows; the order is completed by a second column.
    df = spark.range(5000).select(F.when(F.col("id") % 3 > 0, F.lit(7)).otherwise(F.col("id")).alias("g"), "id").repartition(7)
    got = {(r["g"], r["id"]): r["k"] for r in keys.dense_key(df, ["g", "id"], "k").collect()}
    want = {gi: n for n, gi in enumerate(sorted(got), 1)}
    assert got == want


def test_rank_within_hot_group_is_split(spark):
    df = spark.range(6000).select(F.when(F.col("id") % 2 == 0, "hot").otherwise(F.concat(F.lit("g"), (F.col("id") % 50).cast("string"))).alias("g"), "id")
    rows = keys.rank_within(df, ["g"], ["id"], "rn").collect()
    by_group = {}
    for r in sorted(rows, key=lambda r: r["id"]):
        by_group.setdefault(r["g"], []).append(r["rn"])
    assert len(rows) == 6000
    assert all(v == list(range(1, len(v) + 1)) for v in by_group.values())


def test_upsert_is_idempotent_and_rejects_duplicates(spark):
    target = spark.createDataFrame([(1, "a", 1.0), (2, "b", 2.0)], "k int, name string, v double")
    source = spark.createDataFrame([(2, "x", 20.0), (3, "c", 3.0)], "k int, name string, v double")
    once = keys.upsert(target, source, ["k"], ["v"])
    twice = keys.upsert(once, source, ["k"], ["v"])
    want = {(1, "a", 1.0), (2, "b", 20.0), (3, "c", 3.0)}
    assert set(map(tuple, once.collect())) == want == set(map(tuple, twice.collect()))
    with pytest.raises(Exception, match="duplicate source key"):
        keys.upsert(target, source.unionAll(source), ["k"], ["v"]).collect()
    latest = keys.upsert(target, source.unionAll(source.withColumn("v", F.col("v") + 1)), ["k"], ["v"], latest_by=["v"])
    assert {r["k"]: r["v"] for r in latest.collect()} == {1: 1.0, 2: 21.0, 3: 4.0}


def test_scd2_keeps_one_current_row_per_key(spark):
    first = spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "id int, name string")
    dim = scd.scd2_start(first, "id", ["name"], "2024-01-01", "sk")
    second = spark.createDataFrame([(1, "a"), (2, None), (3, "c"), (4, "d")], "id int, name string")
    dim = scd.scd2_apply(dim, second, "id", ["name"], "2024-02-01", "sk")
    third = scd.scd2_apply(dim, second, "id", ["name"], "2024-03-01", "sk")
    assert third.count() == dim.count() == 6
    assert scd.one_current_each(third, "id").count() == 0
    assert {(r["id"], r["name"]) for r in scd.current_rows(third).collect()} == {(1, "a"), (2, None), (3, "c"), (4, "d")}
    assert {r["id"] for r in scd.scd2_as_of(dim, "2024-01-15").collect()} == {1, 2, 3}
    assert len({r["sk"] for r in third.collect()}) == 6


def test_insert_missing_numbers_new_rows_after_the_old(spark):
    have = spark.createDataFrame([(1, "Auto"), (2, "Home")], "id bigint, name string")
    seen = spark.createDataFrame([(" AUTO ",), ("Personal",), ("business",)], "name string")
    out = keys.insert_missing(have, seen, ["name"], "id", lambda c: F.upper(F.trim(c)))
    assert sorted(map(tuple, out.collect())) == [(1, "Auto"), (2, "Home"), (3, "Personal"), (4, "business")]


def test_suffix_past_ninety_nine(spark):
    df = spark.range(130).select(F.lit("A").alias("acc"), "id")
    out = {r["id"]: r["acc"] for r in conform.suffix_duplicate_ids(df, "acc", ["id"]).collect()}
    assert (out[0], out[1], out[99], out[100], out[129]) == ("A", "A_01", "A_99", "A_100", "A_129")
