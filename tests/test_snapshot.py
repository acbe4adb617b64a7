"""Keyed tables: merges against plain upserts, and files that stay the files they were."""

import random

import pytest
from pyspark.sql import functions as F

from riskmart.operators.keys import upsert
from riskmart.operators.snapshot import KeyedTable


def names(df):
    return {f.rsplit("/", 1)[-1] for f in df.inputFiles()}


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=str)


@pytest.fixture
def table(spark):
    rng = random.Random(4)
    rows = [(m * 100 + d, c, f"s{rng.randrange(4)}", rng.random()) for m in range(202001, 202013) for d in (1, 15) for c in range(8)] + [(None, 3, "none", 0.5)]
    return spark.createDataFrame(rows, "day long, cust long, state string, amount double")


def store(spark, path, buckets=3):
    return KeyedTable(spark, str(path), ["day", "cust"], [F.floor(F.col("day") / 100)], buckets)


def test_merge_equals_upsert_and_leaves_other_months_alone(spark, table, tmp_path):
    kept = store(spark, tmp_path)
    first = kept.create(table)
    assert rows_of(first) == rows_of(table)
    batch = spark.createDataFrame([(20201101, 2, "new", 9.0), (20201102, 99, "new", 8.0), (20210103, 1, "later", 7.0)], "day int, cust int, state string, amount double")
    before, was = names(first), {f for f in first.inputFiles()}
    second = kept.merge(batch, ["state"])
    assert rows_of(second) == rows_of(upsert(table, batch, ["day", "cust"], ["state"]))
    same = {f for f in second.inputFiles() if "/00000000/" in f}
    months = {f.split("_part=")[1].split("-")[0] for f in was}
    assert same < was and {f.split("_part=")[1].split("-")[0] for f in same} >= months - {"202011"} and before & names(second)
    assert len(was - same) <= 3  # of twelve months in three buckets, those of one
    assert rows_of(kept.read(0)) == rows_of(table)


def test_repeated_and_empty_batches(spark, table, tmp_path):
    kept = store(spark, tmp_path)
    kept.create(table)
    twice = spark.createDataFrame([(20200101, 1, "a", 1.0), (20200101, 1, "b", 2.0)], table.schema)
    with pytest.raises(Exception, match="duplicate source key"):
        kept.merge(twice, ["state"])
    assert kept.versions() == [0]  # a failed merge leaves no version behind
    done = kept.merge(twice, ["state"], latest_by=["amount"])
    assert done.where("day = 20200101 and cust = 1").first()["state"] == "b"
    assert rows_of(kept.merge(twice.limit(0), ["state"])) == rows_of(done) and kept.versions() == [0, 1]


def test_from_an_empty_table(spark, table, tmp_path):
    kept = store(spark, tmp_path)
    assert kept.create(table.limit(0)).collect() == []
    assert rows_of(kept.merge(table.where("day is not null"), ["state"])) == rows_of(table.where("day is not null"))
    with pytest.raises(ValueError):
        kept.create(table)


def test_vacuum_keeps_what_the_last_versions_read(spark, table, tmp_path):
    kept = store(spark, tmp_path)
    kept.create(table)
    for n in range(3):
        kept.merge(spark.createDataFrame([(20200201, n, f"v{n}", 1.0)], table.schema), ["state"])
    want = rows_of(kept.read())
    assert kept.vacuum(1) > 0 and kept.versions() == [3] and rows_of(kept.read()) == want
