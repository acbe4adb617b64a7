"""Bounded samples of labelled rows: no size makes a share zero, no repeated id makes a sample large."""

from pyspark.sql import functions as F

from riskmart.llm import langid
from riskmart.llm.common import below_share
from riskmart.llm.textstats import labelled_sample


def test_shares_never_become_zero():
    assert below_share(1.0) == below_share(7.0) == (1 << 63) - 1
    for rows in (3_000, 5_000_000_000, 10**15):
        got = (below_share(2_000 / rows) + (1 << 63)) / 2.0**64
        assert abs(got * rows - 2_000) < 1e-3 * 2_000


def test_a_repeated_id_teaches_once(spark):
    rows = spark.range(5_000).select(F.lit(1).cast("long").alias("doc_id"), F.concat(F.lit("text "), F.col("id").cast("string")).alias("text"))
    rows = rows.unionByName(spark.createDataFrame([(2, None), (3, "x"), (None, "y")], "doc_id long, text string"))
    labels = spark.createDataFrame([(1, 1), (2, 0), (3, None), (None, 1)], "doc_id long, quality int")
    got = labelled_sample(rows, labels, "quality", 20_000).collect()
    assert sorted((r["doc_id"], r["_label"]) for r in got) == [(1, 1), (2, 0)]
    again = labelled_sample(rows.repartition(7), labels, "quality", 20_000).collect()
    assert sorted(map(str, got)) == sorted(map(str, again))


def test_a_sample_follows_its_bound(spark):
    rows = spark.range(4_000).select(F.col("id").alias("doc_id"), F.lit("t").alias("text"))
    labels = rows.select("doc_id", (F.col("doc_id") % 2).cast("int").alias("quality"))
    assert 350 < labelled_sample(rows, labels, "quality", 400).count() < 450


def test_every_language_is_learned(spark):
    rows = spark.createDataFrame([(i, f"ab{i} cd", "xx") for i in range(300)] + [(1_000, "ef gh", "yy")], "doc_id long, text string, lang string")
    languages, matrix, prior = langid.fit(rows, F.lit(True), per_language=50)
    assert languages == ["xx", "yy"] and matrix.shape[0] == 2 and prior[0] > prior[1]
