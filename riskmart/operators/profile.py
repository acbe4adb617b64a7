"""Column profiles and report numbers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskmart.functions.expr import numeric_columns
from riskmart.functions.moments import correlations
from riskmart.functions.stats import quantiles, value_counts
from riskmart.schemas import LINEAGE

QUARTILES = (0.25, 0.5, 0.75)


def profile(df: DataFrame) -> DataFrame:
    """One row per column: type, count, NULLs, distinct values, moments and quartiles of numbers, most frequent value."""
    cols, numbers = df.columns, numeric_columns(df)
    quart = quantiles(df, numbers, QUARTILES)
    types = dict(df.dtypes)
    aggs = [F.count("*").alias("_n")]
    for i, c in enumerate(cols):
        aggs.append(F.count(c).alias(f"n{i}"))
        if c in numbers:
            v = F.col(c).cast("double")
            aggs += [F.avg(v).alias(f"m{i}"), F.stddev_samp(v).alias(f"s{i}"), F.min(v).alias(f"a{i}"), F.max(v).alias(f"b{i}")]
    rows = []
    for i, c in enumerate(cols):
        num = c in numbers
        n = F.col(f"n{i}")
        rows.append(F.struct(
            F.lit(c).alias("column_name"), F.lit(types[c]).alias("data_type"), n.alias("count"), (F.col("_n") - n).alias("nulls"),
            F.try_divide((F.col("_n") - n) * 100.0, F.col("_n")).alias("null_pct"),
            *[(F.col(f"{k}{i}") if num else F.lit(None)).cast("double").alias(a) for k, a in (("m", "mean"), ("s", "std"), ("a", "min"))],
            *[F.lit(quart[c][p] if num else None).cast("double").alias(a) for p, a in zip(QUARTILES, ("p25", "p50", "p75"), strict=True)],
            (F.col(f"b{i}") if num else F.lit(None)).cast("double").alias("max")))
    shape = df.agg(*aggs).select(F.inline(F.array(*rows)))
    top = value_counts(df, cols).groupBy("column_name").agg(
        F.count("*").alias("distinct"), F.min(F.struct(-F.col("n"), "value")).alias("_t"))
    top = top.select("column_name", "distinct", F.col("_t.value").alias("top"), (-F.col("_t.col1")).alias("freq"))
    return shape.join(top, "column_name", "left").withColumn("distinct", F.coalesce("distinct", F.lit(0))).orderBy("column_name")


def histograms(df: DataFrame, cols: Sequence[str] | None = None, max_bins: int = 30) -> DataFrame:
    """Equal-width counts (column, bin, lower, upper, n) with min(``max_bins``, distinct values) bins; empty bins left out.

    Without ``cols`` all numeric columns.
    """
    cols = list(cols) if cols is not None else numeric_columns(df)
    counts = value_counts(df.select(*[F.col(c).cast("double").alias(c) for c in cols]), cols)
    counts = counts.withColumn("value", F.col("value").cast("double"))
    # One row per column.
    spans = counts.groupBy("column_name").agg(
        F.min("value").alias("lo"), F.max("value").alias("hi"), F.least(F.count("*"), F.lit(max_bins)).alias("bins"))
    width = (F.col("hi") - F.col("lo")) / F.col("bins")
    slot = F.least(F.floor(F.coalesce(F.try_divide((F.col("value") - F.col("lo")) * F.col("bins"), F.col("hi") - F.col("lo")), F.lit(0.0))), F.col("bins") - 1)
    binned = counts.join(F.broadcast(spans), "column_name").withColumn("bin", slot.cast("int"))
    return binned.groupBy("column_name", "bin").agg(
        F.first(F.col("lo") + F.col("bin") * width).alias("lower"), F.first(F.col("lo") + (F.col("bin") + 1) * width).alias("upper"),
        F.sum("n").alias("n"))


def correlation_matrix(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Pearson correlation of each pair (lower triangle) of ``cols`` or all numeric columns, all pairs from one scan."""
    cols = list(cols) if cols is not None else numeric_columns(df)
    found = correlations(df, cols) if len(cols) > 1 else {}
    return df.sparkSession.createDataFrame([(b, a, r) for (a, b), (_, r) in found.items()], "column_a string, column_b string, r double")


def missing_report(df: DataFrame) -> DataFrame:
    """Share of NULL in percent for columns that have any, highest first; lineage columns do not count."""
    cols = [c for c in df.columns if c not in LINEAGE]
    row = df.agg(*[(F.avg(F.col(c).isNull().cast("double")) * 100).alias(f"c{i}") for i, c in enumerate(cols)])
    cells = [F.struct(F.lit(c).alias("column_name"), F.col(f"c{i}").alias("missing_pct")) for i, c in enumerate(cols)]
    return row.select(F.inline(F.array(*cells))).filter("missing_pct > 0").orderBy(F.desc("missing_pct"), "column_name")


def save_issue_report(issues: DataFrame, df: DataFrame, dataset: str, path: str) -> DataFrame:
    """Write the issue rows with dataset name, row and column count as JSON and return what was written."""
    size = df.agg(F.count("*").alias("row_count"))
    report = issues.crossJoin(F.broadcast(size)).select(
        F.lit(dataset).alias("dataset"), "row_count", F.lit(len(df.columns)).alias("column_count"),
        *[c for c in issues.columns if c != "dataset"])
    report.write.mode("errorifexists").json(path)
    return df.sparkSession.read.schema(report.schema).json(path)
