"""Type-2 (versioned) dimensions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskmart.functions.expr import any_of
from riskmart.operators.keys import dense_key, next_key, one_per_key
from riskmart.session import settle

PERIOD = ("IsCurrent", "effective_start", "effective_end")


def scd2_start(batch: DataFrame, key: str, tracked: Sequence[str], as_of, surrogate: str,
               latest_by: Sequence[str] | None = None) -> DataFrame:
    """First load of a versioned dimension: one current row per key."""
    rows = one_per_key(batch.select(key, *tracked, *(latest_by or ())), [key], latest_by).select(key, *tracked)
    rows = dense_key(rows, [key], surrogate)
    return rows.select(
        surrogate, key, *tracked,
        F.lit(1).alias("IsCurrent"),
        F.lit(as_of).cast("date").alias("effective_start"),
        F.lit(None).cast("date").alias("effective_end"),
    )


def scd2_apply(dim: DataFrame, batch: DataFrame, key: str, tracked: Sequence[str], as_of, surrogate: str,
               latest_by: Sequence[str] | None = None, attributes: Sequence[str] | None = None) -> DataFrame:
    """Close current rows whose tracked attributes changed, add one new version each, add rows for new keys.

    Changes are compared NULL-safely. Keys missing from the batch stay as they are. History is carried along untouched,
    only the current rows take part in the join. A new version stores ``attributes`` (default: the tracked ones), so a
    caller may watch a few attributes and still replace all of them. The rows of the batch are settled, because kept rows, new rows
    and the ranges of their keys all come from them.
    """
    stored = list(attributes or tracked)
    rows = one_per_key(batch.select(key, *stored, *(latest_by or ())), [key], latest_by)
    rows = settle(rows.select(key, *stored)).withColumn("_b", F.lit(1)).alias("b")
    current = dim.filter("IsCurrent = 1").alias("d")
    joined = current.join(rows, F.col(f"d.{key}") == F.col(f"b.{key}"), "full")
    known, seen = F.col("d.IsCurrent").isNotNull(), F.col("b._b").isNotNull()
    changed = seen & any_of(~F.col(f"d.{c}").eqNullSafe(F.col(f"b.{c}")) for c in tracked)
    day = F.lit(as_of).cast("date")

    kept = joined.filter(known).select(
        *[F.col(f"d.{c}") for c in dim.columns if c not in PERIOD],
        F.when(changed, 0).otherwise(1).alias("IsCurrent"),
        F.col("d.effective_start"),
        F.when(changed, day).alias("effective_end"),
    )
    fresh = joined.filter(seen & (~known | changed)).select(F.col(f"b.{key}"), *[F.col(f"b.{c}") for c in stored])
    fresh = dense_key(fresh, [key], surrogate, next_key(dim, surrogate)).withColumns({
        "IsCurrent": F.lit(1),
        "effective_start": day,
        "effective_end": F.lit(None).cast("date"),
    })
    history = dim.filter("IsCurrent <> 1")
    return history.unionByName(kept).unionByName(fresh, allowMissingColumns=True).select(*dim.columns)


def scd2_as_of(dim: DataFrame, ts) -> DataFrame:
    """Versions valid at a point in time."""
    at = F.lit(ts).cast("date")
    return dim.filter((F.col("effective_start") <= at) & (F.col("effective_end").isNull() | (at < F.col("effective_end"))))


def current_rows(dim: DataFrame) -> DataFrame:
    return dim.filter("IsCurrent = 1")


def one_current_each(dim: DataFrame, key: str) -> DataFrame:
    """Keys that do not have exactly one current row (empty when the dimension is sound)."""
    n = F.sum(F.when(F.col("IsCurrent") == 1, 1).otherwise(0))
    return dim.groupBy(key).agg(n.alias("n_current")).filter("n_current > 1")


__all__ = ["scd2_start", "scd2_apply", "scd2_as_of", "current_rows", "one_current_each"]
