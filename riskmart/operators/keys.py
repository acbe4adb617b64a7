"""Surrogate keys, natural-key hashes and snapshot upserts.

Parquet has no row-level MERGE, so an upsert is a pure function ``(target, source) -> new target`` whose result is
written as a new snapshot.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from riskmart.functions.expr import all_of, attach_stats
from riskmart.session import settle

_ROWS_BITS = 33  # monotonically_increasing_id keeps the row number of a partition in its lower 33 bits


def dense_key(
    df: DataFrame, order_cols: Sequence[str | Column], name: str, start: int | DataFrame = 1
) -> DataFrame:
    """Gap-free ids in the total order of ``order_cols``, equal to a global ``row_number`` without its single task.

    The rows are range-partitioned and sorted, then settled once so that both passes see the same split. Partition
    sizes (one row per partition) give each partition its offset. ``start`` may be a one-row table with a column
    ``start``.
    """
    ranged = df.repartitionByRange(*order_cols).sortWithinPartitions(*order_cols)
    ranged = settle(ranged.withColumn("_at", F.monotonically_increasing_id()))
    sizes = ranged.groupBy(F.shiftright("_at", _ROWS_BITS).alias("_part")).agg(F.count("*").alias("_n"))
    # One row per partition, so the un-keyed window and the broadcast hold a few thousand rows at most.
    before = W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    offsets = sizes.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    placed = (
        ranged.withColumn("_part", F.shiftright("_at", _ROWS_BITS))
        .join(F.broadcast(offsets), "_part")
        .withColumn("_at", F.col("_at").bitwiseAND((1 << _ROWS_BITS) - 1) + F.col("_offset"))
    )
    if isinstance(start, DataFrame):
        placed = attach_stats(placed, start.select(F.col("start").alias("_start")))
        first = F.col("_start")
    else:
        first = F.lit(start)
    placed = placed.withColumn(name, (F.col("_at") + first).cast("bigint"))
    return placed.drop("_at", "_part", "_offset", "_start")


def next_key(df: DataFrame, key: str) -> DataFrame:
    """One row with the first unused value of an id column."""
    return df.agg((F.coalesce(F.max(key), F.lit(0)) + 1).cast("bigint").alias("start"))


def rank_within(df: DataFrame, group: Sequence[str], order: Sequence[str], name: str) -> DataFrame:
    """``row_number() over (partition by group order by order)`` that never puts a whole group into one task.

    The rows are range-partitioned by (group, order) and settled once. The rank is the place inside the partition, from where the
    group starts there, plus what earlier partitions hold of the group. That comes from a table of one row per (partition,
    group), joined on both, so a group with a third of the rows stays spread over as many tasks as it has partitions. There are
    several ranges per task of a shuffle, so that the ranges of a hot group spread evenly.
    """
    sort = [*group, *order]
    ranged = df.repartitionByRange(8 * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *sort).sortWithinPartitions(*sort)
    ranged = settle(ranged.withColumn("_at", F.monotonically_increasing_id())).withColumn("_part", F.shiftright("_at", _ROWS_BITS))
    parts = ranged.groupBy("_part", *group).agg(F.min("_at").alias("_first"), F.count("*").alias("_n"))
    before = W.partitionBy(*group).orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    parts = parts.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0)))
    on = all_of([F.col("i._part") == F.col("f._part"), *[F.col(f"i.{g}").eqNullSafe(F.col(f"f.{g}")) for g in group]])
    joined = ranged.alias("i").join(parts.alias("f"), on)
    keep = [F.col(f"i.{c}") for c in df.columns]
    return joined.select(*keep, (F.col("i._at") - F.col("_first") + F.col("_before") + 1).cast("bigint").alias(name))


def natural_key_hash(cols: Sequence[str | Column]) -> Column:
    """MD5 of the key parts joined by a bar."""
    parts = [(F.col(c) if isinstance(c, str) else c).cast("string") for c in cols]
    return F.md5(F.concat_ws("|", *parts))


def one_per_key(df: DataFrame, keys: Sequence[str], latest_by: Sequence[str] | None = None, show: str | None = None) -> DataFrame:
    """One row per key: the latest by ``latest_by``, or, without it, an error when a key repeats; it names the key, or the struct column ``show``."""
    rest = [c for c in df.columns if c not in keys]
    if latest_by is not None:
        # The row itself closes the order, so ties cannot make the pick depend on task timing.
        pick = F.max(F.struct(*[F.col(c).alias(f"_o{i}") for i, c in enumerate(latest_by)], F.struct(*rest).alias("_r")))
        return df.groupBy(*keys).agg(pick.alias("_p")).select(*keys, *[F.col(f"_p._r.{c}").alias(c) for c in rest])
    grouped = df.groupBy(*keys).agg(F.count("*").alias("_n"), *[F.any_value(c).alias(c) for c in rest])
    single = F.when(F.col("_n") == 1, F.lit(True)).otherwise(
        F.raise_error(F.concat(F.lit("duplicate source key: "), F.to_json(F.col(show) if show else F.struct(*keys)))).cast("boolean")
    )
    return grouped.filter(single).select(*df.columns)


def upsert(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    update_cols: Sequence[str],
    insert_cols: Sequence[str] | None = None,
    latest_by: Sequence[str] | None = None,
) -> DataFrame:
    """Matched rows take ``update_cols`` from the source, unmatched source rows are inserted, others stay.

    One full outer join on the key; both sides are unique in it, so no key can be hot. The key is compared as one struct: with a
    literal part that differs between the sides, equality of the parts would fold to false and leave a join without keys. A
    repeated source key is an error unless ``latest_by`` says which row wins. The source is grouped by that struct too, so that the join
    takes the rows where the grouping left them. A key with a NULL part matches nothing.
    """
    insert_cols = list(insert_cols) if insert_cols is not None else [c for c in source.columns if c in target.columns]
    have = {f.name: f.dataType for f in target.schema.fields}

    def whole(k: Sequence[str]) -> Column:
        return F.struct(*[F.col(c).cast(have[c]).alias(c) for c in k])

    if all(source.schema[c].dataType == have[c] for c in keys):
        order = None if latest_by is None else [c for c in latest_by if c not in keys]
        src = one_per_key(source.withColumn("_key", whole(keys)).drop(*keys), ["_key"], order, show="_key")
        src = src.select(*[F.col(f"_key.{c}").alias(c) for c in keys], *src.columns)
    else:
        src = one_per_key(source, keys, latest_by).withColumn("_key", whole(keys))
    src = src.withColumn("_s", F.lit(1)).alias("s")
    tgt = target.withColumns({"_t": F.lit(1), "_key": whole(keys)}).alias("t")
    known = all_of(F.col(f"t.{c}").isNotNull() for c in keys)
    joined = tgt.join(src, (F.col("t._key") == F.col("s._key")) & known, "full")
    in_t, in_s = F.col("t._t").isNotNull(), F.col("s._s").isNotNull()
    out = []
    for f in target.schema.fields:
        c, old = f.name, F.col(f"t.{f.name}")
        new = F.col(f"s.{c}").cast(f.dataType) if c in source.columns else F.lit(None).cast(f.dataType)
        if c in keys:
            out.append(F.coalesce(old, new).alias(c))
        elif c in update_cols:
            insert = new if c in insert_cols else F.lit(None).cast(f.dataType)
            out.append(F.when(~in_t, insert).when(in_s, new).otherwise(old).alias(c))
        elif c in insert_cols:
            out.append(F.when(in_t, old).otherwise(new).alias(c))
        else:
            out.append(F.when(in_t, old).alias(c))
    return joined.select(*out)


def insert_missing(
    target: DataFrame,
    source: DataFrame,
    match: Sequence[str],
    surrogate: str | None = None,
    normalise: Callable[[Column], Column] = lambda c: c,
) -> DataFrame:
    """Add the source rows whose ``match`` columns have no counterpart in the target, with fresh surrogate ids.

    ``normalise`` is applied to both sides before comparing (for example upper-case and trim).
    """
    norm = [normalise(F.col(m)).alias(f"_k{i}") for i, m in enumerate(match)]
    names = [f"_k{i}" for i in range(len(match))]
    rest = [c for c in source.columns]
    fresh = source.select(*norm, F.struct(*rest).alias("_r")).groupBy(*names).agg(F.min("_r").alias("_r"))
    fresh = fresh.join(target.select(*norm).distinct(), names, "left_anti").select("_r.*")
    if surrogate:
        fresh = dense_key(fresh, list(match), surrogate, next_key(target, surrogate))
    return target.unionByName(fresh, allowMissingColumns=True).select(*target.columns)
