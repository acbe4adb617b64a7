"""Tables kept in buckets of one key, so that aggregates and joins on it read them without a shuffle."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskmart.session import stage_path, staged


@dataclass(frozen=True)
class Colocated:
    """``cold`` tables share their buckets; ``hot`` holds the rows of keys that no bucket could take, None if there are none.

    A key has all its rows of all tables on one side.
    """

    cold: dict[str, DataFrame]
    hot: dict[str, DataFrame] | None

    def each(self, plan: Callable[[dict[str, DataFrame]], DataFrame]) -> DataFrame:
        """``plan`` on both sides, for plans whose rows depend on the rows of one key (and on tables without the key)."""
        rows = plan(self.cold)
        return rows if self.hot is None else rows.unionByName(plan(self.hot))


def hot_keys(tables: Mapping[str, DataFrame], key: str, buckets: int, least_rows: int) -> DataFrame:
    """(_hot): keys with over half a mean bucket of some table's rows, so under ``2 * buckets`` per table. NULL counts as a key."""
    found = []
    for name, df in tables.items():
        counts = staged(df.groupBy(F.col(key).alias("_hot")).agg(F.count("*").alias("_n")), f"rows-by-key-{name}")
        rows = counts.agg(F.sum("_n")).first()[0] or 0
        found.append(counts.where((F.col("_n") * (2 * buckets) > rows) & (F.col("_n") >= least_rows)).select("_hot"))
    return reduce(DataFrame.unionByName, found).distinct()


def save_colocated(tables: Mapping[str, DataFrame], key: str, buckets: int | None = None, least_rows: int = 100_000) -> Colocated:
    """Save ``tables`` in ``buckets`` (the number of shuffle partitions) by ``key``, which has one type in all of them.

    A bucket is read by one task, so keys that would fill one go apart into plain files: there an aggregate combines before its shuffle and a
    hot key costs no single task. Keys of fewer than ``least_rows`` rows never go apart. Each table is read once for the counts and once or twice to
    be written. The files lie in the shared folder and go with :func:`riskmart.session.drop_staged`.
    """
    spark = next(iter(tables.values())).sparkSession
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    kinds = {name: df.schema[key].dataType.simpleString() for name, df in tables.items()}
    if len(set(kinds.values())) > 1:
        raise TypeError(f"{key} has several types, whose hashes differ: {kinds}")
    hot = staged(hot_keys(tables, key, buckets, least_rows), "hot-keys")
    parted = not hot.isEmpty()

    def side(df: DataFrame, how: str) -> DataFrame:
        return df.join(F.broadcast(hot), F.col(key).eqNullSafe(F.col("_hot")), how)

    def bucketed(name: str, df: DataFrame) -> DataFrame:
        table = f"colocated_{name}_{uuid.uuid4().hex}".lower()
        out = df.repartition(buckets, key).write.format("parquet").bucketBy(buckets, key).sortBy(key)
        out.option("path", stage_path(spark, table)).saveAsTable(table)
        return spark.table(table)

    cold = {name: bucketed(name, side(df, "left_anti") if parted else df) for name, df in tables.items()}
    return Colocated(cold, {name: staged(side(df, "left_semi"), f"hot-{name}") for name, df in tables.items()} if parted else None)


__all__ = ["Colocated", "hot_keys", "save_colocated"]
