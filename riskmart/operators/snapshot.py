"""Keyed tables kept as partitions of files, of which a merge rewrites only those its batch touches.

A table is a folder with data (one folder per version and partition) and a manifest per version that names the folder of every partition. A partition is a
function of the key alone, so a row and its replacement meet in the same one. A merge reads the partitions that occur in the batch, upserts
them, writes them as a new version and copies the other names into the new manifest: their files stay the files they were. The
manifest is written last and only once per version, so readers see a whole version or none, and of two merges of one version one fails.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskmart.operators.keys import upsert
from riskmart.session import settle

PART = "_part"
MANIFEST = "kind string, name string, value string"


class KeyedTable:
    """``keys`` name a row. ``by`` are expressions of key columns that batches are close in, such as the month of a date key;
    ``buckets`` cuts each further by a hash of the key."""

    def __init__(self, spark: SparkSession, root: str, keys: Sequence[str], by: Sequence[Column] = (), buckets: int = 16):
        self.spark, self.root, self.keys, self.by, self.buckets = spark, root.rstrip("/"), list(keys), list(by), buckets

    # --- files ---

    def _children(self, path: str) -> list[str]:
        """Names below a folder, on whatever storage it is; none if there is no such folder."""
        at = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        fs = at.getFileSystem(self.spark._jsc.hadoopConfiguration())
        return sorted(s.getPath().getName() for s in fs.listStatus(at)) if fs.exists(at) else []

    def _delete(self, path: str) -> bool:
        at = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return at.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(at, True)

    def versions(self) -> list[int]:
        """The versions whose manifest is complete."""
        found = self._children(f"{self.root}/manifest")
        return [int(v) for v in found if v.isdigit() and "_SUCCESS" in self._children(f"{self.root}/manifest/{v}")]

    def _manifest(self, version: int) -> tuple[T.StructType, dict[str, str]]:
        """Schema and folder by partition: as many rows as partitions, as a listing of the folders would have."""
        rows = self.spark.read.schema(MANIFEST).parquet(f"{self.root}/manifest/{version:08d}").collect()
        schema = next(r["value"] for r in rows if r["kind"] == "schema")
        return T.StructType.fromJson(json.loads(schema)), {r["name"]: r["value"] for r in rows if r["kind"] == "part"}

    # --- rows ---

    def _with_part(self, df: DataFrame) -> DataFrame:
        names = [F.coalesce(c.cast("string"), F.lit("none")) for c in self.by]
        return df.withColumn(PART, F.concat_ws("-", *names, F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("string")))

    def _commit(self, df: DataFrame, version: int, schema: T.StructType, kept: dict[str, str]) -> DataFrame:
        path = f"{self.root}/data/{version:08d}"
        # rows of a partition come together, large partitions in several files
        self._with_part(df).hint("rebalance", PART).write.mode("overwrite").partitionBy(PART).parquet(path)
        new = {name.split("=", 1)[1]: f"{path}/{name}" for name in self._children(path) if name.startswith(f"{PART}=")}
        rows = [("schema", "", schema.json()), *[("part", k, v) for k, v in sorted({**kept, **new}.items())]]
        self.spark.createDataFrame(rows, MANIFEST).coalesce(1).write.mode("errorifexists").parquet(f"{self.root}/manifest/{version:08d}")
        return self.read(version)

    def _read(self, schema: T.StructType, folders: Sequence[str]) -> DataFrame:
        if not folders:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*folders)

    def create(self, df: DataFrame) -> DataFrame:
        """Version 0; an error if the table exists."""
        if self.versions():
            raise ValueError(f"{self.root} exists")
        return self._commit(df, 0, df.schema, {})

    def read(self, version: int | None = None) -> DataFrame:
        """The latest version, or the given one."""
        at = max(self.versions()) if version is None else version
        schema, folders = self._manifest(at)
        return self._read(schema, [folders[k] for k in sorted(folders)])

    def merge(self, source: DataFrame, update_cols: Sequence[str], insert_cols: Sequence[str] | None = None, latest_by: Sequence[str] | None = None) -> DataFrame:
        """:func:`riskmart.operators.keys.upsert` of the batch ``source``, in the partitions it touches; returns the new version.

        An empty batch makes no version.
        """
        at = max(self.versions())
        schema, folders = self._manifest(at)
        kinds = {f.name: f.dataType for f in schema.fields}
        source = settle(self._with_part(source.withColumns({k: F.col(k).cast(kinds[k]) for k in self.keys})))
        touched = {r[PART] for r in source.select(PART).distinct().collect()}  # no more than there are partitions
        if not touched:
            return self.read(at)
        old = self._read(schema, [folders[k] for k in sorted(touched & set(folders))])
        new = upsert(old, source.drop(PART), self.keys, update_cols, insert_cols, latest_by)
        return self._commit(new, at + 1, schema, {k: v for k, v in folders.items() if k not in touched})

    def vacuum(self, keep: int = 2) -> int:
        """Delete the manifests before the last ``keep`` versions and the data folders that none of those left names. Returns the folders deleted."""
        versions = sorted(self.versions())
        gone, left = versions[:-keep], versions[-keep:]
        named = {f for v in left for f in self._manifest(v)[1].values()}
        dropped = sum(self._delete(f) for v in gone for f in set(self._manifest(v)[1].values()) - named)
        for v in gone:
            self._delete(f"{self.root}/manifest/{v:08d}")
        return dropped
