"""File sources and sinks."""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskmart.operators.keys import dense_key
from riskmart.session import stage_path, staged

FORMATS_IN = ("csv", "json", "parquet")
FORMATS_OUT = ("csv", "json", "parquet")
CORRUPT = "_corrupt_record"
MANIFEST = "manifest"


def read_source(spark: SparkSession, path: str, fmt: str | None = None, schema: T.StructType | str | None = None,
                max_rows: int | None = None, **options) -> DataFrame:
    """Read CSV (with header), JSON records or Parquet; the format follows the file ending unless given."""
    fmt = (fmt or path.rstrip("/").rsplit(".", 1)[-1]).lower()
    if fmt not in FORMATS_IN:
        raise ValueError(f"unsupported file format: {fmt}")
    reader = spark.read.options(**options)
    if schema is not None:
        reader = reader.schema(schema)
    if fmt == "csv":
        reader = reader.option("header", True)
    df = reader.format(fmt).load(path)
    return df if max_rows is None else df.limit(max_rows)


def write_output(df: DataFrame, path: str, fmt: str | None = None, mode: str = "errorifexists") -> int:
    """Write a result and return the number of rows, counted while writing."""
    fmt = (fmt or path.rstrip("/").rsplit(".", 1)[-1]).lower()
    if fmt not in FORMATS_OUT:
        raise ValueError(f"unsupported file format: {fmt}")
    seen = Observation()
    writer = df.observe(seen, F.count(F.lit(1)).alias("rows")).write.mode(mode)
    if fmt == "csv":
        writer = writer.option("header", True)
    writer.format(fmt).save(path)
    return seen.get["rows"]


class TooManyErrors(RuntimeError):
    """More bad rows than the load allows."""


def load_typed_csv(spark: SparkSession, path: str, schema: T.StructType, max_errors: int,
                   reject_path: str | None = None, **options) -> tuple[DataFrame, DataFrame]:
    """CSV with header against a fixed schema: (good rows, rejected rows with the raw line).

    The load fails when more than ``max_errors`` lines do not fit; rejects are kept below ``reject_path`` if given.
    """
    full = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    # Parsed once, into a staged table that holds every column: a line is bad when any of its columns is, and the parser skips columns nobody needs.
    raw = staged(spark.read.schema(full).options(
        header=True, mode="PERMISSIVE", columnNameOfCorruptRecord=CORRUPT, columnPruning=False, **options).csv(path), "typed-csv")
    bad = F.col(CORRUPT).isNotNull()
    found = raw.filter(bad).count()
    rejects = raw.filter(bad)
    if reject_path:
        rejects.write.mode("overwrite").json(reject_path)
    if found > max_errors:
        raise TooManyErrors(f"{found} rows of {path} do not fit the schema, {max_errors} allowed")
    return raw.filter(~bad).drop(CORRUPT), rejects


def reload_tables(tables: Mapping[str, DataFrame], root: str, batch_id: str,
                  required: Sequence[str] = ()) -> tuple[dict[str, str], DataFrame]:
    """Full reload of several tables as one unit: a new snapshot folder ``root/batch_id`` and a table of row counts.

    Nothing is written when a required table is missing. Tables go below a folder name of this attempt; the manifest (table, path,
    rows), written last, publishes them all at once. Readers go by :func:`published`; an attempt that failed is invisible
    and does not stand in the way of the next, and a published snapshot is never overwritten.
    """
    absent = [n for n in required if n not in tables]
    if absent:
        raise FileNotFoundError(f"missing source for: {', '.join(absent)}")
    home = f"{root.rstrip('/')}/{batch_id}"
    paths, counts, spark = {}, [], next(iter(tables.values())).sparkSession
    if _exists(spark, f"{home}/{MANIFEST}"):
        raise FileExistsError(f"snapshot {home} already exists")
    attempt = uuid.uuid4().hex
    for name, df in tables.items():
        paths[name] = f"{home}/{attempt}/{name}"
        counts.append((name, paths[name], write_output(df, paths[name], "parquet")))
    manifest = spark.createDataFrame(counts, "table_name string, path string, row_count bigint")
    manifest.coalesce(1).write.mode("errorifexists").json(f"{home}/{MANIFEST}")
    return paths, manifest.drop("path")


def _exists(spark: SparkSession, path: str) -> bool:
    at = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    return at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at)


def published(spark: SparkSession, root: str, batch_id: str) -> dict[str, DataFrame]:
    """The tables of a published snapshot by its manifest."""
    rows = spark.read.schema("table_name string, path string, row_count bigint").json(f"{root.rstrip('/')}/{batch_id}/{MANIFEST}").collect()
    return {r["table_name"]: spark.read.parquet(r["path"]) for r in rows}


def with_row_index(df: DataFrame, order_by: Sequence[str], name: str = "_row") -> DataFrame:
    """Position of each row (from 0) in a stated total order."""
    return dense_key(df, list(order_by), name, 0)


def zip_sources(dfs: Sequence[DataFrame], orders: Sequence[Sequence[str]]) -> DataFrame:
    """Put sources side by side by row position; a shorter source is padded with NULL, repeated names get a suffix."""
    taken: dict[str, int] = {}
    out, columns = None, []
    for df, order in zip(dfs, orders, strict=True):
        indexed = with_row_index(df, order)
        for c in df.columns:
            n = taken.get(c, -1) + 1
            taken[c] = n
            new = c if n == 0 else f"{c}_{n}"
            indexed = indexed.withColumnRenamed(c, new)
            columns.append(new)
        out = indexed if out is None else out.join(indexed, "_row", "full")
    return out.select(*columns)


def checkpoint_step(df: DataFrame, name: str, path: str | None = None) -> DataFrame:
    """Save a step's output and go on from the saved files."""
    path = path or stage_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def add_lineage(df: DataFrame, batch_id: str, load_ts) -> DataFrame:
    """Load batch, load time and an empty last-updated column."""
    return df.withColumns({
        "LoadBatchID": F.lit(batch_id),
        "LoadDate": F.lit(load_ts).cast("timestamp"),
        "LastUpdated": F.lit(None).cast("timestamp"),
    })
