"""Session and scratch-folder helpers."""

from __future__ import annotations

import os
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession


_STAGED: list[str] = []


def local_session(cores: int | str = 8, name: str = "riskmart") -> SparkSession:
    """A single-machine session for tests and the bench; a cluster brings its own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(name)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("RISKMART_DRIVER_MEMORY", "8g"))
        .getOrCreate()
    )


def scratch_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``; where none is named, one below the warehouse.

    Both are on storage that every executor reaches on a cluster. There is no temporary folder of one machine, on no master.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named
    made = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_staged"
    spark.sparkContext.setCheckpointDir(made)
    return made


def settle(df: DataFrame) -> DataFrame:
    """Materialise ``df`` in the shared folder and cut its lineage.

    Used where two passes must see the very same partitioning (dense ids). The files are on shared storage, so a lost
    executor costs a re-read, never a different split.
    """
    scratch_dir(df.sparkSession)
    if df.sparkSession.sparkContext.getCheckpointDir() is None:
        df.sparkSession.sparkContext.setCheckpointDir(scratch_dir(df.sparkSession))
    return df.checkpoint(eager=True)


def stage_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder for a staged table; :func:`drop_staged` ends its life."""
    path = f"{scratch_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    _STAGED.append(path)
    return path


def staged(df: DataFrame, name: str, codec: str | None = None) -> DataFrame:
    """``df`` written as Parquet to the shared folder and read back: cuts the lineage, and later reads fetch only their columns."""
    path = stage_path(df.sparkSession, name)
    df.write.parquet(path, compression=codec)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def staged_mark() -> int:
    """The place in the list of staged paths; what is staged from here on can be dropped with ``drop_staged(spark, mark)``."""
    return len(_STAGED)


def drop_staged(spark: SparkSession, since: int = 0, keep: Sequence[DataFrame] = ()) -> int:
    """Delete what this process staged (after the mark ``since``), once the results that read it are written. Returns the number of paths dropped.

    Paths that the tables in ``keep`` still read stay, and stay on the list.
    """
    read = [f for df in keep for f in df.inputFiles()]
    held = [p for p in _STAGED[since:] if any(f"/{p.rsplit('/', 1)[-1]}/" in f for f in read)]
    dropped = 0
    for name in [p for p in _STAGED[since:] if p not in held]:
        path = spark._jvm.org.apache.hadoop.fs.Path(name)
        dropped += path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
    _STAGED[since:] = held
    return dropped
