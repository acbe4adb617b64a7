"""Run-log tables and the reports over them."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

LOG_SCHEMA = ("ProcedureName string, StepName string, Status string, RowsProcessed bigint, ExecutionTimeSeconds bigint, "
              "ExecutionDateTime timestamp, ErrorMessage string")


def etl_dashboard(log: DataFrame, top: int | None = None) -> DataFrame:
    """Mean and longest run time by procedure and status, ordered by name; the first ``top`` groups only if asked for."""
    out = (
        log.groupBy("ProcedureName", "Status")
        .agg(F.avg("ExecutionTimeSeconds").alias("AvgDurationSeconds"), F.max("ExecutionTimeSeconds").alias("MaxDurationSeconds"))
        .orderBy("ProcedureName", "Status")
    )
    return out if top is None else out.limit(top)


def purge_log(log: DataFrame, as_of, days: int = 30) -> tuple[DataFrame, DataFrame]:
    """(rows kept, one row with the number of rows dropped) for a retention of ``days`` before ``as_of``."""
    old = F.col("ExecutionDateTime") < F.lit(as_of).cast("timestamp") - F.make_dt_interval(F.lit(days))
    return log.filter(~F.coalesce(old, F.lit(False))), log.agg(F.count_if(old).alias("RowsDeleted"))


def step_timings(log: DataFrame, since) -> DataFrame:
    """Run times by procedure and step since a point in time, slowest first."""
    return (
        log.filter(F.col("ExecutionDateTime") >= F.lit(since).cast("timestamp"))
        .groupBy("ProcedureName", "StepName")
        .agg(
            F.avg("ExecutionTimeSeconds").alias("AvgSeconds"),
            F.max("ExecutionTimeSeconds").alias("MaxSeconds"),
            F.count("*").alias("Executions"),
        )
        .orderBy(F.desc("MaxSeconds"), "ProcedureName", "StepName")
    )


def table_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Row count of each table, ordered by name."""
    counts = [df.agg(F.count("*").alias("RowCount")).select(F.lit(n).alias("TableName"), "RowCount") for n, df in tables.items()]
    return reduce(DataFrame.unionByName, counts).orderBy("TableName")


def watched(df: DataFrame) -> tuple[DataFrame, Observation]:
    """``df`` with a row counter that is filled while its rows are written, without a job of its own."""
    seen = Observation()
    return df.observe(seen, F.count(F.lit(1)).alias("rows")), seen


def log_row(spark: SparkSession, procedure: str, step: str, status: str, rows: int | None, seconds: int, at,
            message: str | None = None) -> DataFrame:
    """One log entry."""
    return spark.range(1).select(
        F.lit(procedure).alias("ProcedureName"), F.lit(step).alias("StepName"), F.lit(status).alias("Status"),
        F.lit(rows).cast("bigint").alias("RowsProcessed"), F.lit(seconds).cast("bigint").alias("ExecutionTimeSeconds"),
        F.lit(at).cast("timestamp").alias("ExecutionDateTime"), F.lit(message).cast("string").alias("ErrorMessage"))


def append_run_log(log: DataFrame, procedure: str, step: str, status: str, rows: int | None, seconds: int, at) -> DataFrame:
    """Log with one more entry."""
    return log.unionByName(log_row(log.sparkSession, procedure, step, status, rows, seconds, at), allowMissingColumns=True)


def step_log(df: DataFrame, procedure: str, step: str, seconds: int, at) -> DataFrame:
    """Log entry whose row count is taken from the table itself."""
    return df.agg(F.count("*").alias("RowsProcessed")).select(
        F.lit(procedure).alias("ProcedureName"), F.lit(step).alias("StepName"), F.lit("Success").alias("Status"), "RowsProcessed",
        F.lit(seconds).cast("bigint").alias("ExecutionTimeSeconds"), F.lit(at).cast("timestamp").alias("ExecutionDateTime"))
