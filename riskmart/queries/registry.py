"""Registry of queries and their SQL counterparts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from riskmart.adapters import ADAPTERS, TABLES, plain

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


class Inputs:
    """The given tables (``t.orders``) and the domain inputs derived from them (``t.stg_loan``)."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.dir = sf_dir.rstrip("/")

    def path(self, name: str) -> str:
        return f"{self.dir}/{name}.parquet"

    def __getattr__(self, name: str) -> DataFrame:
        if name in TABLES:
            return self.spark.read.parquet(self.path(name))
        if name in ADAPTERS:
            text = ADAPTERS[name]
            used = {n: getattr(self, n) for n in TABLES if "{" + n + "}" in text}
            return self.spark.sql(text, **used)
        raise AttributeError(name)


def ctes(body: str, *adapters: str, **more: str) -> str:
    """``body`` preceded by the adapters and by further named sub-selects, in the given order."""
    parts = [f"{a} AS ({plain(a)})" for a in adapters] + [f"{k} AS ({v})" for k, v in more.items()]
    return ("WITH " + ",\n".join(parts) + "\n" if parts else "") + body


def query(key: str, sql: str | None = None):
    """Register a function of :class:`Inputs` under ``key``."""

    def wrap(fn: Callable[[Inputs], DataFrame]):
        if key in QUERIES:
            raise KeyError(f"{key} registered twice")
        QUERIES[key] = lambda spark, sf_dir: fn(Inputs(spark, sf_dir))
        if sql is not None:
            ORACLE[key] = sql
        return fn

    return wrap
