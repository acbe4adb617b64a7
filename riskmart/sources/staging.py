"""Text columns to staged types."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskmart.functions.expr import FALSE_TOKENS, TRUE_TOKENS

# Date spellings tried in this order.
DATE_FORMATS = (
    "yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd H:mm", "yyyy-MM-dd", "M/d/yyyy H:mm", "M/d/yyyy", "yyyy/M/d", "dd-MMM-yyyy",
)


def parse_timestamp(text: Column, formats: Sequence[str] = DATE_FORMATS) -> Column:
    """First format that fits, NULL if none does."""
    return F.coalesce(text.try_cast("timestamp"), *[F.try_to_timestamp(text, F.lit(f)) for f in formats])


def bit(text: Column) -> Column:
    token = F.lower(F.trim(text))
    return F.when(token.isin(*TRUE_TOKENS), 1).when(token.isin(*FALSE_TOKENS), 0)


def coerce_text(text: Column, to: T.DataType) -> Column:
    """One text value to a type; blank and unreadable values become NULL. Boolean targets read bit tokens as 0/1."""
    value = F.nullif(F.trim(text), F.lit(""))
    if isinstance(to, T.StringType):
        return F.nullif(text, F.lit(""))
    if isinstance(to, T.BooleanType):
        return bit(value)
    if isinstance(to, T.DateType):
        return F.to_date(parse_timestamp(value))
    if isinstance(to, T.TimestampType):
        return parse_timestamp(value)
    if isinstance(to, T.IntegralType):
        return F.coalesce(value.try_cast(to), F.bround(value.try_cast("decimal(38,6)"), 0).try_cast(to))
    return value.try_cast(to)


def _shared(df: DataFrame, schema: T.StructType) -> list[T.StructField]:
    return [f for f in schema.fields if f.name in df.columns]


def coerce_staging(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Typed columns of the schema that the text table has; other columns are dropped."""
    return df.select(*[coerce_text(F.col(f.name), f.dataType).alias(f.name) for f in _shared(df, schema)])


def staging_rejects(df: DataFrame, schema: T.StructType, keys: Sequence[str]) -> DataFrame:
    """One row per value that was present but could not be read: keys, column name, raw text."""
    cells = []
    for f in _shared(df, schema):
        raw = F.col(f.name)
        lost = (F.trim(raw) != "") & coerce_text(raw, f.dataType).isNull()
        cells.append(F.when(lost, F.struct(F.lit(f.name).alias("column_name"), raw.alias("raw_value"))))
    return df.select(*keys, F.explode(F.array_compact(F.array(*cells))).alias("_c")).select(*keys, "_c.*")


def column_gaps(df: DataFrame, schema: T.StructType) -> dict[str, list[str]]:
    """Columns unknown to the schema (ignored) and required columns the table lacks (to be generated)."""
    return {
        "unknown": [c for c in df.columns if c not in schema.fieldNames()],
        "missing": [f.name for f in schema.fields if not f.nullable and f.name not in df.columns],
    }
