"""Small column expressions used by several families."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

DATE_KEY = "yyyyMMdd"

# Tokens accepted as true / false in text input.
TRUE_TOKENS = ("1", "true", "yes", "y", "t", "on")
FALSE_TOKENS = ("0", "false", "no", "n", "f", "off")


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def band(value: str | Column, steps: Sequence[tuple[float, float]], default: float) -> Column:
    """Step function: the first ``(threshold, result)`` with ``value > threshold`` wins. NULL falls to ``default``."""
    v = col(value)
    out = F.lit(default)
    for threshold, result in reversed(steps):
        out = F.when(v > F.lit(threshold), F.lit(result)).otherwise(out)
    return out


def floor_band(value: str | Column, steps: Sequence[tuple[float, float]], default: float) -> Column:
    """Like :func:`band` with ``>=``."""
    v = col(value)
    out = F.lit(default)
    for threshold, result in reversed(steps):
        out = F.when(v >= F.lit(threshold), F.lit(result)).otherwise(out)
    return out


def date_id(c: str | Column) -> Column:
    """yyyymmdd integer of a date or timestamp."""
    d = col(c)
    return (F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)).cast("int")


def month_gap(start: str | Column, end: str | Column) -> Column:
    """Number of month boundaries between two dates (day of month does not matter)."""
    s, e = col(start), col(end)
    return (F.year(e) * 12 + F.month(e) - F.year(s) * 12 - F.month(s)).cast("int")


def us_week(d: str | Column) -> Column:
    """Week of year where week 1 holds 1 January and weeks start on Sunday."""
    c = col(d)
    first_dow = F.dayofweek(F.trunc(c, "year"))
    return (F.floor((F.dayofyear(c) + first_dow - 2) / 7) + 1).cast("int")


def all_of(conds: Iterable[Column]) -> Column:
    return reduce(lambda a, b: a & b, conds, F.lit(True))


def any_of(conds: Iterable[Column]) -> Column:
    return reduce(lambda a, b: a | b, conds, F.lit(False))


def same_key(left: str, right: str, keys: Sequence[str], null_safe: bool = False) -> Column:
    pairs = [(F.col(f"{left}.{k}"), F.col(f"{right}.{k}")) for k in keys]
    return all_of(a.eqNullSafe(b) if null_safe else a == b for a, b in pairs)


def clamp(value: Column, low=None, high=None) -> Column:
    """NULL-preserving clamp (``greatest``/``least`` skip NULL, so guard)."""
    out = value
    if low is not None:
        out = F.greatest(out, col(low) if isinstance(low, (str, Column)) else F.lit(low))
    if high is not None:
        out = F.least(out, col(high) if isinstance(high, (str, Column)) else F.lit(high))
    return F.when(value.isNotNull(), out)


def round_even(value: str | Column, scale: int = 0) -> Column:
    """Round a double half to even on its binary value: scale up, round to the nearest whole, scale down."""
    return F.rint(col(value) * float(10**scale)) / float(10**scale)


def pearson(a: str | Column, b: str | Column) -> Column:
    """Correlation over the rows where both are present; NULL when one of them does not vary (``corr`` fails there)."""
    x, y = col(a).cast("double"), col(b).cast("double")
    both = x.isNotNull() & y.isNotNull()
    x, y = F.when(both, x), F.when(both, y)
    return F.try_divide(F.covar_pop(x, y), F.stddev_pop(x) * F.stddev_pop(y))


def is_blank(c: str | Column) -> Column:
    v = col(c)
    return v.isNull() | (F.trim(v) == "")


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def string_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]


def has_token(name: str, tokens: Iterable[str]) -> bool:
    low = name.lower()
    return any(t in low for t in tokens)


def null_apart(col: str) -> Column:
    """A join key as text in which every NULL is a text of its own.

    It matches nothing, as NULL would, but many NULLs do not meet in one task. Project it before the join; the other side is ``cast('string')``.
    """
    return F.coalesce(F.col(col).cast("string"), F.concat(F.lit("\0"), F.monotonically_increasing_id().cast("string")))


def attach_stats(df: DataFrame, stats: DataFrame) -> DataFrame:
    """Add the columns of a one-row table of global aggregates to every row.

    ``stats`` comes from a ``df.agg(...)`` without keys, so it is exactly one row whatever the input size.
    """
    return df.crossJoin(F.broadcast(stats))


def large(df: DataFrame) -> DataFrame:
    """A side that grows with the data, never broadcast.

    Before a join has run, Spark takes the size of the compressed files, by columns, for that of the rows: keys of 5.4 million customers
    count as 10 MB, within its limit, and take 169 MB in a broadcast, several times that while the driver builds it.
    """
    return df.hint("merge")
