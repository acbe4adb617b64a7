"""Deterministic random numbers: pure functions of row key, column name and seed, the same under any partitioning."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

HEX = 13  # hexadecimal digits of the digest, 52 bits


def digest(key: Sequence[str], name: str, seed: int, draw: int = 0) -> Column:
    return F.md5(F.concat_ws("|", *[F.coalesce(F.col(k).cast("string"), F.lit("")) for k in key], F.lit(f"{name}|{seed}|{draw}")))


def uniform(key: Sequence[str], name: str, seed: int, draw: int = 0) -> Column:
    """Number strictly between 0 and 1."""
    whole = F.conv(F.substring(digest(key, name, seed, draw), 1, HEX), 16, 10).cast("bigint")
    return (whole + F.lit(0.5)) / F.lit(float(16**HEX))


def normal(key: Sequence[str], name: str, seed: int) -> Column:
    """Standard normal number."""
    u, v = uniform(key, name, seed, 1), uniform(key, name, seed, 2)
    return F.sqrt(-2 * F.log(u)) * F.cos(F.lit(2 * math.pi) * v)


def beta_2_5(key: Sequence[str], name: str, seed: int) -> Column:
    """Beta(2, 5): the second smallest of six uniform numbers."""
    return F.sort_array(F.array(*[uniform(key, name, seed, d) for d in range(1, 7)]))[1]


def choice(key: Sequence[str], name: str, seed: int, values: Sequence, draw: int = 0) -> Column:
    """One of the values, all equally likely."""
    if len(values) == 1:
        return F.lit(values[0])
    return F.get(F.array(*[F.lit(v) for v in values]), F.floor(uniform(key, name, seed, draw) * len(values)).cast("int"))


def between(key: Sequence[str], name: str, seed: int, low: int, high: int, draw: int = 0) -> Column:
    """Whole number from ``low`` to ``high - 1``."""
    return (F.floor(uniform(key, name, seed, draw) * (high - low)) + low).cast("bigint")
