"""Global statistics of columns, computed without ever holding a column in one task."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterable, Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskmart.functions.expr import any_of

BINS = 2048


def order_statistics(df: DataFrame, ranks: Mapping[str, Callable[[int], Iterable[int]]]) -> tuple[dict[str, int], dict[tuple[str, int], float]]:
    """(number of values per column, value at each wanted rank). ``ranks`` maps a column to ``n -> zero-based ranks``.

    The built-in exact ``percentile`` keeps every distinct value of a column in one task. Here each pass counts values
    in equal bins of the interval known to hold the wanted rank and zooms into one bin, until the bin holds a single
    value. A pass is one map-side combined aggregate over the narrow columns and brings back at most ``BINS`` counts
    per open rank; a few passes suffice because every pass shrinks the interval about two-thousand-fold.
    """
    cols = list(ranks)
    if not cols:
        return {}, {}
    values = df.select(*[_number(c) for c in cols])
    first = values.agg(*[f(c).alias(f"{n}{i}") for i, c in enumerate(cols) for n, f in (("n", F.count), ("a", F.min), ("b", F.max))]).first()
    sizes = {c: first[f"n{i}"] for i, c in enumerate(cols)}
    known: dict[tuple[str, int], float] = {}
    open_: dict[tuple[str, int], tuple[float, float, int]] = {}
    for i, c in enumerate(cols):
        for rank in set(ranks[c](sizes[c])) if sizes[c] else ():
            _place(known, open_, (c, rank), first[f"a{i}"], first[f"b{i}"], 0)
    while open_:
        spans = sorted({(c, lo, hi) for (c, _), (lo, hi, _) in open_.items()})
        cells = []
        for i, (c, lo, hi) in enumerate(spans):
            v = F.col(c)
            # halves, because hi - lo may overflow
            share = (v / 2 - F.lit(lo / 2)) / F.lit(hi / 2 - lo / 2)
            slot = F.least(F.floor(share * BINS), F.lit(BINS - 1)).cast("int")
            cells.append(F.when((v >= F.lit(lo)) & (v <= F.lit(hi)), F.struct(F.lit(i).alias("s"), slot.alias("b"), v.alias("v"))))
        # Rows outside every open interval are dropped before they are fanned out.
        inside = any_of((F.col(c) >= F.lit(lo)) & (F.col(c) <= F.lit(hi)) for c, lo, hi in spans)
        counted = (
            values.filter(inside).select(F.explode(F.array(*cells)).alias("c")).filter(F.col("c").isNotNull())
            .groupBy("c.s", "c.b")
            .agg(F.count("*").alias("n"), F.min("c.v").alias("lo"), F.max("c.v").alias("hi"))
            .collect()
        )
        by_span: dict[int, list] = {}
        for r in sorted(counted, key=lambda r: (r["s"], r["b"])):
            by_span.setdefault(r["s"], []).append(r)
        index = {span: i for i, span in enumerate(spans)}
        todo, open_ = open_, {}
        for (c, rank), (lo, hi, below) in todo.items():
            for r in by_span[index[(c, lo, hi)]]:
                if rank < below + r["n"]:
                    _place(known, open_, (c, rank), r["lo"], r["hi"], below)
                    break
                below += r["n"]
    return sizes, known


def quantiles(df: DataFrame, cols: Sequence[str], probs: Sequence[float]) -> dict[str, dict[float, float | None]]:
    """Exact linearly interpolated quantiles of numeric columns (None for a column without values)."""

    def wanted(n: int) -> set[int]:
        return {f((n - 1) * p) for p in probs for f in (math.floor, math.ceil)}

    sizes, known = order_statistics(df, {c: wanted for c in cols})
    out: dict[str, dict[float, float | None]] = {}
    for c in cols:
        n, out[c] = sizes[c], {}
        for p in probs:
            if n == 0:
                out[c][p] = None
                continue
            h = (n - 1) * p
            a, b = known[(c, math.floor(h))], known[(c, math.ceil(h))]
            out[c][p] = a + (b - a) * (h - math.floor(h))
    return out


def _number(c: str):
    v = F.col(c).cast("double")
    return F.when(~F.isnan(v) & (F.abs(v) < F.lit(float("inf"))), v).alias(c)


def _place(known, open_, key, lo, hi, below) -> None:
    if lo == hi:
        known[key] = lo
    else:
        open_[key] = (lo, hi, below)


def value_counts(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(column_name, value as text, n) of several columns in one shuffle; NULL is left out."""
    cells = [F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value")) for c in cols]
    long = df.select(F.explode(F.array(*cells)).alias("c")).select("c.*").filter(F.col("value").isNotNull())
    return long.groupBy("column_name", "value").agg(F.count("*").alias("n"))


def modes(df: DataFrame, cols: Sequence[str]) -> dict[str, str | None]:
    """Most frequent value of each text column, the lowest one on ties."""
    if not cols:
        return {}
    best = value_counts(df, cols).groupBy("column_name").agg(F.min(F.struct(-F.col("n"), "value")).alias("b"))
    found = {r["column_name"]: r["b"]["value"] for r in best.select("column_name", "b").collect()}
    return {c: found.get(c) for c in cols}


def null_rates(df: DataFrame, cols: Sequence[str] | None = None) -> dict[str, float]:
    """Share of NULL per column (0 for an empty table)."""
    cols = list(cols if cols is not None else df.columns)
    row = df.agg(F.count("*").alias("_n"), *[F.count_if(F.col(c).isNull()).alias(f"c{i}") for i, c in enumerate(cols)]).first()
    return {c: (row[f"c{i}"] / row["_n"] if row["_n"] else 0.0) for i, c in enumerate(cols)}


def distinct_counts(df: DataFrame, cols: Sequence[str]) -> dict[str, int]:
    """Exact number of distinct values per column; grouped by value first, so no task holds a column."""
    if not cols:
        return {}
    rows = value_counts(df, cols).groupBy("column_name").agg(F.count("*").alias("d")).collect()
    found = {r["column_name"]: r["d"] for r in rows}
    return {c: found.get(c, 0) for c in cols}


def small_domains(df: DataFrame, cols: Sequence[str], limit: int) -> dict[str, list[str]]:
    """Distinct values (sorted) of those columns that have at most ``limit`` of them.

    A first pass drops columns whose approximate count is far above the limit, so no wide value set is counted exactly
    and at most ``limit`` values per column reach the driver.
    """
    if not cols:
        return {}
    row = df.agg(*[F.approx_count_distinct(c).alias(f"c{i}") for i, c in enumerate(cols)]).first()
    near = [c for i, c in enumerate(cols) if row[f"c{i}"] <= 2 * limit + 10]
    if not near:
        return {}
    counts = value_counts(df, near)
    few = counts.groupBy("column_name").agg(F.count("*").alias("d")).filter(F.col("d") <= limit)
    out: dict[str, list[str]] = {}
    for r in counts.join(few, "column_name").select("column_name", "value").collect():
        out.setdefault(r["column_name"], []).append(r["value"])
    return {c: sorted(out[c]) for c in near if c in out}
