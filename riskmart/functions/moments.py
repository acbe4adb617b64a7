"""Moments of all pairs of columns from one scan.

The state of a task is a set of square matrices over the columns: how many rows know both, sums, sums of squares and products over those rows,
and whether the two columns were equal so far. A batch of rows adds to it by matrix products. States of tasks are rows of one pair each, so they
are merged by a grouped sum that spreads over the pairs; a state's size depends on the number of columns only.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from itertools import combinations_with_replacement

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskmart.session import drop_staged, staged, staged_mark

#: Columns of one group; a task holds the matrices of two groups, some 30 MB. More columns take one scan for each pair of groups.
GROUP = 512
STATE = "i int, j int, n long, kx double, ky double, sx double, sy double, qx double, qy double, c double, odd boolean, same boolean"


class _PairState:
    """Matrices of one task between the columns ``left`` and ``right`` (indices into the table)."""

    def __init__(self, columns: int, left: np.ndarray, right: np.ndarray):
        self.left, self.right = left, right
        self.shift, self.shifted = np.zeros(columns), np.zeros(columns, dtype=bool)
        shape = (len(left), len(right))
        self.n, self.sx, self.sy, self.qx, self.qy, self.c = (np.zeros(shape) for _ in range(6))
        self.odd, self.same = np.zeros(shape, dtype=bool), np.ones(shape, dtype=bool)

    def add(self, values: np.ndarray, known: np.ndarray) -> None:
        """Rows of all columns: 0 where a value is not ``known``."""
        as_bytes = [values[:, at].tobytes() for at in range(values.shape[1])]
        label: dict[bytes, int] = {}
        labels = np.array([label.setdefault(b, len(label)) for b in as_bytes])
        self.same &= labels[self.left][:, None] == labels[self.right][None, :]
        finite = np.isfinite(values)
        plain = known & finite
        for at in np.flatnonzero(~self.shifted & plain.any(axis=0)):  # a value that occurs, so that a constant column has no deviations at all
            seen = np.sort(values[plain[:, at], at])
            self.shift[at], self.shifted[at] = seen[len(seen) // 2], True
        off = np.where(plain, np.where(finite, values, 0.0) - self.shift, 0.0)
        mask, square = known.astype(np.float64), off * off
        mx, my, x, y = mask[:, self.left], mask[:, self.right], off[:, self.left], off[:, self.right]
        self.n += mx.T @ my
        self.sx += x.T @ my
        self.sy += mx.T @ y
        self.qx += square[:, self.left].T @ my
        self.qy += mx.T @ square[:, self.right]
        self.c += x.T @ y
        if not finite.all():
            bad = (known & ~finite).astype(np.float64)
            self.odd |= (bad[:, self.left].T @ my + mx.T @ bad[:, self.right]) > 0

    def rows(self) -> pa.RecordBatch:
        a, b = np.nonzero(self.left[:, None] <= self.right[None, :])
        i, j = self.left[a], self.right[b]
        parts = [i.astype(np.int32), j.astype(np.int32), np.rint(self.n[a, b]).astype(np.int64), self.shift[i], self.shift[j],
                 *[m[a, b] for m in (self.sx, self.sy, self.qx, self.qy, self.c, self.odd, self.same)]]
        return pa.RecordBatch.from_arrays([pa.array(p) for p in parts], names=[f.split()[0] for f in STATE.split(", ")])


def _states(columns: int, left: range, right: range):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = None
        for batch in batches:
            if not batch.num_rows:
                continue
            state = state or _PairState(columns, np.array(left), np.array(right))
            known = np.column_stack([~np.asarray(c.is_null()) for c in batch.columns])
            values = np.column_stack([c.fill_null(0.0).to_numpy(zero_copy_only=False) for c in batch.columns]) + 0.0  # no negative zero
            values[np.isnan(values)] = np.nan  # one NaN
            state.add(values, known)
        if state is not None:
            yield state.rows()

    return run


def pair_moments(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(i, j, n, same, r) for each pair i < j of ``cols`` by their places.

    ``n`` counts the rows that know both, ``same`` says that all rows are equal with NULL as 0, and ``r`` is Pearson's correlation over the rows that know both: NULL where one does not
    vary there, NaN where a value is not finite. No row for an empty table.

    The table is scanned once (once per pair of groups of ``GROUP`` columns). The states of tasks are staged, since a second look at them
    gives each column a common shift, which keeps the sums exact enough far from zero.
    """
    spark = df.sparkSession
    groups = [range(at, min(at + GROUP, len(cols))) for at in range(0, len(cols), GROUP)]
    states = None
    for left, right in combinations_with_replacement(groups, 2):
        at = sorted({*left, *right})
        place = {c: k for k, c in enumerate(at)}
        numbers = df.select(*[F.col(f"`{cols[c]}`").cast("double").alias(f"c{c}") for c in at])
        local = numbers.mapInArrow(_states(len(at), range(place[left[0]], place[left[-1]] + 1), range(place[right[0]], place[right[-1]] + 1)), STATE)
        local = local.withColumns({"i": F.col("i") + (left[0] - place[left[0]]), "j": F.col("j") + (right[0] - place[right[0]])})
        states = local if states is None else states.unionByName(local)
    states = staged(states, "pair-states")
    # one number for each column: a value that some task shifted by
    common = states.where("i = j AND n > 0").groupBy("i").agg(F.percentile_approx("kx", 0.5).alias("k"))
    pairs = states.where("i < j").join(F.broadcast(common.select("i", F.col("k").alias("_kx"))), "i", "left").join(
        F.broadcast(common.select(F.col("i").alias("j"), F.col("k").alias("_ky"))), "j", "left")
    dx = F.when(F.col("n") > 0, F.col("kx") - F.col("_kx")).otherwise(0.0)
    dy = F.when(F.col("n") > 0, F.col("ky") - F.col("_ky")).otherwise(0.0)
    moved = pairs.withColumns({"dx": F.coalesce(dx, F.lit(0.0)), "dy": F.coalesce(dy, F.lit(0.0))})
    sums = moved.groupBy("i", "j").agg(
        F.sum("n").alias("n"), F.bool_and("same").alias("same"), F.bool_or("odd").alias("odd"),
        F.sum(F.expr("sx + n * dx")).alias("sx"), F.sum(F.expr("sy + n * dy")).alias("sy"),
        F.sum(F.expr("qx + 2 * dx * sx + n * dx * dx")).alias("qx"), F.sum(F.expr("qy + 2 * dy * sy + n * dy * dy")).alias("qy"),
        F.sum(F.expr("c + dy * sx + dx * sy + n * dx * dy")).alias("c"))
    vx, vy = F.expr("qx - try_divide(sx * sx, n)"), F.expr("qy - try_divide(sy * sy, n)")
    r = F.when(F.col("odd"), F.lit(float("nan"))).when((vx > 0) & (vy > 0), F.expr("c - try_divide(sx * sy, n)") / (F.sqrt(vx) * F.sqrt(vy)))
    return sums.select("i", "j", "n", "same", r.alias("r"))


def correlations(df: DataFrame, cols: Sequence[str]) -> dict[tuple[str, str], tuple[bool, float | None]]:
    """{(a, b): (same, r)} of each pair in the order of ``cols``; as many as the columns have pairs reach the driver, whatever the number of rows.

    An empty table gives (True, None) for each pair.
    """
    mark = staged_mark()
    found = {(row["i"], row["j"]): (row["same"], row["r"]) for row in pair_moments(df, cols).collect()}
    drop_staged(df.sparkSession, mark)
    return {(a, b): found.get((i, j), (True, None)) for i, a in enumerate(cols) for j, b in enumerate(cols) if i < j}


def is_beyond(r: float | None, threshold: float) -> bool:
    return r is not None and not math.isnan(r) and abs(r) > threshold
