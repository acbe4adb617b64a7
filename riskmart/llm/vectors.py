"""Exact top-k search by integer inner product over vectors, pruned by segment statistics at several resolutions.

A vector cut into segments is described by the mean and the deviation of each. For one segment of width w, the squared distance of two vectors is at
least ``w * ((mean - mean')^2 + (dev - dev')^2)``; summed over the segments, the distance has a lower bound, and so the inner product
``(|q|^2 + |v|^2 - distance^2) / 2`` has an upper one. Every candidate meets the bounds with 1, 4 and 16 segments in turn, each tighter than the last, and
only pairs that may still reach a query's k-th best score so far get their exact score.

Queries go round in packs of bounded size: a pack is broadcast, every task reads its share of the candidates once and keeps the k best per query,
and what the tasks found is ranked by query. A first round over one candidate in ``PRIME`` gives k-th best scores to begin with. Candidates are never
shuffled by query and never paired up; a group of equal vectors costs its rows.

Defined cases: vectors that are NULL or hold a NULL or non-finite component, and rows with a NULL id, take no part; of vectors of different
length the common components count (no components: score 0); an id that asks with several vectors asks with the least; every candidate
row counts, so a repeated one is listed repeatedly; scores beyond a long are cut to its range; further columns are ignored; empty tables give no rows.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from riskmart.llm.topk import kth_scores, merged
from riskmart.session import stage_path, staged

SCALE, LEVELS = 256.0, (1, 4, 16)
#: The most queries, and the most components of queries (of one query more, if it alone has more), in one broadcast.
PACK_QUERIES, PACK_CELLS = 2048, 1 << 20
CHUNK, PART_ROWS, PRIME = 1024, 8192, 16
#: Below this share of pairs alive, pairs are taken one by one instead of whole matrices.
SPARSE = 0.05
#: Share of the norms' product by which a bound may be off through rounding.
SLACK = 1e-9
LONG = np.iinfo(np.int64)
FOUND = "query_id long, vec_id long, score long"


def usable(vectors: DataFrame, vec_id: str, embedding: str) -> DataFrame:
    """(vec_id, v): the rows that take part."""
    rows = vectors.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(embedding).cast("array<double>").alias("v"))
    finite = F.forall("v", lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))), F.lit(False)))
    return rows.where(F.col("vec_id").isNotNull() & F.col("v").isNotNull() & finite)


def matrix(v: pa.ListArray, width: int) -> np.ndarray:
    """floor(256 * x) of the first ``width`` components, zeros beyond a vector's end."""
    ends = v.offsets.to_numpy()
    sizes, flat = np.diff(ends), v.values.to_numpy(zero_copy_only=False)
    out = np.zeros((len(sizes), width))
    if len(sizes) and (sizes == width).all():
        out[:] = flat[ends[0]:ends[-1]].reshape(-1, width)
    else:
        for i, (a, n) in enumerate(zip(ends, np.minimum(sizes, width))):
            out[i, :n] = flat[a:a + n]
    return np.floor(SCALE * out)


class Described:
    """Vectors with their segment statistics; ``at(level)`` times that of another is a bound of the inner products."""

    def __init__(self, rows: np.ndarray):
        fine = LEVELS[-1]
        self.rows = rows
        padded = np.pad(rows, ((0, 0), (0, -rows.shape[1] % fine))) if rows.shape[1] else np.zeros((len(rows), fine))
        self.levels = [self._stats(padded.reshape(len(rows), n, -1)) for n in LEVELS]
        self.norm = np.sqrt((rows * rows).sum(1))
        self.most = float(np.abs(rows).max(initial=0.0))

    @staticmethod
    def _stats(cut: np.ndarray) -> np.ndarray:
        """Root of the width times the mean and times the deviation, side by side."""
        width = cut.shape[2]
        mean = cut.sum(2) / np.sqrt(width)
        return np.concatenate([mean, np.sqrt(np.maximum((cut * cut).sum(2) - mean * mean, 0))], axis=1)


def exact(q: np.ndarray, v: np.ndarray, safe: bool) -> np.ndarray:
    """Inner products of paired rows as integers; doubles are exact as long as no sum reaches 2^53."""
    if safe:
        return np.einsum("ij,ij->i", q, v).astype(np.int64)
    sums = [sum(int(a) * int(b) for a, b in zip(x, y)) for x, y in zip(q, v)]
    return np.array([min(max(s, LONG.min), LONG.max) for s in sums], dtype=np.int64)


def best_of(queries: Described, ids: np.ndarray, least: np.ndarray, k: int, chunks: Iterable[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query row, score, vec_id) of the k best candidates of each query that score at least ``least``; chunks are (vec_ids, vectors)."""
    have = tuple(np.zeros(0, np.int64) for _ in range(3))
    for vec_id, rows in chunks:
        with np.errstate(all="ignore"):  # vast components give infinite bounds, which prune nothing
            cands = Described(rows)
            safe = queries.most * cands.most * max(1, rows.shape[1]) < 2.0 ** 53
            slack = SLACK * queries.norm
            alive, pairs = ids[:, None] != vec_id[None, :], None
            for a, b in zip(queries.levels, cands.levels):
                if pairs is None:
                    alive &= ~(a @ b.T + slack[:, None] * cands.norm[None, :] < least[:, None])
                    if np.count_nonzero(alive) < SPARSE * alive.size:
                        pairs = np.nonzero(alive)
                else:
                    i, j = pairs
                    keep = ~(np.einsum("ij,ij->i", a[i], b[j]) + slack[i] * cands.norm[j] < least[i])
                    pairs = i[keep], j[keep]
        if pairs is None and safe:
            score = queries.rows @ rows.T
            alive &= score >= least[:, None]
            i, j = np.nonzero(alive)
            score = score[i, j].astype(np.int64)
        else:
            i, j = np.nonzero(alive) if pairs is None else pairs
            score = exact(queries.rows[i], rows[j], safe)
        reach = score >= least[i]
        have = merged(have, (i[reach], score[reach], vec_id[j][reach]), k)
        least = kth_scores(have[0], have[1], least, k)
    return have


def _found(candidates: DataFrame, pack: dict, k: int) -> DataFrame:
    """(query_id, vec_id, score): per task, the k best candidates of every query of a pack."""
    shared = candidates.sparkSession.sparkContext.broadcast(pack)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        queries = Described(own["rows"])

        def chunks():
            for batch in batches:
                for i in range(0, batch.num_rows, CHUNK):
                    part = batch.slice(i, CHUNK)
                    yield part.column("vec_id").to_numpy(), matrix(part.column("v"), own["rows"].shape[1])

        query, score, vec = best_of(queries, own["ids"], own["least"], k, chunks())
        yield pa.RecordBatch.from_arrays([pa.array(own["ids"][query]), pa.array(vec), pa.array(score)], ["query_id", "vec_id", "score"])

    return candidates.select("vec_id", "v").mapInArrow(run, FOUND)


def _ranked(found: DataFrame, k: int) -> DataFrame:
    """The k best of what the tasks found: at most k rows per query and task meet here."""
    place = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", place).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def top_k(vectors: DataFrame, k: int = 5, every: int = 50, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score) for the rows whose id is divisible by ``every`` against all other ids."""
    spark = vectors.sparkSession
    rows = usable(vectors, vec_id, embedding)
    size = rows.agg(F.count("*").alias("n")).first()["n"]
    candidates = staged(rows.repartition(max(1, -(-size // PART_ROWS))), "vectors")
    asked = staged(candidates.where(F.col("vec_id") % every == 0).groupBy("vec_id").agg(F.min("v").alias("v")), "vector-queries")
    n = asked.agg(F.count("*").alias("n"), F.coalesce(F.sum(F.size("v")), F.lit(0)).alias("cells")).first()
    packs = max(1, -(-n["n"] // PACK_QUERIES), -(-n["cells"] // PACK_CELLS))
    path = stage_path(spark, "nearest")
    spark.createDataFrame([], "query_id long, rank int, vec_id long, score long").write.parquet(path)
    for at in range(packs):
        own = asked.where(F.pmod(F.xxhash64("vec_id"), F.lit(packs)) == at).toArrow().combine_chunks()
        if not own.num_rows:
            continue
        v = own.column("v").chunk(0)
        ids = own.column("vec_id").to_numpy()
        pack = {"ids": ids, "rows": matrix(v, int(np.diff(v.offsets.to_numpy()).max(initial=0))), "least": np.full(len(ids), -np.inf)}
        primed = _ranked(_found(candidates.where(F.pmod(F.xxhash64("vec_id", F.lit(1)), F.lit(PRIME)) == 0), pack, k), k).where(F.col("rank") == k).toArrow()
        place = {int(q): i for i, q in enumerate(ids)}
        for q, score in zip(primed.column("query_id").to_pylist(), primed.column("score").to_pylist()):
            pack["least"][place[q]] = score
        _ranked(_found(candidates, pack, k), k).write.mode("append").parquet(path)
    return spark.read.schema("query_id long, rank int, vec_id long, score long").parquet(path)
