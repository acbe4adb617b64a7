"""Quality classifier: histogram gradient-boosted trees over document statistics.

Trees are grown on binned statistics of a bounded labelled sample (second-order gains, logistic loss) and flattened into arrays; scoring
walks all trees of a batch at once in numpy, level by level.

Defined cases: NULL and empty texts have all-zero statistics and get the score of those; without usable labels every score is
the prior 0.5; repeated rows score alike. Only the text reaches the model.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskmart.llm.common import fold
from riskmart.llm.textstats import FIELDS, counts_of, labelled_sample

NAMES = ("log_words", "mean_word", "symbol_share", "dup_line_share", "repeat_share", "words_per_line", "upper_share", "digit_share",
         "punct_share", "variety", "top_share", "same_next_share", "stops_per_word", "shout_share", "long_share")


def features(texts) -> np.ndarray:
    """One row of size-free statistics per text."""
    c = np.array([counts_of(t) for t in texts], dtype=float).reshape(-1, len(FIELDS))
    at = {k: c[:, i] for i, k in enumerate(FIELDS)}
    over = lambda a, b: at[a] / np.maximum(at[b], 1)
    return np.column_stack([
        np.log1p(at["n_words"]), over("word_chars", "n_words"), over("n_symbols", "n_chars"), over("n_dup_lines", "n_lines"),
        over("n_repeat_words", "n_words"), over("n_words", "n_lines"), over("n_upper", "n_chars"), over("n_digits", "n_chars"),
        over("n_punct", "n_chars"), np.log1p(at["n_distinct"]) / np.maximum(np.log1p(at["n_words"]), 1e-9), over("n_top", "n_words"), over("n_same_next", "n_words"),
        over("n_stops", "n_words"), over("n_shout", "n_words"), over("n_long", "n_words")])


@dataclass
class Forest:
    """Trees as arrays of shape (trees, nodes): children of node i are 2i+1 and 2i+2; a leaf sends rows left for ever (threshold inf)."""

    prior: float
    feature: np.ndarray
    threshold: np.ndarray
    value: np.ndarray
    depth: int

    def raw(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.prior)
        rows = np.arange(len(x))
        for f, t, v in zip(self.feature, self.threshold, self.value):
            at = np.zeros(len(x), dtype=np.int64)
            for _ in range(self.depth):
                at = 2 * at + 1 + (x[rows, f[at]] > t[at])
            out += v[at]
        return out

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1.0 / (1.0 + np.exp(-self.raw(x)))


def grow(x: np.ndarray, y: np.ndarray, trees: int = 80, depth: int = 4, rate: float = 0.1, bins: int = 64, l2: float = 1.0,
         least: float = 2.0) -> Forest:
    """Boosts ``trees`` complete trees of ``depth`` levels; the histograms of a level come from one ``bincount`` per statistic."""
    n, m = x.shape
    nodes = 2 ** (depth + 1) - 1
    shape = (trees, nodes)
    forest = Forest(0.0, np.zeros(shape, np.int64), np.full(shape, np.inf), np.zeros(shape), depth)
    if n == 0:
        return forest
    rate_1 = min(max(y.mean(), 1e-3), 1 - 1e-3)
    forest.prior = float(np.log(rate_1 / (1 - rate_1)))
    cuts = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[1:-1])) for j in range(m)]
    codes = [np.searchsorted(cuts[j], x[:, j], side="left") for j in range(m)]
    raw = np.full(n, forest.prior)
    for k in range(trees):
        p = 1 / (1 + np.exp(-raw))
        g, h = p - y, np.maximum(p * (1 - p), 1e-9)
        at = np.zeros(n, np.int64)  # position inside the level
        for level in range(depth):
            width, first = 2**level, 2**level - 1
            best = np.full(width, 1e-6)
            split_f, split_b = np.zeros(width, np.int64), np.full(width, -1)
            for j in range(m):
                nb = len(cuts[j]) + 1
                if nb == 1:
                    continue
                cell = at * nb + codes[j]
                gs = np.bincount(cell, g, width * nb).reshape(width, nb).cumsum(1)
                hs = np.bincount(cell, h, width * nb).reshape(width, nb).cumsum(1)
                G, H = gs[:, -1:], hs[:, -1:]
                gl, hl = gs[:, :-1], hs[:, :-1]
                gain = gl**2 / (hl + l2) + (G - gl) ** 2 / (H - hl + l2) - G**2 / (H + l2)
                gain[(hl < least) | (H - hl < least)] = -1
                b = gain.argmax(1)
                top = gain[np.arange(width), b]
                better = top > best
                best[better], split_f[better], split_b[better] = top[better], j, b[better]
            for w in np.flatnonzero(split_b >= 0):
                forest.feature[k, first + w] = split_f[w]
                forest.threshold[k, first + w] = cuts[split_f[w]][split_b[w]]
            f, t = forest.feature[k, first + at], forest.threshold[k, first + at]
            at = 2 * at + (x[np.arange(n), f] > t)
        first = 2**depth - 1
        leaf = -rate * np.bincount(at, g, 2**depth) / (np.bincount(at, h, 2**depth) + l2)
        forest.value[k, first:] = leaf
        raw += leaf[at]
    return forest


def fit(documents: DataFrame, labels: DataFrame, where: Column | None = None, sample: int = 20_000, **how) -> Forest:
    """Trees from at most about ``sample`` labelled documents (a documented bound), chosen by a hash of their ids."""
    rows = labelled_sample(documents, labels, "quality", sample, where)

    def count(batches):
        for pdf in batches:
            yield pd.DataFrame({"doc_id": pdf["doc_id"], "y": pdf["_label"], "x": list(features(pdf["text"]))})

    got = rows.mapInPandas(count, f"doc_id {dict(rows.dtypes)['doc_id']}, y int, x array<double>").toPandas()
    got = got.assign(key=got["x"].map(tuple)).sort_values(["doc_id", "key"])
    x = np.array(got["x"].tolist(), float).reshape(len(got), len(NAMES))
    return grow(x, got["y"].to_numpy(float), **how)


def score_column(forest: Forest, text: Column) -> Column:
    shared = forest

    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        return pd.Series(shared.score(features(texts)))

    return score(text)


def quality_scores(documents: DataFrame, labels: DataFrame, modulus: int = 5, held: int = 0, at_least: float = 0.3) -> DataFrame:
    """Per document: doc_id, held_out, score (0 to 1, higher: better) and predicted. Held-out labels teach nothing."""
    forest = fit(documents, labels, fold("doc_id", modulus) != held)
    scored = documents.select("doc_id", (fold("doc_id", modulus) == held).alias("held_out"), score_column(forest, F.col("text")).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= at_least).cast("int"))
