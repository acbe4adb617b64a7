"""The k best answers of many queries at once, as flat arrays sorted by query, best first."""

from __future__ import annotations

import numpy as np


def merged(have: tuple[np.ndarray, ...], more: tuple[np.ndarray, ...], k: int) -> tuple[np.ndarray, ...]:
    """The k best per query of both; columns are query, score and whatever decides ties (least first)."""
    both = [np.concatenate([a, b]) for a, b in zip(have, more)]
    order = np.lexsort((*both[:1:-1], ~both[1], both[0]))  # ~score falls as the score rises, without overflow
    both = [x[order] for x in both]
    keep = np.arange(len(order)) - np.searchsorted(both[0], both[0]) < k
    return tuple(x[keep] for x in both)


def kth_scores(query: np.ndarray, score: np.ndarray, least: np.ndarray, k: int) -> np.ndarray:
    """``least`` by query, raised to the k-th score of each query that has k."""
    first = np.flatnonzero(np.r_[True, query[1:] != query[:-1]]) if len(query) else np.zeros(0, int)
    full = first[np.diff(np.r_[first, len(query)]) >= k]
    out = least.copy()
    out[query[full]] = np.maximum(out[query[full]], score[full + k - 1].astype(float))
    return out
