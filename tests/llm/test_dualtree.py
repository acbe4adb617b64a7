"""Dual-tree search against scores of all pairs in plain integers."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from riskmart.llm import dualtree

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def slow(docs, items, k=20):
    bags = [(d, Counter(terms(t))) for d, t in docs]
    N, L = sum(bool(b) for _, b in bags), sum(sum(b.values()) for _, b in bags)
    df = Counter(t for _, b in bags for t in b)
    texts, out = {}, []
    for i, t in items:
        if i is not None:
            texts[i] = min(texts.get(i, t or ""), t or "")
    for i, text in texts.items():
        found = []
        for d, b in bags:
            n = sum(b.values())
            m = 75 + (25 * n * N) // L if L else 0
            s = sum(math.floor(1000 * math.log((2 * N + 2) / (2 * df[t] + 1))) * ((10 ** 9 * b[t]) // (1000 * b[t] + 12 * m)) for t in terms(text) if b[t])
            if s > 0:
                found.append((-s, d is None, d or 0))
        out += [(i, r, None if none else d, -s) for r, (s, none, d) in enumerate(sorted(found)[:k], 1)]
    return sorted(out, key=str)


def made(seed=2):
    rng = random.Random(seed)
    words = [f"w{int(rng.paretovariate(0.6)) % 400}" for _ in range(4000)]
    text = lambda n: " ".join(rng.choice(words).upper() if rng.random() < 0.1 else rng.choice(words) for _ in range(n))
    docs = [(i, text(rng.choice((3, 20, 60, 200)))) for i in range(500)]
    docs += [(1000 + i, "the same text of w1 w2 w3 w4") for i in range(60)] + [(2000, text(30_000)), (2001, None), (2002, ""), (2003, "--- !"), (None, "w5 w6 Äpfel"), (None, "w5 w6 Äpfel"), (7, "äpfel w5")]
    items = [(i, text(rng.choice((1, 5, 30)))) for i in range(40)] + [(100, "w1 w1 w1 w2"), (101, None), (102, "..."), (103, "nowhere"), (None, "w1"), (104, "w9 w8"), (104, "w1 w2 w3"), (105, "Äpfel äpfel w5"), (106, "the same text")]
    rng.shuffle(docs)
    return docs, items


@pytest.mark.parametrize("sizes", [{}, {"DOC_NODES": (24, 6, 2, 1), "ITEM_NODES": (8, 4, 2, 1), "PACK_ITEMS": 16, "WAVE_BYTES": 700, "PRIME": 2}])
def test_all_pairs(spark, sizes, monkeypatch):
    for name, value in sizes.items():
        monkeypatch.setattr(dualtree, name, value)
    docs, items = made()
    left = spark.createDataFrame([(*d, 1, 2, 3) for d in docs], "doc_id long, text string, score int, n int, item_id int").repartition(4)
    right = spark.createDataFrame([(*i, 1, 2) for i in items], "item_id long, text string, doc_id int, size int")
    assert sorted((tuple(r) for r in dualtree.search(left, right).collect()), key=str) == slow(docs, items)


def test_items_named_by_text_and_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, "b")], "doc_id long, text string")
    items = spark.createDataFrame([("x", "a"), ("y", "zz")], "item_id string, text string")
    assert [(r["item_id"], r["rank"], r["doc_id"]) for r in dualtree.search(docs, items).collect()] == [("x", 1, 1)]
    assert dualtree.search(docs.limit(0), items).collect() == [] and dualtree.search(docs, items.limit(0)).collect() == []


def test_bounds_of_nodes():
    rng = np.random.default_rng(0)
    docs, items = rng.integers(0, 9, (1500, 30)) * (rng.random((1500, 30)) < 0.2), rng.integers(0, 9, (70, 30)) * (rng.random((70, 30)) < 0.1)
    scores = docs @ items.T
    for least in (np.ones(70), np.full(70, 60.0), np.sort(scores, axis=0)[-20]):
        i, j, s = dualtree.surviving(dualtree.tree(docs, dualtree.DOC_NODES), dualtree.tree(items, dualtree.ITEM_NODES), least.astype(float))
        assert set(zip(i, j)) == set(zip(*np.nonzero(scores >= least))) and (s == scores[i, j]).all()


def test_pieces(monkeypatch):
    text = "Ab,cd " * 50 + "x" * 90 + " END ü"
    whole = [w for p in dualtree.pieces_of(text) for w in p]
    monkeypatch.setattr(dualtree, "PIECE", 7)
    pieces = list(dualtree.pieces_of(text))
    assert len(pieces) > 20 and [w for p in pieces for w in p] == whole == [t.encode() for t in terms(text)]
