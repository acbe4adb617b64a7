"""Language-model scores against plain counts, tries against each other, and the pipeline stage by stage."""

import re
import zlib
from collections import Counter

import numpy as np
import pytest

import corpus_pipeline
from riskmart.llm import mixing
from riskmart.llm.common import ASCII_LOWER
from riskmart.llm.queries import QUERIES
from tests.llm.test_duplicates import slow_contamination
from tests.llm.test_lines_quotes import check_lines


def held_out(d):
    return zlib.crc32(("" if d is None else str(int(d))).encode()) % 10 == 0


def check_base(rows, docs):
    taught = Counter()
    for d, t in docs:
        if not held_out(d):
            taught.update([*mixing.tokens_of(t), b""])
    n, v = sum(taught.values()), len(taught)
    want = Counter()
    for d, t in docs:
        words = [*mixing.tokens_of(t), b""]
        base = sum(np.log10((taught[w] + 0.1) / (n + 0.1 * (v + 1))) for w in words)
        want[d, held_out(d), len(words), sum(taught[w] > 0 for w in words), n, round(base, 5)] += 1
    assert Counter((r["doc_id"], r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 5)) for r in rows) == want
    assert all(r["score"] < 0 and r["bits_per_byte"] > 0 for r in rows)


def test_scores_and_base(spark, sf_dir, texts):
    rows = QUERIES["op5_context_mixing"](spark, sf_dir).collect()
    check_base(rows, list(zip(texts["doc_id"], texts["text"])))
    assert np.mean([r["bits_per_byte"] for r in rows if r["held_out"]]) < 2.4


def test_scores_of_odd_rows(spark, odd, no_rows, monkeypatch):
    monkeypatch.setattr(mixing, "PART_TYPES", 120)
    monkeypatch.setattr(mixing, "BLOCK_TOKENS", 50)
    more = spark.createDataFrame([(30, "long " + "ab" * 900 + "c"), (31, "long " + "ab" * 900 + "d"), (32, "x" * 39 + " " + "x" * 40 + " " + "x" * 41)], "doc_id long, text string")
    both = odd.select("doc_id", "text").unionByName(more)
    check_base(mixing.lm_scores(both).collect(), [tuple(r) for r in both.collect()])
    assert mixing.lm_scores(no_rows).count() == 0


def test_parts_know_the_whole_trie():
    words = sorted({f"{a}{b}".encode() for a in ("the", "then", "than", "a", "") for b in range(60)} | {b"", b"x" * 70})
    c = np.arange(len(words)) % 7
    whole = mixing.Trie(words, c)
    name = lambda t: {((t.words[w] + b" ")[:d], int(b)): int(n) for w, d, b, n in zip(t.word, t.depth, t.byte, t.count)}
    cuts = [0, 37, 38, 120, 200, len(words)]
    parts = [mixing.Trie(words[i:j], c[i:j]) for i, j in zip(cuts, cuts[1:])]
    total = Counter()
    for p in parts:
        back = {v: k for k, v in p.rim().items()}
        for e in range(p.own):
            if int(p.node[e]) in back:
                total[back[int(p.node[e])], int(p.byte[e])] += int(p.count[e])
    for p in parts:
        rim = p.rim()
        rows = [(k[0], k[1], n) for k, n in total.items() if k[0] in rim]
        p.widen(*map(list, zip(*rows)))
        known = name(whole)
        assert all(known[k] == n for k, n in name(p).items())
    assert whole.count[whole.depth == 0].sum() == c.sum()


def test_next_bytes_sum_to_one():
    words = [b"", b"ab", b"abc", b"b", b"bd"]
    trie = mixing.Trie(words, np.array([3, 9, 4, 0, 1]))
    flat = np.zeros((sum(1 << b for b in mixing.TABLE_BITS), 2), np.float32)
    counts = mixing.table_counts(trie)
    flat[counts[:, 0]] = counts[:, 1:]
    tables = np.split(flat, np.cumsum([1 << b for b in mixing.TABLE_BITS])[:-1])
    w = mixing.fresh_weights()
    adapt = np.full((mixing.LEVELS, mixing.BINS), 0.5)
    every = mixing.Trie(sorted(bytes([b]) for b in range(256) if b != 32), np.zeros(255, np.int64))
    every.count[every.depth == 0] = [dict({97: 13, 98: 1}).get(int(b), 0) for b in every.byte[every.depth == 0]]
    order, cost = np.lexsort((every.byte, every.node)), np.zeros(every.own)
    for j in range(8):
        e = mixing.BitEvents(every, order, tables, j, without=0)
        p = mixing.refined((e.x * w[e.gate]).sum(1), e.level, adapt)
        cost[e.edge] += np.log(np.where(e.bit == 1, p, 1 - p))
    first = np.exp(cost[every.depth == 0]).sum()
    assert first == pytest.approx(1, abs=0.1) and first <= 1 + 1e-9  # the blank is the byte left out


def firsts_of_near(texts):
    """The smallest id of each group of texts whose sets of five-word shingles have a Jaccard similarity of 0.8 or more, by all pairs."""
    sets = {}
    for d, t in texts.items():
        w = re.findall(rb"[^\x20\x09-\x0D]+", t.encode().translate(ASCII_LOWER))
        sets[d] = {b" ".join(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set()
    root = {d: d for d in sets}
    for a in sets:
        for b in sets:
            if a < b and sets[a] and root[a] != root[b] and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]):
                low, high = sorted((root[a], root[b]))
                root = {d: low if r == high else r for d, r in root.items()}
    blank = sorted(d for d in sets if not sets[d])  # texts without a word are one group
    return (set(root.values()) - set(blank)) | set(blank[:1])


def test_pipeline_stages(spark, sf_dir, documents):
    docs, names = documents, [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality_rules", "line_dedup", "near_dedup", "decontamination", "packing"]
    after = {}
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, sf_dir)
        docs = spark.createDataFrame(docs.collect(), docs.schema).coalesce(4)
        after[name] = docs.collect()
        if name != "packing":
            assert docs.columns == documents.columns
    kept = {r["doc_id"]: r["text"] for r in after["quality_rules"]}
    assert all(len(re.findall(r"[^\x20\x09-\x0D]+", t)) >= 50 for t in kept.values()) and len(kept) > 100
    lined = {r["doc_id"]: r["text"] for r in after["line_dedup"]}
    assert set(lined) == set(kept) and all(r["n_chars"] == len(r["text"]) for r in after["line_dedup"])
    assert check_lines([(d, kept[d], lined[d]) for d in kept], list(kept.items())) > 0
    near = {r["doc_id"]: r["text"] for r in after["near_dedup"]}
    assert sorted(near) == sorted(firsts_of_near(lined))
    items = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text").collect()]
    clean = {d for d, t in near.items() if not slow_contamination(t, items)[4]}
    assert {r["doc_id"] for r in after["decontamination"]} == clean == {r["doc_id"] for r in after["packing"]}


def test_pipeline_stages_on_odd_rows(spark, sf_dir, odd, no_rows):
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, odd, sf_dir)
        assert out.columns == odd.columns and {r["kept"] for r in out.collect()} <= {r["kept"] for r in odd.collect()}
        assert stage(spark, no_rows, sf_dir).count() == 0
    assert corpus_pipeline.near_dedup(spark, odd, sf_dir).where("doc_id = 3").count() <= 1
