"""Near-duplicates and decontamination against brute force."""

import hashlib
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from riskmart.llm import near, simhash, winnow
from riskmart.llm.common import ASCII_LOWER
from riskmart.llm.queries import ORACLE, QUERIES
from tests.compare import compare

WORD = re.compile(rb"[^\x20\x09-\x0D]+")
TOKEN = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower(text):
    return (text or "").encode().translate(ASCII_LOWER)


def slow_fingerprint(text):
    w = WORD.findall(lower(text))
    if not w:
        return 0
    sh = [b" ".join(w[i:i + 3]) for i in range(max(1, len(w) - 2))]
    h = [xxhash.xxh64_intdigest(s, 42) for s in sh]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def slow_groups(ids, prints, most):
    parent = list(range(len(prints)))

    def top(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(prints)):
        for j in range(i):
            if bin(prints[i] ^ prints[j]).count("1") <= most:
                parent[top(i)] = top(j)
    best = {}
    for i, d in enumerate(ids):
        best[top(i)] = min((x for x in (best.get(top(i)), d) if x is not None), default=None)
    return [best[top(i)] for i in range(len(prints))]


def test_every_near_pair_shares_a_key():
    rng = np.random.default_rng(1)
    for _ in range(300):
        a = int(rng.integers(0, 2**63)) | int(rng.integers(0, 2)) << 63
        b = a
        for bit in rng.choice(64, rng.integers(0, 4), replace=False):
            b ^= 1 << int(bit)
        row, key = simhash.keys_of(np.array([a, b], dtype="<u8").view("<i8"))
        assert set(key[row == 0]) & set(key[row == 1])
    assert simhash.golay_tables()[3].tolist().count(6) == 1771


def test_simhash_components(spark, sf_dir, texts):
    got = QUERIES["op3_simhash_golay"](spark, sf_dir).toPandas().set_index("doc_id")
    assert len(got) == len(texts)
    prints = [slow_fingerprint(t) for t in texts["text"]]
    want = slow_groups(list(texts["doc_id"]), prints, 3)
    for d, fp, c in zip(texts["doc_id"], prints, want):
        assert (got.loc[d, "fingerprint"], got.loc[d, "component_id"]) == (f"{fp:016x}", c)


def test_simhash_odd_rows(odd, no_rows):
    rows = simhash.near_duplicates(odd).collect()
    assert len(rows) == odd.count()
    empty = [r for r in rows if r["fingerprint"] == "0" * 16]
    assert len(empty) == 4 and {r["component_id"] for r in empty} == {1}
    assert {r["component_id"] for r in rows if r["doc_id"] == 3} == {3}
    assert simhash.near_duplicates(no_rows).count() == 0


def test_links_between_dense_and_sparse_groups(spark):
    rng = np.random.default_rng(4)
    prints = set()
    for _ in range(12):
        seed = int(rng.integers(0, 2**62))
        for _ in range(40):
            x = seed
            for bit in rng.choice(64, rng.integers(0, 7), replace=False):
                x ^= 1 << int(bit)
            prints.add(x)
    prints = sorted(prints)
    signed = np.array(prints, dtype="<u8").view("<i8")
    got = {r["fp"]: r["root"] for r in simhash.groups(spark.createDataFrame([(int(x),) for x in signed], "fp long")).collect()}
    want = slow_groups(list(range(len(prints))), prints, 3)
    assert len(set(zip(want, (got[int(x)] for x in signed)))) == len(set(want)) == len(set(got.values()))


def test_keep_one_finds_planted_copies(spark):
    rng = np.random.default_rng(8)

    def shingles(w):
        return {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))}

    rows, want, missed_by_bits = [], set(), 0
    for i in range(60):
        n = int(rng.integers(100, 400))
        words = [f"w{x}" for x in rng.integers(0, 5000, n)]
        copy = list(words)
        for at in rng.choice(n, max(1, int(n * (0.01, 0.02, 0.05)[i % 3])), replace=False):
            copy[at] = "new"
        a, b = shingles(words), shingles(copy)
        near_copy = len(a & b) / len(a | b) >= 0.8
        rows += [(2 * i, " ".join(words)), (2 * i + 1, " ".join(copy).upper())]
        want |= {2 * i} if near_copy else {2 * i, 2 * i + 1}
        missed_by_bits += near_copy and bin(slow_fingerprint(rows[-2][1]) ^ slow_fingerprint(rows[-1][1])).count("1") > 3
    got = {r["doc_id"] for r in simhash.keep_one(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()}
    assert got == want and missed_by_bits > 10 and len(want) > 70


def test_keep_one_links_by_fingerprints(spark, monkeypatch):
    """Without the bands, the Golay keys alone find every near copy whose fingerprint is within three bits, and the shingles decide on it."""
    rng, rows, want, within = np.random.default_rng(3), [], set(), 0
    for i in range(40):
        words = [f"w{x}" for x in rng.integers(0, 5000, int(rng.integers(200, 400)))]
        copy = [*words[:-1], "new"] if i % 2 else [f"v{x}" for x in rng.integers(0, 5000, 200)]
        (_, a), (_, b) = (simhash.shingles_of(" ".join(w)) for w in (words, copy))
        bits = bin((simhash.majority([a], len(a)) ^ simhash.majority([b], len(b))) & (2**64 - 1)).count("1")
        linked = bits <= 3 and len(set(a.tolist()) & set(b.tolist())) >= 0.8 * len(set(a.tolist()) | set(b.tolist()))
        rows += [(2 * i, " ".join(words)), (2 * i + 1, " ".join(copy))]
        want |= {2 * i} if linked else {2 * i, 2 * i + 1}
        within += linked
    sketch = simhash.sketch
    monkeypatch.setattr(simhash, "sketch", lambda text: sketch(text).withField("keys", F.array().cast("array<long>")))
    got = {r["doc_id"] for r in simhash.keep_one(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()}
    assert got == want and within > 10


def test_components_of_paths_stars_and_loops(spark):
    edges = [(i, i + 1) for i in range(1, 60)] + [(100, i) for i in range(101, 160)] + [(5, 5), (200, 201), (201, 202), (202, 200), (201, 200)]
    got = {r["node"]: r["root"] for r in near.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**dict.fromkeys(range(1, 61), 1), **dict.fromkeys(range(100, 160), 100), **dict.fromkeys((200, 201, 202), 200)}
    assert near.components(spark.createDataFrame([], "a long, b long")).count() == 0


def slow_contamination(text, items, span=10):
    words = TOKEN.findall(lower(text).decode())
    hit, named = set(), set()
    for item_id, t in items:
        iw = TOKEN.findall(lower(t).decode())
        n = min(span, len(iw))
        windows = {tuple(iw[i:i + n]) for i in range(len(iw) - n + 1)} if n else set()
        for i in range(len(words) - n + 1):
            if tuple(words[i:i + n]) in windows:
                hit.update(range(i, i + n))
                named.add(str(item_id))
    ids = ",".join(sorted(named))
    return len(words), len(hit), len(named), hashlib.sha256(ids.encode()).hexdigest(), bool(hit)


def check_contamination(rows, docs, items):
    got = sorted((r["doc_id"] or -1, r["n_words"], r["n_hit"], r["n_items"], r["items_sha256"], r["contaminated"]) for r in rows)
    assert got == sorted((d or -1, *slow_contamination(t, items)) for d, t in docs)


def test_decontamination(spark, sf_dir, texts, duck):
    items = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text").collect()]
    rows = QUERIES["op8_decontamination"](spark, sf_dir).collect()
    assert compare(QUERIES["op8_decontamination"](spark, sf_dir), duck, ORACLE["op8_decontamination"]) == []
    check_contamination(rows, list(zip(texts["doc_id"], texts["text"])), items)
    assert any(r["contaminated"] for r in rows)


@pytest.mark.parametrize("broadcast", [True, False])
def test_decontamination_odd_rows(spark, odd, no_rows, broadcast, monkeypatch):
    if not broadcast:
        monkeypatch.setattr(winnow, "BROADCAST_ROWS", 0)
        monkeypatch.setattr(winnow, "BROADCAST_BYTES", 0)
    items = [(1, "The CAT sat"), (2, "äpfel"), (2, "Öl"), (3, None), (4, " ,.; "), (5, "x-y z"), (6, "one two three four five six seven eight nine ten eleven"),
             (7, "word3 said word4 said word5 said word6 said word7 said word8"), (8, "the cat sat on the mat")]
    bench = spark.createDataFrame([*items, (None, "the cat sat")], "item_id long, text string")
    more = [(20, "zero one two three four five six seven eight nine ten, eleven twelve"), (21, "One two three four FIVE six seven eight nine"),
            (22, "the cat the cat sat on the mat the cat")]
    docs = [(r["doc_id"], r["text"]) for r in odd.collect()] + more
    both = odd.select("doc_id", "text").unionByName(spark.createDataFrame(more, "doc_id long, text string"))
    check_contamination(winnow.contamination(both, bench).collect(), docs, items)
    assert winnow.contamination(no_rows, bench).count() == 0
    assert {r["n_hit"] for r in winnow.contamination(odd, bench.limit(0)).collect()} == {0}


def test_like_nodes_in_many_buckets_are_checked_once(spark):
    """Sixty nodes in eight buckets of different smallest nodes: a check for each, not for each bucket (before: 508)."""
    seen = []

    def verify(pairs):
        seen.append(pairs.count())
        return pairs

    keys = [(k, n) for k in range(8) for n in [*range(k, 8), *range(100, 160)]]
    nodes = [(n, 0, 10) for n in [*range(8), *range(100, 160)]]
    got = near.linked(spark.createDataFrame(keys, "key long, node long"), spark.createDataFrame(nodes, "node long, fp long, size long"), 0, 0.8, verify)
    assert {r["node"]: r["root"] for r in got.collect()} == {n: 0 for n, _, _ in nodes}
    assert sum(seen) == 67


def test_links_that_only_later_rounds_find(spark):
    """Random buckets and links against brute force; the smallest node of a bucket often links to none of it."""
    rng = np.random.default_rng(5)
    for size in (3, 12, 40):
        keys = sorted({(int(k), int(n)) for k, n in zip(rng.integers(0, 12, 12 * size), rng.integers(0, 60, 12 * size))})
        true = {(a, b) for a in range(60) for b in range(a + 1, 60) if rng.random() < 0.05}
        links = spark.createDataFrame(sorted(true), "a long, b long")
        nodes = spark.createDataFrame([(n, 0, 10) for n in range(60)], "node long, fp long, size long")

        def verify(pairs):
            ends = [F.least("a", "b").alias("_x"), F.greatest("a", "b").alias("_y")]
            return pairs.select("*", *ends).join(links.toDF("_x", "_y"), ["_x", "_y"], "left_semi").select(*pairs.columns)

        got = near.linked(spark.createDataFrame(keys, "key long, node long"), nodes, 0, 0.8, verify)
        held = {}
        for k, n in keys:
            held.setdefault(k, set()).add(n)
        parent = list(range(60))
        for a, b in true:
            if any(a in s and b in s for s in held.values()):
                low, high = sorted((parent[a], parent[b]))
                parent = [low if x == high else x for x in parent]
        want = {n: parent[n] for n in range(60) if parent.count(parent[n]) > 1}
        assert {r["node"]: r["root"] for r in got.collect()} == want
