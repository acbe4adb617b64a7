"""Packing round trip, sharding balance and the three learned text judges against plain Python."""

import re
import zlib
from collections import Counter
from functools import cache

import numpy as np
import pytest

from riskmart.llm import langid, packing, rules, sharding, trees
from riskmart.llm.queries import QUERIES, tokenizer_path
from riskmart.llm.textstats import counts_of

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def crc_fold(doc_id, m):
    return zlib.crc32(("" if doc_id is None else str(int(doc_id))).encode()) % m


def auc(y, s):
    order = np.argsort(s, kind="stable")
    rank = np.empty(len(s))
    rank[order] = np.arange(1, len(s) + 1)
    for v in np.unique(s):
        rank[s == v] = rank[s == v].mean()
    p = y == 1
    return (rank[p].sum() - p.sum() * (p.sum() + 1) / 2) / (p.sum() * (~p).sum())


@cache
def tokenizer():
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(tokenizer_path())
    t.encode_special_tokens = True
    return t


def whole_ids(text):
    return [*tokenizer().encode(text or "", add_special_tokens=False).ids, 0]


def check_pieces(rows, texts, size):
    by_text = Counter(texts)
    assert rows.groupby("sequence_id")["length"].sum().max() <= size
    for _, g in rows.groupby("sequence_id"):
        g = g.sort_values("offset")
        assert (g["offset"].to_numpy() == np.concatenate([[0], g["length"].cumsum()[:-1]])).all()
    assert rows["length"].sum() == sum(len(whole_ids(t)) * n for t, n in by_text.items())
    for doc_id, g in rows.dropna(subset=["doc_id"]).groupby("doc_id"):
        yield int(doc_id), g.sort_values("start")


def test_packing_round_trip(spark, sf_dir, texts):
    rows = QUERIES["op1_packing"](spark, sf_dir).toPandas()
    text_of = dict(zip(texts["doc_id"], texts["text"]))
    seen = 0
    for doc_id, g in check_pieces(rows, list(texts["text"]), 1024):
        ids = whole_ids(text_of[doc_id])
        assert set(g["doc_tokens"]) == {len(ids)} and g["length"].sum() == len(ids)
        for s, n, crc in zip(g["start"], g["length"], g["ids_crc32"]):
            assert zlib.crc32(np.array(ids[s:s + n], "<u4").tobytes()) == crc
        seen += 1
    assert seen == len(texts)
    used, n = rows["length"].sum(), rows["sequence_id"].nunique()
    rest = rows[rows["length"] < 1024]
    assert n <= -(-rest["length"].sum() // 1000) + (rows["length"] == 1024).sum() + 8, used


def test_packing_odd_rows(odd, no_rows):
    rows = packing.pack(odd, tokenizer_path()).toPandas()
    assert len(list(check_pieces(rows, [r["text"] for r in odd.collect()], 1024))) == 8
    assert packing.pack(no_rows, tokenizer_path()).count() == 0


def test_column_generation_reaches_the_bound():
    rng = np.random.default_rng(5)
    demand = rng.integers(0, 400, 64)
    units = (demand * np.arange(1, 65)).sum()
    made = packing.plan(demand, 64)
    assert (sum(p * n for p, n in made) == demand).all()
    assert all((p * np.arange(1, 65)).sum() <= 64 for p, _ in made)
    _, x = packing.column_generation(demand, 64)
    assert sum(n for _, n in made) <= np.ceil(x.sum()) + 20 and x.sum() >= units / 64


def test_sharding_is_whole_and_even(spark, sf_dir, texts):
    rows = QUERIES["op9_sharding"](spark, sf_dir).toPandas()
    assert sorted(rows["doc_id"]) == sorted(texts["doc_id"])
    data = {d: (t or "").encode() for d, t in zip(texts["doc_id"], texts["text"])}
    assert all(data and s == len(data[d]) + 1 and c == zlib.crc32(data[d]) for d, s, c in zip(rows["doc_id"], rows["size"], rows["text_crc32"]))
    for _, g in rows.groupby("shard"):
        assert sorted(g["slot"]) == list(range(len(g)))
    load = rows.groupby("shard")["size"].sum().reindex(range(16), fill_value=0)
    assert load.max() - load.min() < rows["size"].min() + 0.1 * load.mean()


def test_sharding_splits_a_repeated_row(spark):
    df = spark.range(4000).selectExpr("IF(id < 2000, 7, id) AS doc_id", "'same text here' AS text").repartition(4)
    load = sharding.shard_by_bytes(df).groupBy("shard").count().toPandas()["count"]
    assert load.sum() == 4000 and len(load) == 16 and load.max() - load.min() <= 20


def test_map_edits():
    first = sharding.dealt(64, 4)
    more = sharding.grown(first, 4)
    assert all(a == b or b == 4 for a, b in zip(first, more)) and 10 <= more.count(4) <= 13
    owner = dict(enumerate(first))
    weight = {u: 1 + (u * 37) % 11 for u in owner} | {0: 60}
    after = sharding.rebalanced(owner, weight, 4)
    load = Counter()
    for u, s in after.items():
        load[s] += weight[u]
    assert max(load.values()) - min(load.values()) <= 1


def test_sharding_odd_rows(odd, no_rows):
    rows = sharding.shard_by_bytes(odd).toPandas()
    assert len(rows) == odd.count() and rows["size"].min() == 1
    assert all(sorted(g["slot"]) == list(range(len(g))) for _, g in rows.groupby("shard"))
    assert sharding.shard_by_bytes(no_rows).count() == 0


def slow_counts(text):
    words = WORD.findall(text or "")
    win = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    n = Counter(win)
    hit = {i + k for i, w in enumerate(win) if n[w] > 1 for k in range(3)}
    seen, dup = set(), 0
    for line in (text or "").split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), dup, len(hit)


def test_counts_match_plain_python(texts, odd):
    for t in [*texts["text"], *[r["text"] for r in odd.collect()], "a b c a b c a", "a a a a", "x\ny\nx\n \n \n"]:
        assert counts_of(t)[:5] == slow_counts(t)


def test_quality_rules(spark, texts):
    sf = "/root/testdata/sf0.01"
    rows = QUERIES["op7_quality_rules"](spark, sf).toPandas().set_index("doc_id")
    label = spark.read.parquet(f"{sf}/labels.parquet").toPandas().set_index("doc_id")["quality"]
    both = rows.join(label, how="inner")
    both = both[~both["base_failed"]]
    assert both[both["quality"] == 1]["kept"].mean() > 0.97
    assert both[both["quality"] == 0]["kept"].mean() < 0.5


def test_rules_odd_rows(odd, no_rows, labels):
    rows = rules.quality_rules(odd, labels)
    got = {r["doc_id"]: r for r in rows.collect()}
    assert rows.count() == odd.count() and not got[2]["kept"] and got[2]["base_failed"] and got[2]["n_words"] == 0
    assert rules.quality_rules(no_rows, labels.limit(0)).count() == 0


def test_rule_learning_finds_a_conjunction():
    rng = np.random.default_rng(2)
    x = rng.random((4000, 3))
    bad = (x[:, 0] > 0.8) & (x[:, 2] <= 0.3)
    made = rules.learn(x, bad, np.arange(4000) % 3, ["a", "b", "c"])
    hit = np.any([r.covers(x, ["a", "b", "c"]) for r in made], axis=0)
    assert (hit & bad).sum() > 0.95 * bad.sum() and (hit & ~bad).sum() < 0.03 * bad.sum()
    assert rules.learn(np.zeros((0, 3)), np.zeros(0, bool), np.zeros(0), ["a", "b", "c"]) == []


def test_classifier_ranks_held_out_labels(spark):
    sf = "/root/testdata/sf0.01"
    rows = QUERIES["op2_quality_classifier"](spark, sf).toPandas().set_index("doc_id")
    assert all(h == (crc_fold(d, 5) == 0) for d, h in rows["held_out"].items())
    both = rows.join(spark.read.parquet(f"{sf}/labels.parquet").toPandas().set_index("doc_id"), how="inner")
    both = both[both["held_out"]]
    assert auc(both["quality"].to_numpy(), both["score"].to_numpy()) > 0.95
    assert (rows["predicted"] == (rows["score"] >= 0.3)).all() and rows["score"].between(0, 1).all()


def test_forest_arrays_equal_the_walk():
    rng = np.random.default_rng(3)
    x = rng.random((300, 4))
    f = trees.grow(x, (x[:, 1] + x[:, 3] > 1).astype(float), trees=10, depth=3)
    for row, got in zip(x[:50], f.raw(x[:50])):
        want = f.prior
        for k in range(10):
            at = 0
            while 2 * at + 2 < f.feature.shape[1]:
                at = 2 * at + 1 + (row[f.feature[k, at]] > f.threshold[k, at])
            want += f.value[k, at]
        assert got == pytest.approx(want)


def test_classifier_odd_rows(odd, no_rows, labels):
    rows = trees.quality_scores(odd, labels).toPandas()
    assert len(rows) == odd.count() and rows["score"].between(0, 1).all()
    assert set(trees.quality_scores(odd, labels.limit(0)).toPandas()["score"]) == {0.5}
    assert trees.quality_scores(no_rows, labels).count() == 0


def test_language_id(spark):
    sf = "/root/testdata/sf0.01"
    rows = QUERIES["op10_language_id"](spark, sf).toPandas().set_index("doc_id")
    docs = spark.read.parquet(f"{sf}/documents.parquet").toPandas().set_index("doc_id")
    both = rows.join(docs["lang"])
    assert all(h == (crc_fold(d, 4) == 2) for d, h in rows["held_out"].items())
    assert (both["lang"] == both["lang_pred"])[both["held_out"]].mean() > 0.95
    assert rows["score"].between(0, 1).all()


def test_language_odd_rows(odd, no_rows):
    got = langid.detect(odd).toPandas()
    assert len(got) == odd.count()
    assert set(got[got["doc_id"].isin([1, 2, 5])]["lang_pred"]) == {"und"}
    assert langid.detect(no_rows).count() == 0
    pred, score = langid.predict(["²³ 5", "abc"], ["a"], np.zeros((1 << 16, 1)), np.zeros(1))
    assert pred == ["und", "a"] and score == [0.0, 1.0]
