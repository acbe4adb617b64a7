"""Fuzzy line dedup and quotation linking against brute force."""

import hashlib
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskmart.llm import lines, near, quotes
from riskmart.llm.common import ASCII_LOWER
from riskmart.llm.queries import QUERIES


def norm(line):
    t = line.encode().translate(ASCII_LOWER).decode()
    return [w for w in re.split(r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", t) if w]


def edits(a, b):
    """Edit distance, a row of the table at a time."""
    x, y = (np.frombuffer(t.encode("utf-32-le"), np.uint32) for t in (a, b))
    at = np.arange(len(y) + 1)
    row = at.copy()
    for i, c in enumerate(x, 1):
        new = np.concatenate([[i], np.minimum(row[1:] + 1, row[:-1] + (y != c))])
        row = np.minimum.accumulate(new - at) + at
    return int(row[-1])


def true_links(texts, similar=0.8):
    """[(i, j)] of the texts of that edit similarity; pairs of characters that only one has bound the distance from below."""
    bags, sizes, out = np.zeros((len(texts), 512), np.int16), np.array([len(t) for t in texts]), []
    for i, t in enumerate(texts):
        np.add.at(bags[i], [(ord(c) * 31 + ord(d)) % 512 for c, d in zip(t, t[1:])], 1)
    for i, a in enumerate(texts):
        most = (np.maximum(sizes[:i], sizes[i]) * (1 - similar) + 1e-9).astype(int)
        apart = np.maximum(np.maximum(bags[:i] - bags[i], 0).sum(1), np.maximum(bags[i] - bags[:i], 0).sum(1)) / 2  # an edit touches two pairs
        out += [(i, int(j)) for j in np.flatnonzero(apart <= most) if edits(a, texts[j]) <= most[j]]
    return out


def slow_dedup(docs, similar=0.8):
    """{(doc_id, text): numbers of the lines that go} over distinct documents, by the edit similarity alone."""
    spots = []
    for d, t in sorted(set(docs), key=lambda x: (x[0] is None, x[0] or 0)):
        spots += [((d is None, d or 0, i), (d, t), " ".join(w)) for i, x in enumerate((t or "").split("\n")) if (w := norm(x))]
    texts = sorted({s[2] for s in spots})
    parent = list(range(len(texts)))

    def top(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, j in true_links(texts, similar):
        parent[top(i)] = top(j)
    at = {t: top(i) for i, t in enumerate(texts)}
    seen, gone = set(), {d: set() for d in set(docs)}
    for place, doc, t in sorted(spots, key=lambda s: s[0]):
        if at[t] in seen:
            gone[doc].add(place[2])
        seen.add(at[t])
    return gone


def check_lines(rows, docs):
    """No line goes that the edit similarity does not justify, and at most a tenth of those it does justify stays; texts follow."""
    want, left, due = slow_dedup(docs), 0, 0
    for d, text, kept in rows:
        if text is None:
            assert kept is None
            continue
        lines_of = text.split("\n")
        stay = kept.split("\n") if kept else [x for x in lines_of if not norm(x)]
        gone, at = set(), 0
        for i, line in enumerate(lines_of):  # of equal lines the first that may go goes
            spare = at < len(stay) and stay[at] == line
            if spare and (i not in want[d, text] or len(lines_of) - i == len(stay) - at):
                at += 1
            elif len(stay) < len(lines_of):
                gone.add(i)
        assert "\n".join(x for i, x in enumerate(lines_of) if i not in gone) == kept and gone <= want[d, text]
        left, due = left + len(want[d, text] - gone), due + len(want[d, text])
    assert left <= 0.1 * due
    return due


BASE = "the quick brown fox jumps over the lazy dog near the old river bank while seven grey geese fly south over quiet hills and far fields"


def test_fuzzy_lines(spark, texts):
    words = BASE.split() * 4
    near = [" ".join(words[:i] + [w] + words[i + 1:]) for i, w in ((50, "x"), (77, "foxes"), (90, "a"))]
    docs = [(int(d), t) for d, t in zip(texts["doc_id"][:60], texts["text"][:60])]
    docs += [(1000 + i, t) for i, t in enumerate([f"{' '.join(words)}\nother {i} line" for i in range(2)] + [f"first\n{n.upper()}!\n\nlast" for n in near])]
    docs += [(None, "FIRST\nno id here"), (2000, None), (2001, ""), (2001, ""), (2002, "...\n...\n---")]
    df = spark.createDataFrame(docs, "doc_id long, text string").withColumn("n_lines", F.lit(1)).withColumn("line", F.lit(2)).withColumn("__k1", F.lit(3)).withColumn("_was", F.col("text")).repartition(4)
    rows = lines.dedup_lines(df).collect()
    assert len(rows) == len(docs) and all(r["n_lines"] == 1 and r["line"] == 2 and r["__k1"] == 3 for r in rows)
    assert check_lines([(r["doc_id"], r["_was"], r["text"]) for r in rows], docs) > 10
    assert sum("fox" in (r["text"] or "").lower() for r in rows) == 1 and sum("..." in (r["text"] or "") for r in rows) == 1


def test_recall_by_length(spark, texts):
    """Of the pairs of lines of edit similarity 0.8 or more, at most a tenth in each class of length keeps both lines."""
    docs = [(int(d), t) for d, t in zip(texts["doc_id"], texts["text"])]
    known = sorted({" ".join(w) for _, t in docs for x in t.split("\n") if (w := norm(x))})
    rows = lines.dedup_lines(spark.createDataFrame(docs, "doc_id long, text string").repartition(4)).collect()
    left = {" ".join(norm(x)) for r in rows for x in r["text"].split("\n")}
    classes = defaultdict(list)
    for i, j in true_links(known):
        n = max(len(known[i]), len(known[j]))
        classes[min(n // 100, 3) * 100].append(not {known[i], known[j]} <= left)
    assert sum(map(len, classes.values())) > 40, classes
    assert all(sum(found) >= 0.9 * len(found) for found in classes.values() if len(found) > 5) and sum(sum(f) for f in classes.values()) > 40


def test_lines_of_a_repeated_word(spark):
    row = " ".join(["no"] * 7)
    long = " ".join(["no"] * 40)
    df = spark.createDataFrame([(1, f"{row} no"), (2, f"{row} yes"), (3, f"keep\n{row} not!"), (4, "yes no"), (5, f"{long} a"), (6, f"{long} b"), (7, "le la\nla le"), (8, "la la")], "doc_id long, text string")
    want = {1: f"{row} no", 2: "", 3: "keep", 4: "yes no", 5: f"{long} a", 6: "", 7: "le la", 8: ""}  # "la la" links the two
    assert {r["doc_id"]: r["text"] for r in lines.dedup_lines(df).collect()} == want


def test_letters_lose_no_link(spark):
    """Whatever the edit similarity links passes the letters' bound; lines of the same word pairs but other letters do not reach the distance."""
    rng = np.random.default_rng(6)
    texts = ["".join(rng.choice(list("aehtzq \u00fc1"), n)) for n in rng.integers(10, 160, 25)] + ["e" * 30, "e" * 37 + " x", "z" * 30, BASE, BASE.replace("the", "te")]
    texts += ["".join(c if rng.random() > 0.15 else "k" for c in t) for t in texts]
    table = lines.with_bags(spark.createDataFrame([(i, t, len(t)) for i, t in enumerate(texts)], "i int, _t string, size int"))
    cols = ["i", "size", *[f"c{k}" for k in range(len(lines.BAGS))]]
    left, right = (table.select([F.col(c).alias(f"{side}_{c}") for c in cols]) for side in "lr")
    allowed = {(r["l_i"], r["r_i"]) for r in left.join(right, (F.col("r_i") < F.col("l_i")) & lines.bags_allow(0.8)("l_", "r_")).collect()}
    want = set(true_links(texts))
    assert len(want) > 10 and want <= allowed and len(allowed) < len(texts) * (len(texts) - 1) / 4


def test_buckets_drop_impossible_pairs(spark):
    """A pair that the carried columns exclude is not handed on to be verified, neither in the star nor between groups."""
    nodes = [(n, 0, 10, n % 2) for n in range(6)]
    hub = (0, 0, 10, 0)
    shared = spark.createDataFrame([(1, *n, hub) for n in nodes], "key long, node long, fp long, size int, c int, hub struct<node: long, fp: long, size: int, c: int>")
    seen = []

    def verify(pairs):
        seen.extend((r["a"], r["b"]) for r in pairs.collect())
        return pairs

    got = near.link_buckets(shared, 0, 0.8, verify, ["c"], lambda a, b: F.col(f"{a}c") == F.col(f"{b}c"))
    assert {(r["node"], r["root"]) for r in got.collect()} == {(n, n % 2) for n in range(6)}
    assert seen and all(a % 2 == b % 2 for a, b in seen)


def test_word_bits_lose_no_pair(spark):
    """What has enough words in common passes the bits of the words; most lines of other words do not."""
    rng = np.random.default_rng(8)
    texts = [" ".join(f"w{i}" for i in rng.integers(0, 400, 60)) for _ in range(25)]
    texts += [" ".join(w if rng.random() > 0.3 else f"v{rng.integers(400)}" for w in t.split()) for t in texts] + [" ".join(["no"] * 70), " ".join(["no"] * 60 + ["yes"] * 10)]
    table = spark.createDataFrame([(i, t, len(t)) for i, t in enumerate(texts)], "i int, _t string, size int")
    table = lines.with_word_bits(table.withColumn("_b", lines.varied_words(F.transform(F.split("_t", " "), lambda w: F.hash(w)))))
    cols = ["i", "size", "_b", "n_different", *[f"c{k}" for k in range(len(lines.BAGS))]]
    left, right = (table.select([F.col(c).alias(f"{side}_{c}") for c in cols]) for side in "lr")
    enough, allowed = lines.common_words(F.col("l__b"), F.col("r__b")).alias("enough"), lines.words_allow("l_", "r_").alias("allowed")
    rows = left.join(right, F.col("r_i") < F.col("l_i")).select(enough, allowed).collect()
    assert sum(r["enough"] for r in rows) > 25 and all(r["allowed"] for r in rows if r["enough"]) and sum(r["allowed"] for r in rows) < len(rows) / 4


@pytest.mark.parametrize("n, kept, seeds", [(40, 20, [0, 10, 13, 140]), (24, 12, [6, 9, 10, 140])])
def test_links_of_few_common_words(spark, n, kept, seeds):
    """Lines that share blocks and have an edit similarity of 0.9 are linked, though one letter differs in half of their words (a third of all words is in common)."""
    docs = []
    for s in seeds:
        rng = np.random.default_rng(s)
        words = ["".join(rng.choice(list("abcdefghijklmnop"), 4)) for _ in range(n)]
        at = int(rng.integers(0, n - kept + 1))
        docs += [(2 * s, " ".join(words)), (2 * s + 1, " ".join(w if at <= i < at + kept else w[:2] + "z" + w[3:] for i, w in enumerate(words)))]
    got = {r["doc_id"]: r["text"] for r in lines.dedup_lines(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert got == {d: "" if d % 2 else t for d, t in docs}


def test_likely_hub_is_met_first(spark):
    """A node of two buckets meets the likely one of their smallest nodes first, and the other one as well."""
    def row(key, node, hub):
        return (key, node, 0, 10, node % 2, (hub, 0, 10, hub % 2))

    rows = [row(1, 2, 2), row(1, 9, 2), row(2, 3, 3), row(2, 9, 3)]
    shared = spark.createDataFrame(rows, "key long, node long, fp long, size int, c int, hub struct<node: long, fp: long, size: int, c: int>")
    seen = []

    def verify(pairs):
        seen.append({(r["a"], r["b"]) for r in pairs.collect()})
        return pairs

    got = near.link_buckets(shared, 0, 0.8, verify, ["c"], likely=lambda a, b: F.col(f"{a}c") == F.col(f"{b}c"))
    assert seen[:2] == [{(3, 9)}, {(2, 9)}] and {(r["node"], r["root"]) for r in got.collect()} == {(n, 2) for n in (2, 3, 9)}


@pytest.mark.parametrize("n, link, most", [(400, "abs(xxhash64(a, b, 1)) % 10 < 4", 20_000), (150, "concat_ws('-', a, b) IN ('5-140', '7-8', '90-141', '140-141')", 11_200)])
def test_buckets_meet_in_rounds(spark, n, link, most):
    """Members of a large bucket that early links bring together are not compared any more; a link that stands alone is found."""
    shared = spark.createDataFrame([(1, i, 0, 10, (0, 0, 10)) for i in range(n)], "key long, node long, fp long, size int, hub struct<node: long, fp: long, size: int>")
    seen = []

    def verify(pairs):
        seen.append(pairs.count())
        return pairs.where(link)

    got = {r["node"]: r["root"] for r in near.link_buckets(shared, 0, verify=verify).collect()}
    ids = spark.range(n)
    every = ids.select(F.col("id").alias("a")).crossJoin(ids.select(F.col("id").alias("b"))).where("a < b").where(link).collect()
    root = list(range(n))
    while any(root[a] != root[b] for a, b in every):
        for a, b in every:
            root[a] = root[b] = min(root[a], root[b])
    assert [got.get(i, i) for i in range(n)] == root and len(every) > 3
    assert sum(seen) < most


def test_very_long_lines(spark):
    """Lines of a hundred thousand characters are compared by words, within seconds; tokens without blanks take the same way."""
    rng = np.random.default_rng(4)
    words = [f"w{i}" for i in rng.integers(0, 5000, 20_000)]
    changed = list(words)
    for i in range(0, len(words), 50):
        changed[i] = "other"
    other = [f"v{i}" for i in rng.integers(0, 5000, 20_000)]
    df = spark.createDataFrame([(1, " ".join(words)), (2, " ".join(changed)), (3, " ".join(other)), (4, "q" * 100_000), (5, "q" * 80_000)], "doc_id long, text string")
    assert [bool(r["text"]) for r in lines.dedup_lines(df).orderBy("doc_id").collect()] == [True, False, True, True, True]


def test_long_lines_by_characters(spark):
    """Lines of over 2,048 characters link by their characters: a letter in each third word is few edits, a third of the words rewritten is too many."""
    rng = np.random.default_rng(4)
    words = ["".join(rng.choice(list("abcdefghijklmnop"), 5)) for _ in range(800)]
    typos = [w[:2] + "z" + w[3:] if i >= 530 else w for i, w in enumerate(words)]
    tail = "x" * 900  # one word of the 801, a sixth of the characters
    head = [f"w{i}" for i in rng.integers(0, 5000, 700)]
    docs = [(1, " ".join(words)), (2, " ".join(typos)), (3, " ".join([*head, tail])), (4, " ".join([*head, "y" * 900, "z" * 900]))]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    got = [bool(r["text"]) for r in lines.dedup_lines(df).orderBy("doc_id").collect()]
    assert [edits(docs[i][1], docs[i + 1][1]) <= 0.2 * max(len(docs[i][1]), len(docs[i + 1][1])) for i in (0, 2)] == [True, False]
    assert got == [True, False, True, True]


def test_fuzzy_lines_query(spark, sf_dir, texts, odd, no_rows):
    rows = QUERIES["op6_fuzzy_lines"](spark, sf_dir).collect()
    assert len(rows) == len(texts) and sum(r["n_removed"] for r in rows) > 0
    done = lines.dedup_lines(odd).collect()
    assert len(done) == odd.count() and {r["text"] for r in done if r["doc_id"] == 6} == {"Äpfel und Öl\n"}
    assert lines.dedup_lines(no_rows).count() == 0


def slow_links(messages):
    """{(conv, turn): parent} by direct search."""
    own, quoted = defaultdict(set), defaultdict(list)
    for conv, turn, _, text in messages:
        if turn is None:
            continue
        for x in (text or "").split("\n"):
            m = re.match(quotes.MARKS, x)
            clean = re.sub(r"[\W_]+", " ", x[m.end():] if m else x).strip().lower()
            if clean and m:
                quoted[conv, turn].append((m.group(1).count(">"), clean))
            elif clean:
                own[conv, clean].add(turn)
    out = {}
    for (conv, turn), found in quoted.items():
        votes, least = Counter(), min(d for d, _ in found)
        for depth, clean in found:
            before = [t for t in own[conv, clean] if t < turn]
            if depth == least and before:
                votes[max(before)] += 1
        if votes:
            out[conv, turn] = max((n, t) for t, n in votes.items())[1]
    return out


def conversation():
    rng = np.random.default_rng(9)
    said, rows = [], []
    for t in range(60):
        body = [f"line {t} a {rng.integers(5)}", "ok" if t % 3 == 0 else f"More of {t}!"]
        if said and rng.random() < 0.7:
            u = int(rng.integers(len(said)))
            body = [*(f"> > {x}" for x in said[max(0, u - 1)]), *(f">{x.upper()}" for x in said[u]), "> ", *body]
        said.append(body[-2:])
        rows.append((1 + t % 2, t, "user" if t % 2 else "assistant", "\n".join(body)))
    return rows


def test_quotation_linking(spark):
    rows = conversation() + [(None, 0, "user", "hello there"), (None, 3000, "user", "> Hello, there\nyes"), (3, 1, None, None), (3, None, "user", "> ok"), (3, 1, None, None),
                             (4, 5, "user", "> said by nobody\nhm"), (4, 6, "user", "")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("place", F.lit(7)).withColumn("ck", F.lit("x"))
    got = quotes.link(df).collect()
    want = slow_links(rows)
    assert len(got) == len(rows) and len(want) > 20
    by = {(r["conv_id"], r["turn"]): r for r in got}
    for (conv, turn), r in by.items():
        assert r["parent_turn"] == want.get((conv, turn))
        path, at = [turn], turn
        while (conv, at) in want:
            at = want[conv, at]
            path.append(at)
        assert (r["thread_turn"], r["depth"]) == (path[-1], len(path) - 1)
        if len(path) > 1:
            assert r["place"] > by[conv, path[1]]["place"]
        assert not any(x.lstrip().startswith(">") for x in r["body"].split("\n"))
    for conv in (1, 2, 4):
        assert sorted(r["place"] for r in got if r["conv_id"] == conv) == list(range(sum(r[0] == conv for r in rows)))
    text = quotes.rendered(quotes.link(df), 8).where("conv_id = 1").orderBy("chunk").collect()
    assert len(text) == 4 and all(r["text"].startswith("<|") for r in text)
    assert quotes.link(df.limit(0)).count() == 0


def test_null_and_empty_names_are_different_conversations(spark):
    rows = [(None, 0, "user", "a question of weight"), ("", 1, "user", "> a question of weight\nyes"), ("", 0, "user", "hello"), (None, 1, "user", "> a question of weight\nno"), ("=", 0, "user", "third")]
    got = {(r["conv_id"], r["turn"]): (r["parent_turn"], r["place"]) for r in quotes.link(spark.createDataFrame(rows, "conv_id string, turn long, role string, text string")).collect()}
    assert got == {(None, 0): (None, 0), (None, 1): (0, 1), ("", 0): (None, 0), ("", 1): (None, 1), ("=", 0): (None, 0)}


def test_all_messages_of_one_turn_quote(spark):
    rows = [(1, 0, "user", "first things come first")] + [(1, 1, "user", f"> > {i}\n> first things come first\nanswer {i}") for i in range(300)]
    got = quotes.link(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(4)).collect()
    assert {r["parent_turn"] for r in got if r["turn"] == 1} == {0} and sorted(r["place"] for r in got) == list(range(301))


def test_rewrapped_and_foreign_quotes(spark):
    first = "We should move the nightly load to the new cluster before Friday, because the old one is full."
    rows = [(1, 0, "user", first + "\nok"), (1, 1, "assistant", "Something else entirely is said here.\nok"),
            (1, 2, "user", "> We should move the nightly load\n> to the new cluster before\n> Friday, because\nAgreed."),
            (1, 3, "assistant", "> the nightly load to the new clus\nWhich one?"), (1, 4, "user", ">>> print(2 + 2) in the shell\n> nobody here ever said this\nLook."),
            (1, 5, "user", "> > the nightly load\n> Which one?\nThat.")]
    got = {r["turn"]: r for r in quotes.link(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(3)).collect()}
    assert {t: r["parent_turn"] for t, r in got.items()} == {0: None, 1: None, 2: 0, 3: 0, 4: None, 5: 3}
    assert {t: r["said"] for t, r in got.items() if t > 1} == {
        2: "Agreed.", 3: "> the nightly load to the new clus\nWhich one?", 4: ">>> print(2 + 2) in the shell\n> nobody here ever said this\nLook.", 5: "> > the nightly load\nThat."}
    assert got[4]["body"] == "Look."


def test_reply_order_has_rows_of_one_width(spark):
    rng = np.random.default_rng(3)
    up = {("chain", t): t - 1 for t in range(1, 150)} | {("tree", t): int(rng.integers(t)) for t in range(1, 120) if t % 10}
    turns = [("chain", t) for t in range(150)] + [("tree", t) for t in range(120)]
    rows = [(c, t, "user", (f"> {c} {up[c, t]}\n" if (c, t) in up else "") + f"{c} {t}") for c, t in turns]
    got = {(r["conv_id"], r["turn"]): r for r in quotes.link(spark.createDataFrame(rows, "conv_id string, turn long, role string, text string").repartition(3)).collect()}

    def path(c, t):
        return (*(path(c, up[c, t]) if (c, t) in up else ()), t)

    for conv in ("chain", "tree"):
        want = sorted(path(c, t) for c, t in turns if c == conv)
        for place, p in enumerate(want):
            r = got[conv, p[-1]]
            assert (r["place"], r["thread_turn"], r["depth"]) == (place, p[0], len(p) - 1)
    answers = spark.createDataFrame([("chain", t, t - 1, 1) for t in range(1, 150)], "ck string, turn long, parent long, votes long")
    tops = quotes.threads(answers)
    for df in (tops, quotes.tour(answers, tops)):
        assert not any(t.startswith("array") for _, t in df.dtypes)


def test_quotation_query(spark, sf_dir):
    rows = QUERIES["op4_quote_linking"](spark, sf_dir)
    given = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    assert rows.count() == given.count()
    per = rows.groupBy("conv_id").agg(F.count("*").alias("n"), F.countDistinct("place").alias("d"), (F.max("place") + 1).alias("m"))
    assert per.where("n <> d OR n <> m").count() == 0


def test_quotation_query_makes_chat_texts(spark, sf_dir):
    rows = [r.asDict() for r in QUERIES["op4_quote_linking"](spark, sf_dir).collect()]
    chats = defaultdict(list)
    for r in rows:
        chats[r["conv_id"], r["chunk"]].append((r["place"], f"<|{r['role'] or 'unknown'}|>\n{r['said']}", r["chat_sha256"]))
    for lines_of in chats.values():
        text = "\n".join(x[1] for x in sorted(lines_of))
        assert {x[2] for x in lines_of} == {hashlib.sha256(text.encode()).hexdigest()}
