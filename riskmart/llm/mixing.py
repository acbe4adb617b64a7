"""Language-model scoring by online logistic context mixing.

The model codes a text as its tokens: each word, A-Z lower-cased, followed by a blank, and at the end an empty word with its blank; byte by
byte, bit by bit. Several predictors give a probability for the next bit: one for the whole word so far (exact counts), three for
the last one, two and three bytes (hashed tables of counts). Their logits are mixed with weights chosen by a gate (how often the word so far
was seen, whether it was always followed by the same bit, which bit it is), and the mix is refined by an adaptive table over (gate
group, mixed logit). Last, words are gated by the kind of text: training texts have a class (their language; the most frequent have one each,
all others share one), ``P(class | word)`` comes from the word's counts, and with the posterior of the classes given the words before, a word
has ``P(word) * sum over classes of posterior * P(class | word) / P(class)``, which over a text telescopes to one sum over classes. The
sum of the logarithms is the score: bits per byte are ``-score / log10(2) / bytes``.

Spark side. Tokens are counted over all training texts, one row per type, range-partitioned by token and staged, so each part is a trie of
its own; nodes that reach over the edge of a part get their counts from the neighbours by a join. Predictions depend on the word so
far alone, hence on an edge of the trie: each edge is computed once, not once per occurrence. Weights are learned online inside each
part, edge after edge in a fixed random order, weighted by occurrences, each prediction made without the occurrence it is judged on; the
parts' weights are averaged by mass. What the driver sees has a fixed size (hashed tables, weights); the types do not pass through it.
Documents are scored in blocks: a block's distinct tokens, each with the documents it is in, are joined to the scored types and come
back to the block's sums; texts are not shuffled.

Defined cases: NULL and empty texts have the end token alone; without training texts N and V are 0 and every bit costs what the priors say;
repeated rows are scored, and teach, once per row; a NULL doc_id is held out where ``crc32('')`` says so; words of any length are
scored: beyond ``DEPTH`` bytes by the two-byte predictor.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DoubleType, LongType, StringType, StructField, StructType

from riskmart.llm.common import ASCII_LOWER, fold
from riskmart.session import staged

DEPTH = 40
TABLE_BITS = (16, 20, 21)
PART_TYPES = 60_000
BLOCK_TOKENS = 2_000_000
FLUSH_TYPES = 300_000
LEVELS = 14
GATES = LEVELS * 2 * 8
#: Classes of texts, the one for all further languages included; what a word gains in each is sent in steps of 1 / STEP.
CLASSES = 8
STEP = 4096
INPUTS = 5
BINS = 33
CLIP = 14.0


def tokens_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").translate(ASCII_LOWER).split()


def text_class(documents: DataFrame, teaches) -> Column:
    """The number of a text's class; languages in the order of how many texts they teach with, all others and NULL are 0."""
    if "lang" not in documents.columns:
        return F.lit(0)
    most = documents.where(teaches & F.col("lang").isNotNull()).groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(CLASSES - 1).collect()
    number = F.lit(0)
    for i, row in enumerate(most, 1):
        number = F.when(F.col("lang") == row["lang"], i).otherwise(number)
    return number


def count_types(documents: DataFrame, teaches) -> DataFrame:
    """(token, c, k0, k1, ...): all tokens of all documents, counted over those that teach, in all and by class. A task passes its sums on whenever they grow large."""

    def count(batches):
        taught, heard = [Counter() for _ in range(CLASSES)], set()

        def rows():
            for k, c in enumerate(taught):
                heard.difference_update(c)
            for k, c in enumerate([*taught, dict.fromkeys(heard, 0)]):
                if c:
                    yield pa.RecordBatch.from_arrays([pa.array(list(c), pa.binary()), pa.array(np.full(len(c), k % CLASSES), pa.int32()), pa.array(list(c.values()), pa.int64())],
                                                     names=["token", "k", "n"])
                c.clear()
            heard.clear()

        for batch in batches:
            for text, teach, k in zip(batch.column(0), batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                words = tokens_of(text.as_py())
                words.append(b"")
                (taught[k] if teach else heard).update(words)
                if len(heard) + sum(map(len, taught)) > FLUSH_TYPES:
                    yield from rows()
        yield from rows()

    narrow = documents.select("text", teaches.alias("_teach"), text_class(documents, teaches).alias("_class"))
    by_class = [F.coalesce(F.sum(F.when(F.col("k") == k, F.col("n"))), F.lit(0)).alias(f"k{k}") for k in range(CLASSES)]
    return narrow.mapInArrow(count, "token binary, k int, n long").groupBy("token").agg(F.sum("n").alias("c"), *by_class)


class Trie:
    """Edges of sorted words, each closed by a blank: node (a prefix), next byte, count, and the place in ``starts`` of its depth."""

    def __init__(self, words: list[bytes], c: np.ndarray):
        n = len(words)
        self.words, self.c = words, c
        self.length = np.minimum(np.array([len(w) for w in words]) + 1, DEPTH)
        self.m = np.frombuffer(b"".join([(w + b" ")[:DEPTH].ljust(DEPTH, b"\0") for w in words]), np.uint8).reshape(n, DEPTH)
        same = np.logical_and.accumulate(self.m[1:] == self.m[:-1], axis=1).sum(1)
        self.lcp = np.concatenate([[-1], np.minimum(same, np.minimum(self.length[1:], self.length[:-1]))])
        self.starts = [np.flatnonzero(self.lcp < k) if k else np.zeros(1, np.int64) for k in range(DEPTH + 1)]
        word, depth, node, count, self.edge_at, base = [], [], [], [], [], 0
        for k in range(DEPTH):
            at = self.starts[k + 1]
            has = self.length[at] > k
            number = np.full(len(at), -1)
            number[has] = base + np.arange(has.sum())
            self.edge_at.append(number)
            base += int(has.sum())
            word.append(at[has])
            depth.append(np.full(has.sum(), k))
            node.append(self.node_of(at[has], k))
            count.append(np.add.reduceat(c, at)[has])
        self.word, self.depth, self.node, self.count = map(np.concatenate, (word, depth, node, count))
        self.byte = self.m[self.word, self.depth].astype(np.int64)
        self.own = len(self.word)  # edges of these words; those after them are only known from other parts

    def node_of(self, word: np.ndarray, k: int) -> np.ndarray:
        at = self.starts[k]
        return at[np.searchsorted(at, word, side="right") - 1] * (DEPTH + 1) + k

    def rim(self) -> dict[bytes, int]:
        """Prefixes of the first and the last word, which may go on in other parts, and their nodes."""
        out = {}
        for i in (0, len(self.words) - 1):
            for k in range(int(self.length[i])):
                out[(self.words[i] + b" ")[:k]] = int(self.node_of(np.array([i]), k)[0])
        return out

    def widen(self, prefix: list[bytes], byte: list[int], total: list[int]) -> np.ndarray:
        """Takes in the counts over all parts; returns the counts of this part alone."""
        local, rim = self.count.copy(), self.rim()
        nodes = np.array(sorted(set(rim.values())))
        edge = {(int(self.node[e]), int(self.byte[e])): e for e in np.flatnonzero(np.isin(self.node, nodes))}
        more = []
        for p, b, t in zip(prefix, byte, total):
            e = edge.get((rim[p], b))
            if e is None:
                more.append((rim[p], b, t, len(p)))
            else:
                self.count[e] = t
        if more:
            node, b, t, depth = (np.array(x, dtype=np.int64) for x in zip(*more))
            first = node // (DEPTH + 1)
            self.node, self.byte = np.concatenate([self.node, node]), np.concatenate([self.byte, b])
            self.count = np.concatenate([self.count, t])
            self.word, self.depth = np.concatenate([self.word, first]), np.concatenate([self.depth, depth])
        return local

    def before(self, k: int) -> np.ndarray:
        """The k bytes in front of each edge as a number; blanks stand in front of a word."""
        out = np.zeros(len(self.word), np.int64)
        for back in range(k, 0, -1):
            at = self.depth - back
            out = out << 8 | np.where(at >= 0, self.m[self.word, np.maximum(at, 0)], 32)
        return out


def slot(order: int, context: np.ndarray, partial: np.ndarray) -> np.ndarray:
    """Place of (context, bits so far) in the hashed table of an order."""
    key = (context.astype(np.uint64) << np.uint64(8) | partial.astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
    return (key >> np.uint64(64 - TABLE_BITS[order])).astype(np.int64)


def long_tail(word: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(two bytes before, byte) for what a word has beyond DEPTH, its blank included."""
    data = np.frombuffer(word + b" ", np.uint8).astype(np.int64)
    return data[DEPTH - 2:-2] << 8 | data[DEPTH - 1:-1], data[DEPTH:]


def table_counts(trie: Trie) -> np.ndarray:
    """Rows (place, zeros, ones) of the hashed tables, all orders in one numbering."""
    base, rows = 0, []
    tails = [(*long_tail(w), c) for w, c in zip(trie.words, trie.c) if len(w) >= DEPTH and c]
    for order in range(3):
        context, byte, n = trie.before(order + 1), trie.byte, trie.count
        if order == 1 and tails:
            context = np.concatenate([context, *[t[0] for t in tails]])
            byte = np.concatenate([byte, *[t[1] for t in tails]])
            n = np.concatenate([n, *[np.full(len(t[1]), t[2]) for t in tails]])
        on = n > 0
        context, byte, n = context[on], byte[on], n[on]
        for j in range(8):
            at, bit = slot(order, context, (1 << j) | (byte >> (8 - j))), byte >> (7 - j) & 1
            ones, total = np.bincount(at, n * bit, 1 << TABLE_BITS[order]), np.bincount(at, n, 1 << TABLE_BITS[order])
            on = np.flatnonzero(total)
            rows.append(np.stack([base + on, total[on] - ones[on], ones[on]], axis=1).astype(np.int64))
        base += 1 << TABLE_BITS[order]
    return np.concatenate(rows)


def logit(ones, total, prior):
    """Clipped logit of (ones + prior) / (total + 2 prior)."""
    return np.clip(np.log((ones + prior) / (total - ones + prior)), -CLIP, CLIP)


def squash(x):
    return 1.0 / (1.0 + np.exp(-x))


class BitEvents:
    """Inputs, gates and outcomes of bit ``j`` of all own edges of a trie. ``without`` occurrences are taken out of the counts."""

    def __init__(self, trie: Trie, order: np.ndarray, tables: list[np.ndarray], j: int, without: int):
        node, byte, count = trie.node[order], trie.byte[order], trie.count[order]
        partial, bit = (1 << j) | (byte >> (8 - j)), byte >> (7 - j) & 1
        new = np.concatenate([[True], (node[1:] != node[:-1]) | (partial[1:] != partial[:-1])])
        group, first = np.cumsum(new) - 1, np.flatnonzero(new)
        total, ones = np.add.reduceat(count, first)[group], np.add.reduceat(count * bit, first)[group]
        mine = order < trie.own
        self.edge, self.bit = order[mine], bit[mine]
        total, ones = total[mine], ones[mine]
        drop = np.minimum(without, count[mine])
        total, ones = total - drop, ones - drop * self.bit
        x = [np.ones(len(self.edge)), logit(ones, total, 0.02)]
        for k in range(3):
            context = trie.before(k + 1)[self.edge]
            seen = tables[k][slot(k, context, partial[mine])].astype(np.float64)
            zero, one = seen[:, 0] - drop * (1 - self.bit), seen[:, 1] - drop * self.bit
            x.append(logit(np.maximum(one, 0), np.maximum(one, 0) + np.maximum(zero, 0), 0.4))
        self.x = np.stack(x, axis=1)
        level = np.minimum(np.ceil(np.log2(total + 1)).astype(np.int64), LEVELS - 1)
        sure = (ones == 0) | (ones == total)
        self.level, self.gate = level, (level * 2 + sure) * 8 + j


def fresh_weights() -> np.ndarray:
    w = np.zeros((GATES, INPUTS))
    trust = np.minimum(0.15 * (np.arange(GATES) // 16), 0.9)
    w[:, 1] = trust
    w[:, 2:] = (1 - trust)[:, None] * np.array([0.1, 0.3, 0.6])
    return w


def bins_of(mixed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The bin below a mixed logit and the share of the one above."""
    at = np.clip((mixed + CLIP) * (BINS - 1) / (2 * CLIP), 0, BINS - 1 - 1e-9)
    low = at.astype(np.int64)
    return low, at - low


def refined(mixed: np.ndarray, level: np.ndarray, adapt: np.ndarray) -> np.ndarray:
    """The mix and what the adaptive table makes of it, one to one."""
    low, share = bins_of(mixed)
    table = (1 - share) * adapt[level, low] + share * adapt[level, low + 1]
    return np.clip((squash(mixed) + table) / 2, 1e-7, 1 - 1e-7)


def learn(trie: Trie, local: np.ndarray, tables: list[np.ndarray], rounds: int = 2, together: int = 2048, rate: float = 0.02):
    """(weights, mass per gate, ones and totals of the adaptive table) after ``rounds`` online passes over this part's edges."""
    w, mass = fresh_weights(), np.zeros(GATES)
    adapt = np.zeros((2, LEVELS, BINS))
    order = np.lexsort((trie.byte, trie.node))
    local = np.concatenate([local, np.zeros(len(trie.count) - len(local))])
    rng = np.random.default_rng(11)
    for j in range(8):
        events = BitEvents(trie, order, tables, j, without=1)
        weight = local[events.edge].astype(float)
        use = np.flatnonzero(weight > 0)
        # curvature seen so far; it starts at a tenth of the gate's occurrences, so that a few heavy edges do not throw the weights
        bend = np.repeat(0.1 * np.bincount(events.gate[use], weight[use], GATES)[:, None], INPUTS, axis=1)
        for turn in range(rounds):
            walk = use[rng.permutation(len(use))]
            for i in range(0, len(walk), together):
                at = walk[i: i + together]
                x, g, y, n = events.x[at], events.gate[at], events.bit[at], weight[at]
                mixed = (x * w[g]).sum(1)
                p = squash(mixed)
                if turn == rounds - 1:  # predicted before it is learned from
                    cell, share = bins_of(mixed)
                    for cells, part in ((cell, 1 - share), (cell + 1, share)):
                        cells = events.level[at] * BINS + cells
                        adapt[0] += np.bincount(cells, n * y * part, LEVELS * BINS).reshape(LEVELS, BINS)
                        adapt[1] += np.bincount(cells, n * part, LEVELS * BINS).reshape(LEVELS, BINS)
                    mass += np.bincount(g, n, GATES)
                for k in range(INPUTS):
                    bend[:, k] += np.bincount(g, n * p * (1 - p) * x[:, k] ** 2, GATES)
                    step = np.bincount(g, n * (y - p) * x[:, k], GATES)
                    w[:, k] += step / np.maximum(INPUTS * bend[:, k], 1e-9)
    return w, mass, adapt[0], adapt[1]


def word_scores(trie: Trie, tables: list[np.ndarray], w: np.ndarray, adapt: np.ndarray) -> np.ndarray:
    """log10 probability of each word with its blank."""
    order = np.lexsort((trie.byte, trie.node))
    cost = np.zeros(trie.own)
    for j in range(8):
        e = BitEvents(trie, order, tables, j, without=0)
        mixed = (e.x * w[e.gate]).sum(1)
        p = refined(mixed, e.level, adapt)
        cost[e.edge] += np.log10(np.where(e.bit == 1, p, 1 - p))
    out, every = np.zeros(len(trie.words)), np.arange(len(trie.words))
    for k in range(DEPTH):
        at = trie.edge_at[k][np.searchsorted(trie.starts[k + 1], every, side="right") - 1]
        here = (trie.length > k) & (at >= 0)
        out[here] += cost[at[here]]
    for i, word in enumerate(trie.words):
        if len(word) >= DEPTH:
            context, byte = long_tail(word)
            for j in range(8):
                seen = tables[1][slot(1, context, (1 << j) | (byte >> (8 - j)))].astype(float) + 0.4
                out[i] += np.log10(seen[np.arange(len(byte)), byte >> (7 - j) & 1] / seen.sum(1)).sum()
    return out


def _sorted(pdf: pd.DataFrame) -> Trie:
    pdf = pdf.sort_values("token", kind="stable")
    return Trie(list(pdf["token"]), pdf["c"].to_numpy(np.int64))


def score_types(types: DataFrame) -> DataFrame:
    """(token, c, logp, gain) of all types: the model is trained on them and applied to them. ``gain`` packs log10 P(class | word) / P(class)."""
    spark = types.sparkSession
    parts = max(1, -(-types.count() // PART_TYPES))
    types = staged(types.repartitionByRange(parts, "token").withColumn("part", F.spark_partition_id()), "types")

    def survey(pdf: pd.DataFrame) -> pd.DataFrame:
        trie = _sorted(pdf)
        name = {v: k for k, v in trie.rim().items()}
        at = np.flatnonzero(np.isin(trie.node, list(name)))
        rim = pd.DataFrame({"part": pdf["part"].iloc[0], "prefix": [name[int(x)] for x in trie.node[at]], "place": trie.byte[at],
                            "zero": trie.count[at], "one": 0})
        counts = table_counts(trie)
        return pd.concat([rim, pd.DataFrame({"part": -1, "prefix": None, "place": counts[:, 0], "zero": counts[:, 1], "one": counts[:, 2]})])

    plain = types.select("part", "token", "c")
    found = staged(plain.groupBy("part").applyInPandas(survey, "part int, prefix binary, place long, zero long, one long"), "survey")
    rim = found.where("part >= 0")
    total = rim.groupBy("prefix", "place").agg(F.sum("zero").alias("total"))
    bounds = staged(rim.select("part", "prefix").distinct().join(total, "prefix"), "bounds")

    sums = found.where("part < 0").groupBy("place").agg(F.sum("zero").alias("zero"), F.sum("one").alias("one")).toPandas()  # at most the tables' places
    flat = np.zeros((sum(1 << b for b in TABLE_BITS), 2), np.float32)
    flat[sums["place"].to_numpy()] = sums[["zero", "one"]].to_numpy()
    tables = spark.sparkContext.broadcast(np.split(flat, np.cumsum([1 << b for b in TABLE_BITS])[:-1]))
    del flat, sums

    def prepared(pdf: pd.DataFrame, rim: pd.DataFrame):
        trie = _sorted(pdf)
        return trie, trie.widen(list(rim["prefix"]), list(rim["place"]), list(rim["total"]))

    def train(pdf: pd.DataFrame, rim: pd.DataFrame) -> pd.DataFrame:
        if not len(pdf) or not pdf["c"].any():
            return pd.DataFrame({"part": pd.Series(dtype="int32"), "value": pd.Series(dtype=object)})
        w, mass, ones, seen = learn(*prepared(pdf, rim), tables.value)
        value = np.concatenate([(w * mass[:, None]).ravel(), mass, ones.ravel(), seen.ravel()])
        return pd.DataFrame({"part": [int(pdf["part"].iloc[0])], "value": [value.tobytes()]})

    def total(pdf: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"value": [sum(np.frombuffer(v) for v in pdf["value"]).tobytes()]})

    pair = plain.groupBy("part").cogroup(bounds.groupBy("part"))
    # one row of sums per part, added up in up to 64 tasks and then here
    learned = pair.applyInPandas(train, "part int, value binary").groupBy(F.pmod("part", F.lit(64))).applyInPandas(total, "value binary").collect()
    value = sum((np.frombuffer(bytes(r["value"])) for r in learned), np.zeros(GATES * (INPUTS + 1) + 2 * LEVELS * BINS))
    w, mass, ones, seen = np.split(value, np.cumsum([GATES * INPUTS, GATES, LEVELS * BINS]))
    w = np.where(mass[:, None] > 0, w.reshape(GATES, INPUTS) / np.maximum(mass, 1)[:, None], fresh_weights())
    middle = squash(np.linspace(-CLIP, CLIP, BINS))
    adapt = (ones.reshape(LEVELS, BINS) + 20 * middle) / (seen.reshape(LEVELS, BINS) + 20)

    names = [f"k{k}" for k in range(CLASSES)]
    share = class_shares(types)

    def score(pdf: pd.DataFrame, rim: pd.DataFrame) -> pd.DataFrame:
        if not len(pdf):
            return pd.DataFrame({"token": pd.Series(dtype=object), "c": pd.Series(dtype="int64"), "logp": pd.Series(dtype="float64"), "gain": pd.Series(dtype=object)})
        trie, _ = prepared(pdf, rim)
        by = pdf.sort_values("token", kind="stable")[names].to_numpy(float)
        gain = np.log10((by + 0.5 * share) / (by.sum(1, keepdims=True) + 0.5) / share)
        gain = np.rint(np.clip(gain, -7.9, 7.9) * STEP).astype("<i2")
        return pd.DataFrame({"token": trie.words, "c": trie.c, "logp": word_scores(trie, tables.value, w, adapt), "gain": [g.tobytes() for g in gain]})

    whole = types.groupBy("part").cogroup(bounds.groupBy("part"))
    return staged(whole.applyInPandas(score, "token binary, c long, logp double, gain binary"), "scored-types")


def class_shares(types: DataFrame) -> np.ndarray:
    """P(class): its share of the training tokens, none quite zero."""
    n = np.array(types.agg(*[F.coalesce(F.sum(f"k{k}"), F.lit(0)) for k in range(CLASSES)]).first(), dtype=float) + 1e-3
    return n / n.sum()


def requests(documents: DataFrame) -> DataFrame:
    """Rows of blocks of documents: (block, token, postings) per distinct token, and a row per document whose token no word equals.

    A posting is a document's number in the block in the upper and the occurrences in the lower 16 bits.
    """

    def ask(batches):
        from pyspark import TaskContext

        task, blocks, ids, marks, lengths, sizes, numbers, tokens, book = TaskContext.get().partitionId(), 0, [], [], [], [], [], 0, {}

        def rows():
            nonlocal blocks, tokens
            name = task << 24 | blocks
            number = np.concatenate(numbers).astype(np.int64)
            doc = np.repeat(np.arange(len(ids)), lengths)
            key, n = np.unique(number << 16 | doc, return_counts=True)
            extra = n // 65535
            if extra.any():
                key, n = np.repeat(key, extra + 1), np.concatenate([[65535] * e + [r] for e, r in zip(extra, n % 65535)])
            post = ((key & 0xFFFF) << 16 | n).astype("<u4")
            cut = (np.searchsorted(key >> 16, np.arange(len(book) + 1)) * 4).astype("<i4")
            postings = pa.Array.from_buffers(pa.binary(), len(book), [None, pa.py_buffer(cut.tobytes()), pa.py_buffer(post.tobytes())])
            own = [b" %d %d" % (name, i) for i in range(len(ids))]
            empty = lambda k, t: pa.nulls(k, t)
            for token, posting, who, held, size, length in (
                    (pa.array(list(book), pa.binary()), postings, empty(len(book), pa.string()), empty(len(book), pa.bool_()), *[empty(len(book), pa.int64())] * 2),
                    (pa.array(own, pa.binary()), empty(len(ids), pa.binary()), pa.array(ids, pa.string()), pa.array(marks, pa.bool_()), pa.array(lengths, pa.int64()), pa.array(sizes, pa.int64()))):
                k = len(token)
                nth = pa.array(np.arange(k) if size.null_count == 0 else np.zeros(k, np.int64), pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array(np.full(k, name), pa.int64()), token, posting, who, held, size, length, nth],
                                                 names=["block", "token", "postings", "doc_id", "held_out", "n_tokens", "n_bytes", "nth"])
            blocks, tokens = blocks + 1, 0
            for x in (ids, marks, lengths, sizes, numbers, book):
                x.clear()

        for batch in batches:
            who, held = batch.column(0).to_pylist(), batch.column(2).to_pylist()
            for i, text in enumerate(batch.column(1)):
                words = tokens_of(text.as_py())
                words.append(b"")
                for x in words:
                    if x not in book:
                        book[x] = len(book)
                numbers.append(np.fromiter(map(book.__getitem__, words), np.uint32, len(words)))
                ids.append(who[i])
                marks.append(held[i])
                lengths.append(len(words))
                sizes.append(sum(map(len, words)) + len(words))
                tokens += len(words)
                if tokens >= BLOCK_TOKENS or len(ids) == 65535:
                    yield from rows()
        if ids:
            yield from rows()

    schema = "block long, token binary, postings binary, doc_id string, held_out boolean, n_tokens long, n_bytes long, nth long"
    return documents.mapInArrow(ask, schema)


def lm_scores(documents: DataFrame, modulus: int = 10, held: int = 0) -> DataFrame:
    """Per document: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score (log10 probability) and bits_per_byte."""
    held_out = fold("doc_id", modulus) == held
    counted = staged(count_types(documents, ~held_out), "type-counts")
    scored = score_types(counted)
    size = scored.agg(F.coalesce(F.sum("c"), F.lit(0)).alias("n"), F.count(F.when(F.col("c") > 0, 1)).alias("v")).first()
    n, v = int(size["n"]), int(size["v"])
    share = class_shares(counted)
    kept = scored.select("token", "c", F.col("logp").cast("float").alias("logp"), "gain")

    asked = requests(documents.select(F.col("doc_id").cast("string").alias("doc_id"), "text", held_out.alias("held_out")))
    answered = asked.join(kept, "token", "left").drop("token")

    def add(pdf: pd.DataFrame) -> pd.DataFrame:
        docs = pdf[pdf["n_tokens"].notna()].sort_values("nth")
        hits = pdf[pdf["n_tokens"].isna()]
        post = np.frombuffer(b"".join(hits["postings"]), "<u4")
        times = np.array([len(x) // 4 for x in hits["postings"]], dtype=np.int64)
        doc, k = (post >> 16).astype(np.int64), (post & 0xFFFF).astype(float)
        c = hits["c"].to_numpy(float)
        gain = np.frombuffer(b"".join(hits["gain"]), "<i2").reshape(-1, CLASSES) / STEP
        total = lambda x: np.bincount(doc, k * np.repeat(x, times), len(docs))
        by_class = np.stack([total(gain[:, z]) for z in range(CLASSES)], axis=1) + np.log10(share)
        top = by_class.max(1, keepdims=True) if len(docs) else by_class
        kind = top[:, 0] + np.log10((10 ** (by_class - top)).sum(1)) if len(docs) else np.zeros(0)
        return pd.DataFrame({
            "doc_id": docs["doc_id"].to_numpy(), "held_out": docs["held_out"].astype(bool).to_numpy(), "n_tokens": docs["n_tokens"].astype("int64").to_numpy(),
            "n_known": np.rint(total((c > 0).astype(float))).astype(np.int64), "base_score": total(np.log10((c + 0.1) / (n + 0.1 * (v + 1)))),
            "score": total(hits["logp"].to_numpy(float)) + kind, "_bytes": docs["n_bytes"].to_numpy(float)})

    schema = StructType([StructField("doc_id", StringType()), StructField("held_out", BooleanType()), StructField("n_tokens", LongType()),
                         StructField("n_known", LongType()), StructField("base_score", DoubleType()), StructField("score", DoubleType()), StructField("_bytes", DoubleType())])
    out = answered.groupBy("block").applyInPandas(add, schema)
    return out.select(F.col("doc_id").cast(documents.schema["doc_id"].dataType).alias("doc_id"), "held_out", "n_tokens", "n_known", F.lit(n).cast("long").alias("train_tokens"),
                      "base_score", "score", (-F.col("score") / np.log10(2) / F.col("_bytes")).alias("bits_per_byte"))
