"""Packing token sequences by cutting-stock column generation.

1. Texts are tokenised once, per Arrow batch; each document (its ids and a closing id) is cut into full pieces of ``size`` ids and a rest.
   Only the pieces' places, lengths and checksums go on.
2. The rests are counted by length class (``grain`` ids). A linear program over patterns of classes is solved on that histogram by
   column generation: a knapsack dynamic program prices new patterns against the duals, a revised simplex step takes them in.
3. The rounded-down patterns, and first-fit patterns for what rounding leaves, are assigned to documents by their rank inside a class.

The driver sees the histogram (at most ``size / grain`` counts) and the patterns, never documents. Ranks come from staged ranges
(:func:`riskmart.llm.common.ranked`), so a length that a third of all documents share is no hot group.

Defined cases: NULL and empty texts are one piece, the closing id; repeated rows and ids are packed once per row; special-token
strings inside a text are ordinary text; a text of any length is cut; an empty table gives an empty result.
"""

from __future__ import annotations

import os
import re
import zlib
from array import array

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType
from pyspark.sql.window import Window

from riskmart.llm.common import ranked
from riskmart.session import staged

#: Fixed value: how the byte-level vocabulary cuts texts before merging.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
ODD_SPACE = re.compile(r"\s\s|\0")


class Words(dict):
    """Little-endian ids of words, with the blank in front where they have one; emptied when it would hold over ``most`` words.

    The pre-tokenizer never joins letters, digits or marks across white space, takes a blank only together with what follows it, and cuts
    between a letter and a full stop or comma. So texts without white space beside white space can be put together from their words, and
    words from their stem and their stops; only stems are remembered.
    """

    def __init__(self, path: str, most: int = 800_000):
        import json

        import tiktoken
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # the tasks are the parallelism
        super().__init__()
        self.whole = Tokenizer.from_file(path)
        self.whole.encode_special_tokens = True
        # the same vocabulary and merges for single words, at a fraction of the time per call; the tests hold its ids against the tokenizer's
        with open(path, encoding="utf-8") as f:
            vocabulary = json.load(f)["model"]["vocab"]
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
        letter = dict(zip(map(chr, plain), plain)) | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in set(plain))}
        ranks = {bytes(map(letter.__getitem__, t)): i for t, i in vocabulary.items() if all(c in letter for c in t)}
        ranks = {t: i for t, i in ranks.items() if not t.startswith(b"<|endoftext")}
        self.word = tiktoken.Encoding("words", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
        self.most = most

    def encode(self, words: list[str]) -> list[bytes]:
        return [array("I", self.word(w)).tobytes() for w in words]

    def table(self, words: set[str]) -> dict[str, bytes]:
        """The ids of these words; a small table of the words at hand is faster to search than all that is remembered."""
        stem = {w: s if (s := w.rstrip(".,")) and s[-1].isalpha() else w for w in words}
        if len(self) + len(stem) > self.most:
            self.clear()
        need = [s for s in {*stem.values(), *(w[len(s):] for w, s in stem.items())} if s not in self]
        self.update(zip(need, self.encode(need)))
        known = self.__getitem__
        return {w: known(s) if len(s) == len(w) else known(s) + known(w[len(s):]) for w, s in stem.items()}

    def ids(self, texts: list[str]) -> list[bytes]:
        """The ids of whole texts."""
        odd = {t for t in texts if ODD_SPACE.search(t)}
        odd = dict(zip(odd, self.whole.encode_batch_fast(list(odd), add_special_tokens=False)))
        split = [[] if t in odd else t.replace("\n", "\0\n\0").replace(" ", "\0 ").split("\0") for t in texts]
        known = self.table(set().union(*split)).__getitem__
        return [array("I", odd[t].ids).tobytes() if t in odd else b"".join(map(known, words)) for t, words in zip(texts, split)]


def in_parts(texts: list[str], most: int = 4_000_000):
    """(number of the first, texts) with up to ``most`` characters together, one text at least."""
    first, size = 0, 0
    for i, t in enumerate(texts):
        if i > first and size + len(t) > most:
            yield first, texts[first:i]
            first, size = i, 0
        size += len(t)
    if texts:
        yield first, texts[first:]


_WORDS: dict[str, Words] = {}


def pieces(documents: DataFrame, tokenizer: str, size: int, end: int = 0) -> DataFrame:
    """doc_id, start, length, ids_crc32, doc_tokens: full pieces of ``size`` ids and a rest for each document."""
    closing = np.array([end], dtype="<u4").tobytes()

    def cut(batches):
        words = _WORDS.setdefault(tokenizer, None) or _WORDS.__setitem__(tokenizer, Words(tokenizer)) or _WORDS[tokenizer]
        for batch in batches:
            rows, start, length, crc, total = [], [], [], [], []
            for first, texts in in_parts([t or "" for t in batch.column(1).to_pylist()]):
                for i, ids in enumerate(words.ids(texts), first):
                    ids += closing
                    n = len(ids) // 4
                    for s in range(0, n, size):
                        part = ids[4 * s: 4 * (s + size)]
                        rows.append(i)
                        start.append(s)
                        length.append(len(part) // 4)
                        crc.append(zlib.crc32(part))
                        total.append(n)
            long = lambda x: pa.array(x, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(long(rows)), long(start), long(length), long(crc), long(total)],
                names=["doc_id", "start", "length", "ids_crc32", "doc_tokens"])

    schema = StructType([documents.schema["doc_id"], *[StructField(c, LongType()) for c in ("start", "length", "ids_crc32", "doc_tokens")]])
    return documents.select("doc_id", "text").mapInArrow(cut, schema)


def _price(y: np.ndarray, capacity: int) -> tuple[float, np.ndarray]:
    """The most valuable pattern (unbounded knapsack): y[k] is the value of class k + 1, which takes k + 1 units."""
    best, choice = np.zeros(capacity + 1), np.zeros(capacity + 1, np.int64)
    for c in range(1, capacity + 1):
        value = best[c - 1 :: -1][: len(y)] + y[: min(c, len(y))]
        k = int(value.argmax())
        best[c], choice[c] = (value[k], k + 1) if value[k] > best[c - 1] else (best[c - 1], 0)
    pattern, c = np.zeros(len(y), np.int64), capacity
    while c > 0:
        if choice[c]:
            pattern[choice[c] - 1] += 1
            c -= choice[c]
        else:
            c -= 1
    return best[capacity], pattern


def column_generation(demand: np.ndarray, capacity: int, most_steps: int = 5_000) -> tuple[list[np.ndarray], np.ndarray]:
    """Patterns and their (fractional) uses that cover ``demand`` with fewest sequences in the linear program."""
    on = np.flatnonzero(demand > 0)
    if not len(on):
        return [], np.zeros(0)
    patterns = []
    for k in on:
        p = np.zeros(len(demand), np.int64)
        p[k] = capacity // (k + 1)
        patterns.append(p)
    inverse = np.diag([1.0 / p[k] for p, k in zip(patterns, on)])
    x = inverse @ demand[on].astype(float)
    for _ in range(most_steps):
        y = np.full(len(demand), -1.0)
        y[on] = inverse.sum(0)
        value, pattern = _price(y, capacity)
        if value <= 1 + 1e-9:
            break
        u = inverse @ pattern[on].astype(float)
        ratio = np.where(u > 1e-12, x / np.where(u > 1e-12, u, 1), np.inf)
        r = int(ratio.argmin())
        patterns[r] = pattern
        row = inverse[r] / u[r]
        step = ratio[r]
        inverse -= np.outer(u, row)
        inverse[r] = row
        x -= step * u
        x[r] = step
        x = np.maximum(x, 0)
    return patterns, x


def plan(demand: np.ndarray, capacity: int) -> list[tuple[np.ndarray, int]]:
    """Whole patterns with whole uses that place exactly ``demand``: the program rounded down, then first-fit decreasing for the rest."""
    left, out = demand.astype(np.int64).copy(), []
    for p, x in zip(*column_generation(demand, capacity)):
        used = p > 0
        times = min(int(np.floor(x + 1e-9)), int((left[used] // p[used]).min()) if used.any() else 0)
        if times > 0:
            out.append((p, times))
            left -= times * p
    while left.any():
        p, room = np.zeros(len(demand), np.int64), capacity
        for k in np.flatnonzero(left)[::-1]:
            p[k] = min(room // (k + 1), left[k])
            room -= p[k] * (k + 1)
        used = p > 0
        times = int((left[used] // p[used]).min())
        out.append((p, times))
        left -= times * p
    return out


def pack(documents: DataFrame, tokenizer: str, size: int = 1024, grain: int = 4) -> DataFrame:
    """Per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset. Classes round lengths up to ``grain``, so a pattern always fits."""
    classed = F.when(F.col("length") == size, 0).otherwise(F.ceil(F.col("length") / grain)).cast("int")
    cut = staged(pieces(documents, tokenizer, size).withColumn("_class", classed), "pieces")
    sizes = {r["_class"]: r["n"] for r in cut.groupBy("_class").agg(F.count("*").alias("n")).collect()}
    demand = np.array([sizes.get(k, 0) for k in range(1, size // grain + 1)], dtype=np.int64)
    first, copies, base = ([[0]] + [[] for _ in demand] for _ in range(3))
    copies[0], base[0] = [1], [0]
    sequence, taken = sizes.get(0, 0), np.zeros(len(demand), np.int64)
    for p, times in plan(demand, size // grain):
        for k in np.flatnonzero(p):
            first[k + 1].append(int(taken[k]))
            copies[k + 1].append(int(p[k]))
            base[k + 1].append(sequence)
            taken[k] += p[k] * times
        sequence += times
    tables = [tuple(np.array(t[k], dtype=np.int64) for t in (first, copies, base)) for k in range(len(first))]

    @F.pandas_udf("long")
    def sequence_of(kind: pd.Series, rank: pd.Series) -> pd.Series:
        kind, rank = kind.to_numpy(), rank.to_numpy()
        out = np.zeros(len(rank), np.int64)
        for k in np.unique(kind):
            here = np.flatnonzero(kind == k)
            start, per, seq = tables[k]
            at = np.searchsorted(start, rank[here], side="right") - 1
            out[here] = seq[at] + (rank[here] - start[at]) // per[at]
        return pd.Series(out)

    order = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
    placed = ranked(cut, ["_class"], "_rank", order).withColumn("sequence_id", sequence_of("_class", "_rank"))
    ahead = Window.partitionBy("sequence_id").orderBy(F.desc("length"), *order).rowsBetween(Window.unboundedPreceding, -1)
    return placed.withColumn("offset", F.coalesce(F.sum("length").over(ahead), F.lit(0))).select(*order, "sequence_id", "offset")
