"""SimHash near-duplicates through Golay-code fuzzy hashing.

The 64-bit fingerprint is cut into segments A and B of 23 bits and C of 18 (padded with zeros). The binary Golay code is perfect: every
23-bit word lies within 3 bits of exactly one code word. A word takes as keys the index of that code word and, where it is 3 bits away,
those of the five code words 4 bits away. Two words that differ in one bit then always share a key.

At most 3 differing bits over three segments leave two cases. Some segment is free of errors and another has at most one: the exact bits of
the one with the fuzzy keys of the other, six ordered pairs. Or each has exactly one: the fuzzy keys of A and of B with one half of
C, since one error leaves a half exact. Either way the keys have at least 30 bits, and candidates are verified on all 64.

Defined cases: a text without words (NULL, empty, blank) has fingerprint zero and links like any other; the component is named by its
smallest doc_id, NULL if it has only NULL ids; rows with equal fingerprints are one node, so copies never pair up; further columns
are ignored.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from riskmart.llm.common import ASCII_LOWER, with_key
from riskmart.llm.near import link_buckets, linked
from riskmart.session import drop_staged, staged, staged_mark

GENERATOR = 0b110001110101  # x^11 + x^10 + x^6 + x^5 + x^4 + x^2 + 1
ROW_CHUNK = 1 << 15
#: What ``keep_one`` takes for near: words of a shingle, Jaccard similarity of the shingles; and the bands and rows of its min-hashes.
SHINGLE, SIMILAR, BANDS, ROWS = 5, 0.8, 20, 4
#: Bits in which linked fingerprints differ at most; the keys find all such pairs.
MOST_BITS = 3


def remainder(word: int) -> int:
    """The word modulo the generator polynomial: zero for code words."""
    for bit in range(22, 10, -1):
        if word >> bit & 1:
            word ^= GENERATOR << (bit - 11)
    return word


def golay_tables() -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Remainders of the low 12 and the high 11 bits, and per remainder the errors that lead to its near code words and their number."""
    low = np.array([remainder(x) for x in range(1 << 12)], dtype=np.int64)
    high = np.array([remainder(x << 12) for x in range(1 << 11)], dtype=np.int64)
    errors, count = np.zeros((1 << 11, 6), np.int64), np.zeros(1 << 11, np.int64)
    for weight in range(5):
        for bits in combinations(range(23), weight):
            e = sum(1 << b for b in bits)
            r = remainder(e)
            errors[r, count[r]] = e
            count[r] += 1
    return low, high, errors, count


_TABLES: list = []


def fuzzy(segment: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, key): the 12-bit indices of the near code words of each 23-bit word."""
    if not _TABLES:
        _TABLES.extend(golay_tables())
    low, high, errors, count = _TABLES
    r = low[segment & 0xFFF] ^ high[segment >> 12]
    row = np.repeat(np.arange(len(segment)), count[r])
    nth = np.arange(len(row)) - np.repeat(np.cumsum(count[r]) - count[r], count[r])
    return row, (segment[row] ^ errors[r[row], nth]) >> 11


def keys_of(fp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, key) of all keys of signed 64-bit fingerprints; the kind of key is in the bits from 40 up."""
    word = fp.astype(np.int64).view(np.uint64)
    part = [((word >> np.uint64(s)) & np.uint64((1 << n) - 1)).astype(np.int64) for s, n in ((0, 23), (23, 23), (46, 18))]
    near = [fuzzy(p) for p in part]
    rows, keys, kind = [], [], 0
    for i in range(3):
        for j in range(3):
            if i != j:
                row, key = near[j]
                rows.append(row)
                keys.append((kind << 40) | (part[i][row] << 12) | key)
                kind += 1
    (row_a, key_a), (row_b, key_b) = near[0], near[1]
    n_b = np.bincount(row_b, minlength=len(fp))
    first_b = np.cumsum(n_b) - n_b
    row = np.repeat(row_a, n_b[row_a])
    nth = np.arange(len(row)) - np.repeat(np.cumsum(n_b[row_a]) - n_b[row_a], n_b[row_a])
    both = (np.repeat(key_a, n_b[row_a]) << 12) | key_b[first_b[row] + nth]
    for half in (part[2] & 0x1FF, part[2] >> 9):
        rows.append(row)
        keys.append((kind << 40) | (both << 9) | half[row])
        kind += 1
    return np.concatenate(rows), np.concatenate(keys)


def fingerprint_of(text: str | None) -> int:
    """Bits set in over half of the XXH64 values (seed 42) of the 3-word shingles, repeats included, as a signed 64-bit number."""
    import xxhash

    words = (text or "").encode("utf-8", "surrogatepass").translate(ASCII_LOWER).split()
    if not words:
        return 0
    line, digest = b" ".join(words), xxhash.xxh64_intdigest
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    if len(words) > 3:
        starts, ends = starts[:-2], ends[2:]
    else:
        starts, ends = [0], [len(line)]
    starts, ends = list(map(int, starts)), list(map(int, ends))
    chunks = ([digest(line[s:e], 42) for s, e in zip(starts[i: i + ROW_CHUNK], ends[i: i + ROW_CHUNK])] for i in range(0, len(starts), ROW_CHUNK))
    return majority(chunks, len(starts))


def majority(chunks: Iterable[Sequence[int]], n: int) -> int:
    """Bits set in over half of ``n`` hash values, as a signed 64-bit number; zero for none."""
    total = np.zeros(64, np.int64)
    for chunk in chunks:
        h = np.asarray(chunk, dtype="<u8")
        total += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    bits = (2 * total > n).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view("<i8")[0])


def fingerprint(text: Column) -> Column:
    @F.pandas_udf("long")
    def of(texts: pd.Series) -> pd.Series:
        return pd.Series([fingerprint_of(t) for t in texts], dtype="int64")

    return of(text)


def with_keys(nodes: DataFrame) -> DataFrame:
    """(key, node, fp, size) of nodes with their fingerprints: some 88 keys each."""

    def expand(batches):
        for pdf in batches:
            all_fp = pdf["fp"].to_numpy(np.int64)
            for i in range(0, len(all_fp), ROW_CHUNK // 8):
                row, key = keys_of(all_fp[i: i + ROW_CHUNK // 8])
                yield pdf.iloc[i + row].assign(key=key)[["key", "node", "fp", "size"]].drop_duplicates()

    return nodes.select("node", "fp", "size").mapInPandas(expand, "key long, node long, fp long, size int")


def groups(marked: DataFrame, most_bits: int = MOST_BITS) -> DataFrame:
    """(fp, root) for every distinct fingerprint of ``marked`` (fp): root names its group of linked fingerprints."""
    distinct = staged(marked.select("fp").distinct(), "fingerprints")
    nodes = distinct.select(F.col("fp").alias("node"), "fp", F.lit(0).alias("size"))
    found = linked(with_keys(nodes), nodes, most_bits).withColumnRenamed("node", "fp")
    return distinct.join(found, "fp", "left").select("fp", F.coalesce("root", "fp").alias("root"))


def near_duplicates(documents: DataFrame) -> DataFrame:
    """Per document: doc_id, fingerprint (16 hex digits) and component_id."""
    marked = staged(documents.select("doc_id", fingerprint(F.col("text")).alias("fp")), "marked")
    group = staged(groups(marked), "groups")
    smallest = marked.groupBy("fp").agg(F.min("doc_id").alias("_first")).join(group, "fp").groupBy("root").agg(F.min("_first").alias("component_id"))
    named = group.join(smallest, "root").select("fp", "component_id")
    return marked.join(named, "fp").select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def shingles_of(text: str | None, width: int = SHINGLE) -> tuple[int, np.ndarray]:
    """The hash of the words of a text, and the sorted distinct XXH64 values of its shingles; a shorter text is one shingle, a blank one has none."""
    import xxhash

    words, digest = (text or "").encode("utf-8", "surrogatepass").translate(ASCII_LOWER).split(), xxhash.xxh64_intdigest
    found = {digest(b" ".join(words[i: i + width]), 42) for i in range(max(1, len(words) - width + 1))} if words else set()
    whole = int(np.array(digest(b" ".join(words), 42), "<u8").view("<i8"))
    return whole, np.sort(np.fromiter(found, np.uint64, len(found)))


def band_keys(shingles: np.ndarray) -> list[int]:
    """One key for each band: ``ROWS`` least values of the shingles under multiplicative hashes of their own."""
    import xxhash

    if not len(shingles):
        return []
    rng = np.random.default_rng(5)
    turn = rng.integers(0, 1 << 63, (2, BANDS * ROWS), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    least = np.full(BANDS * ROWS, np.iinfo(np.uint64).max, np.uint64)
    for i in range(0, len(shingles), ROW_CHUNK // 8):
        h = shingles[i: i + ROW_CHUNK // 8, None] * turn[0]
        h = (h ^ (h >> np.uint64(31))) * turn[1]
        least = np.minimum(least, (h ^ (h >> np.uint64(29))).min(0))
    bands = least.astype("<u8").reshape(BANDS, ROWS)
    return np.array([xxhash.xxh64_intdigest(b.tobytes(), k) for k, b in enumerate(bands)], "<u8").view("<i8").tolist()


def sketch(text: Column) -> Column:
    @F.pandas_udf("node long, size int, fp long, keys array<long>")
    def of(texts: pd.Series) -> pd.DataFrame:
        both = [shingles_of(t) for t in texts]
        fp = [majority((x[i: i + ROW_CHUNK] for i in range(0, len(x), ROW_CHUNK)), len(x)) for _, x in both]
        return pd.DataFrame({"node": [n for n, _ in both], "size": [len(x) for _, x in both], "fp": fp, "keys": [band_keys(x) for _, x in both]})

    return of(text)


def shingle_set(text: Column) -> Column:
    @F.pandas_udf("array<long>")
    def of(texts: pd.Series) -> pd.Series:
        return pd.Series([shingles_of(t)[1].view(np.int64) for t in texts])

    return of(text)


def keep_one(documents: DataFrame) -> DataFrame:
    """``documents`` with one row of every group of near-duplicates: that of the smallest doc_id (NULL last), once.

    Two texts link if their sets of five-word shingles have a Jaccard similarity of ``SIMILAR`` or more; it is computed on the whole sets. Candidates
    have SimHash fingerprints of these sets within ``MOST_BITS`` bits, all of which share a key of the Golay code. At that similarity fingerprints may
    lie further apart, so candidates are also those that share one of ``BANDS`` keys of ``ROWS`` min-hashes each, which a pair of similarity 0.8 misses
    with probability 3e-5 (by calculation).
    """
    mark, keyed = staged_mark(), with_key(documents, "doc_id", "text")
    marked = staged(keyed.select("doc_id", "__k1", "__k2", sketch(F.col("text")).alias("_s")).select("doc_id", "__k1", "__k2", "_s.*"), "marked")
    best = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "__k1", "__k2")).alias("_b")
    nodes = staged(marked.groupBy("node").agg(best, F.min("size").alias("size"), F.min("fp").alias("fp"), F.min("keys").alias("keys")), "texts")

    def close(pairs: DataFrame) -> DataFrame:
        if pairs.isEmpty():
            return pairs
        wanted = pairs.select(F.col("a").alias("node")).unionByName(pairs.select(F.col("b").alias("node"))).distinct()
        at = nodes.join(wanted, "node").select("node", "_b.__k1", "_b.__k2")
        sets = keyed.select("__k1", "__k2", "text").join(at, ["__k1", "__k2"]).dropDuplicates(["node"])
        sets = staged(sets.select("node", shingle_set(F.col("text")).alias("_set")), "text-sets")
        left, right = (sets.select(F.col("node").alias(c), F.col("_set").alias(f"_set{c}")) for c in "ab")
        both = pairs.join(left, "a").join(right, "b").withColumn("_both", F.size(F.array_intersect("_seta", "_setb")))
        return both.where(F.col("_both") >= SIMILAR * (F.size("_seta") + F.size("_setb") - F.col("_both")) - 1e-9).drop("_seta", "_setb", "_both")

    golay = with_keys(nodes.where("size > 0")).select(F.xxhash64(F.lit(-1), "key").alias("key"), "node", "fp", "size")
    bands = nodes.select(F.explode("keys").alias("key"), "node", F.lit(0).cast("long").alias("fp"), "size")  # no bits to compare
    fact, bucket = F.struct("node", "fp", "size"), Window.partitionBy("key")
    shared = golay.unionByName(bands).select("key", fact.alias("_f"), F.min(fact).over(bucket).alias("hub"), F.max("node").over(bucket).alias("_last"))
    buckets = staged(shared.where("hub.node != _last").select("key", "_f.*", "hub"), "text-buckets")
    group = link_buckets(buckets, MOST_BITS, SIMILAR, close)
    firsts = nodes.join(group, "node", "left").groupBy(F.coalesce("root", "node").alias("root")).agg(F.min("_b").alias("_b"))
    firsts = staged(firsts.select("_b.__k1", "_b.__k2"), "firsts")
    drop_staged(documents.sparkSession, mark, keep=[firsts])
    # equal rows share a key; the join has dealt them out by it already
    return keyed.join(firsts, ["__k1", "__k2"]).dropDuplicates(["__k1", "__k2"]).select(*documents.columns)
