"""Benchmark decontamination by winnowing, in DataFrame functions only.

Of every window of ``span - k + 1`` consecutive k-gram hashes (that is, of ``span`` words) the least is kept. A span of that many words that a
document shares with an item has the same hashes on both sides, so the same least one: no such span escapes. Fingerprints are joined,
each hit is extended to its windows of words, and those are held against the item's windows word by word.
Items shorter than the span are one window each and are found by the hash of all their words.

Documents cross a shuffle as ids and distinct fingerprints; words are looked at again only where a fingerprint has hit.

Defined cases: NULL, empty and blank texts have no words and are never hit; items without words, and items with NULL id, are
ignored; equal item ids count once; rows equal in id and text are one document and get the same answer; further columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskmart.llm.common import UPPER, with_key
from riskmart.session import drop_staged, staged, staged_mark

#: ASCII other than digits and letters: what separates words.
SEPARATORS = "".join(chr(c) for c in range(128) if not chr(c).isalnum())
#: Fingerprint tables of at most this many rows may be sent to every task (16 MB); larger ones are shuffled.
BROADCAST_ROWS = 1_000_000
#: Hit documents (keys and fingerprints) of at most this many bytes may be sent to every task; else the documents are shuffled to them.
BROADCAST_BYTES = 16 << 20


def words_of(text: Column) -> Column:
    """Lower-cased (A-Z) runs of letters, digits and all that is not ASCII."""
    clean = F.translate(F.coalesce(text, F.lit("")), UPPER + SEPARATORS, UPPER.lower() + " " * len(SEPARATORS))
    return F.array_remove(F.split(clean, " "), "")


def _zip(a: str, b: str, shift: int, length: Column, f) -> Column:
    """``f(a[i], b[i + shift])`` for the first ``length`` places (columns by name: each is computed once, in a projection below)."""
    n = F.greatest(length, F.lit(0))
    return F.zip_with(F.slice(F.col(a), F.lit(1), n), F.slice(F.col(b), F.lit(shift + 1), n), f)


def with_grams(df: DataFrame, sizes: list[int], hashes: str = "_h1") -> DataFrame:
    """Adds ``_h{k}`` for each size: the hashes of k consecutive words, made from the hashes of two shorter runs."""
    have = {1}

    def add(df: DataFrame, n: int) -> DataFrame:
        if n in have:
            return df
        half = 1 << ((n - 1).bit_length() - 1)
        df = add(add(df, half), n - half)
        have.add(n)
        return df.withColumn(f"_h{n}", _zip(f"_h{half}", f"_h{n - half}", half, F.size(hashes) - n + 1, lambda a, b: F.xxhash64(a, b)))

    for k in sizes:
        df = add(df, k)
    return df


def with_least(df: DataFrame, grams: str, width: int, name: str) -> DataFrame:
    """Adds ``name``: the least of every ``width`` consecutive values of ``grams``, by doubling."""
    at, have = grams, 1
    while have < width:
        step = min(have, width - have)
        to = name if have + step == width else f"_m{have + step}"
        df = df.withColumn(to, _zip(at, at, step, F.size(at) - step, lambda a, b: F.least(a, b)))
        at, have = to, have + step
    return df if at == name else df.withColumn(name, F.col(at))


def with_fingerprints(df: DataFrame, text: str, span: int, k: int, short: list[int]) -> DataFrame:
    """Adds _words, ``_least`` (one value per window of ``span`` words) and ``_s{n}`` (one per run of n words, for the lengths in ``short``)."""
    df = df.withColumn("_words", words_of(F.col(text)))
    df = df.withColumn("_h1", F.transform("_words", lambda w: F.xxhash64(w)))
    df = with_least(with_grams(df, sorted({k, *short})), f"_h{k}", span - k + 1, "_least")
    for n in short:
        df = df.withColumn(f"_s{n}", F.transform(f"_h{n}", _salted(n)))
    return df


def _salted(n: int):
    return lambda h: F.xxhash64(h, F.lit(n))


def _found_at(name: str):
    return lambda i: F.array_contains("found", F.get(name, i))


def item_windows(benchmark: DataFrame, span: int) -> DataFrame:
    """(item_id, words, window): the distinct windows of each item as blank-joined words, and how many words they have."""
    items = benchmark.where(F.col("item_id").isNotNull()).select("item_id", words_of(F.col("text")).alias("_words"))
    items = items.where(F.size("_words") > 0).withColumn("words", F.least(F.size("_words"), F.lit(span)))
    starts = F.sequence(F.lit(1), F.size("_words") - F.col("words") + 1)
    at = items.select("item_id", "words", "_words", F.explode(starts).alias("_i"))
    return staged(at.select("item_id", "words", F.array_join(F.slice("_words", F.col("_i"), F.col("words")), " ").alias("window")).distinct(), "windows")


def window_fingerprints(windows: DataFrame, span: int, k: int, short: list[int]) -> DataFrame:
    """(fp): what a document that has one of the windows must have among its fingerprints."""
    at = with_fingerprints(windows.select("words", "window").distinct(), "window", span, k, short)
    kinds = F.when(F.col("words") == span, F.element_at("_least", 1))
    for n in short:
        kinds = kinds.when(F.col("words") == n, F.element_at(f"_s{n}", 1))
    return staged(at.select(kinds.alias("fp")).distinct(), "item-fingerprints")


def occurrences(documents: DataFrame, benchmark: DataFrame, span: int, k: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(documents' ids, keys and n_words; items' windows; found): found has every place of a document where a window of an item stands."""
    windows = item_windows(benchmark, span)
    short = sorted(r["words"] for r in windows.where(F.col("words") < span).select("words").distinct().collect())  # below ``span`` values
    prints = window_fingerprints(windows, span, k, short)
    if prints.count() <= BROADCAST_ROWS:
        prints = F.broadcast(prints)

    keyed = with_key(documents.select("doc_id", "text"), "doc_id", "text")
    marked = with_fingerprints(keyed, "text", span, k, short)
    marks = F.array_distinct(F.concat("_least", *[f"_s{n}" for n in short]))
    marked = staged(marked.select("doc_id", "__k1", "__k2", F.size("_words").cast("long").alias("n_words"), marks.alias("marks")), "marked")
    hit = marked.select("__k1", "__k2", F.explode("marks").alias("fp")).join(prints, "fp")
    hit = staged(hit.groupBy("__k1", "__k2").agg(F.collect_set("fp").alias("found")), "hit")

    size = hit.agg(F.coalesce(F.sum(40 + 8 * F.size("found")), F.lit(0)).alias("n")).first()["n"]
    again = keyed.join(F.broadcast(hit) if size <= BROADCAST_BYTES else hit, ["__k1", "__k2"])
    again = with_fingerprints(again, "text", span, k, short)
    parts = []
    for name, n in [("_least", span), *[(f"_s{n}", n) for n in short]]:
        # places from 0; the one past the end has no hash and finds nothing
        starts = F.filter(F.sequence(F.lit(0), F.size(name)), _found_at(name))
        at = again.select("__k1", "__k2", "_words", F.explode(starts).alias("start"))
        parts.append(at.select("__k1", "__k2", "start", F.lit(n).alias("words"),
                               F.array_join(F.slice("_words", F.col("start") + 1, F.lit(n)), " ").alias("window")))
    candidates = parts[0]
    for p in parts[1:]:
        candidates = candidates.unionByName(p)
    known = windows.select("words", "window").distinct()
    found = staged(candidates.join(known, ["words", "window"]), "found")
    return marked.select("doc_id", "__k1", "__k2", "n_words"), windows, found


def clean(documents: DataFrame, benchmark: DataFrame, span: int = 10, k: int = 5) -> DataFrame:
    """``documents`` without those that share a window with an item."""
    mark = staged_mark()
    _, _, found = occurrences(documents, benchmark, span, k)
    hit = staged(found.select("__k1", "__k2").distinct(), "contaminated")
    drop_staged(documents.sparkSession, mark, keep=[hit])
    return with_key(documents, "doc_id", "text").join(hit, ["__k1", "__k2"], "left_anti").select(*documents.columns)


def contamination(documents: DataFrame, benchmark: DataFrame, span: int = 10, k: int = 5) -> DataFrame:
    """Per document: doc_id, n_words, n_hit, n_items, items_sha256, contaminated."""
    marked, windows, found = occurrences(documents, benchmark, span, k)
    spans = found.groupBy("__k1", "__k2").agg(F.array_sort(F.collect_set(F.struct("start", (F.col("start") + F.col("words")).alias("end")))).alias("_spans"))
    zero = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).alias("end"))
    covered = F.aggregate("_spans", zero, lambda a, x: F.struct(
        (a["n"] + F.greatest(x["end"] - F.greatest(x["start"], a["end"]), F.lit(0))).cast("long").alias("n"),
        F.greatest(a["end"], x["end"]).alias("end")))["n"]
    spans = spans.select("__k1", "__k2", covered.alias("n_hit"))
    named = found.select("__k1", "__k2", "words", "window").distinct().join(windows, ["words", "window"])
    named = named.select("__k1", "__k2", F.col("item_id").cast("string").alias("item")).distinct().groupBy("__k1", "__k2")
    named = named.agg(F.array_sort(F.collect_set("item")).alias("_items"))
    answer = spans.join(named, ["__k1", "__k2"]).select(
        "__k1", "__k2", "n_hit", F.size("_items").cast("long").alias("n_items"), F.sha2(F.array_join("_items", ","), 256).alias("items_sha256"))

    out = marked.join(answer, ["__k1", "__k2"], "left")
    n_hit = F.coalesce("n_hit", F.lit(0).cast("long"))
    return out.select("doc_id", "n_words", n_hit.alias("n_hit"), F.coalesce("n_items", F.lit(0).cast("long")).alias("n_items"),
                      F.coalesce("items_sha256", F.sha2(F.lit(""), 256)).alias("items_sha256"), (n_hit > 0).alias("contaminated"))
