"""Counts over whole texts, made per document inside Arrow batches (one pass, memory of one document at a time)."""

from __future__ import annotations

import re
from collections import Counter

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from riskmart.llm.common import below_share

SPACES = " \t\n\r\x0b\x0c"
SYMBOLS = b"#*$%&|<>"
STOPS = re.compile(r"[.!?]")
FIELDS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_chars", "n_upper", "n_digits",
          "n_punct", "n_distinct", "n_top", "n_same_next", "n_stops", "n_shout", "n_long")
SCHEMA = ", ".join(f"{f} long" for f in FIELDS)
_DROP_DIGITS, _DROP_PUNCT, _DROP_UPPER = b"0123456789", b"!\"'(),-./:;?@[]_{}~+=\\^`", bytes(range(65, 91))


def repeated_words(words: list) -> int:
    """Words inside 3-word windows that occur twice or more in the text, first occurrences included."""
    windows = list(zip(words, words[1:], words[2:]))
    counts = Counter(windows)
    if len(counts) == len(windows):
        return 0
    total, end = 0, 0
    for i, w in enumerate(windows):
        if counts[w] > 1:
            total += i + 3 - max(i, end)
            end = i + 3
    return total


def repeated_lines(data: bytes) -> int:
    """Lines with a word that equal an earlier line."""
    lines = [x for x in data.split(b"\n") if x.strip(b" \t\r\x0b\x0c")]
    return len(lines) - len(set(lines))


def counts_of(text: str | None) -> tuple[int, ...]:
    """The values of :data:`FIELDS`; no text has all of them zero."""
    if not text:
        return (0,) * len(FIELDS)
    data = text.encode("utf-8", "surrogatepass")
    words = data.split()
    n = len(words)
    freq = Counter(words)
    spaces = sum(text.count(c) for c in SPACES)
    without = lambda drop: len(data) - len(data.translate(None, drop))
    return (
        n, len(text) - spaces, without(SYMBOLS), repeated_lines(data), repeated_words(words), data.count(b"\n") + 1, len(text),
        without(_DROP_UPPER), without(_DROP_DIGITS), without(_DROP_PUNCT), len(freq), max(freq.values(), default=0),
        sum(map(bytes.__eq__, words, words[1:])), len(STOPS.findall(text)), data.count(b"!!"), sum(map((30).__lt__, map(len, words))))


def text_counts(text: Column) -> Column:
    """A struct of :data:`FIELDS` for a text column."""

    @F.pandas_udf(SCHEMA)
    def count(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([counts_of(x) for x in texts], columns=list(FIELDS), dtype="int64")

    return count(text)


def ratio(a: Column, b: Column) -> Column:
    """``a / b`` as a double, 0 where ``b`` is 0."""
    return F.when(b == 0, F.lit(0.0)).otherwise(a.cast("double") / F.when(b == 0, F.lit(1.0)).otherwise(b.cast("double")))


#: Size-free statistics as Spark expressions over the counts.
RATIOS = {
    "log_words": lambda c: F.log1p(c("n_words").cast("double")),
    "mean_word": lambda c: ratio(c("word_chars"), c("n_words")),
    "symbol_share": lambda c: ratio(c("n_symbols"), c("n_chars")),
    "dup_line_share": lambda c: ratio(c("n_dup_lines"), c("n_lines")),
    "repeat_share": lambda c: ratio(c("n_repeat_words"), c("n_words")),
    "words_per_line": lambda c: ratio(c("n_words"), c("n_lines")),
    "upper_share": lambda c: ratio(c("n_upper"), c("n_chars")),
    "digit_share": lambda c: ratio(c("n_digits"), c("n_chars")),
    "punct_share": lambda c: ratio(c("n_punct"), c("n_chars")),
    # logarithms, because the share of distinct words falls with the length of any text
    "variety": lambda c: ratio(F.log1p(c("n_distinct").cast("double")), F.log1p(c("n_words").cast("double"))),
    "top_share": lambda c: ratio(c("n_top"), c("n_words")),
    "same_next_share": lambda c: ratio(c("n_same_next"), c("n_words")),
    "stops_per_word": lambda c: ratio(c("n_stops"), c("n_words")),
    "shout_share": lambda c: ratio(c("n_shout"), c("n_words")),
    "long_share": lambda c: ratio(c("n_long"), c("n_words")),
}


def ratios(struct: str) -> dict[str, Column]:
    return {k: f(lambda n: F.col(f"{struct}.{n}")) for k, f in RATIOS.items()}


def labelled_sample(documents, labels, label: str, most: int, where: Column | None = None, modulus_key: str = "doc_id"):
    """At most ``most`` labelled documents (doc_id, text, label) in expectation, chosen by a hash of the id alone.

    ``most`` is a documented bound of what is learned from, never of what is scored. A document with several labels takes their
    majority, ties count as 1; NULL labels and NULL ids teach nothing; an id with several rows teaches once, with the text of the least hash, so that
    no more rows than ids come out.
    """
    known = labels.where(F.col(label).isNotNull() & F.col(modulus_key).isNotNull())
    if where is not None:
        known = known.where(where)
    known = known.groupBy(modulus_key).agg((F.avg(F.col(label).cast("double")) >= 0.5).cast("int").alias("_label"))
    total = known.count()
    share = min(1.0, most / max(total, 1))
    known = known.where(F.xxhash64(F.col(modulus_key), F.lit(17)) <= below_share(share))
    taught = documents.select("doc_id", "text").join(F.broadcast(known), "doc_id")
    return taught.groupBy("doc_id").agg(F.min(F.struct(F.xxhash64("text").alias("h"), "text")).alias("_t"), F.min("_label").alias("_label")).select("doc_id", "_t.text", "_label")
