"""Language ID: multinomial naive Bayes over hashed character n-grams.

Texts are lower-cased (full Unicode), every run of non-letters is one blank, and the 1- to 3-grams of the code points are hashed into
``2**bits`` features. Counts per language are summed by Spark; the log-probability matrix (languages x features) goes to the tasks
once, where a batch is scored as a sparse product: gather the rows of its features and sum them per document.

Defined cases: NULL text or a text without a letter is ``und`` with score 0; without any labelled text all is ``und``; ties go to
the language first in the alphabet; repeated rows are answered alike.
"""

from __future__ import annotations

import re

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskmart.llm.common import below_share, fold

OTHER = re.compile(r"[\W\d_]+")
#: Characters handled at once; longer texts go through in chunks that overlap by two, so that no n-gram is lost.
CHUNK = 1 << 20


def hashed(text: str, bits: int) -> np.ndarray:
    """Feature numbers of all 1-, 2- and 3-grams of ``text``, repeats included."""
    code = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4").astype(np.uint64)
    mult, shift = np.uint64(0x9E3779B97F4A7C15), np.uint64(64 - bits)
    out, key = [], code + np.uint64(1)
    for n in (1, 2, 3):
        if n > 1:
            if len(key) < 2:
                break
            key = key[:-1] * np.uint64(0x100000001B3) + code[n - 1:]
        out.append(((key * mult) >> shift).astype(np.int64))
    return np.concatenate(out)


def chunks(text: str | None):
    """Normalised pieces of a text; none if it has no letter."""
    clean = OTHER.sub(" ", (text or "").lower()).strip()
    if any(map(str.isalpha, clean)):
        clean = f" {clean} "
        for i in range(0, max(len(clean) - 2, 1), CHUNK):
            yield clean[i: i + CHUNK + 2]


def fit(documents: DataFrame, where: Column, per_language: int = 2_000, bits: int = 16, alpha: float = 0.5):
    """(languages, log-probability matrix, log prior) from about ``per_language`` documents of each language (a documented bound)."""
    known = documents.where(where & F.col("lang").isNotNull()).select("doc_id", "text", "lang")
    sizes = {r["lang"]: r["n"] for r in known.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    languages = sorted(sizes)
    if not languages:
        return [], np.zeros((0, 1 << bits), np.float32), np.zeros(0)
    share = F.create_map(*[F.lit(v) for k in languages for v in (k, below_share(per_language / sizes[k]))])
    known = known.where(F.xxhash64("doc_id", "text", F.lit(29)) <= share[F.col("lang")])

    def count(batches):
        sums: dict[str, np.ndarray] = {}
        for pdf in batches:
            for lang, text in zip(pdf["lang"], pdf["text"]):
                for piece in chunks(text):
                    at = sums.setdefault(lang, np.zeros(1 << bits, np.int64))
                    at += np.bincount(hashed(piece, bits), minlength=1 << bits)
        for lang, at in sums.items():
            on = np.flatnonzero(at)
            yield pd.DataFrame({"lang": lang, "feature": on, "n": at[on]})

    sums = known.mapInPandas(count, "lang string, feature long, n long").groupBy("lang", "feature").agg(F.sum("n").alias("n")).toPandas()
    matrix = np.zeros((len(languages), 1 << bits))
    matrix[sums["lang"].map({k: i for i, k in enumerate(languages)}).to_numpy(int), sums["feature"].to_numpy(int)] = sums["n"].to_numpy(float)
    matrix = np.log((matrix + alpha) / (matrix.sum(1, keepdims=True) + alpha * (1 << bits)))
    total = sum(sizes.values())
    return languages, matrix.astype(np.float32), np.log([sizes[k] / total for k in languages])


def predict(texts, languages: list[str], by_feature: np.ndarray, prior: np.ndarray, bits: int = 16) -> tuple[list[str], list[float]]:
    """Most likely language and its posterior for each text. ``by_feature`` is the matrix with one row per feature."""
    names, scores = [], []
    for text in texts:
        total, any_letter = prior.astype(float).copy(), False
        for piece in chunks(text):
            any_letter = True
            counts = np.bincount(hashed(piece, bits), minlength=1 << bits) if len(piece) > 50_000 else None
            total += counts @ by_feature if counts is not None else by_feature[hashed(piece, bits)].sum(0, dtype=np.float64)
        if not any_letter or not languages:
            names.append("und")
            scores.append(0.0)
            continue
        best = int(total.argmax())
        names.append(languages[best])
        scores.append(float(1.0 / np.exp(total - total[best]).sum()))
    return names, scores


def detect(documents: DataFrame, modulus: int = 4, held: int = 2, bits: int = 16) -> DataFrame:
    """Per document: doc_id, held_out, lang_pred and score. Held-out languages teach nothing."""
    languages, matrix, prior = fit(documents, fold("doc_id", modulus) != held, bits=bits)
    shared = documents.sparkSession.sparkContext.broadcast((languages, np.ascontiguousarray(matrix.T), prior))

    @F.pandas_udf("lang_pred string, score double")
    def ask(texts: pd.Series) -> pd.DataFrame:
        names, scores = predict(texts, *shared.value, bits=bits)
        return pd.DataFrame({"lang_pred": names, "score": scores})

    asked = documents.select("doc_id", (fold("doc_id", modulus) == held).alias("held_out"), ask(F.col("text")).alias("_a"))
    return asked.select("doc_id", "held_out", "_a.lang_pred", "_a.score")
