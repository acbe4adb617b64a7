"""Quality rules: base limits and a decision list learned by sequential covering.

Conditions ``statistic <= t`` or ``statistic > t`` are grown one by one on two thirds of the labelled sample (information gain of the covered
part), pruned on the last third, and kept if they are precise there; what a rule covers leaves the sample before the next is grown.
The list becomes one ordered Spark ``CASE`` over statistics of the whole text.

Defined cases: NULL and empty texts have no words, so the base limits reject them; without usable labels the list is empty and only
the base limits decide; repeated rows are judged alike; ids and further columns play no part.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskmart.llm.textstats import labelled_sample, ratios, text_counts

BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


@dataclass(frozen=True)
class Rule:
    """A conjunction of (statistic, above?, threshold) that rejects; ``precision`` as seen on the pruning part."""

    tests: tuple[tuple[str, bool, float], ...]
    precision: float

    def column(self, stats: dict[str, Column]) -> Column:
        out = F.lit(True)
        for name, above, t in self.tests:
            out = out & ((stats[name] > t) if above else (stats[name] <= t))
        return out

    def covers(self, x: np.ndarray, names: list[str]) -> np.ndarray:
        out = np.ones(len(x), bool)
        for name, above, t in self.tests:
            v = x[:, names.index(name)]
            out &= (v > t) if above else (v <= t)
        return out


def _best_test(x, bad, cuts, covered):
    """The single test with the largest FOIL gain inside ``covered``: (gain, feature, above, threshold)."""
    p0, n0 = bad[covered].sum(), (~bad[covered]).sum()
    if p0 == 0 or n0 == 0:
        return None
    base, best = np.log2(p0 / (p0 + n0)), None
    for j, at in enumerate(cuts):
        if not len(at):
            continue
        code = np.searchsorted(at, x[covered, j], side="left")
        pos = np.cumsum(np.bincount(code[bad[covered]], minlength=len(at) + 1))[:-1]
        neg = np.cumsum(np.bincount(code[~bad[covered]], minlength=len(at) + 1))[:-1]
        for above, p, n in ((False, pos, neg), (True, p0 - pos, n0 - neg)):
            gain = np.where(p > 0, p * (np.log2(np.maximum(p, 1) / np.maximum(p + n, 1)) - base), -1.0)
            k = int(np.argmax(gain))
            if gain[k] > 1e-9 and (best is None or gain[k] > best[0]):
                best = (gain[k], j, above, float(at[k]))
    return best


def learn(x: np.ndarray, bad: np.ndarray, fold: np.ndarray, names: list[str], max_rules: int = 16, max_tests: int = 4,
          min_precision: float = 0.97, min_covered: int = 3) -> list[Rule]:
    """Ordered reject rules. ``fold`` 2 prunes, 0 and 1 grow."""
    rules: list[Rule] = []
    cuts = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, 129)[1:-1])) if len(x) else np.empty(0) for j in range(len(names))]
    left = np.ones(len(x), bool)
    for _ in range(max_rules):
        grow, prune = left & (fold != 2), left & (fold == 2)
        covered, tests = grow.copy(), []
        while len(tests) < max_tests and (found := _best_test(x, bad, cuts, covered)):
            _, j, above, t = found
            tests.append((names[j], above, t))
            covered &= (x[:, j] > t) if above else (x[:, j] <= t)
        best = None
        for k in range(1, len(tests) + 1):
            hit = Rule(tuple(tests[:k]), 0.0).covers(x, names) & prune
            p, n = int((hit & bad).sum()), int((hit & ~bad).sum())
            worth = (p - n) / (p + n) if p + n else -1.0
            if p + n >= min_covered and (best is None or worth > best[0]):
                best = (worth, k, p / (p + n))
        if best is None or best[2] < min_precision:
            break
        rules.append(Rule(tuple(tests[: best[1]]), best[2]))
        left &= ~rules[-1].covers(x, names)
    return rules


def fit(documents: DataFrame, labels: DataFrame, sample: int = 20_000, **how) -> list[Rule]:
    """Rules from at most about ``sample`` labelled documents, chosen by a hash of their ids; their whole texts are counted."""
    rows = labelled_sample(documents, labels, "quality", sample).withColumn("__counts", text_counts(F.col("text")))
    stats = ratios("__counts")
    fold = F.pmod(F.xxhash64("doc_id", F.lit(3)), F.lit(3)).alias("_fold")
    got = rows.select("doc_id", "_label", fold, *[c.alias(k) for k, c in stats.items()]).toPandas()
    got = got.sort_values(["doc_id", *stats]).reset_index(drop=True)  # the same list whatever order the tasks ended in
    x = got[list(stats)].to_numpy(float).reshape(len(got), len(stats))
    return learn(x, got["_label"].to_numpy() == 0, got["_fold"].to_numpy(), list(stats), **how)


def verdict(rules: list[Rule], stats: dict[str, Column]) -> Column:
    """The number of the first rule that fires, NULL for none, as one ordered ``CASE``."""
    out = None
    for i, rule in enumerate(rules):
        out = F.when(rule.column(stats), i) if out is None else out.when(rule.column(stats), i)
    return F.lit(None).cast("int") if out is None else out.cast("int")


def judge(documents: DataFrame, rules: list[Rule], text: str = "text", min_words: int = 50, max_repeat: int = 50) -> DataFrame:
    """All columns of ``documents`` and a struct ``__quality``: the base counts, base_failed, fired (rule number) and kept."""
    counted = documents.withColumn("__counts", text_counts(F.col(text)))
    failed = (F.col("__counts.n_words") < min_words) | (100 * F.col("__counts.n_repeat_words") > max_repeat * F.col("__counts.n_words"))
    fired = verdict(rules, ratios("__counts"))
    return counted.withColumn("__quality", F.struct(
        *[F.col(f"__counts.{c}").alias(c) for c in BASE], failed.alias("base_failed"), fired.alias("fired"),
        (~failed & fired.isNull()).alias("kept"))).drop("__counts")


def quality_rules(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """Per document: doc_id, the base counts, base_failed, fired and kept."""
    narrow = documents.select("doc_id", "text")
    return judge(narrow, fit(documents, labels)).select("doc_id", "__quality.*")
