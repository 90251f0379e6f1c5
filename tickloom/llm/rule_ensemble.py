"""A quality classifier of rules: tree paths, lasso weights, Spark column expressions.

Text statistics are Spark columns. Small boosted trees are grown on labelled rows; each
path from a root becomes one conjunctive rule over the statistics; a logistic
regression with an L1 penalty keeps few rules; the kept rules with their weights are
compiled into one Spark column, so scoring is a projection of the scan.

Training uses at most ``TRAINING_ROWS`` labelled rows, chosen by a hash of doc_id: the
bound of what the driver holds. Labels come only from rows whose crc32(doc_id) mod 5 is
not 0. Only statistics of the text are inputs.

Rows: a null text counts as empty and is scored like one; null and repeated rows are
scored one for one; a row without doc_id counts as not held out. Without usable labels
of both classes every score is the share of good labels, or 0.5 if there is none.
Labels other than 0 and 1 and null labels are left out; of several labels of one
document the smallest counts.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

TRAINING_ROWS = 4000
FOLDS = 5
THRESHOLD = 0.3
WHITE = r"[ \t-\r]+"


def statistics(text: Column) -> dict[str, Column]:
    """Named statistics of a text, all as double columns; an empty text has zeros."""
    whole = F.coalesce(text, F.lit(""))
    words = F.filter(F.split(whole, WHITE), lambda w: w != "")
    lines = F.filter(F.split(whole, "\n"), lambda x: F.trim(x) != "")
    n_chars, n_words, n_lines = F.length(whole), F.size(words), F.size(lines)

    def share(part: Column, whole: Column) -> Column:
        return F.when(whole > 0, part.cast("double") / whole).otherwise(0.0)

    def left_without(pattern: str) -> Column:
        return n_chars - F.length(F.regexp_replace(whole, pattern, ""))

    return {
        "log_words": F.log1p(n_words.cast("double")),
        "word_length": share(n_chars - n_words, n_words),
        "line_words": share(n_words, n_lines),
        "upper": share(left_without(r"\p{Lu}+"), n_chars),
        "digits": share(left_without(r"[0-9]+"), n_chars),
        "marks": share(left_without(r"[^\p{L}\p{N}\s.,]+"), n_chars),
        "stops": share(left_without(r"[.,]+"), n_chars),
        "distinct_words": share(F.size(F.array_distinct(words)), n_words),
        "distinct_lines": share(F.size(F.array_distinct(lines)), n_lines),
    }


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % FOLDS == 0, F.lit(False))


@dataclass(frozen=True)
class Condition:
    name: str
    above: bool
    bound: float

    def column(self, stats: dict[str, Column]) -> Column:
        return stats[self.name] > self.bound if self.above else stats[self.name] <= self.bound


Rule = tuple[Condition, ...]


@dataclass(frozen=True)
class Ensemble:
    """Kept rules with weights, an intercept; score = 1 / (1 + exp(-margin))."""

    rules: tuple[tuple[Rule, float], ...]
    intercept: float

    def column(self, stats: dict[str, Column]) -> Column:
        margin = F.lit(float(self.intercept))
        for rule, weight in self.rules:
            holds = rule[0].column(stats)
            for condition in rule[1:]:
                holds = holds & condition.column(stats)
            margin = margin + F.when(holds, float(weight)).otherwise(0.0)
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-margin))


def grow_rules(x: np.ndarray, y: np.ndarray, names: list[str], trees: int = 30, depth: int = 3, bins: int = 24, rate: float = 0.3) -> list[Rule]:
    """Paths of small trees fitted one after another to the rest of the logistic loss."""
    cuts = [np.unique(np.quantile(x[:, k], np.linspace(0, 1, bins + 1)[1:-1])) for k in range(x.shape[1])]
    coded = np.stack([np.searchsorted(c, x[:, k], side="left") for k, c in enumerate(cuts)], axis=1)
    margin, found = np.zeros(len(y)), {}
    for _ in range(trees):
        p = 1 / (1 + np.exp(-margin))
        gradient, weight = y - p, p * (1 - p) + 1e-6
        step = np.zeros(len(y))
        level: list[tuple[np.ndarray, Rule]] = [(np.arange(len(y)), ())]
        for _ in range(depth):
            deeper = []
            for rows, path in level:
                best = (1e-3, None, 0)
                g, h = gradient[rows].sum(), weight[rows].sum()
                for k, c in enumerate(cuts):
                    if not len(c):
                        continue
                    gs = np.cumsum(np.bincount(coded[rows, k], gradient[rows], len(c) + 1))[:-1]
                    hs = np.cumsum(np.bincount(coded[rows, k], weight[rows], len(c) + 1))[:-1]
                    ns = np.cumsum(np.bincount(coded[rows, k], minlength=len(c) + 1))[:-1]
                    gain = gs**2 / (hs + 1) + (g - gs) ** 2 / (h - hs + 1) - g**2 / (h + 1)
                    gain[(ns < 8) | (len(rows) - ns < 8)] = 0
                    at = int(np.argmax(gain))
                    if gain[at] > best[0]:
                        best = (gain[at], k, at)
                if best[1] is None:
                    continue
                _, k, at = best
                low = coded[rows, k] <= at
                for side, above in ((rows[low], False), (rows[~low], True)):
                    longer = (*path, Condition(names[k], above, float(cuts[k][at])))
                    found.setdefault(longer, None)
                    step[side] = gradient[side].sum() / (weight[side].sum() + 1)
                    deeper.append((side, longer))
            level = deeper
        margin += rate * step
    return list(found)


def holds(rule: Rule, x: np.ndarray, names: list[str]) -> np.ndarray:
    out = np.ones(len(x), dtype=bool)
    for c in rule:
        values = x[:, names.index(c.name)]
        out &= values > c.bound if c.above else values <= c.bound
    return out


def lasso(rules: list[Rule], x: np.ndarray, y: np.ndarray, names: list[str], penalty: float = 2e-3, rounds: int = 600) -> Ensemble:
    """Logistic weights of the rules under an L1 penalty, by accelerated proximal steps."""
    z = np.stack([holds(r, x, names) for r in sorted(rules, key=len)], axis=1)
    z, first = np.unique(z, axis=1, return_index=True)  # of rules that hold for the same rows the shortest
    rules, z = [sorted(rules, key=len)[k] for k in first], z.astype(np.float64)
    mean = z.mean(axis=0)
    z -= mean
    rate = 4 * len(y) / (np.linalg.norm(z, 2) ** 2 + len(y))
    share = min(max(y.mean(), 1e-3), 1 - 1e-3)
    b0 = ahead0 = float(np.log(share / (1 - share)))
    w = ahead = np.zeros(len(rules))
    t = 1.0
    for _ in range(rounds):
        rest = y - 1 / (1 + np.exp(-(z @ ahead + ahead0)))
        moved = ahead + rate * (z.T @ rest) / len(y)
        new = np.sign(moved) * np.maximum(np.abs(moved) - rate * penalty, 0)
        new0 = ahead0 + rate * rest.mean()
        t_new = (1 + np.sqrt(1 + 4 * t * t)) / 2
        ahead, ahead0 = new + (t - 1) / t_new * (new - w), new0 + (t - 1) / t_new * (new0 - b0)
        w, b0, t = new, new0, t_new
    kept = np.flatnonzero(np.abs(w) > 1e-6)
    return Ensemble(tuple((rules[k], float(w[k])) for k in kept), float(b0 - mean @ w))


def training_rows(docs: DataFrame, labels: DataFrame, limit: int = TRAINING_ROWS) -> DataFrame:
    """Statistics and label of a bounded, repeatable choice of labelled rows."""
    usable = (
        labels.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("quality").cast("int").alias("quality"))
        .filter(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
        .groupBy("doc_id").agg(F.min("quality").alias("quality"))
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(limit)
    )
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    chosen = texts.join(F.broadcast(usable), "doc_id")  # at most ``limit`` short rows
    stats = statistics(F.col("text"))
    # Rows of one document id share its label; of them the least statistics count.
    row = F.struct(*[c.alias(n) for n, c in stats.items()], F.col("quality").alias("label"))
    return chosen.groupBy("doc_id").agg(F.min(row).alias("row")).select("doc_id", "row.*")


def train(docs: DataFrame, labels: DataFrame, limit: int = TRAINING_ROWS) -> Ensemble:
    rows = sorted(training_rows(docs, labels, limit).collect(), key=lambda r: r["doc_id"])
    names = list(statistics(F.lit("")))
    x = np.array([[r[n] for n in names] for r in rows], dtype=np.float64).reshape(-1, len(names))
    y = np.array([r["label"] for r in rows], dtype=np.float64)
    if not len(y) or y.min() == y.max():
        share = (y.sum() + 1) / (len(y) + 2)
        return Ensemble((), float(np.log(share / (1 - share))))
    rules = grow_rules(x, y, names)
    return lasso(rules, x, y, names) if rules else Ensemble((), float(np.log(y.mean() / (1 - y.mean()))))


def score(docs: DataFrame, model: Ensemble, threshold: float = THRESHOLD) -> DataFrame:
    """All columns of the documents in a struct ``doc``, with score and prediction."""
    stats = statistics(F.col("text"))
    # The statistics become columns first: rules then compare doubles only.
    named = docs.select(F.struct(*docs.columns).alias("doc"), *[c.alias(n) for n, c in stats.items()])
    value = model.column({n: F.col(n) for n in stats})
    return named.select("doc", value.alias("score")).withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that the classifier accepts, with their own columns."""
    return score(docs, train(docs, labels)).filter("predicted = 1").select("doc.*")
