"""Quality classifier: a sparse rule ensemble.

Shallow trees are grown on statistics of labelled texts; every path from a root to a node is a rule, the conjunction of the
path's conditions. A logistic regression with a lasso penalty weighs the rules, which leaves few of them, and the rest is
compiled into one Spark column expression. Statistics and score are built-in column expressions: scoring a table is one pass
without a shuffle and without Python.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from propgraph.llm.common import free_name, labelled_sample

#: Labelled rows to learn from, at most.
SAMPLE_ROWS = 6000
TREES = 24
DEPTH = 3
LEARNING_RATE = 0.4
LASSO = 0.002

#: Patterns whose matches are counted, per character or per word. Java syntax.
UPPER = r"\p{Lu}"
LETTER = r"\p{L}"
DIGIT = r"\p{Nd}"
SYMBOL = r"[^\p{L}\p{Nd}\s.,;:'\"!?()-]"
# Possessive, and tried at the beginning of a run only: a long line of symbols takes no longer than its length.
ODD = r"[^\p{L}\p{Nd}\s.,;:)'\"]"
ODD_END = rf"(?<!{ODD}){ODD}{{2,}}+(?=\s|$)"
STOP = r"[.!?]"
AGAIN = r"(?<!\S)(\S++) (?=\1(?!\S))"


def statistics(text: str | Column = "text") -> dict[str, Column]:
    """Statistics of a whole text, by name; all are 0 for a null or empty one and none is ever null."""
    column = F.col(text) if isinstance(text, str) else text
    t = F.coalesce(column.cast("string"), F.lit(""))
    words = F.filter(F.split(t, r"\s+"), lambda w: w != "")
    lines = F.filter(F.split(t, "\n"), lambda w: w != "")

    def count(pattern: str) -> Column:
        return F.regexp_count(t, F.lit(pattern)).cast("double")

    n_chars, n_words, n_lines = F.length(t).cast("double"), F.size(words).cast("double"), F.size(lines).cast("double")

    def per(a: Column, b: Column) -> Column:
        return a / F.greatest(b, F.lit(1.0))

    return {
        "chars": n_chars,
        "words": n_words,
        "word_length": per(n_chars, n_words),
        "letter_share": per(count(LETTER), n_chars),
        "upper_share": per(count(UPPER), n_chars),
        "digit_share": per(count(DIGIT), n_chars),
        "symbol_share": per(count(SYMBOL), n_chars),
        "symbol_ends": per(count(ODD_END), n_words),
        "sentence_words": per(n_words, count(STOP)),
        "distinct_words": per(F.size(F.array_distinct(words)).cast("double"), n_words),
        "repeated_next": per(count(AGAIN), n_words),
        "distinct_lines": per(F.size(F.array_distinct(lines)).cast("double"), n_lines),
        "line_words": per(n_words, n_lines),
    }


Condition = tuple[int, bool, float]  # statistic, True for "above", threshold


@dataclass
class RuleModel:
    """Rules over statistics with their weights; ``prior`` is the score if there is nothing to learn from."""

    names: list[str]
    rules: list[tuple[Condition, ...]] = field(default_factory=list)
    weights: list[float] = field(default_factory=list)
    bias: float = 0.0
    prior: float | None = None

    def score(self, text: str | Column = "text") -> Column:
        """The probability of label 1 as a column expression over a text."""
        if self.prior is not None:
            return F.lit(float(self.prior))
        return self.score_of(statistics(text))

    def score_of(self, columns: dict[str, Column]) -> Column:
        if self.prior is not None:
            return F.lit(float(self.prior))

        def holds(condition: Condition) -> Column:
            index, above, threshold = condition
            column = columns[self.names[index]]
            return column > threshold if above else column <= threshold

        logit = F.lit(float(self.bias))
        for rule, weight in zip(self.rules, self.weights, strict=True):
            logit = logit + F.when(reduce(lambda a, b: a & b, map(holds, rule)), float(weight)).otherwise(0.0)
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-logit))

    def score_rows(self, x: np.ndarray) -> np.ndarray:
        """The same score of rows of statistics, without Spark."""
        if self.prior is not None:
            return np.full(len(x), float(self.prior))
        return _sigmoid(rule_matrix(self.rules, x) @ np.array(self.weights) + self.bias)


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def rule_matrix(rules: list[tuple[Condition, ...]], x: np.ndarray) -> np.ndarray:
    out = np.ones((len(x), len(rules)))
    for j, rule in enumerate(rules):
        for index, above, threshold in rule:
            out[:, j] *= (x[:, index] > threshold) == above
    return out


def _cuts(x: np.ndarray, most: int = 24) -> list[np.ndarray]:
    """Per statistic, thresholds between its quantiles."""
    found = []
    for column in x.T:
        values = np.unique(np.quantile(column, np.linspace(0, 1, most + 1)))
        found.append((values[1:] + values[:-1]) / 2)
    return found


def grow(x: np.ndarray, gradient: np.ndarray, curvature: np.ndarray, cuts: list[np.ndarray], depth: int, least: int) -> list:
    """One tree on the gradient: (rule, value) for each of its nodes but the root, and whether it is a leaf."""
    nodes = []

    def gain(g: np.ndarray, h: np.ndarray) -> np.ndarray:
        return g**2 / (h + 1.0)

    def split(rows: np.ndarray, rule: tuple, level: int) -> None:
        g, h = gradient[rows], curvature[rows]
        best = (1e-9, None)
        for j, thresholds in enumerate(cuts if level < depth else []):
            for t in thresholds:
                high = x[rows, j] > t
                n = high.sum()
                if min(n, len(rows) - n) < least:
                    continue
                better = gain(g[high].sum(), h[high].sum()) + gain(g[~high].sum(), h[~high].sum()) - gain(g.sum(), h.sum())
                if better > best[0]:
                    best = (better, (j, float(t), high))
        leaf = best[1] is None
        if rule:
            nodes.append((rule, float(g.sum() / (h.sum() + 1.0)), leaf))
        if not leaf:
            j, t, high = best[1]
            split(rows[high], (*rule, (j, True, t)), level + 1)
            split(rows[~high], (*rule, (j, False, t)), level + 1)

    split(np.arange(len(x)), (), 0)
    return nodes


def fit_lasso(m: np.ndarray, y: np.ndarray, penalty: float, steps: int = 400) -> tuple[np.ndarray, float]:
    """Logistic regression with an L1 penalty on all weights but the bias, by accelerated proximal steps."""
    n, k = m.shape
    rate = 4.0 / (np.linalg.norm(m, 2) ** 2 / n + 1.0) if k else 1.0
    w, b = np.zeros(k), float(np.log((y.mean() + 1e-6) / (1 - y.mean() + 1e-6)))
    v, c, t = w.copy(), b, 1.0
    for _ in range(steps):
        error = _sigmoid(m @ v + c) - y
        new = v - rate * (m.T @ error) / n
        new = np.sign(new) * np.maximum(np.abs(new) - rate * penalty, 0)
        new_b = c - rate * error.mean()
        t_next = (1 + np.sqrt(1 + 4 * t * t)) / 2
        v, c = new + (t - 1) / t_next * (new - w), new_b + (t - 1) / t_next * (new_b - b)
        w, b, t = new, new_b, t_next
    return w, b


def fit_rules(names: list[str], x: np.ndarray, y: np.ndarray, trees: int = TREES, depth: int = DEPTH, penalty: float = LASSO) -> RuleModel:
    """Grow trees by gradient boosting, take their paths as rules and weigh them with the lasso."""
    if not len(y):
        return RuleModel(names, prior=1.0)
    if y.min() == y.max():
        return RuleModel(names, prior=float(y[0]))
    cuts, rules, seen = _cuts(x), [], set()
    z = np.full(len(y), np.log(y.mean() / (1 - y.mean())))
    least = max(3, len(y) // 200)
    for _ in range(trees):
        p = _sigmoid(z)
        nodes = grow(x, y - p, p * (1 - p), cuts, depth, least)
        for rule, value, leaf in nodes:
            if leaf:
                z += LEARNING_RATE * value * rule_matrix([rule], x)[:, 0]
            if frozenset(rule) not in seen:
                seen.add(frozenset(rule))
                rules.append(rule)
    if not rules:
        return RuleModel(names, prior=float(y.mean()))
    m = rule_matrix(rules, x)
    # Rules that hold for the same rows are one rule to the lasso: the shortest stands for them.
    shortest: dict[bytes, int] = {}
    for j in sorted(range(len(rules)), key=lambda j: (len(rules[j]), j)):
        shortest.setdefault(np.packbits(m[:, j] > 0).tobytes(), j)
    chosen = sorted(shortest.values())
    w, b = fit_lasso(m[:, chosen], y, penalty)
    kept = [(rules[j], float(a)) for j, a in zip(chosen, w, strict=True) if abs(a) > 1e-4]
    return RuleModel(names, [r for r, _ in kept], [a for _, a in kept], float(b))


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", bound: int = SAMPLE_ROWS) -> RuleModel:
    """A model of ``labels[label]`` (0 or 1) from at most ``bound`` labelled documents outside the held-out fold.

    Without labels every score is 1; if only one label occurs, every score is that label. Labels of unknown documents, null
    labels and null ids are not used. Only doc_id and text of ``docs`` are read.
    """
    stats = statistics()
    rows = labelled_sample(docs, labels, label, ["text"], bound, [c.alias(f"_s_{name}") for name, c in stats.items()])
    x = np.array([[row[f"_s_{name}"] for name in stats] for row in rows], dtype=float).reshape(len(rows), len(stats))
    return fit_rules(list(stats), x, np.array([float(row["y"] > 0) for row in rows]))


def with_score(docs: DataFrame, model: RuleModel, column: str = "score", text: str = "text") -> DataFrame:
    """``docs`` with the score of each row's text in ``column``.

    A null or empty text has the score of a text whose statistics are all 0. Very long texts are scored whole, in time that grows
    with their length. Repeated rows stay, each with the same score, and so do further columns. An empty table gives no rows.

    Statistics are computed once per row, in one struct column that is dropped again.
    """
    if model.prior is not None:
        return docs.withColumn(column, F.lit(float(model.prior)))
    used = {model.names[c[0]] for rule in model.rules for c in rule}
    stats = [c.alias(name) for name, c in statistics(text).items() if name in used] or [F.lit(0.0).alias("none")]
    held = free_name(docs, "_statistics")
    # Without the array round trip Spark would push the statistics into every rule that uses them.
    with_stats = docs.withColumn(held, F.explode(F.array(F.struct(*stats))))
    return with_stats.withColumn(column, model.score_of({name: F.col(f"{held}.{name}") for name in used})).drop(held)
