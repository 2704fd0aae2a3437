"""Text quality: a sparse rule ensemble over statistics of the text.

Small boosted trees on the statistics of labelled rows give candidate rules: each path from a root is a
conjunction of bounds on statistics.  A lasso logistic regression keeps few of them, and these become one
Spark column expression.  Scoring is column expressions only.

Defined results: a null or empty text has the statistics of an empty one and gets a score; null statistics do
not occur; repeated rows are scored once each; a null id is never held out and never trained on; without
training rows every score is 0.5; other columns are ignored.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import held_out, labelled, one_per_id, released, sampled, table

#: Bound on the labelled rows that the rules are fitted on.
TRAINING_ROWS = 20_000
THRESHOLD = 0.3
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def statistics(text: Column) -> dict[str, Column]:
    """Statistics of a text by name, each a finite double."""
    text = F.coalesce(text, F.lit(""))
    words = F.split(text, "[ \\n\\t\\r]+")
    n, n_words = F.length(text), F.size(words)
    count = lambda chars: n - F.length(F.translate(text, chars, ""))
    lines, sentences = F.split(text, "\n"), F.split(text, "\\. ")
    share = lambda part, whole: part.cast("double") / F.greatest(whole, F.lit(1)).cast("double")
    return {
        "chars": n.cast("double"),
        "words": n_words.cast("double"),
        "word_length": share(n, n_words),
        "distinct_words": share(F.size(F.array_distinct(words)), n_words),
        "distinct_lines": share(F.size(F.array_distinct(lines)), F.size(lines)),
        "distinct_sentences": share(F.size(F.array_distinct(sentences)), F.size(sentences)),
        "line_length": share(n, F.size(lines)),
        "sentence_length": share(n_words, F.size(sentences)),
        "upper": share(count(_UPPER), n),
        "digits": share(count("0123456789"), n),
        "exclamations": share(count("!"), n_words),
        "bars": share(count("|"), n_words),
        "symbols": share(count("#$%&*@^~<>{}[]\\+="), n_words),
        "stops": share(count("."), n_words),
        "commas": share(count(","), n_words),
    }


@dataclass(frozen=True)
class Rule:
    """A conjunction of (statistic, bound, whether above it)."""

    bounds: tuple[tuple[str, float, bool], ...]

    def holds(self, values: dict[str, np.ndarray]) -> np.ndarray:
        return np.logical_and.reduce([values[s] > b if above else values[s] <= b for s, b, above in self.bounds])

    def column(self) -> Column:
        out = F.lit(True)
        for s, b, above in self.bounds:
            out = out & ((F.col(s) > b) if above else (F.col(s) <= b))
        return out


@dataclass
class Model:
    rules: list[tuple[Rule, float]]
    intercept: float

    def column(self) -> Column:
        """The score from columns named as the statistics."""
        total = F.lit(self.intercept)
        for rule, weight in self.rules:
            total = total + rule.column().cast("double") * weight
        return 1 / (1 + F.exp(-total))


def grow(values: dict[str, np.ndarray], gradient: np.ndarray, curvature: np.ndarray, bins, depth: int, least: int):
    """(path, rows, step) of every node but the root of a second-order regression tree; leaves last."""
    nodes, todo = [], [((), np.arange(len(gradient)))]
    while todo:
        path, rows = todo.pop()
        g, h = gradient[rows], curvature[rows]
        best = (1e-6, None)
        if len(path) < depth and len(rows) >= 2 * least:
            whole = g.sum() ** 2 / (h.sum() + 1)
            for name, edges in bins.items():
                bucket = np.searchsorted(edges, values[name][rows], "left")
                size = len(edges) + 1
                gs, hs, ns = (np.cumsum(np.bincount(bucket, w, size))[:-1] for w in (g, h, np.ones(len(rows))))
                gain = gs**2 / (hs + 1) + (g.sum() - gs) ** 2 / (h.sum() - hs + 1) - whole
                gain[(ns < least) | (len(rows) - ns < least)] = 0
                if len(gain) and gain.max() > best[0]:
                    best = (gain.max(), (name, float(edges[int(gain.argmax())])))
        if path:
            nodes.append((path, rows, None if best[1] else -g.sum() / (h.sum() + 1)))
        if best[1]:
            name, edge = best[1]
            low = values[name][rows] <= edge
            todo += [((*path, (name, edge, False)), rows[low]), ((*path, (name, edge, True)), rows[~low])]
    return nodes


def fit(values: dict[str, np.ndarray], labels: np.ndarray, trees=30, depth=3, penalty=2e-3) -> Model:
    """Rules from boosted trees, weights from a lasso logistic regression by accelerated proximal steps."""
    if not len(labels):
        return Model([], 0.0)
    share = min(max(labels.mean(), 1e-3), 1 - 1e-3)
    total = np.full(len(labels), math.log(share / (1 - share)))
    bins = {n: np.unique(np.quantile(v, np.linspace(0, 1, 65)[1:-1])) for n, v in values.items()}
    rng, rules = np.random.default_rng(5), {}
    for _ in range(trees):
        chance = 1 / (1 + np.exp(-total))
        chosen = rng.random(len(labels)) < 0.7
        part = {n: v[chosen] for n, v in values.items()}
        nodes = grow(part, (chance - labels)[chosen], (chance * (1 - chance))[chosen], bins, depth, max(3, len(labels) // 500))
        for path, _, step in nodes:
            rule = Rule(path)
            rules.setdefault(rule, None)
            if step is not None:
                total += 0.3 * step * rule.holds(values)
    names = list(rules)
    if not names:
        return Model([], math.log(share / (1 - share)))
    x = np.array([r.holds(values) for r in names], float).T
    centre = x.mean(axis=0)
    scale = np.maximum(x.std(axis=0), 0.05)
    x = (x - centre) / scale
    step = 4 / (np.linalg.norm(x, 2) ** 2 / len(labels) + 1)
    w, b, seen, t = np.zeros(len(names)), math.log(share / (1 - share)), np.zeros(len(names)), 1.0
    for _ in range(400):
        error = 1 / (1 + np.exp(-(x @ seen + b))) - labels
        moved = seen - step * (x.T @ error) / len(labels)
        new = np.sign(moved) * np.maximum(np.abs(moved) - step * penalty, 0)
        b -= step * error.mean()
        later = (1 + math.sqrt(1 + 4 * t * t)) / 2
        seen, w, t = new + (t - 1) / later * (new - w), new, later
    kept = np.flatnonzero(w)
    weights = w / scale
    return Model([(names[k], float(weights[k])) for k in kept], float(b - (weights * centre).sum()))


def with_statistics(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", *[c.alias(n) for n, c in statistics(F.col("text")).items()])


def trained(docs: DataFrame, labels: DataFrame) -> Model:
    """A model from the statistics of at most ``TRAINING_ROWS`` labelled rows outside the held-out fold."""
    picked = F.broadcast(sampled(labelled(labels, "quality"), TRAINING_ROWS))
    rows = with_statistics(docs.join(picked.select("doc_id"), "doc_id", "left_semi")).join(picked, "doc_id")
    names = list(statistics(F.lit("")))
    rows = one_per_id(rows, ["order", "doc_id", "label"], names, TRAINING_ROWS).select(*names, "label").toPandas()
    model = fit({n: rows[n].to_numpy(float) for n in names}, rows["label"].to_numpy(float))
    released()
    return model


def score_quality(docs: DataFrame, model: Model) -> DataFrame:
    """One row per document: ``doc_id`` and ``score``."""
    return with_statistics(docs).select("doc_id", model.column().alias("score"))


def op1_quality(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    model = trained(docs, table(spark, sf_dir, "labels"))
    return score_quality(docs, model).select(
        "doc_id", held_out(5, 0).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted")
    )
