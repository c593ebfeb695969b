"""From score vectors to 0/1 label vectors.

All functions take and return array columns in vocabulary order, need no shuffle, and work
the same on batch and streaming frames.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Defaults of the decision rules.
THRESHOLD = 0.35
TOP_K = 1
PROBABILITY_CUT = 0.5


def fit_width(scores: Column, n_classes: int) -> Column:
    """Pad with zeros, or cut, to ``n_classes`` entries."""
    zeros = F.array_repeat(F.lit(0.0), n_classes)
    return F.slice(F.concat(scores, zeros), 1, n_classes)


def two_sided(score: Column) -> Column:
    """One decision value of a two-class model as a score per class."""
    return F.array(-score, score)


def sigmoid(scores: Column) -> Column:
    return F.transform(scores, lambda x: F.lit(1.0) / (F.lit(1.0) + F.exp(-x)))


def uniform_if_missing(scores: Column, n_classes: int) -> Column:
    """Rows no model could score get equal scores."""
    return F.coalesce(scores, F.array_repeat(F.lit(1.0 / n_classes), n_classes))


def one_hot(index: Column, n_classes: int) -> Column:
    """Class index to a 0/1 vector; an index out of range means class 0."""
    inside = F.when(index.between(0, n_classes - 1), index).otherwise(F.lit(0))
    return F.array(*[(inside == i).cast("int") for i in range(n_classes)])


def one_hot_or_none(index: Column, n_classes: int) -> Column:
    """The interactive form: an index out of range sets nothing."""
    return F.array(*[(index == i).cast("int") for i in range(n_classes)])


def at_least(scores: Column, threshold: float = THRESHOLD) -> Column:
    return F.transform(scores, lambda x: (x >= F.lit(float(threshold))).cast("int"))


def above(scores: Column, cut: float) -> Column:
    return F.transform(scores, lambda x: (x > F.lit(float(cut))).cast("int"))


def best_k(scores: Column, k: int) -> Column:
    """Indices of the ``k`` highest scores; equal scores go to the lower index."""
    if k <= 0:
        return F.array().cast("array<int>")
    ranked = F.array_sort(F.transform(scores, lambda x, i: F.struct((-x).alias("a"), i.alias("i"))))
    return F.transform(F.slice(ranked, 1, k), lambda r: r["i"])


def fill_empty(decided: Column, scores: Column, top_k: int = TOP_K) -> Column:
    """Rows without any positive get their ``top_k`` best scores; ``top_k=0`` leaves them."""
    if top_k <= 0:
        return decided
    best = best_k(scores, top_k)
    return F.when(F.array_contains(decided, 1), decided).otherwise(
        F.transform(scores, lambda _, i: F.array_contains(best, i).cast("int"))
    )


def from_probabilities(
    scores: Column, threshold: float = THRESHOLD, top_k: int = TOP_K
) -> Column:
    """Score at least ``threshold``, with the top-k fallback."""
    return fill_empty(at_least(scores, threshold), scores, top_k)


def from_raw_scores(scores: Column, top_k: int = TOP_K) -> Column:
    """Decision values: positive above zero, with the top-k fallback."""
    return fill_empty(above(scores, 0.0), scores, top_k)


def from_hard_labels(vector: Column, n_classes: int) -> Column:
    """Predicted 0/1 vectors: right width, and class 0 where nothing was predicted."""
    sized = F.transform(fit_width(vector.cast("array<double>"), n_classes), lambda x: x.cast("int"))
    first = F.array(*[F.lit(int(i == 0)) for i in range(n_classes)])
    return F.when(F.array_contains(sized, 1), sized).otherwise(first)


def by_default(probabilities: Column) -> Column:
    """Plain model prediction: probability over one half, no fallback."""
    return above(probabilities, PROBABILITY_CUT)


def interactive(
    scores: Column, kind: str, threshold: float = THRESHOLD, top_k: int = TOP_K
) -> Column:
    """The rule for one-off requests: ``hard`` vectors count above zero, anything else
    (raw scores too) is held against the threshold."""
    if kind == "hard":
        return above(scores, 0.0)
    return from_probabilities(scores, threshold, top_k)
