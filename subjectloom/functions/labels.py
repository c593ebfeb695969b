"""Label strings, label sets and 0/1 label vectors as column expressions."""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column
from pyspark.sql import functions as F

from subjectloom.functions.text import SPACE, strip


class LabelFormat(NamedTuple):
    """How a delimited label string is read."""

    delimiters: str
    lower: bool
    distinct: bool


# The five ways label strings are read.
FORMATS = {
    "split": LabelFormat(rf"[,;/|]|[{SPACE}]+", lower=True, distinct=True),
    "evaluate": LabelFormat(rf"[,;/|]|[{SPACE}]+", lower=True, distinct=False),
    "fit": LabelFormat(rf"[;,{SPACE}]+", lower=False, distinct=False),
    "stored": LabelFormat(rf"[{SPACE}]+", lower=False, distinct=False),
    "count": LabelFormat(rf"[,;/|]|[{SPACE}]+", lower=False, distinct=False),
}

# The default subject categories.
DEFAULT_CATEGORIES = ("astro-ph", "cond-mat", "cs", "math", "physics")


def _tidy(items: Column, fmt: LabelFormat) -> Column:
    def clean(item: Column) -> Column:
        item = strip(item)
        return F.lower(item) if fmt.lower else item

    kept = F.filter(F.transform(items, clean), lambda x: x != "")
    return F.array_distinct(kept) if fmt.distinct else kept


def _none_to_empty(labels: Column) -> Column:
    return F.coalesce(labels, F.array().cast("array<string>"))


def parse_labels(raw: Column, how: str = "split") -> Column:
    """A delimited label string as an array; null gives an empty array."""
    fmt = FORMATS[how]
    return _none_to_empty(_tidy(F.split(raw, fmt.delimiters), fmt))


def parse_label_list(raw: Column, how: str = "evaluate") -> Column:
    """Labels that already come as an array: trimmed, blanks and nulls dropped."""
    return _none_to_empty(_tidy(raw, FORMATS[how]))


def top_level(labels: Column, lower: bool = True) -> Column:
    """``cs.LG`` -> ``cs``: each label up to its first dot, in lower case unless told not to."""
    def top(label: Column) -> Column:
        first = strip(F.substring_index(label, ".", 1))
        return F.lower(first) if lower else first

    return F.transform(labels, top)


def restrict(labels: Column, allowed: Sequence[str]) -> Column:
    """The set of labels among ``allowed``, sorted."""
    wanted = sorted({a.lower() for a in allowed})
    return F.array_sort(F.array_distinct(F.filter(labels, lambda x: x.isin(wanted))))


def subjects(raw: Column, allowed: Sequence[str], how: str = "split") -> Column:
    """Raw label string to its sorted set of allowed top-level labels."""
    return restrict(top_level(parse_labels(raw, how)), allowed)


def join_list(labels: Column) -> Column:
    """How a list label is stored next to the clean text."""
    return F.array_join(labels, ";")


def to_stored(labels: Column) -> Column:
    """How the label set is stored in the train and validation tables."""
    return F.array_join(labels, " ")


def multi_hot(labels: Column, vocabulary: Sequence[str]) -> Column:
    """0/1 vector in vocabulary order; labels outside the vocabulary are ignored."""
    return F.array(*[
        F.coalesce(F.array_contains(labels, v), F.lit(False)).cast("int") for v in vocabulary
    ])


def labels_of(vector: Column, vocabulary: Sequence[str]) -> Column:
    """0/1 vector back to labels in vocabulary order; a wrong length is an error."""
    names = F.array(*[F.lit(v) for v in vocabulary])
    wrong = F.raise_error(F.lit(f"label vector does not have {len(vocabulary)} entries"))
    return F.when(
        F.size(vector) == len(vocabulary),
        F.filter(names, lambda _, i: F.get(vector, i) == 1),
    ).otherwise(wrong)
