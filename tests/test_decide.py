import pytest
from pyspark.sql import functions as F

from subjectloom.functions import decide as D
from subjectloom.operators.ensembles import hard_vote, soft_vote, stack_models


def decide(spark, rows, rule):
    df = spark.createDataFrame([(i, r) for i, r in enumerate(rows)], "id int, s array<double>")
    return [r[0] for r in df.orderBy("id").select(rule(F.col("s"))).collect()]


def test_threshold_with_fallback(spark):
    rows = [[0.1, 0.2, 0.2], [0.4, 0.1, 0.5], [0.0, 0.0, 0.0], [0.35, 0.0, 0.0]]
    assert decide(spark, rows, D.from_probabilities) == [
        [0, 1, 0], [1, 0, 1], [1, 0, 0], [1, 0, 0]
    ]
    assert decide(spark, rows, lambda s: D.from_probabilities(s, top_k=0)) == [
        [0, 0, 0], [1, 0, 1], [0, 0, 0], [1, 0, 0]
    ]
    assert decide(spark, rows[:1], lambda s: D.from_probabilities(s, top_k=9)) == [[1, 1, 1]]


def test_other_rules(spark):
    assert decide(spark, [[-1.0, 0.0], [0.1, -3.0]], D.from_raw_scores) == [[0, 1], [1, 0]]
    assert decide(spark, [[0.5, 0.51]], D.by_default) == [[0, 1]]
    assert decide(spark, [[0.0, 0.0], [0.0, 1.0]], lambda s: D.from_hard_labels(s, 3)) == [
        [1, 0, 0], [0, 1, 0]
    ]
    assert decide(spark, [[0.2, 3.0]], lambda s: D.interactive(s, "hard")) == [[1, 1]]
    assert decide(spark, [[0.2, 0.1]], lambda s: D.interactive(s, "score", top_k=0)) == [[0, 0]]


def test_shapes(spark):
    assert decide(spark, [[0.1], [1.0, 2.0, 3.0]], lambda s: D.fit_width(s, 2)) == [
        [0.1, 0.0], [1.0, 2.0]
    ]
    assert decide(spark, [None, [0.5, 0.1]], lambda s: D.uniform_if_missing(s, 2)) == [
        [0.5, 0.5], [0.5, 0.1]
    ]
    df = spark.createDataFrame([(0,), (2,), (-1,), (7,)], "i int")
    got = [r[0] for r in df.select(D.one_hot(F.col("i"), 3)).collect()]
    assert got == [[1, 0, 0], [0, 0, 1], [1, 0, 0], [1, 0, 0]]
    assert decide(spark, [[0.0]], D.sigmoid) == [[0.5]]


def votes(spark, models):
    """One document; each model gives its labels the score 1."""
    rows = [(1, f"m{i}", [1.0 if c in m else 0.0 for c in range(3)]) for i, m in enumerate(models)]
    return spark.createDataFrame(rows, "id int, model string, scores array<double>")


@pytest.mark.parametrize("models,want", [
    ([{0}, {1}, {2}], [1, 0, 0]),
    ([{0}, {1}], [1, 0, 0]),
    ([{1}, {1}, {0, 2}], [0, 1, 0]),
    ([{1, 2}, {1, 2}, {0}], [0, 1, 1]),
])
def test_hard_vote(spark, models, want):
    assert hard_vote(votes(spark, models), "id", 3).first()["p"] == want


def test_soft_vote(spark):
    a = spark.createDataFrame([(1, [0.6, 0.1, 0.2])], "id int, scores array<double>")
    b = spark.createDataFrame([(1, [0.2, 0.1, 0.4])], "id int, scores array<double>")
    row = soft_vote(stack_models({"a": a, "b": b}, "id"), "id", 3).first()
    assert row["p"] == [1, 0, 0]
    assert [round(x, 9) for x in row["scores"]] == [0.4, 0.1, 0.3]
    alone = soft_vote(stack_models({"a": a}, "id"), "id", 3).first()
    assert alone["scores"] == [0.6, 0.1, 0.2]
