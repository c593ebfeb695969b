import pytest

from subjectloom.operators import metrics as M

VOCAB = ["x", "y", "z"]
ROWS = [
    ("a", [1, 0, 0], [1, 0, 0]),
    ("b", [1, 0, 0], [1, 1, 0]),
    ("c", [0, 1, 0], [0, 0, 1]),
]


@pytest.fixture(scope="module")
def df(spark):
    return spark.createDataFrame(ROWS, "id string, y array<int>, p array<int>")


def values(row, *names):
    return tuple(round(row[n], 6) for n in names)


def test_counts_per_class(df):
    rows = {r["label"]: (r["tp"], r["fp"], r["fn"], r["tn"])
            for r in M.confusion_per_class(df, VOCAB).collect()}
    assert rows == {"x": (2, 0, 0, 1), "y": (0, 1, 1, 1), "z": (0, 1, 0, 2)}


def test_averages(df):
    per_class = M.confusion_per_class(df, VOCAB)
    prf = ("precision", "recall", "f1")
    assert values(M.exact_match(df).first(), "accuracy") == (0.333333,)
    assert values(M.macro(per_class).first(), *prf) == (0.333333, 0.333333, 0.333333)
    assert values(M.micro(per_class).first(), *prf) == (0.5, 0.666667, 0.571429)
    assert values(M.hamming(per_class).first(), "hamming_loss") == (0.333333,)


def test_report(df):
    rows = {r["label"]: r for r in M.classification_report(df, VOCAB).collect()}
    assert values(rows["x"], "precision", "recall", "f1") == (1.0, 1.0, 1.0)
    assert rows["x"]["support"] == 2 and rows["z"]["support"] == 0
    assert values(rows["weighted avg"], "precision", "recall", "f1") == (
        0.666667, 0.666667, 0.666667)
    assert values(rows["samples avg"], "precision", "recall", "f1") == (0.5, 0.666667, 0.555556)
    assert rows["micro avg"]["support"] == 3


def test_first_label_grid_and_distribution(df):
    grid = {(r[0], r[1]): r[2] for r in M.confusion_by_first(df, VOCAB).collect()}
    assert len(grid) == 9 and grid["x", "x"] == 2 and grid["y", "z"] == 1
    assert sum(grid.values()) == 3
    counts = {r[0]: (r[1], r[2]) for r in M.label_distribution(df, VOCAB).collect()}
    assert counts == {"x": (2, 2), "y": (1, 1), "z": (0, 1)}


def test_single_label(spark):
    df = spark.createDataFrame([("a", "a"), ("a", "b"), ("b", "b"), ("c", "b")], "t string, p string")
    row = M.single_label_metrics(df, "t", "p").first()
    # a: P 1, R 1/2; b: P 1/3, R 1; c: P 0, R 0
    assert values(row, "accuracy", "precision", "recall", "f1") == (
        0.5, round((1 + 1 / 3) / 3, 6), 0.5, round((2 / 3 + 1 / 2) / 3, 6))


def test_nothing_to_score(spark):
    df = spark.createDataFrame([], "id string, y array<int>, p array<int>")
    assert M.confusion_per_class(df, VOCAB).count() == 0
    assert M.exact_match(df).first()["accuracy"] == 0.0


def test_alignment(spark):
    truth = spark.createDataFrame([(1, [1]), (2, [0]), (3, [1])], "id int, y array<int>")
    guess = spark.createDataFrame([(2, [0]), (3, [0]), (4, [1])], "id int, p array<int>")
    assert M.align(truth, guess, "id").count() == 2
    assert tuple(M.alignment_summary(truth, guess, "id").first()) == (2, 1, 1)


def test_models_side_by_side(spark, df):
    from pyspark.sql import functions as F

    both = df.withColumn("model", F.lit("m")).unionByName(
        df.withColumn("model", F.lit("perfect")).withColumn("p", F.col("y")))
    rows = {r["model"]: r for r in M.model_comparison(both, VOCAB).collect()}
    assert values(rows["m"], "accuracy", "f1") == (0.333333, 0.333333)
    assert values(rows["perfect"], "accuracy", "f1") == (1.0, 0.666667)
