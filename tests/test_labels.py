import pytest
from pyspark.sql import functions as F

from subjectloom.functions import labels as L
from subjectloom.operators import vocabulary as V

RAW = [
    ("math.CO, cs.LG;CS.lg  stat/ML", ["math.co", "cs.lg", "stat", "ml"], ["cs", "math"]),
    ("q-bio.NC", ["q-bio.nc"], []),
    (None, [], []),
    ("astro-ph|cs.AI", ["astro-ph", "cs.ai"], ["astro-ph", "cs"]),
]


def test_split_preset_and_rollup(spark):
    df = spark.createDataFrame([(r[0],) for r in RAW], "t string")
    rows = df.select(
        L.parse_labels(F.col("t")), L.subjects(F.col("t"), L.DEFAULT_CATEGORIES)
    ).collect()
    assert [(r[0], r[1]) for r in rows] == [(r[1], r[2]) for r in RAW]


@pytest.mark.parametrize("how,want", [
    ("split", ["a.b", "c", "d"]),
    ("evaluate", ["a.b", "c", "a.b", "d"]),
    ("fit", ["a.B", "c", "A.b/d"]),
    ("stored", ["a.B,", "c;A.b/d"]),
    ("count", ["a.B", "c", "A.b", "d"]),
])
def test_presets(spark, how, want):
    df = spark.createDataFrame([(" a.B, c;A.b/d ",)], "t string")
    assert df.select(L.parse_labels(F.col("t"), how)).first()[0] == want


def test_unicode_blanks(spark):
    df = spark.createDataFrame([("\u00a0cs.LG\u2003math.CO\x85",)], "t string")
    assert df.select(L.parse_labels(F.col("t"))).first()[0] == ["cs.lg", "math.co"]
    df = spark.createDataFrame([(["\u3000CS\xa0", "\u2009"],)], "t array<string>")
    assert df.select(L.parse_label_list(F.col("t"))).first()[0] == ["cs"]


def test_list_labels(spark):
    df = spark.createDataFrame([([" CS.lg ", "", None, "x"],), (None,)], "t array<string>")
    rows = [r[0] for r in df.select(L.parse_label_list(F.col("t"))).collect()]
    assert rows == [["cs.lg", "x"], []]
    assert df.select(L.parse_label_list(F.col("t"), "fit")).first()[0] == ["CS.lg", "x"]
    assert df.select(L.join_list(F.array(F.lit("a"), F.lit("b")))).first()[0] == "a;b"


def test_vectors_and_back(spark):
    df = spark.createDataFrame([(["b", "zz"],), ([],), (["a", "c"],)], "t array<string>")
    vocab = ["a", "b", "c"]
    hot = L.multi_hot(F.col("t"), vocab)
    rows = df.select(hot, L.labels_of(hot, vocab)).collect()
    assert [tuple(r) for r in rows] == [
        ([0, 1, 0], ["b"]), ([0, 0, 0], []), ([1, 0, 1], ["a", "c"])
    ]
    with pytest.raises(Exception, match="entries"):
        df.select(L.labels_of(hot, ["a", "b"])).collect()


def test_vocabularies_and_counts(spark):
    df = spark.createDataFrame([(["b", "a", "b"],), (["c", "b"],), ([],)], "labels array<string>")
    assert V.vocabulary_list(V.learn_vocabulary(df)) == ["a", "b", "c"]
    assert V.vocabulary_list(V.fixed_vocabulary(spark, ["Q", "b", "B"])) == ["b", "q"]
    assert {tuple(r) for r in V.label_counts(df).collect()} == {("a", 1), ("b", 2), ("c", 1)}
    wanted = V.label_counts_wanted(df, ["b", "x"])
    assert {tuple(r) for r in wanted.collect()} == {("b", 2), ("x", 0)}
