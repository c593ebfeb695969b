"""Positive-unlabelled learning: the risk, odd rows, and held-out documents."""

import zlib

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from subjectloom.llm import toxicity
from subjectloom.llm.toxicity import fit, fit_linear, score, with_labels
from subjectloom.session import fresh_path, written


def risk(w, b, p, u, prior):
    sp, su = (1 / (1 + np.exp(-(x @ w + b))) for x in (p, u))
    return prior * (1 - sp).mean() + max(0.0, su.mean() - prior * sp.mean())


def test_risk_goes_down_and_unlabelled_positives_are_found():
    rng = np.random.default_rng(0)
    toxic = lambda n: np.hstack([rng.random((n, 1)) < 0.9, rng.random((n, 9)) < 0.3])
    clean = lambda n: np.hstack([rng.random((n, 1)) < 0.01, rng.random((n, 9)) < 0.3])
    p = toxic(300).astype(np.float32)
    u = np.vstack([toxic(200), clean(800)]).astype(np.float32)
    w, b = fit_linear(p, u, 0.2)
    assert risk(w, b, p, u, 0.2) < risk(np.zeros(10), np.log(0.25), p, u, 0.2)
    flagged = u @ w + b >= 0
    assert flagged[:200].mean() > 0.8 and flagged[200:].mean() < 0.05


def test_cut():
    p, u = np.array([3.0, 2.0, -1.0, -4.0]), np.array([3.0, -1.5, -3.0, *[-5.0] * 17])
    assert toxicity.best_cut(p, u, 0.05) == -1.25
    assert toxicity.best_cut(np.array([1.0]), np.array([1.0]), 0.5) == 0.5


def test_few_positives_without_telling_words_do_not_condemn_all(spark):
    """Half of the confirmed texts look like any other text."""
    rng = np.random.default_rng(1)
    p = np.zeros((10, 6), np.float32)
    p[:5] = rng.random((5, 6)) < 0.8
    u = np.zeros((94, 6), np.float32)
    u[:2] = p[:2]
    w, b = fit_linear(p, u, 0.147)
    assert b < 0 and ((u @ w + b) >= 0).mean() < 0.1


def sample(n):
    rows = []
    for i in range(n):
        bad = i % 5 == 0
        text = f"word{i % 37} plain{i % 11} text{i % 7}" + (" Vile, nasty!" if bad else "")
        label = (1 if bad else 0) if i % 2 else None
        rows.append((i, text, label))
    return rows


def test_learns_from_positive_and_unlabelled(spark, frame):
    rows = sample(600)
    model = fit(frame(rows, "doc_id long, text string, toxic int"), "text", "toxic")
    out = score(frame([("so vile and nasty",), ("plain1 text2",), (None,), ("",), ("x " * 300_000,)],
                      "text string"), "text", model).collect()
    assert out[0]["toxicity"] > 0.5
    assert all(r["toxicity"] < 0.5 for r in out[1:])
    assert out[2]["toxicity"] == out[3]["toxicity"]


def test_each_column_counts_once():
    model = toxicity.Model(np.array([5, 9]), np.array([[1.0], [2.0]]), np.array([0.0]), 4)
    got = model.score(pd.Series(["a b c d e f g h", ""]))
    found = [set(x.tolist()) for x in toxicity._columns(pd.Series(["a b c d e f g h", ""]), 4)]
    want = [(5 in f) * 1.0 + (9 in f) * 2.0 for f in found]
    assert got.tolist() == pytest.approx([1 / (1 + np.exp(-x)) for x in want])


@pytest.mark.parametrize("rows", [[], [("a", 0), ("b", None)], [("a", 1)], [("a", 1), ("a", 1)]])
def test_without_both_kinds_all_score_the_prior(spark, frame, rows):
    model = fit(frame(rows, "text string, toxic int"), "text", "toxic", prior=0.3)
    got = score(frame([("a",), ("z",)], "text string"), "text", model).collect()
    assert [r["toxicity"] for r in got] == pytest.approx([0.3, 0.3])


def test_labels_with_nulls_and_repeats(spark, frame):
    docs = frame([(1, "a"), (1, "b"), (2, "c"), (None, "d")], "doc_id long, text string")
    labels = frame([(1, 0), (1, 1), (2, None), (None, 1), (3, 1)], "doc_id long, toxic int")
    got = with_labels(docs, "doc_id", labels, "doc_id", "toxic", "toxic")
    assert {(r["text"], r["toxic"]) for r in got.collect()} == {
        ("a", 1), ("b", 1), ("c", None), ("d", None)}


def test_scores_do_not_depend_on_held_out_labels(spark):
    docs = spark.createDataFrame([(i, t) for i, t, _ in sample(600)], "doc_id long, text string")
    keep = lambda i: zlib.crc32(str(i).encode()) % 5 != 0
    labels = [(i, x) for i, _, x in sample(600) if x is not None]
    turned = [(i, x if keep(i) else 1 - x) for i, x in labels]
    models = [toxicity.train_on_fold(docs, spark.createDataFrame(x, "doc_id long, toxic int"))
              for x in (labels, turned)]
    assert np.array_equal(models[0].columns, models[1].columns)
    assert np.array_equal(models[0].weights, models[1].weights)


def test_query_on_held_out_documents(spark):
    sf = "/root/testdata/sf0.1"
    truth = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    got = toxicity.op10_toxicity(spark, sf).collect()
    assert len(got) == 10_000
    assert all(r["predicted"] == (r["score"] >= 0.5) and 0 <= r["score"] <= 1 for r in got)
    judged = [(r["predicted"], truth[r["doc_id"]]) for r in got
              if r["held_out"] and r["doc_id"] in truth]
    caught = [p for p, t in judged if t == 1]
    clean = [p for p, t in judged if t == 0]
    assert sum(caught) / len(caught) > 0.85
    assert sum(clean) / len(clean) < 0.06


def test_texts_repeated_very_often(spark):
    """The sample is of different texts, so it holds them all where there are few."""
    import corpus_pipeline

    copies = spark.range(400_000).select(
        (F.col("id") + 1000).alias("doc_id"),
        F.concat(F.lit("plain text "), (F.col("id") % 3).cast("string")).alias("text"),
        F.lit(None).cast("int").alias("label"),
    )
    toxic = spark.range(100).select(
        F.col("id").alias("doc_id"),
        F.concat(F.lit("vile nasty "), F.col("id").cast("string")).alias("text"),
        F.lit(1).alias("label"),
    )
    rows = copies.union(toxic)
    model = fit(rows, "text", "label")
    scores = model.score(pd.Series(["vile nasty thing", "plain text 1"]))
    assert scores[0] >= 0.5 > scores[1]
    some = rows.where("doc_id < 40000")
    folder = fresh_path(spark, "repeated")
    toxic.select("doc_id", F.lit(1).alias("quality"), F.col("label").alias("toxic")).write.parquet(
        f"{folder}/labels.parquet")
    left = corpus_pipeline.without_toxic(spark, written(some.select("doc_id", "text"), "docs"), folder)
    assert left.where("doc_id < 1000").count() == 0
    assert left.count() == some.count() - 100


def test_label_column_of_the_documents_gives_way(spark, frame):
    docs = frame([(1, "own"), (2, "own")], "doc_id long, toxic string")
    labels = frame([(1, 0), (1, 1), (3, 1)], "doc_id long, toxic int")
    got = with_labels(docs, "doc_id", labels, "doc_id", "toxic", "toxic").collect()
    assert {(r["doc_id"], r["toxic"]) for r in got} == {(1, 1), (2, None)}


_ALL = 2**64 - 1


def plain_columns(text, bits):
    """Columns of a text's words and word beginnings, byte by byte."""
    out = set()
    lower = bytes(b + 32 if 65 <= b <= 90 else b for b in (text or "").encode())
    letters = bytes(b if b > 127 or chr(b).isalnum() else 32 for b in lower)
    for word in letters.split(b" "):
        for part in {word, *(word[:k] for k in toxicity.PREFIXES)} if word else ():
            x, power = 0, 1
            for b in part:
                x, power = (x + (b + 1) * power) & _ALL, power * 0x9E3779B97F4A7C15 & _ALL
            x = (x ^ x >> 30) * 0xBF58476D1CE4E5B9 & _ALL
            x = (x ^ x >> 27) * 0x94D049BB133111EB & _ALL
            out.add((x ^ x >> 31) >> 64 - bits)
    return out


def test_columns_and_scores_by_brute_force(spark, small):
    """Of all of the smallest table: the columns chosen, and every score of the query."""
    docs = spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{small}/labels.parquet")
    model = toxicity.train_on_fold(docs, labels)
    known = {r["doc_id"]: r["toxic"] for r in labels.collect()}
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    columns = {i: plain_columns(t, model.bits) for i, t in texts.items()}
    fold = [i for i in texts if zlib.crc32(str(i).encode()) % 5]
    sides = [[i for i in fold if known.get(i) == 1], [i for i in fold if known.get(i) is None]]
    counts = [{}, {}]
    for side, ids in enumerate(sides):
        for i in ids:
            for c in columns[i]:
                counts[side][c] = counts[side].get(c, 0) + 1
    (n_p, n_u), chosen = map(len, sides), []
    for c in {*counts[0], *counts[1]}:
        p, u = counts[0].get(c, 0), counts[1].get(c, 0)
        in_p, in_u, pooled = (p + 0.5) / (n_p + 1), (u + 0.5) / (n_u + 1), (p + u + 0.5) / (n_p + n_u + 1)
        sure = (in_p - in_u) / (pooled * (1 - pooled) * (1 / n_p + 1 / n_u)) ** 0.5
        if sure >= toxicity.SURE and in_p >= toxicity.LIFT * in_u:
            chosen.append((-sure, c))
    assert model.columns.tolist() == sorted(c for _, c in sorted(chosen)[: toxicity.FEATURES])
    weights = dict(zip(model.columns.tolist(), model.weights.tolist(), strict=True))
    got = {r["doc_id"]: r for r in toxicity.op10_toxicity(spark, small).collect()}
    assert set(got) == set(texts)
    for i in texts:
        sums = [float(b) for b in model.offsets]
        for c in columns[i] & set(weights):
            sums = [a + b for a, b in zip(sums, weights[c], strict=True)]
        want = sum(1 / (1 + np.exp(-x)) for x in sums) / len(sums)
        assert got[i]["score"] == pytest.approx(want, abs=1e-9)
        assert got[i]["predicted"] == (got[i]["score"] >= 0.5)
