"""Exact search against all products."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from subjectloom.llm import pivot_search
from subjectloom.llm.pivot_search import top_k

SCHEMA = "vec_id long, embedding array<float>, dim int, far string"


def plain(rows, is_query, top):
    usable = []
    for i, (vec_id, v) in enumerate(rows):
        if vec_id is None or v is None or any(x is None or not np.isfinite(x) for x in v):
            continue
        steps = [int(np.floor(np.float64(np.float32(x)) * 64)) for x in v]
        usable.append((i, vec_id, steps))
    out = []
    for i, q, a in usable:
        if not is_query(q):
            continue
        found = sorted((-sum(x * y for x, y in zip(a, b, strict=True)), c, j)
                       for j, c, b in usable if j != i and len(a) == len(b))
        out += [(q, r + 1, c, -s) for r, (s, c, _) in enumerate(found[:top])]
    return sorted(out)


def run(spark, rows, top=5, **sizes):
    df = spark.createDataFrame([(i, v, 1, "x") for i, v in rows], SCHEMA)
    got = top_k(df, "vec_id", "embedding", F.col("vec_id") % 3 == 0, top, **sizes)
    assert got.columns == ["query_id", "rank", "vec_id", "score"]
    return sorted(tuple(r) for r in got.collect())


@pytest.mark.parametrize("seed", range(2))
def test_against_all_products(spark, seed):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(4, 6)) * 3
    rows = [(int(i), [float(x) for x in centres[i % 4] + rng.normal(size=6) * 0.2])
            for i in rng.permutation(150)]
    rows += [(i, rows[0][1]) for i in range(200, 230)]  # equal vectors, so ties
    got = run(spark, rows, query_block=20, candidate_block=40, pivots=5)
    assert got == plain(rows, lambda i: i % 3 == 0, 5)


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 2.0]), (3, [-1.0, 0.5]), (1, [1.0, 2.0]), (2, None), (6, [nan, 1.0]),
            (9, [inf, 1.0]), (12, [None, 1.0]), (None, [1.0, 1.0]), (15, [1.0]), (18, []),
            (21, []), (4, [1e12, 1e3]), (3, [0.25, 0.25]), (24, [0.0, 0.0])]
    assert run(spark, rows) == plain(rows, lambda i: i % 3 == 0, 5)
    assert run(spark, []) == []
    assert run(spark, [(3, [1.0])]) == []


def test_bounds_rule_candidates_out(monkeypatch):
    import pandas as pd

    rng = np.random.default_rng(0)
    near = rng.integers(-2, 3, (50, 8)) + 100
    vectors = np.vstack([near, rng.integers(-2, 3, (4000, 8))])
    far = pivot_search._distances(vectors, vectors[[0, 60, 61]])
    rows = pd.DataFrame({
        "row_key": range(len(vectors)), "vec_id": range(len(vectors)), "vector": list(vectors),
        "square": (vectors**2).sum(1).astype(float), "far": list(far)})
    seen = []
    real = pivot_search._scores
    monkeypatch.setattr(pivot_search, "_scores", lambda q, x: seen.append(len(x)) or real(q, x))
    got = pivot_search.best_of_block(rows.iloc[:1], rows, 10)
    want = np.argsort(-(vectors[1:] @ vectors[0]), kind="stable")[:10] + 1
    assert got["vec_id"].tolist() == want.tolist()
    assert sum(seen) < 300


def test_products_beyond_doubles():
    import pandas as pd

    big = 2**29
    vectors = np.array([[big + 1, big], [big, big + 3], [big + 2, big - 1], [1, 1]])
    rows = pd.DataFrame({
        "row_key": range(4), "vec_id": range(4), "vector": list(vectors),
        "square": (vectors.astype(float)**2).sum(1), "far": [np.zeros(0, np.float32)] * 4})
    got = pivot_search.best_of_block(rows.iloc[:1], rows, 3)
    want = sorted(((-int(a) * (big + 1) - int(b) * big, i) for i, (a, b) in enumerate(vectors) if i))
    assert list(zip((-got["score"]).tolist(), got["vec_id"].tolist(), strict=True)) == want


def test_columns_of_any_name(spark):
    """Names that the search itself uses belong to the caller, also in what makes a query."""
    rows = [(100 + i, [float(i), 1.0], i, i, i) for i in range(4)]
    df = spark.createDataFrame(
        rows, "_key long, v array<float>, row_key int, vec_id int, query int")
    got = top_k(df, "_key", "v", F.col("row_key") == 3, 2).collect()
    assert [(r["query_id"], r["rank"], r["vec_id"]) for r in got] == [(103, 1, 102), (103, 2, 101)]
    got = top_k(df, "_key", "v", F.col("_key") == 102, 1).collect()
    assert [(r["query_id"], r["vec_id"]) for r in got] == [(102, 103)]
