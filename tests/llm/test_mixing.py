"""Targets and systematic sampling."""

import pytest

from subjectloom.llm import mixing


def level_by_steps(sizes, weights, share, most):
    """Targets by resharing the excess until no source is above its ceiling."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    capped = set()
    while True:
        free = [s for s in names if s not in capped]
        left = share * sum(sizes.values()) - sum(most * sizes[s] for s in capped)
        total = sum(weight[s] for s in free)
        target = {s: left * weight[s] / total for s in free} if total else {}
        above = [s for s in free if target[s] > most * sizes[s] + 1e-9]
        if not above:
            return {**{s: float(most * sizes[s]) for s in capped}, **target}
        capped |= set(above)


@pytest.mark.parametrize("sizes", [
    {"a": 10, "b": 1000, "c": 20, None: 5, "d": 0}, {"a": 7}, {"z": 0, None: 0},
    {"é": 100, "z": 100, "Z": 100, "a": 3, "b": 400, "c": 1},
])
def test_targets(spark, sizes):
    df = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
    got = {r["source"]: r["target"] for r in mixing.targets(df).collect()}
    assert got == pytest.approx(level_by_steps(sizes, mixing.WEIGHTS, mixing.SHARE, mixing.MOST))


def test_odd_rows(spark, frame):
    rows = [(i % 90 or None, "w " * (i % 40), ["x", "y", None, "x"][i % 4], "k", 3)
            for i in range(400)] + [(1, None, "x", "k", 3), (1, "", None, "k", 3)]
    df = frame(rows, "doc_id long, text string, source string, row_key string, copies int")
    planned = mixing.plan(df, "doc_id", "text", "source").collect()
    assert len(planned) == len(rows)
    assert all(0 <= r["copies"] <= 2 for r in planned)
    for source in ("x", "y", None):
        own = [r for r in planned if r["source"] == source]
        taken = sum(r["copies"] * r["size"] for r in own)
        assert own[0]["source_size"] == sum(r["size"] for r in own)
        assert abs(taken - own[0]["target"]) <= 2 * max(r["size"] for r in own)
    again = mixing.plan(df, "doc_id", "text", "source").collect()
    assert sorted(map(repr, planned)) == sorted(map(repr, again))
    mixed = mixing.mix(df, "doc_id", "text", "source")
    assert mixed.columns == df.columns
    assert mixed.count() == sum(r["copies"] for r in planned)


def test_one_source_and_empty_table(spark, frame):
    schema = "doc_id long, text string, source string"
    one = frame([(i, "a b c", "s") for i in range(100)], schema)
    got = mixing.plan(one, "doc_id", "text", "source").collect()
    assert sum(r["copies"] for r in got) in (149, 150, 151)
    assert mixing.plan(one.limit(0), "doc_id", "text", "source").count() == 0
    assert mixing.mix(one.limit(0), "doc_id", "text", "source").count() == 0
