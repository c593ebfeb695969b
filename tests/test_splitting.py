import hashlib
import math
import random

import pytest
from pyspark.sql import functions as F

from subjectloom.operators import sampling as S
from subjectloom.operators import splitting as P


def order(n, seed=42):
    return sorted(range(n), key=lambda i: (hashlib.md5(f"{i}:{seed}".encode()).hexdigest(), i))


@pytest.mark.parametrize("n", [1, 7, 500, 1999])
def test_exact_sample_equals_full_sort(spark, n):
    df = spark.range(2000)
    got = {r["id"] for r in S.sample_exact(df, "id", n).collect()}
    assert got == set(order(2000)[:n])


def test_sample_edges(spark):
    df = spark.range(10)
    assert S.sample_exact(df, "id", None).count() == 10
    assert S.sample_exact(df, "id", 10).count() == 10
    assert S.sample_exact(df, "id", 99).count() == 10
    assert df.where(S.lowest(df, "id", 0, 42)).count() == 0


def test_sample_does_not_depend_on_partitions(spark):
    one = {r[0] for r in S.sample_exact(spark.range(300).repartition(1), "id", 41).collect()}
    many = {r[0] for r in S.sample_exact(spark.range(300).repartition(7), "id", 41).collect()}
    assert one == many


def test_sample_is_a_filter(spark):
    plan = S.sample_exact(spark.range(300), "id", 41)._jdf.queryExecution().toString()
    physical = plan[plan.index("== Physical Plan =="):]
    assert "Exchange" not in physical and "Sort" not in physical


def test_random_split(spark):
    rows = P.split_random(spark.range(101), "id").collect()
    val = {r["id"] for r in rows if r["split"] == "val"}
    assert val == set(order(101)[: math.ceil(0.2 * 101)])
    assert len(rows) == 101


def test_stratified_split_shares(spark):
    """One label set holds most rows; each set gives its share, none is lost."""
    labels = F.when(F.col("id") < 700, F.array(F.lit("a"))).when(
        F.col("id") < 701, F.array(F.lit("a"), F.lit("b"))
    ).otherwise(F.when(F.col("id") < 900, F.array(F.lit("b"))).otherwise(F.array(F.lit("c"))))
    df = spark.range(1003).withColumn("labels", labels)
    rows = P.split_stratified(df, "id", "labels").collect()
    assert sorted(r["id"] for r in rows) == list(range(1003))
    sizes, val = {}, {}
    for r in rows:
        key = " ".join(r["labels"])
        sizes[key] = sizes.get(key, 0) + 1
        val[key] = val.get(key, 0) + (r["split"] == "val")
    assert sum(val.values()) == math.ceil(0.2 * 1003)
    assert all(abs(val[k] - 0.2 * sizes[k]) < 1 for k in sizes)


def test_stratified_split_without_broadcast(spark, monkeypatch):
    df = spark.range(500).withColumn("labels", F.array((F.col("id") % 3).cast("string")))
    first = {tuple(r) for r in P.split_stratified(df, "id", "labels").select("id", "split").collect()}
    monkeypatch.setattr("subjectloom.operators.lookup.BROADCAST_ROWS", 0)
    again = {tuple(r) for r in P.split_stratified(df, "id", "labels").select("id", "split").collect()}
    assert first == again


def test_hash_split_moves_nothing(spark):
    df = P.split_by_hash(spark.range(5000), "id")
    share = df.where("split = 'val'").count() / 5000
    assert abs(share - 0.2) < 0.03
    summary = P.split_summary(df).first()
    assert summary["train_samples"] + summary["val_samples"] == summary["total_samples"] == 5000


def label_counts(rows):
    total, val, sets = {}, {}, {}
    for r in rows:
        for x in set(r["labels"] or []):
            total[x] = total.get(x, 0) + 1
            val[x] = val.get(x, 0) + (r["split"] == "val")
            sets.setdefault(x, set()).add(frozenset(r["labels"]))
    return total, val, {x: len(s) for x, s in sets.items()}


@pytest.mark.parametrize("max_sets", [P.MAX_SETS, 3])
def test_balanced_split(spark, max_sets):
    """Labels of rare label sets only get their validation rows, too."""
    rng = random.Random(1)
    rows = []
    for i in range(900):
        labels = ["common"] if rng.random() < 0.7 else ["common", rng.choice("abcd")]
        rows.append((i, labels, "x"))
    for i in range(40):  # eight labels of five rows, each row of a label set of its own
        rows.append((900 + i, [f"rare{i % 8}", f"own{i}"], "x"))
    rows += [(950, [], "x"), (951, None, "x"), (952, ["a", "a", "common"], "x")]
    df = spark.createDataFrame(rows, "id long, labels array<string>, stratum string")
    got = P.split_balanced(df, "id", "labels", max_sets=max_sets)
    assert got.columns == ["id", "labels", "stratum", "split"]
    got = got.collect()
    assert sorted(r["id"] for r in got) == [r[0] for r in rows]
    total, val, sets = label_counts(got)
    assert sum(r["split"] == "val" for r in got) == math.ceil(0.2 * len(rows))
    if max_sets > 3:
        for x, n in total.items():
            assert abs(val[x] - 0.2 * n) < 1 + sets[x]
            assert n < 5 or val[x] >= 1, x
        assert abs(val["common"] - 0.2 * total["common"]) < 2
        assert all(val[f"rare{i}"] == 1 for i in range(8))


@pytest.mark.parametrize("seed", range(20))
def test_balanced_quotas(seed):
    rng = random.Random(seed)
    sets = {tuple(sorted(rng.sample("abcdefgh", rng.randint(1, 4)))): rng.choice([1, 1, 2, 3, 9, 50])
            for _ in range(40)}
    sets = sorted(sets.items())
    quotas = P.balanced_quotas(sets, 0.2)
    wanted = math.ceil(0.2 * sum(n for _, n in sets) - 1e-9)
    assert sum(quotas) >= wanted
    for (labels, n), q in zip(sets, quotas, strict=True):
        assert math.floor(0.2 * n) <= q <= math.ceil(0.2 * n)
    for x in "abcdefgh":
        own = [(n, q) for (labels, n), q in zip(sets, quotas, strict=True) if x in labels]
        if sum(n for n, _ in own) >= 5:
            assert sum(q for _, q in own) >= 1
    again = P.balanced_quotas(sets, 0.2)
    assert again == quotas and P.balanced_quotas([], 0.2) == []
