"""The n-gram model against a plain reading of its formulas."""

import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from subjectloom.llm import ngram_model
from subjectloom.llm.hashing import mix
from subjectloom.llm.ngram_model import (
    blocks, discounts, forget, merged, pack_run, perplexity, score, train, unmix, unpack_run,
)

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def tokens(text):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return [*WORD.findall(lower), None]


class Plain:
    def __init__(self, texts):
        self.count, self.pair = Counter(), Counter()
        for text in texts:
            own = tokens(text)
            self.count.update(own)
            self.pair.update(zip(["<begin>", *own], own))
        self.before, self.seen, self.off = Counter(), Counter(), Counter()
        for (_, w) in self.pair:
            self.before[w] += 1
        self.d2, self.d1 = (
            discounts(tuple(sum(c == k for c in x.values()) for k in (1, 2, 3, 4)))
            for x in (self.pair, self.before)
        )
        for (v, _), c in self.pair.items():
            self.seen[v] += c
            self.off[v] += self.d2[min(c, 3) - 1]
        self.n, self.v, self.a = sum(self.count.values()), len(self.count), len(self.pair)
        self.spread = (sum(self.d1[min(a, 3) - 1] for a in self.before.values()) / self.a
                       if self.a else 1.0)

    def alone(self, w):
        a = self.before[w]
        return (max(a - self.d1[min(a, 3) - 1], 0) / self.a if a else 0) + self.spread / (self.v + 1)

    def p(self, v, w):
        if not self.seen[v]:
            return self.alone(w)
        c = self.pair[v, w]
        kept = max(c - self.d2[min(c, 3) - 1], 0) if c else 0
        return kept / self.seen[v] + self.off[v] / self.seen[v] * self.alone(w)

    def row(self, text):
        own = tokens(text)
        base = sum(math.log10((self.count[w] + 1) / (self.n + self.v + 1)) for w in own)
        full = sum(math.log10(self.p(v, w)) for v, w in zip(["<begin>", *own], own))
        return len(own), sum(w in self.count for w in own), base, full


def check(spark, learnt, scored, **sizes):
    schema = "i long, text string, score string, n_known int"
    model = train(spark.createDataFrame(
        [(i, t, "x", 1) for i, t in enumerate(learnt)], schema).repartition(3), "text", **sizes)
    plain = Plain(learnt)
    assert (model.tokens, model.words, model.pairs) == (plain.n, plain.v, plain.a)
    got = score(spark.createDataFrame(
        [(i, t, "x", 1) for i, t in enumerate(scored)], schema).repartition(3), "text", model)
    assert got.columns == ["i", "text", "n_tokens", "n_known", "base_score", "score"]
    rows = {r["i"]: r for r in got.collect()}
    assert len(rows) == len(scored)
    for i, text in enumerate(scored):
        n, known, base, full = plain.row(text)
        mine = rows[i]
        assert (mine["text"], mine["n_tokens"], mine["n_known"]) == (text, n, known)
        assert mine["base_score"] == pytest.approx(base, abs=1e-9 * n)
        assert mine["score"] == pytest.approx(full, abs=1e-9 * n)
    told = got.select("i", perplexity(got["score"], got["n_tokens"]).alias("p")).collect()
    assert all(r["p"] == pytest.approx(10 ** (-rows[r["i"]]["score"] / rows[r["i"]]["n_tokens"]))
               for r in told)
    forget(spark, model)
    return plain


@pytest.mark.parametrize("seed", range(2))
def test_against_plain_reading(spark, seed, monkeypatch):
    rng = random.Random(seed)
    pool = [f"w{i}" for i in range(80)] + ["Été", "it's"]
    weights = [1 / (i + 1) for i in range(len(pool))]

    def text():
        return rng.choice([" ", "\n", "\t "]).join(rng.choices(pool, weights, k=rng.randint(0, 60)))

    learnt = [text() for _ in range(80)]
    scored = [text() + rng.choice(["", " new", " new newer"]) for _ in range(40)] + learnt[:5]
    plain = check(spark, learnt, scored)
    assert max(plain.pair.values()) > 4
    check(spark, learnt, scored, shard_tokens=100)  # many arrays


def test_texts_that_go_on_in_the_next_block(spark, monkeypatch):
    rng = random.Random(3)
    texts = [" ".join(rng.choices("abcdefg", k=rng.choice([0, 1, 3, 40]))) for _ in range(60)]
    model = train(spark.createDataFrame([(t,) for t in texts], "text string"), "text")
    whole = ngram_model.Scorer(model).score(texts)
    for size in (1, 2, 7):
        monkeypatch.setattr(ngram_model, "BLOCK", size)
        cut = ngram_model.Scorer(model).score(texts)
        assert all((whole[k] == cut[k]).all() for k in whole)
        assert max(len(b.token) for b in blocks(texts)) <= 2 * size


def test_odd_rows(spark):
    long = "very " * 300_000 + "long"
    odd = [None, "", " \n", "a", "A", "a a a", long, "x" * 3_000_000, "a\x00b"]
    check(spark, odd, [*odd, "unknown words", "a unknown very a"])
    check(spark, odd + odd, odd)
    check(spark, [], odd)
    check(spark, odd, [])
    check(spark, [None], [None, "a"])


def test_probabilities_sum_to_one():
    rng = random.Random(1)
    plain = Plain([" ".join(rng.choices("aabbcdefgh", k=rng.randint(0, 20))) for _ in range(50)])
    for v in ["<begin>", *[w for w in plain.count if w], "never"]:
        total = sum(plain.p(v, w) for w in [*plain.count, "unknown"])
        assert total == pytest.approx(1)


def test_runs_and_hashes():
    rng = np.random.default_rng(0)
    x = rng.integers(0, 2**64, 10_000, dtype=np.uint64, endpoint=False)
    assert (unmix(mix(x)) == x).all()
    some = np.unique(x)
    assert (unpack_run(pack_run(some), len(some)) == some).all()
    keys = rng.integers(0, 50, 1000).astype(np.uint64)
    got, sums = merged(keys, np.arange(1000))
    assert got.tolist() == sorted(set(keys.tolist()))
    assert sums.tolist() == [int(np.flatnonzero(keys == k).sum()) for k in got]


def test_discounts():
    assert discounts((0, 1, 1, 1)) == discounts((5, 0, 1, 1)) == (0.5, 1.0, 1.5)
    y = 100 / (100 + 2 * 40)
    assert discounts((100, 40, 20, 12)) == pytest.approx(
        (1 - 2 * y * 40 / 100, 2 - 3 * y * 20 / 40, 3 - 4 * y * 12 / 20))
    assert discounts((10, 100, 1, 1)) != discounts((100, 40, 20, 12))


def test_query(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet").collect()
    rest = {r["doc_id"]: zlib.crc32(str(r["doc_id"]).encode()) % 7 for r in docs}
    plain = Plain([r["text"] for r in docs if rest[r["doc_id"]] != 2])
    got = {r["doc_id"]: r for r in ngram_model.op12_ngram_model(spark, small).collect()}
    assert len(got) == len(docs)
    better = 0
    for r in docs:
        n, known, base, full = plain.row(r["text"])
        mine = got[r["doc_id"]]
        assert mine["held_out"] == (rest[r["doc_id"]] == 2)
        assert (mine["n_tokens"], mine["n_known"], mine["train_tokens"]) == (n, known, plain.n)
        assert mine["base_score"] == pytest.approx(base, abs=1e-9 * n)
        assert mine["score"] == pytest.approx(full, abs=1e-6 + 1e-9 * n)
        better += mine["held_out"] and full > base
    assert better > 0.8 * sum(r == 2 for r in rest.values())
