"""Search by NRA against the score of every document."""

import math
import random
import re

import numpy as np
import pytest

from subjectloom.llm import nra_search
from subjectloom.llm.nra_search import nra, search, terms

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def words(text):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return TERM.findall(lower)


def plain(docs, items, top):
    split = [words(t) for _, t in docs]
    n_docs, total = sum(bool(w) for w in split), sum(map(len, split))
    df = {}
    for w in split:
        for t in set(w):
            df[t] = df.get(t, 0) + 1
    out = []
    for item, text in items:
        scored = []
        for (doc, _), own in zip(docs, split, strict=True):
            score = 0
            for t in set(words(text)) & set(own):
                w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                m = 100 - 90 + (90 * len(own) * n_docs) // total
                tf = own.count(t)
                score += w * ((1000000000 * tf) // (1000 * tf + 8 * m))
            if score > 0:
                scored.append((-score, doc is None, doc))
        scored.sort(key=lambda s: (s[0], s[1], s[2] or 0))
        out += [(item, r + 1, d, -s) for r, (s, _, d) in enumerate(scored[:top])]
    return sorted(out, key=repr)


def run(spark, docs, items, top=5, **sizes):
    left = spark.createDataFrame(
        [(d, t, "x", 1) for d, t in docs], "doc_id long, text string, terms string, score int"
    ).repartition(3)
    right = spark.createDataFrame(
        [(i, t, 0) for i, t in items], "item_id long, text string, rank int")
    got = search(left, "doc_id", "text", right, "item_id", "text", top, **sizes)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    return sorted((tuple(r) for r in got.collect()), key=repr)


@pytest.mark.parametrize("seed", range(3))
def test_against_all_scores(spark, seed):
    rng = random.Random(seed)
    pool = [f"w{i}" for i in range(60)] + ["Été", "ß", "x1"]
    weights = [1 / (i + 1) for i in range(len(pool))]
    docs = [(i, " ".join(rng.choices(pool, weights, k=rng.randint(0, 40)))) for i in range(200)]
    docs += docs[:20]  # the same rows again
    docs += [(i + 500, docs[3][1]) for i in range(30)]  # ties
    items = [(i, ", ".join(rng.choices(pool, k=rng.randint(1, 12)))) for i in range(20)]
    items += items[:2]
    for sizes in ({}, {"documents": 30, "block_terms": 40}):
        assert run(spark, docs, items, **sizes) == plain(docs, items, 5)


def test_odd_rows(spark):
    docs = [(1, None), (2, ""), (3, "..."), (None, "alpha"), (4, "alpha beta"), (4, "alpha beta"),
            (5, "ALPHA-Beta_gamma"), (6, "alpha " * 300_000 + "beta"), (7, "\x00alpha\x7f"),
            (8, "é" * 2_000_000)]
    items = [(1, "alpha"), (1, "alpha"), (2, None), (3, ""), (None, "beta gamma"), (4, "nothing"),
             (5, "é" * 2_000_000)]
    assert run(spark, docs, items) == plain(docs, items, 5)
    assert run(spark, [], items) == []
    assert run(spark, docs, []) == []
    assert run(spark, [(1, None)], items) == []


def test_terms_of_long_texts(monkeypatch):
    text = "Ab, cé_d1 \n é " * 50
    monkeypatch.setattr(nra_search, "SEGMENT", 7)
    got = [t.decode() for some in terms(text.encode()) for t in some]
    assert got == words(text)


def test_reads_little_where_lists_tell_enough():
    rng = np.random.default_rng(1)
    size, lists = 20_000, []
    full = np.zeros(size, np.int64)
    best = rng.choice(size, 5, replace=False)
    for _ in range(6):
        gains = rng.integers(1, 1000, size)
        gains[best] += 5000
        order = np.argsort(-gains, kind="stable")
        lists.append((order, gains[order]))
        full += gains
    docs, scores, read = nra(lists, size, 5)
    assert sorted(docs[np.argsort(-scores)[:5]]) == sorted(best)
    assert (scores == full[docs]).all() and read < 6 * size / 50


def test_lists_without_a_document_are_read_until_scores_are_settled():
    rng = np.random.default_rng(2)
    for _ in range(200):
        size, full, lists = int(rng.integers(1, 60)), None, []
        full = np.zeros(size, np.int64)
        for _ in range(rng.integers(1, 5)):
            docs = rng.permutation(size)[: rng.integers(1, size + 1)]
            gains = np.sort(rng.integers(1, 6, len(docs)))[::-1]
            full[docs] += gains
            lists.append((docs, gains))
        floor = int(rng.integers(0, 8))
        docs, scores, _ = nra(lists, size, 3, floor)
        assert (scores == full[docs]).all()
        rank = np.lexsort((np.arange(size), -full))[:3]
        wanted = {int(d) for d in rank if full[d] > 0 and full[d] >= floor}
        assert wanted <= set(docs.tolist())
