"""The Jaccard join against all pairs."""

import random
import re

import pytest

from subjectloom.llm import jaccard_join
from subjectloom.llm.components import components
from subjectloom.llm.jaccard_join import link_groups, one_of_each

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def shingle_set(text):
    lowered = (text or "").translate(str.maketrans(UPPER, UPPER.lower()))
    words = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    if len(words) < 5:
        return frozenset([tuple(words)]) if words else frozenset()
    return frozenset(tuple(words[i : i + 5]) for i in range(len(words) - 4))


def plain(rows, percent=75):
    """Components as lists of rows, and set sizes."""
    sets = [shingle_set(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * both >= percent * (len(sets[i] | sets[j])):
                root[find(i)] = find(j)
    groups = {}
    for i in range(len(rows)):
        groups.setdefault(find(i), []).append(i)
    smallest = {}
    for members in groups.values():
        ids = [rows[i][0] for i in members if rows[i][0] is not None]
        for i in members:
            smallest[i] = min(ids, default=None)
    return sets, smallest, groups


def check(frame, rows, **options):
    df = frame([(i, t, 5, "x") for i, t in rows], "doc_id long, text string, n int, grp string")
    got = link_groups(df, "doc_id", "text", **options).collect()
    sets, smallest, groups = plain(rows, options.get("percent", 75))
    want = sorted(((rows[i][0], len(sets[i]), smallest[i]) for i in range(len(rows))), key=repr)
    assert sorted(((r["id"], r["n_shingles"], r["component_id"]) for r in got), key=repr) == want
    assert len({r["component"] for r in got}) == len(groups)
    return df, got


def edited(rng, words, changes):
    words = list(words)
    for _ in range(changes):
        if not words:
            break
        at = rng.randrange(len(words))
        words[at : at + 1] = rng.choice([[], [f"new{rng.random()}"], [words[at], "put"]])
    return " ".join(words)


@pytest.mark.parametrize(("seed", "frequent"), [(0, 0), (1, 40), (2, 1000)])
def test_against_all_pairs(spark, frame, seed, frequent):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(300)]
    bases = [[rng.choice(vocabulary) for _ in range(rng.choice([4, 6, 30, 80]))] for _ in range(12)]
    passage = [rng.choice(vocabulary) for _ in range(60)]
    rows = []
    for i in range(160):
        base = rng.choice(bases)
        text = edited(rng, base, rng.choice([0, 0, 1, 2, 3, 6]))
        if rng.random() < 0.3:
            own = " ".join(f"own{i}x{k}" for k in range(rng.choice([3, 8, 15, 40])))
            text = f"{' '.join(passage)} {own}"
        rows.append((rng.choice([i, i, i, 3, None]), text.upper() if i % 3 == 0 else text))
    check(frame, rows, frequent=frequent)


def test_many_near_copies(spark, frame):
    rng = random.Random(9)
    base = [f"b{i}" for i in range(100)]
    rows = [(i, edited(rng, base, rng.choice([1, 2, 3, 4, 5]))) for i in range(150)]
    check(frame, rows)


def test_chain_of_links(spark, frame):
    words = [f"c{i}" for i in range(100)]
    rows = [(90 - k, " ".join(words[2 * k : 2 * k + 40])) for k in range(30)]
    _, got = check(frame, rows)
    assert len({r["component_id"] for r in got}) == 1


def test_sizes_at_the_limit(spark, frame):
    words = [f"d{i}" for i in range(64)]
    rows = [(1, " ".join(words[:64])), (2, " ".join(words[:49])), (3, " ".join(words[:48])),
            (4, " ".join(words[:19])), (5, " ".join(words[:16]))]
    check(frame, rows)


def test_odd_rows(spark, frame):
    long = " ".join(f"l{i}" for i in range(40_000))
    rows = [(1, None), (2, ""), (3, " \t\n"), (4, "a b"), (5, "A  b"), (5, "a b"), (None, "a b"),
            (None, "q"), (None, None), (6, "a b c"), (7, long), (8, long + " end"), (9, "a b c d e"),
            (9, "entirely other text here now and then")]
    df, _ = check(frame, rows)
    kept = one_of_each(df, "doc_id", "text")
    assert kept.columns == df.columns
    assert sorted(((r["doc_id"], r["text"]) for r in kept.collect()), key=repr) == sorted(
        [(1, None), (2, ""), (3, " \t\n"), (4, "a b"), (None, "q"), (None, None), (6, "a b c"),
         (7, long), (9, "a b c d e"), (9, "entirely other text here now and then")], key=repr)


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert link_groups(df, "doc_id", "text").count() == 0
    assert one_of_each(df, "doc_id", "text").count() == 0


def test_components(spark):
    links = [(i, i + 1) for i in range(100, 160)] + [(5, k) for k in range(6, 40)] + [(7, 7)]
    random.Random(0).shuffle(links)
    got = {r["node"]: r["label"] for r in components(
        spark.createDataFrame(links, "a long, b long")).collect()}
    assert len({got[i] for i in range(100, 161)}) == 1
    assert len({got[k] for k in range(5, 40)}) == 1
    assert got[5] != got[100]
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_query(spark, small):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(
        f"{small}/documents.parquet").collect()]
    sets, smallest, _ = plain(docs)
    got = {r["doc_id"]: r for r in jaccard_join.op9_jaccard_join(spark, small).collect()}
    assert len(got) == len(docs)
    for i, (doc_id, _) in enumerate(docs):
        assert (got[doc_id]["n_shingles"], got[doc_id]["component_id"]) == (
            len(sets[i]), smallest[i])
