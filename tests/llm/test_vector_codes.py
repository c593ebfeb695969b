"""Vector codes against plain loops over all entries."""

import hashlib

import numpy as np
import pytest

from subjectloom.llm import vector_codes
from subjectloom.llm.vector_codes import Book, books_sha256, compress, decompress, encode, train

SCHEMA = "vec_id long, embedding array<float>, label int, code string, vector string"


def plain(rows, parts, entries, rounds, steps):
    """``[(row, code numbers, error)]`` and the books, by plain loops."""
    kept = []
    for i, (vec_id, v) in enumerate(rows):
        if v is None or any(x is None or not np.isfinite(x) for x in v):
            continue
        whole = [int(np.floor(float(np.float32(x)) * steps)) for x in v]
        kept.append((vec_id is None, vec_id or 0, whole, i))
    if not kept:
        return [], None
    width = len(kept[0][2]) // parts
    cut = [[v[p * width : (p + 1) * width] for p in range(parts)] for _, _, v, _ in kept]
    first = sorted(range(len(kept)), key=lambda k: kept[k][:3])[:entries]
    books = [[list(cut[k][p]) for k in first] for p in range(parts)]

    def near(x, book):
        return min((sum((a - b) ** 2 for a, b in zip(x, e, strict=True)), i)
                   for i, e in enumerate(book))

    for _ in range(rounds):
        for p, book in enumerate(books):
            got = [near(c[p], book)[1] for c in cut]
            for e in range(len(book)):
                own = [c[p] for c, g in zip(cut, got, strict=True) if g == e]
                if own:
                    book[e] = [sum(x) // len(own) for x in zip(*own, strict=True)]
    out = []
    for k, (_, _, _, i) in enumerate(kept):
        best = [near(cut[k][p], books[p]) for p in range(parts)]
        out.append((i, [e for _, e in best], sum(d for d, _ in best)))
    return out, books


def check(spark, rows, parts=2, entries=4, rounds=3, steps=64):
    df = spark.createDataFrame(
        [(i, v, n, "mine", "x") for n, (i, v) in enumerate(rows)], SCHEMA
    ).repartition(3)
    want, books = plain(rows, parts, entries, rounds, steps)
    book = train(df, "vec_id", "embedding", parts, entries, rounds, steps)
    if books is None:
        assert book is None
        return
    width = book.shape[1] // parts
    assert [[list(e[p * width : (p + 1) * width]) for e in book] for p in range(parts)] == books
    numbers = ",".join(str(x) for b in books for e in b for x in e)
    assert books_sha256(book, parts) == hashlib.sha256(numbers.encode()).hexdigest()
    coded = compress(df, "embedding", book, parts, steps)
    assert coded.columns == ["vec_id", "embedding", "label", "vector", "code", "error"]
    got = {r["label"]: (r["code"], r["error"]) for r in coded.collect()}
    assert got == {i: ("".join(f"{e:02x}" for e in c), err) for i, c, err in want}
    back = {r["label"]: r["v"] for r in coded.select(
        "label", decompress(coded["code"], book, parts, steps).alias("v")).collect()}
    for i, c, _ in want:
        assert back[i] == [x / steps for p in range(parts) for x in books[p][c[p]]]


@pytest.mark.parametrize("seed", range(3))
def test_against_plain_loops(spark, seed):
    rng = np.random.default_rng(seed)
    rows = [(int(i), [float(x) for x in rng.normal(size=6)]) for i in rng.permutation(90)]
    rows += [(int(i), [float(x) for x in rng.integers(-1, 2, 6) / 2]) for i in range(60)]  # ties
    check(spark, rows)


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [0.1, 0.2]), (1, [0.1, 0.2]), (1, [0.0, 0.5]), (None, [1.0, 1.0]), (2, None),
            (3, [nan, 0.0]), (4, [0.0, inf]), (5, [None, 0.0]), (6, [-0.01, -3.0])]
    check(spark, rows)
    check(spark, rows, entries=16)
    check(spark, [])
    check(spark, [(1, None)])
    check(spark, [(1, []), (2, [])])


def test_vectors_that_cannot_be_cut_are_refused(spark):
    for rows in ([(1, [1.0] * 3)], [(1, [1.0] * 4), (2, [1.0] * 6)], [(1, [1e30] * 4)]):
        df = spark.createDataFrame(rows, "i long, v array<float>")
        with pytest.raises(Exception, match="parts|differ|beyond"):
            train(df, "i", "v", 2)


def test_masks_leave_the_nearest_and_little_else():
    """Candidates hold every entry as near as the radius, and fewer than all; also where the
    entries fill several words of a mask, and where entries are equal."""
    rng = np.random.default_rng(5)
    for n in (1, 16, 64, 150):
        entries = rng.integers(-500, 500, (n, 4))
        entries[n // 2 :] = entries[: n - n // 2]  # equal ones: the lower index wins
        book = Book.of(entries)
        rows = rng.integers(-600, 600, (300, 4))
        far = ((rows[:, None] - entries[None]) ** 2).sum(axis=2)
        best, apart = book.nearest(rows)
        assert (best == far.argmin(axis=1)).all() and (apart == far.min(axis=1)).all()
        radius = np.full(len(rows), 200)
        masks = book.candidates(rows, radius)
        bits = np.stack([masks[:, e // 64] >> np.uint64(e % 64) & np.uint64(1)
                         for e in range(n)], axis=1).astype(bool)
        within = (np.abs(rows[:, None] - entries[None]) <= 200).all(axis=2)
        assert (bits == within).all()
        assert n < 16 or bits.mean() < 0.2


def test_parts_are_coded_apart():
    rows = np.array([[0, 0, 9, 9], [9, 9, 0, 0]])
    books = [Book.of(np.array([[0, 0], [9, 9]]))] * 2
    codes, apart = encode(rows, books)
    assert codes.tolist() == [[0, 1], [1, 0]] and apart.tolist() == [0, 0]


def test_query_on_odd_tables(spark, tmp_path):
    rows = [(i, [float(np.sin(i * 7 + d)) for d in range(16)], i % 3 if i % 4 else None)
            for i in range(40)] + [(50, None, 1)]
    for name, some in (("full", rows), ("bare", [])):
        df = spark.createDataFrame(some, "vec_id long, embedding array<float>, label int")
        df.write.parquet(f"{tmp_path}/{name}/embeddings.parquet")
        got = vector_codes.op13_vector_codes(spark, f"{tmp_path}/{name}").collect()
        want, books = plain([r[:2] for r in some], 8, 16, 6, 4096)
        by_label = {}
        for i, _, err in want:
            by_label[some[i][2]] = by_label.get(some[i][2], 0) + err
        assert sorted((r["vec_id"], r["code"], r["error"], r["label_error"]) for r in got) == [
            (some[i][0], "".join(f"{e:02x}" for e in c), err, by_label[some[i][2]])
            for i, c, err in want
        ]
        numbers = ",".join(str(x) for b in books or [] for e in b for x in e)
        assert {r["codebooks_sha256"] for r in got} <= {hashlib.sha256(numbers.encode()).hexdigest()}
