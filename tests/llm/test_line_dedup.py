"""Line dedup against a plain reading of its rules."""

import hashlib
import random

import pytest

from subjectloom.llm import line_dedup
from subjectloom.llm.line_dedup import chunks, remove_repeats


def plain(rows):
    """``{row: (text, cut)}`` for ``(id, text)`` rows, in one pass over the rows by id."""
    seen, out = set(), {}
    order = sorted(range(len(rows)), key=lambda i: (rows[i][0] is None, rows[i][0] or 0, i))
    counted = {}
    for i in order:
        lines = (rows[i][1] or "").split("\n")
        for c in chunks(lines):
            if c[2]:
                text = "\n".join(lines[c[0] : c[1]])
                counted[text] = counted.get(text, 0) + 1
    for i in order:
        if rows[i][1] is None:
            out[i] = (None, [])
            continue
        lines, kept, cut = rows[i][1].split("\n"), [], []
        for a, b, counts in chunks(lines):
            text = "\n".join(lines[a:b])
            if counts and counted[text] > 1 and text in seen:
                cut.append((a, b - 1))
            else:
                kept.append(text)
            if counts:
                seen.add(text)
        out[i] = ("\n".join(kept), cut)
    return out


def check(spark, rows):
    df = spark.createDataFrame(
        [(i, d, t, "x") for i, (d, t) in enumerate(rows)],
        "n long, doc_id long, text string, hits string",
    ).coalesce(1)
    got = remove_repeats(df, "doc_id", "text")
    assert got.columns == ["n", "doc_id", "text", "hits", "cut"]
    found = {r["n"]: (r["text"], [tuple(c) for c in r["cut"]]) for r in got.collect()}
    assert found == plain(rows)
    return found


def test_chunks_cover_all_lines():
    rng = random.Random(1)
    for _ in range(200):
        lines = [rng.choice(["", "a", "b c", "w " * 60, str(rng.random())])
                 for _ in range(rng.randint(1, 40))]
        found = chunks(lines)
        assert [c[0] for c in found] == [0, *[c[1] for c in found[:-1]]]
        assert found[-1][1] == len(lines)


def test_boundaries_return_after_an_insertion():
    lines = [f"line {i}" for i in range(400)]
    ends = {c[1] for c in chunks(lines)}
    moved = {c[1] - 1 for c in chunks([*lines[:100], "put in", *lines[100:]])}
    assert len({e for e in ends if e > 130} ^ {e for e in moved if e > 130}) == 0


@pytest.mark.parametrize("seed", range(3))
def test_against_plain_reading(spark, seed):
    rng = random.Random(seed)
    passages = [[f"passage {p} line {i}" for i in range(rng.randint(3, 12))] for p in range(6)]
    rows = []
    for i in range(60):
        lines = [f"own {i} {k}" for k in range(rng.randint(0, 5))]
        for _ in range(rng.randint(0, 3)):
            lines[rng.randint(0, len(lines)) : 0] = rng.choice(passages)
        if rng.random() < 0.2:
            lines.append("word " * 55)
        rows.append((rng.choice([i, i, None, 7]), "\n".join(lines)))
    found = check(spark, rows)
    assert any(cut for _, cut in found.values())


def test_odd_rows(spark):
    long = "\n".join(f"row {i}" for i in range(30_000))
    check(spark, [(1, None), (2, ""), (3, ""), (4, "a\nb"), (4, "a\nb"), (None, "a\nb"),
                  (5, "\n\n\n"), (6, long), (7, long), (8, "single line"), (9, "single line")])


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert remove_repeats(df, "doc_id", "text").count() == 0


def test_chunks_that_share_a_hash_are_told_apart(spark, monkeypatch):
    texts = [f"a{i}\nb{i}" for i in range(6)] * 2
    real = line_dedup._occurrences
    rows = [(i, t) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)

    def clash(batches):
        import pyarrow as pa

        for batch in real(batches):
            yield batch.set_column(3, "hash", pa.array([1] * batch.num_rows, pa.int64()))

    monkeypatch.setattr(line_dedup, "_occurrences", clash)
    got = {r["doc_id"]: r["text"] for r in remove_repeats(df, "doc_id", "text").collect()}
    assert got == {i: t if i < 6 else "" for i, t in rows}


def test_repeats_within_one_text(spark):
    found = check(spark, [(1, "\n".join(["x 1", "x 2", "x 3", "x 4", "x 5", "x 6"] * 6))])
    assert found[0][1]


def words_of(lines):
    return sum(len(line.split()) for line in lines)


def brute(rows):
    """``{row: (text, lines cut)}``: all runs of 50 or more words that stand earlier, found by
    trying every run of lines, and the repeats among chunks and whole texts."""
    seen, out = {}, {}
    for i in sorted(range(len(rows)), key=lambda i: (rows[i][0] is None, rows[i][0] or 0, i)):
        lines, gone = (rows[i][1] or "").split("\n"), set()
        spans = {c[:2] for c in chunks(lines) if c[2]}
        if any(line.strip() for line in lines):
            spans.add((0, len(lines)))
        spans |= {(a, b) for a in range(len(lines)) for b in range(a + 1, len(lines) + 1)
                  if words_of(lines[a:b]) >= 50}
        for a, b in sorted(spans):
            row, end = seen.setdefault("\n".join(lines[a:b]), (i, b))
            if row != i or a >= end:
                gone.update(range(a, b))
        kept = [line for k, line in enumerate(lines) if k not in gone]
        out[i] = (rows[i][1] and "\n".join(kept), sorted(gone))
    return out


def check_whole(spark, rows):
    df = spark.createDataFrame(
        [(i, d, t) for i, (d, t) in enumerate(rows)], "n long, doc_id long, text string"
    ).coalesce(1)
    got = remove_repeats(df, "doc_id", "text", whole=True).collect()
    found = {
        r["n"]: (r["text"], [k for a, b in r["cut"] for k in range(a, b + 1)]) for r in got
    }
    assert found == brute(rows)
    return found


@pytest.mark.parametrize("count", [2, 3, 4, 7])
def test_passages_of_a_few_lines_are_cut_whole(spark, count):
    rng = random.Random(count)
    rows = []
    for p in range(20):
        passage = [f"passage {p} {k} " + "word " * (50 // count) for k in range(count)]
        for _ in range(2):
            around = [[f"own {rng.random()}" for _ in range(rng.randint(0, 3))] for _ in "ab"]
            rows.append((len(rows), "\n".join([*around[0], *passage, *around[1]])))
    found = check_whole(spark, rows)
    assert all(len(found[i][1]) >= count for i in range(1, len(rows), 2))


@pytest.mark.parametrize("seed", range(3))
def test_runs_against_brute_force(spark, seed):
    rng = random.Random(seed)
    pool = [" ".join(rng.choices("abcdefgh", k=rng.choice([0, 3, 10, 20, 55]))) for _ in range(12)]
    rows = [(rng.choice([i, i, None, 7]), "\n".join(rng.choices(pool, k=rng.randint(1, 14))))
            for i in range(40)]
    rows += [(100, None), (101, ""), (102, "same line of six words here\n" * 60)]
    found = check_whole(spark, rows)
    assert any(cut for _, cut in found.values())


def test_runs_that_share_a_hash_are_told_apart(spark, monkeypatch):
    real = line_dedup._all_occurrences

    def clash(batches):
        import pyarrow as pa

        for batch in real(batches):
            yield batch.set_column(3, "hash", pa.array([1] * batch.num_rows, pa.int64()))

    monkeypatch.setattr(line_dedup, "_all_occurrences", clash)
    texts = [f"{'a ' * 30}{i}\n{'b ' * 30}{i}\n{'c ' * 30}{i}" for i in range(6)] * 2
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    got = {r["doc_id"]: r["text"] for r in remove_repeats(
        df, "doc_id", "text", whole=True).collect()}
    assert got == {i: t if i < 6 else "" for i, t in enumerate(texts)}


def test_copies_leave_nothing(spark):
    rows = [(1, "single line"), (2, "single line"), (3, "a\nb\n" + "long " * 60 + "\nalone")]
    for i in range(40):
        text = "\n".join(f"text {i} line {k}" for k in range(i % 9 + 1)) + f"\n\nalone {i}"
        rows += [(10 + 2 * i, text), (11 + 2 * i, text)]
    rows += [(200, rows[2][1]), (201, " \n"), (202, " \n")]
    found = check_whole(spark, rows)
    first = set()
    for i, (_, text) in enumerate(rows):
        if text.strip():
            assert (found[i][0] == "") == (text in first)
            first.add(text)


def test_query_against_brute_force(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet").orderBy("doc_id").collect()
    rows = [(r["doc_id"], r["text"]) for r in docs]
    want, chunks_alone = brute(rows), plain(rows)
    got = {r["doc_id"]: r for r in line_dedup.op3_line_dedup(spark, small).collect()}
    assert len(got) == len(docs)
    for i, row in enumerate(docs):
        text, cut = want[i]
        mine = got[row["doc_id"]]
        assert mine["lines_removed"] == len(cut)
        assert mine["chars_left"] == len(text)
        assert mine["text_sha256"] == hashlib.sha256(text.encode()).hexdigest()
        # Whatever the rule of chunks alone cuts is cut here too.
        cut_here = {k for span in mine["lines_cut"].split(",") if span
                    for k in range(int(span.split("-")[0]), int(span.split("-")[1]) + 1)}
        assert {k for a, b in chunks_alone[i][1] for k in range(a, b + 1)} <= cut_here


def test_all_texts_are_moved_where_keys_are_too_many_to_broadcast(spark, monkeypatch):
    rng = random.Random(9)
    pool = [" ".join(rng.choices("abcdefgh", k=rng.choice([0, 3, 20, 55]))) for _ in range(12)]
    rows = [(i, "\n".join(rng.choices(pool, k=rng.randint(1, 10)))) for i in range(40)]
    monkeypatch.setattr(line_dedup, "fits_broadcast", lambda table: False)
    check_whole(spark, [*rows, (50, None)])
