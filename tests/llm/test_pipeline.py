"""The pipeline's stages against plain readings of the same rules."""

import random

import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline as P
from subjectloom.llm import mixing, toxicity
from subjectloom.session import noting, written
from tests.llm.test_jaccard_join import plain as plain_groups
from tests.llm.test_line_dedup import brute as plain_lines
from tests.llm.test_mixing import level_by_steps

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, row_key string, cut int"


def test_stages_are_in_order():
    assert [name for name, _ in P.STAGES] == [
        "toxicity", "line_dedup", "near_duplicates", "mixing", "bpe"]
    assert P.ORACLE_SQL is None


def test_whole_run_stage_by_stage(spark, small):
    """Each stage's rows from its predecessor's, by brute force."""
    docs = spark.read.parquet(f"{small}/documents.parquet")
    stages = dict(P.STAGES)
    clean = written(stages["toxicity"](spark, docs, small), "t1")
    assert clean.columns == COLUMNS
    model = toxicity.train_on_fold(docs, spark.read.parquet(f"{small}/labels.parquet"))
    known = docs.toPandas()
    fine = known[(model.score(known["text"]) < 0.5).to_numpy()]
    assert sorted(map(tuple, clean.collect())) == sorted(fine.itertuples(index=False, name=None))
    assert len(fine) >= 0.8 * len(known)

    rows = clean.orderBy("doc_id").collect()
    want = plain_lines([(r["doc_id"], r["text"]) for r in rows])
    lines = written(stages["line_dedup"](spark, clean, small), "t2")
    assert lines.columns == COLUMNS
    expected = {}
    for i, row in enumerate(rows):
        text, cut = want[i]
        if not cut or text:
            expected[row["doc_id"]] = (text, len(text) if cut else row["n_chars"])
    assert {r["doc_id"]: (r["text"], r["n_chars"]) for r in lines.collect()} == expected

    rows = lines.orderBy("doc_id").collect()
    _, _, groups = plain_groups([(r["doc_id"], r["text"]) for r in rows])
    one = written(stages["near_duplicates"](spark, lines, small), "t3")
    assert one.columns == COLUMNS
    assert sorted(r["doc_id"] for r in one.collect()) == sorted(
        min(rows[i]["doc_id"] for i in members) for members in groups.values())

    mixed = written(stages["mixing"](spark, one, small), "t4")
    assert mixed.columns == COLUMNS
    size = F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+"))
    have = {r["source"]: (r["n"], r["most"]) for r in one.groupBy("source").agg(
        F.sum(size).alias("n"), F.max(size).alias("most")).collect()}
    aims = level_by_steps({s: n for s, (n, _) in have.items()},
                          mixing.WEIGHTS, mixing.SHARE, mixing.MOST)
    taken = {r["source"]: r["n"] for r in mixed.groupBy("source").agg(
        F.sum(size).alias("n")).collect()}
    for source, (_, most) in have.items():
        assert abs(taken.get(source, 0) - aims[source]) <= 2 * most
    assert max(r["count"] for r in mixed.groupBy("doc_id").count().collect()) <= 2

    tokenizer = Tokenizer.from_file(public_tokenizers.path(P.VOCABULARY))
    texts = {r["doc_id"]: r["text"] or "" for r in one.collect()}
    ids = stages["bpe"](spark, mixed, small).collect()
    assert sorted(r["doc_id"] for r in ids) == sorted(r["doc_id"] for r in mixed.collect())
    for row in ids:
        assert row["ids"] == tokenizer.encode(texts[row["doc_id"]], add_special_tokens=False).ids


def test_odd_rows_pass_every_stage(spark, small, frame):
    rng = random.Random(3)
    passage = "\n".join(f"shared line {i} of many" for i in range(8))
    rows = [(None, None, None, None, None, "k", 1), (1, "", "en", "s", 0, "k", 1),
            (1, "", "en", "s", 0, "k", 1), (2, "one two three", None, "s", 13, None, None),
            (3, "x " * 60_000, "en", None, 1, "k", 1)]
    rows += [(10 + i, f"own {rng.random()} words\n{passage}", "en", "s", 9, "k", 1)
             for i in range(20)]
    docs = frame(rows, SCHEMA)
    for name, stage in P.STAGES:
        docs = written(stage(spark, docs, small), f"odd-{name}")
    assert docs.columns == ["doc_id", "lang", "source", "n_tokens", "ids"]
    assert docs.count() > 0


@pytest.mark.parametrize("name", [n for n, _ in P.STAGES])
def test_empty_documents(spark, small, name):
    empty = spark.createDataFrame([], ", ".join(SCHEMA.split(", ")[:5]))
    assert dict(P.STAGES)[name](spark, empty, small).count() == 0


def test_runs_do_not_disturb_each_other(spark, small, monkeypatch):
    """Stages built before either is written, and a run meanwhile, read what they need; a run
    leaves nothing but its result."""
    docs = spark.read.parquet(f"{small}/documents.parquet").limit(60)
    stages = dict(P.STAGES)
    first = stages["line_dedup"](spark, docs, small)
    second = stages["line_dedup"](spark, docs, small)
    other = stages["near_duplicates"](spark, docs, small)
    with noting() as made:
        result = P.run(spark, small)
    assert result.count() > 0
    place = spark._jvm.org.apache.hadoop.fs.Path
    store = place(made[0]).getFileSystem(spark._jsc.hadoopConfiguration())
    assert [p for p in made if store.exists(place(p))] == [result.shared_path]
    assert first.count() == second.count() > 0
    assert other.count() > 0
