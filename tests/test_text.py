import pytest
from pyspark.sql import functions as F

from subjectloom.functions import text as X
from subjectloom.functions.stemming import porter_stem, porter_stems
from subjectloom.operators.tokens import lemma_tags, lemmatize_tokens, replace_tokens, stem_tokens

CASES = [
    ("We study N=4 SYM; see https://example.org/abs/1234.5 (12th ed.)", "study sym see ed"),
    ("State-of-the-art: 3.14 don't", "stateoftheart dont"),
    ("The a of 42", ""),
    (None, ""),
    ("Étude www.x.org ABC", "étude abc"),
    ("«Quoted»word 3.14abc 1.2.3", "quoted word"),
]


def test_whole_chain(spark):
    df = spark.createDataFrame([(t,) for t, _ in CASES], "t string")
    got = [r[0] for r in df.select(X.normalize_text(F.col("t"))).collect()]
    assert got == [want for _, want in CASES]


def test_steps_agree_with_the_chain(spark):
    df = spark.createDataFrame([(t or "",) for t, _ in CASES], "t string")
    steps = X.drop_short(X.keep_words(X.tokenize(X.bare_text(F.col("t")))))
    rows = df.select(F.array_join(steps, " "), X.normalize_text(F.col("t"))).collect()
    assert all(r[0] == r[1] for r in rows)


def test_tokens(spark):
    df = spark.createDataFrame([("i cannot gonna “go” cannots",)], "t string")
    got = df.select(X.tokenize(F.col("t"))).first()[0]
    assert got == ["i", "can", "not", "gon", "na", "“", "go", "”", "cannots"]


def test_number_boundaries(spark):
    texts = ["a 12 b", "12th", "x3", "3.14", "1.2.3", "v_1", "12é", "٣ x"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r[0] for r in df.select(X.strip_numbers(F.col("t"))).collect()]
    assert got == ["a   b", "12th", "x3", " ", " . ", "v_1", "12é", "  x"]


def test_keeps_repeats_and_takes_another_stop_list(spark):
    df = spark.createDataFrame([(["the", "cat", "the", "x1", "cat"],)], "t array<string>")
    assert df.select(X.keep_words(F.col("t"))).first()[0] == ["cat", "cat"]
    assert df.select(X.keep_words(F.col("t"), ())).first()[0] == ["the", "cat", "the", "cat"]


STEMS = """caresses caress ponies poni ties tie cats cat feed feed agreed agre plastered plaster
motoring motor sing sing conflated conflat troubled troubl sized size hopping hop tanned tan
falling fall hissing hiss fizzed fizz failing fail filing file happy happi sky sky enjoy enjoy
relational relat conditional condit rational ration valenci valenc digitizer digit conformabli
conform radicalli radic vietnamization vietnam predication predic operator oper feudalism feudal
decisiveness decis hopefulness hope callousness callous formaliti formal sensitiviti sensit
sensibiliti sensibl triplicate triplic formative form formalize formal electriciti electr
electrical electr hopeful hope goodness good revival reviv allowance allow inference infer
airliner airlin adoption adopt probate probat rate rate cease ceas controll control roll roll
dying die dies die died die cried cri by by say say geology geolog replacement replac
adjustment adjust dependent depend communism commun activate activ effective effect skies sky
is is as as this thi""".split()


def test_stems(spark):
    want = dict(zip(STEMS[::2], STEMS[1::2]))
    df = spark.createDataFrame([(w,) for w in want], "token string")
    got = {r["token"]: r["stem"] for r in porter_stems(df).collect()}
    assert got == want


@pytest.mark.parametrize("rows_limit", [None, 0, 1])
def test_replacing_keeps_order_and_empty_documents(spark, monkeypatch, rows_limit):
    if rows_limit is not None:
        monkeypatch.setattr("subjectloom.operators.lookup.BROADCAST_ROWS", rows_limit)
    df = spark.createDataFrame(
        [(1, ["b", "a", "b", "c"]), (2, []), (3, ["z"])], "id int, tokens array<string>"
    )
    table = spark.createDataFrame([("b", "B"), ("c", "C")], "token string, replacement string")
    got = {r["id"]: r["tokens"] for r in replace_tokens(df, table, "id").collect()}
    assert got == {1: ["B", "a", "B", "C"], 2: [], 3: ["z"]}


@pytest.mark.parametrize("rows_limit", [0, 1, 3, 100])
def test_frequent_and_rare_tokens_meet_again(spark, monkeypatch, rows_limit):
    """One token is a third of everything; the result is that of one plain lookup."""
    docs = [
        (i, ["hot"] * 20 + [f"w{(i * j) % 50}" for j in range(40)] + (["hot"] if i % 2 else []))
        for i in range(60)
    ] + [(60, []), (61, ["w1"]), (62, ["unknown"])]
    df = spark.createDataFrame(docs, "id int, tokens array<string>")
    changed = {"hot": "HOT", **{f"w{k}": f"W{k}" for k in range(0, 50, 3)}}
    table = spark.createDataFrame(list(changed.items()), "token string, replacement string")
    monkeypatch.setattr("subjectloom.operators.lookup.BROADCAST_ROWS", rows_limit)
    got = {r["id"]: r["tokens"] for r in replace_tokens(df, table, "id").collect()}
    assert got == {i: [changed.get(t, t) for t in tokens] for i, tokens in docs}


def test_empty_table_and_null_lists(spark):
    df = spark.createDataFrame([(1, ["a"]), (2, None), (3, [])], "id int, tokens array<string>")
    for rows in ([], [("a", "b")]):
        table = spark.createDataFrame(rows, "token string, replacement string")
        got = {r["id"]: r["tokens"] for r in replace_tokens(df, table, "id").collect()}
        assert got == {1: [dict(rows).get("a", "a")], 2: [], 3: []}


def test_stem_tokens(spark):
    df = spark.createDataFrame([(1, ["cats", "running", "sky"])], "id int, tokens array<string>")
    assert stem_tokens(df).first()["tokens"] == ["cat", "run", "sky"]


def test_lemmas_by_tag(spark):
    df = spark.createDataFrame(
        [(1, ["meeting", "meeting", "better"], ["VBG", "NN", "JJR"])],
        "id int, tokens array<string>, tags array<string>",
    )
    lemmas = spark.createDataFrame(
        [("meeting", "v", "meet"), ("better", "a", "good"), ("better", "n", "better")],
        "token string, tag string, lemma string",
    )
    tagged = lemmatize_tokens(df, lemmas, "id", tags_col="tags").first()["tokens"]
    assert tagged == ["meet", "meeting", "good"]
    assert lemmatize_tokens(df, lemmas, "id").first()["tokens"] == ["meeting", "meeting", "better"]
    tags = spark.createDataFrame([(["JJ", "VB", "NNS", "RB", "XX"],)], "g array<string>")
    assert tags.select(lemma_tags(F.col("g"))).first()[0] == ["a", "v", "n", "r", "n"]


@pytest.mark.parametrize("rows_limit", [0, 1, 100])
def test_one_answer_whatever_the_size(spark, monkeypatch, rows_limit):
    """Repeated keys, null keys, repeated and null ids, null tokens: the same rows either way."""
    monkeypatch.setattr("subjectloom.operators.lookup.BROADCAST_ROWS", rows_limit)
    df = spark.createDataFrame(
        [(1, ["a", "cats"]), (1, ["cats", "b"]), (None, ["cats"]), (None, []), (2, None),
         (3, ["x", None, "x"]), (3, ["x", None, "x"])], "id int, tokens array<string>",
    ).coalesce(1)
    table = spark.createDataFrame(
        [("cats", "n", "cat"), ("cats", "n", "kitty"), ("cats", "v", "dog"), (None, "n", "no"),
         ("b", None, "no"), ("x", "n", None), ("x", "n", "y")],
        "token string, tag string, lemma string",
    )
    got = sorted(map(repr, [tuple(r) for r in lemmatize_tokens(df, table, "id").collect()]))
    assert got == sorted(map(repr, [
        (1, ["a", "cat"]), (1, ["cat", "b"]), (None, ["cat"]), (None, []), (2, []),
        (3, ["y", None, "y"]), (3, ["y", None, "y"])]))


def test_both_stemmers_agree_on_the_corpus(spark, small):
    words = spark.read.parquet(f"{small}/documents.parquet").select(
        F.explode(F.split(F.lower("text"), r"[^\p{L}]+")).alias("token")).distinct()
    known = spark.createDataFrame([(w,) for w in STEMS[::2]], "token string")
    rows = porter_stems(words.union(known).where("token <> ''")).collect()
    assert len(rows) > 1000
    assert {r["token"]: r["stem"] for r in rows} == {r["token"]: porter_stem(r["token"]) for r in rows}
    assert [porter_stem(w) for w in STEMS[::2]] == STEMS[1::2]


def test_stems_pass_other_columns_through(spark):
    df = spark.createDataFrame(
        [("k", ["cats", None], 1.5), (None, None, 2.5), ("k", [], None)],
        "key string, tokens array<string>, x double",
    )
    assert [tuple(r) for r in stem_tokens(df).collect()] == [
        ("k", ["cat", None], 1.5), (None, [], 2.5), ("k", [], None)]
