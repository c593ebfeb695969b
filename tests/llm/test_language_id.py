"""Language identification: the sums by hand, odd texts, and accuracy on held-out documents."""

import math
import zlib
from collections import Counter

import numpy as np
import pytest

from subjectloom.llm import language_id
from subjectloom.llm.language_id import Model, fit, grams, has_letter, identify, in_train_fold


def held_out(doc_id):
    return zlib.crc32(str(doc_id).encode()) % 5 == 0


def test_grams_cover_all_stretches(monkeypatch):
    text = "Añb cd" * 50
    whole = np.sort(np.concatenate(list(grams(text))))
    assert len(whole) == 3 * len(text) - 3
    monkeypatch.setattr(language_id, "STEP", 7)
    assert np.array_equal(whole, np.sort(np.concatenate(list(grams(text)))))


def test_fit_equals_counting_by_hand(spark, frame):
    rows = [(1, "ab cd", "x"), (2, "AB", "x"), (3, "zz zz", "y"), (4, None, "y"), (5, "q", None),
            (6, "123", "y"), (7, "", "y")]
    df = frame(rows, "doc_id long, text string, lang string")
    model = fit(df, "text", "lang", bits=8, smoothing=0.5)
    assert model.languages == ["x", "y"]
    assert np.exp(model.log_prior) == pytest.approx([2 / 3, 1 / 3])
    for j, texts in enumerate((["ab cd", "AB"], ["zz zz"])):
        count = Counter(int(c) for t in texts for g in grams(t, 8) for c in g)
        total = sum(count.values()) + 0.5 * 256
        for column in range(256):
            want = math.log((count[column] + 0.5) / total)
            assert model.log_prob[column, j] == pytest.approx(want)


def test_odd_texts(spark, frame):
    model = fit(frame([("hello there", "en"), ("guten tag", "de")], "t string, l string"), "t", "l")
    rows = [(None,), ("",), ("123 !?",), ("hello",), ("hello",), ("guten tag " * 60_000,), ("\x00Ж",)]
    df = frame([(*r, "own", 2) for r in rows], "text string, lang_pred string, lang int")
    got = identify(df, "text", model)
    assert got.columns == ["text", "lang", "lang_pred", "lang_score"]
    out = got.collect()
    assert [r["lang_pred"] for r in out[:6]] == ["und", "und", "und", "en", "en", "de"]
    assert [r["lang_score"] for r in out[:3]] == [0.0, 0.0, 0.0]
    assert all(0 <= r["lang_score"] <= 1 for r in out)
    assert out[6]["lang_pred"] in ("en", "de")


def test_without_languages(spark):
    df = spark.createDataFrame([], "text string, lang string")
    model = fit(df, "text", "lang")
    assert model.languages == [] and identify(df, "text", model).count() == 0
    assert model.predict(["hello"]) == [("und", 0.0)] and model.predict([]) == []


def test_too_many_languages(spark):
    df = spark.createDataFrame([(f"t{i}", f"l{i}") for i in range(5)], "text string, lang string")
    with pytest.raises(ValueError, match="max_languages"):
        fit(df, "text", "lang", max_languages=4)


def test_query_on_held_out_documents(spark):
    sf = "/root/testdata/sf0.01"
    truth = {r["doc_id"]: r for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got = language_id.op8_language_id(spark, sf).collect()
    assert len(got) == len(truth)
    assert all(r["held_out"] == held_out(r["doc_id"]) for r in got)
    right = [r["lang_pred"] == truth[r["doc_id"]]["lang"] for r in got if r["held_out"]]
    assert sum(right) / len(right) > 0.98
    assert all(0 <= r["score"] <= 1 for r in got)
    assert all((r["lang_pred"] == "und") == (not has_letter(truth[r["doc_id"]]["text"])) for r in got)


def plain_grams(text, bits):
    """The columns of all n-grams, number by number."""
    one, two, three, all_ = 0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D, 2**32 - 1
    c = [(ord(x) + 1) * one & all_ for x in text.lower()]
    c = [x ^ x >> 15 for x in c]
    pair = [(a * two & all_) ^ b for a, b in zip(c, c[1:])]
    triple = [(a * three & all_) ^ b for a, b in zip(pair, c[2:])]
    for found, factor in ((c, two), (pair, three), (triple, one)):
        for x in found:
            x = x * factor & all_
            yield ((x ^ x >> 16) * two & all_) >> 32 - bits


def plain_predict(model, text):
    if not text or not any(map(str.isalpha, text)):
        return "und", 0.0
    total = [float(x) for x in model.log_prior]
    table = model.log_prob.tolist()
    for column, n in Counter(plain_grams(text, model.bits)).items():
        total = [a + n * b for a, b in zip(total, table[column])]
    top = max(total)
    share = [math.exp(x - top) for x in total]
    return model.languages[total.index(top)], 1 / sum(share)


@pytest.mark.parametrize("cells", [1 << 18, 100])
def test_predictions_by_brute_force(spark, small, monkeypatch, cells):
    """All of the smallest table, fitted and predicted number by number."""
    monkeypatch.setattr(language_id, "CELLS", cells)
    docs = spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text", "lang")
    rows = docs.collect()
    model = fit(docs.where(in_train_fold("doc_id")), "text", "lang")
    count = {}
    for r in rows:
        if not held_out(r["doc_id"]):
            count.setdefault(r["lang"], Counter()).update(plain_grams(r["text"], model.bits))
    assert model.languages == sorted(count)
    for j, lang in enumerate(model.languages):
        total = sum(count[lang].values()) + 0.5 * 2**model.bits
        for column in list(count[lang])[:500]:
            want = math.log((count[lang][column] + 0.5) / total)
            assert model.log_prob[column, j] == pytest.approx(want)
    texts = [r["text"] for r in rows]
    for (lang, score), text in zip(model.predict(texts), texts, strict=True):
        want = plain_predict(model, text)
        assert lang == want[0] and score == pytest.approx(want[1], abs=1e-9)
    if cells > 1000:
        got = {r["doc_id"]: r for r in language_id.op8_language_id(spark, small).collect()}
        for r in rows:
            want = plain_predict(model, r["text"])
            assert got[r["doc_id"]]["lang_pred"] == want[0]
            assert got[r["doc_id"]]["score"] == pytest.approx(want[1], abs=1e-9)


def test_equally_likely_languages_go_by_name():
    model = Model(["de", "en", "fr"], np.log(np.full((256, 3), 1 / 256)), np.log([0.25, 0.375, 0.375]), 8)
    got = model.predict(["abc", None, "12"])
    assert [lang for lang, _ in got] == ["en", "und", "und"]
    assert [score for _, score in got] == [pytest.approx(0.375), 0.0, 0.0]
