"""Encoding against the tokenizers library, whole and through joins."""

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from subjectloom.llm import bpe

PATH = public_tokenizers.path("byte_bpe_50k.json")
TOKENIZER = Tokenizer.from_file(PATH)


def reference(text):
    return TOKENIZER.encode(text, add_special_tokens=False).ids


def awkward(rng, size):
    """Texts whose words, blanks, runs and added tokens reach across any cut."""
    bits = [
        "a", "aa" * 40, " ", "   ", "\n\n", "'ll", "'s", "''", "l", "hello", " world", "é", "日本",
        "😀", "0", "123", "!!", "<|endoftext|>", "<|endof", "text|>", " ", "\t", "=" * 70, "ß",
        " ", "é", "word" * 30, "‍", "\r\n", "it's", "-", "._",
    ]
    return "".join(rng.choice(bits) for _ in range(size))


@pytest.mark.parametrize("seed", range(60))
def test_joined_pieces_equal_the_whole(seed):
    rng, codec = random.Random(seed), bpe.codec(PATH)
    text = awkward(rng, rng.randint(1, 400))
    whole = reference(text)
    assert codec.encode(text).tolist() == whole
    for piece in (7, 64, 301):
        parts = [codec.encode(p) for p in bpe.halves(text, piece)]
        assert codec.concatenate(parts).tolist() == whole
    assert codec.decode(np.array(whole, dtype=np.int32)) == TOKENIZER.decode(
        whole, skip_special_tokens=False
    )


@pytest.mark.parametrize("text", ["a" * 5000, "ab" * 3000, " " * 3000 + "x", "\n" * 999, "'" * 700])
def test_long_runs(text):
    codec = bpe.codec(PATH)
    parts = [codec.encode(p) for p in bpe.halves(text, 100)]
    assert codec.concatenate(parts).tolist() == reference(text)


def test_single_characters_split_alike():
    codec = bpe.codec(PATH)
    for start in range(0, 0x30000, 64):
        chars = [chr(c) for c in range(start, start + 64) if not 0xD800 <= c < 0xE000]
        text = "".join(f"a{c}b {c}1{c} " for c in chars)
        assert codec.encode(text).tolist() == reference(text), hex(start)


def test_odd_rows(spark):
    texts = [None, "", "x", "x", "long " * 9000, "long " * 9000, "é" * 20000]
    rows = [(i if i else None, t, i, "c") for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids int, row_key string")
    out = bpe.decode_ids(bpe.encode_ids(df, "text", PATH, 1000), "ids", PATH)
    assert set(out.columns) == {"doc_id", "text", "ids", "row_key", "decoded"}
    got = out.collect()
    assert len(got) == len(texts)
    for row in got:
        assert row["ids"] == reference(row["text"] or "")
        assert row["decoded"] == (row["text"] or "")
    assert bpe.encode_ids(df.limit(0), "text", PATH).count() == 0


def test_query(spark, small):
    docs = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(
        f"{small}/documents.parquet").collect()}
    got = bpe.op1_bpe(spark, small).collect()
    assert sorted(r["doc_id"] for r in got) == sorted(docs)
    for row in got:
        ids = reference(docs[row["doc_id"]])
        assert row["n_tokens"] == len(ids)
        assert row["ids_sha256"] == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert row["decoded_sha256"] == hashlib.sha256(docs[row["doc_id"]].encode()).hexdigest()


def test_decode_of_broken_and_missing_ids(spark):
    df = spark.createDataFrame([([],), (None,), ([244],)], "ids array<int>")
    got = [r["decoded"] for r in bpe.decode_ids(df, "ids", PATH).select(F.col("decoded")).collect()]
    assert got == ["", None, TOKENIZER.decode([244], skip_special_tokens=False)]
