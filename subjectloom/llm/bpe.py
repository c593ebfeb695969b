"""Byte-pair encoding and decoding; long texts by tree concatenation."""

from __future__ import annotations

import functools
import hashlib
import json
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import public_tokenizers
import tiktoken
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from subjectloom.llm.common import free_name, in_small_batches, table, text_of, with_lasting_key

#: Texts of more characters are cut into halves until no piece is longer.
PIECE = 16_384
#: Tokens on either side of a join that are encoded again at first; doubled until both agree.
WINDOW = 32


@functools.cache
def byte_letters() -> dict[str, int]:
    """The letters that byte-level vocabularies write bytes with: printable Latin-1 for itself,
    all other bytes in order from U+0100."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    other = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(other)}


class Codec:
    """Encoder and decoder for a byte-level BPE vocabulary in a ``tokenizers`` JSON file.

    The base encoder is tiktoken's with the file's tokens as ranks; the vocabulary lists tokens
    in the order of its merges, so both libraries merge alike. Added tokens of the file that
    stand in a text become their ids, as they do there.
    """

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        letters = byte_letters()
        added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        ranks = {
            bytes(letters[c] for c in token): number
            for token, number in spec["model"]["vocab"].items() if token not in added
        }
        self.encoding = tiktoken.Encoding(
            "vocabulary", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks,
            special_tokens=added,
        )
        size = max(max(ranks.values()), max(added.values(), default=0)) + 1
        self.tokens = [b""] * size
        for token, number in ranks.items():
            self.tokens[number] = token
        for token, number in added.items():
            self.tokens[number] = token.encode()
        # A window may only begin where a character begins.
        self.starts = np.array([not t or t[0] & 0xC0 != 0x80 for t in self.tokens])

    def encode(self, text: str) -> np.ndarray:
        ids = self.encoding.encode(text, allowed_special="all")
        return np.array(ids, dtype=np.int32)

    def decode(self, ids: np.ndarray) -> str:
        data = self.encoding.decode_bytes(ids.tolist())
        return data.decode("utf-8", errors="replace")

    def _text(self, ids: np.ndarray) -> str:
        return b"".join(self.tokens[i] for i in ids.tolist()).decode("utf-8")

    def join(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The encoding of two texts in a row, from their encodings.

        The last tokens of the left and the first of the right are turned back into text and
        encoded together. If the outer quarters of the outcome are the very tokens that stood
        there, no merge and no split of words reaches beyond the window: what lies outside is as
        in the encoding of the whole. Else the window doubles, up to both texts entirely.
        """
        if not len(left) or not len(right):
            return np.concatenate([left, right])
        width = WINDOW
        while True:
            at = max(0, len(left) - width)
            while at > 0 and not self.starts[left[at]]:
                at -= 1
            to = min(len(right), width)
            while to < len(right) and not self.starts[right[to]]:
                to += 1
            old_left, old_right = left[at:], right[:to]
            new = self.encode(self._text(np.concatenate([old_left, old_right])))
            near = max(8, min(width // 4, len(new) // 4))
            agree_left = at == 0 or (
                len(old_left) >= near and len(new) >= 2 * near
                and np.array_equal(new[:near], old_left[:near])
            )
            agree_right = to == len(right) or (
                len(old_right) >= near and len(new) >= 2 * near
                and np.array_equal(new[-near:], old_right[-near:])
            )
            if agree_left and agree_right:
                return np.concatenate([left[:at], new, right[to:]])
            width *= 2

    def concatenate(self, parts: list[np.ndarray]) -> np.ndarray:
        """Neighbours joined in pairs, level by level, up to the root."""
        while len(parts) > 1:
            parts = [
                self.join(*parts[i : i + 2]) if i + 1 < len(parts) else parts[i]
                for i in range(0, len(parts), 2)
            ]
        return parts[0] if parts else np.empty(0, dtype=np.int32)


@functools.cache
def codec(path: str) -> Codec:
    return Codec(path)


def halves(text: str, piece: int) -> list[str]:
    """The text cut into halves, those into halves again, until none is over ``piece`` long."""
    if len(text) <= piece:
        return [text]
    count = 1 << math.ceil(math.log2(len(text) / piece))
    cuts = [len(text) * i // count for i in range(count + 1)]
    return [text[a:b] for a, b in zip(cuts, cuts[1:], strict=False)]


def encoder(path: str):
    @F.pandas_udf("array<int>")
    def encode_texts(texts: pd.Series) -> pd.Series:
        own = codec(path)
        return pd.Series([own.encode(t) for t in texts], dtype=object)

    return encode_texts


def decoder(path: str):
    @F.pandas_udf("string")
    def decode_lists(lists: pd.Series) -> pd.Series:
        own = codec(path)
        return pd.Series([None if x is None else own.decode(x) for x in lists], dtype=object)

    return decode_lists


@F.pandas_udf(T.StringType())
def ids_sha256(lists: pd.Series) -> pd.Series:
    """Lowercase hex of the ids as little-endian unsigned 32-bit integers."""
    return lists.map(lambda x: hashlib.sha256(np.asarray(x, dtype="<u4").tobytes()).hexdigest())


def encode_ids(docs: DataFrame, text_col: str, path: str, piece: int = PIECE) -> DataFrame:
    """Adds ``ids``, the tokens of each whole text, in place of a column of that name.

    Short texts are encoded where they are. Longer ones are cut into halves of halves, which
    are dealt out over the cluster and encoded in parallel; the pieces of a text then meet in
    one task, as does the row they become, and are joined pair by pair up the tree. A null
    text is the empty text, which has no tokens. Repeated rows, and rows with equal ids or
    none, are told apart by a key of their own. Other columns stay as they are.
    """
    in_small_batches(docs.sparkSession)
    key, text = free_name(docs, "row_key"), free_name(docs, "whole_text")
    columns = [c for c in docs.columns if c != "ids"]
    keyed = with_lasting_key(docs, key).withColumn(text, text_of(text_col))
    rest = [F.col(f"`{c}`") for c in columns]
    long = F.length(text) > piece
    # The tokens are worked out once; a plain expression would be put in wherever it is used.
    short = keyed.where(~long).select(*rest, encoder(path)(text).alias("ids"))

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row_key, whole in zip(batch["row_key"], batch["text"], strict=True):
                parts = halves(whole, piece)
                for at in range(0, len(parts), 64):
                    some = parts[at : at + 64]
                    yield pd.DataFrame(
                        {"row_key": row_key, "part": range(at, at + len(some)), "text": some}
                    )

    def grown(group: pd.DataFrame) -> pd.DataFrame:
        parts = [np.frombuffer(x, dtype=np.int32) for x in group.sort_values("part")["ids"]]
        whole = codec(path).concatenate(parts)
        return pd.DataFrame({"row_key": [group["row_key"].iloc[0]], "ids": [whole]})

    @F.pandas_udf("binary")
    def packed(texts: pd.Series) -> pd.Series:
        own = codec(path)
        return texts.map(lambda t: own.encode(t).tobytes())

    tall = keyed.where(long)
    pieces = tall.select(F.col(key).alias("row_key"), F.col(text).alias("text")).mapInPandas(
        cut, "row_key long, part int, text string"
    )
    trees = (
        pieces.repartition("row_key", "part")
        .select("row_key", "part", packed("text").alias("ids"))
        .groupBy("row_key")
        .applyInPandas(grown, "row_key long, ids array<int>")
        .withColumnRenamed("row_key", key)
    )
    joined = tall.drop("ids").join(trees, key).select(*rest, F.col("ids"))
    return short.unionByName(joined)


def decode_ids(rows: DataFrame, ids_col: str, path: str, out: str = "decoded") -> DataFrame:
    """Adds the text that the ids stand for, added tokens included; bytes that are no UTF-8
    become U+FFFD. Null ids give null, an empty list the empty text."""
    return rows.withColumn(out, decoder(path)(F.col(f"`{ids_col}`")))


def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.json")
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    rows = encode_ids(docs, "text", path).select("doc_id", "ids")
    decoded = decode_ids(rows, "ids", path)
    return decoded.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        ids_sha256("ids").alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"),
    )


QUERIES = {"op1_bpe": op1_bpe}
