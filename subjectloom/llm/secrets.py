"""Secrets in texts: known patterns, and strings that a tokenizer can hardly shorten."""

from __future__ import annotations

import base64
import functools
import re
from collections.abc import Collection

import pandas as pd
import public_tokenizers
import tiktoken
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from subjectloom.llm.common import in_small_batches, table, text_of

# The kinds in their order, and the base patterns.
KINDS = ("assign", "access", "hex", "random")
_KEYS = ("password", "passwd", "secret", "token", "api_?key")
MIN_VALUE, MIN_ACCESS, MIN_HEX = 12, 18, 16


def _either_case(word: str) -> str:
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)


ASSIGN = re.compile(
    f"({'|'.join(map(_either_case, _KEYS))})[\"']?\\x20*[:=]\\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
)
ACCESS = re.compile("AKIA[A-Z0-9]+")
# A run is taken whole, so one that is too short holds none that is long enough.
HEX = re.compile(f"(?<![0-9a-f])[0-9a-f]{{{MIN_HEX},}}")

#: Runs of these characters are tried if they are at least so long ...
MIN_RUN = 16
RUN = re.compile(f"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{{{MIN_RUN},}}")
#: ... and are random if a token covers no more than so many characters on average.
MAX_CHARS_PER_TOKEN = 2.0
#: The vocabulary that tells words of identifiers if the caller gives none.
VOCABULARY = "byte_bpe_50k.tiktoken"

# Lengths of usual digests in hexadecimal (128 to 512 bits).
DIGEST_LENGTHS = (32, 40, 48, 56, 64, 96, 128)
_DIGEST = re.compile("|".join(f"[0-9a-f]{{{n}}}|[0-9A-F]{{{n}}}" for n in DIGEST_LENGTHS))
_UUID = re.compile("[0-9A-Fa-f]{8}(-[0-9A-Fa-f]{4}){3}-[0-9A-Fa-f]{12}")
#: Words, numbers and version-like endings joined by separators, in any case style.
_IDENTIFIER = re.compile(
    "[/_=+-]*([A-Za-z]+[0-9]{0,4}|[0-9]+)([/_=+-]+([A-Za-z]+[0-9]{0,4}|[0-9]+))*[/_=+-]*"
)
#: The letters of a run by case changes; digits and separators end a part too.
_PART = re.compile("[A-Z]?[a-z]+|[A-Z]+(?![a-z])|[A-Z]+")
#: Shorter parts may be words or not.
WORD_LETTERS = 3

Span = tuple[str, int, int]


@functools.cache
def vocabulary(path: str) -> tiktoken.Encoding:
    with open(path, "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    return tiktoken.Encoding(
        "ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
    )


def base_spans(text: str) -> list[Span]:
    """The spans of the base patterns, each kind leftmost and without overlaps."""
    found: list[Span] = []
    if ":" in text or "=" in text:
        found += [
            ("assign", m.start(), m.end()) for m in ASSIGN.finditer(text)
            if len(m.group(2)) >= MIN_VALUE
        ]
    if "AKIA" in text:
        found += [
            ("access", m.start(), m.end()) for m in ACCESS.finditer(text)
            if m.end() - m.start() >= MIN_ACCESS
        ]
    found += [("hex", m.start(), m.end()) for m in HEX.finditer(text)]
    return sorted(found, key=lambda s: (s[1], KINDS.index(s[0])))


def is_identifier(run: str, encoding: tiktoken.Encoding) -> bool:
    """Numbers alone, or words: parts of three or more letters hold half of the letters at
    least, and a token covers as many of theirs as it hardly does in random ones, in the case
    that suits the vocabulary best."""
    if not _IDENTIFIER.fullmatch(run):
        return False
    parts = _PART.findall(run)
    words = [p for p in parts if len(p) >= WORD_LETTERS]
    letters = sum(map(len, words))
    if 2 * letters < sum(map(len, parts)):
        return False
    tokens = sum(
        min(len(encoding.encode_ordinary(w)) for w in {p, p.lower(), p.capitalize()})
        for p in words
    )
    return letters >= MAX_CHARS_PER_TOKEN * tokens


def is_known(
    run: str, known: Collection[str] = (), encoding: tiktoken.Encoding | None = None
) -> bool:
    """Digests of usual lengths, UUIDs, identifiers, and whatever the caller lists."""
    if run in known or _DIGEST.fullmatch(run) or _UUID.fullmatch(run):
        return True
    return is_identifier(run, encoding or vocabulary(public_tokenizers.path(VOCABULARY)))


def random_spans(
    text: str, taken: list[Span], encoding: tiktoken.Encoding, known: Collection[str] = ()
) -> list[Span]:
    """Runs with few characters per token that no base span touches."""
    found = []
    order = sorted((x, y) for _, x, y in taken)
    at = reach = 0  # spans that begin before the end of the run, and where the last of them ends
    for m in RUN.finditer(text):
        a, b = m.span()
        while at < len(order) and order[at][0] < b:
            reach = max(reach, order[at][1])
            at += 1
        if reach > a:
            continue
        if b - a > MAX_CHARS_PER_TOKEN * len(encoding.encode_ordinary(m.group())):
            continue
        if not is_known(m.group(), known, encoding):
            found.append(("random", a, b))
    return found


def spans(text: str, encoding: tiktoken.Encoding, known: Collection[str] = ()) -> list[Span]:
    base = base_spans(text)
    added = random_spans(text, base, encoding, known)
    return sorted(base + added, key=lambda s: (s[1], KINDS.index(s[0])))


def find_secrets(
    docs: DataFrame, text_col: str, vocabulary_path: str, known: Collection[str] = ()
) -> DataFrame:
    """Adds ``secrets``, an array of ``(kind, start, end)`` in code points, in place of a column
    of that name, ordered by start and then kind.

    Whole texts are searched, each on its own, so repeated rows get equal spans. ``known`` are
    strings that are no secrets, such as digests published elsewhere; it travels with the code
    and is meant for lists of modest size. A null or empty text has no spans.
    """
    in_small_batches(docs.sparkSession)
    listed = frozenset(known)

    @F.pandas_udf("array<struct<kind:string,start:int,end:int>>")
    def search(texts: pd.Series) -> pd.Series:
        encoding = vocabulary(vocabulary_path)
        return pd.Series(
            [[{"kind": k, "start": a, "end": b} for k, a, b in spans(t, encoding, listed)]
             for t in texts], dtype=object,
        )

    return docs.withColumn("secrets", search(text_of(text_col)))


def op5_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = find_secrets(docs, "text", public_tokenizers.path(VOCABULARY))

    def listed(kinds):
        chosen = F.filter("secrets", lambda s: s["kind"].isin(*kinds))
        return F.array_join(
            F.transform(chosen, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ","
        )

    def number(kind):
        return F.size(F.filter("secrets", lambda s: s["kind"] == kind)).cast("long")

    return found.select(
        "doc_id", *[number(kind).alias(f"n_{kind}") for kind in KINDS[:3]],
        F.sha2(listed(KINDS[:3]), 256).alias("base_sha256"), listed(KINDS).alias("spans"),
    )


QUERIES = {"op5_secrets": op5_secrets}
