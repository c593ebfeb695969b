"""Repeated passages: multi-line chunks with content-defined boundaries, and all runs of lines
with enough words, removed after a comparison of their bytes."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from subjectloom.llm.common import free_name, in_small_batches, table, text_of, with_lasting_key
from subjectloom.operators.lookup import fits_broadcast
from subjectloom.session import release, written

#: A chunk may end after a line where the hash rolled over this many lines leaves no remainder ...
WINDOW = 2
DIVISOR = 2
#: ... and the chunk has so many lines that are not blank. Shorter ones are never removed ...
MIN_LINES = 2
#: ... but for a line of so many words, which is always a chunk of its own. Runs of lines with so
#: many words are removed wherever they begin and end.
LONG_WORDS = 50

# Fixed value: an odd 64-bit multiplier without structure.
_FACTOR = 0x9E3779B97F4A7C15
_ALL = 2**64 - 1


def _hash(text: str) -> int:
    return xxhash.xxh3_64_intdigest(text.encode("utf-8", "surrogatepass"))


def is_long(line: str) -> bool:
    return len(line) >= 2 * LONG_WORDS - 1 and len(line.split()) >= LONG_WORDS


def chunks(lines: list[str]) -> list[tuple[int, int, bool]]:
    """``(first line, line after the last, whether it counts)`` of each chunk, in order.

    Where a chunk may end depends on the line there and the one before it only, so lines put in
    or taken out elsewhere in a text do not move the boundaries, but for the first that follows:
    a repeated passage falls into the same chunks wherever it stands, but for what lies before
    its first and after its last boundary.
    """
    found: list[tuple[int, int, bool]] = []
    start = full = before = 0
    for i, line in enumerate(lines):
        own = _hash(line)
        if is_long(line):
            if start < i:
                found.append((start, i, full >= MIN_LINES))
            found.append((i, i + 1, True))
            start, full, before = i + 1, 0, own
            continue
        full += bool(line.strip())
        rolled = (before * _FACTOR + own) & _ALL
        rolled = ((rolled ^ rolled >> 32) * _FACTOR & _ALL) >> 32
        if full >= MIN_LINES and i >= WINDOW - 1 and rolled % DIVISOR == 0:
            found.append((start, i + 1, True))
            start, full = i + 1, 0
        before = own
    if start < len(lines):
        found.append((start, len(lines), full >= MIN_LINES))
    return found


Spans = Callable[[list[str]], list[tuple[int, int]]]


def counted(lines: list[str]) -> list[tuple[int, int]]:
    """The chunks that count."""
    return [(a, b) for a, b, counts in chunks(lines) if counts]


def runs(lines: list[str]) -> set[tuple[int, int]]:
    """From every line on, and up to every line, the shortest run that has ``LONG_WORDS`` words.

    Any run of lines with so many words is covered by those of them that lie in it: from a line
    of it there are enough words to its end, or there are not and the run up to its end holds
    the line. So a repeated passage meets its first occurrence in all of its lines, wherever in
    its text it stands.
    """
    words = [len(line.split()) for line in lines]
    found = set()
    end = have = 0
    for start in range(len(lines)):
        while end < len(lines) and have < LONG_WORDS:
            have += words[end]
            end += 1
        if have < LONG_WORDS:
            break
        found.add((start, end))
        have -= words[start]
    start, have = len(lines), 0
    for end in range(len(lines), 0, -1):
        while start > 0 and have < LONG_WORDS:
            start -= 1
            have += words[start]
        if have < LONG_WORDS:
            break
        found.add((start, end))
        have -= words[end - 1]
    return found


def passages(lines: list[str]) -> list[tuple[int, int]]:
    """The chunks that count, the runs of enough words, and the whole text if it has a word, so
    that a copy of a text leaves nothing, however its last lines fall into chunks."""
    found = runs(lines).union(counted(lines))
    if any(map(str.strip, lines)):
        found.add((0, len(lines)))
    return sorted(found)


def _joined(lines: list[str], start: int, end: int) -> str:
    return "\n".join(lines[start:end])


def _occurrences(
    batches: Iterator[pa.RecordBatch], spans: Spans = counted
) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows, starts, ends, hashes = [], [], [], []
        for row, text in enumerate(batch.column("text").to_pylist()):
            lines = text.split("\n")
            for start, end in spans(lines):
                rows.append(row)
                starts.append(start)
                ends.append(end)
                hashes.append(_hash(_joined(lines, start, end)) - 2**63)
        where = pa.array(rows, pa.int64())
        yield pa.RecordBatch.from_arrays(
            [batch.column("row_key").take(where), batch.column("id").take(where),
             pa.array(starts, pa.int32()), pa.array(hashes, pa.int64()),
             pa.array(ends, pa.int32())],
            names=["row_key", "id", "at", "hash", "to"],
        )


def _all_occurrences(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    return _occurrences(batches, passages)


_LONGS = T.ArrayType(T.LongType())


_PIECES = T.ArrayType(
    T.StructType(
        [T.StructField("key", T.LongType()), T.StructField("start", T.IntegerType()),
         T.StructField("end", T.IntegerType()), T.StructField("piece", T.StringType()),
         T.StructField("hashes", _LONGS)]
    )
)


@F.pandas_udf(_PIECES)
def _later_pieces(texts: pd.Series, hits: pd.Series) -> pd.Series:
    """The stretches of each text that are to be the same as lines ``start`` to ``end`` of the row
    ``key``: hits that follow each other here and there are one."""
    out = []
    for text, own in zip(texts, hits, strict=True):
        lines, made = text.split("\n"), []
        later = [h for h in own if h["later"]]
        for h in sorted(later, key=lambda h: (h["key"], h["start"] - h["at"], h["at"])):
            shift = h["start"] - h["at"]
            last = made[-1] if made else None
            if last and last[:2] == [h["key"], shift] and h["at"] <= last[3]:
                last[3] = max(last[3], h["to"])
                last[4].append(h["hash"])
            else:
                made.append([h["key"], shift, h["at"], h["to"], [h["hash"]]])
        out.append([
            {"key": key, "start": at + shift, "end": to + shift, "piece": _joined(lines, at, to),
             "hashes": hashes}
            for key, shift, at, to, hashes in made
        ])
    return pd.Series(out, dtype=object)


@F.pandas_udf(T.ArrayType(T.StringType()))
def _cut_out(texts: pd.Series, starts: pd.Series, ends: pd.Series) -> pd.Series:
    return pd.Series([
        [_joined(text.split("\n"), a, b) for a, b in zip(first, after, strict=True)]
        for text, first, after in zip(texts, starts, ends, strict=True)
    ], dtype=object)


def _differing(touched: DataFrame, text: Column, key: str, hits: str) -> DataFrame:
    """The hashes of what is not the same, byte by byte, as its first occurrence. The texts that
    hold later occurrences give their pieces, those that hold first ones what is asked of them;
    pieces of the same lines meet."""
    one = F.explode(_later_pieces(text, F.col(hits))).alias("one")
    later = touched.where(F.exists(hits, lambda h: h["later"])).select(one).select("one.*")
    asked = later.select("key", "start", "end").distinct()
    asked = asked.groupBy(F.col("key").alias(key)).agg(
        F.collect_list("start").alias("starts"), F.collect_list("end").alias("ends")
    )
    firsts = touched.select(key, text.alias("text")).join(asked, key)
    firsts = firsts.select(
        F.col(key).alias("key"), F.explode(F.arrays_zip(
            F.col("starts").alias("start"), F.col("ends").alias("end"),
            _cut_out("text", "starts", "ends").alias("first"),
        )).alias("one"),
    ).select("key", "one.*")
    both = later.join(firsts, ["key", "start", "end"]).where("piece <> first")
    return both.select(F.explode("hashes").alias("hash")).distinct()


@F.pandas_udf(T.StructType([T.StructField("high", _LONGS), T.StructField("low", _LONGS)]))
def _digests(texts: pd.Series, starts: pd.Series, ends: pd.Series) -> pd.DataFrame:
    """128 bits of BLAKE2b of each of the spans asked for."""
    out = []
    for text, first, after in zip(texts, starts, ends, strict=True):
        lines = text.split("\n")
        made = [
            hashlib.blake2b(
                _joined(lines, a, b).encode("utf-8", "surrogatepass"), digest_size=16
            ).digest()
            for a, b in zip(first, after, strict=True)
        ]
        out.append([
            [int.from_bytes(d[half], "big", signed=True) for d in made]
            for half in (slice(8), slice(8, None))
        ])
    return pd.DataFrame(out, columns=["high", "low"])


_CUT = T.ArrayType(
    T.StructType([T.StructField("first", T.IntegerType()), T.StructField("last", T.IntegerType())])
)


@F.pandas_udf(T.StructType([T.StructField("text", T.StringType()), T.StructField("cut", _CUT)]))
def _without(texts: pd.Series, starts: pd.Series, ends: pd.Series) -> pd.DataFrame:
    """Each text without the spans given, and the lines they held (from 0, both ends); spans
    that overlap are one."""
    out = []
    for text, first, after in zip(texts, starts, ends, strict=True):
        if text is None or first is None:
            out.append((None, None))
            continue
        gone: list[list[int]] = []
        for a, b in sorted(zip(map(int, first), map(int, after), strict=True)):
            if gone and a < gone[-1][1]:
                gone[-1][1] = max(gone[-1][1], b)
            else:
                gone.append([a, b])
        lines, kept, at = text.split("\n"), [], 0
        for a, b in gone:
            kept += lines[at:a]
            at = b
        kept += lines[at:]
        out.append(("\n".join(kept), [{"first": a, "last": b - 1} for a, b in gone]))
    return pd.DataFrame(out, columns=["text", "cut"])


def remove_repeats(
    docs: DataFrame, id_col: str, text_col: str, whole: bool = False
) -> DataFrame:
    """``docs`` with every repeated chunk cut out but its first occurrence, and ``cut``, the
    stretches of lines taken from each text (in place of a column of that name). With ``whole``
    every repeated run of lines that has ``LONG_WORDS`` words is cut out as well, whole, and every
    text that is a copy of another becomes the empty text.

    The first occurrence is that in the row with the smallest id, null ids last, and there the
    one that stands first; of repeated rows one counts as first. Chunks and runs are repeated if
    their bytes are the same, in another text or further on in the same one, where they must not
    overlap their first occurrence. What is left of a text keeps its line breaks; a text of which
    all is repeats becomes the empty text. Each line cut still stands in an earlier place. A null
    text stays null, and nothing is cut from it or from an empty one. An empty table stays empty.
    Other columns stay as they are.

    What is gathered over the corpus is a hash per chunk or run. Only texts with a hash that
    occurs elsewhere are moved (if their keys are too many to be broadcast, all are); their
    repeated pieces meet their first occurrences, and bytes are compared. Where different ones
    share a hash, each keeps a first occurrence of its own.
    """
    in_small_batches(docs.sparkSession)
    key, hits_col, new = (free_name(docs, n) for n in ("row_key", "hits", "new"))
    columns = [c for c in docs.columns if c != "cut"]
    keyed = with_lasting_key(docs.select(*[F.col(f"`{c}`") for c in columns]), key)
    narrow = keyed.select(
        F.col(key).alias("row_key"), F.col(f"`{id_col}`").alias("id"),
        text_of(text_col).alias("text"),
    )
    schema = T.StructType(
        [narrow.schema["row_key"], narrow.schema["id"], T.StructField("at", T.IntegerType()),
         T.StructField("hash", T.LongType()), T.StructField("to", T.IntegerType())]
    )
    found = narrow.mapInArrow(_all_occurrences if whole else _occurrences, schema)
    found = written(found, "line-chunks")
    place = F.struct(F.col("id").isNull().alias("no_id"), "id", "row_key", "at", "to")
    repeated = found.groupBy("hash").agg(
        F.min(place).alias("first"), F.count(F.lit(1)).alias("n")
    ).where("n > 1")
    # Written, so that both sides of the next join are shuffled and a frequent hash can be split.
    repeated = written(
        repeated.select("hash", F.col("first.row_key").alias("key"),
                        F.col("first.at").alias("start"), F.col("first.to").alias("end")),
        "line-repeats",
    )
    later = (F.col("row_key") != F.col("key")) | (F.col("at") >= F.col("end"))
    hits = found.join(repeated, "hash").groupBy(F.col("row_key").alias(key)).agg(
        F.collect_list(
            F.struct("at", "to", "hash", later.alias("later"), "key", "start")
        ).alias(hits_col)
    )
    hits = written(hits, "line-hits")
    release(found, repeated)
    keys = hits.select(key)
    few = fits_broadcast(keys)
    if few:
        touched = keyed.join(F.broadcast(keys), key, "left_semi").join(hits, key)
        rest = keyed.join(F.broadcast(keys), key, "left_anti")
        touched = written(touched, "line-texts")
    else:
        joined = written(keyed.join(hits, key, "left"), "line-texts")
        release(hits)
        touched = joined.where(F.col(hits_col).isNotNull())
        rest = joined.where(F.col(hits_col).isNull())

    shared = written(_differing(touched, text_of(text_col), key, hits_col), "line-collisions")
    removed = F.filter(hits_col, lambda h: h["later"])
    if not shared.isEmpty():
        hit = touched.select(
            F.col(key).alias("row_key"), F.col(f"`{id_col}`").alias("id"),
            F.col(hits_col).alias("hits"),
            _digests(
                text_of(text_col), F.col(f"{hits_col}.at"), F.col(f"{hits_col}.to")
            ).alias("digests"),
        )
        compared = hit.select(
            "row_key", "id",
            F.explode(F.arrays_zip("hits", F.col("digests.high").alias("high"),
                                   F.col("digests.low").alias("low"))).alias("one"),
        ).select(
            "row_key", "id", "one.hits.at", "one.hits.to", "one.hits.hash", "one.high", "one.low"
        )
        told = compared.join(shared, "hash", "left_semi")
        firsts = told.groupBy("hash", "high", "low").agg(F.min(place).alias("first"))
        firsts = written(firsts, "line-firsts")
        again = (F.col("row_key") != F.col("first.row_key")) | (F.col("at") >= F.col("first.to"))
        told = told.join(firsts, ["hash", "high", "low"]).withColumn("again", again)
        fixed = free_name(touched, "fixed")
        touched = touched.join(
            told.groupBy(F.col("row_key").alias(key)).agg(
                F.collect_set(F.struct("at", "to", "again")).alias(fixed)
            ), key, "left",
        )

        def holds(h: Column, again: bool) -> Column:
            span = F.struct(h["at"].alias("at"), h["to"].alias("to"), F.lit(again).alias("again"))
            return F.coalesce(F.array_contains(F.col(fixed), span), F.lit(False))

        removed = F.filter(
            hits_col, lambda h: holds(h, True) | (h["later"] & ~holds(h, False))
        )
    removed = F.when(F.size(removed) > 0, removed)
    text = F.col(f"`{text_col}`")
    edited = touched.withColumn(new, _without(
        F.when(removed.isNotNull(), text), removed["at"], removed["to"]
    ))
    edited = edited.select(
        *[
            F.coalesce(F.col(f"{new}.text"), F.col(f"`{c}`")).alias(c) if c == text_col
            else F.col(f"`{c}`") for c in columns
        ],
        F.coalesce(F.col(f"{new}.cut"), F.array().cast(_CUT)).alias("cut"),
    )
    return edited.union(
        rest.select(*[F.col(f"`{c}`") for c in columns], F.array().cast(_CUT).alias("cut"))
    )


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    edited = remove_repeats(docs, "doc_id", "text", whole=True)
    lines = F.aggregate("cut", F.lit(0), lambda n, c: n + c["last"] - c["first"] + 1)
    spans = F.transform("cut", lambda c: F.concat_ws("-", c["first"], c["last"]))
    return edited.select(
        "doc_id", lines.cast("long").alias("lines_removed"),
        F.array_join(spans, ",").alias("lines_cut"),
        F.length(text_of("text")).cast("long").alias("chars_left"),
        F.sha2(text_of("text"), 256).alias("text_sha256"),
    )


QUERIES = {"op3_line_dedup": op3_line_dedup}
