"""Ranked lexical search by NRA: lists sorted by impact are read from their tops, and each
document's score lies between two bounds until the reading has told enough."""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from subjectloom.llm.common import in_small_batches, table
from subjectloom.llm.hashing import AS_TERMS
from subjectloom.session import release, written

# Fixed values of the registered query: results per item, and the formula's constants.
TOP = 10
WEIGHT_UNIT = 1000
IMPACT_UNIT = 1_000_000_000
TF_UNIT = 1000
LENGTH_UNIT = 8
PERCENT_B = 90

#: Bytes of text whose words are split at once.
SEGMENT = 1 << 20
#: Items are worked on together up to so many different terms; the list of them goes to all tasks.
TERMS = 1 << 20
#: Documents, and entries of their lists, that a task ranks at once.
DOCUMENTS = 1 << 14
ENTRIES = 1 << 21
#: Entries first read of each list; then twice as many, and so on.
FIRST = 32
#: Groups that an item's candidates fall into before the last ranking.
GROUPS = 64


def terms(data: bytes) -> Iterator[list[bytes]]:
    """The terms of a text in UTF-8, some at a time: runs of ASCII letters and digits and of
    all that is not ASCII, with A-Z lower-cased."""
    at = 0
    while len(data) - at > SEGMENT:
        to = at + SEGMENT
        while to < len(data) and data[to] != 32 and AS_TERMS[data[to]] != 32:
            to += 1
        yield data[at:to].translate(AS_TERMS).split()
        at = to
    yield data[at:].translate(AS_TERMS).split()


def _texts(column: pa.Array) -> list[bytes]:
    return [t or b"" for t in column.cast(pa.binary()).to_pylist()]


class Corpus(NamedTuple):
    """What all documents together say: how many have a term, and how many terms they have."""

    documents: int
    terms: int

    def weight(self, df: int) -> int:
        return math.floor(WEIGHT_UNIT * math.log((2 * self.documents + 2) / (2 * df + 1)))

    def impacts(self, weight: np.ndarray, tf: np.ndarray, length: np.ndarray) -> np.ndarray:
        """What terms add to scores, given how often they occur in texts of such lengths."""
        m = 100 - PERCENT_B + PERCENT_B * length * self.documents // self.terms
        return weight * (IMPACT_UNIT * tf // (TF_UNIT * tf + LENGTH_UNIT * m))


def _entries(docs: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """``(doc_id, n, terms, tfs)`` per document: its number of terms with repeats, and those of
    the vocabulary that it holds, with how often."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in batches:
            lengths, found, often = [], [], []
            for data in _texts(batch.column("text")):
                counts: Counter[bytes] = Counter()
                for some in terms(data):
                    counts.update(some)
                own = [(known[t], c) for t, c in counts.items() if t in known]
                lengths.append(counts.total())
                found.append([t for t, _ in own])
                often.append([c for _, c in own])
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(lengths, pa.int64()),
                 pa.array(found, pa.list_(pa.int32())), pa.array(often, pa.list_(pa.int64()))],
                names=["doc_id", "n", "terms", "tfs"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.mapInArrow(count, f"doc_id {kind}, n long, terms array<int>, tfs array<long>")


def _statistics(entries: DataFrame, size: int) -> tuple[Corpus, np.ndarray]:
    """The corpus, and for each term how many documents hold it."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df, rows, total = np.zeros(size, np.int64), 0, 0
        for batch in batches:
            df += np.bincount(batch.column("terms").flatten(), minlength=size)
            n = batch.column("n").to_numpy()
            rows, total = rows + int((n > 0).sum()), total + int(n.sum())
        used = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.append(used, [-1, -2])), pa.array(np.append(df[used], [rows, total]))],
            names=["term", "n"],
        )

    counted = entries.select("n", "terms").mapInArrow(count, "term long, n long")
    got = counted.groupBy("term").agg(F.sum("n").alias("n")).toArrow()
    sums = dict(zip(got["term"].to_pylist(), got["n"].to_pylist(), strict=True))
    df = np.zeros(size, np.int64)
    for term, n in sums.items():
        if term >= 0:
            df[term] = n
    return Corpus(sums.get(-1, 0), sums.get(-2, 0)), df


def nra(
    lists: list[tuple[np.ndarray, np.ndarray]], size: int, top: int, floor: int = 0,
) -> tuple[np.ndarray, np.ndarray, int]:
    """Documents and scores among which are all of the ``top`` best of ``size`` documents that
    score ``floor`` or more and above 0, and how many entries were read.

    Each list holds different documents and what they gain from it, highest first. All are read
    in step. What a document has gained so far is the least it can score; the most is that plus
    the next entry of each list it has not been met in. Reading goes on until every document
    that may still be among the best has both equal, ties included.
    """
    least = np.zeros(size, np.int64)
    at, step, read = 0, FIRST, 0
    while True:
        for docs, gains in lists:
            least[docs[at : at + step]] += gains[at : at + step]
            read += len(docs[at : at + step])
        at, step = at + step, step * 2
        heads = np.array([g[at] if at < len(g) else 0 for _, g in lists], np.int64)
        rest = int(heads.sum())
        last = max(floor, 1)
        if top <= size:
            last = max(last, int(np.partition(least, size - top)[size - top]))
        if rest and rest >= last:
            continue
        most = least + rest
        for (docs, _), head in zip(lists, heads, strict=True):
            if head:
                most[docs[:at]] -= head
        open_ = np.flatnonzero((most >= last) & (least > 0))
        if (most[open_] == least[open_]).all():
            return open_, least[open_], read


class _Shard:
    """Some documents' lists, by term and from the highest impact on."""

    def __init__(self, rows: pa.Table, corpus: Corpus, weights: np.ndarray):
        n = rows["n"].to_numpy()
        column = rows["terms"].combine_chunks()
        doc = np.repeat(np.arange(len(n)), np.asarray(pc.list_value_length(column)))
        term = column.flatten().to_numpy()
        tf = rows["tfs"].combine_chunks().flatten().to_numpy()
        gain = corpus.impacts(weights[term], tf, n[doc]) if len(term) else tf
        keep = np.flatnonzero(gain > 0)
        doc, term, gain = doc[keep], term[keep], gain[keep]
        order = np.lexsort((-gain, term))
        self.ids, self.size = rows["doc_id"], len(n)
        self.doc, self.gain, term = doc[order], gain[order], term[order]
        self.starts = np.searchsorted(term, np.arange(len(weights) + 1))

    def best(self, own: np.ndarray, top: int, floor: int) -> tuple[np.ndarray, np.ndarray]:
        lists = []
        for a, b in zip(self.starts[own].tolist(), self.starts[own + 1].tolist(), strict=True):
            if a < b:
                lists.append((self.doc[a:b], self.gain[a:b]))
        if not lists:
            return np.empty(0, np.int64), np.empty(0, np.int64)
        docs, scores, _ = nra(lists, self.size, top, floor)
        return docs, scores


def _ranked_in_task(
    entries: DataFrame, items: list[tuple[int, np.ndarray]], corpus: Corpus, weights: np.ndarray,
    top: int, documents: int, most: int,
) -> DataFrame:
    """``(item, doc_id, score)``: the best of each item among the documents of a task. What some
    documents have reached is what the next ones have to reach."""
    shared = entries.sparkSession.sparkContext.broadcast((items, weights))

    def rank(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items, weights = shared.value
        schema, found = None, {}

        def take(rows: pa.Table) -> None:
            shard = _Shard(rows, corpus, weights)
            for item, own in items:
                before = found.get(item)
                full = before is not None and before.num_rows == top
                docs, scores = shard.best(own, top, before["score"][top - 1].as_py() if full else 0)
                if not len(docs):
                    continue
                both = pa.table({"doc_id": shard.ids.take(docs), "score": scores})
                if before is not None:
                    both = pa.concat_tables([before, both])
                order = pc.sort_indices(both, sort_keys=[
                    ("score", "descending"), ("doc_id", "ascending")], null_placement="at_end")
                found[item] = both.take(order[:top])

        kept, rows, size = [], 0, 0
        for batch in batches:
            schema = batch.schema
            for at in range(0, len(batch), 1024):
                part = batch.slice(at, 1024)
                kept.append(part)
                rows, size = rows + len(part), size + len(part.column("terms").flatten())
                if rows >= documents or size >= most:
                    take(pa.Table.from_batches(kept))
                    kept, rows, size = [], 0, 0
        if kept:
            take(pa.Table.from_batches(kept))
        for item, best in found.items():
            yield from pa.table(
                {"item": pa.array([item] * len(best), pa.int64()), "doc_id": best["doc_id"],
                 "score": best["score"]}
            ).combine_chunks().to_batches()
        if not found and schema is not None:
            yield pa.RecordBatch.from_arrays(
                [pa.array([], pa.int64()), pa.array([], schema.field("doc_id").type),
                 pa.array([], pa.int64())], names=["item", "doc_id", "score"])

    kind = entries.schema["doc_id"].dataType.simpleString()
    return entries.mapInArrow(rank, f"item long, doc_id {kind}, score long")


def _item_terms(items: DataFrame) -> DataFrame:
    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = [sorted(set().union(*terms(data))) for data in _texts(batch.column("text"))]
            yield pa.RecordBatch.from_arrays(
                [batch.column("item"), batch.column("item_id"),
                 pa.array(own, pa.list_(pa.binary()))], names=["item", "item_id", "terms"])

    kind = items.schema["item_id"].dataType.simpleString()
    return items.mapInArrow(split, f"item long, item_id {kind}, terms array<binary>")


def search(
    docs: DataFrame, id_col: str, text_col: str, items: DataFrame, item_id: str, item_text: str,
    top: int = TOP, block_terms: int = TERMS, documents: int = DOCUMENTS, entries: int = ENTRIES,
) -> DataFrame:
    """``(item_id, rank, doc_id, score)``: the ``top`` documents of each item that score above 0,
    highest first, equal scores by ascending id (null ids last); fewer where there are fewer.

    A null or empty text has no terms; an item without terms, or whose terms no document has,
    gets no rows. Every row of both tables counts for itself: repeated documents are ranked one
    after the other, a repeated item gets its rows again. Other columns play no part. Empty
    tables give an empty result.

    Items are taken in blocks of about ``block_terms`` different terms. For each block the texts
    are read once; what is kept are the block's terms in each document. A task ranks the
    documents it reads, some thousands at a time, and hands on ``top`` rows an item.
    """
    spark = docs.sparkSession
    in_small_batches(spark)
    read = items.select(
        F.monotonically_increasing_id().alias("item"), F.col(f"`{item_id}`").alias("item_id"),
        F.col(f"`{item_text}`").cast("string").alias("text"),
    )
    asked = written(_item_terms(read), "search-items")
    size = asked.agg(F.sum(F.size("terms"))).first()[0] or 0
    blocks = max(1, -(-size // block_terms))
    rows = docs.select(
        F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text")
    )
    best = None
    for block in range(blocks):
        mine = asked.where(F.pmod(F.xxhash64("item"), F.lit(blocks)) == block)
        got = mine.select("item", "terms").toArrow()
        vocabulary: dict[bytes, int] = {}
        own = []
        for item, some in zip(got["item"].to_pylist(), got["terms"].to_pylist(), strict=True):
            own.append((item, np.array([vocabulary.setdefault(t, len(vocabulary)) for t in some],
                                       np.int64)))
        held = written(_entries(rows, vocabulary), "search-entries")
        corpus, df = _statistics(held, len(vocabulary))
        weights = np.array([corpus.weight(int(x)) for x in df], np.int64)
        found = written(
            _ranked_in_task(held, own, corpus, weights, top, documents, entries), "search-best"
        )
        release(held)
        best = found if best is None else best.union(found)
    group = F.pmod(F.xxhash64("doc_id"), F.lit(GROUPS))
    order = [F.desc("score"), F.col("doc_id").asc_nulls_last()]

    def cut(frame: DataFrame, *by: str) -> DataFrame:
        ranked = F.row_number().over(Window.partitionBy(*by).orderBy(*order))
        return frame.withColumn("rank", ranked).where(F.col("rank") <= top)

    best = cut(cut(best.withColumn("group", group), "item", "group").drop("rank"), "item")
    ids = asked.select("item", "item_id")
    return best.join(ids, "item").select("item_id", "rank", "doc_id", "score")


def op11_nra_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(
        table(spark, sf_dir, "documents"), "doc_id", "text",
        table(spark, sf_dir, "benchmark"), "item_id", "text",
    )


QUERIES = {"op11_nra_search": op11_nra_search}

_TERMS = (
    "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', "
    r"'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"
)

SQL = {
    "op11_nra_search": f"""
WITH split AS (
    SELECT row_number() OVER () AS k, doc_id, {_TERMS} AS terms FROM documents
), corpus AS (
    SELECT count(*) FILTER (len(terms) > 0) AS n, CAST(sum(len(terms)) AS BIGINT) AS l FROM split
), tf AS (
    SELECT k, doc_id, n, term, count(*) AS tf FROM (
        SELECT k, doc_id, len(terms) AS n, unnest(terms) AS term FROM split
    ) GROUP BY ALL
), weighed AS (
    SELECT term, CAST(floor(1000 * ln(CAST(2 * n + 2 AS DOUBLE) / (2 * df + 1))) AS BIGINT) AS w
    FROM (SELECT term, count(*) AS df FROM tf GROUP BY term) CROSS JOIN corpus
), gains AS (
    SELECT k, doc_id, term, w * ((1000000000 * tf) //
        (1000 * tf + 8 * (100 - 90 + (90 * tf.n * corpus.n) // corpus.l))) AS gain
    FROM tf JOIN weighed USING (term) CROSS JOIN corpus
), asked AS (
    SELECT DISTINCT i, item_id, unnest(terms) AS term FROM (
        SELECT row_number() OVER () AS i, item_id, {_TERMS} AS terms FROM benchmark)
), scored AS (
    SELECT i, item_id, k, doc_id, CAST(sum(gain) AS BIGINT) AS score
    FROM asked JOIN gains USING (term) GROUP BY ALL
), ranked AS (
    SELECT item_id, doc_id, score, CAST(row_number() OVER (
        PARTITION BY i ORDER BY score DESC, doc_id NULLS LAST) AS INTEGER) AS rank
    FROM scored WHERE score > 0
)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 10
""",
}
