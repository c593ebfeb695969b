"""Near duplicates: an exact Jaccard join on word shingles by grouped prefixes."""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from subjectloom.llm.common import (
    SHINGLE_WORDS, free_name, in_small_batches, scanned, table, text_of, with_lasting_key,
)
from subjectloom.llm.components import components
from subjectloom.llm.hashing import AS_WORDS, shingles, word_hashes
from subjectloom.operators.lookup import fits_broadcast
from subjectloom.session import release, written

#: Documents link when 100 * intersection >= PERCENT * union.
PERCENT = 75
#: Shingles known as frequent stand last in every prefix. The list of them is broadcast, the most
#: frequent first, so many at most; it decides about the work to be done and not about results.
FREQUENT = 1 << 17
#: Shingles counted together in a task, to find the frequent ones.
COUNTED = 1 << 21
#: Sizes of sets fall into classes, each so much wider than the one before.
CLASS_RATIO = 1.1


class Order(NamedTuple):
    """The frequent shingles in the order of their hashes, and how often each was seen."""

    shingles: np.ndarray
    seen: np.ndarray

    def prefix(self, own: np.ndarray, percent: int) -> tuple[np.ndarray, int]:
        """The first shingles of a set, rare ones before frequent ones, else by hash, and how
        many of them are rare. Two sets that link have one of them in common."""
        length = len(own) - -(-percent * len(own) // 100) + 1 if len(own) else 0
        if not len(self.shingles):
            return own[:length], length
        at = np.minimum(np.searchsorted(self.shingles, own), len(self.shingles) - 1)
        frequent = self.shingles[at] == own
        rare = own[~frequent]
        if len(rare) >= length:
            return rare[:length], length
        rest, seen = own[frequent], self.seen[at[frequent]]
        return np.concatenate([rare, rest[np.lexsort((rest, seen))]])[:length], len(rare)


def _sets(texts: list[str | None], width: int) -> Iterator[np.ndarray]:
    for words in word_hashes(texts, AS_WORDS):
        yield shingles(words, width)


def frequent_shingles(rows: DataFrame, width: int, most: int) -> Order:
    """Shingles that some task saw repeatedly, with the sum of those counts: all that occur in a
    noticeable share of the documents are among them. Only these are shuffled."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[np.ndarray] = []
        size = 0

        def repeated() -> pd.DataFrame:
            found, times = np.unique(np.concatenate(held), return_counts=True)
            found, times = found[times > 1], times[times > 1]
            return pd.DataFrame({"shingle": found.view(np.int64), "seen": times})

        for batch in batches:
            for own in _sets(batch["text"].to_list(), width):
                held.append(own)
                size += len(own)
                if size >= COUNTED:
                    yield repeated()
                    held, size = [], 0
        if held:
            yield repeated()

    counted = rows.select("text").mapInPandas(count, "shingle long, seen long").groupBy(
        "shingle").agg(F.sum("seen").alias("seen"))
    top = counted.orderBy(F.desc("seen"), "shingle").limit(most).toPandas()
    found = top["shingle"].to_numpy(np.int64).view(np.uint64)
    by_hash = np.argsort(found)
    return Order(found[by_hash], top["seen"].to_numpy(np.int64)[by_hash])


_LONG = T.LongType()


def _prefixes(rows: DataFrame, order: Order, width: int, percent: int) -> DataFrame:
    """``(row_key, id, n, low, high, grp, rare, prefix)``: the size and a 128-bit digest of each
    set, and the group of its prefix and size. The prefix, its first ``rare`` shingles the ones
    that are not known as frequent, is given once per task and group."""
    shared = rows.sparkSession.sparkContext.broadcast(order)
    schema = T.StructType(
        [rows.schema["row_key"], rows.schema["id"],
         *[T.StructField(c, _LONG) for c in ("n", "low", "high", "grp", "rare")],
         T.StructField("prefix", T.ArrayType(_LONG))]
    )

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        given: set[int] = set()
        for batch in batches:
            numbers, prefixes = [], []
            for own in _sets(batch.column("text").to_pylist(), width):
                digest = xxhash.xxh3_128_digest(own.tobytes())
                low, high = np.frombuffer(digest, np.int64).tolist()
                first, rare = shared.value.prefix(own, percent)
                group = xxhash.xxh3_64_intdigest(first.tobytes(), seed=len(own)) - 2**63
                numbers.append((len(own), low, high, group, rare))
                fresh = len(own) > 0 and group not in given
                prefixes.append(first.view(np.int64) if fresh else None)
                given.add(group)
            columns = np.array(numbers, np.int64).reshape(-1, 5).T
            yield pa.RecordBatch.from_arrays(
                [batch.column("row_key"), batch.column("id"),
                 *[pa.array(c, pa.int64()) for c in columns],
                 pa.array(prefixes, pa.list_(pa.int64()))],
                names=[f.name for f in schema],
            )

    return rows.mapInArrow(build, schema)


def _lists(listed: DataFrame) -> DataFrame:
    """``(shingle, ahead)`` of the shingles that several groups have in their prefixes, with
    the group that has it furthest ahead."""
    return listed.groupBy("shingle").agg(
        F.min("grp").alias("first"), F.max("grp").alias("last"),
        F.min(F.struct("at", "grp", "n")).alias("ahead"),
    ).where("first <> last").select("shingle", "ahead")


def _members(sized: DataFrame) -> DataFrame:
    """``(shingle, grp, n, at, ahead)``: the lists of two groups or more.

    Most shingles are rare, and most of those stand in one list of one. A rare shingle has few
    rows, so they are shuffled once, as they are, and both counted and joined from that. The
    frequent ones are aggregated before the shuffle, and their join can be split.
    """
    listed = sized.where("prefix IS NOT NULL").select(
        "grp", "n", "rare", F.posexplode("prefix").alias("at", "shingle")
    )
    columns = ["grp", "n", "at", "shingle"]
    rare = listed.where("at < rare").select(*columns).repartition("shingle")
    often = listed.where("at >= rare").select(*columns)
    lists = written(_lists(often), "lists")
    members = rare.join(_lists(rare), "shingle").distinct().unionByName(
        often.join(lists, "shingle").distinct()
    )
    members = written(members, "members")
    release(lists)
    return members


def _may_link(n: Column, at: Column, m: Column, to: Column, percent: int) -> Column:
    """Whether two sets of sizes ``n`` and ``m`` can link that share the shingle at places ``at``
    and ``to`` of their prefixes and none before: sizes within the ratio, and enough shingles
    left from there on. Of a pair that links, the first shared shingle passes."""
    left = F.least(n - at, m - to)
    return (
        (100 * F.least(n, m) >= percent * F.greatest(n, m))
        & ((100 + percent) * left >= percent * (n + m))
    )


def _linker(width: int, percent: int):
    @F.pandas_udf(T.BooleanType())
    def linked(left: pd.Series, right: pd.Series) -> pd.Series:
        known: dict[str, np.ndarray] = {}

        def set_of(text: str) -> np.ndarray:
            if text not in known:
                if len(known) >= 256:
                    known.clear()
                known[text] = next(_sets([text], width))
            return known[text]

        out = []
        for x, y in zip(left, right, strict=True):
            a, b = set_of(x), set_of(y)
            both = len(np.intersect1d(a, b, assume_unique=True))
            out.append(100 * both >= percent * (len(a) + len(b) - both))
        return pd.Series(out, dtype=bool)

    return linked


def _verified(pairs: DataFrame, rows: DataFrame, width: int, percent: int) -> DataFrame:
    """The pairs ``(a, b)`` of row keys whose sets link. Only texts that occur in a pair are
    moved: by a broadcast of their keys if that is small, else by a shuffle."""
    pairs = written(pairs, "pairs")
    wanted = pairs.select(F.col("a").alias("row_key")).union(pairs.select("b")).distinct()
    wanted = written(wanted, "pair-keys")
    keys = F.broadcast(wanted) if fits_broadcast(wanted) else wanted
    texts = written(rows.select("row_key", "text").join(keys, "row_key", "left_semi"), "pair-texts")

    def side(name: str) -> DataFrame:
        return texts.select(F.col("row_key").alias(name), F.col("text").alias(f"text_{name}"))

    joined = pairs.join(side("a"), "a").join(side("b"), "b")
    checked = joined.withColumn("linked", _linker(width, percent)("text_a", "text_b"))
    links = written(checked.where("linked").select("a", "b"), "verified")
    release(pairs, wanted, texts)
    return links


def _size_class(n: Column) -> Column:
    return F.floor(F.log(n.cast("double")) / float(np.log(CLASS_RATIO))).cast("int")


def _remaining(places: DataFrame, labels: DataFrame, percent: int) -> DataFrame:
    """Pairs of nodes that share a prefix shingle, may link, and are not yet in one component.

    In each shingle's list the members of its most frequent component stand on one side only,
    so a group of copies that is already one costs its size times the few that are not in it.
    The others look for partners by classes of sizes, no further than their place in the
    prefix lets a partner's size be.
    """
    now = places.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    now = written(now, "places")
    tally = now.groupBy("shingle", "label").agg(F.count(F.lit(1)).alias("rows"))
    open_lists = tally.groupBy("shingle").agg(
        F.max(F.struct("rows", "label")).alias("top"), F.count(F.lit(1)).alias("labels")
    ).where("labels > 1")
    open_lists = written(open_lists.select("shingle", F.col("top.label").alias("top")), "open")
    kept = now.join(open_lists, "shingle")
    left, n = F.col("n") - F.col("at"), F.col("n")
    smallest = F.ceil(n * percent / 100)
    largest = F.least(F.floor(n * 100 / percent), F.floor(left * (100 + percent) / percent) - n)
    minor = kept.where("label <> top").withColumn("low", smallest).withColumn("high", largest)
    minor = minor.where("low <= high").select(
        "shingle", F.col("node").alias("x"), F.col("n").alias("m"), F.col("at").alias("to"),
        F.col("label").alias("other"),
        F.explode(F.sequence(_size_class(F.col("low")), _size_class(F.col("high")))).alias("size"),
    )
    minor, all_rows = written(minor, "minor"), kept.withColumn("size", _size_class(F.col("n")))
    met = all_rows.join(minor, ["shingle", "size"]).where(
        (F.col("label") != F.col("other"))
        & ((F.col("label") == F.col("top")) | (F.col("node") < F.col("x")))
        & _may_link(F.col("n"), F.col("at"), F.col("m"), F.col("to"), percent)
    )
    return met.select(F.least("node", "x").alias("a"), F.greatest("node", "x").alias("b")).distinct()


def link_groups(
    docs: DataFrame, id_col: str, text_col: str, width: int = SHINGLE_WORDS,
    percent: int = PERCENT, frequent: int = FREQUENT,
) -> DataFrame:
    """``(row_key, id, n_shingles, component, component_id)`` per row of ``docs``; ``component``
    is a row key that all rows of a component share.

    A text's set holds its different shingles of ``width`` words (at most five), A-Z
    lower-cased; fewer words are one shingle. Two texts link when
    ``100 * |both| >= percent * |either|``; the component's id is the smallest id that can be
    reached by links, null ids aside (null if all are). A text without words, or null, has an
    empty set and links with nothing: its component is itself. Repeated rows and equal texts
    link. An empty table gives an empty result. Other columns play no part.

    Rows with equal sets are one node. Nodes with equal prefixes and sizes are one group; only
    groups are listed under the shingles of their prefix, and lists of one are dropped. In each
    list all are set against the one that has the shingle furthest ahead (of near copies, the
    text that the others derive from), group pairs are filtered by sizes and places, expanded
    to nodes and verified on their sets. What these links join needs no more comparing; every
    pair that is left in some list and could link is verified in a second step. So the result is
    that of comparing all pairs, while groups of copies cost their size, not its square.
    """
    in_small_batches(docs.sparkSession)
    key = free_name(docs, "row_key")
    rows = with_lasting_key(docs, key).select(
        F.col(key).alias("row_key"), F.col(f"`{id_col}`").alias("id"),
        text_of(text_col).alias("text"),
    )
    order = frequent_shingles(rows, width, frequent)
    made = written(_prefixes(rows, order, width, percent), "prefixes")
    narrow = written(made.select("row_key", "id", "n", "low", "high"), "sets")
    sized = made.where("n > 0")
    nodes = written(
        sized.groupBy("low", "high").agg(
            F.min("row_key").alias("node"), F.min("id").alias("id"), F.min("n").alias("n"),
            F.min("grp").alias("grp"),
        ),
        "nodes",
    )

    members = _members(sized)
    release(made)

    groups = nodes.groupBy("grp").agg(F.min("node").alias("chief"), F.count(F.lit(1)).alias("k"))
    groups = written(groups, "groups")
    near = members.where(
        (F.col("grp") != F.col("ahead.grp"))
        & _may_link(F.col("n"), F.col("at"), F.col("ahead.n"), F.col("ahead.at"), percent)
    ).select(F.col("ahead.grp").alias("lead"), "grp").distinct()
    chiefs = groups.select(F.col("grp").alias("lead"), F.col("chief").alias("a"))
    across = near.join(chiefs, "lead").join(
        nodes.select("grp", F.col("node").alias("b")), "grp"
    ).select("a", "b")
    several = nodes.join(groups.where("k > 1"), "grp")
    within = several.where("node <> chief").select(
        F.col("chief").alias("a"), F.col("node").alias("b")
    )
    links = _verified(across.union(within).distinct(), rows, width, percent)
    labels = components(links)

    places = members.select("shingle", "grp", "at").join(
        nodes.select("grp", "node", "n"), "grp"
    ).select("shingle", "node", "n", "at")
    own_lists = several.select(
        F.col("grp").alias("shingle"), "node", "n", F.lit(0).alias("at")
    )
    rest = _remaining(places.union(own_lists), labels, percent)
    more = _verified(rest, rows, width, percent)
    if not more.isEmpty():
        labels = components(links.union(more))

    found = nodes.join(labels, "node", "left").select(
        "low", "high", "id", F.coalesce("label", "node").alias("component")
    )
    found = written(found, "found")
    smallest = found.groupBy("component").agg(F.min("id").alias("component_id"))
    named = found.drop("id").join(smallest, "component")
    named = written(named.select("low", "high", "component", "component_id"), "named")
    linked = narrow.where("n > 0").join(named, ["low", "high"])
    alone = narrow.where("n = 0").withColumns(
        {"component": F.col("row_key"), "component_id": F.col("id")}
    )
    return linked.unionByName(alone).select(
        "row_key", "id", F.col("n").alias("n_shingles"), "component", "component_id"
    )


def one_of_each(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The rows of ``docs`` without their near duplicates: of each component the row with the
    smallest id stays, null ids last, of repeated rows the first. Rows without words stay, and
    so do rows that have nothing in common but their id."""
    docs = scanned(docs)
    key = free_name(docs, "row_key")
    place = F.struct(F.col("id").isNull().alias("no_id"), "id", "row_key")
    first = link_groups(docs, id_col, text_col).groupBy("component").agg(F.min(place).alias("one"))
    kept = written(first.select(F.col("one.row_key").alias(key)), "kept-rows")
    return with_lasting_key(docs, key).join(kept, key, "left_semi").drop(key)


def op9_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return link_groups(docs, "doc_id", "text").select(
        F.col("id").alias("doc_id"), "n_shingles", "component_id"
    )


QUERIES = {"op9_jaccard_join": op9_jaccard_join}
