"""Replacing tokens: stems by rule, lemmas through a table.

Stems follow from the token alone, so they are put in where the tokens are: once per distinct
token of an Arrow batch, with nothing exploded or shuffled. Lemmas come from a table:

* A table that can be broadcast is applied to whole Arrow batches of token lists, in place:
  nothing is exploded and no document is shuffled.
* From a larger table only the frequent tokens are broadcast: they are nearly all occurrences,
  and all of the skew. What is left, rare tokens by definition, is the only part that is
  shuffled by token. Documents are then shuffled once, by id and before they are exploded, so
  putting the tokens together again needs no further exchange.

Both ways give the same rows: the table has one replacement per key before it is measured, and
documents are told apart by a key of their own, not by the user's id.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from subjectloom.functions.stemming import porter_stem
from subjectloom.operators.lookup import fits_broadcast, row_bytes, within_limits
from subjectloom.session import settled


def distinct_tokens(df: DataFrame, tokens_col: str = "tokens") -> DataFrame:
    """``(token)``: deduplicated inside each document first, so less is shuffled."""
    return df.select(F.explode(F.array_distinct(tokens_col)).alias("token")).distinct()


def noun_tags(tokens: Column) -> Column:
    """The tag list used where no tagger has been run: every token counts as a noun."""
    return F.transform(tokens, lambda _: F.lit("n"))


def lemma_tags(tags: Column) -> Column:
    """Treebank tags to lemma-table tags by first letter; anything else is a noun."""
    def one(tag: Column) -> Column:
        return (
            F.when(tag.startswith("J"), "a")
            .when(tag.startswith("V"), "v")
            .when(tag.startswith("R"), "r")
            .otherwise("n")
        )

    return F.transform(tags, one)


def replace_tokens(
    df: DataFrame,
    table: DataFrame,
    id_col: str,
    tokens_col: str = "tokens",
    tags_col: str | None = None,
) -> DataFrame:
    """``(id, tokens)`` with every token found in ``table`` replaced, order kept.

    ``table`` is ``(token, replacement)``, or ``(token, tag, replacement)`` when ``tags_col``
    names an array that runs parallel to the tokens. Tokens it lacks stay as they are; of
    several replacements for a key the smallest counts, and rows without a key count for none.
    Rows of ``df`` with the same id, or with none, stay rows of their own; null tokens give an
    empty list. ``df`` is read more than once if the table is large, so it should be a table or
    a narrow projection of one.
    """
    keys = ["token"] if tags_col is None else ["token", "tag"]
    known = table.dropna(subset=[*keys, "replacement"]).groupBy(*keys)
    table = settled(known.agg(F.min("replacement").alias("replacement")))
    if fits_broadcast(table):
        return _replace_in_place(df, table, id_col, tokens_col, tags_col)
    pair = F.transform(F.col(tokens_col), lambda t: F.struct(t.alias("token")))
    if tags_col is not None:
        pair = F.zip_with(
            tokens_col, tags_col, lambda t, g: F.struct(t.alias("token"), g.alias("tag"))
        )
    exploded = (
        df.select(F.monotonically_increasing_id().alias("_row"), id_col, pair.alias("_pairs"))
        .repartition("_row")
        .select("_row", id_col, F.posexplode_outer("_pairs").alias("_pos", "_pair"))
        .select("_row", id_col, "_pos", "_pair.*")
    )
    placed = _replace_by_frequency(exploded, table, keys, id_col)
    return placed.select(
        id_col, F.transform(F.array_sort("_placed"), lambda x: x["t"]).alias(tokens_col)
    )


def _key(tokens: pa.Array, tags: pa.Array | None) -> pa.Array:
    """Token and tag as one text; the length in front keeps any two pairs apart."""
    if tags is None:
        return tokens
    sizes = pc.binary_length(tokens).cast(pa.string())
    return pc.binary_join_element_wise(sizes, tokens, tags, ":")


def _replace_in_place(
    df: DataFrame, table: DataFrame, id_col: str, tokens_col: str, tags_col: str | None
) -> DataFrame:
    """Looks up each different token of a batch once, in a dictionary made once per task."""
    entries = table.toArrow().combine_chunks()
    known = _key(entries["token"], None if tags_col is None else entries["tag"])
    shared = df.sparkSession.sparkContext.broadcast(
        (known.combine_chunks(), entries["replacement"].combine_chunks())
    )
    schema = T.StructType([
        df.schema[id_col], T.StructField(tokens_col, T.ArrayType(T.StringType())),
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, replacements = shared.value
        table = dict(zip(names.to_pylist(), replacements.to_pylist(), strict=True))
        for batch in batches:
            lists = batch.column(tokens_col)
            tokens = lists.flatten()
            tags = None if tags_col is None else batch.column(tags_col).flatten()
            coded = _key(tokens, tags).dictionary_encode()
            found = pa.array([table.get(k) for k in coded.dictionary.to_pylist()], pa.string())
            new = pc.coalesce(found.take(coded.indices), tokens)
            sizes = pc.fill_null(pc.list_value_length(lists), 0)
            ends = pc.cumulative_sum(sizes)
            offsets = pa.concat_arrays([pa.array([0], pa.int32()), ends.cast(pa.int32())])
            yield pa.RecordBatch.from_arrays(
                [batch.column(id_col), pa.ListArray.from_arrays(offsets, new)],
                names=[id_col, tokens_col],
            )

    wanted = [id_col, tokens_col, *([tags_col] if tags_col else [])]
    return df.select(*wanted).mapInArrow(run, schema)


def _gather(joined: DataFrame, id_col: str) -> DataFrame:
    """Tokens of a document with their places; none for a document without tokens."""
    placed = F.when(
        F.col("_pos").isNotNull(),
        F.struct("_pos", F.coalesce("replacement", "token").alias("t")),
    )
    return joined.groupBy("_row").agg(
        F.first(id_col).alias("_id"), F.collect_list(placed).alias("_placed")
    )


def _replace_by_frequency(
    exploded: DataFrame, table: DataFrame, keys: list[str], id_col: str
) -> DataFrame:
    counted = exploded.where("_pos IS NOT NULL").groupBy(*keys).agg(F.count("*").alias("n"))
    known = settled(counted.join(table, keys, "left"))
    frequent = known.where(F.col("n") >= _frequent_from(known)).withColumnRenamed("n", "_n")
    joined = exploded.join(F.broadcast(frequent), keys, "left")
    settled_here = F.col("_n").isNotNull() | F.col("_pos").isNull()
    done = _gather(joined.where(settled_here), id_col)
    rare = joined.where(~settled_here).select("_row", id_col, "_pos", *keys)
    rest = _gather(rare.join(table, keys, "left"), id_col)
    rest = rest.withColumnsRenamed({"_placed": "_rare", "_id": "_other"})
    none = F.array().cast(done.schema["_placed"].dataType)
    return done.join(rest, "_row", "full").select(
        F.coalesce("_id", "_other").alias(id_col),
        F.concat(F.coalesce("_placed", none), F.coalesce("_rare", none)).alias("_placed"),
    )


def _frequent_from(known: DataFrame) -> int:
    """The lowest power of two such that the tokens occurring at least that often stay within
    the broadcast limits; read off a table with one row per power."""
    power = F.floor(F.log2("n")).cast("int")
    sizes = known.groupBy(power.alias("power")).agg(
        F.count("*").alias("rows"), F.sum(row_bytes(known)).alias("bytes")
    )
    rows = size = 0
    lowest = None
    for r in sorted(sizes.collect(), key=lambda r: -r["power"]):
        rows, size = rows + r["rows"], size + r["bytes"]
        if not within_limits(rows, size):
            break
        lowest = r["power"]
    return 2**62 if lowest is None else 2**lowest


def stem_tokens(df: DataFrame, tokens_col: str = "tokens") -> DataFrame:
    """``df`` with every token of ``tokens_col`` stemmed; all other columns pass through. The
    work is done once per distinct token of a batch, in the task that holds the document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.get_field_index(tokens_col)
            lists = batch.column(at)
            coded = lists.flatten().dictionary_encode()
            stems = [porter_stem(t) for t in coded.dictionary.to_pylist()]
            new = pa.array(stems, pa.string()).take(coded.indices)
            sizes = pc.fill_null(pc.list_value_length(lists), 0)
            ends = pc.cumulative_sum(sizes).cast(pa.int32())
            offsets = pa.concat_arrays([pa.array([0], pa.int32()), ends])
            columns = [*batch.columns]
            columns[at] = pa.ListArray.from_arrays(offsets, new)
            yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names)

    return df.mapInArrow(run, df.schema)


def lemmatize_tokens(
    df: DataFrame,
    lemmas: DataFrame,
    id_col: str,
    tokens_col: str = "tokens",
    tags_col: str | None = None,
) -> DataFrame:
    """``(id, tokens)`` with tokens replaced by the lemmas of a user-supplied table
    ``(token, tag, lemma)``. Without tags every token is looked up as a noun."""
    named = lemmas.withColumnRenamed("lemma", "replacement")
    tags = noun_tags(F.col(tokens_col)) if tags_col is None else lemma_tags(F.col(tags_col))
    return replace_tokens(df.withColumn("_tags", tags), named, id_col, tokens_col, "_tags")
