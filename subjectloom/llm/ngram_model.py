"""Scores of texts by an interpolated modified Kneser-Ney model of words and pairs of words,
counted in Spark and kept as sorted arrays of hashes that workers map into memory."""

from __future__ import annotations

import shutil
import tempfile
import uuid
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from subjectloom.llm.common import free_name, in_small_batches, table
from subjectloom.llm.hashing import AS_WORDS, mix, word_hashes
from subjectloom.session import fresh_path, release, remove, written

#: Tokens whose hashes share an array, about; arrays are split by the first bits of the hash.
SHARD_TOKENS = 1 << 20
#: Bytes a token takes with the blank after it, to choose the number of arrays by.
TOKEN_BYTES = 6
#: Bytes of texts, and tokens of them, that are worked on at once.
GROUP_BYTES = 1 << 23
BLOCK = 1 << 20
#: Different hashes that a task counts before it hands them on.
CHUNK = 1 << 22
#: Every token's logarithm is rounded to so many parts of one, so that sums are exact.
UNIT = 1_000_000_000

# The hash of the end of a text, which is a token like words, and the number that
# stands for its beginning. Factors and inverses modulo 2**64 of hashing.mix.
END = np.uint64(0x5851F42D4C957F2D)
BEGIN = (1 << 32) - 1
_BACK = (pow(0x94D049BB133111EB, -1, 2**64), pow(0xBF58476D1CE4E5B9, -1, 2**64))
#: Discounts where counts do not tell any.
DISCOUNTS = (0.5, 1.0, 1.5)


def unmix(x: np.ndarray) -> np.ndarray:
    """What ``hashing.mix`` made ``x`` of."""
    for bits, factor in ((31, _BACK[0]), (27, _BACK[1]), (30, 1)):
        whole, shift = x, bits
        while shift < 64:
            whole = x ^ (whole >> np.uint64(bits))
            shift += bits
        x = whole * np.uint64(factor)
    return x


def discounts(t: tuple[int, int, int, int]) -> tuple[float, float, float]:
    """What to take off counts of one, two, and three or more, given how many counts are 1 to 4;
    fixed ones where that gives none or one outside 0 to the count."""
    if min(t) > 0:
        y = t[0] / (t[0] + 2 * t[1])
        found = tuple(i + 1 - (i + 2) * y * t[i + 1] / t[i] for i in range(3))
        if all(0 <= d <= i + 1 for i, d in enumerate(found)):
            return found
    return DISCOUNTS


# Runs: sorted distinct numbers with counts, as bytes.


def _pack(numbers: np.ndarray) -> bytes:
    planes = np.ascontiguousarray(numbers).view(np.uint8).reshape(-1, 8).T
    return pa.Codec("zstd", compression_level=1).compress(planes.tobytes(), asbytes=True)


def _unpack(data: bytes, n: int) -> np.ndarray:
    planes = pa.Codec("zstd").decompress(data, n * 8, asbytes=True)
    return np.frombuffer(planes, np.uint8).reshape(8, n).T.copy().view(np.uint64).ravel()


def pack_run(keys: np.ndarray) -> bytes:
    return _pack(np.diff(keys, prepend=np.uint64(0)))


def unpack_run(data: bytes, n: int) -> np.ndarray:
    return np.cumsum(_unpack(data, n), dtype=np.uint64)


def merged(keys: np.ndarray, *counts: np.ndarray) -> tuple[np.ndarray, ...]:
    """The different keys in order, with the sums of their counts."""
    if not len(keys):
        return keys, *counts
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    starts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return keys[starts], *[np.add.reduceat(c[order], starts) for c in counts]


def shard_of(hashes: np.ndarray, bits: int) -> np.ndarray:
    return ((hashes >> np.uint64(63 - bits)) >> np.uint64(1)).astype(np.int64)


# Files of arrays in the shared folder.


def _save(folder: str, name: str, **columns: np.ndarray) -> None:
    """Written aside and then named, so that a task that is lost or runs twice does no harm."""
    store, root = fs.FileSystem.from_uri(folder)
    store.create_dir(root, recursive=True)
    aside = f"{root}/{name}.{uuid.uuid4().hex}"
    batch = pa.RecordBatch.from_arrays([pa.array(c) for c in columns.values()], list(columns))
    with store.open_output_stream(aside) as out, pa.ipc.new_file(out, batch.schema) as writer:
        writer.write_batch(batch)
    store.move(aside, f"{root}/{name}")


def _mapped(folder: str, name: str) -> dict[str, np.ndarray] | None:
    """The file's columns, mapped into memory; None if there is no such file. A file of a store
    that cannot be mapped is mapped from a copy that is gone when the process ends."""
    store, root = fs.FileSystem.from_uri(folder)
    path = f"{root}/{name}"
    if store.get_file_info(path).type == fs.FileType.NotFound:
        return None
    if isinstance(store, fs.LocalFileSystem):
        source = pa.memory_map(path)
    else:
        with tempfile.NamedTemporaryFile() as copy:
            with store.open_input_stream(path) as data:
                shutil.copyfileobj(data, copy)
            copy.flush()
            source = pa.memory_map(copy.name)
    batch = pa.ipc.open_file(source).get_batch(0)
    return {c: batch.column(c).to_numpy() for c in batch.schema.names}


# Tokens of texts.


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Some batches at a time, about ``GROUP_BYTES`` of them."""
    kept, size = [], 0
    for batch in batches:
        kept.append(batch)
        size += batch.nbytes
        if size >= GROUP_BYTES:
            yield pa.Table.from_batches(kept)
            kept, size = [], 0
    if kept:
        yield pa.Table.from_batches(kept)


class Block(NamedTuple):
    doc: np.ndarray  # place of the text
    token: np.ndarray  # hash
    first: np.ndarray  # whether a text begins here


def blocks(texts: list[str | None]) -> Iterator[Block]:
    """The tokens of the texts, in order, ``BLOCK`` or so at a time: words and an end each. A
    long text goes on in the next block."""

    def block(pieces: list[tuple[int, bool, np.ndarray]]) -> Block:
        sizes = np.array([len(p) for _, _, p in pieces])
        first = np.zeros(sizes.sum(), bool)
        first[(np.cumsum(sizes) - sizes)[[f for _, f, _ in pieces]]] = True
        docs = np.repeat(np.array([d for d, _, _ in pieces]), sizes)
        return Block(docs, np.concatenate([p for _, _, p in pieces]), first)

    kept, size = [], 0
    for doc, words in enumerate(word_hashes(texts, AS_WORDS)):
        tokens = np.append(words, END)
        for at in range(0, len(tokens), BLOCK):
            kept.append((doc, at == 0, tokens[at : at + BLOCK]))
            size += len(kept[-1][2])
            if size >= BLOCK:
                yield block(kept)
                kept, size = [], 0
    if kept:
        yield block(kept)


class Vocabulary(NamedTuple):
    """Where the words' arrays are. A word's number is its place in all of them."""

    folder: str
    bits: int
    sizes: tuple[int, ...]  # words per array

    @property
    def bases(self) -> np.ndarray:
        return np.concatenate([[0], np.cumsum(self.sizes)])


class Words:
    """The vocabulary's arrays, as a worker has them mapped."""

    def __init__(self, vocabulary: Vocabulary, statistics: bool = False):
        self.own, self.statistics = vocabulary, statistics
        self.bases = vocabulary.bases
        self.open: dict[int, dict[str, np.ndarray]] = {}

    def _array(self, shard: int) -> dict[str, np.ndarray]:
        if shard not in self.open:
            found = _mapped(self.own.folder, f"words-{shard}")
            if self.statistics:
                found |= _mapped(self.own.folder, f"after-{shard}")
            self.open[shard] = found
        return self.open[shard]

    def find(self, hashes: np.ndarray) -> tuple[np.ndarray, dict[str, np.ndarray]]:
        """The numbers of sorted hashes, -1 for unknown ones, and what is kept of each."""
        number = np.full(len(hashes), -1, np.int64)
        names = ["count", *(["before", "once", "twice", "more"] if self.statistics else [])]
        kept = {c: np.zeros(len(hashes), np.int64) for c in names}
        edges = np.searchsorted(shard_of(hashes, self.own.bits), np.arange(len(self.own.sizes) + 1))
        for shard in np.flatnonzero(np.diff(edges)).tolist():
            if not self.own.sizes[shard]:
                continue
            arrays, a, b = self._array(shard), edges[shard], edges[shard + 1]
            place = np.minimum(np.searchsorted(arrays["hash"], hashes[a:b]), self.own.sizes[shard] - 1)
            hit = np.flatnonzero(arrays["hash"][place] == hashes[a:b])
            number[a + hit] = place[hit] + self.bases[shard]
            for c in names:
                kept[c][a + hit] = arrays[c][place[hit]]
        return number, kept


def _numbered(block: Block, words: Words, before: int) -> tuple[np.ndarray, np.ndarray, tuple]:
    """The number of each token and of what stands before it (-1 unknown), and of the different
    tokens what is kept of them and where each token is among them."""
    different, inverse = np.unique(block.token, return_inverse=True)
    number, kept = words.find(different)
    token = number[inverse]
    last = np.concatenate([[before], token[:-1]])
    last[block.first] = BEGIN
    return token, last, (kept, inverse)


def _pairs(last: np.ndarray, token: np.ndarray) -> np.ndarray:
    return mix((last.astype(np.uint64) << np.uint64(32)) | token.astype(np.uint64))


# Counting.

_RUNS = "shard int, n long, keys binary, counts binary"


def _count(
    docs: DataFrame, bits: int, hashes: Callable[[], Callable[[Block], np.ndarray]]
) -> DataFrame:
    """Runs of what ``hashes()`` makes of blocks of tokens, each with how often it occurred,
    split by the first bits. A task sums up before it hands on."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = hashes()
        kept: list[tuple[np.ndarray, np.ndarray]] = []

        def runs() -> pa.RecordBatch:
            keys, counts = merged(*[np.concatenate(x) for x in zip(*kept, strict=True)])
            edges = np.searchsorted(shard_of(keys, bits), np.arange((1 << bits) + 1))
            full = np.flatnonzero(np.diff(edges))
            parts = [(keys[a:b], counts[a:b]) for a, b in zip(edges[full], edges[full + 1])]
            return pa.RecordBatch.from_arrays(
                [pa.array(full.astype(np.int32)), pa.array(np.diff(edges)[full]),
                 pa.array([pack_run(k) for k, _ in parts], pa.binary()),
                 pa.array([_pack(c) for _, c in parts], pa.binary())],
                names=["shard", "n", "keys", "counts"],
            )

        size = 0
        for group in _groups(batches):
            for block in blocks(group["text"].to_pylist()):
                keys, counts = np.unique(of(block), return_counts=True)
                kept.append((keys, counts.astype(np.int64)))
                size += len(keys)
                if size >= CHUNK:
                    yield runs()
                    kept, size = [], 0
        if kept:
            yield runs()

    return docs.select("text").mapInArrow(count, _RUNS)


def _joined(runs: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    n = runs["n"].to_pylist()
    keys = [unpack_run(k, m) for k, m in zip(runs["keys"].to_pylist(), n, strict=True)]
    counts = [_unpack(c, m) for c, m in zip(runs["counts"].to_pylist(), n, strict=True)]
    return merged(np.concatenate(keys), np.concatenate(counts).astype(np.int64))


def count_words(docs: DataFrame, folder: str, bits: int) -> tuple[Vocabulary, int]:
    """Writes the words' arrays, hashes in order and counts; gives also the number of tokens."""

    def build(runs: pa.Table) -> pa.Table:
        shard = runs["shard"][0].as_py()
        hashes, counts = _joined(runs)
        _save(folder, f"words-{shard}", hash=hashes, count=counts)
        return pa.table({"shard": [shard], "n": [len(hashes)], "tokens": [int(counts.sum())]})

    built = _count(docs, bits, lambda: lambda block: block.token)
    got = built.groupBy("shard").applyInArrow(build, "shard long, n long, tokens long").toArrow()
    sizes = np.zeros(1 << bits, np.int64)
    sizes[got["shard"].to_numpy()] = got["n"].to_numpy()
    if sizes.sum() >= BEGIN:
        raise ValueError("more than 2**32 - 2 different words")
    return Vocabulary(folder, bits, tuple(sizes.tolist())), int(sum(got["tokens"].to_pylist()))


#: Totals of a shard of pairs: how many occur 1, 2, 3, 4 times, how many there are, and how many
#: that begin a text occur once, twice, more often.
_TOTALS = 8


def _after(keys: np.ndarray, counts: np.ndarray) -> tuple[tuple[np.ndarray, ...], list[int]]:
    """What pairs tell about words: per word how many different ones stand before it, and how
    many after it once, twice, more often; and the totals."""
    last, token = keys >> np.uint64(32), keys & np.uint64(BEGIN)
    kind = np.minimum(counts, 3)
    begins = last == np.uint64(BEGIN)
    own = ~begins
    # Counts within an array are below 2**32, so two of them share a number until summed up.
    words = np.concatenate([token, last[own]])
    left = np.ones(len(words), np.int64)
    right = np.zeros(len(words), np.int64)
    left[len(token) :] = (kind[own] == 1).astype(np.int64) << 32
    right[len(token) :] = np.where(kind[own] == 2, 1, (kind[own] == 3).astype(np.int64) << 32)
    words, left, right = merged(words, left, right)
    low = (1 << 32) - 1
    per_word = words, left & low, left >> 32, right & low, right >> 32
    totals = [int((counts == k).sum()) for k in (1, 2, 3, 4)] + [len(keys)]
    return per_word, totals + [int((kind[begins] == k).sum()) for k in (1, 2, 3)]


def count_pairs(docs: DataFrame, vocabulary: Vocabulary, bits: int) -> tuple[list[int], DataFrame]:
    """Writes the pairs' arrays, hashes in order and counts (in a byte; larger ones apart). Gives
    their totals and, as runs split like the vocabulary, what they tell about words."""
    folder = vocabulary.folder

    def hashes() -> Callable[[Block], np.ndarray]:
        words, before = Words(vocabulary), [-1]

        def of(block: Block) -> np.ndarray:
            token, last, _ = _numbered(block, words, before[0])
            before[0] = int(token[-1])
            return _pairs(last, token)

        return of

    def build(runs: pa.Table) -> pa.Table:
        shard = runs["shard"][0].as_py()
        keys, counts = _joined(runs)
        _save(folder, f"pairs-{shard}", hash=keys, count=np.minimum(counts, 255).astype(np.uint8))
        large = np.flatnonzero(counts >= 255)
        _save(folder, f"large-{shard}", hash=keys[large], count=counts[large])
        (words, *about), totals = _after(unmix(keys), counts)
        bases = vocabulary.bases.astype(np.uint64)
        edges = np.searchsorted(words, bases)
        full = np.flatnonzero(np.diff(edges))
        packed = [
            (pack_run(words[a:b] - bases[s]), _pack(np.concatenate([c[a:b] for c in about])))
            for s, a, b in zip(full, edges[full], edges[full + 1], strict=True)
        ]
        return pa.table({
            "shard": pa.array([*full, -1], pa.int32()),
            "n": pa.array([*np.diff(edges)[full], 0], pa.int64()),
            "keys": pa.array([*[k for k, _ in packed], None], pa.binary()),
            "counts": pa.array([*[c for _, c in packed], None], pa.binary()),
            "totals": pa.array([*[None] * len(full), totals], pa.list_(pa.int64())),
        })

    counted = _count(docs, bits, hashes).groupBy("shard").applyInArrow(
        build, f"{_RUNS}, totals array<long>"
    )
    counted = written(counted, "lm-after")
    sums = counted.where("shard < 0").agg(
        *[F.sum(F.col("totals")[i]).alias(f"t{i}") for i in range(_TOTALS)]
    ).first()
    return [int(x or 0) for x in sums], counted


def _save_after(counted: DataFrame, vocabulary: Vocabulary) -> list[int]:
    """Writes, beside the words' arrays, how many different words stand before each and after
    it. Gives how many have 1, 2, 3, 4 before them, and how many have any."""

    def build(runs: pa.Table) -> pa.Table:
        shard = runs["shard"][0].as_py()
        sums = np.zeros((4, vocabulary.sizes[shard]), np.int64)
        for n, keys, counts in zip(*[runs[c].to_pylist() for c in ("n", "keys", "counts")],
                                   strict=True):
            sums[:, unpack_run(keys, n).astype(np.int64)] += _unpack(counts, 4 * n).astype(
                np.int64).reshape(4, n)
        names = ("before", "once", "twice", "more")
        _save(vocabulary.folder, f"after-{shard}",
              **{c: s.astype(np.uint32) for c, s in zip(names, sums, strict=True)})
        found = [int((sums[0] == k).sum()) for k in (1, 2, 3, 4)] + [int((sums[0] > 0).sum())]
        return pa.table({f"t{i}": [x] for i, x in enumerate(found)})

    built = counted.where("shard >= 0").groupBy("shard").applyInArrow(
        build, ", ".join(f"t{i} long" for i in range(5))
    )
    sums = built.agg(*[F.sum(f"t{i}") for i in range(5)]).first()
    return [int(x or 0) for x in sums]


class Model(NamedTuple):
    """Numbers of the model, and where its arrays are.

    With c the count of a pair, c(v) that of what stands first (texts, for the beginning of a
    text), a(w) the number of different tokens before w and A the number of different pairs:
    ``p(w | v) = max(c(v w) - D(c(v w)), 0) / c(v) + g(v) p(w)``, where g(v) is what was taken off
    the pairs that begin with v, over c(v); ``p(w) = max(a(w) - D'(a(w)), 0) / A + g' / (V + 1)``,
    where g' is what was taken off all a, over A, and V the number of different tokens. Where v
    was never seen first, ``p(w | v) = p(w)``; where there is nothing at all, it is 1.
    """

    vocabulary: Vocabulary
    bits: int  # of the pairs' arrays
    texts: int
    tokens: int
    pairs: int
    begins: tuple[int, int, int]
    pair_discounts: tuple[float, float, float]
    word_discounts: tuple[float, float, float]
    spread: float  # g'

    @property
    def words(self) -> int:
        return sum(self.vocabulary.sizes)


class _Pairs:
    def __init__(self, model: Model):
        self.folder, self.bits = model.vocabulary.folder, model.bits
        self.open: dict[int, tuple] = {}

    def counts(self, hashes: np.ndarray) -> np.ndarray:
        """How often each of sorted hashes was counted."""
        out = np.zeros(len(hashes), np.int64)
        edges = np.searchsorted(shard_of(hashes, self.bits), np.arange((1 << self.bits) + 1))
        for shard in np.flatnonzero(np.diff(edges)).tolist():
            if shard not in self.open:
                self.open[shard] = tuple(
                    _mapped(self.folder, f"{kind}-{shard}") for kind in ("pairs", "large")
                )
            own, large = self.open[shard]
            if own is None:
                continue
            a, b = edges[shard], edges[shard + 1]
            place = np.minimum(np.searchsorted(own["hash"], hashes[a:b]), len(own["hash"]) - 1)
            hit = np.flatnonzero(own["hash"][place] == hashes[a:b])
            found = own["count"][place[hit]].astype(np.int64)
            many = np.flatnonzero(found == 255)
            if len(many):
                found[many] = large["count"][
                    np.searchsorted(large["hash"], hashes[a:b][hit[many]])
                ]
            out[a + hit] = found
        return out


class Scorer:
    """A model as a worker has it mapped."""

    def __init__(self, model: Model):
        self.model, self.words, self.pairs = model, Words(model.vocabulary, True), _Pairs(model)

    def _taken(self, counts: np.ndarray, by: tuple[float, float, float]) -> np.ndarray:
        return np.array([0.0, *by])[np.minimum(counts, 3)]

    def logs(self, block: Block, before: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
        """Per token the logarithms by the model and by plain counts, whether it is known, and
        the number of the last one, for the block after this."""
        m = self.model
        token, last, (kept, inverse) = _numbered(block, self.words, before)
        a = kept["before"]
        alone = np.maximum(a - self._taken(a, m.word_discounts), 0.0) / max(m.pairs, 1)
        alone = alone + m.spread / (m.words + 1)
        plain = np.log10((kept["count"] + 1.0) / (m.tokens + m.words + 1.0))
        d1, d2, d3 = m.pair_discounts
        off = d1 * kept["once"] + d2 * kept["twice"] + d3 * kept["more"]

        # What stands before a token is the token before it, the beginning, or that of a block.
        seen = np.concatenate([[0], kept["count"][inverse[:-1]]]).astype(np.float64)
        taken = np.concatenate([[0.0], off[inverse[:-1]]])
        if not block.first[0]:
            number, about = np.array([before]), self._about(before)
            seen[0], taken[0] = about if number[0] >= 0 else (0, 0.0)
        begin_off = d1 * m.begins[0] + d2 * m.begins[1] + d3 * m.begins[2]
        seen[block.first], taken[block.first] = m.texts, begin_off

        p = alone[inverse]
        both = np.flatnonzero((token >= 0) & (last >= 0))
        counts = np.zeros(len(token), np.int64)
        different, where = np.unique(_pairs(last[both], token[both]), return_inverse=True)
        counts[both] = self.pairs.counts(different)[where]
        known = seen > 0
        c = counts[known]
        p[known] = (
            np.maximum(c - self._taken(c, m.pair_discounts), 0.0) / seen[known]
            + taken[known] / seen[known] * p[known]
        )
        return np.log10(p), plain[inverse], token >= 0, int(token[-1])

    def _about(self, number: int) -> tuple[int, float]:
        """How often a word stands first, and what is taken off the pairs it begins."""
        if number < 0:
            return 0, 0.0
        shard = int(np.searchsorted(self.words.bases, number, "right")) - 1
        arrays, at = self.words._array(shard), number - self.words.bases[shard]
        d1, d2, d3 = self.model.pair_discounts
        off = d1 * int(arrays["once"][at]) + d2 * int(arrays["twice"][at])
        return int(arrays["count"][at]), off + d3 * int(arrays["more"][at])

    def score(self, texts: list[str | None]) -> dict[str, np.ndarray]:
        """Per text: tokens, known ones, and the two sums of logarithms in parts of ``UNIT``."""
        out = {k: np.zeros(len(texts), np.int64) for k in ("tokens", "known", "base", "score")}
        before = -1
        for block in blocks(texts):
            model, plain, known, before = self.logs(block, before)
            starts = np.flatnonzero(np.concatenate([[True], np.diff(block.doc) > 0]))
            docs = block.doc[starts]
            sizes = np.diff(np.append(starts, len(block.doc)))
            out["tokens"][docs] += sizes
            for name, x in (("known", known), ("base", np.rint(plain * UNIT)),
                            ("score", np.rint(model * UNIT))):
                out[name][docs] += np.add.reduceat(x.astype(np.int64), starts)
        return out


def train(docs: DataFrame, text_col: str, shard_tokens: int = SHARD_TOKENS) -> Model:
    """Counts the words and pairs of all ``docs`` and writes them as sorted arrays to the shared
    folder. A null text is the empty text, which has an end and no words; repeated rows count as
    often as they occur; an empty table gives a model by which every text has probability 1.
    ``forget`` removes the arrays.

    Tasks count what they read, hand on sorted runs split by the first bits of hashes, and merge
    those; no task meets more than about ``shard_tokens`` tokens' worth of them. Words are told
    apart by 64-bit hashes, pairs by the numbers of their words, from which a hash follows that
    leads back to them.
    """
    spark = docs.sparkSession
    in_small_batches(spark)
    rows = docs.select(F.col(f"`{text_col}`").cast("string").alias("text"))
    size = rows.agg(F.count(F.lit(1)).alias("texts"), F.sum(F.octet_length("text")).alias("bytes"))
    texts, length = size.first()
    about = texts + (length or 0) // TOKEN_BYTES
    bits = max(0, (max(1, about // shard_tokens) - 1).bit_length())
    folder = fresh_path(spark, "lm")
    vocabulary, tokens = count_words(rows, folder, bits)
    totals, counted = count_pairs(rows, vocabulary, bits)
    before = _save_after(counted, vocabulary)
    release(counted)
    by = discounts(tuple(before[:4]))
    off = by[0] * before[0] + by[1] * before[1] + by[2] * (before[4] - before[0] - before[1])
    return Model(
        vocabulary, bits, texts, tokens, totals[4], tuple(totals[5:]),
        discounts(tuple(totals[:4])), by, off / totals[4] if totals[4] else 1.0,
    )


def forget(spark: SparkSession, model: Model) -> None:
    """Removes the model's arrays."""
    remove(spark, [model.vocabulary.folder])


def score(docs: DataFrame, text_col: str, model: Model) -> DataFrame:
    """The rows with ``n_tokens``, ``n_known`` (tokens that the model has seen), ``base_score`` and
    ``score``, the texts' log10 probabilities by counts plus one and by the model, in place of
    columns of those names. Every whole text is read; a null one is the empty one. Scores are
    sums of logarithms rounded to ``1 / UNIT`` each, so they do not depend on their order."""
    names = ["n_tokens", "n_known", "base_score", "score"]
    kept = [c for c in docs.columns if c not in names]
    own = free_name(docs, "text_to_score")
    rows = docs.select(
        *[F.col(f"`{c}`") for c in kept], F.col(f"`{text_col}`").cast("string").alias(own)
    )
    schema = rows.drop(own).schema
    for name, kind in zip(names, ("long", "long", "double", "double"), strict=True):
        schema = schema.add(name, kind)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(model)
        for group in _groups(batches):
            found = scorer.score(group[own].to_pylist())
            columns = [group[c] for c in kept] + [
                pa.chunked_array([x]) for x in (
                    found["tokens"], found["known"], found["base"] / UNIT, found["score"] / UNIT)
            ]
            yield from pa.table(columns, names=[*kept, *names]).combine_chunks().to_batches()

    return rows.mapInArrow(work, schema)


def perplexity(total: Column, tokens: Column) -> Column:
    return F.pow(F.lit(10.0), -total / tokens)


def op12_ngram_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    remainder = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7
    model = train(docs.where(remainder != 2), "text")
    scored = written(score(docs, "text", model).drop("text"), "lm-scores")
    forget(spark, model)
    return scored.select(
        "doc_id", F.coalesce(remainder == 2, F.lit(False)).alias("held_out"), "n_tokens",
        "n_known", F.lit(model.tokens).cast("long").alias("train_tokens"), "base_score",
        F.round("score", 6).alias("score"),
    )


QUERIES = {"op12_ngram_model": op12_ngram_model}

_CRC = (
    "xor(list_reduce(list_transform(range(length(CAST(doc_id AS VARCHAR))), "
    "lambda i: CAST(ord(substring(CAST(doc_id AS VARCHAR), i + 1, 1)) AS BIGINT)), "
    "lambda crc, byte: list_reduce(range(8), lambda c, i: CASE WHEN c % 2 = 1 "
    "THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, xor(crc, byte)), 4294967295), 4294967295)"
)


def _discounted(count: str, d: str) -> str:
    return (f"greatest({count} - CASE WHEN {count} = 0 THEN 0 WHEN {count} = 1 THEN {d}.d1 "
            f"WHEN {count} = 2 THEN {d}.d2 ELSE {d}.d3 END, 0)")


def _discounts(counts: str, column: str) -> str:
    return f"""(
    SELECT CASE WHEN fine THEN d1 ELSE 0.5 END AS d1, CASE WHEN fine THEN d2 ELSE 1.0 END AS d2,
        CASE WHEN fine THEN d3 ELSE 1.5 END AS d3
    FROM (SELECT *, least(t1, t2, t3, t4) > 0 AND coalesce(least(d1, d2, d3) >= 0
            AND d1 <= 1 AND d2 <= 2 AND d3 <= 3, false) AS fine
        FROM (SELECT *, 1 - 2 * y * t2 / t1 AS d1, 2 - 3 * y * t3 / t2 AS d2,
                3 - 4 * y * t4 / t3 AS d3
            FROM (SELECT *, CAST(t1 AS DOUBLE) / (t1 + 2 * t2) AS y FROM (
                SELECT count(*) FILTER ({column} = 1) AS t1, count(*) FILTER ({column} = 2) AS t2,
                    count(*) FILTER ({column} = 3) AS t3, count(*) FILTER ({column} = 4) AS t4
                FROM {counts}))))
)"""


SQL = {
    "op12_ngram_model": f"""
WITH split AS (
    SELECT row_number() OVER () AS k, doc_id, coalesce({_CRC} % 7 = 2, false) AS held_out,
        coalesce({_CRC} % 7 <> 2, false) AS learnt, list_append(regexp_extract_all(translate(
            coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[^\\x20\\x09-\\x0D]+'), ' end') AS tokens
    FROM documents
), pairs AS MATERIALIZED (
    SELECT k, learnt, tokens[i] AS w, CASE WHEN i = 1 THEN ' begin' ELSE tokens[i - 1] END AS v
    FROM split, unnest(range(1, len(tokens) + 1)) AS places(i)
), word AS MATERIALIZED (
    SELECT w, count(*) AS c FROM pairs WHERE learnt GROUP BY w
), pair AS MATERIALIZED (
    SELECT v, w, count(*) AS c FROM pairs WHERE learnt GROUP BY v, w
), before AS (SELECT w, count(*) AS a FROM pair GROUP BY w
), d2 AS {_discounts('pair', 'c')}, d1 AS {_discounts('before', 'a')}, total AS (
    SELECT (SELECT count(*) FROM pair) AS pairs, (SELECT count(*) FROM word) AS words,
        (SELECT CAST(coalesce(sum(c), 0) AS BIGINT) FROM word) AS tokens,
        (SELECT count(*) FILTER (a = 1) * any_value(d1.d1) + count(*) FILTER (a = 2) *
            any_value(d1.d2) + count(*) FILTER (a > 2) * any_value(d1.d3)
         FROM before CROSS JOIN d1) / CAST((SELECT count(*) FROM pair) AS DOUBLE) AS spread
), alone AS (
    SELECT w, {_discounted('a', 'd1')} / CAST(total.pairs AS DOUBLE) AS p FROM before, d1, total
), first AS (
    SELECT v, CAST(sum(c) AS DOUBLE) AS seen, count(*) FILTER (c = 1) * any_value(d2.d1)
        + count(*) FILTER (c = 2) * any_value(d2.d2) + count(*) FILTER (c > 2)
        * any_value(d2.d3) AS off
    FROM pair CROSS JOIN d2 GROUP BY v
), weighed AS (
    SELECT k, word.c IS NOT NULL AS known,
        log10((coalesce(word.c, 0) + 1.0::DOUBLE) / (total.tokens + total.words + 1.0::DOUBLE)) AS base,
        coalesce(alone.p, 0) + coalesce(total.spread, 1) / (total.words + 1) AS p1,
        CASE WHEN first.seen IS NULL THEN NULL
            ELSE {_discounted('coalesce(pair.c, 0)', 'd2')} / first.seen END AS p2,
        first.off / first.seen AS g
    FROM pairs CROSS JOIN total CROSS JOIN d2 LEFT JOIN word ON word.w = pairs.w
        LEFT JOIN alone ON alone.w = pairs.w LEFT JOIN first ON first.v = pairs.v
        LEFT JOIN pair ON pair.v = pairs.v AND pair.w = pairs.w
), summed AS (
    SELECT k, count(*) AS n_tokens, count(*) FILTER (known) AS n_known,
        sum(CAST(round_even(base * {UNIT}, 0) AS BIGINT)) AS base,
        sum(CAST(round_even(log10(coalesce(p2 + g * p1, p1)) * {UNIT}, 0) AS BIGINT)) AS score
    FROM weighed GROUP BY k
)
SELECT doc_id, held_out, n_tokens, n_known, total.tokens AS train_tokens,
    CAST(base AS DOUBLE) / {UNIT} AS base_score, round(CAST(score AS DOUBLE) / {UNIT}, 6) AS score
FROM split JOIN summed USING (k) CROSS JOIN total
""",
}
