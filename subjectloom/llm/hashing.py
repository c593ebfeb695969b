"""Hashes of words, in numpy over many texts at once."""

from __future__ import annotations

import functools
from collections.abc import Iterable, Iterator

import numpy as np

#: Texts are worked on together up to so many bytes; longer texts in segments of that size.
PACK_BYTES = 1 << 18

# Odd 64-bit multipliers without structure.
_BASE = 0x9E3779B97F4A7C15
_STEPS = (0xD6E8FEB86659FD93, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xA0761D6478BD642F,
          0xE7037ED1A0B428DB)

_UPPER = bytes(range(65, 91))
_LOWER = bytes(range(97, 123))
#: A-Z lower-cased, the six blanks all as a space.
AS_WORDS = bytes.maketrans(_UPPER + b"\t\n\x0b\x0c\r", _LOWER + b" " * 5)
_OTHER = bytes(b for b in range(128) if not chr(b).isalnum())
#: A-Z lower-cased, all of ASCII but letters and digits as a space.
AS_TERMS = bytes.maketrans(_UPPER + _OTHER, _LOWER + b" " * len(_OTHER))


@functools.lru_cache(maxsize=2)
def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    """The base's powers and their inverses modulo 2**64."""
    up, down = np.empty(size, np.uint64), np.empty(size, np.uint64)
    for out, base in ((up, _BASE), (down, pow(_BASE, -1, 2**64))):
        out[0] = 1
        done = 1
        while done < size:
            more = min(done, size - done)
            out[done : done + more] = out[:more] * np.uint64(pow(base, done, 2**64))
            done += more
    return up, down


def mix(x: np.ndarray) -> np.ndarray:
    """Spreads every bit over the whole word."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _spans(data: bytes, prefixes: tuple[int, ...] = ()) -> tuple[np.ndarray, np.ndarray]:
    """Starts and hashes of the words of ``data``, which only has spaces between them; with
    prefixes a column for the words and one for their first so many bytes each."""
    buf = np.frombuffer(data, np.uint8)
    edges = np.flatnonzero(np.diff(buf != 32, prepend=False, append=False))
    starts, ends = edges[0::2], edges[1::2]
    up, down = _powers(1 << max(PACK_BYTES + 1, len(buf) + 1).bit_length())
    sums = np.zeros(len(buf) + 1, np.uint64)
    np.cumsum((buf.astype(np.uint64) + np.uint64(1)) * up[: len(buf)], out=sums[1:])
    if not prefixes:
        return starts, mix((sums[ends] - sums[starts]) * down[starts])
    upto = np.stack([ends, *[np.minimum(ends, starts + k) for k in prefixes]], axis=1)
    return starts, mix((sums[upto] - sums[starts][:, None]) * down[starts][:, None])


def _segments(data: bytes) -> Iterator[bytes]:
    """Cut at spaces, about ``PACK_BYTES`` each; a longer word stays whole."""
    at = 0
    while len(data) - at > PACK_BYTES:
        to = data.find(b" ", at + PACK_BYTES)
        if to < 0:
            break
        yield data[at:to]
        at = to
    yield data[at:]


def word_hashes(
    texts: Iterable[str | None], table: bytes, prefixes: tuple[int, ...] = ()
) -> Iterator[np.ndarray]:
    """For each text the hashes of its words in order. ``table`` says which bytes are blanks."""

    def packed(pack: list[bytes]) -> Iterator[np.ndarray]:
        offsets = np.cumsum([0] + [len(p) + 1 for p in pack])
        starts, hashes = _spans(b" ".join(pack), prefixes)
        cuts = np.searchsorted(starts, offsets)
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            yield hashes[a:b]

    pack: list[bytes] = []
    size = 0
    for text in texts:
        data = (text or "").encode("utf-8", "surrogatepass").translate(table)
        if len(data) > PACK_BYTES:
            if pack:
                yield from packed(pack)
            pack, size = [], 0
            yield np.concatenate([_spans(s, prefixes)[1] for s in _segments(data)])
            continue
        pack.append(data)
        size += len(data) + 1
        if size > PACK_BYTES:
            yield from packed(pack)
            pack, size = [], 0
    if pack:
        yield from packed(pack)


def shingles(words: np.ndarray, width: int) -> np.ndarray:
    """The distinct hashes, in order, of runs of ``width`` words (at most five); of fewer words
    the whole sequence is one run."""
    if not len(words):
        return words
    short = len(words) < width
    n = len(words) if short else width
    total = np.full(len(words) - n + 1, np.uint64(n if short else 0))
    for i in range(n):
        total = mix(total + words[i : len(words) - n + 1 + i]) * np.uint64(_STEPS[i])
    return np.unique(mix(total))
