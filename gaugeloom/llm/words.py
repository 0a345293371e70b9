"""Words of whole batches of texts as NumPy arrays.

A word is a run of bytes other than space and the control characters 9 to 13.
All functions work on the UTF-8 bytes of many texts at once; no Python object
is made for a word.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np

BASE = np.uint64(0x9E3779B97F4A7C15)
PIECE_BYTES = 2_000_000

SPACE = np.zeros(256, dtype=bool)
SPACE[[32, 9, 10, 11, 12, 13]] = True


class Words(NamedTuple):
    """Word i is ``data[start[i]:stop[i]]``; text t holds words ``first[t]`` up to ``first[t + 1]``."""

    data: np.ndarray
    start: np.ndarray
    stop: np.ndarray
    first: np.ndarray

    def text_of(self) -> np.ndarray:
        """For every word the number of its text."""
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))

    def place(self) -> np.ndarray:
        """For every word its position in its text."""
        return np.arange(len(self.start)) - np.repeat(self.first[:-1], np.diff(self.first))


def pieces(texts: list[bytes], limit: int = PIECE_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about ``limit`` bytes; a longer text is a range of its own."""
    begin = size = 0
    for i, text in enumerate(texts):
        if size and size + len(text) > limit:
            yield begin, i
            begin, size = i, 0
        size += len(text)
    if begin < len(texts):
        yield begin, len(texts)


def find_words(texts: list[bytes], space: np.ndarray = SPACE) -> Words:
    """``space`` tells for each byte whether it parts words."""
    data = np.frombuffer(b"".join(texts), dtype=np.uint8)
    ends = np.cumsum([len(t) for t in texts], dtype=np.int64)
    solid = ~space[data]
    edge = np.zeros(len(data) + 1, dtype=bool)
    edge[0] = True
    edge[ends] = True
    opens = solid.copy()
    opens[1:] &= ~solid[:-1] | edge[1:-1]
    closes = solid
    closes[:-1] &= ~solid[1:] | edge[1:-1]
    start = np.flatnonzero(opens)
    stop = np.flatnonzero(closes) + 1
    first = np.concatenate([[0], np.searchsorted(start, ends)])
    return Words(data, start, stop, first)


def letters_apart(words: Words, tail: bytes) -> Words:
    """Words of ASCII letters in lower case, each run of ``tail`` bytes behind one as a word of its own; others as they are."""
    data, start, stop, first = words
    low, high = (data >= 97) & (data <= 122), (data >= 65) & (data <= 90)
    behind = np.zeros(256, dtype=bool)
    behind[list(tail)] = True
    solid = np.where(behind[data], -1, np.arange(len(data)))
    body = np.maximum(np.maximum.accumulate(solid)[stop - 1] + 1, start)
    odd = np.concatenate([[0], np.cumsum(~(low | high))])
    plain = (body > start) & (odd[body] == odd[start])
    lower = np.where(high, data | np.uint8(32), data)
    raw = np.flatnonzero(~plain)
    size = (stop - start)[raw]
    at = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size) + np.repeat(start[raw], size)
    lower[at] = data[at]
    cut = plain & (body < stop)
    count = 1 + cut
    place = np.cumsum(count) - count
    begins, ends = np.empty((2, int(count.sum())), dtype=np.int64)
    begins[place], ends[place] = start, np.where(cut, body, stop)
    begins[place[cut] + 1], ends[place[cut] + 1] = body[cut], stop[cut]
    return Words(lower, begins, ends, np.concatenate([[0], np.cumsum(count)])[first])


def mix(h: np.ndarray) -> np.ndarray:
    """Spread a 64-bit number over all its bits (the finaliser of MurmurHash3)."""
    h = h ^ (h >> np.uint64(33))
    h *= np.uint64(0xFF51AFD7ED558CCD)
    h ^= h >> np.uint64(33)
    h *= np.uint64(0xC4CEB9FE1A85EC53)
    h ^= h >> np.uint64(33)
    return h


class Blocks(NamedTuple):
    """The bytes of spans as numbers of eight bytes; those of span i begin at ``begin[i]``.

    The last block of a span of eight bytes or more ends with the span, so it may
    overlap the one before; a shorter span is one block filled up with zeros. Two
    spans are equal exactly if their sizes and blocks are.
    """

    value: np.ndarray
    begin: np.ndarray
    count: np.ndarray
    size: np.ndarray


def blocks(data: np.ndarray, start: np.ndarray, stop: np.ndarray) -> Blocks:
    size = stop - start
    count = np.maximum(1, (size + 7) >> 3)
    begin = np.cumsum(count) - count
    padded = np.concatenate([data, np.zeros(8, dtype=np.uint8)])
    loads = np.ndarray(len(data) + 1, dtype="<u8", buffer=padded, strides=(1,))
    if len(count) and int(count.max()) > 1:
        place = np.arange(int(begin[-1] + count[-1])) - np.repeat(begin, count)
        at = np.minimum(np.repeat(start, count) + 8 * place, np.repeat(np.maximum(start, stop - 8), count))
    else:
        at = start
    value = loads[at]
    short = np.flatnonzero(size < 8)
    value[begin[short]] &= (np.uint64(1) << (size[short].astype(np.uint64) << np.uint64(3))) - np.uint64(1)
    return Blocks(value, begin, count, size)


def block_hashes(found: Blocks, seed: int = 0) -> np.ndarray:
    """A 64-bit hash of each span: the sum of its blocks, each spread by its own place before it is added.

    No block acts on the sum in a way that another one could undo, other than by chance.
    """
    if not len(found.begin):
        return np.zeros(0, dtype=np.uint64)
    key = mix(np.array([2 * seed + 1], dtype=np.uint64))
    if len(found.value) == len(found.begin):
        total = mix(found.value + mix(key))
    else:
        place = np.arange(len(found.value), dtype=np.uint64) - np.repeat(found.begin, found.count).astype(np.uint64)
        total = np.add.reduceat(mix(found.value + mix(place + key)), found.begin)
    return mix(total + BASE * found.size.astype(np.uint64))


def same(found: Blocks, one: np.ndarray, other: np.ndarray) -> np.ndarray:
    """Whether the spans numbered ``one`` and ``other`` hold the same bytes."""
    good = found.size[one] == found.size[other]
    near = np.flatnonzero(good)
    count = found.count[one[near]]
    first = np.cumsum(count) - count
    step = np.arange(int(count.sum())) - np.repeat(first, count)
    differs = found.value[np.repeat(found.begin[one[near]], count) + step] != found.value[np.repeat(found.begin[other[near]], count) + step]
    if len(near):
        good[near] = ~np.logical_or.reduceat(differs, first)
    return good


def hashes(words: Words, seed: int = 0) -> np.ndarray:
    return block_hashes(blocks(words.data, words.start, words.stop), seed)


def windows(word_hash: np.ndarray, length: int, seed: int = 0) -> np.ndarray:
    """Hash of ``length`` consecutive words from every position on; positions near the end see fewer."""
    n = len(word_hash)
    out = np.zeros(n, dtype=np.uint64)
    weights = mix(np.arange(1, length + 1, dtype=np.uint64) + BASE * np.uint64(seed + 1)) | np.uint64(1)
    for k in range(min(length, n)):
        out[: n - k] += word_hash[k:] * weights[k]
    return mix(out)


def whole(words: Words, length: int) -> np.ndarray:
    """Whether ``length`` words of the same text begin at a position."""
    last = np.repeat(words.first[1:], np.diff(words.first))
    return np.arange(len(words.start)) + length <= last
