"""Phrase collocations by sampling with a negative border (Toivonen).

A sample proposes words and pairs of words that may be frequent. The full pass
counts over all texts every phrase that is proposed and the
negative border: every phrase that is not proposed though all its parts are. (All
words belong to one or the other, then all pairs of proposed words, then all
triples of proposed pairs.) If a phrase of the border turns out frequent, longer
phrases that hold it have been left out: it is added to the proposal, and another
full pass counts what this lets in, and nothing that was counted before. Phrases
have three words at most, so the border is closed after three passes or fewer.

These passes count by a 64-bit hash of language and words. Tasks send sorted hashes with
their counts, many in a row, and each range of hashes is added up on its own; two phrases
that share a hash can only be counted too high. When the border is closed, a last pass
counts the phrases that may be frequent by their words, so every count is exact.

Proposals travel as bitmaps of hashes whose size is fixed, whatever the sample
and the corpus hold. A phrase that is taken for proposed because of a shared bit is
counted as well; whether a phrase is counted in a pass depends on the phrase
alone, so a count is whole or absent.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from gaugeloom.llm import words as wd
from gaugeloom.llm.common import partitions, stored, text_or_empty

LEAST = 10
SHARE = 50
TOP = 2000
#: Bytes of text in the sample, about. Any sample gives the same result.
SAMPLE_BYTES = 32_000_000
SEED = 12
#: Share of the expected count from which on the sample proposes a phrase, and the least count.
LOWERED, LEAST_SEEN = 0.5, 2
#: Bits of a bitmap as a power of two; 2**25 bits are 4 MB.
BITS = 25
#: Text counted at once, and text whose hashes are added up at once.
PIECE_BYTES = 4_000_000
RANGE_BYTES = 16_000_000
#: Parts the rows of one very common word are dealt into where phrases meet the counts of their words.
SALT = 16
#: Language of a text without one.
UNKNOWN = "und"

#: Bytes that end a piece, and those that part words within one (all others stand for themselves).
_ENDS = b".,;:!?\n\x0b\x0c\r"
_PARTS = np.zeros(256, dtype=bool)
_PARTS[list(_ENDS + b" \t")] = True
_CUTS = np.zeros(256, dtype=bool)
_CUTS[list(_ENDS)] = True
_FOLD = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
_SECOND = np.uint64(0x9FB21C651E98DF25)


class Proposal(NamedTuple):
    """Bitmaps of words, pairs and triples, by the high bits of their hashes."""

    words: bytes
    pairs: bytes
    triples: bytes

    def joined(self, other: Proposal) -> Proposal:
        return Proposal(*[(np.frombuffer(a, np.uint8) | np.frombuffer(b, np.uint8)).tobytes() for a, b in zip(self, other, strict=True)])


def _set(bitmap: bytes, h: np.ndarray) -> np.ndarray:
    """Whether the bit of each hash is set."""
    bits = (len(bitmap) * 8).bit_length() - 1
    at = (h >> np.uint64(64 - bits)).astype(np.int64)
    return (np.frombuffer(bitmap, dtype=np.uint8)[at >> 3] >> (at & 7).astype(np.uint8) & 1).astype(bool)


def _next_hash(one: np.ndarray, two: np.ndarray) -> np.ndarray:
    """Hash of a phrase from that of all words but the last and that of the last."""
    return wd.mix(one * _SECOND + wd.mix(two))


def _language_key(lang: str) -> np.uint64:
    return wd.hashes(wd.find_words([lang.encode()], np.zeros(256, dtype=bool)), 3)[0] if lang else np.uint64(0)


def _slices(text: bytes, size: int) -> Iterator[tuple[bytes, int]]:
    """A long text in parts, and how many words at the beginning of a part only lead into it.

    A part ends behind a piece. Where none ends for long, it ends between two
    words, and the next part repeats the two words before.
    """
    at = done = lead = 0
    while len(text) - done > size:
        end = max(text.rfind(bytes([e]), done, done + size) for e in _ENDS) + 1
        whole = bool(end)
        if not whole:
            end = done + size
            while end < len(text) and not _PARTS[text[end]]:
                end += 1
        yield text[at:end], lead
        at, done, lead = end, end, 0
        while not whole and lead < 2:
            while at and text[at - 1] in b" \t":
                at -= 1
            if not at or _CUTS[text[at - 1]]:
                break
            while at and not _PARTS[text[at - 1]]:
                at -= 1
            lead += 1
    yield text[at:], lead


class _Words:
    """The words of one buffer of text, all of one language: hashes of the distinct ones, and their order."""

    def __init__(self, text: bytes, lead: int, lang: str, exact: bool = False):
        self.found = found = wd.find_words([text.translate(_FOLD)], _PARTS)
        self.lead, self.n = lead, len(found.start)
        spelled = wd.blocks(found.data, found.start, found.stop)
        hashed = wd.block_hashes(spelled)
        h, where, which = np.unique(hashed, return_index=True, return_inverse=True)
        if exact:
            odd = np.flatnonzero(~wd.same(spelled, np.arange(self.n), where[which]))
            if len(odd):  # words that share a hash are told apart by their bytes
                spell = [bytes(found.data[found.start[o] : found.stop[o]]) for o in odd.tolist()]
                first = {word: o for word, o in zip(reversed(spell), reversed(odd.tolist()), strict=True)}
                number = {word: len(where) + i for i, word in enumerate(first)}
                which[odd] = [number[word] for word in spell]
                extra = np.array(list(first.values()))
                where, h = np.concatenate([where, extra]), np.concatenate([h, hashed[extra]])
        self.where, self.which, self.h = where, which, wd.mix(h ^ _language_key(lang))
        ends = np.concatenate([[0], np.cumsum(_CUTS[found.data], dtype=np.int32)])
        self.joined = ends[found.stop[:-1]] == ends[found.start[1:]]  # words i and i + 1 lie in one piece

    def phrases(self, now: Proposal | None, before: Proposal | None) -> Iterator[tuple[int, tuple[np.ndarray, ...], np.ndarray, np.ndarray]]:
        """(words in a phrase, numbers of its words, hashes, counts) of what ``now`` lets in and ``before`` did not.

        All words, pairs of words in ``now``, triples of pairs in ``now``; without it all words and pairs.
        """
        h, lead = self.h, self.lead
        if before is None:
            count = np.bincount(self.which[lead:], minlength=len(h))
            some = np.flatnonzero(count)
            yield 1, (some,), h[some], count[some]

        whole = np.flatnonzero(self.joined)
        one, two = self.which[whole], self.which[whole + 1]
        if now:
            good = _set(now.words, h)
            keep = good[one] & good[two]
            whole, one, two = whole[keep], one[keep], two[keep]
        _, first, pair = np.unique(one.astype(np.uint64) << np.uint64(32) | two.astype(np.uint64), return_index=True, return_inverse=True)
        one, two = one[first], two[first]
        pair_h = _next_hash(h[one], h[two])
        count = np.bincount(pair[whole + 1 >= lead], minlength=len(one))
        new = count > 0
        if before:
            old = _set(before.words, h)
            old = old[one] & old[two]
            new &= ~old
        some = np.flatnonzero(new)
        yield 2, (one[some], two[some]), pair_h[some], count[some]

        if now is None:
            return
        near = np.flatnonzero(np.diff(whole) == 1)
        near = near[whole[near] + 2 >= lead]
        left, right = pair[near], pair[near + 1]
        good = _set(now.pairs, pair_h)
        keep = good[left] & good[right]
        if before:
            old &= _set(before.pairs, pair_h)
            keep &= ~(old[left] & old[right])
        key, count = np.unique(left[keep].astype(np.uint64) << np.uint64(32) | right[keep].astype(np.uint64), return_counts=True)
        left, right = (key >> np.uint64(32)).astype(np.int64), (key & np.uint64(0xFFFFFFFF)).astype(np.int64)
        yield 3, (one[left], two[left], two[right]), _next_hash(pair_h[left], h[two[right]]), count

    def spelled(self, numbers: tuple[np.ndarray, ...]) -> list[bytes]:
        data, start, stop = self.found.data.tobytes(), self.found.start[self.where], self.found.stop[self.where]
        parts = [[data[a:b] for a, b in zip(start[k].tolist(), stop[k].tolist(), strict=True)] for k in numbers]
        return parts[0] if len(parts) == 1 else list(map(b" ".join, zip(*parts, strict=True)))


def _buffers(batches: Iterator[pa.RecordBatch], piece_bytes: int) -> Iterator[tuple[str, bytes, int]]:
    """(language, text, words that only lead into it): texts of a language together, long ones in parts."""
    held: dict[str, list[bytes]] = {}
    size: dict[str, int] = {}
    for batch in batches:
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()).to_pylist(), strict=True):
            for part, lead in _slices(text, piece_bytes) if len(text) > piece_bytes else [(text, 0)]:
                if lead:
                    yield lang, part, lead
                    continue
                held.setdefault(lang, []).append(part)
                size[lang] = size.get(lang, 0) + len(part) + 1
                if sum(size.values()) > piece_bytes:
                    largest = max(size, key=size.__getitem__)
                    size.pop(largest)
                    yield largest, b"\n".join(held.pop(largest)), 0
    for lang, texts in held.items():
        yield lang, b"\n".join(texts), 0


PACKED = "size int, range long, hashes binary, counts binary"


def _send(now: Proposal | None, before: Proposal | None, ranges: int, least: int, piece_bytes: int):
    """Hashes with their counts, in rows by range; a count beyond ``least`` says no more than ``least`` does."""
    shift = np.uint64(64 - (ranges.bit_length() - 1)) if ranges > 1 else None
    kind = np.dtype(np.uint8 if least < 256 else np.uint32)

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lang, text, lead in _buffers(batches, piece_bytes):
            rows = []
            for size, _, h, count in _Words(text, lead, lang).phrases(now, before):
                order = np.argsort(h)
                h, count = h[order], np.minimum(count[order], least).astype(kind)
                edges = [0, len(h)]
                own = np.zeros(1, dtype=np.int64)
                if shift is not None and len(h):
                    at = (h >> shift).astype(np.int64)
                    edges = np.r_[0, np.flatnonzero(np.diff(at)) + 1, len(h)].tolist()
                    own = at[edges[:-1]]
                rows += [(size, int(k), h[a:b].tobytes(), count[a:b].tobytes()) for k, a, b in zip(own.tolist(), edges[:-1], edges[1:], strict=True) if b > a]
            if rows:
                kinds = [pa.int32(), pa.int64(), pa.binary(), pa.binary()]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], ["size", "range", "hashes", "counts"])

    return each


def _add_up(now: Proposal | None, ranges: int, bits: int, least: int):
    """The bits of a range's hashes that may belong to a frequent phrase, and how many of them ``now`` lacks."""
    kind = np.dtype(np.uint8 if least < 256 else np.uint32)

    def each(key: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
        size, number = key[0].as_py(), key[1].as_py()
        h = np.concatenate([np.frombuffer(r, np.uint64) for r in rows.column("hashes").to_pylist()])
        count = np.concatenate([np.frombuffer(r, kind) for r in rows.column("counts").to_pylist()]).astype(np.int64)
        order = np.argsort(h)
        h, count = h[order], count[order]
        begin = np.r_[0, np.flatnonzero(np.diff(h)) + 1]
        h = h[begin][np.add.reduceat(count, begin) >= least]
        own = (1 << bits) // ranges
        bitmap = np.zeros(own, dtype=bool)
        bitmap[(h >> np.uint64(64 - bits)).astype(np.int64) - number * own] = True
        missed = int((~_set(now[size - 1], h)).sum()) if now else 0
        return pa.table({"size": pa.array([size], pa.int32()), "range": [number], "part": [np.packbits(bitmap, bitorder="little").tobytes()], "missed": [missed]})

    return each


def _pass(docs: DataFrame, now: Proposal | None, before: Proposal | None, least: int, ranges: int, bits: int, piece_bytes: int) -> tuple[Proposal, bool]:
    """What may be frequent of the phrases counted, and whether all its words and pairs were proposed. Only bitmaps reach the driver."""
    sent = docs.mapInArrow(_send(now, before, ranges, least, piece_bytes), PACKED)
    found = sent.groupBy("size", "range").applyInArrow(_add_up(now, ranges, bits, least), "size int, range long, part binary, missed long").collect()
    whole = [np.zeros((1 << bits) // 8, dtype=np.uint8) for _ in range(3)]
    for r in found:
        part = np.frombuffer(bytes(r.part), np.uint8)
        whole[r["size"] - 1][r["range"] * len(part) : (r["range"] + 1) * len(part)] = part
    return Proposal(*[w.tobytes() for w in whole]), not any(r.missed for r in found if r["size"] < 3)


COUNTS = "lang string, size int, phrase string, f long"


def _spell(seen: Proposal, piece_bytes: int):
    """Counts by words of the phrases whose hash may be frequent; size 0 is the number of all words."""
    kinds = [pa.string(), pa.int32(), pa.string(), pa.int64()]

    def rows(lang: str, size: int, phrases: list[bytes], counts: np.ndarray) -> pa.RecordBatch:
        n = len(phrases)
        columns = [pa.array([lang] * n, kinds[0]), pa.array([size] * n, kinds[1]), pa.array(phrases, pa.binary()).cast(pa.string()), pa.array(counts, kinds[3])]
        return pa.RecordBatch.from_arrays(columns, ["lang", "size", "phrase", "f"])

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lang, text, lead in _buffers(batches, piece_bytes):
            words = _Words(text, lead, lang, exact=True)
            yield rows(lang, 0, [b""], np.array([words.n - lead]))
            for size, numbers, h, count in words.phrases(seen, None):
                some = np.flatnonzero(_set(seen[size - 1], h))
                if len(some):
                    yield rows(lang, size, words.spelled(tuple(k[some] for k in numbers)), count[some])

    return each


def frequent(
    docs: DataFrame, least: int = LEAST, sample_bytes: int = SAMPLE_BYTES, bits: int = BITS, piece_bytes: int = PIECE_BYTES, range_bytes: int = RANGE_BYTES
) -> DataFrame:
    """(lang, size, phrase, f) of every phrase of one to three words with f >= ``least``; (lang, 0, '') holds the number of words."""
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    share = min(1.0, sample_bytes / max(size, 1))
    ranges = min(1 << max(partitions(docs.sparkSession) - 1, -(-size // range_bytes) - 1).bit_length(), 1 << max(bits - 3, 0))
    lowered = max(LEAST_SEEN, int(LOWERED * least * share)) if least > 1 else 1
    sample = docs if share == 1 else docs.sample(share, seed=SEED)
    now, _ = _pass(sample, None, None, lowered, ranges, bits, piece_bytes)
    before, seen = None, Proposal(*[bytes(len(b)) for b in now])
    while True:
        more, closed = _pass(docs, now, before, least, ranges, bits, piece_bytes)
        seen = seen.joined(more)
        if closed:
            break
        before, now = now, now.joined(more)
    counted = docs.mapInArrow(_spell(seen, piece_bytes), COUNTS).groupBy("lang", "size", "phrase").agg(F.sum("f").alias("f"))
    return stored(counted.where((F.col("f") >= least) | (F.col("size") == 0)), "frequent")


def _cut(k: int) -> tuple[Column, Column]:
    """The first ``k`` words of a phrase, and the rest."""
    return F.substring_index("phrase", " ", k), F.expr(f"substring_index(phrase, ' ', {k} - size)")


def collocations(
    docs: DataFrame,
    least: int = LEAST,
    share: int = SHARE,
    top: int = TOP,
    sample_bytes: int = SAMPLE_BYTES,
    bits: int = BITS,
    piece_bytes: int = PIECE_BYTES,
) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the ``top`` phrases of two and three words in each language.

    ``docs`` has text and lang; other columns are ignored. A null text has no
    words, a null lang is ``und``. Repeated rows count as often as they come. Words are parted by spaces and
    tabs, phrases lie between marks and line ends, and only A to Z are put in
    lower case. ``a`` counts the phrase, ``l`` and ``r`` its two parts at the cut where
    1000000 * a * a / (l * r), rounded down, is least. A phrase with a < ``least`` is no
    candidate. One whose words lie in a longer candidate with at least ``share`` percent
    of its count is dropped. An empty table gives an empty result.
    """
    spark = docs.sparkSession
    rows = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit(UNKNOWN)).alias("lang"), text_or_empty().alias("text"))
    all_counts = frequent(rows, least, sample_bytes, bits, piece_bytes)
    total = all_counts.where("size = 0").groupBy("lang").agg(F.sum("f").alias("n"))
    known = all_counts.where("size > 0")
    candidates = known.where("size > 1").select("lang", "phrase", "size", F.col("f").alias("a"))

    # A part that is a single word may be that of very many phrases: their rows are dealt out, the word's count goes along.
    own = lambda single: F.when(single, F.pmod(F.xxhash64("phrase"), F.lit(SALT))).otherwise(F.lit(0).cast("long"))
    split = F.array(*[F.when(F.col("size") > k, F.struct(*[c.alias(s) for c, s in zip(_cut(k), "xy", strict=True)])) for k in (1, 2)])
    cuts = candidates.select("*", F.posexplode(split)).where("col IS NOT NULL").select("lang", "phrase", "size", "a", (F.col("pos") + 1).alias("k"), "col.x", "col.y")
    each = F.sequence(F.lit(0).cast("long"), F.when(F.col("size") == 1, F.lit(SALT - 1)).otherwise(F.lit(0)).cast("long"))
    parts = known.where("size < 3").select("lang", F.col("phrase").alias("part"), F.col("f"), F.explode(each).alias("salt"))
    for side, count, single in (("x", "l", F.col("k") == 1), ("y", "r", F.col("size") - F.col("k") == 1)):
        cuts = cuts.withColumn("salt", own(single)).join(parts.select("lang", "salt", F.col("part").alias(side), F.col("f").alias(count)), ["lang", "salt", side]).drop("salt")
    wide = lambda c: f"cast({c} AS decimal(14,0))"
    score = F.expr(f"(cast(1000000 AS decimal(7,0)) * {wide('a')} * {wide('a')}) div ({wide('l')} * {wide('r')})")
    scored = cuts.withColumn("score", score).groupBy("lang", "phrase", "size", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("least"))

    inside = candidates.where("size = 3").select(
        "lang", F.col("a").alias("longer"), F.explode(F.array(F.substring_index("phrase", " ", 2), F.substring_index("phrase", " ", -2))).alias("phrase")
    )
    longest = inside.groupBy("lang", "phrase").agg(F.max("longer").alias("longer"))
    kept = scored.join(longest, ["lang", "phrase"], "left").where(F.col("longer").isNull() | (100 * F.col("longer") < share * F.col("a")))
    order = W.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    best = kept.select("lang", "phrase", "a", "least.*").withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return best.join(total, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
