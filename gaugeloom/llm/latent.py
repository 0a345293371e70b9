"""Benchmark decontamination by latent semantic retrieval.

The passages of the benchmark are TF-IDF vectors over the benchmark's own
vocabulary, weighted by how many documents of the whole corpus hold a word. A
distributed randomised SVD gives their latent space: blocks of passages are
multiplied where they lie, and only the sums, with a row per word of the
vocabulary, come together. A space keeps the directions that hold ``ENERGY`` of its passages'
squared length, at most ``RANK``, and has fewer of them than passages. Every window of every document is folded into that
space, and compared with the passages there, both at length one: a passage that stands in a
document word for word has the cosine one whatever was cut off. A window is
only compared if the space holds enough of its weight, words outside the vocabulary counting with the mean weight.
Windows close to a passage are candidates. A candidate holds if the longest common
subsequence of the whole item and the words around the window covers most of the item, or
less of it but with the item's answer.

The space can only hold enough of a window if enough of its weight lies within the vocabulary, and it can only be close to
a passage if its words, each as strong as in the passage that has most of it, reach the bound together.
Both are tested before anything is folded in and lose no candidate.

A space holds at most ``TOGETHER`` passages, so that its directions keep enough of each;
an item with more passages spreads over several spaces. The documents are
scanned once for about ``ITEMS`` items or ``PASSAGES`` passages, against all their spaces, so
what a task holds has a bound for a benchmark of any size (a longer item has a scan with others of its hash).
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeloom.llm import words as wd
from gaugeloom.llm.common import stored, text_or_empty

ITEMS, PASSAGES = 1000, 2000
#: Words of half a window; windows overlap by half.
HALF = 16
RANK, EXTRA, ROUNDS = 384, 8, 2
TOGETHER = 800
#: Share of the passages' squared length that a space keeps, if ``RANK`` directions can.
ENERGY = 0.8
#: Least cosine within the space, and least share of a window's length that lies in the space.
COSINE, HELD = 0.45, 0.3
#: No count t makes (1 + ln t)**2 exceed this many times t.
REPEATS = 1.5
#: No count t up to the words of a window makes it less than this many times t.
FEWEST = 0.6
#: Share of an item that must be found in order, alone and together with its answer; share of the answer.
ALONE, WITH_ANSWER, ANSWER = 0.8, 0.6, 0.8
#: An item without an answer of its own has its last words as one.
TAIL_SHARE = 0.25
SEED = 11

#: All bytes of ASCII but letters and digits part words.
PARTING = np.zeros(256, dtype=bool)
PARTING[:128] = [not chr(b).isalnum() for b in range(128)]


class Item(NamedTuple):
    item_id: int
    words: list[int]
    answer: list[int]


class Space(NamedTuple):
    """Weights of the space's words, word directions (words, rank), passages of length one (passages, rank), the most any passage has of each word, the item of each passage and where it begins there.

    ``place`` has the word of the space for each word of the scan, and one more: -1 for those the space has not.
    """

    place: np.ndarray
    weight: np.ndarray
    outside: float
    axes: np.ndarray
    passages: np.ndarray
    most: np.ndarray
    item: np.ndarray
    offset: np.ndarray


class Scan(NamedTuple):
    """What one scan of the documents looks for; ``vocabulary`` are the sorted hashes of all words."""

    vocabulary: np.ndarray
    items: list[Item]
    spaces: list[Space]


def _hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every word, and where each text begins; the texts are in lower case."""
    parts, counts = [], []
    for a, b in wd.pieces(texts):
        found = wd.find_words(texts[a:b], PARTING)
        parts.append(wd.hashes(found))
        counts.append(np.diff(found.first))
    if not parts:
        return np.zeros(0, dtype=np.uint64), np.zeros(1, dtype=np.int64)
    return np.concatenate(parts), np.r_[0, np.cumsum(np.concatenate(counts))]


def _lower(column: pa.Array) -> list[bytes]:
    return pc.utf8_lower(column).cast(pa.binary()).to_pylist()


def _spelled(h: np.ndarray) -> bytes:
    return h.astype("<u8").tobytes()


def _read(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words and where each text begins, of texts or of hashes that ``_spelled`` made."""
    if not pa.types.is_binary(column.type):
        return _hashes(_lower(column))
    parts = [np.frombuffer(b, dtype="<u8") for b in column.to_pylist()]
    return np.concatenate([np.zeros(0, dtype=np.uint64), *parts]), np.r_[0, np.cumsum([len(x) for x in parts])].astype(np.int64)


def _terms(h: np.ndarray, vocabulary: np.ndarray, sieve: np.ndarray) -> np.ndarray:
    """Place of each word in the vocabulary, -1 if it is not there."""
    out = np.full(len(h), -1, dtype=np.int64)
    maybe = np.flatnonzero(sieve[(h & np.uint64(len(sieve) - 1)).astype(np.int64)])
    at = np.minimum(np.searchsorted(vocabulary, h[maybe]), len(vocabulary) - 1)
    good = vocabulary[at] == h[maybe]
    out[maybe[good]] = at[good]
    return out


def _sieve(vocabulary: np.ndarray) -> np.ndarray:
    """A first test of a word: the low 20 bits of its hash occur in the vocabulary."""
    out = np.zeros(1 << 20, dtype=bool)
    out[(vocabulary & np.uint64((1 << 20) - 1)).astype(np.int64)] = True
    return out


def document_counts(docs: DataFrame, vocabulary: np.ndarray) -> tuple[np.ndarray, int]:
    """In how many documents each word of the vocabulary stands, and how many documents there are."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sieve, total, n = _sieve(vocabulary), np.zeros(len(vocabulary), dtype=np.int64), 0
        for batch in batches:
            n += batch.num_rows
            for at in range(0, batch.num_rows, 1024):
                h, first = _hashes(_lower(batch.column(0).slice(at, 1024)))
                term = _terms(h, vocabulary, sieve)
                text = np.repeat(np.arange(len(first) - 1), np.diff(first))
                own = term >= 0
                pairs = np.unique(text[own] * len(vocabulary) + term[own])
                total += np.bincount(pairs % len(vocabulary), minlength=len(vocabulary))
        term = np.r_[np.flatnonzero(total), -1]
        yield pa.RecordBatch.from_arrays([pa.array(term), pa.array(np.r_[total[term[:-1]], n])], ["term", "n"])

    rows = docs.select(text_or_empty().alias("text")).mapInArrow(each, "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).collect()
    found = {r.term: r.n for r in rows}
    return np.array([found.get(t, 0) for t in range(len(vocabulary))], dtype=np.int64), found.get(-1, 0)


def _passages(h: np.ndarray, first: np.ndarray) -> list[tuple[int, int, int]]:
    """(text, begin, end) of the windows of each text, two halves long, one half apart."""
    out = []
    for t, (a, b) in enumerate(zip(first[:-1].tolist(), first[1:].tolist(), strict=True)):
        for at in range(a, max(a + 1, b - HALF), HALF):
            out.append((t, at, min(at + 2 * HALF, b)))
    return out


def _times(passages: DataFrame, vocabulary: np.ndarray, weight: np.ndarray, right: np.ndarray) -> np.ndarray:
    """A^T (A right) of the weighted passages A, summed over the partitions."""
    columns = right.shape[1]

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sieve, total = _sieve(vocabulary), np.zeros((len(vocabulary), columns))
        for batch in batches:
            h, first = _read(batch.column(0))
            term = _terms(h, vocabulary, sieve)
            for _, a, b in _passages(h, first):
                own, times = np.unique(term[a:b][term[a:b] >= 0], return_counts=True)
                row = (1 + np.log(times)) * weight[own]
                length = math.sqrt(row @ row)
                if length:
                    row = row / length
                    total[own] += row[:, None] * (row @ right[own])
        used = np.flatnonzero(total.any(axis=1))
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used].tolist(), pa.list_(pa.float64()))], ["term", "row"])

    zip_add = lambda a, b: F.zip_with(a, b, lambda x, y: x + y)
    parts = passages.select("hashes" if "hashes" in passages.columns else "text").mapInArrow(each, "term long, row array<double>").groupBy("term").agg(F.collect_list("row").alias("rows"))
    out = np.zeros_like(right)
    for r in parts.select("term", F.reduce(F.slice("rows", 2, F.size("rows")), F.element_at("rows", 1), zip_add).alias("row")).collect():
        out[r.term] = r.row
    return out


def directions(passages: DataFrame, vocabulary: np.ndarray, weight: np.ndarray, rank: int = RANK, energy: float = 1.0, count: int = 0) -> np.ndarray:
    """Right singular vectors (words, directions) of the passages, by subspace iteration from a random start.

    There are ``rank`` at most, and no more than hold the share ``energy`` of the squared length of ``count`` passages.
    """
    width = min(rank + EXTRA, len(vocabulary))
    basis = np.linalg.qr(np.random.default_rng(SEED).standard_normal((len(vocabulary), width)))[0]
    for _ in range(ROUNDS):
        basis = np.linalg.qr(_times(passages, vocabulary, weight, basis))[0]
    value, turn = np.linalg.eigh(basis.T @ _times(passages, vocabulary, weight, basis))
    best = np.argsort(-value)[:rank]
    best = best[value[best] > 1e-9]
    if energy < 1:
        best = best[: np.searchsorted(np.cumsum(value[best]), energy * count) + 1]
    return (basis @ turn[:, best]).astype(np.float32)


def common_length(item: list[int], words: list[int]) -> int:
    """Length of the longest common subsequence, with one bit per word of the item."""
    places: dict[int, int] = {}
    for k, w in enumerate(item):
        places[w] = places.get(w, 0) | 1 << k
    full = (1 << len(item)) - 1
    free = full
    for w in words:
        hit = free & places.get(w, 0)
        free = ((free + hit) | (free - hit)) & full
    return len(item) - free.bit_count()


def _items(block: DataFrame) -> tuple[list[Item], np.ndarray, np.ndarray]:
    rows = sorted(block.select("item_id", "text", "answer").collect(), key=lambda r: (r.item_id, r.text))
    items, texts = [], [r.text.lower().encode() for r in rows]
    h, first = _hashes(texts)
    answers, begin = _hashes([(r.answer or "").lower().encode() for r in rows])
    kept_h, counts = [], []
    for k, r in enumerate(rows):
        own = h[first[k] : first[k + 1]].tolist()
        if not own:
            continue
        answer = answers[begin[k] : begin[k + 1]].tolist() or own[-max(1, math.ceil(TAIL_SHARE * len(own))) :]
        items.append(Item(r.item_id, own, answer))
        kept_h.extend(own)
        counts.append(len(own))
    return items, np.array(kept_h, dtype=np.uint64), np.r_[0, np.cumsum(counts)].astype(np.int64)


def blocks_of(first: np.ndarray, rank: int = TOGETHER) -> list[list[tuple[int, int, int]]]:
    """Blocks of at most ``rank`` passages, each a list of (item, begin, end) of stretches of words of one item."""
    out: list[list[tuple[int, int, int]]] = [[]]
    held = 0
    for k, n in enumerate(np.diff(first).tolist()):
        of = len(range(0, max(1, n - HALF), HALF))
        for at in range(0, of, rank):
            size = min(rank, of - at)
            if held + size > rank:
                out.append([])
                held = 0
            # The last passage reaches a half beyond where it begins, into what the next stretch begins with.
            out[-1].append((k, at * HALF, n if at + size == of else (at + size + 1) * HALF))
            held += size
    return out


def fit(block: DataFrame, docs: DataFrame, rank: int = RANK, energy: float = ENERGY, together: int = TOGETHER) -> Scan | None:
    """The latent spaces of some benchmark items; null if no item has a word."""
    items, h, first = _items(block)
    if not items:
        return None
    vocabulary = np.unique(h)
    counts, n = document_counts(docs, vocabulary)
    idf = np.log((n + 1) / (counts + 0.5))
    spaces = []
    for stretches in blocks_of(first, together):
        parts = [h[first[k] + a : first[k] + b] for k, a, b in stretches]
        begins = np.r_[0, np.cumsum([len(x) for x in parts])]
        joined = np.concatenate(parts)
        own = np.unique(joined)
        of_scan = np.searchsorted(vocabulary, own)
        weight = idf[of_scan]
        count = len(_passages(joined, begins))
        axes = directions(block.sparkSession.createDataFrame([(_spelled(x),) for x in parts], "hashes binary"), own, weight, rank, energy, count)
        at = np.searchsorted(own, joined)
        rows, item, offset = [], [], []
        for part, a, b in _passages(joined, begins):
            word, times = np.unique(at[a:b], return_counts=True)
            entry = (1 + np.log(times)) * weight[word]
            folded = entry @ axes[word]
            rows.append(folded / max(float(np.sqrt(folded @ folded)), 1e-12))
            item.append(stretches[part][0])
            offset.append(stretches[part][1] + a - int(begins[part]))
        place = np.full(len(vocabulary) + 1, -1, dtype=np.int64)
        place[of_scan] = np.arange(len(own))
        passages = np.array(rows, dtype=np.float32)
        most = np.maximum((axes @ passages.T).max(axis=1), 0).astype(np.float64)
        spaces.append(Space(place, weight, float(weight.mean()), axes, passages, most, np.array(item), np.array(offset)))
    return Scan(vocabulary, items, spaces)


def _search(scan: Scan, cosine: float):
    limit = np.float32(HELD)
    below = 0.999 * cosine * HELD  # leaves room for rounding

    def near_passages(space: Space, first: np.ndarray, term: np.ndarray) -> Iterator[tuple[int, int, int, int, float]]:
        """(text, begin, end, passage, cosine) of every window close to a passage; ``term`` are words of the space."""
        count, gain = np.diff(first), space.weight * space.most
        halves = np.maximum(-(-count // HALF), 1)
        text = np.repeat(np.arange(len(count)), count)
        half = (np.cumsum(halves) - halves)[text] + (np.arange(len(term)) - first[text]) // HALF
        inside = np.where(term >= 0, space.weight[term], 0.0)
        own, other, reached = (np.zeros(int(halves.sum()) + 1) for _ in range(3))
        own[:-1] = np.bincount(half, inside**2, minlength=len(own) - 1)
        other[:-1] = np.bincount(half, term < 0, minlength=len(own) - 1) * space.outside**2
        reached[:-1] = np.bincount(half, np.where(term >= 0, gain[term], 0.0), minlength=len(own) - 1)
        last = np.zeros(len(own), dtype=bool)
        last[np.cumsum(halves) - 1] = True
        joined = np.where(last[:-1], 0, 1)
        inner, outer = own[:-1] + joined * own[1:], other[:-1] + joined * other[1:]
        top = reached[:-1] + joined * reached[1:]
        chosen = np.flatnonzero((REPEATS * inner * (1 - limit**2) >= limit**2 * outer) & (top >= below * np.sqrt(FEWEST * inner + outer)) & (inner > 0))
        of = np.repeat(np.arange(len(halves)), halves)
        begin = first[of[chosen]] + (chosen - (np.cumsum(halves) - halves)[of[chosen]]) * HALF
        end = np.minimum(begin + 2 * HALF, first[of[chosen] + 1])
        for a in range(0, len(chosen), 4096):
            part = slice(a, a + 4096)
            size = end[part] - begin[part]
            place = np.arange(int(size.sum())) + np.repeat(begin[part] - (np.cumsum(size) - size), size)
            row = np.repeat(np.arange(len(size)), size)
            ids = term[place]
            pair, times = np.unique(row[ids >= 0] * len(space.weight) + ids[ids >= 0], return_counts=True)
            at, word = pair // len(space.weight), pair % len(space.weight)
            entry = (1 + np.log(times)) * space.weight[word]
            own_square = np.bincount(at, entry**2, minlength=len(size))
            square = own_square + space.outside**2 * np.bincount(row[ids < 0], minlength=len(size))
            best = np.bincount(at, entry * space.most[word], minlength=len(size))
            strong = np.flatnonzero((own_square >= limit**2 * square) & (best >= below * np.sqrt(square)) & (own_square > 0))
            if not len(strong):
                continue
            number = np.full(len(size), -1)
            number[strong] = np.arange(len(strong))
            use = number[at] >= 0
            at, word, entry = number[at[use]], word[use], entry[use]
            near, length = np.empty((len(strong), len(space.passages)), dtype=np.float32), np.empty(len(strong), dtype=np.float32)
            for b in range(0, len(strong), 512):  # the words of the windows are in the windows' order
                lo, hi = np.searchsorted(at, [b, b + 512])
                scaled = entry[lo:hi, None].astype(np.float32) * space.axes[word[lo:hi]]
                folded = np.add.reduceat(scaled, np.flatnonzero(np.diff(at[lo:hi], prepend=-1)))
                near[b : b + 512] = folded @ space.passages.T
                length[b : b + 512] = np.sqrt((folded * folded).sum(axis=1))
            near /= np.maximum(length, 1e-12)[:, None]
            near[length < limit * np.sqrt(square[strong])] = 0
            for x, p in zip(*np.nonzero(near >= cosine), strict=True):
                w = a + int(strong[x])
                yield int(of[chosen[w]]), int(begin[w]), int(end[w]), int(p), float(near[x, p])

    def hits(h: np.ndarray, first: np.ndarray, term: np.ndarray) -> list[tuple[int, int, float, float, bool, int]]:
        """Best (text, item, cosine, share, answer, word) per text and item."""
        found: dict[tuple[int, int], tuple] = {}
        shared: dict[tuple[int, int, int], tuple[float, bool]] = {}
        for space in scan.spaces:
            for t, begin, end, p, near in near_passages(space, first, space.place[term]):
                k = int(space.item[p])
                item = scan.items[k]
                reach, start = len(item.words) // 2 + HALF, begin - int(space.offset[p])
                lo, hi = max(int(first[t]), start - reach), min(int(first[t + 1]), max(end, start + len(item.words)) + reach)
                if (k, lo, hi) not in shared:
                    around = h[lo:hi].tolist()
                    shared[k, lo, hi] = common_length(item.words, around) / len(item.words), common_length(item.answer, around) >= ANSWER * len(item.answer)
                share, answered = shared[k, lo, hi]
                if share >= ALONE or share >= WITH_ANSWER and answered:
                    if (t, k) not in found or found[t, k][3:1:-1] < (share, near):
                        found[t, k] = (t, item.item_id, near, share, answered, lo - int(first[t]))
        return list(found.values())

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sieve = _sieve(scan.vocabulary)
        for batch in batches:
            rows = []
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                h, first = _hashes(_lower(part.column(2)))
                if len(h):
                    for t, *rest in hits(h, first, _terms(h, scan.vocabulary, sieve)):
                        rows.append((part.column(0)[t].as_py(), part.column(1)[t].as_py(), *rest))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), _KINDS, strict=True)], _NAMES)

    return each


_NAMES = ["doc_id", "text_key", "item_id", "cosine", "share", "answered", "near_word"]
_KINDS = [pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.bool_(), pa.int64()]
SCHEMA = "doc_id long, text_key long, item_id long, cosine double, share double, answered boolean, near_word long"


def contaminated(docs: DataFrame, benchmark: DataFrame, cosine: float = COSINE, items: int = ITEMS) -> DataFrame:
    """(doc_id, text_key, item_id, cosine, share, answered, near_word) for each row of ``docs`` and item it gives away.

    ``docs`` has doc_id and text, ``benchmark`` item_id, text and perhaps answer; other columns are
    ignored. ``text_key`` is the hash of the text, ``share`` the part of the item found in order, ``answered``
    whether its answer was found, ``near_word`` the word where the compared
    stretch begins. Texts and items that are null or have no word give nothing. Rows with a
    null doc_id are searched like all others. Repeated rows and items come out as often as
    they came in (an item that comes twice with one id counts twice). Empty tables give an empty result.
    """
    rows = docs.select("doc_id", F.xxhash64(text_or_empty()).alias("text_key"), text_or_empty().alias("text"))
    answer = F.col("answer").cast("string") if "answer" in benchmark.columns else F.lit(None).cast("string")
    known = stored(benchmark.select("item_id", text_or_empty().alias("text"), answer.alias("answer")).where("text != ''"), "items")
    words = F.size(F.split("text", "[^0-9A-Za-z\\x{80}-\\x{10ffff}]+"))
    count, passages = known.agg(F.count(F.lit(1)), F.sum(F.ceil(words / HALF))).first()
    scans = max(1, -(-count // items), -(-(passages or 0) // (PASSAGES * items // ITEMS)))
    part = F.pmod(F.xxhash64("item_id", "text"), F.lit(scans))
    fitted = [fit(known.where(part == k), rows) for k in range(scans)]
    found = [rows.mapInArrow(_search(s, cosine), SCHEMA) for s in fitted if s]
    return reduce(DataFrame.union, found) if found else rows.limit(0).select("doc_id", "text_key", *(F.lit(None).cast(t).alias(n) for n, t in (("item_id", "long"), ("cosine", "double"), ("share", "double"), ("answered", "boolean"), ("near_word", "long"))))
