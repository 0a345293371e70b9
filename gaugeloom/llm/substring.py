"""Exact repeats of word sequences across documents, by fixed-block anchors.

A window of ``window`` words always holds a whole block of
``(window + 1) // 2`` words that starts at a multiple of that length. So every
document is indexed by its non-overlapping blocks only, and all rolling blocks
of all documents probe that index. A block that is indexed somewhere and occurs
in two documents is an anchor. Around the anchors, and nowhere else, the hits
are extended: each window that holds one is compared with the same windows of
all documents, and windows that repeat are joined to maximal runs.

Documents are dealt into pieces of some megabytes. A piece sends each key once,
with many keys packed into a row, so a passage that a third of all documents
share costs a key per piece, and no pairs of documents are made anywhere.
Anchors compare 40 bits of a hash, which can only let in needless windows. What is removed
is decided by two hashes of 64 bits each, of different seeds down to the bytes of every word: among
10**13 windows two different ones agree with a probability below 10**-12.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeloom.llm import words as wd
from gaugeloom.llm.common import partitions, text_or_empty

WINDOW = 13
PIECE_BYTES = 8_000_000
#: Text whose block keys share a bucket, so that a bucket of any corpus fits a worker.
BUCKET_BYTES = 32_000_000
_DROP = np.uint64(24)
_SHORT = np.uint64(40)

PACKED = "piece long, ids binary, known binary, sizes binary, body binary"


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (piece, doc_id, text) as one row per batch and piece."""
    squeeze = zstandard.ZstdCompressor(level=3)
    for batch in batches:
        order = np.argsort(batch.column(0).to_numpy(), kind="stable")
        piece = batch.column(0).to_numpy()[order]
        known = batch.column(1).is_valid().to_numpy(zero_copy_only=False)[order]
        ids = batch.column(1).fill_null(0).to_numpy()[order]
        texts = batch.column(2).cast(pa.binary()).take(pa.array(order)).to_pylist()
        sizes = np.array([len(t) for t in texts], dtype=np.int64)
        edges = np.concatenate([[0], np.flatnonzero(np.diff(piece)) + 1, [len(piece)]]) if len(piece) else []
        rows = [
            (int(piece[a]), ids[a:b].tobytes(), known[a:b].tobytes(), sizes[a:b].tobytes(), squeeze.compress(b"".join(texts[a:b])))
            for a, b in zip(edges[:-1], edges[1:], strict=True)
        ]
        if rows:
            names = ["piece", "ids", "known", "sizes", "body"]
            kinds = [pa.int64()] + [pa.binary()] * 4
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)


class _Piece:
    """The documents of one piece and the hashes of their words."""

    def __init__(self, rows: pa.Table, window: int):
        ids, known, self.texts = [], [], []
        expand = zstandard.ZstdDecompressor()
        for r in rows.to_pylist():
            ids.append(np.frombuffer(r["ids"], dtype=np.int64))
            known.append(np.frombuffer(r["known"], dtype=bool))
            body, at = expand.decompress(r["body"]), 0
            for size in np.frombuffer(r["sizes"], dtype=np.int64).tolist():
                self.texts.append(body[at : at + size])
                at += size
        self.ids, self.known = np.concatenate(ids), np.concatenate(known)
        found = [wd.find_words(self.texts[a:b]) for a, b in wd.pieces(self.texts)]
        spelled = [wd.blocks(w.data, w.start, w.stop) for w in found]
        self.hash, self.check = (np.concatenate([wd.block_hashes(s, seed) for s in spelled]) for seed in (0, 1))
        self.count = np.concatenate([np.diff(w.first) for w in found])
        self.first = np.concatenate([[0], np.cumsum(self.count)])
        self.doc = np.repeat(np.arange(len(self.count)), self.count)
        self.left = self.first[1:][self.doc] - np.arange(len(self.hash))
        self.joins = self.known[self.doc] & (self.count[self.doc] >= window)

    def blocks(self, block: int) -> tuple[np.ndarray, np.ndarray]:
        """Key of the block at each word, and where a block begins."""
        return wd.windows(self.hash, block), self.joins & (self.left >= block)

    def windows(self, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Two independent keys of the window at each word, and where a window begins."""
        return wd.windows(self.hash, window, 1), wd.windows(self.check, window, 2), self.joins & (self.left >= window)


def _runs(*keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The order that sorts the keys, the first one before the others, and where each distinct one begins in it."""
    order = np.argsort(keys[0]) if len(keys) == 1 else np.lexsort(keys[::-1])
    new = np.zeros(max(len(order) - 1, 0), dtype=bool)
    for key in keys:
        ranked = key[order]
        new |= ranked[1:] != ranked[:-1]
    return order, np.concatenate([[0], np.flatnonzero(new) + 1])


def _five(short: np.ndarray) -> bytes:
    """Numbers below 2**40 as five planes of bytes; sorted ones have a first plane that compresses well."""
    return short.astype("<u8").view(np.uint8).reshape(-1, 8)[:, 4::-1].T.tobytes()


def _unfive(data: bytes) -> np.ndarray:
    planes = np.frombuffer(data, dtype=np.uint8).reshape(5, -1)
    out = np.zeros(planes.shape[1], dtype=np.uint64)
    for plane in planes:
        out = (out << np.uint64(8)) | plane
    return out


def _by_bucket(keys: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    bucket = (keys % np.uint64(buckets)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    edges = np.searchsorted(bucket[order], np.arange(buckets + 1)) if buckets <= len(keys) else None
    if edges is None:
        cuts = np.flatnonzero(np.diff(bucket[order])) + 1
        edges = np.concatenate([[0], cuts, [len(keys)]])
    return bucket, order, edges


ANCHORS = "bucket long, piece long, keys binary, indexed binary, several binary"


def _anchor_keys(window: int, buckets: int):
    block = (window + 1) // 2

    def each(key: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
        piece = _Piece(rows, window)
        value, begins = piece.blocks(block)
        place = np.arange(len(value)) - piece.first[piece.doc]
        value, doc, fixed = value[begins], piece.doc[begins], (place[begins] % block) == 0
        out = []
        if len(value):
            order, begin = _runs(value)
            unique = value[order][begin]
            indexed = np.logical_or.reduceat(fixed[order], begin)
            several = np.minimum.reduceat(doc[order], begin) != np.maximum.reduceat(doc[order], begin)
            bucket, dealt, edges = _by_bucket(unique, buckets)
            for a, b in zip(edges[:-1], edges[1:], strict=True):
                if b > a:
                    own = dealt[a:b]
                    out.append((int(bucket[own[0]]), key[0].as_py(), _five(unique[own] >> _DROP), np.packbits(indexed[own]).tobytes(), np.packbits(several[own]).tobytes()))
        return _table(out, ["bucket", "piece", "keys", "indexed", "several"], 2)

    return each


def _table(rows: list, names: list[str], longs: int) -> pa.Table:
    kinds = [pa.int64()] * longs + [pa.binary()] * (len(names) - longs)
    columns = zip(*rows, strict=True) if rows else [[]] * len(names)
    return pa.Table.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)


def _bits(data: bytes, n: int) -> np.ndarray:
    return np.unpackbits(np.frombuffer(data, dtype=np.uint8), count=n).astype(bool)


def _shared_anchors(key: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
    """Of one bucket, per piece the keys that are indexed somewhere and occur in two documents."""
    rows = rows.to_pylist()
    parts = [_unfive(r["keys"]) for r in rows]
    size = [len(p) for p in parts]
    value = np.concatenate(parts)
    indexed = np.concatenate([_bits(r["indexed"], n) for r, n in zip(rows, size, strict=True)])
    several = np.concatenate([_bits(r["several"], n) for r, n in zip(rows, size, strict=True)])
    order, begin = _runs(value)
    runs = np.diff(np.concatenate([begin, [len(value)]]))
    good = np.logical_or.reduceat(indexed[order], begin) & ((runs > 1) | np.logical_or.reduceat(several[order], begin))
    keep = np.empty(len(value), dtype=bool)
    keep[order] = np.repeat(good, runs)
    out, at = [], 0
    for r, part, n in zip(rows, parts, size, strict=True):
        chosen = part[keep[at : at + n]]
        at += n
        if len(chosen):
            out.append((r["piece"], key[0].as_py(), _five(chosen)))
    return _table(out, ["piece", "bucket", "keys"], 2)


WINDOWS = "bucket long, piece long, keys binary, checks binary, least binary, several binary"


def _found(sought: np.ndarray, among: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where each sought number stands among sorted ones, and whether it is there."""
    at = np.minimum(np.searchsorted(among, sought), max(len(among) - 1, 0))
    return at, (among[at] == sought) if len(among) else np.zeros(len(sought), dtype=bool)


def _window_keys(window: int, buckets: int):
    block = (window + 1) // 2

    def each(key: tuple[pa.Scalar, ...], left: pa.Table, right: pa.Table) -> pa.Table:
        names = ["bucket", "piece", "keys", "checks", "least", "several"]
        if not right.num_rows or not left.num_rows:
            return _table([], names, 2)
        piece = _Piece(left, window)
        anchors = np.sort(np.concatenate([np.uint64(r["bucket"] << 40) | _unfive(r["keys"]) for r in right.to_pylist()]))
        value, begins = piece.blocks(block)
        hit = np.zeros(len(value) + 1, dtype=np.int64)
        own = value[begins]
        hit[1:][begins] = _found((own % np.uint64(buckets)) << _SHORT | own >> _DROP, anchors)[1]
        upto = np.cumsum(hit)
        value, check, begins = piece.windows(window)
        at = np.flatnonzero(begins)
        at = at[upto[at + window - block + 1] > upto[at]]
        out = []
        if len(at):
            value, check, doc = value[at], check[at], piece.doc[at]
            order, begin = _runs(value, check)
            unique, checks = value[order][begin], check[order][begin]
            least = np.minimum.reduceat(piece.ids[doc][order], begin)
            several = np.minimum.reduceat(doc[order], begin) != np.maximum.reduceat(doc[order], begin)
            bucket, dealt, edges = _by_bucket(unique, buckets)
            for a, b in zip(edges[:-1], edges[1:], strict=True):
                if b > a:
                    own = dealt[a:b]
                    own = own[np.argsort(order[begin[own]])]  # in the order of the text, so that ids repeat
                    out.append((int(bucket[own[0]]), key[0].as_py(), unique[own].tobytes(), checks[own].tobytes(), least[own].tobytes(), np.packbits(several[own]).tobytes()))
        return _table(out, names, 2)

    return each


def _repeated_windows(key: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
    """Of one bucket, per piece the windows that may start in a smaller document, with the smallest one."""
    rows = rows.to_pylist()
    parts = [np.frombuffer(r["keys"], dtype=np.uint64) for r in rows]
    value = np.concatenate(parts)
    check = np.concatenate([np.frombuffer(r["checks"], dtype=np.uint64) for r in rows])
    least = np.concatenate([np.frombuffer(r["least"], dtype=np.int64) for r in rows])
    several = np.concatenate([_bits(r["several"], len(p)) for r, p in zip(rows, parts, strict=True)])
    order, begin = _runs(value, check)
    runs = np.diff(np.concatenate([begin, [len(value)]]))
    first = np.empty(len(value), dtype=np.int64)
    first[order] = np.repeat(np.minimum.reduceat(least[order], begin), runs)
    keep = several | (first < least)
    out, at = [], 0
    for r, part in zip(rows, parts, strict=True):
        own = slice(at, at + len(part))
        at += len(part)
        if keep[own].any():
            out.append((r["piece"], part[keep[own]].tobytes(), check[own][keep[own]].tobytes(), first[own][keep[own]].tobytes()))
    return _table(out, ["piece", "keys", "checks", "first"], 1)


RESULT = "doc_id long, n_words long, n_removed long, runs array<struct<start:long,length:long>>, kept string"


def _cut(window: int):
    kind = pa.schema(
        [("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()),
         ("runs", pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64())]))), ("kept", pa.string())]
    )

    def each(key: tuple[pa.Scalar, ...], left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows:
            return kind.empty_table()
        piece = _Piece(left, window)
        n = len(piece.hash)
        step = np.zeros(n + 1, dtype=np.int64)
        if right.num_rows:
            kinds = {"keys": np.uint64, "checks": np.uint64, "first": np.int64}
            known, checks, first = (np.concatenate([np.frombuffer(r, dtype=t) for r in right.column(c).to_pylist()]) for c, t in kinds.items())
            order = np.lexsort((checks, known))
            known, checks, first = known[order], checks[order], first[order]
            value, check, begins = piece.windows(window)
            at = np.flatnonzero(begins)
            rank, there = _found(value[at], known)
            at, rank = at[there], rank[there]
            while True:  # past entries that share the first key alone
                other = np.flatnonzero((checks[rank] < check[at]) & (known[np.minimum(rank + 1, len(known) - 1)] == value[at]) & (rank + 1 < len(known)))
                if not len(other):
                    break
                rank[other] += 1
            at = at[(checks[rank] == check[at]) & (first[rank] < piece.ids[piece.doc[at]])]
            step[at] += 1
            step[at + window] -= 1
        gone = np.cumsum(step)[:n] > 0
        rows = []
        for i, text in enumerate(piece.texts):
            lo, hi = int(piece.first[i]), int(piece.first[i + 1])
            tokens, own = text.split(), gone[lo:hi]
            runs = []
            if own.any():
                tokens = list(compress(tokens, ~own))
                edge = np.flatnonzero(np.diff(np.concatenate([[0], own.astype(np.int8), [0]])))
                runs = [{"start": int(a), "length": int(b - a)} for a, b in zip(edge[::2], edge[1::2], strict=True)]
            doc_id = int(piece.ids[i]) if piece.known[i] else None
            rows.append({"doc_id": doc_id, "n_words": hi - lo, "n_removed": hi - lo - len(tokens), "runs": runs, "kept": b" ".join(tokens).decode()})
        return pa.Table.from_pylist(rows, kind)

    return each


def remove_repeats(docs: DataFrame, window: int = WINDOW, piece_bytes: int = PIECE_BYTES) -> DataFrame:
    """(doc_id, n_words, n_removed, runs, kept) of every row of ``docs`` (doc_id, text; other columns are ignored).

    Each word is removed that a window of ``window`` words covers whose words
    also stand in a document with a smaller doc_id. Windows are judged on the
    input. ``runs`` are the maximal removed stretches (position of the first
    word, number of words), ``kept`` the other words, joined by one space.

    A null text has no words. A row with a null doc_id has no place in the
    order: it keeps all words and takes none from others. Rows of equal doc_id
    take no words from each other. Repeated rows come out as often as they came
    in, an empty table gives an empty result.
    """
    spark = docs.sparkSession
    n = partitions(spark)
    rows = docs.select("doc_id", text_or_empty().alias("text"))
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    count = max(1, -(-size // piece_bytes))
    dealt = rows.select(F.pmod(F.xxhash64("doc_id", "text"), F.lit(count)).alias("piece"), "doc_id", "text")
    packed = dealt.mapInArrow(_pack, PACKED).repartition(n, "piece")
    buckets = max(4 * n, -(-size // BUCKET_BYTES))
    anchors = packed.groupBy("piece").applyInArrow(_anchor_keys(window, buckets), ANCHORS)
    shared = anchors.groupBy("bucket").applyInArrow(_shared_anchors, "piece long, bucket long, keys binary")
    keyed = packed.groupBy("piece").cogroup(shared.groupBy("piece")).applyInArrow(_window_keys(window, buckets), WINDOWS)
    repeated = keyed.groupBy("bucket").applyInArrow(_repeated_windows, "piece long, keys binary, checks binary, first binary")
    return packed.groupBy("piece").cogroup(repeated.groupBy("piece")).applyInArrow(_cut(window), RESULT)
