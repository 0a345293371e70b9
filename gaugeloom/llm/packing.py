"""Pack token sequences into windows, each document placed where the sum of squares stays least.

The level array counts the open windows of every fill. A document of ``a``
tokens goes to the fill level (or a new window) after which the sum of the
squared counts is smallest. That keeps the counts of all levels low, so that few
windows stay partly filled. Longer documents first fill whole windows. When
the input of a task ends, or very many windows are open, the open windows are
merged: the emptiest are cut up to fill the fullest. What is left of the last one
is cut at powers of two, which need no padding.

Every input partition is packed on its own, in the order in which its rows
come, with no shuffle. Read from a stored table, a task that is run again
gives the same pieces.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from gaugeloom.llm.common import text_or_empty
from gaugeloom.llm.tokens import encoder

#: Fixed values of the contract: tokens in a window and the end id.
CAPACITY = 4096
END_ID = 2
#: Open windows of a task before they are merged; at most that many times CAPACITY ids are held.
OPEN = 2048
SCHEMA = "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"

#: (document number, first id, number of ids) within a window.
Piece = tuple[int, int, int]


class Packer:
    """Places lengths into windows; ``closed`` collects finished windows as lists of pieces."""

    def __init__(self, capacity: int = CAPACITY, most_open: int = OPEN):
        self.capacity, self.most_open = capacity, most_open
        self.level = np.zeros(capacity + 1, dtype=np.int64)
        self.at: dict[int, list[list[Piece]]] = {}
        self.open = 0
        self.closed: list[list[Piece]] = []

    def place(self, doc: int, tokens: int) -> None:
        start = 0
        while tokens - start >= self.capacity:
            self.closed.append([(doc, start, self.capacity)])
            start += self.capacity
        if tokens > start:
            self._put((doc, start, tokens - start))
            if self.open > self.most_open:
                self.merge(last=False)

    def _choose(self, size: int) -> int:
        """The level to fill up; 0 for a new window. Ties go to the fullest level."""
        own = np.flatnonzero(self.level[1 : self.capacity - size + 1]) + 1
        # Half the change of the sum of squares, less what all moves have in common.
        new = self.level[size] - 0.5
        if not len(own):
            return 0
        after = self.level[own + size] - self.level[own]
        change = np.where(own + size == self.capacity, -self.level[own] - 0.5, after)
        best = len(own) - 1 - int(np.argmin(change[::-1]))
        return int(own[best]) if change[best] <= new else 0

    def _put(self, piece: Piece) -> None:
        level = self._choose(piece[2])
        if level:
            window = self.at[level].pop()
            self.level[level] -= 1
            self.open -= 1
        else:
            window = []
        window.append(piece)
        level += piece[2]
        if level == self.capacity:
            self.closed.append(window)
        else:
            self.at.setdefault(level, []).append(window)
            self.level[level] += 1
            self.open += 1

    def merge(self, last: bool = True) -> None:
        """Fill the fullest open windows with the pieces of the emptiest, cut where they have to be."""
        windows = [(n, w) for n in sorted(self.at, reverse=True) for w in self.at[n]]
        self.at, self.open = {}, 0
        self.level[:] = 0
        supply: list[Piece] = []
        while windows:
            fill, window = windows.pop(0)
            while fill < self.capacity and (supply or windows):
                if not supply:
                    supply = windows.pop()[1]
                doc, start, length = supply.pop()
                taken = min(length, self.capacity - fill)
                window.append((doc, start, taken))
                fill += taken
                if taken < length:
                    supply.append((doc, start + taken, length - taken))
            if fill == self.capacity:
                self.closed.append(window)
            else:
                self._rest(window, fill, last)
        if supply:
            self._rest(supply, sum(p[2] for p in supply), last)

    def _rest(self, window: list[Piece], fill: int, last: bool) -> None:
        if not last:
            self.at.setdefault(fill, []).append(window)
            self.level[fill] += 1
            self.open += 1
            return
        pieces = window[::-1]
        while fill:
            room = 1 << (fill.bit_length() - 1)
            fill -= room
            own: list[Piece] = []
            while room:
                doc, start, length = pieces.pop()
                taken = min(length, room)
                own.append((doc, start, taken))
                room -= taken
                if taken < length:
                    pieces.append((doc, start + taken, length - taken))
            self.closed.append(own)


def _pack(path: str, capacity: int, end_id: int, most_open: int):
    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with encoder(path) as encode:
            end = np.array([end_id], dtype=encode.kind).tobytes()
            width = encode.kind.itemsize
            packer = Packer(capacity, most_open)
            held: dict[int, list] = {}  # by document: its id, ids, and how many have not left yet
            number = 0
            sequence = TaskContext.get().partitionId() << 33

            def leave() -> Iterator[pa.RecordBatch]:
                nonlocal sequence
                for at in range(0, len(packer.closed), 512):
                    rows = []
                    for window in packer.closed[at : at + 512]:
                        offset = 0
                        for doc, start, length in window:
                            own = held[doc]
                            ids = np.frombuffer(own[1], encode.kind, length, start * width).astype("<u4").tobytes()
                            rows.append((own[0], start, length, ids, len(own[1]) // width, sequence, offset))
                            offset += length
                            own[2] -= length
                            if not own[2]:
                                del held[doc]
                        sequence += 1
                    yield _batch(rows)
                packer.closed.clear()

            for batch in batches:
                ids, texts = batch.column(0), batch.column(1).cast(pa.binary())
                for at in range(0, batch.num_rows, 1024):
                    doc_ids = ids.slice(at, 1024).to_pylist()
                    for doc_id, raw in zip(doc_ids, encode.encode(texts.slice(at, 1024).to_pylist()), strict=True):
                        raw += end
                        held[number] = [doc_id, raw, len(raw) // width]
                        packer.place(number, len(raw) // width)
                        number += 1
                    yield from leave()
            packer.merge()
            yield from leave()

    return each


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    names = ["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"]
    kinds = [pa.binary() if n == "ids" else pa.int64() for n in names]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)


def pack(docs: DataFrame, path: str, capacity: int = CAPACITY, end_id: int = END_ID, most_open: int = OPEN) -> DataFrame:
    """The pieces of all rows of ``docs`` (doc_id, text; other columns are ignored) in windows of ``capacity`` ids.

    Result: doc_id, start (ids of the document before the piece), length, ids
    (little-endian unsigned 32-bit), doc_tokens (ids of the document, with
    the end id), sequence_id, offset (in the sequence, from 0 without gaps).
    ``path`` names a vocabulary file of the tokenizers library.

    A null or empty text is the end id alone. Rows with a null or repeated
    doc_id are packed like all others and keep that id. An empty table gives no piece.
    """
    rows = docs.select("doc_id", text_or_empty().alias("text"))
    return rows.mapInArrow(_pack(path, capacity, end_id, most_open), SCHEMA)
