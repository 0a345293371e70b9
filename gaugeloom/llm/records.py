"""Token ids in length-delimited binary records, with an offset index for shuffled reads.

A record is: length of the payload (unsigned 64 bits), masked CRC-32C of those
8 bytes, the payload, masked CRC-32C of the payload; all little-endian, the framing of
TFRecord files. A payload is a flag (1 if the document has an id), the bytes
an id takes, 6 zero bytes, the document id (signed 64 bits), the ids.
Beside each ``.rec`` file lies an ``.idx`` file with the offset of every record
(unsigned 64 bits), so that any record can be read on its own.

Documents are range-partitioned by doc_id and written in order, in files of
bounded size. A file appears under its name only when it is complete, and a task
that is run again writes the same files.
"""

from __future__ import annotations

import struct
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from gaugeloom.llm.common import partitions, stored, text_or_empty
from gaugeloom.llm.tokens import encoder, wide

END_ID = 2
FILE_BYTES = 64_000_000
#: Fixed values of the format: reflected polynomial of CRC-32C and the mask of TFRecord checksums.
POLYNOMIAL = 0x82F63B78
MASK = 0xA282EAD8
BLOCK = 256
HEAD = "<BB6xq"
HEAD_BYTES = struct.calcsize(HEAD)


def _step(state: np.ndarray, table: np.ndarray) -> np.ndarray:
    return (state >> np.uint32(8)) ^ table[state & np.uint32(255)]


def _tables() -> tuple[np.ndarray, np.ndarray]:
    """For words of four bytes, and for skipping ``BLOCK`` zero bytes: four tables each, one per byte."""
    first = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        first = np.where(first & 1, (first >> np.uint32(1)) ^ np.uint32(POLYNOMIAL), first >> np.uint32(1))
    word = [first]
    for _ in range(3):
        word.append(_step(word[-1], first))
    skip = []
    for k in range(4):
        state = np.arange(256, dtype=np.uint32) << np.uint32(8 * k)
        for _ in range(BLOCK):
            state = _step(state, first)
        skip.append(state)
    return np.array(word[::-1], dtype=np.uint32), np.array(skip, dtype=np.uint32)


WORD, SKIP = _tables()


def _apply(tables: np.ndarray, state: np.ndarray) -> np.ndarray:
    out = tables[0][state & np.uint32(255)]
    for k in (1, 2, 3):
        out ^= tables[k][(state >> np.uint32(8 * k)) & np.uint32(255)]
    return out


def checksums(parts: list[bytes]) -> np.ndarray:
    """CRC-32C of each part, of at least four bytes, all computed side by side."""
    if not parts:
        return np.zeros(0, dtype=np.uint32)
    size = np.array([len(p) for p in parts])
    if size.min() < 4:
        raise ValueError("a part needs four bytes")
    blocks = -(-size // BLOCK)
    last = np.cumsum(blocks)
    data = np.zeros(int(last[-1]) * BLOCK, dtype=np.uint8)
    for part, end in zip(parts, (last * BLOCK).tolist(), strict=True):
        # Zeros before the data change nothing; the first four bytes are inverted instead of the initial state.
        own = data[end - len(part) : end]
        own[:] = np.frombuffer(part, dtype=np.uint8)
        own[:4] ^= np.uint8(255)
    words = np.ascontiguousarray(data.view("<u4").reshape(-1, BLOCK // 4).T)
    state = np.zeros(len(data) // BLOCK, dtype=np.uint32)
    for column in words:
        state = _apply(WORD, state ^ column)
    first = last - blocks
    out = state[first]
    for k in range(1, int(blocks.max())):
        own = np.flatnonzero(blocks > k)
        out[own] = _apply(SKIP, out[own]) ^ state[first[own] + k]
    return ~out


def masked(parts: list[bytes]) -> np.ndarray:
    crc = checksums(parts)
    return ((crc >> np.uint32(15)) | (crc << np.uint32(17))) + np.uint32(MASK)


def frame(payloads: list[bytes]) -> list[bytes]:
    """The payloads as records."""
    sizes = [struct.pack("<Q", len(p)) for p in payloads]
    pairs = zip(sizes, masked(sizes).astype("<u4").tolist(), payloads, masked(payloads).astype("<u4").tolist(), strict=True)
    return [b"".join((s, struct.pack("<I", a), p, struct.pack("<I", b))) for s, a, p, b in pairs]


def unframe(data: memoryview, offsets: np.ndarray) -> list[memoryview]:
    """The payloads of the records at ``offsets``; any wrong length or checksum is an error."""
    heads, sums, out, tails = [], [], [], []
    for at in offsets.tolist():
        size, crc = struct.unpack_from("<QI", data, at)
        if at + 16 + size > len(data):
            raise ValueError(f"record at {at} is cut off")
        heads.append(bytes(data[at : at + 8]))
        sums.append(crc)
        out.append(data[at + 12 : at + 12 + size])
        tails.append(struct.unpack_from("<I", data, at + 12 + size)[0])
    if (masked(heads) != np.array(sums, dtype=np.uint32)).any() or (masked(out) != np.array(tails, dtype=np.uint32)).any():
        raise ValueError("a record does not match its checksum")
    return out


class _File:
    """A record file and its index, written under other names until they are complete."""

    def __init__(self, folder: str, name: str):
        self.store, root = fs.FileSystem.from_uri(folder)
        self.store.create_dir(root, recursive=True)
        self.name, self.base, self.own = name, f"{root}/{name}", f"{root}/.{name}-{uuid.uuid4().hex}"
        self.out = self.store.open_output_stream(f"{self.own}.rec")
        self.size, self.tokens, self.offsets = 0, 0, []

    def add(self, records: list[bytes], tokens: int) -> None:
        for r in records:
            self.offsets.append(self.size)
            self.size += len(r)
        self.out.write(b"".join(records))
        self.tokens += tokens

    def close(self) -> tuple:
        self.out.close()
        with self.store.open_output_stream(f"{self.own}.idx") as index:
            index.write(np.array(self.offsets, dtype="<u8").tobytes())
        for kind in ("idx", "rec"):
            self.store.move(f"{self.own}.{kind}", f"{self.base}.{kind}")
        return self.name, len(self.offsets), self.tokens, self.size


MANIFEST = "name string, n_records long, n_tokens long, n_bytes long"


def _write(path: str, folder: str, end_id: int, file_bytes: int):
    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, done, file = TaskContext.get().partitionId(), [], None
        with encoder(path) as encode:
            end = np.array([end_id], dtype=encode.kind).tobytes()
            width = encode.kind.itemsize
            for batch in batches:
                for at in range(0, batch.num_rows, 1024):
                    rows = batch.slice(at, 1024)
                    raw = encode.encode(rows.column(1).cast(pa.binary()).to_pylist())
                    heads = [struct.pack(HEAD, i is not None, width, i or 0) for i in rows.column(0).to_pylist()]
                    file = file or _File(folder, f"{part:08d}-{len(done):06d}")
                    file.add(frame([h + r + end for h, r in zip(heads, raw, strict=True)]), sum(map(len, raw)) // width + len(raw))
                    if file.size >= file_bytes:
                        done.append(file.close())
                        file = None
            if file:
                done.append(file.close())
        if done:
            kinds = [pa.string(), pa.int64(), pa.int64(), pa.int64()]
            names = ["name", "n_records", "n_tokens", "n_bytes"]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*done, strict=True), kinds, strict=True)], names)

    return each


def write_records(docs: DataFrame, path: str, folder: str, end_id: int = END_ID, file_bytes: int = FILE_BYTES) -> DataFrame:
    """Write all rows of ``docs`` (doc_id, text; other columns are ignored) below ``folder``; returns the list of files.

    ``folder`` must be seen by all executors. Files in order of their names
    hold the documents in ascending order of doc_id, a null one first, rows of
    equal doc_id in an order that depends on their text. A null text counts as empty: the end
    id alone. Rows of an empty table make no file. The list has name, n_records, n_tokens, n_bytes.
    """
    rows = docs.select("doc_id", text_or_empty().alias("text"), F.xxhash64(text_or_empty()).alias("tie"))
    order = rows.repartitionByRange(partitions(docs.sparkSession), "doc_id", "tie").sortWithinPartitions("doc_id", "tie")
    return stored(order.select("doc_id", "text").mapInArrow(_write(path, folder, end_id, file_bytes), MANIFEST), "manifest")


def _read(folder: str):
    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                store, root = fs.FileSystem.from_uri(folder)
                with store.open_input_file(f"{root}/{row['name']}.idx") as f:
                    offsets = np.frombuffer(f.read(), dtype="<u8")
                if len(offsets) != row["n_records"]:
                    raise ValueError(f"{row['name']} has another number of records than its list")
                start = row["before"]
                with store.open_input_file(f"{root}/{row['name']}.rec") as f:
                    ends = np.r_[offsets[1:], row["n_bytes"]].astype(np.int64)
                    for at in range(0, len(offsets), 256):
                        lo, hi = int(offsets[at]), int(ends[min(at + 256, len(ends)) - 1])
                        part = memoryview(f.read_at(hi - lo, lo))
                        found = []
                        for payload in unframe(part, offsets[at : at + 256].astype(np.int64) - lo):
                            known, width, doc_id = struct.unpack_from(HEAD, payload)
                            ids = wide(payload[HEAD_BYTES:], np.dtype(f"<u{width}"))
                            found.append((doc_id if known else None, start, len(ids), ids.tobytes()))
                            start += len(ids)
                        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.binary()]
                        names = ["doc_id", "start", "n_tokens", "ids"]
                        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*found, strict=True), kinds, strict=True)], names)

    return each


def read_records(spark: SparkSession, manifest: DataFrame, folder: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids) of every record; ``start`` counts the ids of all records before it.

    ``ids`` are little-endian unsigned 32-bit numbers. Lengths and checksums are verified.
    """
    # One row per file: the running total is small whatever the files hold.
    before = F.sum("n_tokens").over(W.orderBy("name").rowsBetween(W.unboundedPreceding, -1))
    placed = manifest.withColumn("before", F.coalesce(before, F.lit(0).cast("long")))
    return placed.repartition(partitions(spark), "name").mapInArrow(_read(folder), "doc_id long, start long, n_tokens long, ids binary")
