"""Near-duplicate documents by SimHash, candidates by pigeonring chains.

A fingerprint is cut into four segments in a ring. If two fingerprints differ
in at most ``bits`` places, some segment starts a chain of which every prefix
keeps within its share of the bits: for 3 bits and four segments the first
segment is equal, the first two differ in at most 1 place, the first three in
at most 2. So the two agree on that segment and on one half of the next:
candidates meet on 24 equal bits, the chain is tested, then the whole distance.
Only distinct fingerprints are compared, so copies cost one row. A meeting
place that holds very many fingerprints is cut into blocks, pairs of blocks are
compared in different tasks, and each returns a spanning forest, not its pairs.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeloom.llm.common import partitions, stored, text_or_empty
from gaugeloom.llm.components import components

#: Fixed values of the contract: seed of the shingle hash, words in a shingle, bits that may differ.
SEED = 42
SHINGLE = 3
BITS = 3
SEGMENTS = 4
WIDTH = 64 // SEGMENTS
#: Fingerprints of one meeting place that a task compares with each other.
BLOCK = 4096


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """The 64-bit fingerprint of one text; 0 if it has no word."""
    words = text.lower().split()
    if not words:
        return 0
    if len(words) <= shingle:
        grams = [b" ".join(words)]
    else:
        grams = map(b" ".join, zip(*(words[k:] for k in range(shingle)), strict=False))
    values = np.fromiter(map(xxhash.xxh64_intdigest, grams, repeat(SEED)), dtype=np.uint64)
    ones = np.zeros(64, dtype=np.int64)
    for at in range(0, len(values), 8192):
        part = values[at : at + 8192].astype("<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(values), bitorder="little").tobytes(), "little")


def fingerprints(docs: DataFrame, shingle: int = SHINGLE, carried: Sequence[str] = ()) -> DataFrame:
    """(doc_id, fp, and the ``carried`` columns) of every row; a null text counts as an empty one."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [fingerprint(t, shingle) for t in batch.column(1).cast(pa.binary()).to_pylist()]
            signed = np.array(found, dtype=np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(signed, pa.int64()), *batch.columns[2:]], ["doc_id", "fp", *carried])

    kinds = dict(docs.dtypes)
    schema = ", ".join(["doc_id long", "fp long", *[f"{c} {kinds[c]}" for c in carried]])
    return docs.select("doc_id", text_or_empty().alias("text"), *carried).mapInArrow(each, schema)


def _segment(fp, i: int, n: int = 1) -> np.ndarray:
    """``n`` segments from the i-th on, around the ring, as the low bits of a number."""
    turn = np.uint64(i * WIDTH)
    ring = fp if i == 0 else (fp >> turn) | (fp << np.uint64(64 - i * WIDTH))
    return ring & np.uint64((1 << (n * WIDTH)) - 1)


def _keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each fingerprint its eight meeting places: a segment and one half of the next."""
    half = WIDTH // 2
    low = np.uint64((1 << half) - 1)
    for batch in batches:
        fp = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
        keys = []
        for i in range(SEGMENTS):
            first, second = _segment(fp, i), _segment(fp, (i + 1) % SEGMENTS)
            for side in (0, 1):
                part = second & low if side == 0 else second >> np.uint64(half)
                keys.append((first << np.uint64(half) | part) | np.uint64((2 * i + side) << 32))
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate(keys).view(np.int64)), pa.array(np.tile(fp, len(keys)).view(np.int64))], ["key", "fp"]
        )


def _near(x: np.ndarray, y: np.ndarray, i: int, bits: int) -> np.ndarray:
    """Pairs whose chain from segment i keeps within budget, up to the whole ring."""
    diff = x[:, None] ^ y[None, :]
    good = np.bitwise_count(_segment(diff, i, 2)) * SEGMENTS <= 2 * bits
    good &= np.bitwise_count(_segment(diff, i, 3)) * SEGMENTS <= 3 * bits
    return good & (np.bitwise_count(diff) <= bits)


def _find(parent: np.ndarray, i: int) -> int:
    while parent[i] != i:
        parent[i] = parent[parent[i]]
        i = parent[i]
    return i


def _forest(fps: np.ndarray, sides: np.ndarray, i: int, bits: int) -> list[tuple[int, int]]:
    """Links that connect what the pairs within the bound connect; ``sides`` tells the two blocks apart.

    A row of links already joined is skipped, so a cloud of near copies costs a few passes.
    """
    n = len(fps)
    parent, links = np.arange(n), []
    left = np.flatnonzero(sides == 0)
    right = np.flatnonzero(sides == 1) if (sides == 1).any() else left
    root = np.arange(n)
    for at in left:
        other = right[root[right] != root[at]]
        if right is left:
            other = other[other > at]
        if not len(other):
            continue
        hits = other[_near(fps[at : at + 1], fps[other], i, bits)[0]]
        for hit in hits:
            a, b = _find(parent, int(at)), _find(parent, int(hit))
            if a != b:
                parent[max(a, b)] = min(a, b)
                links.append((int(at), int(hit)))
        if len(hits):
            root = _roots(parent)
    return links


def _roots(parent: np.ndarray) -> np.ndarray:
    root = parent.copy()
    while True:
        up = root[root]
        if (up == root).all():
            return root
        root = up


def _links(bits: int):
    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The rows of a partition arrive sorted by meeting place."""
        rest = None
        for batch in _ended(batches):
            parts = [rest] if rest is not None else []
            parts += [pa.Table.from_batches([batch])] if batch is not None else []
            if not parts or not sum(p.num_rows for p in parts):
                continue
            rest = pa.concat_tables(parts)
            place = np.stack([rest.column(c).to_numpy() for c in ("key", "one", "two")])
            cuts = np.flatnonzero((place[:, 1:] != place[:, :-1]).any(axis=0)) + 1
            if batch is None:
                upto = rest.num_rows
            elif len(cuts):
                upto = int(cuts[-1])
            else:
                continue
            yield _compare(rest.slice(0, upto), cuts[cuts < upto], bits)
            rest = rest.slice(upto)

    return each


def _ended(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch | None]:
    yield from batches
    yield None


def _compare(rows: pa.Table, cuts: np.ndarray, bits: int) -> pa.RecordBatch:
    fps = rows.column("fp").to_numpy().view(np.uint64)
    keys, sides = rows.column("key").to_numpy(), rows.column("side").to_numpy()
    edges = np.concatenate([[0], cuts, [len(fps)]])
    a, b = [], []
    for k in np.flatnonzero(np.diff(edges) > 1):
        lo, hi = int(edges[k]), int(edges[k + 1])
        for x, y in _forest(fps[lo:hi], sides[lo:hi], int(keys[lo] >> 33), bits):
            a.append(fps[lo + x])
            b.append(fps[lo + y])
    return pa.RecordBatch.from_arrays(
        [pa.array(np.array(v, dtype=np.uint64).view(np.int64), pa.int64()) for v in (a, b)], ["a", "b"]
    )


def links(distinct: DataFrame, bits: int = BITS, block: int = BLOCK) -> DataFrame:
    """(a, b) links between distinct fingerprints that connect all that lie within ``bits``."""
    if not 0 <= bits < SEGMENTS:
        raise ValueError(f"four segments serve 0 to {SEGMENTS - 1} bits")
    keyed = distinct.select("fp").mapInArrow(_keys, "key long, fp long")
    counts = keyed.groupBy("key").count()
    crowded = counts.where(F.col("count") > block).select("key", F.ceil(F.col("count") / (block // 2)).cast("long").alias("blocks"))
    shared = counts.where((F.col("count") > 1) & (F.col("count") <= block)).select("key", F.lit(1).cast("long").alias("blocks"))
    placed = keyed.join(shared.union(crowded), "key").withColumn("own", F.pmod(F.xxhash64("fp"), F.col("blocks")))
    # Block `own` meets every other block once: the pair is named by its smaller and larger number.
    met = placed.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    met = met.select(
        "key", "fp", F.least("own", "other").alias("one"), F.greatest("own", "other").alias("two"),
        (F.col("own") > F.col("other")).cast("int").alias("side"),
    )
    dealt = met.repartition(partitions(distinct.sparkSession), "key", "one", "two").sortWithinPartitions("key", "one", "two", "fp")
    return dealt.mapInArrow(_links(bits), "a long, b long")


def grouped(docs: DataFrame, shingle: int = SHINGLE, bits: int = BITS, carried: Sequence[str] = ()) -> DataFrame:
    """(doc_id, fp, root, component_id, and the ``carried`` columns) of every row; ``root`` names a component whatever its numbers."""
    marked = stored(fingerprints(docs, shingle, carried), "fingerprints")
    least = marked.groupBy("fp").agg(F.min("doc_id").alias("least"))
    tree = components(links(least, bits)).withColumnRenamed("node", "fp")
    rooted = stored(least.join(tree, "fp", "left").withColumn("root", F.coalesce("root", "fp")), "roots")
    named = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    of = rooted.join(named, "root").select("fp", "root", "component_id")
    return marked.join(of, "fp").select("doc_id", "fp", "root", "component_id", *carried)


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, bits: int = BITS) -> DataFrame:
    """(doc_id, fingerprint, component_id) of every row of ``docs`` (doc_id, text; other columns are ignored).

    ``component_id`` is the smallest doc_id that can be reached over links of
    at most ``bits`` differing bits. Null and empty texts have the fingerprint
    zero and are linked like any other. A row with a null doc_id is fingerprinted
    and links, but cannot name a component (it is null if no row can). Repeated
    rows come out as often as they came in. An empty table gives an empty result.
    """
    return grouped(docs, shingle, bits).select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
