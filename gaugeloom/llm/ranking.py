"""Ranked lexical search by the Best Position Algorithm.

Documents are dealt into shards. A shard keeps one impact list per term: its
documents by falling contribution of that term to a score. For an item, the lists of
its terms are read from the top. Each document met is looked up in all other lists at once, which gives
its whole score and marks its positions there as seen too. The best position
of a list is the last one up to which all are seen; an unseen document scores
at most the sum of the impacts at the best positions. Reading goes on behind the best positions
and stops as soon as the k-th score lies strictly above that sum, so that no equal score is missed.

Texts are read once, for the index of the terms that items ask for. Numbers of
documents, terms and postings come from that index; shards grow in number and
not in size. Each shard answers all items of a block and returns the k best of each.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from gaugeloom.llm.common import stored, text_or_empty

#: Bytes of distinct item terms up to which the index is limited to them while texts are read; beyond, it holds all terms.
VOCABULARY_BYTES = 8_000_000
#: Postings of a shard and terms of a block of items, about.
SHARD = 400_000
BLOCK = 2_000_000
#: Positions read from each list in a first round; rounds double them.
STEP = 32
#: Text that is split into terms at once.
SLICE_BYTES = 4_000_000

#: Letters A to Z in lower case, and a space for every other character of ASCII that is no letter or digit.
_FOLD = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256))


def slices(text: bytes, size: int = SLICE_BYTES) -> Iterator[bytes]:
    """The folded text in parts of about ``size`` bytes that cut no term."""
    at = 0
    while at < len(text):
        end = at + size
        while end < len(text) and _FOLD[text[end]] != 32:
            end += 1
        yield text[at:end].translate(_FOLD)
        at = end


def count_terms(text: bytes) -> Counter:
    counts: Counter = Counter()
    for part in slices(text):
        counts.update(part.split())
    return counts


TERMS = "id long, text_key long, n long, terms array<string>, tfs array<long>"


def _terms(only: frozenset[bytes] | None):
    """Rows (id, text_key, text) as (id, text_key, n, terms, tfs); ``n`` counts all terms, also those left out."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                rows = batch.slice(at, 1024)
                total, sizes, terms, tfs = [], [0], [], []
                for text in rows.column(2).cast(pa.binary()).to_pylist():
                    counts = count_terms(text)
                    total.append(counts.total())
                    kept = list(counts if only is None else counts.keys() & only)
                    terms.extend(kept)
                    tfs.extend(map(counts.__getitem__, kept))
                    sizes.append(len(terms))
                lists = [pa.ListArray.from_arrays(pa.array(sizes, pa.int32()), v) for v in (pa.array(terms, pa.binary()).cast(pa.string()), pa.array(tfs, pa.int64()))]
                yield pa.RecordBatch.from_arrays([rows.column(0), rows.column(1), pa.array(total, pa.int64()), *lists], ["id", "text_key", "n", "terms", "tfs"])

    return each


def _termed(df: DataFrame, row_id: str, only: frozenset[bytes] | None = None) -> DataFrame:
    rows = df.select(F.col(row_id).cast("long").alias("id"), F.xxhash64(text_or_empty()).alias("text_key"), text_or_empty().alias("text"))
    return rows.mapInArrow(_terms(only), TERMS)


def _asked_for(terms: DataFrame) -> frozenset[bytes] | None:
    """The distinct terms of all items, or None if they exceed their bound."""
    size = terms.agg(F.sum(F.octet_length("term"))).first()[0] or 0
    return frozenset(r[0].encode() for r in terms.collect()) if size <= VOCABULARY_BYTES else None


class Lists:
    """The impact lists of one shard, one behind the other, and the places of each document in them."""

    def __init__(self, term: np.ndarray, doc: np.ndarray, impact: np.ndarray, terms: int, docs: int):
        """``doc`` numbers documents in the order in which equal scores rank."""
        order = np.lexsort((doc, -impact, term))
        self.term, self.doc, self.impact = term[order], doc[order], impact[order]
        self.begin = np.searchsorted(self.term, np.arange(terms + 1))
        self.slot = np.argsort(self.doc, kind="stable")
        self.first = np.searchsorted(self.doc[self.slot], np.arange(docs + 1))
        # Stamps of the item that last saw a slot or a document, so that nothing has to be cleared between items.
        self.seen = np.zeros(len(order), dtype=np.int32)
        self.met = np.zeros(docs, dtype=np.int32)
        self.item = 0
        self.read = 0

    def best(self, terms: np.ndarray, k: int, step: int = STEP) -> tuple[np.ndarray, np.ndarray]:
        """Documents and scores of the ``k`` best for the terms."""
        self.item += 1
        begin, end = self.begin[terms], self.begin[terms + 1]
        begin, end = begin[begin < end], end[begin < end]
        asked = np.zeros(len(self.begin), dtype=bool)
        asked[terms] = True
        front = begin.copy()  # the first slot of each list behind its best position
        docs, scores = [np.zeros(0, dtype=np.int64)], [np.zeros(0, dtype=np.int64)]
        top = np.zeros(0, dtype=np.int64)
        while (front < end).any():
            self.read += int((np.minimum(front + step, end) - front).sum())
            found = np.unique(np.concatenate([self.doc[a:b] for a, b in zip(front.tolist(), np.minimum(front + step, end).tolist(), strict=True)]))
            found = found[self.met[found] != self.item]
            self.met[found] = self.item
            if len(found):
                score = self._look_up(found, asked)
                docs.append(found)
                scores.append(score)
                top = np.concatenate([top, score])
                if len(top) > k:
                    top = np.partition(top, -k)[-k:]
            front = np.array([self._advance(a, b, step) for a, b in zip(front.tolist(), end.tolist(), strict=True)])
            # The impact at the best position bounds what an unseen document can have behind it.
            bound = int(self.impact[front[front < end] - 1].sum())
            if len(top) >= k and int(top.min()) > bound:
                break
            step *= 2
        docs, scores = np.concatenate(docs), np.concatenate(scores)
        if len(docs) > k:
            near = scores >= top.min()
            docs, scores = docs[near], scores[near]
        order = np.lexsort((docs, -scores))[:k]
        return docs[order], scores[order]

    def _look_up(self, docs: np.ndarray, asked: np.ndarray) -> np.ndarray:
        """Whole scores by direct access to every list; the positions found count as seen."""
        count = self.first[docs + 1] - self.first[docs]
        begin = np.cumsum(count) - count
        at = np.arange(int(count.sum())) + np.repeat(self.first[docs] - begin, count)
        slot = self.slot[at]
        own = asked[self.term[slot]]
        self.seen[slot[own]] = self.item
        return np.add.reduceat(np.where(own, self.impact[slot], 0), begin)

    def _advance(self, front: int, end: int, step: int) -> int:
        while front < end:
            part = self.seen[front : min(front + 2 * step, end)] != self.item
            first = int(part.argmax())
            if part[first]:
                return front + first
            front += len(part)
        return end


FOUND = "item_id long, item_key long, doc_id long, score long"


def _search(k: int):
    kind = pa.schema([(name, pa.int64()) for name in ("item_id", "item_key", "doc_id", "score")])

    def each(key: tuple[pa.Scalar, ...], left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return kind.empty_table()
        ids = left.column("id").combine_chunks()
        rank = np.empty(left.num_rows, dtype=np.int64)
        order = pc.array_sort_indices(ids, null_placement="at_end").to_numpy()
        rank[order] = np.arange(left.num_rows)
        m = left.column("m").to_numpy()
        asked, weight = right.column("terms").combine_chunks(), right.column("weights").combine_chunks().flatten().to_numpy()
        names = pc.unique(asked.flatten())
        number = pc.index_in(asked.flatten(), names).to_numpy(zero_copy_only=False).astype(np.int64)
        w = np.zeros(len(names), dtype=np.int64)
        w[number] = weight
        held = left.column("terms").combine_chunks()
        term = pc.index_in(held.flatten(), names).fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64)
        tf = left.column("tfs").combine_chunks().flatten().to_numpy()
        size = pc.list_value_length(held).to_numpy(zero_copy_only=False)
        doc = np.repeat(np.arange(left.num_rows), size)
        good = np.flatnonzero(term >= 0)
        term, tf, doc = term[good], tf[good], doc[good]
        impact = w[term] * ((1_000_000_000 * tf) // (1000 * tf + 20 * m[doc]))
        good = np.flatnonzero(impact > 0)
        lists = Lists(term[good], rank[doc[good]], impact[good], len(names), left.num_rows)
        cuts = np.concatenate([[0], np.cumsum(pc.list_value_length(asked).to_numpy(zero_copy_only=False))])
        out = []
        item_ids, item_keys = right.column("id").to_pylist(), right.column("text_key").to_pylist()
        for i, (item_id, item_key) in enumerate(zip(item_ids, item_keys, strict=True)):
            docs, scores = lists.best(number[cuts[i] : cuts[i + 1]], k)
            n = len(docs)
            out.append(pa.Table.from_arrays([pa.array([item_id] * n, pa.int64()), pa.array([item_key] * n, pa.int64()), ids.take(pa.array(order[docs])), pa.array(scores)], schema=kind))
        return pa.concat_tables(out)

    return each


def ranked(docs: DataFrame, items: DataFrame, k: int, shard: int = SHARD, block: int = BLOCK) -> DataFrame:
    """(item_id, rank, doc_id, score) of the ``k`` best rows of ``docs`` (doc_id, text) for each row of ``items`` (item_id, text).

    Other columns are ignored. Scores are whole numbers: for each term of the
    item a weight times a share that grows with the term's count in the document
    and falls with the document's length. Only scores above zero rank; equal ones go by the smaller doc_id, a null doc_id last.

    A null or empty text has no terms: such a document is not counted and such an
    item finds nothing. Documents that share a doc_id are ranked singly. Rows of
    ``items`` with the same item_id and text are one item; other texts under the same item_id, or under a null one,
    are items of their own with their own ranks. Empty tables give an empty result.
    """
    wanted = stored(_termed(items, "item_id").dropDuplicates(["id", "text_key"]).select("id", "text_key", F.explode("terms").alias("term")), "item_terms")
    index = stored(_termed(docs, "doc_id", _asked_for(wanted.select("term").distinct())), "index")
    counted = index.where("n > 0")
    documents, length, postings = counted.agg(F.count(F.lit(1)), F.sum("n"), F.sum(F.size("terms"))).first()
    df = counted.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    weight = F.floor(1000 * F.log((2.0 * documents + 2) / (2.0 * F.col("df") + 1))).cast("long")
    weighed = wanted.join(df, "term").withColumn("weight", weight)
    asked = weighed.groupBy("id", "text_key").agg(F.collect_list(F.struct("term", "weight")).alias("t"))
    asked = stored(asked.select("id", "text_key", F.col("t.term").alias("terms"), F.col("t.weight").alias("weights")), "items")
    sought = asked.agg(F.sum(F.size("terms"))).first()[0] or 0
    shards, blocks = max(1, -(-(postings or 0) // shard)), max(1, -(-sought // block))

    every = lambda c: F.explode(F.sequence(F.lit(0).cast("long"), F.lit(c - 1).cast("long")))
    # 50 * n * N may pass 64 bits where its quotient does not.
    m = F.expr(f"50 + ((cast(50 AS decimal(3,0)) * cast(n AS decimal(15,0)) * cast({documents} AS decimal(15,0))) div {length or 1}L)")
    left = counted.where(F.size("terms") > 0).select("id", m.cast("long").alias("m"), "terms", "tfs", F.pmod(F.xxhash64("id", "text_key"), F.lit(shards)).alias("s"), every(blocks).alias("b"))
    right = asked.select("id", "text_key", "terms", "weights", every(shards).alias("s"), F.pmod(F.xxhash64("id", "text_key"), F.lit(blocks)).alias("b"))
    found = left.groupBy("s", "b").cogroup(right.groupBy("s", "b")).applyInArrow(_search(k), FOUND)
    order = W.partitionBy("item_id", "item_key").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    best = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return best.select("item_id", "rank", "doc_id", "score")
