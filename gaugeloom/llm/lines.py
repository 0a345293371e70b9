"""Near-repeated lines by a deletion-neighbourhood join, in DataFrame functions only.

Lines are compared as sequences of words (runs of characters other than
space and control characters 9 to 13). Two lines are near if one edit of a
word (change, insert, delete) makes them equal and both have at least
``min_words`` words. Each line emits a hashed key for every deletion of one
word. Lines of equal length that agree after deleting the same word meet on
that key; a line meets another one, a word longer, that becomes equal to it by a deletion.

Two lines that are near share their first or their last half. So before any
variant is made, lines that share neither half with another line are set
aside, which loses no pair and leaves few lines to expand. All members of a meeting place are
compared with its earliest line only, so no place emits its pairs.

The hash of a line is the exclusive or of the hashes of (word, position), so
all its deletions follow from running totals over its words, in time
proportional to its length.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from gaugeloom.llm.common import stored, text_or_empty

MIN_WORDS = 8
_GAP = r"[\x20\x09-\x0D]+"
_SOLID = r"[^\x20\x09-\x0D]"
_ADDED = ("text_key", "n_lines", "n_removed", "n_left")
_LINE = ["doc_id", "text_key", "line_no"]


def _words(line: Column) -> Column:
    return F.array_remove(F.split(line, _GAP), "")


def _half(side: str, n: Column, size: Column) -> Column:
    start = F.lit(1) if side == "first" else n - size + 1
    return F.xxhash64(F.lit(side), size, F.slice("words", start, size))


def _occurrences(rows: DataFrame, min_words: int) -> DataFrame:
    """One row per line that has a word: where it stands, two hashes of its words, keys of its halves."""
    n, small, large = F.col("n"), F.floor((F.col("n") - 1) / 2).cast("int"), F.floor(F.col("n") / 2).cast("int")
    sides = {f"{side}_{k}": _half(side, n, size) for side in ("first", "last") for k, size in (("small", small), ("large", large))}
    counted = (
        rows.select("doc_id", "text_key", F.posexplode(F.split("text", "\n")).alias("line_no", "line"))
        .select(*_LINE, _words(F.col("line")).alias("words"))
        .withColumn("n", F.size("words"))
        .where("n > 0")
    )
    halved = counted.select(*_LINE, "n", F.xxhash64("words").alias("h1"), F.get("words", large).alias("middle"), *(c.alias(k) for k, c in sides.items()))
    # The second hash is that of both halves and the word between or behind them.
    second = F.xxhash64("n", "first_large", "middle", "last_large").alias("h2")
    return halved.select(*_LINE, "h1", second, "n", F.when(n >= min_words, F.array_distinct(F.array(*sides))).alias("halves"))


def _candidates(unique: DataFrame) -> DataFrame:
    """(h1, h2) of lines that share a half with another line."""
    halves = unique.select("h1", "h2", F.explode("halves").alias("half"))
    shared = halves.groupBy("half").count().where("count > 1").select("half")
    return halves.join(shared, "half").select("h1", "h2").distinct()


def _with_words(unique: DataFrame, rows: DataFrame) -> DataFrame:
    """The words of each candidate line, read where it stands first; a text is split once."""
    places = unique.groupBy("first.doc_id", "first.text_key").agg(F.collect_list(F.struct("h1", "h2", "first.line_no", "first")).alias("places"))
    lines = rows.join(places, ["doc_id", "text_key"]).select("places", F.split("text", "\n").alias("lines"))
    found = lines.select(F.explode(F.transform("places", lambda p: F.struct(p.h1.alias("h1"), p.h2.alias("h2"), p.first.alias("at"), F.get("lines", p.line_no).alias("line")))).alias("p"))
    once = found.select("p.h1", "p.h2", "p.at", "p.line").dropDuplicates(["h1", "h2"])  # a repeated row brings its lines again
    ranked = once.orderBy("at").withColumn("id", F.monotonically_increasing_id())
    return ranked.select("h1", "h2", "id", _words(F.col("line")).alias("words")).withColumn("n", F.size("words"))


def _variants(lines: DataFrame) -> DataFrame:
    """(id, n, j, variant) for each deletion of word j."""
    whole = W.partitionBy("id")
    so_far = whole.orderBy("j")
    each = lines.select("id", "n", F.posexplode("words").alias("j", "word"))
    kept = each.select("id", "n", "j", F.xxhash64("word", "j").alias("stay"), F.xxhash64("word", F.col("j") - 1).alias("move"))
    before = F.coalesce(F.bit_xor("stay").over(so_far.rowsBetween(W.unboundedPreceding, -1)), F.lit(0).cast("long"))
    behind = F.bit_xor("move").over(whole).bitwiseXOR(F.bit_xor("move").over(so_far.rowsBetween(W.unboundedPreceding, 0)))
    return kept.select("id", "n", "j", before.bitwiseXOR(behind).alias("variant"))


def _without(words: str, j: str) -> Column:
    return F.concat(F.slice(words, F.lit(1), F.col(j)), F.slice(words, F.col(j) + 2, F.greatest(F.size(words) - F.col(j) - 1, F.lit(0))))


def _whole_hash() -> Column:
    hashed = F.transform("words", lambda w, i: F.xxhash64(w, i))
    return F.aggregate(hashed, F.lit(0).cast("long"), lambda a, h: a.bitwiseXOR(h))


def _near(lines: DataFrame) -> DataFrame:
    """(h1, h2) of the lines that have an earlier line within one edit; ``lines`` is stored, its ids rise with the place."""
    variants = stored(_variants(lines), "variants")
    whole = lines.select("id", "n", _whole_hash().alias("variant"))
    place = ["n", "j", "variant"]
    first = variants.groupBy(place).agg(F.min("id").alias("other"), F.count(F.lit(1)).alias("c")).where("c > 1").drop("c")
    changed = variants.join(first, place).where("id > other").select("id", "other", "j", F.lit("both").alias("cut"))
    # A line one word longer that becomes equal to a whole one.
    shorter = variants.withColumn("n", F.col("n") - 1).join(whole.withColumnRenamed("id", "other"), ["n", "variant"])
    ends = F.when(F.col("id") > F.col("other"), F.struct("id", "other", "j", F.lit("id").alias("cut"))).otherwise(
        F.struct(F.col("other").alias("id"), F.col("id").alias("other"), "j", F.lit("other").alias("cut"))
    )
    pairs = changed.union(shorter.select(ends.alias("e")).select("e.*"))
    words = lines.select("id", "words")
    texts = pairs.join(words, "id").join(words.select(F.col("id").alias("other"), F.col("words").alias("others")), "other")
    own = F.when(F.col("cut") == "other", F.col("words")).otherwise(_without("words", "j"))
    others = F.when(F.col("cut") == "id", F.col("others")).otherwise(_without("others", "j"))
    return texts.where(own == others).select("id").distinct().join(lines.select("id", "h1", "h2"), "id").select("h1", "h2")


def dedupe_lines(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """``docs`` (doc_id, text; all columns are kept) without their repeated lines.

    Added are text_key (hash of the text that came in), n_lines, n_removed and n_left
    (lines left that have a word); columns of those names are replaced.

    Documents are in order of doc_id, then text_key. A line goes if an equal
    one stands earlier, or a near one; both are judged on the input. Lines
    without a word are never removed. Rows equal in doc_id and text are one
    document: each comes out, with the same lines left. A null text counts as empty: one
    line without a word. Rows with a null doc_id have no place in the order
    and come out whole. An empty table gives an empty result.
    """
    others = [c for c in docs.columns if c not in ("doc_id", "text", *_ADDED)]
    full = docs.select("doc_id", text_or_empty().alias("text"), F.struct(*others, F.lit(0).alias("_")).alias("rest")).withColumn("text_key", F.xxhash64("text"))
    rows = full.where("doc_id IS NOT NULL").select("doc_id", "text", "text_key")
    seen = stored(_occurrences(rows, min_words), "lines")
    unique = seen.groupBy("h1", "h2").agg(F.min(F.struct(*_LINE)).alias("first"), F.count(F.lit(1)).alias("c"), F.first("n").alias("n"), F.first("halves").alias("halves"))
    unique = stored(unique, "unique-lines")
    chosen = unique.where(F.col("n") >= min_words).join(_candidates(unique), ["h1", "h2"])
    lines = stored(_with_words(chosen, rows), "candidate-lines")
    near = _near(lines).withColumn("near", F.lit(True))
    marked = unique.join(near, ["h1", "h2"], "left").where("c > 1 OR near").select("h1", "h2", "first", F.coalesce("near", F.lit(False)).alias("near"))
    gone = seen.select(*_LINE, "h1", "h2").join(marked, ["h1", "h2"]).where(F.col("near") | (F.struct(*_LINE) != F.col("first")))
    lists = gone.groupBy("doc_id", "text_key").agg(F.collect_set("line_no").alias("gone"))
    cut = full.join(lists, ["doc_id", "text_key"], "left").select("doc_id", "text_key", "rest", *_rest())
    counted = cut.withColumn("n_left", F.size(F.filter(F.split("text", "\n"), lambda x: x.rlike(_SOLID))))
    kept = [F.col(c) if c in ("doc_id", "text") else F.col(f"rest.`{c}`") for c in docs.columns if c not in _ADDED]
    return counted.select(*kept, *_ADDED)


def _rest() -> list[Column]:
    lines, gone = F.split("text", "\n"), F.coalesce("gone", F.array().cast("array<int>"))
    left = F.transform(F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), gone), lambda i: F.get(lines, i))
    return [
        F.when(F.size(gone) == 0, F.col("text")).otherwise(F.array_join(left, "\n")).alias("text"),
        F.size(lines).alias("n_lines"),
        F.size(gone).alias("n_removed"),
    ]
