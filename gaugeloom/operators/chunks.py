"""Windows over long series without putting a whole series into one task.

A station may own a large share of all rows, so a window partitioned by the
station alone can end up as one enormous task. Here every series is cut into
stretches ("chunks") by a function of its order column. Windows run inside a
chunk, and what has to cross a chunk border travels through a small table
with one row per series and chunk.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def with_neighbours(
    df: DataFrame,
    keys: Sequence[str],
    chunk: str,
    order: Sequence[str],
    payload: Sequence[str],
    previous: str | None = "previous",
    following: str | None = None,
) -> DataFrame:
    """Attach the payload of the preceding and/or following row of the series.

    ``chunk`` must not decrease along ``order``, and ``order`` must be unique
    within a series. ``previous`` / ``following`` name the struct columns to add.
    """
    keys = list(keys)
    body = F.struct(*payload)
    inside = Window.partitionBy(*keys, chunk).orderBy(*order)
    across = Window.partitionBy(*keys).orderBy(chunk)
    rank = F.col(order[0]) if len(order) == 1 else F.struct(*order)

    edges, carried = [], []
    out = df
    if previous:
        out = out.withColumn(previous, F.lag(body).over(inside))
        edges += [F.max_by(c, rank).alias(f"_tail_{c}") for c in payload]
        tail = F.struct(*[F.col(f"_tail_{c}").alias(c) for c in payload])
        carried.append(F.lag(tail).over(across).alias("_carry_prev"))
    if following:
        out = out.withColumn(following, F.lead(body).over(inside))
        edges += [F.min_by(c, rank).alias(f"_head_{c}") for c in payload]
        head = F.struct(*[F.col(f"_head_{c}").alias(c) for c in payload])
        carried.append(F.lead(head).over(across).alias("_carry_next"))

    borders = df.groupBy(*keys, chunk).agg(*edges).select(*keys, chunk, *carried)
    out = out.join(borders, [*keys, chunk], "left")
    if previous:
        out = out.withColumn(previous, F.coalesce(previous, "_carry_prev"))
    if following:
        out = out.withColumn(following, F.coalesce(following, "_carry_next"))
    return out.drop("_carry_prev", "_carry_next")


def value_chunk(value: Column, per_octave: int = 4096) -> Column:
    """A bucket number that never decreases with ``value`` and needs no statistics.

    Buckets are logarithmic, so the same rule splits small and large magnitudes
    alike, and the bucket of a value never depends on the other rows.
    """
    size = F.abs(value)
    scaled = F.floor(F.log2(size) * F.lit(float(per_octave))).cast("bigint") + F.lit(1200 * per_octave)
    bucket = (
        F.when(value == 0, F.lit(0).cast("bigint"))
        .when(size == float("inf"), F.signum(value).cast("bigint") * F.lit(4000 * per_octave))
        .otherwise(F.signum(value).cast("bigint") * scaled)
    )
    return F.coalesce(bucket, F.lit(0).cast("bigint"))


def value_counts(df: DataFrame, keys: Sequence[str], value: str = "value") -> DataFrame:
    """Distinct values per group with their number of rows and their bucket.

    Rows without a key or value are left out here, so that joins on these
    columns add no filters of their own and all uses share one shuffle.
    """
    return (
        df.filter(reduce(Column.__and__, [F.col(c).isNotNull() for c in (*keys, value)]))
        .groupBy(*keys, value)
        .agg(F.count(F.lit(1)).alias("cnt"))
        .withColumn("bucket", value_chunk(F.col(value)))
    )


def split_large(counts: DataFrame, keys: Sequence[str], most: int, value: str = "value") -> DataFrame:
    """Value counts dealt by group and bucket, where a group of at most ``most`` rows is one bucket.

    Only larger groups keep the buckets of their values. They are listed by all keys but the
    last one; the lists hold at most as many groups as rows divided by ``most``, so they may be
    broadcast. What groups, joins or sorts by group and bucket afterwards needs no other shuffle of the counts.
    """
    *outer, inner = keys
    sizes = counts.groupBy(*keys).agg(F.sum("cnt").alias("_rows"))
    lists = sizes.groupBy(*outer).agg(F.collect_list(F.when(F.col("_rows") > most, F.col(inner))).alias("_large"))
    bucket = F.when(F.array_contains("_large", F.col(inner)), F.col("bucket")).otherwise(F.lit(0).cast("bigint"))
    marked = counts.join(F.broadcast(lists), outer)
    return marked.select(*keys, value, "cnt", bucket.alias("bucket")).repartition(*keys, "bucket")


def bucket_offsets(counts: DataFrame, keys: Sequence[str], value: str | None = None) -> DataFrame:
    """Per group and bucket the rows below the bucket, in it and in the whole group.

    With ``value`` also the group's ``mean``, kept within its lowest and highest value, so that equal values have none other.
    """
    group = Window.partitionBy(*keys)
    below = group.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    sums = [F.sum("cnt").alias("in_bucket")]
    if value:
        sums += [F.sum(F.col("cnt") * F.col(value)).alias("_total"), F.min(value).alias("_lo"), F.max(value).alias("_hi")]
    offsets = (
        counts.groupBy(*keys, "bucket")
        .agg(*sums)
        .withColumn("offset", F.coalesce(F.sum("in_bucket").over(below), F.lit(0).cast("bigint")))
        .withColumn("n", F.sum("in_bucket").over(group))
    )
    if not value:
        return offsets
    mean = F.sum("_total").over(group) / F.col("n")
    mean = F.greatest(F.least(mean, F.max("_hi").over(group)), F.min("_lo").over(group))
    return offsets.withColumn("mean", mean).drop("_total", "_lo", "_hi")


def cumulated(counts: DataFrame, offsets: DataFrame, keys: Sequence[str], value: str = "value") -> DataFrame:
    """Value counts with the running total ``cum`` of their group and the columns of their bucket.

    The total inside a bucket is taken before the join, which then finds the counts in its own order.
    """
    inside = Window.partitionBy(*keys, "bucket").orderBy(value).rowsBetween(Window.unboundedPreceding, 0)
    running = counts.withColumn("_inside", F.sum("cnt").over(inside))
    return running.join(offsets, [*keys, "bucket"]).withColumn("cum", F.col("offset") + F.col("_inside")).drop("_inside")


def ranked_values(df: DataFrame, keys: Sequence[str], value: str = "value") -> DataFrame:
    """Distinct values per group with their counts and cumulative counts.

    Returns ``keys, bucket, value, cnt, prev_cum, cum, n``. Equal values are
    counted before anything is sorted, and the running total is taken inside
    value buckets, so a group of any size is spread over many tasks.
    """
    keys = list(keys)
    counts = value_counts(df, keys, value)
    return (
        _cumulated(counts, bucket_offsets(counts, keys), keys, value)
        .withColumn("prev_cum", F.col("cum") - F.col("cnt"))
        .select(*keys, "bucket", value, "cnt", "prev_cum", "cum", "n")
    )


def _cumulated(counts: DataFrame, offsets: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    inside = Window.partitionBy(*keys, "bucket").orderBy(value).rowsBetween(Window.unboundedPreceding, 0)
    return counts.join(offsets, [*keys, "bucket"]).withColumn("cum", F.col("offset") + F.sum("cnt").over(inside))


def exact_medians(counts: DataFrame, offsets: DataFrame, keys: Sequence[str], value: str = "value") -> DataFrame:
    """Median of every group: the mean of its two middle values.

    Only the one or two buckets that hold the middle ranks are sorted.
    """
    keys = list(keys)
    lower = F.floor((F.col("n") + 1) / F.lit(2))
    upper = F.floor(F.col("n") / F.lit(2)) + 1
    holds = lambda rank: (F.col("offset") < rank) & (rank <= F.col("offset") + F.col("in_bucket"))
    middle = offsets.filter(holds(lower) | holds(upper))
    return (
        _cumulated(counts, middle, keys, value)
        .groupBy(*keys)
        .agg(
            F.min(F.when(F.col("cum") >= lower, F.col(value))).alias("_lo"),
            F.min(F.when(F.col("cum") >= upper, F.col(value))).alias("_hi"),
        )
        .select(*keys, ((F.col("_lo") + F.col("_hi")) / F.lit(2.0)).alias("median"))
    )
