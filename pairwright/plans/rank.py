"""Global ranks and running totals without a single-task window.

Rows are put into ordered buckets; bucket totals are a small table whose
running sums are the offsets, and each bucket is ranked on its own.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pairwright.plans.storage import materialize

# Hex digits of an MD5 used as a bucket: at most 65,536 buckets.
BUCKET_DIGITS = 4
# Rows of a range that one task orders.
ROWS_PER_RANGE = 200_000


def md5_order(seed: object, *ids: Column) -> Column:
    """Uniform pseudo-random order key of a row: MD5 of seed and ids."""
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *[i.cast("string") for i in ids]))


def running_totals(df: DataFrame, bucket: Column, order: Sequence[Column],
                   totals: dict[str, Column]) -> DataFrame:
    """Add, for each ``name: value``, the sum of ``value`` over all rows up to
    and including this one in the order (bucket, *order).

    The table of bucket sums has one row per bucket, that is at most 65,536 for
    hash buckets and one for each ROWS_PER_RANGE rows for ranges; the
    optimizer broadcasts it where its size allows.
    """
    names = list(totals)
    values = df.select("*", bucket.alias("_bucket"), *[v.alias("_v_" + n) for n, v in totals.items()])
    sums = values.groupBy("_bucket").agg(*[F.sum("_v_" + n).alias("_s_" + n) for n in names])
    before = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select("_bucket", *[
        F.coalesce(F.sum("_s_" + n).over(before), F.lit(0)).alias("_o_" + n) for n in names])
    inside = Window.partitionBy("_bucket").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return values.join(offsets, "_bucket").select(
        *df.columns,
        *[(F.col("_o_" + n) + F.sum("_v_" + n).over(inside)).alias(n) for n in names])


def exact_rank(df: DataFrame, order_key: Column, ties: Sequence[str], name: str = "rank") -> DataFrame:
    """1-based rank of every row in the order (order_key, *ties).

    ``order_key`` is a hexadecimal hash text, so its leading digits spread the
    rows evenly.
    """
    keyed = df.withColumn("_key", order_key)
    bucket = F.substring("_key", 1, BUCKET_DIGITS)
    ranked = running_totals(keyed, bucket, [F.col("_key"), *[F.col(t) for t in ties]],
                            {name: F.lit(1).cast("bigint")})
    return ranked.drop("_key")


def order_cuts(keys: DataFrame, positions: Sequence[int], key: str = "_key", tie: str = "_tie") -> list:
    """The (key, tie) at each 1-based position of the ascending order; None before the first and beyond the last.

    ``keys`` holds a hexadecimal hash text and a tie-breaker. Counts of
    buckets of the leading digits show in which bucket a position lies; only the rows of
    those buckets are ranked, and one row for each position comes back.
    """
    rows = keys.withColumn("_bucket", F.substring(key, 1, BUCKET_DIGITS))
    counts = rows.groupBy("_bucket").agg(F.count(F.lit(1)).alias("n"))
    upto = materialize(counts.withColumn("upto", F.sum("n").over(Window.orderBy("_bucket"))), "order-counts")  # at most 16 ** BUCKET_DIGITS rows
    wanted = [p for p in positions if p > 0]
    held = F.array(*map(F.lit, wanted)) if wanted else F.array().cast("array<int>")
    inside = F.filter(held, lambda p: (p <= F.col("upto")) & (p > F.col("upto") - F.col("n")))
    buckets = upto.withColumn("_asked", inside).filter(F.size("_asked") > 0).select("_bucket", "_asked", (F.col("upto") - F.col("n")).alias("_before"))
    place = F.row_number().over(Window.partitionBy("_bucket").orderBy(key, tie)) + F.col("_before")
    found = rows.join(F.broadcast(buckets), "_bucket").withColumn("_place", place).filter(F.array_contains("_asked", F.col("_place").cast("int")))  # a bucket for each position
    at = {r["_place"]: (r[key], r[tie]) for r in found.select("_place", key, tie).collect()}
    return [at.get(p) for p in positions]


def in_range_buckets(df: DataFrame, *order: str) -> DataFrame:
    """Write ``df`` in ranges of ``order``, and add ``_range``, the number of its range.

    The number of ranges follows the number of rows; a range is one task's
    part, and ranges ascend with the order. Equal keys share a range.
    """
    ranges = max(1, -(-df.count() // ROWS_PER_RANGE))
    dealt = df.repartitionByRange(ranges, *order).withColumn("_range", F.spark_partition_id())
    return materialize(dealt, "ranges")
