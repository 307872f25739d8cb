"""Limits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SAMPLE_ROWS = 15_000_000


def sorted_down(df: DataFrame, *by: str) -> DataFrame:
    """All rows by descending ``by``, nulls last, then by the other columns.

    A total order makes the result repeatable, and it lets the sort spread a
    long run of equal values, such as all the words used once, over many tasks.
    """
    others = [F.asc(name) for name in df.columns if name not in by]
    return df.orderBy(*[F.desc_nulls_last(name) for name in by], *others)


def top_rows(df: DataFrame, n: int, *order_by: Column) -> DataFrame:
    """The first ``n`` rows in the given order, for a small ``n``.

    Each task keeps ``n`` rows. Add a key to the order to settle ties.
    """
    return df.orderBy(*order_by).limit(n)


def sample_distinct(df: DataFrame, n: int = SAMPLE_ROWS, bits: int = 16) -> DataFrame:
    """``n`` distinct rows, or all of them if there are fewer.

    ``distinct().limit(n)`` would pass all ``n`` rows through one task. Here
    the first ``bits`` bits of a hash put the distinct rows into buckets, which
    are even because no row repeats. The bucket sizes say which buckets are
    taken whole and which one only in part. All branches read the one shuffle
    that makes the rows distinct. The rows of the one bucket taken in part,
    about one in ``2 ** bits``, are ordered in one task: raise ``bits`` beyond
    some billions of rows.
    """
    if not 1 <= bits <= 20:
        raise ValueError("bits must be from 1 to 20")
    names = df.columns
    bucket = F.shiftrightunsigned(F.xxhash64(*names), 64 - bits)
    bucketed = df.distinct().withColumn("__bucket", bucket)
    upto = Window.orderBy("__bucket").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    # One short row per bucket, so at most 2 ** bits of them whatever the size
    # of df: safe to order in one task and to broadcast.
    sizes = (
        bucketed.groupBy("__bucket")
        .agg(F.count("*").alias("__size"))
        .withColumn("__room", F.lit(n) - F.sum("__size").over(upto) + F.col("__size"))
        .where("__room > 0")
    )
    wanted = bucketed.join(F.broadcast(sizes), "__bucket")
    whole = wanted.where("__size <= __room").select(*names)
    within = Window.partitionBy("__bucket").orderBy(*names)
    part = wanted.where("__size > __room").withColumn("__row", F.row_number().over(within)).where("__row <= __room")
    return whole.union(part.select(*names))
