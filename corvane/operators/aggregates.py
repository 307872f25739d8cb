"""Aggregates with semantics of their own."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def correlation(a: str, b: str, nulls_as_zero: bool = False) -> Column:
    """Pearson correlation of two columns.

    Rows with a null are skipped, or count as zero, which is what
    ``DataFrame.stat.corr`` does.
    """
    if nulls_as_zero:
        return F.corr(F.coalesce(F.col(a), F.lit(0.0)), F.coalesce(F.col(b), F.lit(0.0)))
    return F.corr(a, b)


def row_with_least(df: DataFrame, order_by: list[str], group_by: list[str] | None = None) -> DataFrame:
    """The row with the smallest ``order_by`` values, nulls first, overall or per group.

    Ties go to the smaller remaining columns, so the choice is always the same.
    A plain aggregate: each task keeps one row per group, and no group is ever
    gathered as a whole.
    """
    others = [name for name in df.columns if name not in order_by]
    least = F.min(F.struct(*order_by, *others)).alias("__row")
    picked = df.groupBy(*(group_by or [])).agg(least)
    return picked.select(*[F.col(f"__row.{name}").alias(name) for name in df.columns])


def distinct_by(df: DataFrame, keys: list[str], order_by: list[str]) -> DataFrame:
    """One row per key, always the same one: the first by ``order_by``.

    ``dropDuplicates`` keeps whichever row comes first at run time, which can
    change when a lost task runs again.
    """
    return row_with_least(df, order_by, keys)


def whole_mean(column: Column) -> Column:
    """Mean of whole numbers by whole-number division, null counting as zero; null of no rows."""
    total = F.sum(F.coalesce(column, F.lit(0)))
    return F.call_function("div", total, F.nullif(F.count("*"), F.lit(0)))


SKETCH_BITS = 12  # 4,096 registers: a relative standard deviation of 1.6 %


def stored_sketches(df: DataFrame, column: str, *by: str, bits: int = SKETCH_BITS) -> DataFrame:
    """(by, sketch): one HyperLogLog sketch of the different values of ``column`` per group.

    Sketches have a fixed size and merge, so written down once they answer
    for any union of groups without reading a row again.
    """
    return df.groupBy(*by).agg(F.hll_sketch_agg(column, bits).alias("sketch"))


def merged_estimate(sketches: DataFrame, *by: str) -> DataFrame:
    """(by, estimate): about how many different values the merged sketches have seen; 0 for none."""
    merged = sketches.groupBy(*by).agg(F.hll_union_agg("sketch").alias("sketch"))
    return merged.select(*by, F.coalesce(F.hll_sketch_estimate("sketch"), F.lit(0)).alias("estimate"))
