"""Joins that Spark would plan badly if written down directly.

No function here hints a broadcast: Spark broadcasts a side only where its
known or measured size is below ``spark.sql.autoBroadcastJoinThreshold``, and
adaptive execution splits hot keys of the shuffle joins.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_MEMBER = "__member"


def _half(key: str) -> Column:
    """A second key that follows from the first.

    Adaptive execution splits a hot key only where both inputs of a join come
    straight from a shuffle. A grouping or join on the pair leaves its result
    partitioned by the pair, so that a later join on the key alone has to
    shuffle it again. Used on small inputs, to keep the large one splittable.
    """
    return F.xxhash64(key) % 2


def _keys_once(df: DataFrame, key: str, name: str = "__key") -> DataFrame:
    """The key values of ``df``, each once; copies shrink before the shuffle."""
    return df.select(F.col(key).alias(name), _half(key).alias("__half")).distinct().select(name)


def lookup(left: DataFrame, right: DataFrame, left_key: str, right_key: str) -> DataFrame:
    """Add the columns of ``right``, which has one row per key, to ``left``; null where it has none.

    Meant for building a dimension: the result is shuffled anew when it is
    joined with a fact table by the same key, so hot facts can be split there.
    """
    keyed = right.withColumn("__half", _half(right_key))
    condition = (F.col(left_key) == F.col(right_key)) & (_half(left_key) == F.col("__half"))
    return left.join(keyed, condition, "left").drop("__half", right_key)


def without_match(left: DataFrame, right: DataFrame, left_key: str, right_key: str) -> DataFrame:
    """The rows of ``left`` whose key, if any, does not occur in ``right``."""
    keys = _keys_once(right, right_key)
    return left.join(keys, F.col(left_key) == F.col("__key"), "left_anti")


def spread_join(
    left: DataFrame, right: DataFrame, left_key: str, right_key: str, how: str, unique_right: bool = False
) -> DataFrame:
    """Outer join (``left``, ``right`` or ``full``) that stays balanced whichever side has a hot key.

    ``unique_right`` states that ``right`` has one row per key. Then only
    ``left`` can have a hot key, a left outer join can be split there, and the
    full join takes one anti join beside it.

    Adaptive execution may split only the preserved side of an outer join and
    neither side of a full one, so a hot key would end in one task. An inner
    join can be split on both sides; the rows without a match come from anti
    joins against the keys alone. The column names of the two sides must
    differ.
    """
    if how not in ("left", "right", "full"):
        raise ValueError("how must be left, right or full")
    outer = unique_right and how in ("left", "full")
    parts = [left.join(right, F.col(left_key) == F.col(right_key), "left" if outer else "inner")]
    if how in ("left", "full") and not outer:
        lone = without_match(left, right, left_key, right_key)
        parts.append(lone.select("*", *_nulls_for(right)))
    if how in ("right", "full"):
        lone = without_match(right, left, right_key, left_key)
        parts.append(lone.select(*_nulls_for(left), "*"))
    return reduce(DataFrame.union, parts)


def _nulls_for(df: DataFrame) -> list[Column]:
    return [F.lit(None).cast(field.dataType).alias(field.name) for field in df.schema]


def membership_join(left: DataFrame, right: DataFrame, array_column: str, right_key: str) -> DataFrame:
    """Inner join on ``array_contains(left.array_column, right.right_key)``.

    One row per element makes it a hash or merge join on equality, where the
    condition as such would compare every pair. An element repeated within an
    array counts once. The column names of the two sides must differ.
    """
    members = left.withColumn(_MEMBER, F.explode(F.array_distinct(array_column)))
    return members.join(right, members[_MEMBER] == right[right_key], "inner").drop(_MEMBER)


def membership_full_join(
    left: DataFrame, right: DataFrame, array_column: str, left_key: str, right_key: str
) -> DataFrame:
    """Full outer form of :func:`membership_join`, as pairs of structs.

    Columns ``left`` and ``right`` hold the two rows; the missing side is null.
    ``left_key`` must identify the rows of ``left``.
    """
    lefts = left.select(F.struct("*").alias("left"))
    rights = right.select(F.struct("*").alias("right"))
    members = left.select(left_key, F.explode(F.array_distinct(array_column)).alias(_MEMBER))
    pairs = lefts.withColumn(_MEMBER, F.explode(F.array_distinct(f"left.{array_column}"))).join(
        rights, F.col(_MEMBER) == F.col(f"right.{right_key}"), "inner"
    )
    known = _keys_once(right, right_key)
    matched = members.join(known, F.col(_MEMBER) == F.col("__key"), "left_semi")
    lone_lefts = without_match(lefts, matched, f"left.{left_key}", left_key)
    lone_rights = without_match(rights, members, f"right.{right_key}", _MEMBER)
    return (
        pairs.select("left", "right")
        .unionByName(lone_lefts, allowMissingColumns=True)
        .unionByName(lone_rights, allowMissingColumns=True)
    )


def pair_join(
    left: DataFrame, right: DataFrame, left_key: str, right_key: str, how: str = "inner", unique_right: bool = False
) -> DataFrame:
    """Join on equal keys that keeps each side whole as a struct column.

    The structs are built before the join, so a side without a match is null
    and not a struct of nulls.
    """
    lefts = left.select(F.struct("*").alias("left"))
    rights = right.select(F.struct("*").alias("right"))
    keys = f"left.{left_key}", f"right.{right_key}"
    if how == "inner":
        return lefts.join(rights, F.col(keys[0]) == F.col(keys[1]))
    return spread_join(lefts, rights, *keys, how, unique_right)
