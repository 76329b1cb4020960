"""Joins whose null keys equal null keys, and look-ups of few keys in a large table behind a bitmap of fixed size."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bits of the bitmap: 1 MB, whatever the number of keys. With many more keys than bits it lets most rows pass, no fewer.
BITS = 1 << 23
#: Bits of one row that bitmap_construct_agg makes.
_ROW = 32768


def null_safe(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "left") -> DataFrame:
    """`left` joined with `right` on columns of the same names, a null key being equal to a null key."""
    other = right.select(*(F.col(k).alias(f"__right_{k}") for k in keys), *(c for c in right.columns if c not in keys))
    on = reduce(lambda a, b: a & b, (left[k].eqNullSafe(other[f"__right_{k}"]) for k in keys))
    return left.join(other, on, how).drop(*(f"__right_{k}" for k in keys))


def _place(key: Column) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(BITS))


def _has_bit(bitmap: Column, place: Column) -> Column:
    byte = F.conv(F.hex(F.substring(bitmap, (place % _ROW / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    return (byte.bitwiseAND(F.element_at(F.array(*(F.lit(1 << i) for i in range(8))), (place % 8 + 1).cast("int")))) != 0


def may_hold(large: DataFrame, column: str, keys: DataFrame, key: str) -> DataFrame:
    """The rows of `large` whose column may be among `keys`: all that are, and few others.

    Only a bitmap of the keys' hashes is broadcast, of at most BITS bits, so neither side's size matters; `large` isn't shuffled."""
    places = keys.where(F.col(key).isNotNull()).select(_place(F.col(key)).alias("p"))
    rows = places.groupBy((F.col("p") / _ROW).cast("long").alias("__row")).agg(F.bitmap_construct_agg(F.col("p") % _ROW).alias("__bits"))
    placed = large.withColumn("__place", _place(F.col(column))).withColumn("__row", (F.col("__place") / _ROW).cast("long"))
    return placed.join(F.broadcast(rows), "__row").where(_has_bit(F.col("__bits"), F.col("__place"))).drop("__row", "__place", "__bits")


def lacking(references: DataFrame, column: str, known: DataFrame, key: str) -> DataFrame:
    """The rows of `references` whose column isn't among `known`, a table that may be far larger; null isn't."""
    wanted = references.select(F.col(column).alias("__wanted")).distinct()
    found = may_hold(known.select(F.col(key).alias("__wanted")), "__wanted", wanted, "__wanted").distinct()
    return references.join(found, references[column] == found["__wanted"], "left_anti")
