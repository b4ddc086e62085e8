"""Bloom filters as plain expressions, to drop rows or tokens before anything is shuffled for them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def bloom_filter(frame: DataFrame, column: str, bits: int) -> Column:
    """A Bloom filter of a column as one value: an array of 64-bit words, ``bits`` bits in all, a power of two."""
    words = bits // 64
    marked = frame.select(F.explode(F.array(*bit_places(F.col(column), bits))).alias("at")).select(
        F.shiftright("at", 6).alias("word"), F.expr("shiftleft(1L, CAST(at & 63 AS INT))").alias("mask")
    )
    empty = frame.sparkSession.range(words).select(F.col("id").alias("word"), F.lit(0).cast("long").alias("mask"))
    filled = marked.unionByName(empty).groupBy("word").agg(F.bit_or("mask").alias("mask"))
    ordered = F.array_sort(F.collect_list(F.struct("word", "mask")))
    return filled.agg(F.transform(ordered, lambda w: w["mask"]).alias("words")).scalar()


def bit_places(value: Column, bits: int) -> list[Column]:
    """The two places of a value in a filter."""
    hashed = F.xxhash64(value)
    return [hashed.bitwiseAND(F.lit(bits - 1)), F.shiftrightunsigned(hashed, 32).bitwiseAND(F.lit(bits - 1))]


def may_hold(words: Column, value: Column, bits: int) -> Column:
    """Whether a filter of ``bloom_filter`` may hold a value. The filter stays a constant of the expression."""
    def held(at: Column) -> Column:
        word, bit = F.get(words, F.shiftright(at, 6).cast("int")), at.bitwiseAND(F.lit(63)).cast("int")
        return F.call_function("shiftrightunsigned", word, bit).bitwiseAND(F.lit(1)) == 1

    first, second = bit_places(value, bits)
    return held(first) & held(second)
