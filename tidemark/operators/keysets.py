"""Exact sets of whole-number keys as bits: one row for up to 64 neighbouring keys, small enough to be kept in a state.

Set operations work on words of 64 bits; only the result is spelt out as keys.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

WORD, BITS = "_word", "_bits"


def key_bits(df: DataFrame, key: str) -> DataFrame:
    """(_word, _bits) of the keys of a frame, combined before the shuffle; NULL is no key."""
    if not isinstance(df.schema[key].dataType, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        raise ValueError(f"{key} is no whole number: only those have bits")
    k = F.col(key).cast("bigint")
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), k.bitwiseAND(F.lit(63).cast("bigint")).cast("int"))
    return df.where(k.isNotNull()).groupBy(F.shiftright(k, 6).alias(WORD)).agg(F.bit_or(bit).alias(BITS))


def keys_of(bits: DataFrame, key: str, data_type: str = "bigint") -> DataFrame:
    """The keys of a set."""
    inside = F.filter(F.sequence(F.lit(0), F.lit(63)), lambda i: F.call_function("shiftrightunsigned", F.col(BITS), i).bitwiseAND(F.lit(1).cast("bigint")) == 1)
    return bits.select(F.col(WORD), F.explode(inside).alias("_i")).select((F.col(WORD) * 64 + F.col("_i")).cast(data_type).alias(key))


def _combined(a: DataFrame, b: DataFrame, how: str, bits: Column) -> DataFrame:
    other = b.select(WORD, F.col(BITS).alias("_other"))
    return a.join(other, WORD, how).select(WORD, bits.alias(BITS)).where(F.col(BITS) != 0)


def without(a: DataFrame, b: DataFrame) -> DataFrame:
    """Keys of the first set that the second lacks."""
    return _combined(a, b, "left", F.col(BITS).bitwiseAND(F.bitwise_not(F.coalesce(F.col("_other"), F.lit(0).cast("bigint")))))


def common(a: DataFrame, b: DataFrame) -> DataFrame:
    return _combined(a, b, "inner", F.col(BITS).bitwiseAND(F.col("_other")))


def either(a: DataFrame, b: DataFrame) -> DataFrame:
    none = F.lit(0).cast("bigint")
    return _combined(a, b, "full_outer", F.coalesce(F.col(BITS), none).bitwiseOR(F.coalesce(F.col("_other"), none)))


def size(bits: DataFrame) -> DataFrame:
    return bits.agg(F.coalesce(F.sum(F.bit_count(BITS)), F.lit(0)).cast("bigint").alias("n"))
