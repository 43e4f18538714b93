"""Bit filters: a set of keys in a fixed number of bits, tested without a join.

A filter says yes for every key it was made from and for few others, as long as it
is sparse; a full one says yes to all, which costs work and no result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

#: Bits of one of Spark's bitmaps.
_BITMAP = 1 << 15
#: Bits per key wanted (one in 64 other keys passes), and the least and most bits of a filter (4 KiB to 4 MiB).
PER_KEY, BITS = 64, (_BITMAP, 1 << 25)


def bits_for(n: int) -> int:
    """Bits of a filter of ``n`` keys, a power of two."""
    return min(max(1 << (PER_KEY * max(n, 1) - 1).bit_length(), BITS[0]), BITS[1])


def _bit(key: Column, n: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(n))


def bit_filter(keys: DataFrame, key: str, n: int) -> bytes:
    """The filter of a key column, ``n`` bits: bitmaps of 4 KiB built on the executors, ``n`` / 32768 of them at most."""
    at = _bit(F.col(key), n) + 1  # Spark's buckets of positive numbers begin at 1
    maps = (keys.where(F.col(key).isNotNull()).select(at.alias("at"))
            .groupBy(F.bitmap_bucket_number("at").alias("number")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("at")).alias("map")))
    out = bytearray(n // 8)
    for number, bitmap in maps.collect():
        out[(number - 1) * _BITMAP // 8:number * _BITMAP // 8] = bitmap
    return bytes(out)


def may_hold(bits: bytes, key: Column) -> Column:
    """Whether a filter may hold a key; NULL for a NULL key."""
    bit = _bit(key, 8 * len(bits))
    byte = F.ascii(F.decode(F.substring(F.lit(bits), (F.floor(bit / 8) + 1).cast("int"), F.lit(1)), "ISO-8859-1"))
    return F.when(key.isNotNull(), F.getbit(byte, (bit % 8).cast("int")) == 1)
