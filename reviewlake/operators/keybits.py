"""Bitmaps of key hashes: which rows may share a key with another table.

A join that touches few rows of a wide table need not shuffle the others.
The keys of the other side are put in one bitmap (a bit per hash, several
bits of room per key), which is broadcast in chunks of 4 KB: 32 MB at most,
whatever the number of keys.  A clear bit is certain; a set bit is not, so
the rows behind it still take the exact join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CHUNK_BITS = 1 << 15                   # of bitmap_construct_agg
MIN_BITS, MAX_BITS = 1 << 20, 1 << 28
BITS_PER_KEY = 64                      # one key in 64 is taken for another one's


def bits_for(keys: int) -> int:
    """Size of a bitmap for so many keys: a power of two, bounded."""
    return min(MAX_BITS, max(MIN_BITS, 1 << (keys * BITS_PER_KEY).bit_length()))


def _slot(key: str, bits: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(bits))


def _chunk(key: str, bits: int) -> Column:
    return F.shiftright(_slot(key, bits), 15)


def _position(key: str, bits: int) -> Column:
    return _slot(key, bits).bitwiseAND(F.lit(CHUNK_BITS - 1))


def key_bits(df: DataFrame, key: str, bits: int) -> DataFrame:
    """The bitmap of the keys of ``df``: ``_chunk``, ``_bits``.  The hashes are
    shuffled, not the bitmaps of every task."""
    at = df.where(F.col(key).isNotNull()).select(_chunk(key, bits).alias("_chunk"), _position(key, bits).alias("_at"))
    return at.repartition("_chunk").groupBy("_chunk").agg(F.bitmap_construct_agg("_at").alias("_bits"))


def with_may_hold(df: DataFrame, key: str, bitmap: DataFrame, bits: int, out: str) -> DataFrame:
    """``df`` with ``out``: false only if no key of the bitmap equals the row's."""
    b = F.broadcast(bitmap.select(F.col("_chunk").alias(f"{out}_chunk"), F.col("_bits").alias(f"{out}_bits")))
    at = _position(key, bits)
    byte = F.conv(F.hex(F.substring(F.col(f"{out}_bits"), (F.shiftright(at, 3) + 1).cast("int"), F.lit(1))), 16, 10).cast("long")
    hit = F.getbit(byte, at.bitwiseAND(F.lit(7)).cast("int")) == 1
    j = df.join(b, (_chunk(key, bits) == F.col(f"{out}_chunk")) & F.col(key).isNotNull(), "left")
    return j.withColumn(out, F.coalesce(hit, F.lit(False))).drop(f"{out}_chunk", f"{out}_bits")
