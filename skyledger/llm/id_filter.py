"""Keeps rows whose key may be asked for, so that a join need not shuffle the others.

The filter is a set of bits of a fixed size at any number of keys. With very many keys it lets more
rows through by chance, never fewer than asked for; the join that follows decides. Keys are numbers,
taken as long on both sides, as a hash tells int from long.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# 8 MB; a key sets one bit.
FILTER_BITS = 1 << 26
# Bitmaps of 4 KB are cut into pieces, as a row tested copies the whole one that it meets.
PIECES, PIECE_BYTES = 64, 64


def _place(key: str) -> Column:
    return F.pmod(F.xxhash64(F.col(key).cast("long")), F.lit(FILTER_BITS))


def key_bits(keys: DataFrame, key: str) -> DataFrame:
    """The bits of all keys: at most ``FILTER_BITS`` / 512 rows of 64 bytes."""
    bits = keys.select(F.bitmap_bucket_number(_place(key)).alias("_map"), F.bitmap_bit_position(_place(key)).alias("_bit"))
    bits = bits.groupBy("_map").agg(F.bitmap_construct_agg("_bit").alias("_bits"))
    bits = bits.withColumn("_piece", F.explode(F.sequence(F.lit(0), F.lit(PIECES - 1))))
    piece = F.substring("_bits", F.col("_piece") * PIECE_BYTES + 1, F.lit(PIECE_BYTES))
    return bits.select((F.col("_map") * PIECES + F.col("_piece")).alias("_map"), piece.alias("_bits"))


def with_mark(rows: DataFrame, bits: DataFrame, key: str) -> DataFrame:
    """``rows`` with ``_asked``: false if the key is none of those in ``bits``, true if it may be one."""
    bit = F.bitmap_bit_position(_place(key))
    piece = F.floor(bit / (8 * PIECE_BYTES)).cast("long")
    rows = rows.withColumns({"_map": F.bitmap_bucket_number(_place(key)) * PIECES + piece, "_bit": bit % (8 * PIECE_BYTES)})
    byte = F.conv(F.hex(F.expr("substring(_bits, int(_bit div 8) + 1, 1)")), 16, 10).cast("long")
    set_there = byte.bitwiseAND(F.expr("shiftleft(1L, int(_bit % 8))")) != 0
    # The filter has a fixed size.
    tested = rows.join(F.broadcast(bits), "_map", "left")
    return tested.withColumn("_asked", F.col("_bits").isNotNull() & set_there).drop("_map", "_bit", "_bits")


def maybe_asked(rows: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """The rows of ``rows`` whose ``key`` may be in ``keys``."""
    return with_mark(rows, key_bits(keys, key), key).where("_asked").drop("_asked")
