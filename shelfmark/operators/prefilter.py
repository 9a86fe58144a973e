"""Rows that cannot meet a set of keys, dropped before they are shuffled.

The keys are held as bits by their hash: a table of a fixed size, whatever their number,
that is sent to every task. A row whose bit is not set has no key among them; a few whose
bit is set have none either, so that this goes before a join and does not replace it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITS = 24               # 2 ** 24 bits are 512 rows of 4 KB
ROW_BITS = 32_768       # bits of one bitmap, as the built-in functions have them


def _slot(keys: Sequence[str]) -> Column:
    return F.xxhash64(*keys).bitwiseAND(F.lit((1 << BITS) - 1))


def key_bits(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``bucket, bits``: the bits of all keys, at most ``2 ** BITS / ROW_BITS`` rows."""
    slots = rows.select(_slot(keys).alias("slot"))
    return slots.groupBy(F.bitmap_bucket_number("slot").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("slot")).alias("bits"))


def perhaps_among(rows: DataFrame, keyed: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``rows`` without most of those whose keys ``keyed`` does not have; none of the others go."""
    slotted = rows.withColumn("_slot", _slot(keys))
    held = F.broadcast(key_bits(keyed, keys))       # of a fixed size
    place = F.bitmap_bit_position("_slot")
    byte = F.conv(F.hex(F.substring("bits", (place / 8).cast("int") + 1, F.lit(1))), 16, 10)
    found = slotted.join(held, F.bitmap_bucket_number("_slot") == F.col("bucket"))
    bit = F.call_function("shiftright", byte.cast("int"), (place % 8).cast("int"))
    return found.where(bit.bitwiseAND(F.lit(1)) == 1).select(*rows.columns)
