"""A filter of fixed size that tells which hashes may be in a set: no false negatives, some false positives."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

BITS = 1 << 23


def bit_filter(hashes: DataFrame, bits: int = BITS) -> Column:
    """One value for the whole set: a map of bitmaps of 4 KiB, together ``bits`` / 8 bytes, however many hashes.

    ``hashes`` has one long column. Use the result with ``may_hold``. The size is fixed, so it may be sent to every
    task; once it is full it lets everything through, which costs time and changes no result.
    """
    place = F.pmod(F.col(hashes.columns[0]), F.lit(bits))
    maps = hashes.groupBy(F.bitmap_bucket_number(place).alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("bits")
    )
    return maps.agg(F.map_from_entries(F.collect_list(F.struct("bucket", "bits"))).alias("filter")).scalar()


def may_hold(filter_value: Column, hashed: Column, bits: int = BITS) -> Column:
    place = F.pmod(hashed, F.lit(bits))
    bitmap = F.try_element_at(filter_value, F.bitmap_bucket_number(place))
    at = F.bitmap_bit_position(place)
    byte = F.conv(F.hex(F.substring(bitmap, (F.floor(at / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    bit = F.floor(byte / F.pow(F.lit(2), F.pmod(at, F.lit(8)))).cast("int").bitwiseAND(F.lit(1))
    return F.coalesce(bit == 1, F.lit(False))
