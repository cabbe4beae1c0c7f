"""A Bloom filter of the running campaigns, tested in the scan of the clicks.

Clicks of campaigns that do not run add nothing to the ledger, but each would go through the join
with the links. The filter has one hash and a fixed number of bits, so its size does not grow with the
campaigns: ``2 ** bits`` bits, kept as rows of 32,768, are broadcast (1 MB at 23 bits). A click whose bit
is not set belongs to no running campaign. Some others pass too; the join with the campaigns, after the
clicks are added up, is the exact test.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _bit(camp_id: Column, bits: int) -> Column:
    # the bitmap functions count from 1
    return F.shiftrightunsigned(F.xxhash64(camp_id), 64 - bits) + 1


def campaign_bitmap(campaigns: DataFrame, bits: int) -> DataFrame:
    """``bitmap_bucket, bitmap``: the bits of the ``camp_id`` of ``campaigns``; at most ``2 ** (bits - 15)`` rows of 4 KB."""
    if not 15 <= bits <= 27:
        raise ValueError(f"a campaign filter has 15 to 27 bits (4 KB to 16 MB), not {bits}")
    bit = _bit(F.col("camp_id"), bits)
    known = campaigns.filter(F.col("camp_id").isNotNull())
    return (known.groupBy(F.bitmap_bucket_number(bit).alias("bitmap_bucket"))
            .agg(F.bitmap_construct_agg(F.bitmap_bit_position(bit)).alias("bitmap")))


def may_be_of(clicks: DataFrame, campaigns: DataFrame, bits: int) -> DataFrame:
    """The ``clicks`` that may be of ``campaigns``: all of theirs, and some of others. No click is moved."""
    bit = _bit(F.col("camp_id"), bits)
    place = F.bitmap_bit_position(bit)
    byte = F.substring("bitmap", (F.floor(place / 8) + 1).cast("int"), F.lit(1))
    is_set = F.getbit(F.conv(F.hex(byte), 16, 10).cast("int"), (place % 8).cast("int")) == 1
    known = clicks.filter(F.col("camp_id").isNotNull())
    return (known.join(F.broadcast(campaign_bitmap(campaigns, bits)), F.bitmap_bucket_number(bit) == F.col("bitmap_bucket"))
            .filter(is_set).select(*clicks.columns))
