"""Sets of integers as bitmaps of 32,768 bits, one row per bucket."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def id_bitmaps(df: DataFrame, column: str) -> DataFrame:
    """(bucket, bits): the distinct values of an integer column; nulls are left out."""
    rows = df.where(F.col(column).isNotNull()).select(F.bitmap_bucket_number(column).alias("bucket"), F.bitmap_bit_position(column).alias("bit"))
    return rows.groupBy("bucket").agg(F.bitmap_construct_agg("bit").alias("bits"))


def bit_is_set(bits: str, bit: Column) -> Column:
    """Whether a bit of the bitmap in column ``bits`` is set; false without a bitmap."""
    byte = F.conv(F.hex(F.substring(F.col(bits), (F.floor(bit / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    masks = F.array(*[F.lit(1 << i) for i in range(8)])
    return F.coalesce(byte.bitwiseAND(F.element_at(masks, (bit % 8 + 1).cast("int"))) != 0, F.lit(False))
