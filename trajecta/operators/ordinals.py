"""Exact positions inside groups that may be as large as the table.

A window over a hot group would send the whole group to one task.  Here a group is cut into
buckets by hash (or by the order column's own hash), buckets are counted with a partial
aggregate, the counts are turned into offsets, and only a bucket is ever sorted in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BUCKET = "__bucket"


def with_ordinals(df: DataFrame, groups: list[str], by: list[str], name: str = "ordinal", buckets: int = 256) -> DataFrame:
    """Add ``name``: the 0-based place of each row in its group, in order of the hash of ``by``.

    ``by`` must identify a row inside its group for the result to be repeatable; ties get distinct
    places in no fixed order.  Null group values form a group of their own.  The offsets table has
    at most ``buckets`` rows for a group.
    """
    hashed = F.xxhash64(*[F.col(c) for c in by])
    marked = df.withColumn("__h", hashed).withColumn(BUCKET, F.pmod(F.shiftright("__h", 40), F.lit(buckets)).cast("int"))
    keys = [*groups, BUCKET]
    counts = marked.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"))
    before = Window.partitionBy(*groups).orderBy(BUCKET).rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(*[F.col(k).alias(f"__o_{k}") for k in keys], F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__offset"))
    on: Column = F.lit(True)
    for k in keys:
        on = on & F.col(k).eqNullSafe(F.col(f"__o_{k}"))
    place = F.row_number().over(Window.partitionBy(*keys).orderBy("__h", *by))
    return (
        marked.withColumn("__place", place - 1)
        .join(offsets, on)
        .withColumn(name, F.col("__offset") + F.col("__place"))
        .drop("__h", BUCKET, "__place", "__offset", *[f"__o_{k}" for k in keys])
    )
