"""Exact distinct counts of dense keys by bitmaps (survey D3, Q53, Q54).

Keys from 1 on fall into buckets of 32,768; a bucket is a bitmap of 4 KB, one
bit a key, so a table's distinct keys are an eighth of a byte each instead of
a row each.  Bitmaps of parts of a table, or of loads, merge by OR, so a
distinct count over many loads needs none of their rows again.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def key_bitmaps(df: DataFrame, key: str) -> DataFrame:
    """(bucket, bits): the bitmap of each bucket's keys; NULL keys are left out."""
    return df.where(F.col(key).isNotNull()).groupBy(F.bitmap_bucket_number(key).alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(key)).alias("bits"))


def merged(*bitmaps: DataFrame) -> DataFrame:
    """The bitmaps of all keys of several tables or loads."""
    return reduce(DataFrame.unionAll, bitmaps).groupBy("bucket").agg(F.bitmap_or_agg("bits").alias("bits"))


def key_count(bitmaps: DataFrame, name: str) -> DataFrame:
    """One row: the number of distinct keys."""
    return bitmaps.agg(F.coalesce(F.sum(F.bitmap_count("bits")), F.lit(0)).cast("long").alias(name))


def summary(df: DataFrame, key: str, distinct: str, columns: Mapping[str, tuple[str, str]]) -> DataFrame:
    """One row: the number of distinct non-NULL ``key`` values as ``distinct``,
    and per name of ``columns`` an aggregate (``count``, ``min``, ``max`` or
    ``sum``; a column or ``*``) of all rows.

    Rows are combined into a bitmap and the aggregates of a bucket before
    anything is shuffled, and buckets into one row; nothing is expanded.
    """
    def part(kind: str, column: str) -> Column:
        return F.count("*" if column == "*" else column) if kind == "count" else getattr(F, kind)(column)

    buckets = df.groupBy(F.bitmap_bucket_number(key).alias("__bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(key)).alias("__bits"),
        *(part(*of).alias(name) for name, of in columns.items()))
    return buckets.agg(
        *((F.coalesce(F.sum(name), F.lit(0)).cast("long") if kind == "count" else getattr(F, kind)(name)).alias(name)
          for name, (kind, _) in columns.items()),
        F.coalesce(F.sum(F.bitmap_count("__bits")), F.lit(0)).cast("long").alias(distinct))
