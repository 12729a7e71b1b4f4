"""Rows not seen before: a Bloom filter per day prunes an exact anti-join against history.

The filter of a day is a table of bitmaps, built and merged with Spark's bitmap functions. A row's
hash picks one bitmap of its day and a few bits in it, so one lookup tells of a row that it is
new for certain, or may be known. Only rows that may be known are joined with history.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skytune.operators.joins import null_safe_join

#: Bits of one bitmap (what the bitmap functions use), and bits set per row.
BITMAP_BITS, HASHES = 32768, 4
#: Bitmaps of a day; a few thousand rows each keep false alarms rare.
BITMAPS = 64


def _bitmap(row: Sequence[str], bitmaps: int) -> Column:
    return F.pmod(F.xxhash64(*row), F.lit(bitmaps)).cast("int")


def _bits(row: Sequence[str]) -> Column:
    """Places of the bits of a row inside its bitmap."""
    return F.array(
        *(F.pmod(F.xxhash64(*row, F.lit(i)), F.lit(BITMAP_BITS)) for i in range(HASHES))
    )


def filter_of(
    rows: DataFrame, day: str, row: Sequence[str], bitmaps: int = BITMAPS
) -> DataFrame:
    """(day, bitmap, bits): the filter of each day, over the columns ``row``."""
    placed = rows.select(day, _bitmap(row, bitmaps).alias("bitmap"), F.explode(_bits(row)).alias("bit"))
    return placed.groupBy(day, "bitmap").agg(F.bitmap_construct_agg("bit").alias("bits"))


def merged(filters: DataFrame, day: str) -> DataFrame:
    """Filters of several loads as one per day."""
    return filters.groupBy(day, "bitmap").agg(F.bitmap_or_agg("bits").alias("bits"))


def maybe_seen(
    rows: DataFrame, filters: DataFrame, day: str, row: Sequence[str], bitmaps: int = BITMAPS
) -> DataFrame:
    """``rows`` with ``_maybe``: false only if no stored row of that day is equal."""
    keyed = rows.withColumn("bitmap", _bitmap(row, bitmaps))
    joined = null_safe_join(keyed, merged(filters, day), [day, "bitmap"])

    def is_set(bit: Column) -> Column:
        byte = F.hex(F.substring("bits", (F.floor(bit / 8) + 1).cast("int"), F.lit(1)))
        return F.getbit(F.conv(byte, 16, 10).cast("int"), (bit % 8).cast("int")) == 1

    every = F.forall(_bits(row), is_set)
    return joined.withColumn("_maybe", F.col("bits").isNotNull() & every).drop("bitmap", "bits")


def unseen(
    rows: DataFrame,
    history: DataFrame,
    filters: DataFrame,
    day: str,
    row: Sequence[str],
    bitmaps: int = BITMAPS,
) -> DataFrame:
    """The rows that are not in ``history``, equal in ``day`` and the columns ``row`` (NULL is equal to NULL).

    ``filters`` must cover all of ``history``; a filter may know more. The result is exact.
    """
    told = maybe_seen(rows, filters, day, row, bitmaps)
    known = history.select(day, *row)
    checked = null_safe_join(told.where("_maybe"), known, [day, *row], "left_anti")
    return told.where(~F.col("_maybe")).unionByName(checked).drop("_maybe")
