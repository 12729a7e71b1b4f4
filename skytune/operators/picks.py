"""Row choice: best row per key, latest rows, distinct rows, presentation order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def top_per_key(
    df: DataFrame, keys: Sequence[str | Column], order: Sequence[Column], n: int = 1
) -> DataFrame:
    """The first ``n`` rows of each key in the given order.

    Catalyst turns the rank filter into a group limit before the shuffle, so a hot key
    sends at most ``n`` rows per map task.
    """
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", rank).where(F.col("_rank") <= n).drop("_rank")


def latest(df: DataFrame, order: Sequence[Column], n: int) -> DataFrame:
    """The ``n`` latest rows overall (each task keeps its own ``n`` before the merge)."""
    return df.orderBy(*order).limit(n)


def distinct_rows(df: DataFrame) -> DataFrame:
    """Full-row distinct; copies collapse map-side before anything is shuffled."""
    return df.dropDuplicates()


def ordered(df: DataFrame, *columns: str) -> DataFrame:
    """Presentation order for display; writes use ``sortWithinPartitions`` instead."""
    return df.orderBy(*(F.col(c).asc_nulls_first() for c in columns))


def preview(df: DataFrame, n: int) -> DataFrame:
    return df.limit(n)
