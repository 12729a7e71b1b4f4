"""Group aggregates repeated on every row of the group."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame

from skytune.operators.joins import null_safe_join


def with_group_context(
    df: DataFrame, groups: Sequence[str], aggregates: Mapping[str, Column]
) -> DataFrame:
    """``agg OVER (PARTITION BY groups)`` for unordered frames.

    Aggregating first combines map-side and joins back one row per group; a window would
    instead gather all rows of a hot group in one task.
    """
    summary = df.groupBy(*groups).agg(*(c.alias(n) for n, c in aggregates.items()))
    return null_safe_join(df, summary, groups)
