"""Reproducible train/test split."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def md5_bucket(keys: Sequence[str | Column], buckets: int = 100) -> Column:
    """Bucket 0..buckets-1 from the row key alone: the same on every run and engine."""
    text = F.concat_ws("|", *keys)
    head = F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint")
    return F.pmod(head, F.lit(buckets)).cast("int")


def split(
    df: DataFrame, keys: Sequence[str | Column], test_share: float = 0.2
) -> tuple[DataFrame, DataFrame]:
    """Train and test frames. Unlike ``randomSplit`` no sort of the input is needed and
    a recomputed task can not move a row to the other side."""
    bucket = md5_bucket(keys)
    cut = round(100 * (1 - test_share))
    return df.where(bucket < cut), df.where(bucket >= cut)
