"""Row counts without extra passes, and a one-pass column profile."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F


def counted(df: DataFrame, stage: str) -> tuple[DataFrame, Observation]:
    """``df`` that counts its rows while some other action runs it."""
    seen = Observation(stage)
    return df.observe(seen, F.count(F.lit(1)).alias("rows")), seen


def profile(df: DataFrame) -> DataFrame:
    """Type, row count and NULL count per column, from a single aggregate."""
    counts = df.agg(
        F.count(F.lit(1)).alias("_rows"),
        *(F.count_if(F.col(f"`{c}`").isNull()).alias(c) for c in df.columns),
    )
    entries = F.array(
        *(
            F.struct(
                F.lit(name).alias("column_name"),
                F.lit(kind).alias("data_type"),
                F.col("_rows").alias("row_count"),
                (F.col("_rows") - F.col(f"`{name}`")).alias("non_null_count"),
                F.col(f"`{name}`").alias("null_count"),
            )
            for name, kind in df.dtypes
        )
    )
    return counts.select(F.inline(entries))
