"""LAG over one global order without sending every row to one task."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DatetimeType, NumericType

from skytune.operators.joins import null_safe_join


SUB = "_sub"


def with_null_ranges(df: DataFrame, bucket: str, order_by: Sequence[str]) -> DataFrame:
    """``df`` with ``_sub``: the range a row of the NULL bucket lies in along the order, else 0.

    Rows without a bucket can be many, and only the columns behind the first tell their order. The
    first of those that is a number, date or time is cut at its approximate quantiles, into
    as many ranges as there are shuffle partitions. Any cuts give the same lag.
    """
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    kinds = {f.name: f.dataType for f in df.schema.fields}
    tie = next(iter(order_by[1:]), None)
    if tie is None or parts < 2 or not isinstance(kinds[tie], (NumericType, DatetimeType)):
        return df.withColumn(SUB, F.lit(0))
    shares = F.array(*(F.lit(i / parts) for i in range(1, parts)))
    lost = df.where(F.col(bucket).isNull())
    cuts = lost.select(F.percentile_approx(tie, shares, 100 * parts)).scalar()
    inside = F.size(F.filter("_cuts", lambda cut: cut <= F.col(tie)))
    sub = F.when(F.col(bucket).isNull() & F.col(tie).isNotNull(), inside).otherwise(0)
    return df.withColumn("_cuts", cuts).withColumn(SUB, sub).drop("_cuts")


def bucketed_lag(
    df: DataFrame,
    values: Mapping[str, str],
    bucket: str,
    order_by: Sequence[str],
    keys: Sequence[str] = (),
    context: Mapping[str, Column] | None = None,
) -> DataFrame:
    """Same result in two levels; ``bucket`` must never decrease along ``order_by``.

    Rows are lagged inside their bucket. The first row of a bucket takes the last row of
    the bucket before it, found on a frame with one row per bucket. Only that frame, whose
    size is the number of calendar buckets whatever the data volume, is ordered globally.
    Rows without a bucket come first in the order; they are cut into ranges, each treated as
    a bucket of its own (see ``with_null_ranges``).

    ``context`` adds aggregates of the bucket to each of its rows.
    """
    df = with_null_ranges(df, bucket, order_by)
    groups = [*keys, bucket, SUB]
    order = [F.col(c).asc_nulls_first() for c in order_by]
    within = Window.partitionBy(*groups).orderBy(*order)
    across = Window.partitionBy(*keys).orderBy(F.col(bucket).asc_nulls_first(), SUB)

    ends = df.groupBy(*groups).agg(
        F.max_by(F.struct(*values.values()), F.struct(*order_by)).alias("_last")
    )
    summary = ends.select(*groups, F.lag("_last").over(across).alias("_carry"))
    if context:
        whole = df.groupBy(*keys, bucket).agg(*(c.alias(n) for n, c in context.items()))
        summary = null_safe_join(summary, whole, [*keys, bucket])
    lagged = df.withColumns(
        {f"_lag_{out}": F.lag(src).over(within) for out, src in values.items()}
        | {"_row": F.row_number().over(within)}
    )
    filled = null_safe_join(lagged, summary, groups).withColumns(
        {
            out: F.when(F.col("_row") == 1, F.col("_carry")[src]).otherwise(F.col(f"_lag_{out}"))
            for out, src in values.items()
        }
    )
    return filled.drop("_carry", "_row", SUB, *(f"_lag_{out}" for out in values))
