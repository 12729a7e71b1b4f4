"""Landing, table and view sinks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame


def land_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("ignoreNullFields", "false").json(path)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").csv(path, header=True, escape='"')


def write_table(
    df: DataFrame,
    name: str,
    path: str | None = None,
    sort_by: Sequence[str] = (),
    allow_empty: bool = False,
) -> bool:
    """Full overwrite of one table; ``sort_by`` orders rows inside each file.

    An empty frame does not replace a table that is there, unless ``allow_empty`` says so.
    Returns whether the table was written.
    """
    if not allow_empty and df.sparkSession.catalog.tableExists(name) and df.isEmpty():
        return False
    writer = (df.sortWithinPartitions(*sort_by) if sort_by else df).write.mode("overwrite")
    if path:
        writer = writer.option("path", path)
    writer.format("parquet").saveAsTable(name)
    return True


def write_days(df: DataFrame, path: str, day: str, sort_by: Sequence[str] = ()) -> None:
    """Replace only the days present in ``df``; all other days keep their files.

    The rebalance hint gathers each day into few files and lets AQE cut a day that is
    larger than the advisory partition size, so one hot day does not end in one task.
    """
    spread = df.hint("rebalance", day).sortWithinPartitions(day, *sort_by)
    (
        spread.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(day)
        .parquet(path)
    )


def publish_view(df: DataFrame, name: str) -> None:
    df.createOrReplaceTempView(name)
