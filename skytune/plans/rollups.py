"""Roll-ups kept as partial aggregates, so that late rows update them without a full run.

Two kinds of tables. A table *by load* has one folder per load with the partials of the rows that
load brought; repeating a load replaces its folder, a late load adds one. A table *by stored day*
has one partition per stored day, and a load replaces those it touched. Partials merge when they
are read: counts and sums add up, extremes stay extremes. So a roll-up costs a load what it brought,
and a reader a few rows per day, however many plays lie behind them.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from skytune.plans.listening import folded_labels, label_partials, merged_labels
from skytune.sources.sinks import write_days

LOAD = "load"
MUSIC_LABEL, MUSIC_MOOD = "music_mood_category", "music_mood"


def store_load(partials: DataFrame, path: str, load: str, day: str) -> None:
    """Write the partials of one load; the same load again replaces what it wrote before."""
    (
        partials.hint("rebalance", day)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "static")
        .partitionBy(day)
        .parquet(f"{path}/{LOAD}={load}")
    )


def stored_loads(
    spark: SparkSession,
    path: str,
    schema: StructType,
    day: str,
    days: tuple[date, date] | None = None,
) -> DataFrame:
    """Partials of all loads; with ``days`` only partitions of that range are read."""
    rows = spark.read.schema(StructType([*schema.fields]).add(LOAD, StringType())).parquet(path)
    return rows.where(F.col(day).between(*map(F.lit, days))) if days else rows


def store_music_days(music: DataFrame, path: str, stored_day: str) -> None:
    """Replace the partials of the stored days that ``music`` holds; other days keep their files.

    A stored day is a local one and touches two dates, and a date two stored days.
    """
    dated = music.withColumnRenamed("play_date", "date")
    partials = label_partials(dated, MUSIC_LABEL, MUSIC_MOOD, keep=[stored_day])
    write_days(partials, path, stored_day)


def music_days(partials: DataFrame, dates: Sequence[date] = ()) -> DataFrame:
    """Music mood per day, as ``daily_music`` gives it over all plays, of some dates or of all."""
    if dates:
        partials = partials.where(F.col("date").isin(*dates))
    rolled = folded_labels(merged_labels(partials, MUSIC_LABEL), MUSIC_LABEL, MUSIC_MOOD)
    return rolled.withColumnRenamed("rows", "plays")
