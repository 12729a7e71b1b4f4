"""The daily batch: landed JSON of one local day to staged tables, then the mart."""

from __future__ import annotations

import datetime as dt
import logging
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skytune.functions.times import in_local_day, parse_iso, parse_played_at
from skytune.plans.mart import combined_mood
from skytune.plans.music import music_mood
from skytune.plans.staging import stage_plays
from skytune.plans.weather import hourly_weather_mood
from skytune.sources.measures import counted
from skytune.sources.scans import scan_music_pulls, scan_weather_records
from skytune.sources.sinks import write_days

log = logging.getLogger(__name__)


@dataclass(frozen=True)
class Folders:
    music_json: str
    weather_json: str
    plays: str
    weather: str
    mart: str


def load(df: DataFrame, path: str, day: str, stage: str) -> int:
    """Write the days of ``df`` and return its row count, all in one action.

    No rows means no day is touched, so an empty pull never wipes what is there.
    """
    watched, seen = counted(df, stage)
    write_days(watched, path, day)
    rows = seen.get["rows"]
    (log.info if rows else log.warning)("%s: %d rows", stage, rows)
    return rows


def run_daily(
    spark: SparkSession,
    run_date: dt.date | str,
    folders: Folders,
    metadata: DataFrame,
    zone: str = "Europe/Berlin",
) -> dict[str, int]:
    """Stage one local day and rebuild that day of the mart.

    Plays and mart are stored per *local* day: the pull covers exactly one, while it
    touches two UTC dates and would overwrite the rest of the earlier one. A play without
    an epoch is dated by its text. Of all landed plays, ``undated`` counts those with neither.
    """
    day = dt.date.fromisoformat(str(run_date))
    told = F.unix_timestamp(parse_played_at(F.col("played_at")))
    epoch = F.coalesce(F.col("played_at_uts").try_cast("bigint"), told)
    landed = stage_plays(scan_music_pulls(spark, folders.music_json)).withColumn("_epoch", epoch)
    plays = (
        landed.where(in_local_day(F.col("_epoch"), day, zone))
        .drop("_epoch")
        .withColumn("local_date", F.lit(day))
    )
    weather = scan_weather_records(spark, folders.weather_json)
    weather = weather.withColumn("date", F.to_date(parse_iso(F.col("timestamp"))))

    counts = {
        "plays": load(plays, folders.plays, "local_date", "plays"),
        "weather": load(weather, folders.weather, "date", "weather"),
        # a pass of its own: an observation below the day filter is lost when the day is empty
        "undated": landed.where(F.col("_epoch").isNull()).count(),
    }
    if counts["undated"]:
        log.warning("plays without a time: %d", counts["undated"])
    if not counts["plays"]:
        return counts | {"mart": 0}

    # Reading back by partition prunes to the folders of this day and the one before.
    today = F.col("local_date") == F.lit(day)
    near = F.col("date").between(day - dt.timedelta(days=1), day)
    staged_plays = spark.read.schema(plays.schema).parquet(folders.plays).where(today)
    staged_weather = spark.read.schema(weather.schema).parquet(folders.weather).where(near)
    mart = combined_mood(
        music_mood(staged_plays, metadata, ["local_date"]),
        hourly_weather_mood(staged_weather),
        ["local_date"],
    )
    return counts | {"mart": load(mart, folders.mart, "local_date", "mart")}
