"""Landed JSON to typed staging frames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skytune.functions.times import iso_z, parse_iso
from skytune.operators.picks import distinct_rows
from skytune.operators.reshape import parallel_arrays_to_rows
from skytune.schemas import WEATHER_ARRAYS

# Staged column and where it sits in a track.
TRACK_FIELDS = {
    "track_name": "name",
    "streamable": "streamable",
    "played_at": "date.#text",
    "played_at_uts": "date.uts",
    "artist_name": "artist.#text",
    "album_name": "album.#text",
}


def flatten_tracks(pulls: DataFrame) -> DataFrame:
    """One row per track; a pull with no tracks gives no row, a track that is still
    playing has no date and gives NULL times."""
    tracks = pulls.select(F.explode("recenttracks.track").alias("track"))
    return tracks.select(
        *(F.col(f"track.{path}").alias(name) for name, path in TRACK_FIELDS.items())
    )


def stage_plays(pulls: DataFrame) -> DataFrame:
    """Distinct plays: overlapping pulls land the same play more than once."""
    return distinct_rows(flatten_tracks(pulls))


def stage_weather_arrays(pulls: DataFrame, source_zone: str | None = None) -> DataFrame:
    """Hourly arrays to weather records with an ISO ``…Z`` timestamp."""
    fields = WEATHER_ARRAYS["hourly"].dataType.names
    # wind is only delivered by some pulls
    calm = F.transform("hourly.time", lambda _: F.lit(None).cast("double"))
    wind = F.coalesce("hourly.windspeed_10m", calm)
    pulls = pulls.withColumn("hourly", F.col("hourly").withField("windspeed_10m", wind))
    rows = parallel_arrays_to_rows(pulls, "hourly", fields)
    stamp = iso_z(parse_iso(F.col("time"), source_zone))
    return rows.select(stamp.alias("timestamp"), *(f for f in fields if f != "time"))
