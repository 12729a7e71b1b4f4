"""The feature mart: every scored play with the weather of its hour."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skytune.operators.joins import lookup_join

# Weather columns of the mart, and all its columns in order.
WEATHER_SIDE = (
    "weather_mood",
    "temperature_2m",
    "apparent_temperature",
    "weather_condition",
    "simplified_condition",
    "cloudcover",
    "precipitation",
    "relativehumidity_2m",
    "weather_mood_category",
    "temperature_category",
    "is_great_weather_mood",
    "is_poor_weather_mood",
)

MART_COLUMNS = (
    "Event_Start_Timestamp",
    "Event_Received_Timestamp",
    "Event_End_Timestamp",
    "Artist_Name",
    "Content_Name",
    "album_name",
    "streamable",
    "danceability",
    "energy",
    "valence",
    "tempo",
    "loudness",
    "popularity",
    "duration_ms",
    "explicit",
    "track_genre",
    "speechiness",
    "acousticness",
    "instrumentalness",
    "liveness",
    "song_mood",
    "weather_mood",
    "temperature_2m",
    "apparent_temperature",
    "weather_condition",
    "simplified_condition",
    "cloudcover",
    "precipitation",
    "relativehumidity_2m",
    "song_mood_category",
    "weather_mood_category",
    "temperature_category",
    "is_great_weather_mood",
    "is_poor_weather_mood",
    "is_uplifting_music",
    "is_depressing_music",
    "music_date",
    "music_hour",
    "music_minute",
    "event_hour",
    "event_day_of_week",
    "event_month",
    "event_day",
    "has_weather_data",
    "track_id",
    "key",
    "mode",
    "time_signature",
)

# Names that music columns take in the mart.
MUSIC_NAMES = {
    "track_name": "Content_Name",
    "artist_name": "Artist_Name",
    "music_mood": "song_mood",
    "music_mood_category": "song_mood_category",
    "play_date": "music_date",
    "play_hour": "music_hour",
}

# Columns a training set expects although no source delivers them.
PLACEHOLDERS = {"track_id": "", "key": 0, "mode": 0, "time_signature": 0}


def combined_mood(
    music: DataFrame, weather: DataFrame, keep: Sequence[str] = (), salts: int = 8
) -> DataFrame:
    """Left join on date and hour; a repeated weather hour repeats the play."""
    plays = music.where(F.col("played_at_ts").isNotNull()).withColumnsRenamed(MUSIC_NAMES)
    hours = weather.select(
        F.col("date").alias("music_date"),
        F.col("hour_of_day").alias("music_hour"),
        F.lit(True).alias("_found"),
        *WEATHER_SIDE,
    )
    joined = lookup_join(plays, hours, ["music_date", "music_hour"], ["played_at_ts"], salts=salts)
    stamp = F.col("played_at_ts")
    return joined.withColumns(
        {
            "Event_Start_Timestamp": stamp,
            "Event_Received_Timestamp": stamp,
            "Event_End_Timestamp": stamp,
            "music_minute": F.minute(stamp),
            "event_hour": F.col("music_hour"),
            "event_day_of_week": F.col("play_day_of_week"),
            "event_month": F.col("play_month"),
            "event_day": F.dayofmonth("music_date"),
            "has_weather_data": F.col("_found").isNotNull(),
        }
        | {name: F.lit(value) for name, value in PLACEHOLDERS.items()}
    ).select(*keep, *MART_COLUMNS)
