"""Weather mood: decode readings, score, label, add trend and daily context."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skytune.functions import rules
from skytune.functions.bands import clamp, flag, known, total
from skytune.functions.times import parse_iso
from skytune.operators.context import with_group_context
from skytune.operators.lagging import bucketed_lag

# Output columns in order.
WEATHER_COLUMNS = (
    "timestamp",
    "timestamp_converted",
    "temperature_2m",
    "apparent_temperature",
    "weathercode",
    "weather_condition",
    "simplified_condition",
    "cloudcover",
    "cloud_category",
    "precipitation",
    "relativehumidity_2m",
    "date",
    "hour_of_day",
    "day_of_week",
    "month",
    "temperature_category",
    *rules.WEATHER_SCORES,
    "weather_mood_raw",
    "weather_mood",
    "weather_mood_category",
    "is_great_weather_mood",
    "is_poor_weather_mood",
    "is_ideal_weather_conditions",
    "is_unfavorable_conditions",
    "prev_hour_weather_mood",
    "prev_hour_temperature",
    "daily_avg_weather_mood",
    "daily_min_temp",
    "daily_max_temp",
)

TREND = {
    "prev_hour_weather_mood": "weather_mood",
    "prev_hour_temperature": "temperature_2m",
}


def decode_weather(
    weather: DataFrame, weather_tz: str | None = None, strict: bool = False
) -> DataFrame:
    """Calendar parts and category labels next to the landed columns.

    ``weather_tz`` names the wall clock of readings that were stamped as UTC unshifted.
    """
    return weather.withColumn(
        "timestamp_converted", parse_iso(F.col("timestamp"), weather_tz, strict)
    ).withColumns(
        {
            "date": F.to_date("timestamp_converted"),
            "hour_of_day": F.hour("timestamp_converted"),
            "day_of_week": F.dayofweek("timestamp_converted"),
            "month": F.month("timestamp_converted"),
            "weather_condition": rules.WEATHER_CONDITION.on(),
            "simplified_condition": rules.SIMPLE_CONDITION.on(),
            "temperature_category": rules.TEMPERATURE_CATEGORY.on(),
            "cloud_category": rules.CLOUD_CATEGORY.on(),
        }
    )


def score_weather(decoded: DataFrame, fix_ranges: bool = False) -> DataFrame:
    """Component scores, total, clamped mood, category and flags; row by row only."""
    scores = rules.WEATHER_SCORES_FIXED if fix_ranges else rules.WEATHER_SCORES
    condition, temperature = F.col("simplified_condition"), F.col("temperature_category")
    return (
        decoded.withColumns({name: bands.on() for name, bands in scores.items()})
        .withColumn("weather_mood_raw", total(list(scores)))
        .withColumn(
            "weather_mood",
            clamp(F.col("weather_mood_raw"), rules.MOOD_FLOOR, rules.MOOD_CEILING),
        )
        .withColumns(
            {
                "weather_mood_category": rules.WEATHER_CATEGORY.on(),
                "is_great_weather_mood": flag(F.col("weather_mood") >= rules.HIGH_MOOD),
                "is_poor_weather_mood": flag(F.col("weather_mood") <= rules.LOW_MOOD),
                "is_ideal_weather_conditions": flag(
                    condition.isin(*rules.IDEAL_CONDITIONS)
                    & temperature.isin(*rules.IDEAL_TEMPERATURES)
                ),
                "is_unfavorable_conditions": flag(
                    condition.isin(*rules.BAD_CONDITIONS)
                    | temperature.isin(*rules.BAD_TEMPERATURES)
                ),
            }
        )
    )


DAILY_CONTEXT = {
    "daily_avg_weather_mood": lambda: F.avg("weather_mood"),
    "daily_min_temp": lambda: F.min(known(F.col("temperature_2m"))),
    "daily_max_temp": lambda: F.max(known(F.col("temperature_2m"))),
}


def with_trend_and_context(
    scored: DataFrame, keys: Sequence[str] = (), tie_break: Sequence[str] = ()
) -> DataFrame:
    """Mood and temperature of the previous reading (the previous row, not the previous
    hour) and the mood and temperature range of the day."""
    return bucketed_lag(
        scored,
        TREND,
        "date",
        ["timestamp_converted", *tie_break],
        keys,
        {name: aggregate() for name, aggregate in DAILY_CONTEXT.items()},
    )


def with_daily_context(scored: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    return with_group_context(
        scored,
        [*keys, "date"],
        {name: aggregate() for name, aggregate in DAILY_CONTEXT.items()},
    )


def hourly_weather_mood(
    weather: DataFrame, *, weather_tz: str | None = None, fix_ranges: bool = False,
    strict: bool = False,
) -> DataFrame:
    """The row-wise part of the model: all the mart needs, and no shuffle."""
    return score_weather(decode_weather(weather, weather_tz, strict), fix_ranges)


def weather_mood(
    weather: DataFrame,
    keys: Sequence[str] = (),
    tie_break: Sequence[str] = (),
    keep: Sequence[str] = (),
    *,
    weather_tz: str | None = None,
    fix_ranges: bool = False,
    strict: bool = False,
) -> DataFrame:
    """The whole model. ``keys`` names location columns when several places are loaded;
    ``tie_break`` orders readings that share a timestamp; ``keep`` passes other landed
    columns through, such as the wind speed that only some pulls deliver."""
    scored = hourly_weather_mood(
        weather, weather_tz=weather_tz, fix_ranges=fix_ranges, strict=strict
    )
    full = with_trend_and_context(scored, keys, tie_break)
    extra = (c for c in (*tie_break, *keep) if c not in WEATHER_COLUMNS)
    return full.select(*keys, *extra, *WEATHER_COLUMNS)
