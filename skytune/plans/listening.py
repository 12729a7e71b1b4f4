"""Listening metrics over matched plays (``match_plays`` output with a ``user_id``).

The definitions are ours: the documentation they come from names the metrics only.
Every metric starts from counts per user and hour or minute, which combine map-side, so
windows only ever see calendar-sized groups (24 hours, 1440 minutes, or the days of one
user), however many plays one user has.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skytune.functions.bands import known

AVERAGED = (
    "danceability",
    "energy",
    "valence",
    "tempo",
    "loudness",
    "speechiness",
    "acousticness",
    "instrumentalness",
    "liveness",
)

USER_HOUR = ("user_id", "play_date", "play_hour")
USER_DAY = ("user_id", "play_date")


def played_ms(matched: DataFrame) -> Column:
    """Played time of an event where one was landed, the track length otherwise."""
    if "play_ms" in matched.columns:
        return F.coalesce(F.col("play_ms"), F.col("duration_ms"))
    return F.col("duration_ms")


def hourly_listening(matched: DataFrame) -> DataFrame:
    """Plays, distinct tracks and artists, minutes and intensity per user and hour.

    ``intensity`` is the played share of the hour; ``relative_intensity`` compares the
    plays of the hour with the user's mean over the active hours of that day.
    """
    # Counts per title first: the distinct counts then expand far fewer rows.
    titles = (
        matched.where(F.col("played_at_ts").isNotNull())
        .groupBy(*USER_HOUR, "cleaned_track_name", "cleaned_artist_name")
        .agg(F.count(F.lit(1)).alias("n"), F.sum(played_ms(matched)).alias("ms"))
    )
    hours = titles.groupBy(*USER_HOUR).agg(
        F.sum("n").alias("plays"),
        F.count_distinct("cleaned_track_name").alias("distinct_tracks"),
        F.count_distinct("cleaned_artist_name").alias("distinct_artists"),
        F.coalesce(F.sum("ms"), F.lit(0)).alias("played_ms"),
    )
    day = Window.partitionBy(*USER_DAY)
    return hours.select(
        *USER_HOUR,
        "plays",
        "distinct_tracks",
        "distinct_artists",
        (F.col("played_ms") / 60000).alias("minutes"),
        (F.col("played_ms") / 3600000).alias("intensity"),
        (F.col("plays") / F.avg("plays").over(day)).alias("relative_intensity"),
    )


def cumulative_listening(plays: DataFrame) -> DataFrame:
    """Songs played so far in the day, per user and minute with at least one play.

    Takes cleaned plays: no metadata is needed, so no title join either.
    """
    minutes = (
        plays.where(F.col("played_at_ts").isNotNull())
        .groupBy(
            "user_id",
            F.to_date("played_at_ts").alias("play_date"),
            F.date_trunc("minute", "played_at_ts").alias("play_minute"),
        )
        .agg(F.count(F.lit(1)).alias("plays"))
    )
    so_far = (
        Window.partitionBy(*USER_DAY)
        .orderBy("play_minute")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return minutes.withColumn("cumulative_plays", F.sum("plays").over(so_far))


def average_features(matched: DataFrame, grain: str = "hour") -> DataFrame:
    """Mean of each audio feature over matched plays, per user and hour or day."""
    groups = {"hour": USER_HOUR, "day": USER_DAY}[grain]
    return (
        matched.where(F.col("matched_with_metadata") & F.col("played_at_ts").isNotNull())
        .groupBy(*groups)
        .agg(
            F.count(F.lit(1)).alias("matched_plays"),
            *(F.avg(known(F.col(c))).alias(f"avg_{c}") for c in AVERAGED),
        )
    )


def feature_partials(matched: DataFrame) -> DataFrame:
    """Plays, and sum and number of known values of each audio feature, per user and hour."""
    sums = {"matched_plays": F.count(F.lit(1))}
    for name in AVERAGED:
        value = known(F.col(name))
        sums |= {f"_sum_{name}": F.sum(value), f"_n_{name}": F.count(value)}
    return (
        matched.where(F.col("matched_with_metadata") & F.col("played_at_ts").isNotNull())
        .groupBy(*USER_HOUR)
        .agg(*(c.alias(n) for n, c in sums.items()))
    )


def folded_features(partials: DataFrame, grain: str = "hour") -> DataFrame:
    """What ``average_features`` gives over all rows that the partials stand for."""
    groups = {"hour": USER_HOUR, "day": USER_DAY}[grain]
    means = (
        F.try_divide(F.sum(f"_sum_{c}"), F.sum(f"_n_{c}")).alias(f"avg_{c}") for c in AVERAGED
    )
    return partials.groupBy(*groups).agg(F.sum("matched_plays").alias("matched_plays"), *means)


def baseline_deviation(music: DataFrame, days: int = 7) -> DataFrame:
    """z-score of a user's daily plays and mood against the ``days`` active days before.

    The current day is not part of its own baseline; with fewer than two days before it,
    or no spread among them, the score is NULL.
    """
    daily = (
        music.where(F.col("played_at_ts").isNotNull())
        .groupBy("user_id", "play_date")
        .agg(F.count(F.lit(1)).alias("plays"), F.avg("music_mood").alias("mood"))
    )
    before = Window.partitionBy("user_id").orderBy("play_date").rowsBetween(-days, -1)

    def deviation(name: str) -> Column:
        spread = F.stddev_samp(name).over(before)
        return F.when(
            spread > 0, (F.col(name) - F.avg(name).over(before)) / spread
        )

    return daily.select(
        *USER_DAY,
        "plays",
        "mood",
        deviation("plays").alias("plays_deviation"),
        deviation("mood").alias("mood_deviation"),
    )


def label_partials(
    df: DataFrame, label: str, mood: str, extra: str | None = None, keep: Sequence[str] = ()
) -> DataFrame:
    """Per ``date`` and label: rows, sum, least and greatest mood. There are only a handful.

    Partials of different rows merge by ``merged_labels``; columns in ``keep`` hold them apart.
    """
    sums = {"_n": F.count(F.lit(1)), "_s": F.sum(mood), "_lo": F.min(mood), "_hi": F.max(mood)}
    if extra:
        sums |= {"_xs": F.sum(extra), "_xn": F.count(extra)}
    dated = df.where(F.col("date").isNotNull())
    return dated.groupBy(*keep, "date", label).agg(*(c.alias(n) for n, c in sums.items()))


def merged_labels(partials: DataFrame, label: str) -> DataFrame:
    """Partials of several loads or stored days as one per date and label."""
    how = {"_lo": F.min, "_hi": F.max}
    sums = [n for n in ("_n", "_s", "_lo", "_hi", "_xs", "_xn") if n in partials.columns]
    return partials.groupBy("date", label).agg(*(how.get(n, F.sum)(n).alias(n) for n in sums))


def folded_labels(per_label: DataFrame, label: str, mood: str, extra: str | None = None) -> DataFrame:
    """Per ``date``: rows, mean, least and greatest mood, and the label of most rows (a tie goes
    to the first in the alphabet), from one partial per date and label."""
    folded = {
        "rows": F.sum("_n"),
        f"avg_{mood}": F.sum("_s") / F.sum("_n"),
        f"min_{mood}": F.min("_lo"),
        f"max_{mood}": F.max("_hi"),
        f"dominant_{label}": F.min_by(label, F.struct(-F.col("_n"), F.col(label))),
    }
    if extra:
        folded[f"avg_{extra}"] = F.sum("_xs") / F.sum("_xn")
    return per_label.groupBy("date").agg(*(c.alias(n) for n, c in folded.items()))


def _rolled_up(df: DataFrame, label: str, mood: str, extra: str | None = None) -> DataFrame:
    """One pass: partial sums per date and label are folded again per date, so the source is
    neither read twice nor gathered by day."""
    return folded_labels(label_partials(df, label, mood, extra), label, mood, extra)


def daily_weather(weather: DataFrame) -> DataFrame:
    """Weather mood and temperature per day."""
    rolled = _rolled_up(weather, "weather_mood_category", "weather_mood", "temperature_2m")
    return rolled.withColumnRenamed("rows", "hours")


def daily_music(music: DataFrame) -> DataFrame:
    """Music mood per day."""
    dated = music.withColumnRenamed("play_date", "date")
    rolled = _rolled_up(dated, "music_mood_category", "music_mood")
    return rolled.withColumnRenamed("rows", "plays")


def daily_mood(music: DataFrame, weather: DataFrame) -> DataFrame:
    """Both moods per day; days known to one side only keep NULL on the other."""
    return daily_weather(weather).join(daily_music(music), "date", "full")
