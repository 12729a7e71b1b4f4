"""Music mood: clean plays, match the best metadata per title, score, label."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skytune.functions import rules
from skytune.functions.bands import clamp, flag, total
from skytune.functions.text import match_key
from skytune.functions.times import duration_minutes, epoch_timestamp, parse_played_at
from skytune.operators.joins import lookup_join
from skytune.operators.picks import top_per_key

# Audio features, and the model's output columns in order.
AUDIO_FEATURES = (
    "danceability",
    "energy",
    "valence",
    "tempo",
    "loudness",
    "popularity",
    "explicit",
    "duration_ms",
    "speechiness",
    "acousticness",
    "instrumentalness",
    "liveness",
    "track_genre",
)

MUSIC_COLUMNS = (
    "track_name",
    "artist_name",
    "album_name",
    "streamable",
    "played_at",
    "played_at_ts",
    "play_date",
    "play_hour",
    "play_day_of_week",
    "play_month",
    "danceability",
    "energy",
    "valence",
    "tempo",
    "loudness",
    "popularity",
    "explicit",
    "duration_ms",
    "duration_minutes",
    "speechiness",
    "acousticness",
    "instrumentalness",
    "liveness",
    "track_genre",
    *rules.MUSIC_SCORES,
    "music_mood_raw",
    "music_mood",
    "music_mood_category",
    "is_uplifting_music",
    "is_depressing_music",
    "time_of_day_category",
)


def clean_plays(
    plays: DataFrame,
    keep: Sequence[str] = (),
    use_epoch: bool = False,
    strict: bool = False,
) -> DataFrame:
    """Named and dated plays with match keys and a parsed play time.

    ``use_epoch`` takes the exact epoch second where one was landed, the text otherwise.
    """
    stamp = parse_played_at(F.col("played_at"), strict)
    if use_epoch:
        stamp = F.coalesce(epoch_timestamp(F.col("played_at_uts")), stamp)
    return plays.where(
        F.col("played_at").isNotNull() & F.col("track_name").isNotNull()
    ).select(
        *keep,
        "track_name",
        "artist_name",
        "album_name",
        "streamable",
        "played_at",
        match_key(F.col("track_name")).alias("cleaned_track_name"),
        match_key(F.col("artist_name")).alias("cleaned_artist_name"),
        stamp.alias("played_at_ts"),
    )


def _match_keys(match_artist: bool) -> list[str]:
    return ["cleaned_track_name", *(["cleaned_artist_name"] if match_artist else [])]


def best_metadata(metadata: DataFrame, match_artist: bool = False) -> DataFrame:
    """The most popular row per title; ties go to the lowest track id."""
    keyed = metadata.select(
        "track_id",
        "track_name",
        "artists",
        *AUDIO_FEATURES,
        match_key(F.col("track_name")).alias("cleaned_track_name"),
        *([match_key(F.col("artists")).alias("cleaned_artist_name")] if match_artist else []),
    )
    order = [F.col("popularity").desc_nulls_last(), F.col("track_id").asc_nulls_first()]
    return top_per_key(keyed, _match_keys(match_artist), order)


def match_plays(
    cleaned: DataFrame, best: DataFrame, match_artist: bool = False, salts: int = 8
) -> DataFrame:
    """Every play with the audio features of its title and a match flag."""
    keys = _match_keys(match_artist)
    features = best.select(*keys, F.lit(True).alias("_found"), *AUDIO_FEATURES)
    # A popular title is played at many different times, so the time spreads it.
    joined = lookup_join(cleaned, features, keys, ["played_at"], salts=salts)
    return joined.withColumns(
        {
            "play_date": F.to_date("played_at_ts"),
            "play_hour": F.hour("played_at_ts"),
            "play_day_of_week": F.dayofweek("played_at_ts"),
            "play_month": F.month("played_at_ts"),
            "duration_minutes": duration_minutes(F.col("duration_ms")),
            "matched_with_metadata": F.col("_found").isNotNull(),
        }
    ).drop("_found")


def score_music(
    matched: DataFrame, keep: Sequence[str] = (), fix_ranges: bool = False
) -> DataFrame:
    """Component scores, total, clamped mood, category and flags of matched plays."""
    scores = rules.MUSIC_SCORES_FIXED if fix_ranges else rules.MUSIC_SCORES
    scored = (
        matched.where(F.col("matched_with_metadata"))
        .withColumns({name: bands.on() for name, bands in scores.items()})
        .withColumn("music_mood_raw", total(list(scores)))
        .withColumn(
            "music_mood",
            clamp(F.col("music_mood_raw"), rules.MOOD_FLOOR, rules.MOOD_CEILING),
        )
        .withColumns(
            {
                "music_mood_category": rules.MUSIC_CATEGORY.on(),
                "is_uplifting_music": flag(F.col("music_mood") >= rules.HIGH_MOOD),
                "is_depressing_music": flag(F.col("music_mood") <= rules.LOW_MOOD),
                "time_of_day_category": rules.TIME_OF_DAY.on(),
            }
        )
    )
    return scored.select(*keep, *MUSIC_COLUMNS)


def music_mood(
    plays: DataFrame,
    metadata: DataFrame,
    keep: Sequence[str] = (),
    *,
    match_artist: bool = False,
    use_epoch: bool = False,
    fix_ranges: bool = False,
    strict: bool = False,
    salts: int = 8,
) -> DataFrame:
    """The whole model; ``keep`` carries extra play columns such as a user id through."""
    cleaned = clean_plays(plays, keep, use_epoch, strict)
    matched = match_plays(cleaned, best_metadata(metadata, match_artist), match_artist, salts)
    return score_music(matched, keep, fix_ranges)
