"""The mood rules. All numbers and labels below are fixed values that define the results.

Rules named ``*_FIXED`` are the opt-in repairs: hour ranges that cross midnight and the
humidity band that the parity order can never reach.
"""

from __future__ import annotations

from skytune.functions.bands import (
    Bands,
    Lookup,
    above,
    any_of,
    around_midnight,
    at_least,
    at_most,
    below,
    between,
    exactly,
)

MOOD_FLOOR, MOOD_CEILING = -10, 10
HIGH_MOOD, LOW_MOOD = 7, -5

# --- music -----------------------------------------------------------------------

MUSIC_SCORES = {
    "energy_score": Bands(
        "energy",
        ((at_least(0.8), 5), (at_least(0.6), 3), (at_least(0.4), 1), (at_least(0.2), -1)),
        -3,
        real=True,
    ),
    "valence_score": Bands(
        "valence",
        ((at_least(0.8), 5), (at_least(0.6), 3), (at_least(0.4), 1), (at_least(0.2), -2)),
        -5,
        real=True,
    ),
    "danceability_score": Bands(
        "danceability",
        ((at_least(0.7), 3), (at_least(0.5), 1), (at_least(0.3), -1)),
        -2,
        real=True,
    ),
    "tempo_score": Bands(
        "tempo",
        (
            (between(100.0, 140.0), 3),
            (between(80.0, 100.0), 1),
            (between(140.0, 180.0), 2),
            (below(60.0), -2),
            (between(60.0, 80.0), -1),
        ),
        0,
        real=True,
    ),
    "genre_score": Lookup(
        "track_genre",
        (
            (("pop", "dance", "disco", "funk"), 3),
            (("rock", "alternative", "indie"), 1),
            (("hip-hop", "rap", "r-n-b"), 2),
            (("jazz", "blues"), 0),
            (("classical",), -1),
            (("metal", "hard-rock"), -2),
            (("sad", "emo"), -3),
        ),
        0,
        fold_case=True,
    ),
    "acousticness_score": Bands(
        "acousticness",
        ((at_least(0.8), -1), (at_least(0.5), 0), (at_least(0.2), 1)),
        2,
        real=True,
    ),
    "time_listening_score": Bands(
        "play_hour",
        ((between(6, 10), 2), (between(16, 20), 1), (between(22, 5), -1)),
        0,
    ),
    "popularity_score": Bands(
        "popularity",
        ((at_least(80), 2), (at_least(60), 1), (at_least(40), 0), (at_least(20), -1)),
        0,
    ),
}

MUSIC_SCORES_FIXED = MUSIC_SCORES | {
    "time_listening_score": Bands(
        "play_hour",
        ((between(6, 10), 2), (between(16, 20), 1), (around_midnight(22, 5), -1)),
        0,
    ),
}

MUSIC_CATEGORY = Bands(
    "music_mood_raw",
    (
        (at_least(7), "uplifting"),
        (at_least(3), "positive"),
        (at_least(-2), "neutral"),
        (at_least(-6), "melancholic"),
    ),
    "depressing",
)

TIME_OF_DAY = Bands(
    "play_hour",
    ((between(6, 12), "morning"), (between(12, 18), "afternoon"), (between(18, 22), "evening")),
    "night",
)

# --- weather ---------------------------------------------------------------------

WEATHER_CONDITION = Lookup(
    "weathercode",
    (
        ((0,), "clear"),
        ((1,), "mainly_clear"),
        ((2,), "partly_cloudy"),
        ((3,), "overcast"),
        ((45, 48), "foggy"),
        ((51, 53, 55), "drizzle"),
        ((61, 63, 65), "rainy"),
        ((71, 73, 75), "snowy"),
        ((77,), "snow_grains"),
        ((80, 81, 82), "rain_showers"),
        ((85, 86), "snow_showers"),
        ((95,), "thunderstorm"),
        ((96, 99), "thunderstorm_hail"),
    ),
    "unknown",
    key_type="bigint",
)

SIMPLE_CONDITION = Lookup(
    "weathercode",
    (
        ((0,), "sunny"),
        ((1, 2), "partly_cloudy"),
        ((3,), "cloudy"),
        ((45, 48), "foggy"),
        ((51, 53, 55, 61, 63, 65, 80, 81, 82), "rainy"),
        ((71, 73, 75, 77, 85, 86), "snowy"),
        ((95, 96, 99), "stormy"),
    ),
    "other",
    key_type="bigint",
)

TEMPERATURE_CATEGORY = Bands(
    "temperature_2m",
    (
        (at_most(0.0), "freezing"),
        (between(0.0, 10.0), "very_cold"),
        (between(10.0, 15.0), "cold"),
        (between(15.0, 20.0), "cool"),
        (between(20.0, 25.0), "warm"),
        (between(25.0, 30.0), "hot"),
        (above(30.0), "very_hot"),
    ),
    "unknown",
    real=True,
)

# Fractional cover between 20 and 21 or 50 and 51 belongs to no band.
CLOUD_CATEGORY = Bands(
    "cloudcover",
    (
        (at_most(20.0), "clear"),
        (between(21.0, 50.0), "partly_cloudy"),
        (between(51.0, 80.0), "mostly_cloudy"),
        (above(80.0), "overcast"),
    ),
    "unknown",
    real=True,
)

WEATHER_SCORES = {
    "temperature_score": Lookup(
        "temperature_category",
        (
            (("warm",), 5),
            (("hot",), 3),
            (("cool",), 1),
            (("cold",), -2),
            (("very_cold",), -4),
            (("freezing",), -5),
            (("very_hot",), 2),
        ),
        0,
    ),
    "weather_score": Lookup(
        "simplified_condition",
        (
            (("sunny",), 5),
            (("partly_cloudy",), 2),
            (("cloudy",), -2),
            (("rainy", "snowy"), -4),
            (("stormy",), -5),
            (("foggy",), -3),
        ),
        -1,
    ),
    "cloud_score": Lookup(
        "cloud_category",
        (
            (("clear",), 3),
            (("partly_cloudy",), 1),
            (("mostly_cloudy",), -1),
            (("overcast",), -3),
        ),
        0,
    ),
    "time_score": Bands(
        "hour_of_day",
        (
            (between(10, 16), 2),
            (any_of(between(7, 9), between(17, 19)), 1),
            (between(20, 22), 0),
            (between(23, 6), -1),
        ),
        0,
    ),
    "precipitation_penalty": Bands(
        "precipitation",
        ((exactly(0.0), 0), (below(1.0), -1), (below(5.0), -2)),
        -3,
        real=True,
    ),
    "humidity_score": Bands(
        "relativehumidity_2m",
        (
            (between(40.0, 60.0), 1),
            (any_of(below(30.0), above(70.0)), -1),
            (above(80.0), -2),
        ),
        0,
        real=True,
    ),
}

WEATHER_SCORES_FIXED = WEATHER_SCORES | {
    "time_score": Bands(
        "hour_of_day",
        (
            (between(10, 16), 2),
            (any_of(between(7, 9), between(17, 19)), 1),
            (between(20, 22), 0),
            (around_midnight(23, 6), -1),
        ),
        0,
    ),
    "humidity_score": Bands(
        "relativehumidity_2m",
        (
            (between(40.0, 60.0), 1),
            (above(80.0), -2),
            (any_of(below(30.0), above(70.0)), -1),
        ),
        0,
        real=True,
    ),
}

WEATHER_CATEGORY = Bands(
    "weather_mood_raw",
    (
        (at_least(7), "excellent"),
        (at_least(3), "good"),
        (at_least(-2), "neutral"),
        (at_least(-6), "poor"),
    ),
    "bad",
)

IDEAL_CONDITIONS, IDEAL_TEMPERATURES = ("sunny",), ("warm", "hot")
BAD_CONDITIONS, BAD_TEMPERATURES = ("rainy", "snowy", "stormy"), ("very_cold", "freezing")
