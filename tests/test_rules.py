"""Every rule at each edge, next to it, out of range and for NULL."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from skytune.functions import rules
from skytune.functions.bands import clamp

M, MF, W, WF = (
    rules.MUSIC_SCORES,
    rules.MUSIC_SCORES_FIXED,
    rules.WEATHER_SCORES,
    rules.WEATHER_SCORES_FIXED,
)

CASES = [
    (M["energy_score"], "double",
     [(0.0, -3), (0.19, -3), (0.2, -1), (0.39, -1), (0.4, 1), (0.59, 1), (0.6, 3), (0.79, 3),
      (0.8, 5), (1.0, 5), (None, -3)]),
    (M["valence_score"], "double",
     [(0.0, -5), (0.19, -5), (0.2, -2), (0.39, -2), (0.4, 1), (0.59, 1), (0.6, 3), (0.79, 3),
      (0.8, 5), (1.0, 5), (None, -5)]),
    (M["danceability_score"], "double",
     [(0.0, -2), (0.29, -2), (0.3, -1), (0.49, -1), (0.5, 1), (0.69, 1), (0.7, 3), (1.0, 3),
      (None, -2)]),
    (M["tempo_score"], "double",
     [(0.0, -2), (59.9, -2), (60.0, -1), (79.9, -1), (80.0, 1), (99.9, 1), (100.0, 3),
      (140.0, 3), (140.1, 2), (180.0, 2), (180.1, 0), (None, 0)]),
    (M["genre_score"], "string",
     [("pop", 3), ("Pop", 3), ("dance", 3), ("disco", 3), ("FUNK", 3), ("rock", 1),
      ("alternative", 1), ("Indie", 1), ("hip-hop", 2), ("rap", 2), ("r-n-b", 2), ("jazz", 0),
      ("blues", 0), ("classical", -1), ("metal", -2), ("hard-rock", -2), ("sad", -3),
      ("emo", -3), ("ambient", 0), ("", 0), (None, 0)]),
    (M["acousticness_score"], "double",
     [(0.0, 2), (0.19, 2), (0.2, 1), (0.49, 1), (0.5, 0), (0.79, 0), (0.8, -1), (1.0, -1),
      (None, 2)]),
    (M["popularity_score"], "int",
     [(0, 0), (19, 0), (20, -1), (39, -1), (40, 0), (59, 0), (60, 1), (79, 1), (80, 2),
      (100, 2), (None, 0)]),
    (M["time_listening_score"], "int",
     [(h, 2 if 6 <= h <= 10 else 1 if 16 <= h <= 20 else 0) for h in range(24)] + [(None, 0)]),
    (MF["time_listening_score"], "int",
     [(h, 2 if 6 <= h <= 10 else 1 if 16 <= h <= 20 else -1 if h >= 22 or h <= 5 else 0)
      for h in range(24)] + [(None, 0)]),
    (rules.TIME_OF_DAY, "int",
     [(0, "night"), (5, "night"), (6, "morning"), (12, "morning"), (13, "afternoon"),
      (18, "afternoon"), (19, "evening"), (22, "evening"), (23, "night"), (None, "night")]),
    (rules.MUSIC_CATEGORY, "int",
     [(-17, "depressing"), (-7, "depressing"), (-6, "melancholic"), (-3, "melancholic"),
      (-2, "neutral"), (2, "neutral"), (3, "positive"), (6, "positive"), (7, "uplifting"),
      (25, "uplifting")]),
    (rules.WEATHER_CATEGORY, "int",
     [(-17, "bad"), (-7, "bad"), (-6, "poor"), (-3, "poor"), (-2, "neutral"), (2, "neutral"),
      (3, "good"), (6, "good"), (7, "excellent"), (16, "excellent")]),
    (rules.WEATHER_CONDITION, "bigint",
     [(0, "clear"), (1, "mainly_clear"), (2, "partly_cloudy"), (3, "overcast"), (4, "unknown"),
      (45, "foggy"), (48, "foggy"), (51, "drizzle"), (53, "drizzle"), (55, "drizzle"),
      (56, "unknown"), (57, "unknown"), (61, "rainy"), (63, "rainy"), (65, "rainy"),
      (66, "unknown"), (67, "unknown"), (71, "snowy"), (73, "snowy"), (75, "snowy"),
      (77, "snow_grains"), (80, "rain_showers"), (81, "rain_showers"), (82, "rain_showers"),
      (85, "snow_showers"), (86, "snow_showers"), (95, "thunderstorm"),
      (96, "thunderstorm_hail"), (99, "thunderstorm_hail"), (None, "unknown")]),
    (rules.SIMPLE_CONDITION, "bigint",
     [(0, "sunny"), (1, "partly_cloudy"), (2, "partly_cloudy"), (3, "cloudy"), (45, "foggy"),
      (48, "foggy"), (51, "rainy"), (53, "rainy"), (55, "rainy"), (61, "rainy"), (63, "rainy"),
      (65, "rainy"), (80, "rainy"), (81, "rainy"), (82, "rainy"), (71, "snowy"), (73, "snowy"),
      (75, "snowy"), (77, "snowy"), (85, "snowy"), (86, "snowy"), (95, "stormy"),
      (96, "stormy"), (99, "stormy"), (66, "other"), (None, "other")]),
    (rules.TEMPERATURE_CATEGORY, "double",
     [(-1.0, "freezing"), (0.0, "freezing"), (0.1, "very_cold"), (10.0, "very_cold"),
      (10.1, "cold"), (15.0, "cold"), (15.1, "cool"), (20.0, "cool"), (20.1, "warm"),
      (25.0, "warm"), (25.1, "hot"), (30.0, "hot"), (30.1, "very_hot"), (None, "unknown")]),
    (rules.CLOUD_CATEGORY, "double",
     [(0.0, "clear"), (20.0, "clear"), (20.5, "unknown"), (21.0, "partly_cloudy"),
      (50.0, "partly_cloudy"), (50.5, "unknown"), (51.0, "mostly_cloudy"),
      (80.0, "mostly_cloudy"), (80.5, "overcast"), (100.0, "overcast"), (None, "unknown")]),
    (W["temperature_score"], "string",
     [("warm", 5), ("hot", 3), ("very_hot", 2), ("cool", 1), ("cold", -2), ("very_cold", -4),
      ("freezing", -5), ("unknown", 0)]),
    (W["weather_score"], "string",
     [("sunny", 5), ("partly_cloudy", 2), ("cloudy", -2), ("foggy", -3), ("rainy", -4),
      ("snowy", -4), ("stormy", -5), ("other", -1)]),
    (W["cloud_score"], "string",
     [("clear", 3), ("partly_cloudy", 1), ("mostly_cloudy", -1), ("overcast", -3),
      ("unknown", 0)]),
    (W["time_score"], "int",
     [(h, 2 if 10 <= h <= 16 else 1 if h in (7, 8, 9, 17, 18, 19) else 0) for h in range(24)]
     + [(None, 0)]),
    (WF["time_score"], "int",
     [(h, 2 if 10 <= h <= 16 else 1 if h in (7, 8, 9, 17, 18, 19) else -1 if h in (23, *range(7))
       else 0) for h in range(24)] + [(None, 0)]),
    (W["precipitation_penalty"], "double",
     [(-1.0, -1), (0.0, 0), (0.1, -1), (0.99, -1), (1.0, -2), (4.99, -2), (5.0, -3), (50.0, -3),
      (None, -3)]),
    (W["humidity_score"], "double",
     [(29.0, -1), (30.0, 0), (39.0, 0), (40.0, 1), (60.0, 1), (61.0, 0), (70.0, 0), (71.0, -1),
      (80.0, -1), (81.0, -1), (None, 0)]),
    (WF["humidity_score"], "double",
     [(29.0, -1), (30.0, 0), (60.0, 1), (70.0, 0), (71.0, -1), (80.0, -1), (81.0, -2),
      (None, 0)]),
]


@pytest.mark.parametrize("rule, kind, pairs", CASES, ids=lambda v: getattr(v, "source", ""))
def test_rule_edges(rows, rule, kind, pairs):
    df = rows(f"{rule.source} {kind}, want string", *((v, str(w)) for v, w in pairs))
    wrong = df.where(rule.on().cast("string") != F.col("want")).collect()
    assert wrong == []
    assert df.where(rule.on().isNull()).count() == 0


def test_clamp_bounds_and_keeps_null(rows):
    df = rows("raw int", (-17,), (-11,), (-10,), (0,), (10,), (11,), (25,), (None,))
    got = [r[0] for r in df.select(clamp(F.col("raw"), -10, 10)).collect()]
    assert got == [-10, -10, -10, 0, 10, 10, 10, None]


def test_scores_are_integers(rows):
    for rule in (*M.values(), *W.values()):
        kind = {"track_genre": "string", "play_hour": "int", "hour_of_day": "int",
                "popularity": "int"}.get(rule.source, "double")
        kind = "string" if rule.source.endswith(("category", "condition")) else kind
        df = rows(f"{rule.source} {kind}", (None,))
        assert df.select(rule.on().alias("s")).dtypes == [("s", "int")]
