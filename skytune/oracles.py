"""The registered queries in plain SQL, for cross-checking on another engine.

The formulas are deliberately not those of the library: scores are step functions counted
over threshold lists, labels are picked from lists and maps, lags and context are plain
windows, and parsing uses the engine's own date parser.
"""

from __future__ import annotations

from skytune.plans.mart import WEATHER_SIDE
from skytune.plans.music import AUDIO_FEATURES, MUSIC_COLUMNS


def _steps(column: str, *thresholds: float) -> str:
    """How many thresholds the column reaches (none for NULL)."""
    listed = ", ".join(map(str, thresholds))
    return f"len(list_filter([{listed}]::DOUBLE[], lambda t: {column} >= t))"


def _over(column: str, *thresholds: float) -> str:
    listed = ", ".join(map(str, thresholds))
    return f"len(list_filter([{listed}]::DOUBLE[], lambda t: {column} > t))"


def _pick(values: list, index: str) -> str:
    listed = ", ".join(f"'{v}'" if isinstance(v, str) else str(v) for v in values)
    return f"[{listed}][1 + {index}]"


def _lookup(key: str, pairs: dict, default: object) -> str:
    def lit(v: object) -> str:
        return f"'{v}'" if isinstance(v, str) else str(v)

    listed = ", ".join(f"{lit(k)}: {lit(v)}" for k, v in pairs.items())
    return f"coalesce(map {{{listed}}}[{key}], {lit(default)})"


def _by_hour(*runs: tuple[int, int]) -> list[int]:
    return [value for value, hours in runs for _ in range(hours)]


# Code groups and their labels.
_CONDITION = (
    {0: "clear", 1: "mainly_clear", 2: "partly_cloudy", 3: "overcast"}
    | dict.fromkeys((45, 48), "foggy")
    | dict.fromkeys((51, 53, 55), "drizzle")
    | dict.fromkeys((61, 63, 65), "rainy")
    | dict.fromkeys((71, 73, 75), "snowy")
    | {77: "snow_grains"}
    | dict.fromkeys((80, 81, 82), "rain_showers")
    | dict.fromkeys((85, 86), "snow_showers")
    | {95: "thunderstorm", 96: "thunderstorm_hail", 99: "thunderstorm_hail"}
)
_SIMPLE = {
    "clear": "sunny",
    "mainly_clear": "partly_cloudy",
    "partly_cloudy": "partly_cloudy",
    "overcast": "cloudy",
    "foggy": "foggy",
    "drizzle": "rainy",
    "rainy": "rainy",
    "rain_showers": "rainy",
    "snowy": "snowy",
    "snow_grains": "snowy",
    "snow_showers": "snowy",
    "thunderstorm": "stormy",
    "thunderstorm_hail": "stormy",
}
_TEMPERATURES = ["freezing", "very_cold", "cold", "cool", "warm", "hot", "very_hot"]
_TEMPERATURE_SCORE = dict(zip(_TEMPERATURES, (-5, -4, -2, 1, 5, 3, 2)))
_CONDITION_SCORE = {
    "sunny": 5, "partly_cloudy": 2, "cloudy": -2, "foggy": -3, "rainy": -4, "snowy": -4,
    "stormy": -5,
}
_CLOUDS = ["clear", "partly_cloudy", "mostly_cloudy", "overcast"]
_GENRE_SCORE = (
    dict.fromkeys(("pop", "dance", "disco", "funk"), 3)
    | dict.fromkeys(("rock", "alternative", "indie"), 1)
    | dict.fromkeys(("hip-hop", "rap", "r-n-b"), 2)
    | {"classical": -1, "metal": -2, "hard-rock": -2, "sad": -3, "emo": -3}
)

# --- derived frames ------------------------------------------------------------------

READINGS = """
hours AS (SELECT DISTINCT date_trunc('hour', ts) AS hr FROM events),
numbered AS (SELECT hr, (epoch_us(hr) // 3600000000)::BIGINT AS i FROM hours),
readings AS (
  SELECT i AS reading_id,
    CASE WHEN i % 11 <> 0 THEN strftime(hr, '%Y-%m-%dT%H:%M:%SZ') END AS "timestamp",
    CASE WHEN i % 89 <> 0 THEN ((i * 7) % 45 - 8)::DOUBLE + (i % 2)::DOUBLE / 2 END AS temperature_2m,
    CASE WHEN i % 89 <> 0 THEN ((i * 7) % 45 - 10)::DOUBLE END AS apparent_temperature,
    (i * 37) % 104 AS weathercode,
    ((i * 29) % 101)::DOUBLE + CASE WHEN i % 3 = 0 THEN 0.5::DOUBLE ELSE 0::DOUBLE END AS cloudcover,
    CASE WHEN i % 97 <> 0 THEN ((i * 5) % 28)::DOUBLE / 4 END AS precipitation,
    ((i * 17) % 101)::DOUBLE AS relativehumidity_2m,
    CASE WHEN i % 5 <> 0 THEN ((i * 13) % 60)::DOUBLE / 2 END AS windspeed_10m
  FROM numbered)
"""

# The genres of the tracks, by residue.
_GENRES = [
    "pop", "dance", "disco", "funk", "rock", "alternative", "indie", "hip-hop", "rap", "r-n-b",
    "jazz", "blues", "classical", "metal", "hard-rock", "sad", "emo", "Pop", "ambient",
]
_GENRE_LIST = ", ".join([f"'{g}'" for g in _GENRES] + ["NULL"])

TRACKS = f"""
tracks AS (
  SELECT 'T' || p_partkey AS track_id, p_brand AS artists, p_type AS album_name,
    p_name AS track_name,
    CASE WHEN p_partkey % 17 <> 0 THEN ((p_partkey * 13)
      % (1 + (length(p_name) * ascii(p_name) * 7 + ascii(reverse(p_name)) * 31) % 101))::INT
    END AS popularity,
    120000 + (p_partkey * 137) % 240000 AS duration_ms,
    p_partkey % 3 = 0 AS explicit,
    ((p_partkey * 31) % 101)::DOUBLE / 100 AS danceability,
    ((p_partkey * 7) % 101)::DOUBLE / 100 AS energy,
    (p_partkey % 12)::INT AS key,
    (-((p_partkey * 3) % 30))::DOUBLE AS loudness,
    (p_partkey % 2)::INT AS mode,
    ((p_partkey * 5) % 101)::DOUBLE / 100 AS speechiness,
    ((p_partkey * 43) % 101)::DOUBLE / 100 AS acousticness,
    ((p_partkey * 23) % 101)::DOUBLE / 100 AS instrumentalness,
    ((p_partkey * 41) % 101)::DOUBLE / 100 AS liveness,
    ((p_partkey * 19) % 101)::DOUBLE / 100 AS valence,
    (40 + (p_partkey * 11) % 170)::DOUBLE AS tempo,
    (p_partkey % 3 + 3)::INT AS time_signature,
    [{_GENRE_LIST}][p_partkey % 20 + 1] AS track_genre
  FROM part)
"""

PLAYS = """
plays AS (
  SELECT event_id, user_id,
    CASE WHEN event_id % 50 = 7 THEN NULL
      WHEN event_id % 4 = 0 THEN p_name
      WHEN event_id % 4 = 1 THEN upper(p_name)
      WHEN event_id % 4 = 2 THEN '  ' || p_name || ' '
      ELSE p_name || ' (live)' END AS track_name,
    p_brand AS artist_name, p_type AS album_name, (event_id % 2)::VARCHAR AS streamable,
    CASE WHEN event_id % 40 <> 3 THEN strftime(ts, '%d %b %Y, %H:%M') END AS played_at,
    (epoch_us(ts) // 1000000)::VARCHAR AS played_at_uts
  FROM events JOIN part ON event_id % (SELECT count(*) FROM part) = p_partkey)
"""

# --- weather -------------------------------------------------------------------------


def _weather(fixed: bool = False, stamp: str = "strptime(\"timestamp\", '%Y-%m-%dT%H:%M:%SZ')") -> str:
    night = -1 if fixed else 0
    hours = _by_hour((night, 7), (1, 3), (2, 7), (1, 3), (0, 3), (night, 1))
    humid = "WHEN relativehumidity_2m > 80 THEN -2" if fixed else ""
    return f"""
{READINGS},
stamped AS (SELECT *, {stamp} AS moment FROM readings),
labelled AS (
  SELECT *, moment AS timestamp_converted, moment::DATE AS date, hour(moment)::INT AS hour_of_day,
    (dayofweek(moment) + 1)::INT AS day_of_week, month(moment)::INT AS month,
    {_lookup("weathercode", _CONDITION, "unknown")} AS weather_condition,
    CASE WHEN temperature_2m IS NULL THEN 'unknown'
      ELSE {_pick(_TEMPERATURES, _over("temperature_2m", 0, 10, 15, 20, 25, 30))} END
      AS temperature_category,
    CASE WHEN cloudcover IS NULL OR (cloudcover > 20 AND cloudcover < 21)
        OR (cloudcover > 50 AND cloudcover < 51) THEN 'unknown'
      ELSE {_pick(_CLOUDS, _over("cloudcover", 20, 50, 80))} END AS cloud_category
  FROM stamped),
simplified AS (
  SELECT *, {_lookup("weather_condition", _SIMPLE, "other")} AS simplified_condition
  FROM labelled),
components AS (
  SELECT *,
    {_lookup("temperature_category", _TEMPERATURE_SCORE, 0)}::INT AS temperature_score,
    {_lookup("simplified_condition", _CONDITION_SCORE, -1)}::INT AS weather_score,
    {_lookup("cloud_category", dict(zip(_CLOUDS, (3, 1, -1, -3))), 0)}::INT AS cloud_score,
    coalesce({_pick(hours, "hour_of_day")}, 0)::INT AS time_score,
    coalesce(CASE WHEN precipitation = 0 THEN 0 ELSE -1 - (precipitation >= 1)::INT
      - (precipitation >= 5)::INT END, -3)::INT AS precipitation_penalty,
    coalesce(CASE {humid} WHEN abs(relativehumidity_2m - 50) <= 10 THEN 1
      WHEN abs(relativehumidity_2m - 50) > 20 THEN -1 ELSE 0 END, 0)::INT AS humidity_score
  FROM simplified),
summed AS (
  SELECT *, (temperature_score + weather_score + cloud_score + time_score
    + precipitation_penalty + humidity_score)::INT AS weather_mood_raw
  FROM components),
weather AS (
  SELECT *, least(10, greatest(-10, weather_mood_raw))::INT AS weather_mood,
    {_pick(["bad", "poor", "neutral", "good", "excellent"], _steps("weather_mood_raw", -6, -2, 3, 7))}
      AS weather_mood_category,
    weather_mood_raw >= 7 AS is_great_weather_mood,
    weather_mood_raw <= -5 AS is_poor_weather_mood,
    simplified_condition = 'sunny' AND temperature_category IN ('warm', 'hot')
      AS is_ideal_weather_conditions,
    simplified_condition IN ('rainy', 'snowy', 'stormy')
      OR temperature_category IN ('very_cold', 'freezing') AS is_unfavorable_conditions
  FROM summed)
"""


def _gappy(weather: str) -> str:
    """The same with missing values where the landed text has NaN."""
    for formula, modulus in (
        ("((i * 7) % 45 - 8)::DOUBLE + (i % 2)::DOUBLE / 2", 7),
        ("((i * 5) % 28)::DOUBLE / 4", 13),
        ("((i * 17) % 101)::DOUBLE", 6),
        ("((i * 29) % 101)::DOUBLE + CASE WHEN i % 3 = 0 THEN 0.5::DOUBLE ELSE 0::DOUBLE END", 5),
    ):
        weather = weather.replace(formula, f"CASE WHEN i % {modulus} <> 0 THEN {formula} END")
    return weather


_LAGS = """
    lag(weather_mood) OVER o AS prev_hour_weather_mood,
    lag(temperature_2m) OVER o AS prev_hour_temperature"""
_ORDER = "WINDOW o AS (ORDER BY timestamp_converted NULLS FIRST, reading_id)"
_CONTEXT = """
    avg(weather_mood) OVER (PARTITION BY date) AS daily_avg_weather_mood,
    min(temperature_2m) OVER (PARTITION BY date) AS daily_min_temp,
    max(temperature_2m) OVER (PARTITION BY date) AS daily_max_temp"""
_W_RESULT = """reading_id, temperature_score, weather_score, cloud_score, time_score,
  precipitation_penalty, humidity_score, weather_mood_raw, weather_mood, weather_mood_category,
  is_great_weather_mood, is_poor_weather_mood, is_ideal_weather_conditions,
  is_unfavorable_conditions"""
_LOCAL_STAMP = (
    "timezone('UTC', timezone('Europe/Berlin', strptime(\"timestamp\", '%Y-%m-%dT%H:%M:%SZ')))"
)

# --- music ---------------------------------------------------------------------------

_CLEAN = """
cleaned AS (
  SELECT event_id, user_id, track_name, artist_name, album_name, streamable, played_at,
    lower(trim(track_name, ' ' || chr(9) || chr(160))) AS cleaned_track_name,
    lower(trim(artist_name, ' ' || chr(9) || chr(160))) AS cleaned_artist_name,
    try_strptime(played_at, '%d %b %Y, %H:%M') AS played_at_ts
  FROM plays WHERE played_at IS NOT NULL AND track_name IS NOT NULL)
"""


def _best(by_artist: bool = False) -> str:
    keys = "cleaned_track_name" + (", cleaned_artist_name" if by_artist else "")
    artist = ", lower(trim(artists, ' ')) AS cleaned_artist_name" if by_artist else ""
    return f"""
keyed AS (SELECT *, lower(trim(track_name, ' ')) AS cleaned_track_name{artist} FROM tracks),
best AS (
  SELECT * FROM keyed
  QUALIFY row_number() OVER (PARTITION BY {keys}
    ORDER BY popularity DESC NULLS LAST, track_id) = 1)
"""


_FEATURES = ", ".join(f"b.{c}" for c in AUDIO_FEATURES)


def _matched(by_artist: bool = False) -> str:
    artist = " AND p.cleaned_artist_name = b.cleaned_artist_name" if by_artist else ""
    return f"""
{PLAYS}, {TRACKS}, {_CLEAN}, {_best(by_artist)},
matched AS (
  SELECT p.*, {_FEATURES},
    p.played_at_ts::DATE AS play_date, hour(p.played_at_ts)::INT AS play_hour,
    (dayofweek(p.played_at_ts) + 1)::INT AS play_day_of_week,
    month(p.played_at_ts)::INT AS play_month,
    ((b.duration_ms + 300) // 600)::DOUBLE / 100 AS duration_minutes,
    b.track_id IS NOT NULL AS matched_with_metadata
  FROM cleaned p LEFT JOIN best b ON p.cleaned_track_name = b.cleaned_track_name{artist})
"""


def _music(fixed: bool = False) -> str:
    night = -1 if fixed else 0
    hours = _by_hour((night, 6), (2, 5), (0, 5), (1, 5), (0, 1), (night, 2))
    day_parts = ["night"] * 6 + ["morning"] * 7 + ["afternoon"] * 6 + ["evening"] * 4 + ["night"]
    return f"""
{_matched()},
parts AS (
  SELECT *,
    (-3 + 2 * {_steps("energy", 0.2, 0.4, 0.6, 0.8)})::INT AS energy_score,
    {_pick([-5, -2, 1, 3, 5], _steps("valence", 0.2, 0.4, 0.6, 0.8))}::INT AS valence_score,
    {_pick([-2, -1, 1, 3], _steps("danceability", 0.3, 0.5, 0.7))}::INT AS danceability_score,
    (CASE WHEN tempo > 180 THEN 0 WHEN tempo > 140 THEN 2
      ELSE {_pick([-2, -1, 1, 3], _steps("tempo", 60, 80, 100))} END)::INT AS tempo_score,
    {_lookup("lower(track_genre)", _GENRE_SCORE, 0)}::INT AS genre_score,
    {_pick([2, 1, 0, -1], _steps("acousticness", 0.2, 0.5, 0.8))}::INT AS acousticness_score,
    coalesce({_pick(hours, "play_hour")}, 0)::INT AS time_listening_score,
    {_pick([0, -1, 0, 1, 2], _steps("popularity", 20, 40, 60, 80))}::INT AS popularity_score
  FROM matched WHERE matched_with_metadata),
added AS (
  SELECT *, (energy_score + valence_score + danceability_score + tempo_score + genre_score
    + acousticness_score + time_listening_score + popularity_score)::INT AS music_mood_raw
  FROM parts),
music AS (
  SELECT *, least(10, greatest(-10, music_mood_raw))::INT AS music_mood,
    {_pick(["depressing", "melancholic", "neutral", "positive", "uplifting"], _steps("music_mood_raw", -6, -2, 3, 7))}
      AS music_mood_category,
    music_mood_raw >= 7 AS is_uplifting_music, music_mood_raw <= -5 AS is_depressing_music,
    coalesce({_pick(day_parts, "play_hour")}, 'night') AS time_of_day_category
  FROM added)
"""


_M_RESULT = """event_id, energy_score, valence_score, danceability_score, tempo_score, genre_score,
  acousticness_score, time_listening_score, popularity_score, music_mood_raw, music_mood"""
_M_MODEL = f"event_id, {', '.join(MUSIC_COLUMNS)}"

# --- mart ----------------------------------------------------------------------------


def _mart(stamp: str | None = None) -> str:
    weather = _weather(stamp=stamp) if stamp else _weather()
    same = ["album_name", "streamable", *AUDIO_FEATURES, "is_uplifting_music",
            "is_depressing_music"]
    renamed = {
        "Artist_Name": "artist_name", "Content_Name": "track_name", "song_mood": "music_mood",
        "song_mood_category": "music_mood_category", "music_date": "play_date",
        "music_hour": "play_hour", "event_hour": "play_hour",
        "event_day_of_week": "play_day_of_week", "event_month": "play_month",
    } | {f"Event_{e}_Timestamp": "played_at_ts" for e in ("Start", "Received", "End")}
    picked = [f"music.{c}" for c in same] + [f"music.{c} AS {n}" for n, c in renamed.items()]
    picked += [f"weather.{c}" for c in WEATHER_SIDE]
    return f"""
{weather}, {_music()},
mart AS (
  SELECT event_id, {", ".join(picked)},
    minute(played_at_ts)::INT AS music_minute, day(played_at_ts)::INT AS event_day,
    reading_id IS NOT NULL AS has_weather_data, '' AS track_id, 0::INT AS key, 0::INT AS mode,
    0::INT AS time_signature
  FROM music LEFT JOIN weather ON timestamp_converted = date_trunc('hour', played_at_ts)
  WHERE played_at_ts IS NOT NULL)
"""


_LANDED = f"""
{PLAYS},
landed AS (
  SELECT track_name, streamable, played_at, played_at_uts, artist_name, album_name
  FROM plays WHERE track_name IS NOT NULL
  UNION ALL
  SELECT track_name, streamable, NULL, NULL, artist_name, album_name
  FROM plays WHERE event_id % 10 = 0)
"""

# Landed tracks with the pull that holds them; the first pull of a track stores it.
_PULLED = f"""
{PLAYS},
tracks_of AS (
  SELECT event_id, track_name, streamable, played_at, played_at_uts, artist_name, album_name
  FROM plays WHERE track_name IS NOT NULL
  UNION ALL
  SELECT event_id, track_name, streamable, NULL, NULL, artist_name, album_name
  FROM plays WHERE event_id % 10 = 0),
pulled AS (
  SELECT DISTINCT t.* EXCLUDE (event_id), p.pull_day
  FROM tracks_of t JOIN (VALUES ('2024-02-01', 1), ('2024-02-02', 2), ('2024-02-03', 3))
    AS p(pull_day, number)
  ON CASE number WHEN 1 THEN event_id % 3 <> 2 WHEN 2 THEN event_id % 3 <> 0
    ELSE event_id % 5 = 0 END),
stored AS (
  SELECT * EXCLUDE (pull_day), min(pull_day) AS pull_day FROM pulled GROUP BY ALL)
"""

_AVERAGED = ("danceability", "energy", "valence", "tempo", "loudness", "speechiness",
             "acousticness", "instrumentalness", "liveness")


def _averages(groups: str) -> str:
    means = ", ".join(f"round(avg({c}), 6) AS avg_{c}" for c in _AVERAGED)
    return f"""WITH {_matched()}
SELECT {groups}, count(*) AS matched_plays, {means}
FROM matched WHERE matched_with_metadata AND played_at_ts IS NOT NULL GROUP BY {groups}"""


def _profile() -> str:
    kinds = {
        "event_id": "bigint", "user_id": "bigint", "track_name": "string",
        "artist_name": "string", "album_name": "string", "streamable": "string",
        "played_at": "string", "played_at_uts": "string",
    }
    rows = [
        f"""SELECT '{name}' AS column_name, '{kind}' AS data_type, count(*) AS row_count,
  count({name}) AS non_null_count, count(*) - count({name}) AS null_count FROM plays"""
        for name, kind in kinds.items()
    ]
    return f"WITH {PLAYS} " + " UNION ALL ".join(rows)


_PREDICTED = f"""{_mart()},
predicted AS (
  SELECT (song_mood + weather_mood)::DOUBLE / 2 AS actual, song_mood::DOUBLE AS prediction
  FROM mart WHERE weather_mood IS NOT NULL)
"""

_DEVIATION = """round(CASE WHEN stddev_samp({c}) OVER b > 0
    THEN ({c} - avg({c}) OVER b) / stddev_samp({c}) OVER b END, 4) AS {c}_deviation"""

ORACLES: dict[str, str] = {
    "weather_category_counts": f"""WITH {_weather()}
SELECT weather_mood_category, count(*) AS hours, min(weather_mood_raw) AS min_raw,
  max(weather_mood_raw) AS max_raw FROM weather GROUP BY 1""",
    "weather_decoded": f"""WITH {_weather()}
SELECT reading_id, timestamp_converted, date, hour_of_day, day_of_week, month,
  weather_condition, simplified_condition, temperature_category, cloud_category FROM weather""",
    "weather_scores": f"WITH {_weather()} SELECT {_W_RESULT} FROM weather",
    "weather_scores_fixed_ranges": f"WITH {_weather(fixed=True)} SELECT {_W_RESULT} FROM weather",
    "weather_local_clock": f"""WITH {_weather(stamp=_LOCAL_STAMP)}
SELECT reading_id, timestamp_converted, date, hour_of_day, weather_mood FROM weather""",
    "weather_lag": f"""WITH {_weather()}
SELECT reading_id, weather_mood, {_LAGS} FROM weather {_ORDER}""",
    "weather_daily_context": f"""WITH {_weather()}
SELECT reading_id, date, {_CONTEXT} FROM weather""",
    "weather_model": f"""WITH {_weather()}
SELECT {_W_RESULT}, "timestamp", timestamp_converted, temperature_2m, apparent_temperature,
  weathercode, weather_condition, simplified_condition, cloudcover, cloud_category, precipitation,
  relativehumidity_2m, date, hour_of_day, day_of_week, month, temperature_category,
  {_LAGS}, {_CONTEXT}
FROM weather {_ORDER}""",
    "played_at_parse": f"WITH {PLAYS}, {_CLEAN} SELECT event_id, played_at, played_at_ts FROM cleaned",
    "played_at_all_months": """
SELECT o_orderkey,
  strftime(o_orderdate + to_minutes(o_orderkey * 37 % 1440), '%d %b %Y, %H:%M') AS played_at,
  date_trunc('minute', o_orderdate + to_minutes(o_orderkey * 37 % 1440)) AS played_at_ts
FROM orders""",
    "match_keys": f"""WITH {PLAYS}
SELECT lower(trim(track_name, ' ')) AS track_key, lower(trim(artist_name, ' ')) AS artist_key,
  count(*) AS plays FROM plays GROUP BY 1, 2""",
    "metadata_best": f"""WITH {TRACKS}, {_best()}
SELECT track_id, track_name, artists, {", ".join(AUDIO_FEATURES)}, cleaned_track_name FROM best""",
    "metadata_best_by_artist": f"""WITH {TRACKS}, {_best(by_artist=True)}
SELECT track_id, track_name, artists, {", ".join(AUDIO_FEATURES)}, cleaned_track_name,
  cleaned_artist_name FROM best""",
    "plays_matched": f"WITH {_matched()} SELECT * FROM matched",
    "plays_matched_by_artist": f"WITH {_matched(by_artist=True)} SELECT * FROM matched",
    "music_scores": f"WITH {_music()} SELECT {_M_RESULT} FROM music",
    "music_scores_fixed_ranges": f"WITH {_music(fixed=True)} SELECT {_M_RESULT} FROM music",
    "music_categories": f"""WITH {_music()}
SELECT music_mood_category, time_of_day_category, is_uplifting_music, is_depressing_music,
  count(*) AS plays, sum(music_mood)::BIGINT AS mood_sum FROM music GROUP BY 1, 2, 3, 4""",
    "music_model": f"WITH {_music()} SELECT {_M_MODEL} FROM music",
    "music_by_epoch": """
SELECT event_id, (epoch_us(ts) // 1000000)::VARCHAR AS played_at_uts,
  date_trunc('second', ts) AS played_at_ts
FROM events JOIN part ON event_id % (SELECT count(*) FROM part) = p_partkey
WHERE event_id % 40 <> 3 AND event_id % 50 <> 7""",
    "combined_mart": f"WITH {_mart()} SELECT * FROM mart",
    "combined_mart_local_clock": f"""WITH {_mart(_LOCAL_STAMP)}
SELECT music_date, has_weather_data, count(*) AS plays, sum(song_mood)::BIGINT AS song_mood_sum,
  sum(weather_mood)::BIGINT AS weather_mood_sum FROM mart GROUP BY 1, 2""",
    "landing_flatten": f"WITH {_LANDED} SELECT * FROM landed",
    "staged_plays": f"WITH {_LANDED} SELECT DISTINCT * FROM landed",
    "weather_records": f"""WITH {READINGS}
SELECT "timestamp", temperature_2m, weathercode, relativehumidity_2m, cloudcover,
  apparent_temperature, precipitation, windspeed_10m FROM readings""",
    "hourly_arrays": f"""WITH {READINGS}
SELECT strftime(make_timestamp(reading_id * 3600000000), '%Y-%m-%dT%H:%M:%SZ') AS "timestamp",
  temperature_2m, weathercode, relativehumidity_2m, cloudcover, apparent_temperature,
  precipitation, windspeed_10m FROM readings""",
    "positional_variables": f"""WITH {READINGS},
days AS (SELECT DISTINCT reading_id // 24 AS day_no FROM readings),
slots AS (SELECT day_no * 24 + unnest(generate_series(0, 23)) AS reading_id FROM days)
SELECT strftime(make_timestamp(s.reading_id * 3600000000), '%Y-%m-%dT%H:%M:%SZ') AS "timestamp",
  temperature_2m, apparent_temperature, cloudcover, relativehumidity_2m, precipitation, weathercode
FROM slots s LEFT JOIN readings r ON r.reading_id = s.reading_id""",
    "records_json": f"""WITH {READINGS}
SELECT '{{"reading_id":' || reading_id || ',"timestamp":'
  || coalesce('"' || "timestamp" || '"', 'null') || ',"weathercode":' || weathercode || '}}'
  AS record FROM readings""",
    "time_axis_per_user": """
WITH spans AS (
  SELECT user_id, epoch_us(min(ts)) // 1000000 AS lo, epoch_us(max(ts)) // 1000000 AS hi
  FROM events GROUP BY user_id),
ticks AS (
  SELECT user_id, unnest(generate_series(lo, hi - 1, 21600)) AS second FROM spans WHERE hi > lo)
SELECT user_id, make_timestamp((second * 1000000)::BIGINT) AS tick FROM ticks""",
    "local_day_window": """
SELECT event_id, ts FROM events
WHERE ts >= TIMESTAMP '2024-01-09 23:00:00' AND ts < TIMESTAMP '2024-01-10 23:00:00'""",
    "local_days": """
WITH zoned AS (SELECT timezone('Europe/Berlin', timezone('UTC', ts))::DATE AS local_day FROM events)
SELECT local_day, count(*) AS events,
  epoch(timezone('Europe/Berlin', local_day::TIMESTAMP))::BIGINT AS first_second,
  epoch(timezone('Europe/Berlin', (local_day + 1)::TIMESTAMP))::BIGINT - 1 AS last_second
FROM zoned GROUP BY local_day""",
    "timestamp_text": """
SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%SZ') AS text, date_trunc('second', ts) AS utc,
  timezone('UTC', timezone('Europe/Berlin', date_trunc('second', ts))) AS from_local,
  date_trunc('second', ts) AS from_epoch
FROM events""",
    "recent_topk": """
SELECT event_id, ts, user_id FROM events ORDER BY ts DESC, event_id DESC LIMIT 200""",
    "recent_topk_per_user": """
SELECT event_id, ts, user_id FROM events
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) <= 50""",
    "distinct_rows": "SELECT DISTINCT user_id, event_type, ts::DATE AS day FROM events",
    "profile": _profile(),
    "preview": f"""WITH {_music()}
SELECT event_id, track_name, played_at_ts, music_mood FROM music
ORDER BY played_at_ts NULLS FIRST, event_id LIMIT 5""",
    "materialise": f"""WITH {_mart()}
SELECT event_id, Event_Start_Timestamp, Content_Name, song_mood, weather_mood, has_weather_data
FROM mart""",
    "row_counts": f"""WITH {_music()}
SELECT 'plays' AS stage, count(*) AS rows FROM plays
UNION ALL SELECT 'cleaned', count(*) FROM cleaned
UNION ALL SELECT 'matched', count(*) FROM matched
UNION ALL SELECT 'scored', count(*) FROM music""",
    # The daily load removes duplicate documents, and sees only plays of one local day.
    "daily_load": f"""WITH {_mart()},
day_plays AS (
  SELECT DISTINCT m.Content_Name, m.Artist_Name, m.album_name, m.streamable,
    p.played_at, p.played_at_uts, m.music_date, m.music_hour, m.has_weather_data, m.song_mood
  FROM mart m JOIN plays p ON p.event_id = m.event_id
    AND p.played_at = strftime(m.Event_Start_Timestamp, '%d %b %Y, %H:%M')
  WHERE p.played_at_uts::BIGINT BETWEEN epoch(TIMESTAMP '2024-01-09 23:00:00')::BIGINT
    AND epoch(TIMESTAMP '2024-01-10 22:59:59')::BIGINT)
SELECT music_date, music_hour, has_weather_data, count(*) AS plays,
  sum(song_mood)::BIGINT AS song_mood_sum FROM day_plays GROUP BY 1, 2, 3""",
    "incremental_plays": f"""WITH {_PULLED}
SELECT * EXCLUDE (pull_day), timezone('Europe/Berlin', timezone('UTC',
  make_timestamp(played_at_uts::BIGINT * 1000000)))::DATE AS local_date FROM stored""",
    "load_manifest": f"""WITH {_PULLED},
landed AS (SELECT pull_day, count(*) AS staged FROM pulled GROUP BY 1),
new AS (SELECT pull_day, count(*) AS fresh, count(*) FILTER (played_at_uts IS NULL) AS undated
  FROM stored GROUP BY 1)
SELECT pull_day, staged, coalesce(fresh, 0) AS fresh, staged - coalesce(fresh, 0) AS known,
  coalesce(undated, 0) AS undated
FROM landed LEFT JOIN new USING (pull_day)""",
    "incremental_mart": f"""WITH {_mart()},
once AS (
  SELECT DISTINCT m.Content_Name, m.Artist_Name, m.album_name, m.streamable,
    p.played_at, p.played_at_uts, m.music_date, m.music_hour, m.has_weather_data, m.song_mood
  FROM mart m JOIN plays p ON p.event_id = m.event_id
    AND p.played_at = strftime(m.Event_Start_Timestamp, '%d %b %Y, %H:%M'))
SELECT music_date, music_hour, has_weather_data, count(*) AS plays,
  sum(song_mood)::BIGINT AS song_mood_sum FROM once GROUP BY 1, 2, 3""",
    "incremental_daily_music": f"""WITH {_music()},
once AS (
  SELECT DISTINCT m.track_name, m.artist_name, m.album_name, m.streamable, p.played_at,
    p.played_at_uts, m.play_date AS date, m.music_mood, m.music_mood_category
  FROM music m JOIN plays p ON p.event_id = m.event_id
  WHERE m.play_date IS NOT NULL AND p.played_at IS NOT NULL),
labels AS (
  SELECT date, music_mood_category AS dominant_music_mood_category FROM once GROUP BY 1, 2
  QUALIFY row_number() OVER (PARTITION BY date ORDER BY count(*) DESC, music_mood_category) = 1)
SELECT date, count(*) AS plays, round(avg(music_mood), 6) AS avg_music_mood,
  min(music_mood) AS min_music_mood, max(music_mood) AS max_music_mood,
  any_value(dominant_music_mood_category) AS dominant_music_mood_category
FROM once JOIN labels USING (date) GROUP BY 1""",
    "listening_hourly": f"""WITH {_matched()},
hourly AS (
  SELECT user_id, play_date, play_hour, count(*) AS plays,
    count(DISTINCT cleaned_track_name) AS distinct_tracks,
    count(DISTINCT cleaned_artist_name) AS distinct_artists,
    coalesce(sum(duration_ms), 0)::DOUBLE AS ms
  FROM matched WHERE played_at_ts IS NOT NULL GROUP BY 1, 2, 3)
SELECT user_id, play_date, play_hour, plays, distinct_tracks, distinct_artists,
  round(ms / 60000, 6) AS minutes, round(ms / 3600000, 6) AS intensity,
  round(plays / avg(plays) OVER (PARTITION BY user_id, play_date), 6) AS relative_intensity
FROM hourly""",
    "listening_cumulative": f"""WITH {_matched()},
running AS (
  SELECT user_id, play_date, played_at_ts AS play_minute,
    count(*) OVER (PARTITION BY user_id, play_date ORDER BY played_at_ts) AS cumulative_plays
  FROM matched WHERE played_at_ts IS NOT NULL)
SELECT user_id, play_date, play_minute, count(*) AS plays, max(cumulative_plays) AS cumulative_plays
FROM running GROUP BY 1, 2, 3""",
    "listening_features_hour": _averages("user_id, play_date, play_hour"),
    "listening_features_day": _averages("user_id, play_date"),
    "late_features_hour": _averages("user_id, play_date, play_hour"),
    "late_features_day": _averages("user_id, play_date"),
    "listening_deviation": f"""WITH {_music()},
daily AS (
  SELECT user_id, play_date, count(*) AS plays, avg(music_mood) AS mood
  FROM music WHERE played_at_ts IS NOT NULL GROUP BY 1, 2)
SELECT user_id, play_date, plays, round(mood, 4) AS mood, {_DEVIATION.format(c="plays")},
  {_DEVIATION.format(c="mood")}
FROM daily WINDOW b AS (PARTITION BY user_id ORDER BY play_date ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING)""",
    "daily_mood": f"""WITH {_weather()}, {_music()},
w AS (
  SELECT date, count(*) AS hours, round(avg(weather_mood), 6) AS avg_weather_mood,
    min(weather_mood) AS min_weather_mood, max(weather_mood) AS max_weather_mood,
    round(avg(temperature_2m), 6) AS avg_temperature_2m
  FROM weather WHERE date IS NOT NULL GROUP BY date),
wl AS (
  SELECT date, weather_mood_category AS dominant_weather_mood_category FROM weather
  GROUP BY 1, 2
  QUALIFY row_number() OVER (PARTITION BY date ORDER BY count(*) DESC, weather_mood_category) = 1),
m AS (
  SELECT play_date AS date, count(*) AS plays, round(avg(music_mood), 6) AS avg_music_mood,
    min(music_mood) AS min_music_mood, max(music_mood) AS max_music_mood
  FROM music WHERE play_date IS NOT NULL GROUP BY 1),
ml AS (
  SELECT play_date AS date, music_mood_category AS dominant_music_mood_category FROM music
  GROUP BY 1, 2
  QUALIFY row_number() OVER (PARTITION BY play_date ORDER BY count(*) DESC, music_mood_category) = 1)
SELECT date, hours, avg_weather_mood, min_weather_mood, max_weather_mood,
  dominant_weather_mood_category, avg_temperature_2m, plays, avg_music_mood, min_music_mood,
  max_music_mood, dominant_music_mood_category
FROM (w JOIN wl USING (date)) FULL JOIN (m JOIN ml USING (date)) USING (date)""",
    # The stream keeps one copy per event, and emits hours the watermark has passed.
    "stream_hourly": f"""WITH {_mart()},
once AS (
  SELECT * FROM mart
  QUALIFY row_number() OVER (PARTITION BY event_id ORDER BY Event_Start_Timestamp) = 1)
SELECT date_trunc('hour', Event_Start_Timestamp) AS window_start, count(*) AS plays,
  sum(song_mood)::BIGINT AS mood_sum, sum(duration_ms)::BIGINT AS played_ms,
  max(weather_mood) AS weather_mood
FROM once GROUP BY 1
HAVING date_trunc('hour', Event_Start_Timestamp) + INTERVAL 1 HOUR
  <= (SELECT max(Event_Start_Timestamp) - INTERVAL 1 HOUR FROM mart)""",
    "csv_roundtrip": f"""WITH {_mart()}
SELECT danceability, energy, valence, tempo, loudness, popularity, duration_ms, speechiness,
  acousticness, instrumentalness, liveness, song_mood, weather_mood, temperature_2m,
  apparent_temperature, cloudcover, precipitation, relativehumidity_2m, music_hour, music_minute,
  event_hour, event_day_of_week, event_month, event_day, key, mode, time_signature,
  event_hour AS hour, (song_mood + weather_mood)::DOUBLE / 2 AS combined_mood
FROM mart""",
    "metadata_csv": f"""WITH {TRACKS} SELECT * REPLACE (
  track_name || ' "live, ' || artists || '"' AS track_name) FROM tracks""",
    "weather_gaps": f"""WITH {_gappy(_weather())}
SELECT "timestamp", weathercode, temperature_category, cloud_category, temperature_score,
  cloud_score, humidity_score, precipitation_penalty, weather_mood_raw FROM weather""",
    "reject_counts": f"""WITH {PLAYS}
SELECT count(*) AS documents, count(*) FILTER (event_id % 25 < 2) AS rejected,
  (sum((track_name IS NOT NULL)::INT + (event_id % 10 = 0)::INT)
    FILTER (event_id % 25 >= 2))::BIGINT AS tracks,
  (sum((track_name IS NOT NULL AND played_at IS NULL)::INT + (event_id % 10 = 0)::INT)
    FILTER (event_id % 25 >= 2))::BIGINT AS undated
FROM plays""",
    "empty_guard": "SELECT count(*) AS rows, false AS replaced FROM events",
    "rf_checks": f"""WITH {_weather()}
SELECT count(*) AS test_rows, 18::BIGINT AS features, 1.0::DOUBLE AS importance, true AS fits,
  true AS reloaded_same
FROM weather WHERE temperature_2m IS NOT NULL AND apparent_temperature IS NOT NULL
  AND precipitation IS NOT NULL AND moment IS NOT NULL AND windspeed_10m IS NOT NULL
  AND ('0x' || substr(md5(reading_id::VARCHAR), 1, 8))::BIGINT % 100 >= 80""",
    "split_md5": f"""WITH {_mart()},
b AS (SELECT event_id, (('0x' || substr(md5(event_id::VARCHAR), 1, 8))::BIGINT % 100)::INT AS bucket FROM mart)
SELECT event_id, bucket, bucket < 80 AS is_train FROM b""",
    "regression_metrics": f"""WITH {_PREDICTED}
SELECT count(*) AS n, round(avg((actual - prediction) ** 2), 6) AS mse,
  round(1 - sum((actual - prediction) ** 2) / sum((actual - m) ** 2), 6) AS r2
FROM predicted, (SELECT avg(actual) AS m FROM predicted)""",
    "residual_bins": f"""WITH {_PREDICTED}
SELECT floor(actual)::DOUBLE AS actual_bin, count(*) AS n,
  round(avg(prediction), 6) AS mean_prediction, round(avg(prediction - actual), 6) AS mean_error
FROM predicted GROUP BY 1""",
}

# Metadata by way of files is the same metadata.
ORACLES["music_from_file"] = ORACLES["music_model"]
