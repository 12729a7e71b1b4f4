"""Declared schemas of landed and staged data (nothing is inferred from content)."""

from __future__ import annotations

from pyspark.sql import types as T


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in fields])


_text = T.StringType()
_real = T.DoubleType()

_named = _struct(("#text", _text))

TRACK = _struct(
    ("name", _text),
    ("streamable", _text),
    ("date", _struct(("uts", _text), ("#text", _text))),
    ("artist", _named),
    ("album", _named),
)

# One document per pull: the tracks sit two levels down.
MUSIC_PULL = _struct(("recenttracks", _struct(("track", T.ArrayType(TRACK)))))

# The names of landed and staged columns.
# Hourly weather as flat records; wind is only delivered by some pulls. A pull in which one code
# is missing lands all its codes as 3.0, so codes are read as real numbers and cast on staging.
WEATHER_RECORD = _struct(
    ("timestamp", _text),
    ("temperature_2m", _real),
    ("weathercode", _real),
    ("relativehumidity_2m", _real),
    ("cloudcover", _real),
    ("apparent_temperature", _real),
    ("precipitation", _real),
    ("windspeed_10m", _real),
)

# The same readings as one array per variable.
WEATHER_ARRAYS = _struct(
    (
        "hourly",
        _struct(
            ("time", T.ArrayType(_text)),
            ("temperature_2m", T.ArrayType(_real)),
            ("weathercode", T.ArrayType(_real)),
            ("relativehumidity_2m", T.ArrayType(_real)),
            ("cloudcover", T.ArrayType(_real)),
            ("apparent_temperature", T.ArrayType(_real)),
            ("precipitation", T.ArrayType(_real)),
            ("windspeed_10m", T.ArrayType(_real)),
        ),
    )
)

PLAYS = _struct(
    ("track_name", _text),
    ("streamable", _text),
    ("played_at", _text),
    ("played_at_uts", _text),
    ("artist_name", _text),
    ("album_name", _text),
)

METADATA = _struct(
    ("track_id", _text),
    ("artists", _text),
    ("album_name", _text),
    ("track_name", _text),
    ("popularity", T.IntegerType()),
    ("duration_ms", T.LongType()),
    ("explicit", T.BooleanType()),
    ("danceability", _real),
    ("energy", _real),
    ("key", T.IntegerType()),
    ("loudness", _real),
    ("mode", T.IntegerType()),
    ("speechiness", _real),
    ("acousticness", _real),
    ("instrumentalness", _real),
    ("liveness", _real),
    ("valence", _real),
    ("tempo", _real),
    ("time_signature", T.IntegerType()),
    ("track_genre", _text),
)
