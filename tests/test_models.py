from __future__ import annotations

import pytest
from conftest import TABLES, executed
from pyspark.sql import functions as F

from skytune import adapters, registry
from skytune.plans.mart import MART_COLUMNS, combined_mood
from skytune.plans.music import (
    MUSIC_COLUMNS,
    best_metadata,
    clean_plays,
    match_plays,
    music_mood,
    score_music,
)
from skytune.plans.weather import WEATHER_COLUMNS, hourly_weather_mood, weather_mood
from skytune.schemas import METADATA, PLAYS, WEATHER_RECORD
from skytune.sources.scans import whole


def _plays(spark, *values):
    return spark.createDataFrame(
        [(t, "1", at, uts, artist, "album") for t, at, uts, artist in values], PLAYS
    )


def _metadata(spark, *entries):
    base = dict.fromkeys(METADATA.names)
    return spark.createDataFrame([{**base, **e} for e in entries], METADATA)


GOOD = dict(track_id="T1", track_name="Blue", artists="A", popularity=90, duration_ms=200_000,
            energy=0.9, valence=0.9, danceability=0.9, tempo=120.0, track_genre="pop",
            acousticness=0.1)
BAD = dict(track_id="T2", track_name="Grey", artists="B", popularity=30, duration_ms=60_300,
           energy=0.0, valence=0.0, danceability=0.0, tempo=40.0, track_genre="sad",
           acousticness=0.9)


def test_music_extremes_are_clamped_and_labelled(spark):
    plays = _plays(spark, (" BLUE ", "08 Dec 2025, 07:00", None, "A"),
                   ("grey", "08 Dec 2025, 23:00", None, "B"),
                   ("unknown", "08 Dec 2025, 23:00", None, "B"),
                   (None, "08 Dec 2025, 23:00", None, "B"), ("blue", None, None, "A"))
    got = {r.track_name: r for r in music_mood(plays, _metadata(spark, GOOD, BAD)).collect()}
    assert set(got) == {" BLUE ", "grey"}
    high, low = got[" BLUE "], got["grey"]
    assert (high.music_mood_raw, high.music_mood, high.music_mood_category) == (25, 10, "uplifting")
    assert (high.is_uplifting_music, high.is_depressing_music) == (True, False)
    assert (low.music_mood_raw, low.music_mood, low.music_mood_category) == (-17, -10, "depressing")
    assert (low.is_uplifting_music, low.is_depressing_music) == (False, True)
    assert (high.duration_minutes, low.duration_minutes) == (3.33, 1.01)
    assert (high.play_day_of_week, high.play_hour, high.play_month) == (2, 7, 12)  # a Monday


def test_unparsed_time_stays_in_music_but_not_in_mart(spark):
    plays = _plays(spark, ("blue", "31 Feb 2025, 07:00", None, "A"))
    music = music_mood(plays, _metadata(spark, GOOD))
    row = music.first()
    assert (row.played_at_ts, row.time_listening_score, row.time_of_day_category) == (None, 0, "night")
    weather = hourly_weather_mood(spark.createDataFrame([], WEATHER_RECORD))
    assert combined_mood(music, weather).isEmpty()


def test_options(spark):
    other = GOOD | {"track_id": "T3", "artists": "B", "popularity": 99, "energy": 0.0}
    metadata = _metadata(spark, GOOD, other)
    plays = _plays(spark, ("blue", "08 Dec 2025, 23:10", "1765148999", " a "))
    assert music_mood(plays, metadata).first().energy == 0.0
    assert music_mood(plays, metadata, match_artist=True).first().energy == 0.9
    assert music_mood(plays, metadata).first().time_listening_score == 0
    assert music_mood(plays, metadata, fix_ranges=True).first().time_listening_score == -1
    exact = music_mood(plays, metadata, use_epoch=True).first().played_at_ts
    assert (exact.hour, exact.minute, exact.second) == (23, 9, 59)


def test_every_play_is_matched_at_most_once(spark):
    metadata = _metadata(spark, GOOD, GOOD | {"track_id": "T0"}, GOOD | {"popularity": None})
    plays = _plays(spark, ("blue", "08 Dec 2025, 23:10", None, "A"), ("red", "08 Dec 2025, 23:10", None, "A"))
    matched = match_plays(clean_plays(plays), best_metadata(metadata))
    assert {(r.track_name, r.matched_with_metadata) for r in matched.collect()} == {
        ("blue", True), ("red", False)}
    assert matched.count() == 2


def _weather(spark, *entries):
    """Readings as the scan stages them: codes land as real numbers."""
    base = dict.fromkeys(WEATHER_RECORD.names)
    landed = spark.createDataFrame([{**base, **e} for e in entries], WEATHER_RECORD)
    return landed.withColumn("weathercode", whole(F.col("weathercode")))


BEST = dict(temperature_2m=22.0, weathercode=0.0, cloudcover=0.0, precipitation=0.0,
            relativehumidity_2m=50.0)
WORST = dict(temperature_2m=-5.0, weathercode=95.0, cloudcover=100.0, precipitation=9.0,
             relativehumidity_2m=95.0)


def test_weather_extremes(spark):
    df = _weather(spark, BEST | {"timestamp": "2025-12-08T12:00:00Z"},
                  WORST | {"timestamp": "2025-12-08T02:00:00Z"}, {"timestamp": None})
    got = {r.timestamp: r for r in weather_mood(df).collect()}
    best, worst = got["2025-12-08T12:00:00Z"], got["2025-12-08T02:00:00Z"]
    assert (best.weather_mood_raw, best.weather_mood, best.weather_mood_category) == (16, 10, "excellent")
    assert (worst.weather_mood_raw, worst.weather_mood, worst.weather_mood_category) == (-17, -10, "bad")
    assert best.is_ideal_weather_conditions and not best.is_unfavorable_conditions
    assert worst.is_unfavorable_conditions and worst.is_poor_weather_mood
    assert (best.prev_hour_weather_mood, best.prev_hour_temperature) == (-10, -5.0)
    assert (best.daily_avg_weather_mood, best.daily_min_temp, best.daily_max_temp) == (0.0, -5.0, 22.0)
    assert got[None].weather_condition == "unknown"


def test_weather_locations_do_not_mix(spark):
    df = _weather(spark, *(BEST | {"timestamp": f"2025-12-0{d}T{h:02d}:00:00Z"}
                           for d in (8, 9) for h in (1, 2)))
    df = df.withColumn("place", F.lit("a")).unionByName(
        df.withColumns({"place": F.lit("b"), "temperature_2m": F.lit(-1.0)}))
    got = weather_mood(df, keys=["place"]).where("prev_hour_temperature <> temperature_2m")
    assert got.isEmpty()
    assert weather_mood(df, keys=["place"]).where("prev_hour_temperature IS NULL").count() == 2


def test_wind_passes_through(spark):
    df = _weather(spark, BEST | {"timestamp": "2025-12-08T12:00:00Z", "windspeed_10m": 7.5})
    assert weather_mood(df, keep=["windspeed_10m"]).first().windspeed_10m == 7.5


def test_mart_fans_out_and_flags_missing_weather(spark):
    plays = _plays(spark, ("blue", "08 Dec 2025, 12:30", None, "A"), ("blue", "08 Dec 2025, 13:30", None, "A"))
    hour = BEST | {"timestamp": "2025-12-08T12:00:00Z"}
    weather = hourly_weather_mood(_weather(spark, hour, hour))
    mart = combined_mood(music_mood(plays, _metadata(spark, GOOD)), weather)
    got = [(r.music_hour, r.has_weather_data, r.weather_mood) for r in mart.collect()]
    assert sorted(got) == [(12, True, 10), (12, True, 10), (13, False, None)]
    row = mart.first()
    assert (row.track_id, row.key, row["mode"], row.time_signature) == ("", 0, 0, 0)


def test_output_columns():
    assert (len(WEATHER_COLUMNS), len(MUSIC_COLUMNS), len(MART_COLUMNS)) == (34, 38, 48)


def test_local_clock_shifts_weather(spark):
    df = _weather(spark, BEST | {"timestamp": "2025-12-08T12:00:00Z"},
                  BEST | {"timestamp": "2025-07-08T12:00:00Z"})
    hours = [r.hour_of_day for r in hourly_weather_mood(df, weather_tz="Europe/Berlin").collect()]
    assert hours == [11, 10]


def test_strict_weather_raises(spark):
    df = _weather(spark, {"timestamp": "yesterday"})
    assert hourly_weather_mood(df).first().date is None
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        hourly_weather_mood(df, strict=True).collect()
    for text in ("05:31:00", "2025-02-31T00:00:00Z"):
        with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
            hourly_weather_mood(_weather(spark, {"timestamp": text}), strict=True).collect()
    good = _weather(spark, {"timestamp": " 2025-12-08T12:00:00Z"}, {"timestamp": None})
    kept = {r.timestamp: r.hour_of_day for r in hourly_weather_mood(good, strict=True).collect()}
    assert kept == {" 2025-12-08T12:00:00Z": 12, None: None}


# --- plans -----------------------------------------------------------------------------


def test_mart_plan(spark):
    """Match filter turns the title join inner, unused weather windows are gone, and no row
    set is gathered in one partition (the row count of parts, a scalar, aside)."""
    plan = executed(registry.QUERIES["combined_mart"](spark, TABLES))
    body = plan.split("== Initial Plan ==")[0]
    assert "LeftOuter" in body and "Inner" in body
    joins = [line for line in body.split("\n") if "Join" in line and "cleaned_track_name" in line]
    assert joins and all("Inner" in line for line in joins)
    assert "lag(" not in body and "max_by" not in body
    assert body.count("row_number()") <= 3  # keep-best only


def test_staged_plays_filter_reaches_the_scan(spark, tmp_path):
    plays = adapters.plays(adapters.events(spark, TABLES), adapters.table(spark, TABLES, "part"))
    plays.write.parquet(str(tmp_path / "plays"))
    cleaned = clean_plays(spark.read.parquet(str(tmp_path / "plays"))).select("played_at_ts")
    plan = executed(cleaned)
    assert "PushedFilters: [IsNotNull(played_at), IsNotNull(track_name)]" in plan
    assert "ReadSchema: struct<track_name:string,played_at:string>" in plan


def test_scoring_needs_no_shuffle(spark):
    matched = match_plays(
        clean_plays(_plays(spark, ("blue", "08 Dec 2025, 12:30", None, "A"))),
        best_metadata(_metadata(spark, GOOD)),
    )
    before, after = executed(matched), executed(score_music(matched))
    assert after.count("Exchange hashpartitioning") <= before.count("Exchange hashpartitioning")
