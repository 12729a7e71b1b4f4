"""Listening metrics against a row-by-row recomputation."""

from __future__ import annotations

import collections
import statistics

import pytest
from conftest import TABLES

from skytune import registry
from skytune.plans import listening


@pytest.fixture(scope="module")
def matched(spark):
    return registry.Frames(registry.prepare(spark), TABLES).matched().cache()


@pytest.fixture(scope="module")
def plays(matched):
    return [r for r in matched.collect() if r.played_at_ts]


def test_hourly(matched, plays):
    hours = collections.defaultdict(list)
    for r in plays:
        hours[r.user_id, r.play_date, r.play_hour].append(r)
    per_day = collections.defaultdict(list)
    for (u, d, _), rs in hours.items():
        per_day[u, d].append(len(rs))
    got = {(r.user_id, r.play_date, r.play_hour): r
           for r in listening.hourly_listening(matched).collect()}
    assert got.keys() == hours.keys()
    for key, rs in hours.items():
        row = got[key]
        ms = sum(r.duration_ms or 0 for r in rs)
        assert row.plays == len(rs)
        assert row.distinct_tracks == len({r.cleaned_track_name for r in rs})
        assert row.distinct_artists == len({r.cleaned_artist_name for r in rs})
        assert row.minutes == pytest.approx(ms / 60000)
        assert row.intensity == pytest.approx(ms / 3600000)
        assert row.relative_intensity == pytest.approx(len(rs) / statistics.mean(per_day[key[:2]]))


def test_cumulative(matched, plays):
    got = listening.cumulative_listening(matched).collect()
    for row in got[::17]:
        mine = [r.played_at_ts for r in plays
                if (r.user_id, r.play_date) == (row.user_id, row.play_date)]
        assert row.cumulative_plays == sum(t <= row.play_minute for t in mine)
        assert row.plays == mine.count(row.play_minute)
    assert sum(r.plays for r in got) == len(plays)


def test_played_ms_prefers_the_event(rows):
    df = rows("play_ms bigint, duration_ms bigint", (5, 9), (None, 9))
    assert [r[0] for r in df.select(listening.played_ms(df)).collect()] == [5, 9]


def test_deviation_frame(rows, spark):
    data = [(1, f"2024-01-{d:02d}", mood) for d in range(1, 11) for mood in [d] * (1 + d % 3)]
    music = spark.createDataFrame(data, "user_id int, play_date string, music_mood int")
    music = music.withColumn("played_at_ts", music.play_date.cast("timestamp"))
    got = {r.play_date: r for r in listening.baseline_deviation(music).collect()}
    counts = {d: 1 + d % 3 for d in range(1, 11)}
    before = [counts[d] for d in range(3, 10)]
    want = (counts[10] - statistics.mean(before)) / statistics.stdev(before)
    assert got["2024-01-10"].plays_deviation == pytest.approx(want)
    moods = list(range(3, 10))
    want = (10 - statistics.mean(moods)) / statistics.stdev(moods)
    assert got["2024-01-10"].mood_deviation == pytest.approx(want)
    assert got["2024-01-01"].plays_deviation is None  # nothing before
    assert got["2024-01-02"].plays_deviation is None  # one day has no spread


def test_daily_rollup_breaks_ties_by_name(spark):
    data = [("2024-01-01", "neutral", 1), ("2024-01-01", "good", 4), (None, "good", 4)]
    df = spark.createDataFrame(data, "date string, weather_mood_category string, weather_mood int")
    df = df.selectExpr("*", "cast(weather_mood as double) as temperature_2m")
    (row,) = listening.daily_weather(df).collect()
    assert (row.hours, row.avg_weather_mood, row.dominant_weather_mood_category) == (2, 2.5, "good")
