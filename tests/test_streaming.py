from __future__ import annotations

import datetime as dt

from conftest import TABLES
from pyspark.sql import functions as F

from skytune import adapters
from skytune.plans.mart import combined_mood
from skytune.plans.music import best_metadata, music_mood
from skytune.plans.staging import flatten_tracks, stage_plays
from skytune.plans.weather import hourly_weather_mood
from skytune.session import written
from skytune.sources import scans, sinks
from skytune.streaming import hourly

SCHEMA = "id int, at string, song_mood int, duration_ms bigint, weather_mood int"


def _land(spark, path, rows, mode="append"):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode(mode).parquet(path)


def _run(spark, tmp_path):
    src, out, ck = (str(tmp_path / n) for n in ("src", "out", "ck"))
    stream = spark.readStream.schema(SCHEMA).parquet(src)
    stamped = stream.withColumn(hourly.STAMP, F.to_timestamp("at"))
    hours = hourly.hourly_listening(hourly.deduplicated(stamped, ["id"]))
    hourly.append_to(hours, out, ck).awaitTermination()
    got = spark.read.schema(hours.schema).parquet(out)
    return sorted((r.window_start.hour, r.plays, r.mood_sum, r.played_ms) for r in got.collect())


def test_closed_hours_duplicates_and_late_rows(spark, tmp_path):
    src = str(tmp_path / "src")
    _land(spark, src, [
        (1, "2024-01-01 10:05:00", 3, 100, 1), (1, "2024-01-01 10:05:00", 3, 100, 1),
        (2, "2024-01-01 10:59:00", -1, 50, 1), (3, "2024-01-01 12:30:00", 5, 10, 2)])
    # watermark 11:30: the hour of 10 is closed, those of 11 and 12 are open
    assert _run(spark, tmp_path) == [(10, 2, 2, 150)]
    _land(spark, src, [
        (4, "2024-01-01 10:30:00", 9, 9, 1),  # too late
        (5, "2024-01-01 11:45:00", 1, 7, 1),  # late, hour still open
        (6, "2024-01-01 15:00:00", 1, 1, 1)])
    assert _run(spark, tmp_path) == [(10, 2, 2, 150), (11, 1, 1, 7), (12, 1, 5, 10)]


def test_rerun_without_new_files_adds_nothing(spark, tmp_path):
    start = dt.datetime(2024, 1, 1, 10)
    _land(spark, str(tmp_path / "src"), [
        (i, str(start + dt.timedelta(minutes=30 * i)), 1, 1, 1) for i in range(8)])
    assert _run(spark, tmp_path) == _run(spark, tmp_path)


def test_stream_of_landed_documents_equals_batch(spark, tmp_path):
    landed = str(tmp_path / "landed")
    events, part = adapters.events(spark, TABLES), adapters.table(spark, TABLES, "part")
    plays, tracks = adapters.plays(events, part), adapters.tracks(part)
    sinks.land_json(adapters.music_pulls(plays).repartition(3), landed)
    best = written(best_metadata(tracks), "best")
    weather = written(hourly_weather_mood(adapters.readings(events)), "hours")

    live = hourly.live_mart(flatten_tracks(scans.stream_music_pulls(spark, landed)), best, weather)
    keys = ["Content_Name", "Artist_Name", "album_name", "streamable", hourly.STAMP]
    hours = hourly.hourly_listening(hourly.deduplicated(live, keys))
    out, ck = str(tmp_path / "out"), str(tmp_path / "ck")
    hourly.append_to(hours, out, ck).awaitTermination()
    got = spark.read.schema(hours.schema).parquet(out)

    staged = stage_plays(scans.scan_music_pulls(spark, landed))
    mart = combined_mood(music_mood(staged, tracks), weather).dropDuplicates(keys)
    closed = mart.agg(F.max(hourly.STAMP) - F.expr("INTERVAL 1 HOUR")).first()[0]
    want = hourly.hourly_listening(mart).where(
        F.col("window_start") + F.expr("INTERVAL 1 HOUR") <= F.lit(closed))
    assert got.count() > 300
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()
