from __future__ import annotations

import gzip
import json

import pytest
from conftest import TABLES
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from skytune import adapters
from skytune.plans.daily import Folders, run_daily
from skytune.plans.staging import flatten_tracks, stage_plays, stage_weather_arrays
from skytune.sources import scans, sinks


def _track(name, at=None, uts=None):
    track = {"name": name, "streamable": "0", "artist": {"#text": "A"}, "album": {"#text": "L"}}
    if at:
        track["date"] = {"uts": uts, "#text": at}
    return track


def _pull(path, *tracks):
    path.write_text(json.dumps({"recenttracks": {"track": list(tracks)}}))


def test_nested_music_files(spark, tmp_path):
    done = _track("x", "08 Dec 2025, 05:31", "1765171860")
    _pull(tmp_path / "a.json", _track("playing"), done)
    _pull(tmp_path / "b.json", done)
    _pull(tmp_path / "c.json")
    pulls = scans.scan_music_pulls(spark, f"{tmp_path}/*.json")
    assert pulls.count() == 3
    assert flatten_tracks(pulls).count() == 3
    staged = stage_plays(pulls)
    assert staged.columns == [
        "track_name", "streamable", "played_at", "played_at_uts", "artist_name", "album_name"]
    assert sorted(map(tuple, staged.collect()), key=str) == sorted([
        ("playing", "0", None, None, "A", "L"),
        ("x", "0", "08 Dec 2025, 05:31", "1765171860", "A", "L")], key=str)


def test_only_empty_pulls_stay_typed(spark, tmp_path):
    _pull(tmp_path / "a.json")
    staged = stage_plays(scans.scan_music_pulls(spark, str(tmp_path)))
    assert staged.isEmpty() and len(staged.columns) == 6


def test_weather_array_of_records(spark, tmp_path):
    hours = [{"timestamp": f"2025-12-08T0{h}:00:00Z", "temperature_2m": h + 0.5, "weathercode": 3}
             for h in range(3)]
    (tmp_path / "w.json").write_text(json.dumps(hours))
    got = scans.scan_weather_records(spark, str(tmp_path))
    assert got.count() == 3
    assert got.where("windspeed_10m IS NULL AND weathercode = 3").count() == 3


def test_weather_parallel_arrays(spark, tmp_path):
    fields = ("temperature_2m", "weathercode", "relativehumidity_2m", "cloudcover",
              "apparent_temperature", "precipitation")
    doc = {"hourly": {"time": ["2025-12-08T05:00"]} | {f: [1] for f in fields}}
    (tmp_path / "w.json").write_text(json.dumps(doc))
    row = stage_weather_arrays(scans.scan_weather_arrays(spark, str(tmp_path))).first()
    assert (row.timestamp, row.weathercode, row.temperature_2m) == ("2025-12-08T05:00:00Z", 1, 1.0)


def test_csv_files_of_different_headers(spark, tmp_path):
    folder = tmp_path / "some files"
    folder.mkdir()
    (folder / "one.csv").write_text('a,b\n1,x\n2,"y ""z"", w"\n')
    (folder / "two.csv").write_text("b,unused,a\nq,0,3\n")
    (folder / "three.csv").write_text("\ufeffa,b\n4,r\n")
    (folder / "only a header.csv").write_text("b,a\n")
    (folder / "empty.csv").write_text("")
    with gzip.open(folder / "packed.csv.gz", "wt") as file:
        file.write("b,a\ns,5\n")
    schema = StructType().add("a", "integer").add("b", "string")
    got = scans.scan_csv(spark, str(folder), schema)
    assert got.columns == ["a", "b"]
    assert sorted(map(tuple, got.collect())) == [
        (1, "x"), (2, 'y "z", w'), (3, "q"), (4, "r"), (5, "s")]
    (tmp_path / "bad").mkdir()
    (tmp_path / "bad" / "one.csv").write_text("a,c\n1,x\n")
    with pytest.raises(ValueError, match="lacks the columns"):
        scans.scan_csv(spark, str(tmp_path / "bad"), schema)
    (tmp_path / "bad" / "one.csv").write_text("a,b,b\n1,x,y\n")
    with pytest.raises(ValueError, match="more than once"):
        scans.scan_csv(spark, str(tmp_path / "bad"), schema)
    (tmp_path / "bad" / "one.csv").write_text("")
    assert scans.scan_csv(spark, str(tmp_path / "bad"), schema).isEmpty()


def test_days_overwrite_only_themselves(spark, tmp_path):
    path = str(tmp_path / "t")
    day = "day string, v int"
    sinks.write_days(spark.createDataFrame([("a", 1), ("b", 2)], day), path, "day")
    sinks.write_days(spark.createDataFrame([("b", 3)], day), path, "day")
    sinks.write_days(spark.createDataFrame([], day), path, "day")
    got = spark.read.parquet(path)
    assert sorted((r.day, r.v) for r in got.collect()) == [("a", 1), ("b", 3)]


def test_table_and_view(spark, tmp_path):
    df = spark.createDataFrame([(2,), (1,)], "v int")
    sinks.write_table(df, "landing_test", str(tmp_path / "t"), ["v"])
    sinks.write_table(df, "landing_test", str(tmp_path / "t"))
    sinks.publish_view(scans.scan_table(spark, "landing_test"), "landing_view")
    assert scans.scan_table(spark, "landing_view").count() == 2
    spark.sql("DROP TABLE landing_test")


def _folders(tmp_path):
    return Folders(*(str(tmp_path / n) for n in ("music", "weather", "plays", "hours", "mart")))


def test_daily_run_keeps_other_days_and_survives_empty_pulls(spark, tmp_path):
    folders = _folders(tmp_path)
    events, part = adapters.events(spark, TABLES), adapters.table(spark, TABLES, "part")
    sinks.land_json(adapters.music_pulls(adapters.plays(events, part)), folders.music_json)
    sinks.land_json(adapters.readings(events).drop("reading_id"), folders.weather_json)
    tracks = adapters.tracks(part)

    first = run_daily(spark, "2024-01-10", folders, tracks)
    second = run_daily(spark, "2024-01-11", folders, tracks)
    again = run_daily(spark, "2024-01-11", folders, tracks)
    assert first["plays"] > 0 and first["mart"] > 0 and second == again
    per_day = {str(r[0]): r[1] for r in
               spark.read.parquet(folders.mart).groupBy("local_date").count().collect()}
    assert per_day == {"2024-01-10": first["mart"], "2024-01-11": second["mart"]}
    # a local winter day starts at 23:00 UTC of the day before
    seconds = spark.read.parquet(folders.plays).where("local_date = '2024-01-10'")
    lo, hi = seconds.select(F.col("played_at_uts").cast("bigint").alias("s")).agg(
        F.min("s"), F.max("s")).first()
    assert 1704841200 <= lo < hi <= 1704927599

    empty = run_daily(spark, "2031-01-01", folders, tracks)
    assert empty["plays"] == empty["mart"] == 0
    assert spark.read.parquet(folders.mart).count() == first["mart"] + second["mart"]


def test_daily_run_dates_plays_by_text_and_counts_the_rest(spark, tmp_path):
    folders = _folders(tmp_path)
    part = adapters.table(spark, TABLES, "part")
    tracks = adapters.tracks(part)
    name = tracks.select("track_name").first()[0]
    (tmp_path / "music").mkdir()
    (tmp_path / "weather").mkdir()
    _pull(
        tmp_path / "music" / "a.json",
        _track(name, "10 Jan 2024, 05:31", "1704864660"),
        _track(name, "09 Jan 2024, 23:30"),  # 00:30 of the 10th in Berlin
        _track(name, "10 Jan 2024, 12:00", "soon"),
        _track(name, "10 Jan 2024, 23:30"),
        _track(name, "some day", "never"),
        _track("playing"),
    )
    sinks.land_json(
        adapters.readings(adapters.events(spark, TABLES)).drop("reading_id"), folders.weather_json
    )
    counts = run_daily(spark, "2024-01-10", folders, tracks)
    assert counts["plays"] == 3 and counts["undated"] == 2 and counts["mart"] == 3
    staged = spark.read.parquet(folders.plays)
    assert "_epoch" not in staged.columns
    assert {r.played_at for r in staged.collect()} == {
        "10 Jan 2024, 05:31", "09 Jan 2024, 23:30", "10 Jan 2024, 12:00"}
    assert run_daily(spark, "2031-01-01", folders, tracks)["undated"] == 2
