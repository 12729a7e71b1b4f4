from __future__ import annotations

import json
from pathlib import Path

from conftest import TABLES, executed
from pyspark.sql import functions as F

from skytune import adapters, registry
from skytune.plans import incremental
from skytune.plans.incremental import Store, land_pull, load_pending, load_pull, pending, scan_pulls
from skytune.schemas import MUSIC_PULL, PLAYS

ZONE = "Europe/Berlin"


def _store(tmp_path):
    return Store(*(str(tmp_path / n) for n in ("landing", "plays", "filters", "manifest", "mart", "rollups")))


def _pull(spark, *plays):
    """A pull document of (title, text, epoch) plays."""
    tracks = [
        {"name": n, "streamable": "0", "artist": {"#text": "A"}, "album": {"#text": "L"}}
        | ({"date": {"uts": uts, "#text": at}} if at else {})
        for n, at, uts in plays
    ]
    text = json.dumps({"recenttracks": {"track": tracks}})
    parsed = F.from_json(F.lit(text), MUSIC_PULL)
    return spark.range(1).select(parsed.alias("d")).select("d.*")


ONE = ("x", "09 Jan 2024, 05:31", "1704778260")
TWO = ("y", "09 Jan 2024, 23:30", "1704843000")  # the 10th in Berlin
THREE = ("z", "10 Jan 2024, 12:00", "soon")  # dated by its text
PLAYING = ("now", None, None)


def _files(path) -> dict[str, float]:
    return {str(p): p.stat().st_mtime for p in Path(path).rglob("*.parquet")}


def test_loads_read_one_pull_and_touch_nothing_stored(spark, tmp_path):
    store = _store(tmp_path)
    land_pull(_pull(spark, ONE, TWO, PLAYING), store, "2024-01-10")
    assert pending(spark, store) == ["2024-01-10"]
    events, part = adapters.events(spark, TABLES), adapters.table(spark, TABLES, "part")
    tracks, readings = adapters.tracks(part), adapters.readings(events)
    assert load_pending(spark, store, tracks, readings, ZONE) == ["2024-01-10"]
    assert pending(spark, store) == [] == load_pending(spark, store, tracks, readings, ZONE)
    before = _files(store.plays)

    land_pull(_pull(spark, TWO, THREE, PLAYING), store, "2024-01-11")
    land_pull(_pull(spark), store, "2024-01-12")
    assert pending(spark, store) == ["2024-01-11", "2024-01-12"]
    scan = scan_pulls(spark, store, ["2024-01-11"])
    assert scan.count() == 1
    plan = executed(scan.groupBy().agg(F.count("recenttracks")))
    assert "PartitionFilters: [isnotnull(pull_day" in plan
    # the folder of the first pull is not even opened
    broken = next(Path(store.landing, "pull_day=2024-01-10").glob("part-*"))
    broken.write_text("{ not json")
    for crc in broken.parent.glob(".*.crc"):
        crc.write_bytes(b"")
    assert load_pending(spark, store, tracks, readings, ZONE) == ["2024-01-11", "2024-01-12"]

    after = _files(store.plays)
    assert before.items() <= after.items() and len(after) > len(before)
    rows = spark.read.schema(incremental.STORED).parquet(store.plays).collect()
    assert sorted((r.track_name, str(r.local_date)) for r in rows) == [
        ("now", "None"), ("x", "2024-01-09"), ("y", "2024-01-10"), ("z", "2024-01-10")]
    manifest = spark.read.schema(incremental.MANIFEST).parquet(store.manifest).orderBy("pull_day")
    assert [tuple(r) for r in manifest.collect()] == [
        (3, 3, 0, 1, "2024-01-10"), (3, 1, 2, 0, "2024-01-11"), (0, 0, 0, 0, "2024-01-12")]


def test_a_load_may_break_anywhere_and_be_repeated(spark, tmp_path):
    store = _store(tmp_path)
    land_pull(_pull(spark, ONE, TWO), store, "2024-01-10")
    # a crash after the filters: they know plays that are not stored
    fresh = incremental.dated(
        incremental.stage_plays(scan_pulls(spark, store, ["2024-01-10"])), ZONE)
    incremental.filter_of(fresh, "local_date", PLAYS.names).write.partitionBy("local_date").parquet(
        store.filters)
    assert load_pull(spark, "2024-01-10", store, ZONE)["fresh"] == 2
    # a crash after the plays: nothing is stored twice
    assert load_pull(spark, "2024-01-10", store, ZONE)["fresh"] == 0
    assert spark.read.schema(incremental.STORED).parquet(store.plays).count() == 2
    # the manifest does not know of either, so the pull is pending
    assert pending(spark, store) == ["2024-01-10"]


def test_only_touched_days_of_the_mart_are_rebuilt(spark, tmp_path):
    store = _store(tmp_path)
    events, part = adapters.events(spark, TABLES), adapters.table(spark, TABLES, "part")
    tracks, readings = adapters.tracks(part), adapters.readings(events)
    name = tracks.select("track_name").first()[0]
    first, second, late = ((name, *p[1:]) for p in (ONE, TWO, ("", "09 Jan 2024, 07:00", None)))
    land_pull(_pull(spark, first, second), store, "2024-01-10")
    load_pending(spark, store, tracks, readings, ZONE)
    before = _files(store.mart)
    land_pull(_pull(spark, second, late), store, "2024-01-11")
    load_pending(spark, store, tracks, readings, ZONE)
    per_day = spark.read.parquet(store.mart).groupBy("local_date").count().collect()
    assert {str(r[0]): r[1] for r in per_day} == {"2024-01-09": 2, "2024-01-10": 1}
    land_pull(_pull(spark, late, PLAYING), store, "2024-01-12")
    kept = {p: t for p, t in _files(store.mart).items() if "2024-01-10" in p}
    load_pending(spark, store, tracks, readings, ZONE)
    assert kept.items() <= _files(store.mart).items() and before


def test_queries_of_loads_derive_their_input_once(spark, monkeypatch):
    """Every load reads copies of the documents, metadata and readings, not the tables again."""
    read = []

    def files(df):
        return [f for f in df.inputFiles() if f.startswith(f"file://{TABLES}")]

    def noted(land):
        return lambda pulls, store, day: (read.extend(files(pulls)), land(pulls, store, day))

    def noted_load(load):
        def run(spark, store, tracks, readings, zone):
            read.extend(files(tracks) + files(readings))
            return load(spark, store, tracks, readings, zone)

        return run

    monkeypatch.setattr(incremental, "land_pull", noted(land_pull))
    monkeypatch.setattr(incremental, "load_pending", noted_load(load_pending))
    assert registry.QUERIES["load_manifest"](spark, TABLES).count() == 3
    assert read == []


def test_hours_are_formatted_after_the_distinct(spark):
    """A filter on the time of a reading does not go below the distinct hours."""
    readings = adapters.readings(adapters.events(spark, TABLES))
    dated = readings.where(F.to_date("timestamp").isNotNull())
    plan = dated._jdf.queryExecution().optimizedPlan().toString()
    below = plan[plan.index("Aggregate"):]
    assert "date_format" in plan and "date_format" not in below
