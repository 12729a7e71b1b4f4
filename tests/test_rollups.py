from __future__ import annotations

import datetime as dt
from pathlib import Path

from conftest import executed

from skytune.plans import listening, rollups

PLAYS = (
    "local_date date, play_date date, music_mood int, music_mood_category string"
)
ONE, TWO, THREE = (dt.date(2024, 1, d) for d in (1, 2, 3))


def _files(path) -> dict[str, float]:
    return {str(p): p.stat().st_mtime for p in Path(path).rglob("*.parquet")}


def _days(spark, path):
    return {tuple(r) for r in rollups.music_days(spark.read.parquet(path)).collect()}


def test_a_late_day_gives_the_rows_of_a_full_run(spark, rows, tmp_path):
    path = str(tmp_path / "rollups")
    # the second date lies in two stored days; there its labels tie until the late play comes
    first = [(ONE, ONE, 3, "happy"), (TWO, TWO, 5, "calm"), (TWO, TWO, -2, "sad")]
    second = [(THREE, TWO, 1, "sad"), (THREE, THREE, 4, "calm"), (THREE, None, 9, "calm")]
    rollups.store_music_days(rows(PLAYS, *first), path, "local_date")
    before = _files(path)
    rollups.store_music_days(rows(PLAYS, *second), path, "local_date")
    assert before.items() <= _files(path).items()
    full = listening.daily_music(rows(PLAYS, *first, *second))
    assert _days(spark, path) == {tuple(r) for r in full.collect()}
    # a late play: its stored day is replaced, the others keep their files
    late = [*first[1:], (TWO, TWO, 7, "calm"), (TWO, TWO, 7, "calm")]
    kept = {p: t for p, t in _files(path).items() if "2024-01-02" not in p}
    rollups.store_music_days(rows(PLAYS, *late), path, "local_date")
    assert kept.items() <= _files(path).items()
    full = listening.daily_music(rows(PLAYS, first[0], *late, *second))
    assert _days(spark, path) == {tuple(r) for r in full.collect()}
    some = rollups.music_days(spark.read.parquet(path), [TWO]).collect()
    assert [(r.date, r.plays, r.dominant_music_mood_category) for r in some] == [(TWO, 5, "calm")]


FEATURES = "user_id int, play_date date, play_hour int, played_at_ts timestamp, matched_with_metadata boolean, " + ", ".join(
    f"{c} double" for c in listening.AVERAGED
)


def _play(user, day, hour, value, known=True):
    return (user, day, hour, dt.datetime(2024, 1, day.day, hour), known, value, *[1.0] * 8)


def test_feature_partials_of_loads_merge(spark, rows, tmp_path):
    path = str(tmp_path / "features")
    nan = float("nan")
    loads = {
        "a": [_play(1, ONE, 8, 0.25), _play(1, ONE, 8, nan), _play(2, ONE, 9, None)],
        "b": [_play(1, ONE, 8, 0.75), _play(1, ONE, 9, 0.5), _play(1, TWO, 1, 0.5, False)],
        "c": [],
    }
    for load in ("a", "b", "c", "b"):  # one is repeated and counts once
        partials = listening.feature_partials(rows(FEATURES, *loads[load]))
        rollups.store_load(partials, path, load, "play_date")
    stored = rollups.stored_loads(spark, path, partials.schema, "play_date")
    whole = rows(FEATURES, *(r for load in loads.values() for r in load))
    for grain in ("hour", "day"):
        got = {tuple(r) for r in listening.folded_features(stored, grain).collect()}
        want = {tuple(r) for r in listening.average_features(whole, grain).collect()}
        assert got == want and len(got) == (3 if grain == "hour" else 2)
    pruned = rollups.stored_loads(spark, path, partials.schema, "play_date", (TWO, THREE))
    assert "PartitionFilters: [isnotnull(play_date" in executed(pruned) and pruned.count() == 0
