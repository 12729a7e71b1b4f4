"""Missing numbers, broken documents, odd files, guards and what training does with gaps."""

from __future__ import annotations

import math

import pytest
from pyspark.sql import functions as F

from skytune.functions import rules
from skytune.functions.times import parse_iso, time_axis
from skytune.plans import training
from skytune.schemas import METADATA, MUSIC_PULL
from skytune.session import release, shared_root, written
from skytune.sources import scans, sinks

NAN = float("nan")
REAL = {
    **{k: v for k, v in rules.MUSIC_SCORES.items() if getattr(v, "real", False)},
    **{k: v for k, v in rules.WEATHER_SCORES.items() if getattr(v, "real", False)},
    "temperature_category": rules.TEMPERATURE_CATEGORY,
    "cloud_category": rules.CLOUD_CATEGORY,
}


def test_nine_rules_read_real_numbers():
    assert len(REAL) == 9


@pytest.mark.parametrize("name", sorted(REAL))
def test_nan_counts_as_missing(spark, name):
    rule = REAL[name]
    frame = spark.createDataFrame([(NAN,), (None,)], f"{rule.source} double")
    assert {r[0] for r in frame.select(rule.on()).collect()} == {rule.otherwise}


def test_codes_with_a_fraction(spark, tmp_path):
    (tmp_path / "w.json").write_text(
        '{"timestamp": "t", "weathercode": 3.0, "temperature_2m": NaN}\n'
        '{"timestamp": "t", "weathercode": 3.5}\n{"timestamp": "t", "weathercode": 61}\n'
    )
    rows = scans.scan_weather_records(spark, str(tmp_path)).collect()
    assert sorted((r.weathercode for r in rows), key=str) == [3, 61, None]
    assert any(r.temperature_2m is not None and math.isnan(r.temperature_2m) for r in rows)


def test_documents_that_do_not_fit(spark, tmp_path):
    good = '{"recenttracks": {"track": [{"name": "a"}]}}'
    (tmp_path / "m.json").write_text(
        good + '\n{"recenttracks": {"track": {"name": "b"}}}\n{"recenttracks": {"track": [{\n'
    )
    kept = scans.scan_music_pulls(spark, str(tmp_path), rejects="keep")
    assert sorted(r[scans.REJECT] is None for r in kept.collect()) == [False, False, True]
    with pytest.raises(Exception, match="MALFORMED|malformed|FAILFAST"):
        scans.scan_music_pulls(spark, str(tmp_path)).collect()
    with pytest.raises(ValueError):
        scans.scan_json(spark, str(tmp_path), MUSIC_PULL, rejects="drop")


def test_csv_by_name_with_quotes(spark, tmp_path):
    names = list(reversed(METADATA.names))
    values = {"track_id": "T1", "track_name": '"a ""b"", c"', "popularity": "7", "energy": "0.5"}
    line = ",".join(["0", *(values.get(n, "") for n in names)])
    (tmp_path / "m.csv").write_text(",".join(["", *names]) + "\n" + line + "\n")
    row = scans.scan_metadata_csv(spark, str(tmp_path)).first()
    assert (row.track_id, row.track_name, row.popularity, row.energy) == ("T1", 'a "b", c', 7, 0.5)
    (tmp_path / "short").mkdir()
    (tmp_path / "short" / "m.csv").write_text("track_id\nT1\n")
    with pytest.raises(ValueError, match="lacks the columns"):
        scans.scan_metadata_csv(spark, str(tmp_path / "short"))


def test_an_empty_frame_replaces_no_table(spark, tmp_path):
    rows = spark.createDataFrame([(1,)], "v int")
    assert sinks.write_table(rows, "guard_test", str(tmp_path / "t"))
    assert not sinks.write_table(rows.where("false"), "guard_test", str(tmp_path / "t"))
    assert spark.table("guard_test").count() == 1
    assert sinks.write_table(rows.where("false"), "guard_test", str(tmp_path / "t"), allow_empty=True)
    assert spark.table("guard_test").count() == 0
    spark.sql("DROP TABLE guard_test")


def test_a_time_of_day_is_no_timestamp(spark):
    frame = spark.createDataFrame([("12:30",), ("2025",), (" 2025-12-01 12:30",)], "t string")
    got = [str(r[0]) for r in frame.select(parse_iso(F.col("t"))).collect()]
    assert got[:2] == ["None", "None"] and got[2].startswith("2025-12-01")


def test_a_fine_axis_comes_in_blocks(spark):
    frame = spark.createDataFrame([(0, 25_000, 1), (5, 5, 1)], "lo long, hi long, by long")
    axis = time_axis(frame, "lo", "hi", "by", "tick")
    row = axis.agg(F.count("*"), F.countDistinct("tick"), F.max(F.unix_timestamp("tick"))).first()
    assert tuple(row) == (25_000, 25_000, 24_999)


def test_rows_with_gaps_are_counted(spark):
    frame = spark.createDataFrame([(1.0,), (NAN,), (None,), (3.0,)], "x double")
    kept, lacking = training.completed(frame, ["x"], "drop")
    assert (kept.count(), lacking) == (2, 2)
    filled, _ = training.completed(frame, ["x"], "impute")
    assert sorted(r.x for r in filled.collect()) == [1.0, 2.0, 2.0, 3.0]
    with pytest.raises(ValueError, match="2 rows"):
        training.completed(frame, ["x"], "raise")


def test_copies_have_an_owner(spark):
    copy = written(spark.range(3), "owned")
    assert copy.count() == 3 and copy._written_to.startswith(shared_root(spark))
    release(copy, None)
    with pytest.raises(Exception, match="PATH_NOT_FOUND|does not exist|FAILED_READ"):
        spark.read.parquet(copy._written_to).count()
