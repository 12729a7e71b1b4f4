from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from skytune.functions.text import match_key
from skytune.functions.times import (
    MONTHS,
    in_local_day,
    iso_z,
    local_day_bounds,
    parse_iso,
    parse_played_at,
    time_axis,
)

PARSED = [
    ("08 Dec 2025, 05:31", "2025-12-08 05:31"),
    ("8 Dec 2025, 05:31", "2025-12-08 05:31"),
    ("08 dec 2025, 05:31", "2025-01-08 05:31"),  # months are case-sensitive, default January
    ("31 Feb 2025, 05:31", None),
    ("2025-12-08 05:31", "2025-01-20 05:31"),  # the leading digits are taken as the day
    ("29 Feb 2024, 23:59", "2024-02-29 23:59"),
    ("29 Feb 2023, 23:59", None),
    ("05 Dec 2025, 10:00 (Jan)", "2025-01-05 10:00"),  # first month in calendar order
    ("08 Dec 2025", None),
    ("Dec 2025, 05:31", None),
    ("08 Dec 25, 05:31", None),
    ("", None),
    (None, None),
    *((f"01 {m} 2024, 00:00", f"2024-{i:02d}-01 00:00") for i, m in enumerate(MONTHS, 1)),
]


def test_played_at_goldens(rows):
    df = rows("text string", *((text,) for text, _ in PARSED))
    got = df.select(parse_played_at(F.col("text")).cast("string")).collect()
    assert [r[0] for r in got] == [w and w + ":00" for _, w in PARSED]


def test_strict_parse_raises_on_impossible_dates_only(rows):
    missing = rows("text string", ("08 Dec 2025",), (None,))
    assert [r[0] for r in missing.select(parse_played_at(F.col("text"), True)).collect()] == [
        None, None,
    ]
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        rows("text string", ("31 Feb 2025, 05:31",)).select(
            parse_played_at(F.col("text"), strict=True)
        ).collect()


def test_match_key(rows):
    df = rows(
        "text string", ("  Red Bolt ",), ("\tRED bolt\n",), (" red Bolt　",), (None,), (" ",)
    )
    keys = [r[0] for r in df.select(match_key(F.col("text"))).collect()]
    assert keys == ["red bolt", "red bolt", "red bolt", None, ""]


@pytest.mark.parametrize(
    "day, hours, first",
    [
        ("2025-03-30", 23, "2025-03-29 23:00:00"),
        ("2025-10-26", 25, "2025-10-25 22:00:00"),
        ("2025-12-07", 24, "2025-12-06 23:00:00"),
    ],
)
def test_local_day_bounds(spark, day, hours, first):
    lo, hi = spark.range(1).select(*local_day_bounds(day, "Europe/Berlin")).first()
    assert hi - lo + 1 == hours * 3600
    assert dt.datetime.fromtimestamp(lo, dt.UTC).strftime("%Y-%m-%d %H:%M:%S") == first


def test_local_day_edges(rows):
    lo, hi = 1764975600, 1765061999  # 2025-12-06 in Berlin
    df = rows("s bigint", (lo - 1,), (lo,), (hi,), (hi + 1,), (None,))
    kept = df.where(in_local_day(F.col("s"), "2025-12-06", "Europe/Berlin")).collect()
    assert [r.s for r in kept] == [lo, hi]


def test_iso_text(rows):
    df = rows("text string", ("2025-12-08T05:00:00Z",), ("2025-12-08T05:00",), ("noon",), (None,))
    got = df.select(iso_z(parse_iso(F.col("text")))).collect()
    assert [r[0] for r in got] == ["2025-12-08T05:00:00Z"] * 2 + [None, None]
    shifted = df.select(iso_z(parse_iso(F.col("text"), "Europe/Berlin"))).first()[0]
    assert shifted == "2025-12-08T04:00:00Z"


def test_time_axis_is_left_closed(rows):
    df = rows("k string, lo bigint, hi bigint, step bigint",
              ("even", 0, 180, 60), ("odd", 0, 90, 60), ("empty", 60, 60, 60), ("null", None, 9, 3))
    got = [(r.k, int(r.t.replace(tzinfo=dt.UTC).timestamp()))
           for r in time_axis(df, "lo", "hi", "step", "t").collect()]
    assert got == [("even", 0), ("even", 60), ("even", 120), ("odd", 0), ("odd", 60)]
