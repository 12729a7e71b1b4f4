from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from skytune.operators import seen

DAYS = ["2024-01-01", "2024-01-02", None]


def _plays(spark, seed: int, n: int = 600):
    rng = random.Random(seed)
    rows = {
        (rng.choice(DAYS), rng.choice(["a", "b", None]), rng.choice([None, *range(300)]))
        for _ in range(n)
    }
    return spark.createDataFrame(sorted(rows, key=str), "day string, name string, at int")


@pytest.mark.parametrize("bitmaps", [1, 8])
def test_unseen_rows_are_exact(spark, bitmaps):
    history, rows = _plays(spark, 1), _plays(spark, 2)
    half = [history.where("at % 2 = 0"), history.where("at % 2 = 1 OR at IS NULL")]
    parts = [seen.filter_of(h, "day", ["name", "at"], bitmaps) for h in half]
    filters = parts[0].unionByName(parts[1])
    got = seen.unseen(rows, history, filters, "day", ["name", "at"], bitmaps)
    want = rows.exceptAll(history)
    assert got.columns == rows.columns
    assert 0 < want.count() == got.count() and want.exceptAll(got).isEmpty()


def test_filter_never_misses_and_seldom_errs(spark):
    history = spark.range(40_000).select(F.lit("d").alias("day"), F.col("id").alias("at"))
    filters = seen.filter_of(history, "day", ["at"])
    assert filters.count() == seen.BITMAPS
    told = seen.maybe_seen(history, filters, "day", ["at"])
    assert told.where(~F.col("_maybe")).isEmpty()
    others = history.withColumn("at", F.col("at") + 10**6)
    assert seen.maybe_seen(others, filters, "day", ["at"]).where("_maybe").count() < 400
    # another day has no filter, so all is new
    other_day = history.withColumn("day", F.lit("e"))
    assert seen.maybe_seen(other_day, filters, "day", ["at"]).where("_maybe").isEmpty()


def test_nothing_seen_and_nothing_new(spark):
    history, none = _plays(spark, 1), _plays(spark, 1).where("day = 'never'")
    empty = seen.filter_of(none, "day", ["name", "at"])
    assert seen.unseen(history, none, empty, "day", ["name", "at"]).count() == history.count()
    full = seen.filter_of(history, "day", ["name", "at"])
    assert seen.unseen(none, history, full, "day", ["name", "at"]).isEmpty()
    assert seen.unseen(history, history, full, "day", ["name", "at"]).isEmpty()
