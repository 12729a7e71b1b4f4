"""Loads that cost one pull: landing by pull day, a manifest, and plays stored once for good.

Every pull lands in a folder of its own, and a load reads only that. Pulls overlap, so plays are
compared with those stored before: only with days that the pull touches, and only those that a
Bloom filter of the day cannot rule out. New plays are appended, so stored files are never rewritten,
and only the days they fall on are built anew in the mart and among the partial roll-ups.
"""

from __future__ import annotations

import logging
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, StringType, StructType

from skytune import schemas
from skytune.functions.times import local_date, parse_played_at
from skytune.operators.seen import filter_of, unseen
from skytune.plans.mart import combined_mood
from skytune.plans.music import music_mood
from skytune.plans.rollups import store_music_days
from skytune.plans.staging import stage_plays
from skytune.plans.weather import hourly_weather_mood
from skytune.session import release, written
from skytune.sources.scans import scan_json
from skytune.sources.sinks import land_json, write_days

log = logging.getLogger(__name__)

PULL, DAY = "pull_day", "local_date"

STORED = StructType([*schemas.PLAYS.fields]).add(DAY, DateType())
FILTERS = "bitmap int, bits binary, local_date date"
MANIFEST = "staged long, fresh long, known long, undated long, pull_day string"


@dataclass(frozen=True)
class Store:
    """Folders of landed pulls, stored plays, their filters, the manifest, the mart and roll-ups."""

    landing: str
    plays: str
    filters: str
    manifest: str
    mart: str
    rollups: str


def land_pull(pulls: DataFrame, store: Store, pull_day: str) -> None:
    """Land one pull in its own folder; landing it again replaces only that folder."""
    land_json(pulls, f"{store.landing}/{PULL}={pull_day}")


def scan_pulls(spark: SparkSession, store: Store, pull_days: Sequence[str]) -> DataFrame:
    """Landed documents of some pulls; folders of all others are left out of the scan."""
    schema = StructType([*schemas.MUSIC_PULL.fields]).add(PULL, StringType())
    return scan_json(spark, store.landing, schema).where(F.col(PULL).isin(*pull_days))


def exists(spark: SparkSession, path: str) -> bool:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place)


def stored(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """A stored table, empty before the first load."""
    if exists(spark, path):
        return spark.read.schema(schema).parquet(path)
    return spark.createDataFrame([], schema)


def pending(spark: SparkSession, store: Store) -> list[str]:
    """Landed pulls that the manifest does not list, in order; one listing of folders."""
    if not exists(spark, store.landing):
        return []
    place = spark._jvm.org.apache.hadoop.fs.Path(store.landing)
    listed = place.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(place)
    names = (status.getPath().getName() for status in listed)
    landed = {name.partition("=")[2] for name in names if name.startswith(f"{PULL}=")}
    done = stored(spark, store.manifest, MANIFEST).select(PULL).collect()
    return sorted(landed - {row[0] for row in done})


def dated(plays: DataFrame, zone: str) -> DataFrame:
    """Plays with the local day they fall on: by epoch, else by text, else NULL."""
    epoch = F.timestamp_seconds(F.col("played_at_uts").try_cast("bigint"))
    stamp = F.coalesce(epoch, parse_played_at(F.col("played_at")))
    return plays.withColumn(DAY, local_date(stamp, zone))


def _among(days: Sequence) -> Column:
    """Partition filter: the given days, NULL for undated plays included if it is given."""
    known = [d for d in days if d is not None]
    chosen = F.col(DAY).isin(known) if known else F.lit(False)
    return chosen | F.col(DAY).isNull() if None in days else chosen


def load_pull(spark: SparkSession, pull_day: str, store: Store, zone: str) -> dict:
    """Store the plays of one landed pull that no earlier load has stored; counts and days touched.

    Filters are written before plays: after a crash in between, a filter knows too much, which only
    means more plays to compare. So a load may be repeated, and stores nothing twice.
    """
    pulled = dated(stage_plays(scan_pulls(spark, store, [pull_day])), zone)
    staged = written(pulled, "staged")
    days = [row[0] for row in staged.select(DAY).distinct().collect()]
    history = stored(spark, store.plays, STORED).where(_among(days))
    filters = stored(spark, store.filters, FILTERS).where(_among(days))
    # partial filters of one load merge with those of others when they are read
    fresh = written(unseen(staged, history, filters, DAY, schemas.PLAYS.names), "fresh")
    counts = fresh.groupBy().agg(
        F.count(F.lit(1)).alias("fresh"), F.count_if(F.col(DAY).isNull()).alias("undated")
    )
    fresh_rows, undated = counts.first()
    if fresh_rows:
        for df, path in (
            (filter_of(fresh, DAY, schemas.PLAYS.names).hint("rebalance", DAY), store.filters),
            (fresh.hint("rebalance", DAY), store.plays),
        ):
            df.write.mode("append").partitionBy(DAY).parquet(path)
    total = staged.count()
    release(staged, fresh)
    log.info("pull %s: %d plays, %d of them new", pull_day, total, fresh_rows)
    known = total - fresh_rows
    return dict(staged=total, fresh=fresh_rows, known=known, undated=undated, days=days)


def rebuild_days(
    spark: SparkSession, days: Sequence, store: Store, metadata: DataFrame, readings: DataFrame
) -> None:
    """Build some days of the mart and the roll-ups anew from stored plays.

    Other days keep their files. The scored plays are written once, as both are built from them.
    """
    known = [d for d in days if d is not None]
    if not known:
        return
    plays = stored(spark, store.plays, STORED).where(_among(known))
    music = written(music_mood(plays, metadata, [DAY]), "music-days")
    write_days(combined_mood(music, hourly_weather_mood(readings), [DAY]), store.mart, DAY)
    store_music_days(music, store.rollups, DAY)
    release(music)


def load_pending(
    spark: SparkSession, store: Store, metadata: DataFrame, readings: DataFrame, zone: str
) -> list[str]:
    """Load every landed pull that is not in the manifest, then the days of the mart they touch."""
    loads = {day: load_pull(spark, day, store, zone) for day in pending(spark, store)}
    touched = {d for counts in loads.values() for d in counts["days"] if d is not None}
    rebuild_days(spark, sorted(touched), store, metadata, readings)
    # noted last, so what a crash leaves undone is pending again
    rows = [(*(c[n] for n in ("staged", "fresh", "known", "undated")), d) for d, c in loads.items()]
    if rows:
        write_days(spark.createDataFrame(rows, MANIFEST), store.manifest, PULL)
    return list(loads)
