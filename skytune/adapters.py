"""Domain frames derived from the given tables.

The tables hold neither weather nor music, so event hours become weather readings, parts
become tracks and events become plays. Values follow from ids and names by arithmetic, so
any engine can derive the same frames, and every frame grows with its table.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skytune.functions.rules import MUSIC_SCORES

# One value per residue of the part key: all scored genres, one in capitals, one that no
# rule names, one missing.
GENRES = [
    *(genre for genres, _ in MUSIC_SCORES["genre_score"].groups for genre in genres),
    "Pop", "ambient", None,
]

TRACK_TIME = "dd MMM yyyy, HH:mm"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def events(spark: SparkSession, folder: str) -> DataFrame:
    """Events with a zoned event time, as watermarks and calendar parts need it."""
    return table(spark, folder, "events").withColumn("ts", F.col("ts").cast("timestamp"))


def _share(number: Column, modulus: int = 101) -> Column:
    return (number % modulus).cast("double") / 100


def readings(events: DataFrame) -> DataFrame:
    """One weather reading per event hour; some lost their timestamp or a value."""
    hours = events.select(F.date_trunc("hour", "ts").alias("hr")).distinct()
    i = F.col("reading_id")
    keyed = hours.withColumn(
        "reading_id", F.floor(F.unix_timestamp("hr") / 3600).cast("bigint")
    )
    reading = F.struct(
        "reading_id",
        F.when(i % 11 != 0, F.date_format("hr", "yyyy-MM-dd'T'HH:mm:ss'Z'")).alias("timestamp"),
        F.when(
            i % 89 != 0, ((i * 7) % 45 - 8).cast("double") + (i % 2).cast("double") / 2
        ).alias("temperature_2m"),
        F.when(i % 89 != 0, ((i * 7) % 45 - 10).cast("double")).alias("apparent_temperature"),
        ((i * 37) % 104).alias("weathercode"),
        (((i * 29) % 101).cast("double") + F.when(i % 3 == 0, 0.5).otherwise(0.0)).alias(
            "cloudcover"
        ),
        F.when(i % 97 != 0, ((i * 5) % 28).cast("double") / 4).alias("precipitation"),
        ((i * 17) % 101).cast("double").alias("relativehumidity_2m"),
        F.when(i % 5 != 0, ((i * 13) % 60).cast("double") / 2).alias("windspeed_10m"),
    )
    # Unpacked like plays: a filter further up would be rewritten below the distinct otherwise, and
    # format and parse the hour of every event.
    return keyed.select(F.inline(F.array(reading)))


def gappy_readings(readings: DataFrame) -> DataFrame:
    """The readings as a pull with gaps lands them: NaN for missing values, codes as 3.0."""
    i = F.col("reading_id")

    def gaps(name: str, modulus: int) -> Column:
        return F.when(i % modulus == 0, F.lit(float("nan"))).otherwise(F.col(name)).alias(name)

    return readings.select(
        "timestamp", F.col("weathercode").cast("double").alias("weathercode"),
        gaps("temperature_2m", 7), gaps("cloudcover", 5), gaps("relativehumidity_2m", 6),
        gaps("precipitation", 13), "apparent_temperature", "windspeed_10m",
    )


def broken_pulls(plays: DataFrame) -> DataFrame:
    """The music documents as text: some are cut off, in some ``track`` is no list."""
    text = F.to_json(F.col("recenttracks"))
    e = F.col("event_id")
    pulls = music_pulls(plays, ["event_id"]).select("event_id", text.alias("inner"))
    return pulls.select(
        F.when(e % 25 == 0, F.lit('{"recenttracks": {"track": [{"name": "cut'))
        .when(e % 25 == 1, F.lit('{"recenttracks": {"track": {"name": "alone"}}}'))
        .otherwise(F.concat(F.lit('{"recenttracks": '), "inner", F.lit("}")))
        .alias("value")
    )


def tracks(part: DataFrame) -> DataFrame:
    """Track metadata, one row per part; titles repeat, so picking the best has work."""
    k, name = F.col("p_partkey"), F.col("p_name")
    spread = (F.length(name) * F.ascii(name) * 7 + F.ascii(F.reverse(name)) * 31) % 101 + 1
    genre = F.element_at(F.array(*map(F.lit, GENRES)), (k % len(GENRES) + 1).cast("int"))
    return part.select(
        F.concat(F.lit("T"), k).alias("track_id"),
        F.col("p_brand").alias("artists"),
        F.col("p_type").alias("album_name"),
        name.alias("track_name"),
        F.when(k % 17 != 0, (k * 13) % spread).cast("int").alias("popularity"),
        (F.lit(120000) + (k * 137) % 240000).alias("duration_ms"),
        (k % 3 == 0).alias("explicit"),
        _share(k * 31).alias("danceability"),
        _share(k * 7).alias("energy"),
        (k % 12).cast("int").alias("key"),
        (-((k * 3) % 30)).cast("double").alias("loudness"),
        (k % 2).cast("int").alias("mode"),
        _share(k * 5).alias("speechiness"),
        _share(k * 43).alias("acousticness"),
        _share(k * 23).alias("instrumentalness"),
        _share(k * 41).alias("liveness"),
        _share(k * 19).alias("valence"),
        (F.lit(40) + (k * 11) % 170).cast("double").alias("tempo"),
        (k % 3 + 3).cast("int").alias("time_signature"),
        genre.alias("track_genre"),
    )


def plays(events: DataFrame, part: DataFrame, parts: Column | int | None = None) -> DataFrame:
    """One play per event. Titles vary in case and padding, a quarter name a live version
    that no metadata has, some lack a title or a time.

    ``parts`` is the number of parts, if the caller knows it already.
    """
    if parts is None:
        parts = part.select(F.count(F.lit(1))).scalar()
    e, name = F.col("event_id"), F.col("p_name")
    title = (
        F.when(e % 50 == 7, F.lit(None))
        .when(e % 4 == 0, name)
        .when(e % 4 == 1, F.upper(name))
        .when(e % 4 == 2, F.concat(F.lit("  "), name, F.lit(" ")))
        .otherwise(F.concat(name, F.lit(" (live)")))
    )
    keyed = events.withColumn("p_partkey", e % parts)
    joined = keyed.join(
        part.select("p_partkey", "p_name", "p_brand", "p_type"), "p_partkey", "left"
    )
    play = F.struct(
        "event_id",
        "user_id",
        title.alias("track_name"),
        F.col("p_brand").alias("artist_name"),
        F.col("p_type").alias("album_name"),
        (e % 2).cast("string").alias("streamable"),
        F.when(e % 40 != 3, F.date_format("ts", TRACK_TIME)).alias("played_at"),
        F.unix_timestamp("ts").cast("string").alias("played_at_uts"),
    )
    # Unpacking a struct makes these real columns, as in a staged table. Otherwise filters
    # and parsers further up would each be rewritten to repeat the formulas above.
    return joined.select(F.inline(F.array(play)))


def order_times(orders: DataFrame) -> DataFrame:
    """Play time text over all months and hours, for the parser."""
    minutes = (F.col("o_orderkey") * 37 % 1440).cast("int")
    stamp = F.col("o_orderdate").cast("timestamp") + F.make_dt_interval(mins=minutes)
    return orders.select("o_orderkey", F.date_format(stamp, TRACK_TIME).alias("played_at"))


def music_pulls(plays: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Nested pull documents as the music service sends them, one per event.

    A play without a title becomes a pull with an empty track list. Every tenth pull
    starts with the track still playing, which has no date yet.
    """

    def track(date: Column) -> Column:
        return F.struct(
            F.col("track_name").alias("name"),
            F.col("streamable"),
            date.alias("date"),
            F.struct(F.col("artist_name").alias("#text")).alias("artist"),
            F.struct(F.col("album_name").alias("#text")).alias("album"),
        )

    date = F.struct(F.col("played_at_uts").alias("uts"), F.col("played_at").alias("#text"))
    now_playing = F.when(F.col("event_id") % 10 == 0, track(F.when(F.lit(False), date)))
    done = F.when(F.col("track_name").isNotNull(), track(date))
    listed = F.array_compact(F.array(now_playing, done))
    return plays.select(*keep, F.struct(listed.alias("track")).alias("recenttracks"))


HOURLY = (
    "temperature_2m",
    "weathercode",
    "relativehumidity_2m",
    "cloudcover",
    "apparent_temperature",
    "precipitation",
    "windspeed_10m",
)


def _daily_readings(readings: DataFrame) -> DataFrame:
    # Readings are distinct hours, so a day never collects more than 24 of them.
    day = F.floor(F.col("reading_id") / 24).cast("bigint").alias("day_no")
    hour = (F.col("reading_id") % 24).cast("int").alias("hour_no")
    entry = F.struct(hour, *HOURLY)
    return readings.groupBy(day).agg(F.sort_array(F.collect_list(entry)).alias("entries"))


def weather_array_pulls(readings: DataFrame) -> DataFrame:
    """One document per day with one array per weather variable."""
    days = _daily_readings(readings)
    stamp = F.transform(
        "entries",
        lambda e: F.date_format(
            F.timestamp_seconds((F.col("day_no") * 24 + e["hour_no"]) * 3600),
            "yyyy-MM-dd'T'HH:mm",
        ),
    )
    # A field of an array of structs is the array of that field.
    arrays = (F.col("entries")[n].alias(n) for n in HOURLY)
    return days.select(F.struct(stamp.alias("time"), *arrays).alias("hourly"))


# The order in which the variables of a positional pull were requested.
REQUEST_ORDER = (
    "temperature_2m",
    "apparent_temperature",
    "cloudcover",
    "relativehumidity_2m",
    "precipitation",
    "weathercode",
)


def weather_positional_pulls(readings: DataFrame) -> DataFrame:
    """One document per day: its first hour, and per requested variable 24 values without
    names; hours with no reading are NULL."""
    days = _daily_readings(readings).withColumn(
        "by_hour",
        F.map_from_entries(F.transform("entries", lambda e: F.struct(e["hour_no"], e))),
    )
    hours = F.sequence(F.lit(0), F.lit(23))

    def values(name: str) -> Column:
        return F.transform(hours, lambda h: F.try_element_at("by_hour", h)[name].cast("double"))

    start = F.col("day_no") * 86400
    return days.select(
        start.alias("time_start"),
        (start + 86400).alias("time_end"),
        F.lit(3600).cast("bigint").alias("interval"),
        F.array(*(values(n) for n in REQUEST_ORDER)).alias("variables"),
    )
