"""Every capability as a query over the given tables: name to (spark, folder) -> frame."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import replace
from functools import cached_property, wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skytune import adapters
from skytune.functions.text import match_key
from skytune.functions.times import (
    epoch_timestamp,
    local_date,
    local_day_bounds,
    in_local_day,
    iso_z,
    parse_iso,
    parse_played_at,
    time_axis,
)
from skytune.operators import picks
from skytune.operators.reshape import positional_to_rows, to_records
from skytune.operators.splitting import md5_bucket
from skytune.plans import daily, incremental, listening, rollups, training
from skytune.plans.mart import combined_mood
from skytune.plans.music import best_metadata, clean_plays, match_plays, music_mood, score_music
from skytune.plans.staging import flatten_tracks, stage_plays, stage_weather_arrays
from skytune.plans.weather import (
    decode_weather,
    hourly_weather_mood,
    weather_mood,
    with_daily_context,
    with_trend_and_context,
)
from skytune.session import prepare, release, shared_folder, written
from skytune.sources import measures, scans, sinks
from skytune.streaming import hourly

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}

ZONE = "Europe/Berlin"
RUN_DATE = "2024-01-10"


def zone_free(df: DataFrame) -> DataFrame:
    """Timestamps as UTC wall clock, so results compare across engines."""
    return df.select(
        *(
            F.col(f"`{f.name}`").cast("timestamp_ntz").alias(f.name)
            if isinstance(f.dataType, T.TimestampType)
            else F.col(f"`{f.name}`")
            for f in df.schema.fields
        )
    )


def query(fn: Callable[[Frames], DataFrame]) -> Callable[[Frames], DataFrame]:
    @wraps(fn)
    def run(spark: SparkSession, folder: str) -> DataFrame:
        return zone_free(fn(Frames(prepare(spark), folder)))

    QUERIES[fn.__name__] = run
    return fn


# --- frames the queries start from ---------------------------------------------------


class Frames:
    """The derived frames of one folder, each planned once."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark, self.folder = spark, folder

    @cached_property
    def events(self) -> DataFrame:
        return adapters.events(self.spark, self.folder)

    @cached_property
    def part(self) -> DataFrame:
        return adapters.table(self.spark, self.folder, "part")

    @cached_property
    def readings(self) -> DataFrame:
        return adapters.readings(self.events)

    @cached_property
    def hours(self) -> DataFrame:
        return hourly_weather_mood(self.readings)

    @cached_property
    def plays(self) -> DataFrame:
        return adapters.plays(self.events, self.part)

    @cached_property
    def tracks(self) -> DataFrame:
        return adapters.tracks(self.part)

    def matched(self, match_artist: bool = False) -> DataFrame:
        cleaned = clean_plays(self.plays, ["event_id", "user_id"])
        return match_plays(cleaned, best_metadata(self.tracks, match_artist), match_artist)

    def music(self, keep: Sequence[str] = ("event_id",), **options: bool) -> DataFrame:
        return music_mood(self.plays, self.tracks, keep, **options)

    def mart(self, keep: Sequence[str] = ("event_id",)) -> DataFrame:
        return combined_mood(self.music(keep), self.hours, keep)


# --- weather -------------------------------------------------------------------------


@query
def weather_category_counts(f: Frames) -> DataFrame:
    scored = f.hours
    return scored.groupBy("weather_mood_category").agg(
        F.count(F.lit(1)).alias("hours"),
        F.min("weather_mood_raw").alias("min_raw"),
        F.max("weather_mood_raw").alias("max_raw"),
    )


WEATHER_LABELS = (
    "weather_condition", "simplified_condition", "temperature_category", "cloud_category"
)


@query
def weather_decoded(f: Frames) -> DataFrame:
    return decode_weather(f.readings).select(
        "reading_id", "timestamp_converted", "date", "hour_of_day", "day_of_week", "month",
        *WEATHER_LABELS,
    )


WEATHER_RESULT = (
    "temperature_score", "weather_score", "cloud_score", "time_score", "precipitation_penalty",
    "humidity_score", "weather_mood_raw", "weather_mood", "weather_mood_category",
    "is_great_weather_mood", "is_poor_weather_mood", "is_ideal_weather_conditions",
    "is_unfavorable_conditions",
)


@query
def weather_scores(f: Frames) -> DataFrame:
    return f.hours.select("reading_id", *WEATHER_RESULT)


@query
def weather_scores_fixed_ranges(f: Frames) -> DataFrame:
    scored = hourly_weather_mood(f.readings, fix_ranges=True)
    return scored.select("reading_id", *WEATHER_RESULT)


@query
def weather_local_clock(f: Frames) -> DataFrame:
    scored = hourly_weather_mood(f.readings, weather_tz=ZONE)
    return scored.select("reading_id", "timestamp_converted", "date", "hour_of_day", "weather_mood")


@query
def weather_lag(f: Frames) -> DataFrame:
    scored = f.hours
    return with_trend_and_context(scored, tie_break=["reading_id"]).select(
        "reading_id", "weather_mood", "prev_hour_weather_mood", "prev_hour_temperature"
    )


@query
def weather_daily_context(f: Frames) -> DataFrame:
    return with_daily_context(f.hours).select(
        "reading_id", "date", "daily_avg_weather_mood", "daily_min_temp", "daily_max_temp"
    )


@query
def weather_model(f: Frames) -> DataFrame:
    return weather_mood(f.readings, tie_break=["reading_id"])


# --- music ---------------------------------------------------------------------------


@query
def played_at_parse(f: Frames) -> DataFrame:
    cleaned = clean_plays(f.plays, ["event_id"])
    return cleaned.select("event_id", "played_at", "played_at_ts")


@query
def played_at_all_months(f: Frames) -> DataFrame:
    times = adapters.order_times(adapters.table(f.spark, f.folder, "orders"))
    return times.withColumn("played_at_ts", parse_played_at(F.col("played_at")))


@query
def match_keys(f: Frames) -> DataFrame:
    keys = f.plays.select(
        match_key(F.col("track_name")).alias("track_key"),
        match_key(F.col("artist_name")).alias("artist_key"),
    )
    return keys.groupBy("track_key", "artist_key").agg(F.count(F.lit(1)).alias("plays"))


@query
def metadata_best(f: Frames) -> DataFrame:
    return best_metadata(f.tracks)


@query
def metadata_best_by_artist(f: Frames) -> DataFrame:
    return best_metadata(f.tracks, match_artist=True)


@query
def plays_matched(f: Frames) -> DataFrame:
    return f.matched()


@query
def plays_matched_by_artist(f: Frames) -> DataFrame:
    return f.matched(match_artist=True)


MUSIC_RESULT = (
    "energy_score", "valence_score", "danceability_score", "tempo_score", "genre_score",
    "acousticness_score", "time_listening_score", "popularity_score", "music_mood_raw",
    "music_mood",
)


@query
def music_scores(f: Frames) -> DataFrame:
    return f.music().select("event_id", *MUSIC_RESULT)


@query
def music_scores_fixed_ranges(f: Frames) -> DataFrame:
    music = f.music(fix_ranges=True)
    return music.select("event_id", *MUSIC_RESULT)


@query
def music_categories(f: Frames) -> DataFrame:
    return (
        f.music()
        .groupBy("music_mood_category", "time_of_day_category", "is_uplifting_music",
                 "is_depressing_music")
        .agg(F.count(F.lit(1)).alias("plays"), F.sum("music_mood").alias("mood_sum"))
    )


@query
def music_model(f: Frames) -> DataFrame:
    return f.music()


@query
def music_by_epoch(f: Frames) -> DataFrame:
    plays = f.plays
    cleaned = clean_plays(plays, ["event_id", "played_at_uts"], use_epoch=True)
    return cleaned.select("event_id", "played_at_uts", "played_at_ts")


# --- mart ----------------------------------------------------------------------------


@query
def combined_mart(f: Frames) -> DataFrame:
    return f.mart()


@query
def combined_mart_local_clock(f: Frames) -> DataFrame:
    weather = hourly_weather_mood(f.readings, weather_tz=ZONE)
    mart = combined_mood(f.music(), weather, ["event_id"])
    return mart.groupBy("music_date", "has_weather_data").agg(
        F.count(F.lit(1)).alias("plays"),
        F.sum("song_mood").alias("song_mood_sum"),
        F.sum("weather_mood").alias("weather_mood_sum"),
    )


# --- landing and staging -------------------------------------------------------------


def _landed_pulls(f: Frames) -> DataFrame:
    path = shared_folder(f.spark, "music-pulls")
    sinks.land_json(adapters.music_pulls(f.plays), path)
    return scans.scan_music_pulls(f.spark, path)


@query
def landing_flatten(f: Frames) -> DataFrame:
    return flatten_tracks(_landed_pulls(f))


@query
def staged_plays(f: Frames) -> DataFrame:
    return stage_plays(_landed_pulls(f))


@query
def weather_records(f: Frames) -> DataFrame:
    path = shared_folder(f.spark, "weather-records")
    sinks.land_json(f.readings.drop("reading_id"), path)
    return scans.scan_weather_records(f.spark, path)


@query
def weather_gaps(f: Frames) -> DataFrame:
    """Labels and scores of landed readings with NaN values and fractional codes."""
    path = shared_folder(f.spark, "weather-gaps")
    sinks.land_json(adapters.gappy_readings(f.readings), path)
    return hourly_weather_mood(scans.scan_weather_records(f.spark, path)).select(
        "timestamp", "weathercode", "temperature_category", "cloud_category",
        "temperature_score", "cloud_score", "humidity_score", "precipitation_penalty",
        "weather_mood_raw",
    )


@query
def reject_counts(f: Frames) -> DataFrame:
    """Landed documents that do not fit, and tracks without a time, all counted."""
    path = shared_folder(f.spark, "broken-pulls")
    adapters.broken_pulls(f.plays).write.text(path)
    pulls = scans.scan_music_pulls(f.spark, path, rejects="keep")
    fits, tracks = F.col(scans.REJECT).isNull(), F.col("recenttracks.track")
    undated = F.filter(tracks, lambda t: t["date"]["#text"].isNull())
    return pulls.agg(
        F.count(F.lit(1)).alias("documents"),
        F.count_if(~fits).alias("rejected"),
        F.sum(F.when(fits, F.size(tracks))).alias("tracks"),
        F.sum(F.when(fits, F.size(undated))).alias("undated"),
    )


@query
def empty_guard(f: Frames) -> DataFrame:
    """An empty pull over a filled table leaves the table as it is."""
    root = shared_folder(f.spark, "guarded")
    name = "guarded_" + root.rsplit("-", 1)[1]
    sinks.write_table(f.plays, name, f"{root}/{name}")
    replaced = sinks.write_table(f.plays.where(F.lit(False)), name, f"{root}/{name}")
    return scans.scan_table(f.spark, name).agg(F.count(F.lit(1)).alias("rows")).withColumn(
        "replaced", F.lit(replaced)
    )


@query
def hourly_arrays(f: Frames) -> DataFrame:
    path = shared_folder(f.spark, "weather-arrays")
    sinks.land_json(adapters.weather_array_pulls(f.readings), path)
    return stage_weather_arrays(scans.scan_weather_arrays(f.spark, path))


@query
def positional_variables(f: Frames) -> DataFrame:
    pulls = adapters.weather_positional_pulls(f.readings)
    ticks = F.sequence("time_start", F.col("time_end") - 1, F.col("interval"))
    stamped = pulls.withColumn(
        "timestamp", F.transform(ticks, lambda s: iso_z(F.timestamp_seconds(s)))
    )
    rows = positional_to_rows(stamped, "variables", adapters.REQUEST_ORDER, "timestamp")
    return rows.withColumn("weathercode", F.col("weathercode").cast("bigint"))


@query
def records_json(f: Frames) -> DataFrame:
    columns = ("reading_id", "timestamp", "weathercode")
    return to_records(f.readings.select(*columns))


@query
def time_axis_per_user(f: Frames) -> DataFrame:
    spans = (
        f.events
        .groupBy("user_id")
        .agg(
            F.unix_timestamp(F.min("ts")).alias("lo"),
            F.unix_timestamp(F.max("ts")).alias("hi"),
            F.lit(6 * 3600).cast("bigint").alias("step"),
        )
    )
    return time_axis(spans, "lo", "hi", "step", "tick").select("user_id", "tick")


@query
def local_day_window(f: Frames) -> DataFrame:
    events = f.events
    return events.where(in_local_day(F.unix_timestamp("ts"), RUN_DATE, ZONE)).select(
        "event_id", "ts"
    )


@query
def local_days(f: Frames) -> DataFrame:
    days = (
        f.events
        .groupBy(local_date(F.col("ts"), ZONE).alias("local_day"))
        .agg(F.count(F.lit(1)).alias("events"))
    )
    first, last = local_day_bounds(F.col("local_day"), ZONE)
    return days.withColumns({"first_second": first, "last_second": last})


@query
def timestamp_text(f: Frames) -> DataFrame:
    stamped = f.events.select("event_id", iso_z(F.col("ts")).alias("text"))
    return stamped.withColumns(
        {
            "utc": parse_iso(F.col("text")),
            "from_local": parse_iso(F.col("text"), ZONE),
            "from_epoch": epoch_timestamp(
                F.unix_timestamp(parse_iso(F.col("text"))).cast("string")
            ),
        }
    )


@query
def recent_topk(f: Frames) -> DataFrame:
    events = f.events.select("event_id", "ts", "user_id")
    return picks.latest(events, [F.desc("ts"), F.desc("event_id")], 200)


@query
def recent_topk_per_user(f: Frames) -> DataFrame:
    events = f.events.select("event_id", "ts", "user_id")
    return picks.top_per_key(events, ["user_id"], [F.desc("ts"), F.desc("event_id")], 50)


@query
def distinct_rows(f: Frames) -> DataFrame:
    events = f.events
    return picks.distinct_rows(events.select("user_id", "event_type", F.to_date("ts").alias("day")))


@query
def profile(f: Frames) -> DataFrame:
    return measures.profile(f.plays)


@query
def preview(f: Frames) -> DataFrame:
    music = picks.ordered(f.music(), "played_at_ts", "event_id")
    return picks.preview(music.select("event_id", "track_name", "played_at_ts", "music_mood"), 5)


# --- materialised chain --------------------------------------------------------------


@query
def materialise(f: Frames) -> DataFrame:
    """Staging tables, views of the two models, mart table, read back by day."""
    root = shared_folder(f.spark, "tables")
    tag = root.rsplit("-", 1)[1]
    staged = {
        f"stg_plays_{tag}": f.plays,
        f"stg_tracks_{tag}": f.tracks,
        f"stg_weather_{tag}": f.readings,
    }
    for name, df in staged.items():
        sinks.write_table(df, name, f"{root}/{name}")
    plays, tracks, weather = (scans.scan_table(f.spark, name) for name in staged)
    sinks.publish_view(weather_mood(weather, tie_break=["reading_id"]), f"weather_{tag}")
    sinks.publish_view(music_mood(plays, tracks, ["event_id"]), f"music_{tag}")
    mart = combined_mood(
        scans.scan_table(f.spark, f"music_{tag}"),
        scans.scan_table(f.spark, f"weather_{tag}"),
        ["event_id"],
    )
    sinks.write_table(mart, f"mart_{tag}", f"{root}/mart", ["Event_Start_Timestamp"])
    return scans.scan_table(f.spark, f"mart_{tag}").select(
        "event_id", "Event_Start_Timestamp", "Content_Name", "song_mood", "weather_mood",
        "has_weather_data",
    )


@query
def row_counts(f: Frames) -> DataFrame:
    """Rows per stage of the music model, counted while one write runs them all."""
    plays, seen_plays = measures.counted(f.plays, "plays")
    cleaned, seen_cleaned = measures.counted(clean_plays(plays, ["event_id"]), "cleaned")
    best = best_metadata(f.tracks)
    matched, seen_matched = measures.counted(match_plays(cleaned, best), "matched")
    scored, seen_scored = measures.counted(score_music(matched, ["event_id"]), "scored")
    written(scored, "row-counts")
    stages = {
        "plays": seen_plays, "cleaned": seen_cleaned, "matched": seen_matched,
        "scored": seen_scored,
    }
    rows = [(name, seen.get["rows"]) for name, seen in stages.items()]
    return f.spark.createDataFrame(rows, "stage string, rows bigint")


@query
def daily_load(f: Frames) -> DataFrame:
    """The daily batch of one local day over landed documents, read back from its mart."""
    root = shared_folder(f.spark, "daily")
    folders = daily.Folders(*(f"{root}/{n}" for n in ("music", "hours", "p", "w", "mart")))
    sinks.land_json(adapters.music_pulls(f.plays), folders.music_json)
    sinks.land_json(f.readings.drop("reading_id"), folders.weather_json)
    counts = daily.run_daily(f.spark, RUN_DATE, folders, f.tracks, ZONE)
    if not counts["mart"]:
        return _daily_result(f.mart(()).where(F.lit(False)))
    return _daily_result(scans.scan_parquet(f.spark, folders.mart))


def _daily_result(mart: DataFrame) -> DataFrame:
    return mart.groupBy("music_date", "music_hour", "has_weather_data").agg(
        F.count(F.lit(1)).alias("plays"), F.sum("song_mood").alias("song_mood_sum")
    )


# Three pulls that overlap: which events each of them holds.
PULLS = {
    "2024-02-01": lambda e: e % 3 != 2,
    "2024-02-02": lambda e: e % 3 != 0,
    "2024-02-03": lambda e: e % 5 == 0,
}


def _loaded_pulls(f: Frames) -> incremental.Store:
    """Three overlapping pulls, each landed and loaded before the next.

    Documents, metadata and readings are derived from the tables once, not by every load.
    """
    root = shared_folder(f.spark, "pulls")
    names = ("landing", "plays", "filters", "manifest", "mart", "rollups")
    store = incremental.Store(*(f"{root}/{n}" for n in names))
    pulls = written(adapters.music_pulls(f.plays, ["event_id"]), "pull-documents")
    best = written(best_metadata(f.tracks), "best-metadata")
    readings = written(f.readings, "readings")
    for day, holds in PULLS.items():
        landed = pulls.where(holds(F.col("event_id"))).drop("event_id")
        incremental.land_pull(landed, store, day)
        incremental.load_pending(f.spark, store, best, readings, ZONE)
    release(pulls, best, readings)
    return store


@query
def incremental_plays(f: Frames) -> DataFrame:
    """Plays stored by loads of overlapping pulls, by local day."""
    return incremental.stored(f.spark, _loaded_pulls(f).plays, incremental.STORED)


@query
def load_manifest(f: Frames) -> DataFrame:
    """What each load staged, stored as new, knew already and could not date."""
    return incremental.stored(f.spark, _loaded_pulls(f).manifest, incremental.MANIFEST)


@query
def incremental_mart(f: Frames) -> DataFrame:
    """The mart after loads that each rebuilt only the days they touched."""
    return _daily_result(scans.scan_parquet(f.spark, _loaded_pulls(f).mart))


@query
def incremental_daily_music(f: Frames) -> DataFrame:
    """Music mood per day from partial roll-ups, of which loads replaced those they touched."""
    partials = scans.scan_parquet(f.spark, _loaded_pulls(f).rollups)
    return _rounded(rollups.music_days(partials))


# --- listening metrics ---------------------------------------------------------------


def _rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Averages depend on summation order in the last bits."""
    return df.select(
        *(
            F.round(f.name, digits).alias(f.name)
            if isinstance(f.dataType, T.DoubleType)
            else F.col(f.name)
            for f in df.schema.fields
        )
    )


@query
def listening_hourly(f: Frames) -> DataFrame:
    return _rounded(listening.hourly_listening(f.matched()))


@query
def listening_cumulative(f: Frames) -> DataFrame:
    return listening.cumulative_listening(clean_plays(f.plays, ["user_id"]))


@query
def listening_features_hour(f: Frames) -> DataFrame:
    return _rounded(listening.average_features(f.matched(), "hour"))


@query
def listening_features_day(f: Frames) -> DataFrame:
    return _rounded(listening.average_features(f.matched(), "day"))


# Loads in turn and the events each brings: on time, two late ones, and the first late one again.
LOADS = [
    ("on-time", lambda e: e % 7 != 3),
    ("late", lambda e: e % 14 == 3),
    ("later", lambda e: e % 14 == 10),
    ("late", lambda e: e % 14 == 3),
]


def _late_partials(f: Frames) -> DataFrame:
    """Feature partials of all loads, two of which hold plays of days loaded before."""
    path = shared_folder(f.spark, "features")
    matched = written(f.matched(), "matched")
    for load, holds in LOADS:
        partials = listening.feature_partials(matched.where(holds(F.col("event_id"))))
        rollups.store_load(partials, path, load, "play_date")
    release(matched)
    return rollups.stored_loads(f.spark, path, partials.schema, "play_date")


@query
def late_features_hour(f: Frames) -> DataFrame:
    """Feature means per user and hour, merged from the partials of late loads."""
    return _rounded(listening.folded_features(_late_partials(f), "hour"))


@query
def late_features_day(f: Frames) -> DataFrame:
    """Feature means per user and day, merged from the same partials."""
    return _rounded(listening.folded_features(_late_partials(f), "day"))


@query
def listening_deviation(f: Frames) -> DataFrame:
    return _rounded(listening.baseline_deviation(f.music(["user_id"])), 4)


@query
def daily_mood(f: Frames) -> DataFrame:
    weather = f.hours
    return _rounded(listening.daily_mood(f.music(()), weather))


# --- stream --------------------------------------------------------------------------


@query
def stream_hourly(f: Frames) -> DataFrame:
    best = written(best_metadata(f.tracks), "best-metadata")
    weather = written(f.hours, "weather-hours")
    raw = adapters.table(f.spark, f.folder, "events")
    stream = scans.stream_parquet(f.spark, f"{f.folder}/events.parquet", raw.schema)
    events = stream.withColumn("ts", F.col("ts").cast("timestamp"))
    mart = hourly.live_mart(adapters.plays(events, f.part, f.part.count()), best, weather, ["event_id"])
    hours = hourly.hourly_listening(hourly.deduplicated(mart, ["event_id"]))
    out = shared_folder(f.spark, "stream-hours")
    hourly.append_to(hours, f"{out}/rows", f"{out}/checkpoint").awaitTermination()
    return f.spark.read.schema(hours.schema).parquet(f"{out}/rows")


# --- training ------------------------------------------------------------------------

STAMP_HEADER = "Event Start Timestamp"


@query
def csv_roundtrip(f: Frames) -> DataFrame:
    """Mart export to CSV with the header the training set has, features from the scan."""
    path = shared_folder(f.spark, "mart-csv")
    mart = training.with_combined_target(f.mart())
    export = mart.withColumnRenamed("Event_Start_Timestamp", STAMP_HEADER)
    sinks.write_csv(export, path)
    loaded = scans.scan_csv(f.spark, path, export.schema)
    return training.feature_frame(loaded, "combined_mood", STAMP_HEADER, ["event_id"])


@query
def metadata_csv(f: Frames) -> DataFrame:
    """Metadata from a file with an index column, columns in another order and quoted titles."""
    path = shared_folder(f.spark, "metadata-csv")
    title = F.concat("track_name", F.lit(' "live, '), "artists", F.lit('"'))
    listed = f.tracks.withColumn("track_name", title)
    sinks.write_csv(listed.select(F.lit(1).alias("index"), *reversed(listed.columns)), path)
    return scans.scan_metadata_csv(f.spark, path)


@query
def music_from_file(f: Frames) -> DataFrame:
    """The model on metadata that two files of different column order brought into its table."""
    root = shared_folder(f.spark, "metadata-load")
    odd = F.pmod(F.xxhash64("track_id"), F.lit(2)) == 1
    columns = f.tracks.columns
    sinks.write_csv(f.tracks.where(odd), f"{root}/files/one")
    sinks.write_csv(f.tracks.where(~odd).select(*reversed(columns)), f"{root}/files/two")
    name = "stg_metadata_" + root.rsplit("-", 1)[1]
    landed = scans.scan_metadata_csv(f.spark, f"{root}/files/*")
    sinks.write_table(landed, name, f"{root}/table")
    return music_mood(f.plays, scans.scan_table(f.spark, name), ["event_id"])


@query
def split_md5(f: Frames) -> DataFrame:
    bucket = md5_bucket(["event_id"])
    return f.mart().select(
        "event_id", bucket.alias("bucket"), (bucket < 80).alias("is_train")
    )


def _simple_predictions(f: Frames) -> DataFrame:
    """A stand-in predictor (the song mood) whose metrics any engine can recompute."""
    mart = training.with_combined_target(f.mart()).dropna(subset=["combined_mood"])
    return mart.select(
        F.col("combined_mood").alias("actual"),
        F.col("song_mood").cast("double").alias("prediction"),
    )


@query
def regression_metrics(f: Frames) -> DataFrame:
    return _rounded(training.regression_metrics(_simple_predictions(f)))


@query
def residual_bins(f: Frames) -> DataFrame:
    return _rounded(training.residual_bins(_simple_predictions(f)))


def _combined_model(f: Frames) -> training.Trained:
    # Training reads its input many times, so it is written once.
    mart = training.with_combined_target(f.mart())
    stamp, key = "Event_Start_Timestamp", ["event_id"]
    needed = written(training.training_columns(mart, stamp, key), "training-mart")
    return training.train_mood(needed, "combined_mood", stamp, key, "drop")


@query
def rf_train(f: Frames) -> DataFrame:
    return training.regression_metrics(_combined_model(f).predictions())


@query
def rf_importance(f: Frames) -> DataFrame:
    return _combined_model(f).importances()


def _weather_model(f: Frames) -> training.Trained:
    hours = f.hours.withColumnRenamed(
        "timestamp_converted", "time"
    )
    data = written(hours.drop("timestamp", "date"), "training-weather")
    return training.train_mood(data, "weather_mood", "time", ["reading_id"], "drop")


def _reloaded(f: Frames, trained: training.Trained) -> training.Trained:
    path = shared_folder(f.spark, "weather-model")
    trained.save(path)
    return replace(trained, model=training.PipelineModel.load(path))


@query
def rf_weather(f: Frames) -> DataFrame:
    """The second training task, through a saved and reloaded model."""
    return training.regression_metrics(_reloaded(f, _weather_model(f)).predictions())


@query
def rf_checks(f: Frames) -> DataFrame:
    """What any engine can tell of a fit: rows, features, sums, a bound on the error."""
    trained = _weather_model(f)
    again = _reloaded(f, trained)
    metrics = training.regression_metrics(trained.predictions())
    weights = trained.importances().agg(
        F.count(F.lit(1)).alias("features"), F.round(F.sum("importance"), 6).alias("importance")
    )
    both = trained.predictions().exceptAll(again.predictions()).agg(
        (F.count(F.lit(1)) == 0).alias("reloaded_same")
    )
    return metrics.select(
        F.col("n").alias("test_rows"),
        F.lit(weights.first()["features"]).cast("bigint").alias("features"),
        F.lit(weights.first()["importance"]).alias("importance"),
        (F.col("r2") > 0.8).alias("fits"),
        F.lit(both.first()["reloaded_same"]).alias("reloaded_same"),
    )
