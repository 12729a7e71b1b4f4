"""Hourly listening from a stream of plays.

The batch transforms are reused as they are; only the watermark, the duplicate removal
and the tumbling window are particular to the stream.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from skytune.plans.mart import combined_mood
from skytune.plans.music import clean_plays, match_plays, score_music

LATENESS = "1 hour"
STAMP = "Event_Start_Timestamp"


def live_mart(
    plays: DataFrame, best: DataFrame, weather: DataFrame, keep: Sequence[str] = ()
) -> DataFrame:
    """The mart over a stream of plays, by stream-static joins.

    Every micro-batch evaluates the static sides anew, so ``best`` (best metadata) and
    ``weather`` (scored hours) should be written tables rather than plans.
    """
    matched = match_plays(clean_plays(plays, keep), best)
    return combined_mood(score_music(matched, keep), weather, keep)


def deduplicated(
    plays: DataFrame, keys: Sequence[str], stamp: str = STAMP, lateness: str = LATENESS
) -> DataFrame:
    """First copy of each play; state is kept only as long as the watermark needs it."""
    return plays.withWatermark(stamp, lateness).dropDuplicatesWithinWatermark(list(keys))


def hourly_listening(plays: DataFrame, stamp: str = STAMP) -> DataFrame:
    """Closed tumbling hours of mart rows; plays later than the watermark are dropped."""
    return (
        plays.groupBy(F.window(stamp, "1 hour").alias("w"))
        .agg(
            F.count(F.lit(1)).alias("plays"),
            F.sum("song_mood").alias("mood_sum"),
            F.sum("duration_ms").alias("played_ms"),
            F.max("weather_mood").alias("weather_mood"),
        )
        .select(
            F.col("w.start").alias("window_start"),
            "plays",
            "mood_sum",
            "played_ms",
            "weather_mood",
        )
    )


def append_to(
    stream: DataFrame, path: str, checkpoint: str, available_now: bool = True
) -> StreamingQuery:
    """Exactly-once parquet sink; ``available_now`` drains the source and stops."""
    writer = (
        stream.writeStream.format("parquet")
        .outputMode("append")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
    )
    return (writer.trigger(availableNow=True) if available_now else writer).start()
