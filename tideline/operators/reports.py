"""Reports: status, lag, errors (CT13, ST8, JN3, JN4)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tideline.functions.types import epoch_seconds


def status(sources: DataFrame, received: DataFrame, replayed: DataFrame, now: str | None = None) -> DataFrame:
    """JN3, ST8: each source with read_lag (now - last received) and replay_lag (received - replayed) in seconds, null if never.

    received and replayed have source and a time; now is a timestamp text, by default the current time.
    """
    at = F.to_timestamp_ntz(F.lit(now)) if now else F.current_timestamp().cast("timestamp_ntz")
    joined = sources.join(received.select("source", F.col("ts").alias("received")), "source", "left").join(replayed.select("source", F.col("ts").alias("replayed")), "source", "left")
    seconds = lambda a, b: epoch_seconds(a) - epoch_seconds(b)
    return joined.withColumn("read_lag", seconds(at, F.col("received"))).withColumn("replay_lag", seconds(F.col("received"), F.col("replayed")))


def errors(log: DataFrame, sources: DataFrame) -> DataFrame:
    """JN4: error rows with what is known of their source."""
    return log.join(sources, "source", "left")
