"""Calls as they come: the aggregates of the evaluation over an unbounded table, with a bound on lateness."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def timed(stream: DataFrame, time: str) -> DataFrame:
    """Event times as instants; watermarks don't take local times. A column that has a watermark stays as it is."""
    return stream if dict(stream.dtypes)[time] == "timestamp" else stream.withColumn(time, F.col(time).cast("timestamp"))


def windowed_counts(stream: DataFrame, time: str = "ts", by: str = "event_type", width: str = "10 minutes", late: str | None = "1 hour") -> DataFrame:
    """Counts and mean values by class in tumbling windows; rows later than `late` are left out, so state is bounded.

    late is None if the stream has its bound already.
    """
    bounded = stream if late is None else timed(stream, time).withWatermark(time, late)
    return bounded.groupBy(F.window(time, width), by).agg(F.count("*").alias("n"), F.avg("value").alias("mean_value"))


def without_repeats(stream: DataFrame, key: str = "event_id", time: str = "ts", late: str = "1 hour") -> DataFrame:
    return timed(stream, time).withWatermark(time, late).dropDuplicatesWithinWatermark([key])
