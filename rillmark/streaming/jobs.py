"""The monthly increment as streams: daily totals of incoming events, and scoring against fixed fits."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.anomaly import return_period
from ..operators.integrate import plain_stat, wet_day_fraction


def daily_totals(events: DataFrame, keys: list[str], time: str, value: str, delay: str) -> DataFrame:
    """Sums per key and day of an event stream; rows later than ``delay`` behind the newest are dropped.

    In append mode a day comes out once, when it can no longer change.
    """
    days = events.withWatermark(time, delay).groupBy(*keys, F.window(time, "1 day").alias("_w"))
    return days.agg(plain_stat("sum", F.col(value)).alias(value)).select(*keys, F.to_date("_w.start").alias("day"), value)


def run_to_files(stream: DataFrame, path: str, checkpoint: str, drain: bool = False) -> StreamingQuery:
    """Append the stream to a parquet table, each row once; ``drain`` stops when the source is read."""
    writer = stream.writeStream.format("parquet").outputMode("append").option("path", path).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if drain else writer).start()


def monthly_wet_days(daily: DataFrame, keys: list[str], value: str, threshold: float, scale: float = 1.0) -> DataFrame:
    """Wet-day share of the days that have come out so far."""
    return wet_day_fraction(daily, keys, value, threshold, scale)


def score(observations: DataFrame, fits: DataFrame, on: list[str], value: str) -> DataFrame:
    """Anomalies and return periods of a stream of observations: a stream-static join, no state."""
    return return_period(observations, fits, on, value)


def run_scored(stream: DataFrame, path: str, checkpoint: str, drain: bool = False) -> StreamingQuery:
    """Write each micro-batch to its own partition, replaced as a whole when the batch is repeated after a failure."""

    def write(batch: DataFrame, number: int) -> None:
        (batch.withColumn("batch", F.lit(number)).write.partitionBy("batch").mode("overwrite")
         .option("partitionOverwriteMode", "dynamic").parquet(path))

    writer = stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if drain else writer).start()
