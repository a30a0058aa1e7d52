"""The live dashboard and the burst check over a stream of actions.

Event time must be a TIMESTAMP (cast a timestamp without time zone first). An hour
is final once the watermark has passed its end; later rows are dropped.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from bazaarlake.functions.common import count_if, sum_if
from bazaarlake.operators.behavior import BURST_THRESHOLD


def _hours(events: DataFrame, time: str, delay: str, id_column: str) -> DataFrame:
    """Events once each, although the source may deliver them again within `delay`."""
    return events.withWatermark(time, delay).dropDuplicatesWithinWatermark([id_column])


def live_hours(
    events: DataFrame,
    time: str = "action_time",
    amount: str = "value",
    delay: str = "1 hour",
    id_column: str = "action_id",
) -> DataFrame:
    """Hour: orders, their money, and page views; one row per finished hour."""
    return (
        _hours(events, time, delay, id_column)
        .groupBy(F.window(time, "1 hour").alias("w"))
        .agg(
            count_if("action_code = 'order'").alias("order_count"),
            sum_if("action_code = 'order'", amount).alias("gmv"),
            count_if("action_code = 'page_view'").alias("view_count"),
        )
        .select(F.col("w.start").alias("hour_start"), "order_count", "gmv", "view_count")
    )


def live_bursts(
    events: DataFrame,
    time: str = "action_time",
    threshold: int = BURST_THRESHOLD,
    delay: str = "1 hour",
    id_column: str = "action_id",
) -> DataFrame:
    """(user, hour) with at least `threshold` events, one row per finished hour."""
    return (
        _hours(events, time, delay, id_column)
        .groupBy(F.window(time, "1 hour").alias("w"), "user_id")
        .agg(F.count(F.lit(1)).alias("event_count"))
        .where(F.col("event_count") >= threshold)
        .select("user_id", F.col("w.start").alias("hour_start"), "event_count")
    )


def append_to(df: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Write what is available now and stop; a restart continues from the checkpoint."""
    return (
        df.writeStream.format("parquet")
        .outputMode("append")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
