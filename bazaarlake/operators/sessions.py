"""Sessions carried over midnight.

A day's sessions are a table of their own: those that ended by a gap, in the folder of the day that saw
the gap, and those still open at midnight, as far as they have come. The next day takes up the open
ones, so a session over midnight is one session, a day's views are read once, and any
split of the log into days gives the sessions of the whole log.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bazaarlake.functions.common import shift
from bazaarlake.operators.dws import in_sessions, session_minutes

# Longer gaps could leave a session open for more than one midnight without a view.
MAX_GAP_SECONDS = 12 * 3600


def _midnight_after(day: Column) -> Column:
    return F.unix_micros(F.date_add(day.cast("date"), 1).cast("timestamp"))


def daily_sessions(
    carried: DataFrame | None,
    views: DataFrame,
    time: str,
    first: str,
    last: str,
    gap_seconds: int = 1800,
) -> DataFrame:
    """Sessions as the days `first` to `last` leave them, one row per (dt, session).

    views: user_id and time of these days; carried: the open rows of the day before `first`, None to
    start with. is_open rows of a dt are the sessions that may go on the next day; the others ended
    and are in one dt only. date_id is the day of the session's start, times are microseconds.
    A view without a readable time is left out.
    """
    if gap_seconds > MAX_GAP_SECONDS:
        raise ValueError(f"gap_seconds must be at most {MAX_GAP_SECONDS}")
    readable = views.withColumn("at", F.col(time).try_cast("timestamp")).where(F.col("at").isNotNull())
    day = F.date_format(F.timestamp_micros("last"), "yyyy-MM-dd")
    # A time with a zone of its own may lie on a neighbouring day.
    minutes = session_minutes(readable, "at", gap_seconds).withColumn(
        "day", F.greatest(F.least(day, F.lit(last)), F.lit(first))
    )
    if carried is not None:
        minutes = minutes.unionByName(
            carried.where("is_open").select(
                "user_id",
                F.floor(F.col("session_start") / F.lit(60_000_000)).alias("minute"),
                F.col("views").alias("events"),
                F.col("session_start").alias("first"),
                F.col("session_end").alias("last"),
                F.lit(shift(first, -1)).alias("day"),
            )
        )
    ordered = Window.partitionBy("user_id").orderBy("minute")
    so_far = Window.partitionBy("user_id", "session_start").orderBy("minute")
    rows = (
        in_sessions(minutes, gap_seconds)
        .withColumn("next_day", F.lead("day").over(ordered))
        .withColumn("next_start", F.lead("session_start").over(ordered))
        .withColumn("views", F.sum("events").over(so_far.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    )
    reaches = _midnight_after(F.col("day")) - F.col("last") <= gap_seconds * 1_000_000
    ends_day = ~F.col("next_day").eqNullSafe(F.col("day"))
    ends = ~F.col("next_start").eqNullSafe(F.col("session_start"))
    tomorrow = F.date_format(F.date_add(F.col("day").cast("date"), 1), "yyyy-MM-dd")

    def row(when: Column, dt: Column, is_open: bool) -> Column:
        return F.when(when, F.struct(dt.alias("dt"), F.lit(is_open).alias("is_open")))

    places = F.array_compact(
        F.array(
            row(ends_day & reaches, F.col("day"), True),
            row(ends & ~reaches, F.col("day"), False),
            row(ends & reaches & (F.col("day") < last), tomorrow, False),
        )
    )
    return rows.withColumn("place", F.explode(places)).where(F.col("place.dt") >= first).select(
        "user_id",
        "session_start",
        F.col("last").alias("session_end"),
        "views",
        F.date_format(F.timestamp_micros("session_start"), "yyyy-MM-dd").alias("date_id"),
        "place.is_open",
        "place.dt",
    )


def as_of(sessions: DataFrame, biz_date: str) -> DataFrame:
    """All sessions known at the end of a day: the ended ones, and the day's open ones as far as they came."""
    ended = ~F.col("is_open") & (F.col("dt") <= biz_date)
    return sessions.where(ended | (F.col("is_open") & (F.col("dt") == biz_date)))
