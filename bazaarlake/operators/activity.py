"""Active days per user as bit masks, carried on from day to day.

A row per user holds two masks of MASK_DAYS bits: bit k of `recent` says whether the user was active k
days before the mask's day, bit k of `since_first` whether on the k-th day after create_date, the
first active day. A day's masks are yesterday's, shifted and or-ed with the day's activity; rows of
earlier days that arrive late set the bits of their day. Retention and active-user counts are then
bit tests over one folder: no report reads the days it counts.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bazaarlake.functions.common import count_if, pct, shift
from bazaarlake.operators.ads import retention_columns, retention_rows

MASK_DAYS = 63
_ALL = (1 << MASK_DAYS) - 1


def update_masks(previous: DataFrame | None, activity: DataFrame, biz_date: str, days: int = 1) -> DataFrame:
    """user_id, create_date, since_first, recent as of biz_date.

    previous: the masks of `days` days before, None to start with; activity: user_id and date_id of the
    day and of any earlier days with new rows. A day before the known first one becomes the first,
    and since_first counts from it. Later days, and rows without a user, are left out.
    """
    seen = activity.where(F.col("user_id").isNotNull() & (F.col("date_id") <= biz_date))
    # As many days as the activity has, whatever its rows.
    new = seen.groupBy("user_id").agg(F.collect_set("date_id").alias("days"))
    if previous is None:
        joined = new.selectExpr(
            "user_id", "days", "cast(null AS string) AS create_date", "0L AS since_first", "0L AS recent"
        )
    else:
        joined = previous.select("user_id", "create_date", "since_first", "recent").join(new, "user_id", "full_outer")
    first = F.least("create_date", F.array_min("days"))
    return joined.withColumn("first", first).select(
        "user_id",
        F.col("first").alias("create_date"),
        F.expr(f"""
            if(datediff(create_date, first) < {MASK_DAYS}, shiftleft(since_first, datediff(create_date, first)) & {_ALL}L, 0L)
            | aggregate(coalesce(days, array()), 0L, (m, d) ->
                m | if(datediff(d, first) < {MASK_DAYS}, shiftleft(1L, datediff(d, first)), 0L))
        """).alias("since_first"),
        F.expr(f"""
            {f'shiftleft(coalesce(recent, 0L), {days}) & {_ALL}L' if days < MASK_DAYS else '0L'}
            | aggregate(coalesce(days, array()), 0L, (m, d) ->
                m | if(datediff('{biz_date}', d) < {MASK_DAYS}, shiftleft(1L, datediff('{biz_date}', d)), 0L))
        """).alias("recent"),
    )


def _active(mask: str, k: int) -> Column:
    return F.getbit(mask, F.lit(k)) == 1


def active_users(masks: DataFrame, biz_date: str, days: int = MASK_DAYS) -> DataFrame:
    """date_id, active: users per day of the last `days` days, days without users left out."""
    counts = masks.agg(*[count_if(_active("recent", k)).alias(f"d{k}") for k in range(days)])
    cells = F.array(*[F.struct(F.lit(shift(biz_date, -k)).alias("date_id"), F.col(f"d{k}").alias("active")) for k in range(days)])
    return counts.select(F.explode(cells).alias("c")).select("c.*").where("active > 0")


def user_activity(masks: DataFrame, biz_date: str) -> DataFrame:
    """Daily, weekly and monthly active users and their ratios, one row."""
    counted = masks.agg(
        *[count_if(F.col("recent").bitwiseAND((1 << days) - 1) != 0).alias(name) for name, days in (("dau", 1), ("wau", 7), ("mau", 30))]
    )
    return counted.select(
        "*", pct(F.col("dau"), F.col("mau")).alias("dau_to_mau_rate"), pct(F.col("wau"), F.col("mau")).alias("wau_to_mau_rate")
    )


def _cohorts(masks: DataFrame, biz_date: str, cohort_days: int, offsets: Sequence[int]) -> DataFrame:
    """One row per first day: cohort size and users back on each offset, NULL where that day is
    not over yet."""
    if max(offsets) >= MASK_DAYS:
        raise ValueError(f"masks reach {MASK_DAYS - 1} days")
    age = F.datediff(F.lit(biz_date).cast("date"), F.col("create_date").cast("date"))
    return (
        masks.where(F.col("create_date").between(shift(biz_date, -cohort_days), biz_date))
        .groupBy("create_date")
        .agg(F.count(F.lit(1)).alias("new_user_count"), *[count_if(_active("since_first", k)).alias(f"__{k}") for k in offsets])
        .select("create_date", "new_user_count", *[F.when(age >= k, F.col(f"__{k}")).alias(f"back_{k}") for k in offsets])
    )


def user_retention(
    masks: DataFrame, biz_date: str, offsets: Sequence[int] = (1, 7, 14, 30), cohort_days: int = 30
) -> DataFrame:
    """(cohort day, retention day) as ads_user_retention has it, from the masks of the day."""
    if cohort_days >= MASK_DAYS:
        raise ValueError(f"daily counts reach {MASK_DAYS - 1} days")
    return retention_rows(_cohorts(masks, biz_date, cohort_days, offsets), active_users(masks, biz_date), offsets)


def user_retention_detail(
    masks: DataFrame, biz_date: str, offsets: Sequence[int] = (1, 3, 7, 14, 30), cohort_days: int = 90
) -> DataFrame:
    """Cohort day with a count and a rate per retention day, from the masks of the day."""
    return retention_columns(_cohorts(masks, biz_date, cohort_days, offsets), offsets)


def user_retention_day(masks: DataFrame, offsets: Sequence[int] = (1, 3, 7)) -> DataFrame:
    """One row per user and retention day the user came back on."""
    cells = F.array_compact(F.array(*[F.when(_active("since_first", k), F.lit(k).cast("bigint")) for k in offsets]))
    day = F.date_add(F.col("create_date").cast("date"), F.col("retention_day").cast("int"))
    return masks.select(
        "user_id", F.col("create_date").alias("cohort_day"), F.explode(cells).alias("retention_day"), "create_date"
    ).select("user_id", "cohort_day", "retention_day", F.date_format(day, "yyyy-MM-dd").alias("retention_date"))
