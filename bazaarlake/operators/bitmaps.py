"""Exact distinct counts over any window, out of daily tables.

Users (or refunded orders) carry a dense number, given once when they first appear. A day's
set of them is kept as bitmaps of 32,768 numbers each, one row per (group, day, bucket), at most 4 KB.
The sets of a window are or-ed and counted: a report reads the bitmaps of its days and
no fact. Dense numbers keep the bitmaps few: a set of n numbers lies in at most n of them, and all
users together in one for every 32,768.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bazaarlake.functions.common import RECENT_DAYS, divide, expand_recent_days, money_sum, shift
from bazaarlake.functions.ranking import distributed_row_number
from bazaarlake.operators.measures import order_measures


def new_numbers(known: DataFrame | None, ids: DataFrame, key: str) -> DataFrame:
    """key, number of the keys in ids that are not known yet, numbered on from the highest known
    number. Null keys get none; known is None or empty to start with."""
    new = ids.where(F.col(key).isNotNull()).select(key).distinct()
    first = 0
    if known is not None:
        new = new.join(known.select(key), key, "left_anti")
        highest = known.agg(F.max("number")).first()[0]
        first = 0 if highest is None else highest + 1
    numbered = distributed_row_number(new, [], [F.col(key)], "number")
    return numbered.select(key, (F.col("number") - 1 + first).alias("number"))


def daily_sets(
    rows: DataFrame,
    numbers: DataFrame,
    key: str,
    sets: Mapping[str, Column],
    keys: Sequence[str] = (),
) -> DataFrame:
    """(keys, date_id, bucket): a bitmap for each entry of `sets`, holding the numbers of the keys that
    have a row for which its condition is true. Rows are reduced to one per (group, day, key) before
    they meet the numbers. Null keys are in no set, and keys without a number stop the job."""
    marks = [F.max(F.when(condition, True)).alias(name) for name, condition in sets.items()]
    per_key = rows.where(F.col(key).isNotNull()).groupBy(*keys, "date_id", key).agg(*marks)
    number = F.coalesce("number", F.raise_error(F.lit(f"a {key} has no number")).cast("bigint"))
    numbered = per_key.join(numbers.select(key, "number"), key, "left").withColumn("number", number)
    # Buckets count from 1 and hold numbers from 1 on.
    return (
        numbered.withColumn("bucket", F.bitmap_bucket_number(F.col("number") + 1))
        .withColumn("bit", F.bitmap_bit_position(F.col("number") + 1))
        .groupBy(*keys, "date_id", "bucket")
        .agg(*[F.bitmap_construct_agg(F.when(F.col(name), F.col("bit"))).alias(name) for name in sets])
    )


def distinct_in_windows(
    sets: DataFrame,
    names: Sequence[str],
    biz_date: str,
    keys: Sequence[str] = (),
    days: Sequence[int] = RECENT_DAYS,
) -> DataFrame:
    """(recent_days, keys): size of each named set over the window, 0 where it is empty. Each bitmap
    is read once for all windows. A group without a day in the longest window has no row; without
    keys there is one row per window whatever the input."""
    inside = sets.where(F.col("date_id").between(shift(biz_date, 1 - max(days)), biz_date))

    def merged(name: str, k: int) -> Column:
        return F.bitmap_or_agg(F.when(F.col("date_id") >= shift(biz_date, 1 - k), F.col(name)))

    per_bucket = inside.groupBy(*keys, "bucket").agg(*[merged(n, k).alias(f"{n}_{k}") for n in names for k in days])
    sizes = per_bucket.groupBy(*keys).agg(
        *[F.coalesce(F.sum(F.bitmap_count(f"{n}_{k}")), F.lit(0)).alias(f"{n}_{k}") for n in names for k in days]
    )
    windows = F.array(
        *[F.struct(F.lit(k).alias("recent_days"), *[F.col(f"{n}_{k}").alias(n) for n in names]) for k in days]
    )
    return sizes.select(*keys, F.explode(windows).alias("w")).select("w.recent_days", *keys, *[f"w.{n}" for n in names])


# Order headers by day ------------------------------------------------------

_COUNTS = ("order_count", "order_user_count", "payment_count", "completed_order_count")
_MONEY = ("gmv", "goods_amount", "feight_fee", "discount_amount", "payment_amount", "completed_gmv")


def order_totals(orders: DataFrame) -> DataFrame:
    """date_id: the counts and sums of order headers that add up over days."""
    return order_measures(orders, ["date_id"]).select("date_id", *_COUNTS, *_MONEY)


def order_users(orders: DataFrame, numbers: DataFrame) -> DataFrame:
    """(date_id, bucket): who ordered, and who ordered something that is paid."""
    return daily_sets(orders, numbers, "user_id", {"buyers": F.lit(True), "payers": F.col("is_paid") == 1})


def refund_totals(refunds: DataFrame) -> DataFrame:
    """date_id: money given back."""
    return refunds.groupBy("date_id").agg(money_sum("refund_amount").alias("refund_amount"))


def refunded_orders(refunds: DataFrame, numbers: DataFrame) -> DataFrame:
    """(date_id, bucket): the orders of which something came back."""
    return daily_sets(refunds, numbers, "order_id", {"refunded": F.lit(True)})


def gmv_day(
    totals: DataFrame, users: DataFrame, refund_sums: DataFrame, refunded: DataFrame, biz_date: str
) -> DataFrame:
    """The report ads_gmv_day makes from order headers and refunds, from the four daily tables."""
    sums = (
        expand_recent_days(totals, "date_id", biz_date)
        .groupBy("recent_days")
        .agg(*[F.sum(c).alias(c) for c in _COUNTS], *[money_sum(c).alias(c) for c in _MONEY])
        .withColumnRenamed("order_user_count", "order_user_days")
    )
    given_back = (
        expand_recent_days(refund_sums, "date_id", biz_date)
        .groupBy("recent_days")
        .agg(money_sum("refund_amount").alias("refund_amount"))
    )
    none = F.lit(0)
    return (
        sums.join(distinct_in_windows(users, ["buyers", "payers"], biz_date), "recent_days")
        .join(distinct_in_windows(refunded, ["refunded"], biz_date), "recent_days")
        .join(given_back, "recent_days", "left")
        .select(
            "recent_days",
            "gmv",
            "order_count",
            F.col("buyers").alias("order_user_count"),
            "order_user_days",
            "goods_amount",
            "feight_fee",
            "discount_amount",
            "payment_amount",
            "payment_count",
            F.col("payers").alias("payment_user_count"),
            F.col("completed_gmv").alias("completed_amount"),
            F.col("completed_order_count").alias("completed_count"),
            divide(F.col("gmv"), F.col("order_count")).alias("avg_order_amount"),
            divide(F.col("payment_amount"), F.col("payment_count")).alias("avg_pay_amount"),
            F.coalesce("refund_amount", none).alias("refund_amount"),
            F.col("refunded").alias("refund_count"),
            (F.col("payment_amount") - F.coalesce("refund_amount", none)).alias("net_sales_amount"),
        )
    )
