"""The stand-alone batch reports over raw orders, order lines and users."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bazaarlake.functions.common import (
    count_if,
    date_id,
    divide,
    money_sum,
    order_status_name,
)


def payment_way_stats(orders: DataFrame) -> DataFrame:
    """Orders and money by payment way, most used first."""
    return (
        orders.groupBy("payment_way")
        .agg(F.count(F.lit(1)).alias("order_cnt"), money_sum("total_amount").alias("gmv"))
        .orderBy(F.col("order_cnt").desc(), "payment_way")
    )


def gmv_overview(orders: DataFrame) -> DataFrame:
    """One row: orders, paid orders, money, money per order."""
    totals = orders.agg(
        F.count(F.lit(1)).alias("order_cnt"),
        count_if(order_status_name() == "PAID").alias("paid_cnt"),
        money_sum("total_amount").alias("gmv"),
    )
    return totals.select("*", divide(F.col("gmv"), F.col("order_cnt")).alias("avg_amount"))


def hot_sku_top10(lines: DataFrame, n: int = 10) -> DataFrame:
    """The n SKUs with most pieces sold."""
    return (
        lines.groupBy("sku_id")
        .agg(F.sum("sku_num").cast("bigint").alias("total_qty"), money_sum("order_amount").alias("total_gmv"))
        .orderBy(F.col("total_qty").desc(), "sku_id")
        .limit(n)
    )


def user_level_dist(users: DataFrame) -> DataFrame:
    """Users per level."""
    return users.groupBy("user_level").agg(F.count(F.lit(1)).alias("user_count"))


def daily_order_trend(orders: DataFrame) -> DataFrame:
    """Orders and money per day."""
    return (
        orders.groupBy(date_id("create_time").alias("day"))
        .agg(F.count(F.lit(1)).alias("order_cnt"), money_sum("total_amount").alias("gmv"))
        .orderBy("day")
    )


QUARTILES = {"p25": 0.25, "p50": 0.5, "p75": 0.75}


def order_amount_summary(orders: DataFrame, bucket_width: int = 1000) -> DataFrame:
    """Count, extremes and exact quartiles (linear interpolation) of the order amount.

    Orders are counted per distinct amount, and the counts are accumulated inside
    amount buckets and across them, so no task sees more than one bucket's amounts
    or one row per bucket.
    """
    bucket = F.floor(F.col("amount") / bucket_width)
    amounts = (
        orders.where(F.col("total_amount").isNotNull())
        .groupBy(F.col("total_amount").alias("amount"))
        .agg(F.count(F.lit(1)).alias("n"))
        .withColumn("bucket", bucket)
    )
    sizes = amounts.groupBy("bucket").agg(F.sum("n").alias("rows"))
    # One row per bucket: bounded by the range of amounts.
    earlier = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        "bucket",
        F.coalesce(F.sum("rows").over(earlier), F.lit(0)).alias("before"),
        F.sum("rows").over(Window.partitionBy()).alias("total"),
    )
    inside = Window.partitionBy("bucket").orderBy("amount")
    ranked = amounts.withColumn("upto", F.sum("n").over(inside)).join(offsets, "bucket")
    upto = F.col("upto") + F.col("before")

    def at(index: Column) -> Column:
        return F.min(F.when(upto > index, F.col("amount"))).cast("double")

    positions = {name: (F.col("total") - 1) * q for name, q in QUARTILES.items()}
    found = ranked.agg(
        F.max("total").alias("cnt"),
        F.min("amount").cast("double").alias("min_amount"),
        F.max("amount").cast("double").alias("max_amount"),
        *[at(F.floor(pos)).alias(f"{name}_low") for name, pos in positions.items()],
        *[at(F.ceil(pos)).alias(f"{name}_high") for name, pos in positions.items()],
        *[F.max(pos - F.floor(pos)).alias(f"{name}_part") for name, pos in positions.items()],
    )
    return found.select(
        "cnt",
        "min_amount",
        *[
            F.round(
                F.col(f"{name}_low")
                + (F.col(f"{name}_high") - F.col(f"{name}_low")) * F.col(f"{name}_part"),
                2,
            ).alias(name)
            for name in QUARTILES
        ],
        "max_amount",
    )
