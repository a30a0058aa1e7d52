"""Detail facts: cleaned, standardised and widened."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bazaarlake.functions.common import (
    MONEY,
    OPEN_END,
    UNKNOWN,
    date_id,
    is_paid,
    latest_per_key,
    order_status_name,
    payment_way_name,
    present,
)
from bazaarlake.operators.dim import dim_sku_full

SKU_NAMES = (
    "sku_name",
    "tm_id",
    "tm_name",
    "category1_id",
    "category1_name",
    "category2_id",
    "category2_name",
    "category3_id",
    "category3_name",
)


def _sku_attributes(sku_dim: DataFrame, *skip: str) -> DataFrame:
    wanted = [c for c in SKU_NAMES if c in sku_dim.columns and c not in skip]
    return sku_dim.select("sku_id", *wanted)


def _widen(fact: DataFrame, sku_dim: DataFrame) -> DataFrame:
    """Left join of the SKU attributes; columns the fact already has win."""
    return fact.join(_sku_attributes(sku_dim, *fact.columns), "sku_id", "left")


def dwd_order_detail(
    details: DataFrame, sku_dim: DataFrame, amount: Column | None = None
) -> DataFrame:
    """Valid order lines with SKU attributes and the line amount."""
    valid = details.where(
        present(details, "id", "order_id", "sku_id")
        & (F.col("sku_num") > 0)
        & (F.col("order_price") >= 0)
    )
    amount = F.col("order_price") * F.col("sku_num") if amount is None else amount
    return _widen(valid.withColumn("order_amount", amount.cast(MONEY)), sku_dim)


def dwd_order_detail_daily(
    details: DataFrame, orders: DataFrame, amount: Column | None = None
) -> DataFrame:
    """Compact order lines: user and province from the order header (inner join).
    Reductions are taken off if the lines carry them, and are 0 otherwise."""
    header = orders.select(F.col("id").alias("order_id"), "user_id", "province_id")
    amount = F.col("order_price") * F.col("sku_num") if amount is None else amount
    none = F.lit(0).cast(MONEY)
    lines = details.select(
        "id",
        "order_id",
        "sku_id",
        "create_time",
        "sku_num",
        amount.cast(MONEY).alias("original_amount"),
        *[
            (F.coalesce(c, none) if c in details.columns else none).alias(c)
            for c in ("activity_reduce", "coupon_reduce")
        ],
    )
    final = F.col("original_amount") - F.col("activity_reduce") - F.col("coupon_reduce")
    return lines.join(header, "order_id").select(
        "*", final.cast(MONEY).alias("final_amount"), date_id("create_time").alias("date_id")
    )


def dwd_order_info(orders: DataFrame, user_dim: DataFrame, province_dim: DataFrame) -> DataFrame:
    """Valid orders with normalised codes, user and province attributes.

    user_dim is the zipper; only its open versions match, one per user.
    """
    users = user_dim.where(F.col("end_date") == OPEN_END).select(
        F.col("id").alias("user_id"),
        "user_level",
        *([F.col("gender").alias("user_gender")] if "gender" in user_dim.columns else []),
    )
    provinces = province_dim.select(
        F.col("id").alias("province_id"),
        F.col("name").alias("province_name"),
        "region_id",
        "region_name",
    )
    named = dwd_order_info_clean(orders)
    joined = named.join(users, "user_id", "left").join(provinces, "province_id", "left")
    for column in ("user_level", "user_gender", "province_name"):
        if column in joined.columns:
            joined = joined.withColumn(column, F.coalesce(column, F.lit(UNKNOWN)))
    return joined


def dwd_order_info_clean(orders: DataFrame) -> DataFrame:
    """The part of dwd_order_info that needs no dimension."""
    named = orders.where(present(orders, "id", "user_id")).select(
        "*",
        order_status_name().alias("order_status_name"),
        payment_way_name().alias("payment_way_name"),
        (F.col("total_amount") - F.col("feight_fee")).cast(MONEY).alias("goods_amount"),
        date_id("create_time").alias("date_id"),
    )
    return named.withColumn("is_paid", is_paid("order_status_name").cast("int"))


def dwd_order_info_daily(orders: DataFrame) -> DataFrame:
    """Compact projection of the order header."""
    return orders.select(
        "id",
        "user_id",
        "province_id",
        "order_status",
        "total_amount",
        "payment_way",
        "create_time",
        date_id("create_time").alias("date_id"),
    )


def dwd_payment_info(payments: DataFrame, orders: DataFrame) -> DataFrame:
    """Payments with the province of their order."""
    header = orders.select(F.col("id").alias("order_id"), "province_id")
    return (
        payments.where(present(payments, "order_id"))
        .join(header, "order_id", "left")
        .withColumn("date_id", date_id("create_time"))
    )


def _action(
    feed: DataFrame,
    code: str,
    name: str,
    target_type: str,
    action_id: Column,
    target_id: Column,
    time: str,
) -> DataFrame:
    return feed.where(F.col("user_id").isNotNull()).select(
        "user_id",
        "sku_id",
        "session_id",
        action_id.cast("string").alias("action_id"),
        F.lit(code).alias("action_code"),
        F.lit(name).alias("action_name"),
        F.col(time).alias("action_time"),
        target_id.cast("string").alias("action_target_id"),
        F.lit(target_type).alias("action_target_type"),
        date_id(time).alias("date_id"),
        *[c for c in ("seen", "dt") if c in feed.columns],
    )


# Display names of the four actions.
ACTION_NAMES = {
    "page_view": "页面浏览",
    "favor_add": "收藏商品",
    "cart_add": "加购物车",
    "order": "下单",
}


def dwd_action(
    page_views: DataFrame,
    favors: DataFrame,
    carts: DataFrame,
    orders: DataFrame,
    sku_dim: DataFrame | None = None,
) -> DataFrame:
    """Four behaviour feeds as one log, optionally with SKU attributes."""
    log = (
        _action(page_views, "page_view", ACTION_NAMES["page_view"], "page",
                F.lit(None), F.col("page_id"), "action_time")
        .unionByName(
            _action(favors, "favor_add", ACTION_NAMES["favor_add"], "sku",
                    F.col("favor_id"), F.col("sku_id"), "create_time")
        )
        .unionByName(
            _action(carts, "cart_add", ACTION_NAMES["cart_add"], "sku",
                    F.col("cart_id"), F.col("sku_id"), "create_time")
        )
        .unionByName(
            _action(orders, "order", ACTION_NAMES["order"], "order",
                    F.col("order_detail_id"), F.col("order_id"), "create_time")
        )
    )
    return log if sku_dim is None else _widen(log, sku_dim)


def dwd_order_refund(refunds: DataFrame, orders: DataFrame, sku_dim: DataFrame) -> DataFrame:
    """Refunds with the order's user and province and the SKU's attributes."""
    columns = [c for c in ("user_id", "province_id") if c not in refunds.columns]
    header = orders.select(F.col("id").alias("order_id"), *columns)
    valid = refunds.where(present(refunds, "order_id"))
    return _widen(valid.join(header, "order_id", "left"), sku_dim).withColumn(
        "date_id", date_id("create_time")
    )


def dwd_review_info(reviews: DataFrame, sku_dim: DataFrame) -> DataFrame:
    """Reviews with the SKU's attributes; anonymous reviews are left out."""
    return _widen(reviews.where(F.col("user_id").isNotNull()), sku_dim)


def _dated(feed: DataFrame, key: str = "id") -> DataFrame:
    return feed.where(present(feed, key)).withColumn("date_id", date_id("create_time"))


def dwd_order_status_log(log: DataFrame) -> DataFrame:
    """Status changes with normalised status and the day of the change."""
    return (
        log.where(present(log, "id", "order_id"))
        .withColumn("order_status", order_status_name())
        .withColumn("change_time", F.col("operate_time"))
        .withColumn("date_id", date_id("operate_time"))
    )


def dwd_sku_info(skus: DataFrame, brands: DataFrame, c3: DataFrame, c2: DataFrame, c1: DataFrame) -> DataFrame:
    """SKU fact view of the flattened snowflake."""
    return dim_sku_full(skus, brands, c3, c2, c1).withColumnRenamed("sku_id", "id")


def dwd_coupon_info(coupons: DataFrame) -> DataFrame:
    return coupons.where(present(coupons, "id"))


def dwd_coupon_use(uses: DataFrame) -> DataFrame:
    return _dated(uses).withColumnRenamed("create_time", "get_time")


def dwd_activity_info(activities: DataFrame) -> DataFrame:
    return activities.where(present(activities, "id"))


def dwd_activity_order(participations: DataFrame, orders: DataFrame) -> DataFrame:
    """Campaign participations with the buyer of their order."""
    header = orders.select(F.col("id").alias("order_id"), "user_id")
    if "user_id" in participations.columns:
        return _dated(participations)
    return _dated(participations).join(header, "order_id", "left")


def dwd_comment_info(comments: DataFrame) -> DataFrame:
    return _dated(comments)


def dwd_favor_info(favors: DataFrame) -> DataFrame:
    return _dated(favors)


def dwd_cart_info(carts: DataFrame, purchases: DataFrame) -> DataFrame:
    """Cart rows flagged '1' if the user bought the SKU, at any time."""
    bought = purchases.select("user_id", "sku_id").distinct().withColumn("bought", F.lit("1"))
    return (
        _dated(carts)
        .join(bought, ["user_id", "sku_id"], "left")
        .withColumn("is_ordered", F.coalesce("bought", F.lit("0")))
        .drop("bought")
    )


def dwd_customer_service(tickets: DataFrame) -> DataFrame:
    return _dated(tickets)


def drop_duplicate_rows(df: DataFrame, keys: list[str], newest_by: list[str]) -> DataFrame:
    """Keep the newest version of each business key."""
    return latest_per_key(df, keys, newest_by)
