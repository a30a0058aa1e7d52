"""The registered queries: every operator over the sample tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bazaarlake.functions.common import OPEN_END, last_year, latest_per_key, on_days, shift
from bazaarlake.operators import activity, ads, batch, behavior, bitmaps, dim, dwd, dws, quality, quantiles
from bazaarlake.sources.files import created_on
from bazaarlake.sources.sample import (
    EVENT_DAY,
    FEED_DAYS,
    ORDER_DAY,
    SNAPSHOT_DAYS,
    Sample,
)

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

RUN_TS = "2024-01-31 00:00:00"
SEGMENTS = ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY")


def edge(df: DataFrame) -> DataFrame:
    """Comparable result types: decimals as double, integers as bigint, times as text."""
    columns = []
    for field in df.schema.fields:
        column = F.col(field.name)
        if isinstance(field.dataType, T.DecimalType):
            column = column.cast("double")
        elif isinstance(field.dataType, (T.IntegerType, T.ShortType, T.ByteType)):
            column = column.cast("bigint")
        elif isinstance(field.dataType, (T.TimestampType, T.TimestampNTZType)):
            column = F.date_format(column, "yyyy-MM-dd HH:mm:ss")
        columns.append(column.alias(field.name))
    return df.select(*columns)


def query(fn: Callable[[Sample], DataFrame]) -> Callable[[Sample], DataFrame]:
    """Register fn under its name."""
    QUERIES[fn.__name__] = lambda spark, path: edge(fn(Sample(spark, path)))
    return fn


# Dimensions ---------------------------------------------------------------


@query
def dim_user_init(s: Sample) -> DataFrame:
    return dim.dim_user_init(s.users(), shift(ORDER_DAY, -1))


def _zipper(s: Sample, step: Callable[..., DataFrame], first: DataFrame) -> DataFrame:
    history = first
    for day in FEED_DAYS[1:]:
        history = step(history, s.user_feed(day), day)
    return history


@query
def dim_user_zip_update(s: Sample) -> DataFrame:
    def step(history: DataFrame, feed: DataFrame, day: str) -> DataFrame:
        return dim.dim_user_zip_update(history, feed, day, ["user_level"])

    return _zipper(s, step, dim.dim_user_init(s.user_feed(FEED_DAYS[0]), FEED_DAYS[0]))


@query
def dim_user_scd2(s: Sample) -> DataFrame:
    first = dim.dim_user_init(s.user_feed(FEED_DAYS[0]), FEED_DAYS[0])
    return _zipper(s, dim.dim_user_scd2, first.withColumn("is_current", F.lit("1")))


@query
def dim_user_scd3(s: Sample) -> DataFrame:
    def step(previous: DataFrame, feed: DataFrame, day: str) -> DataFrame:
        return dim.dim_user_scd3(previous, feed, day, ["user_level"])

    first = dim.dim_user_scd3_init(s.user_feed(FEED_DAYS[0]), FEED_DAYS[0], ["user_level"])
    return _zipper(s, step, first)


@query
def dim_user_snapshot(s: Sample) -> DataFrame:
    return dim.dim_user_snapshot(s.user_feeds(), FEED_DAYS[-1])


@query
def dim_user_scd1(s: Sample) -> DataFrame:
    names = s.users().select("id", "name")
    return dim.dim_user_scd1(s.user_feeds().join(names, "id")).drop("dt")


@query
def dim_sku(s: Sample) -> DataFrame:
    return dim.dim_sku(s.sku_info())


@query
def dim_sku_full(s: Sample) -> DataFrame:
    return dim.dim_sku_full(
        s.sku_info(),
        dim.dim_brand(s.trademarks()),
        dim.dim_category3(s.category3()),
        dim.dim_category2(s.category2()),
        dim.dim_category1(s.category1()),
    ).select("sku_id", "sku_name", "tm_name", "category3_name", "category2_name", "category1_name")


@query
def dim_province(s: Sample) -> DataFrame:
    return dim.dim_province(s.provinces(), s.regions())


@query
def dim_time(s: Sample) -> DataFrame:
    ordered = s.table("orders").select(F.col("o_orderdate").cast("date").alias("day"))
    acted = s.table("events").select(F.col("ts").cast("date").alias("day"))
    return dim.dim_time(ordered.unionByName(acted)).drop("holiday_name")


@query
def dim_trademark(s: Sample) -> DataFrame:
    return dim.dim_trademark(s.trademarks())


@query
def dim_brand(s: Sample) -> DataFrame:
    return dim.dim_brand(s.trademarks())


@query
def dim_category1(s: Sample) -> DataFrame:
    return dim.dim_category1(s.category1())


@query
def dim_category2(s: Sample) -> DataFrame:
    return dim.dim_category2(s.category2())


@query
def dim_category3(s: Sample) -> DataFrame:
    return dim.dim_category3(s.category3())


@query
def dim_spu(s: Sample) -> DataFrame:
    spus = s.sku_info().select("id", F.col("sku_name").alias("spu_name"), "tm_id", "category3_id")
    return dim.dim_spu(spus)


@query
def dim_payment_type(s: Sample) -> DataFrame:
    return dim.dim_payment_type(s.order_info())


@query
def dim_activity(s: Sample) -> DataFrame:
    return dim.dim_activity(s.activities())


@query
def dim_coupon(s: Sample) -> DataFrame:
    return dim.dim_coupon(s.coupons())


@query
def order_accumulating_snapshot(s: Sample) -> DataFrame:
    snapshot = dim.empty_order_snapshot(s.spark, s.order_feed(SNAPSHOT_DAYS[0]))
    for day in SNAPSHOT_DAYS:
        snapshot = dim.order_accumulating_snapshot(snapshot, s.order_feed(day), day)
    return snapshot


# Detail facts -------------------------------------------------------------

LINE_AMOUNT = "order_price"


@query
def dwd_order_detail(s: Sample) -> DataFrame:
    buyers = s.order_info().select(F.col("id").alias("order_id"), "user_id")
    details = dwd.dwd_order_detail(s.order_detail(), s.sku_dim(), F.col(LINE_AMOUNT))
    return details.join(buyers, "order_id").select(
        "order_id", "user_id", "sku_id", "sku_name", "tm_name", "category3_name", "sku_num", "order_amount"
    )


@query
def dwd_order_detail_daily(s: Sample) -> DataFrame:
    return dwd.dwd_order_detail_daily(
        s.order_detail(), s.order_info_with_province(), F.col(LINE_AMOUNT)
    ).drop("create_time")


def _zip_users(s: Sample) -> DataFrame:
    return s.users().select("*", F.lit(OPEN_END).alias("end_date"))


@query
def dwd_order_info(s: Sample) -> DataFrame:
    provinces = dim.dim_province(s.provinces(), s.regions())
    return dwd.dwd_order_info(s.order_info_with_province(), _zip_users(s), provinces).select(
        "id",
        "user_id",
        "order_status_name",
        "payment_way_name",
        "user_level",
        "province_name",
        "total_amount",
        "goods_amount",
        "is_paid",
        "date_id",
    )


@query
def dwd_order_info_daily(s: Sample) -> DataFrame:
    return dwd.dwd_order_info_daily(s.order_info_with_province()).drop("create_time")


@query
def dwd_payment_info(s: Sample) -> DataFrame:
    orders = dwd.dwd_order_info_clean(s.order_info())
    payments = orders.where(F.col("is_paid") == 1).select(
        F.col("id").alias("order_id"),
        "user_id",
        "total_amount",
        F.col("order_status_name").alias("payment_status"),
        "create_time",
    )
    return dwd.dwd_payment_info(payments, s.order_info_with_province()).drop("create_time")


@query
def dwd_action(s: Sample) -> DataFrame:
    log = dwd.dwd_action(
        s.action_feed("view", "page_id", "action_time"),
        s.action_feed("signup", "favor_id", "create_time"),
        s.action_feed("click", "cart_id", "create_time"),
        s.action_feed("purchase", "order_detail_id", "create_time"),
        s.sku_dim(),
    )
    return log.select(
        "user_id",
        "sku_id",
        "action_id",
        "action_code",
        "action_name",
        "action_time",
        "action_target_id",
        "action_target_type",
        "tm_name",
        "category3_name",
        "date_id",
    )


@query
def dwd_order_refund(s: Sample) -> DataFrame:
    refunds = s.refunds().select(
        "order_id", "user_id", "sku_id", "refund_num", "refund_amount", "create_time"
    )
    return dwd.dwd_order_refund(refunds, s.order_info_with_province(), s.sku_dim()).select(
        "order_id",
        "user_id",
        "sku_id",
        "refund_num",
        "refund_amount",
        "province_id",
        "category3_name",
        "tm_name",
        "date_id",
    )


@query
def dwd_review_info(s: Sample) -> DataFrame:
    return dwd.dwd_review_info(s.reviews(), s.sku_dim()).select(
        "review_id", "user_id", "sku_id", "review_star", "category3_name", "tm_name"
    )


@query
def dwd_order_status_log(s: Sample) -> DataFrame:
    return dwd.dwd_order_status_log(s.status_log()).select(
        "id", "order_id", "order_status", "operate_user_id", "date_id"
    )


@query
def dwd_sku_info(s: Sample) -> DataFrame:
    return dwd.dwd_sku_info(
        s.sku_info(),
        dim.dim_brand(s.trademarks()),
        dim.dim_category3(s.category3()),
        dim.dim_category2(s.category2()),
        dim.dim_category1(s.category1()),
    )


@query
def dwd_coupon_info(s: Sample) -> DataFrame:
    return dwd.dwd_coupon_info(s.coupons())


@query
def dwd_coupon_use(s: Sample) -> DataFrame:
    return dwd.dwd_coupon_use(s.coupon_uses())


@query
def dwd_activity_info(s: Sample) -> DataFrame:
    return dwd.dwd_activity_info(s.activities())


@query
def dwd_activity_order(s: Sample) -> DataFrame:
    return dwd.dwd_activity_order(s.activity_orders().drop("user_id"), s.order_info()).drop(
        "create_time"
    )


def _comments(s: Sample) -> DataFrame:
    return s.reviews().select(
        F.col("review_id").alias("id"),
        "user_id",
        "sku_id",
        F.col("review_star").alias("appraisal_star"),
        "create_time",
    )


@query
def dwd_comment_info(s: Sample) -> DataFrame:
    return dwd.dwd_comment_info(_comments(s))


@query
def dwd_favor_info(s: Sample) -> DataFrame:
    favors = s.action_feed("signup", "id", "create_time").drop("session_id", "order_id")
    return dwd.dwd_favor_info(favors)


@query
def dwd_cart_info(s: Sample) -> DataFrame:
    carts = s.action_feed("click", "id", "create_time").drop("session_id", "order_id")
    return dwd.dwd_cart_info(carts, s.action_feed("purchase", "id", "create_time"))


@query
def dwd_customer_service(s: Sample) -> DataFrame:
    return dwd.dwd_customer_service(s.tickets())


@query
def order_dedup_latest(s: Sample) -> DataFrame:
    """The newest line of every (order, line number): the sample repeats the key."""
    lines = s.table("lineitem").select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_linenumber").alias("line_number"),
        F.col("l_partkey").alias("sku_id"),
        F.col("l_extendedprice").alias("amount"),
        F.col("l_shipdate").alias("ship_time"),
    )
    return latest_per_key(lines, ["order_id", "line_number"], ["ship_time", "sku_id", "amount"])


# Daily aggregates ---------------------------------------------------------


def _orders(s: Sample, days: int | None = None) -> DataFrame:
    return dwd.dwd_order_info_clean(s.order_info(days))


def _home_orders(s: Sample, days: int | None = None) -> DataFrame:
    """Orders with the province id alone; names join what is aggregated by it."""
    return dwd.dwd_order_info_clean(s.order_info_with_province(days))


def _with_province_names(s: Sample, stats: DataFrame) -> DataFrame:
    provinces = dim.dim_province(s.provinces(), s.regions()).select(
        F.col("id").alias("province_id"), F.col("name").alias("province_name"), "region_id", "region_name"
    )
    return stats.join(provinces, "province_id", "left")


@query
def dws_gmv_stats(s: Sample) -> DataFrame:
    return dws.dws_gmv_stats(_orders(s))


@query
def dws_user_action_stats(s: Sample) -> DataFrame:
    return dws.dws_user_action_stats(s.actions())


@query
def dws_user_action_order_stats(s: Sample) -> DataFrame:
    """The action aggregate with its order, payment and refund branches."""
    lines = s.lines()
    return dws.dws_user_action_stats(s.actions(), lines, s.refunds())


@query
def dws_sku_stats(s: Sample) -> DataFrame:
    lines = s.lines()
    names = s.sku_dim().select("sku_id", "tm_id", "category3_id")
    return dws.dws_sku_stats(lines, s.refunds(), names)


@query
def dws_user_stats(s: Sample) -> DataFrame:
    levels = s.users().select(F.col("id").alias("user_id"), "user_level")
    so_far = F.col("create_time") < shift(ORDER_DAY, 1)
    orders = dwd.dwd_order_info_clean(s.order_info().where(so_far)).join(levels, "user_id", "left")
    return dws.dws_user_stats(orders, s.lines().where(so_far), ORDER_DAY, s.actions())


@query
def user_favorite_period(s: Sample) -> DataFrame:
    return dws.user_favorite_period(s.actions())


@query
def dws_province_stats(s: Sample) -> DataFrame:
    return _with_province_names(s, dws.dws_province_stats(_home_orders(s)))


@query
def dws_trademark_stats(s: Sample) -> DataFrame:
    return dws.dws_trademark_stats(s.sku_lines().drop("tm_name"))


def _category_lines(s: Sample, days: int | None = None) -> DataFrame:
    return s.sku_lines(days).drop("category3_name")


@query
def dws_category_stats(s: Sample) -> DataFrame:
    return dws.dws_category_stats(_category_lines(s))


@query
def dws_order_day(s: Sample) -> DataFrame:
    lines = s.lines()
    return dws.dws_order_day(_orders(s), s.refunds(), s.coupon_uses(), s.activity_orders())


@query
def dws_user_day(s: Sample) -> DataFrame:
    return dws.dws_user_day(_orders(s), s.actions(), dwd.dwd_comment_info(_comments(s)))


@query
def dws_sku_day(s: Sample) -> DataFrame:
    lines = s.lines()
    return dws.dws_sku_day(lines, s.refunds(), s.actions())


@query
def dws_order_week(s: Sample) -> DataFrame:
    return dws.dws_order_week(_orders(s), s.refunds())


@query
def dws_order_month(s: Sample) -> DataFrame:
    return dws.dws_order_month(_orders(s), s.refunds())


@query
def dws_user_new_day(s: Sample) -> DataFrame:
    return dws.dws_user_new_day(_orders(s), s.users().drop("name"))


@query
def dws_user_retention_day(s: Sample) -> DataFrame:
    return dws.dws_user_retention_day(s.actions())


@query
def dws_trademark_day(s: Sample) -> DataFrame:
    return dws.dws_trademark_day(s.sku_lines().drop("tm_name"))


@query
def dws_category3_day(s: Sample) -> DataFrame:
    return dws.dws_category3_day(_category_lines(s))


@query
def dws_province_day(s: Sample) -> DataFrame:
    return _with_province_names(s, dws.dws_province_day(_home_orders(s)))


@query
def dws_coupon_day(s: Sample) -> DataFrame:
    return dws.dws_coupon_day(s.coupon_uses(), dim.dim_coupon(s.coupons()))


@query
def dws_activity_day(s: Sample) -> DataFrame:
    return dws.dws_activity_day(s.activity_orders(), dim.dim_activity(s.activities()))


@query
def dws_customer_service_day(s: Sample) -> DataFrame:
    return dws.dws_customer_service_day(dwd.dwd_customer_service(s.tickets()))


@query
def dws_page_view_day(s: Sample) -> DataFrame:
    return dws.dws_page_view_day(s.events().where("event_type = 'view'"), "ts")


# Reports ------------------------------------------------------------------

MONTH = 30


@query
def ads_gmv_day(s: Sample) -> DataFrame:
    return ads.ads_gmv_day(_orders(s, MONTH), ORDER_DAY, s.refunds(MONTH))


@query
def ads_gmv_day_bitmaps(s: Sample) -> DataFrame:
    """The same report from daily sums and daily sets of buyers and refunded orders."""
    orders, refunds = _orders(s, MONTH), s.refunds(MONTH)
    users = bitmaps.new_numbers(None, orders, "user_id")
    returned = bitmaps.new_numbers(None, refunds, "order_id")
    return bitmaps.gmv_day(
        bitmaps.order_totals(orders),
        bitmaps.order_users(orders, users),
        bitmaps.refund_totals(refunds),
        bitmaps.refunded_orders(refunds, returned),
        ORDER_DAY,
    )


@query
def ads_user_retention(s: Sample) -> DataFrame:
    return ads.ads_user_retention(s.actions(), EVENT_DAY)


@query
def ads_user_retention_orders(s: Sample) -> DataFrame:
    """Retention of buyers: cohorts by first order day over the whole history."""
    return ads.ads_user_retention(_orders(s), ORDER_DAY, cohort_days=None)


def _action_masks(s: Sample) -> DataFrame:
    """The masks of the last day, from all days at once."""
    return activity.update_masks(None, s.actions(), EVENT_DAY)


@query
def dws_user_action_days(s: Sample) -> DataFrame:
    return _action_masks(s)


@query
def dws_user_retention_day_masks(s: Sample) -> DataFrame:
    return activity.user_retention_day(_action_masks(s))


@query
def ads_user_retention_masks(s: Sample) -> DataFrame:
    return activity.user_retention(_action_masks(s), EVENT_DAY)


@query
def ads_user_retention_detail_masks(s: Sample) -> DataFrame:
    return activity.user_retention_detail(_action_masks(s), EVENT_DAY)


@query
def ads_user_activity_masks(s: Sample) -> DataFrame:
    return activity.user_activity(_action_masks(s), EVENT_DAY)


@query
def ads_user_retention_detail(s: Sample) -> DataFrame:
    return ads.ads_user_retention_detail(s.actions(), EVENT_DAY)


@query
def ads_sku_sales_rank(s: Sample) -> DataFrame:
    lines = s.lines(MONTH)
    names = s.sku_dim().select("sku_id", "sku_name", "tm_name", "category3_name")
    return ads.ads_sku_sales_rank(lines, ORDER_DAY, s.refunds(MONTH), names)


@query
def ads_sku_sales_rank_top100(s: Sample) -> DataFrame:
    return ads.ads_sku_sales_rank_top100(s.lines(7), ORDER_DAY, s.sku_dim())


@query
def ads_conversion_rate(s: Sample) -> DataFrame:
    return ads.ads_conversion_rate(s.actions(MONTH), EVENT_DAY)


@query
def ads_conversion_funnel(s: Sample) -> DataFrame:
    return ads.ads_conversion_funnel(s.actions(MONTH), EVENT_DAY)


@query
def ads_user_repurchase_rate(s: Sample) -> DataFrame:
    return ads.ads_user_repurchase_rate(_orders(s, MONTH), ORDER_DAY)


@query
def ads_user_repurchase_rate_daily(s: Sample) -> DataFrame:
    """The same report from the daily table of users."""
    return ads.ads_user_repurchase_rate(None, ORDER_DAY, daily=dws.dws_user_day(_orders(s, MONTH)))


@query
def ads_user_activity(s: Sample) -> DataFrame:
    return ads.ads_user_activity(s.actions(MONTH), EVENT_DAY)


@query
def ads_user_active_day(s: Sample) -> DataFrame:
    return ads.ads_user_active_day(s.actions(MONTH), EVENT_DAY)


@query
def ads_category_sale_analysis(s: Sample) -> DataFrame:
    lines = s.sku_lines(MONTH)
    return ads.ads_category_sale_analysis(lines, s.sku_refunds(MONTH), ORDER_DAY)


@query
def ads_province_sale(s: Sample) -> DataFrame:
    return _with_province_names(s, ads.ads_province_sale(_home_orders(s, MONTH), ORDER_DAY))


@query
def ads_gmv_trend(s: Sample) -> DataFrame:
    compared = on_days("create_time", [ORDER_DAY, shift(ORDER_DAY, -1), last_year(ORDER_DAY)])
    orders = dwd.dwd_order_info_clean(s.order_info().where(compared))
    return ads.ads_gmv_trend(orders, ORDER_DAY)


@query
def ads_gmv_trend_series(s: Sample) -> DataFrame:
    return ads.ads_gmv_trend_series(_orders(s))


def _sku_names(s: Sample) -> DataFrame:
    return s.sku_dim().select("sku_id", "sku_name", "category3_name")


@query
def ads_sku_repurchase_analysis(s: Sample) -> DataFrame:
    return ads.ads_sku_repurchase_analysis(s.lines(), sku_dim=_sku_names(s))


@query
def ads_sku_repurchase_recent(s: Sample) -> DataFrame:
    """The report's own window, the last 31 days."""
    return ads.ads_sku_repurchase_analysis(s.lines(31), ORDER_DAY, sku_dim=_sku_names(s))


def _reasoned_refunds(s: Sample, days: int | None = None) -> DataFrame:
    return s.sku_refunds(days).select(
        "order_id",
        "user_id",
        "refund_amount",
        F.col("create_time").alias("refund_time"),
        F.col("order_time").alias("create_time"),
        F.col("category3_name").alias("category_name"),
        F.col("line_status").alias("refund_reason_type"),
        "date_id",
    )


@query
def ads_refund_analysis(s: Sample) -> DataFrame:
    return ads.ads_refund_analysis(_reasoned_refunds(s), s.order_info())


@query
def ads_refund_analysis_day(s: Sample) -> DataFrame:
    """Of the business day alone."""
    return ads.ads_refund_analysis(_reasoned_refunds(s, 1), _orders(s, 1), ORDER_DAY)


@query
def ads_dashboard(s: Sample) -> DataFrame:
    types = s.sku_dim().select("sku_id", F.col("category2_id").alias("category"))
    actions = s.actions(1).join(types, "sku_id", "left")
    return ads.ads_dashboard(actions, EVENT_DAY, 23, "value", "category")


@query
def ads_gmv_province(s: Sample) -> DataFrame:
    return _with_province_names(s, ads.ads_gmv_province(_home_orders(s, MONTH), ORDER_DAY))


@query
def ads_gmv_trademark(s: Sample) -> DataFrame:
    return ads.ads_gmv_trademark(s.sku_lines(MONTH).drop("tm_name"), ORDER_DAY)


@query
def ads_gmv_category(s: Sample) -> DataFrame:
    return ads.ads_gmv_category(_category_lines(s, MONTH), ORDER_DAY)


@query
def ads_trademark_stats(s: Sample) -> DataFrame:
    lines = s.sku_lines(MONTH).drop("tm_name")
    return ads.ads_trademark_stats(lines, s.sku_refunds(MONTH), ORDER_DAY)


@query
def ads_province_stats(s: Sample) -> DataFrame:
    orders = _home_orders(s, MONTH)
    # A refund of the window may be of an older order.
    home = s.order_info_with_province().select(F.col("id").alias("order_id"), "province_id")
    refunds = s.refunds(MONTH).join(home, "order_id")
    return _with_province_names(s, ads.ads_province_stats(orders, refunds, ORDER_DAY))


@query
def ads_user_new_day(s: Sample) -> DataFrame:
    return ads.ads_user_new_day(dws.dws_user_new_day(_orders(s), s.users()), SEGMENTS)


@query
def ads_sku_exposure_click(s: Sample) -> DataFrame:
    """Views are exposures; a click counts as one and, as in all other queries, as a cart add."""
    log = s.events().select("sku_id", F.col("event_type").alias("action_code"))
    return ads.ads_sku_exposure_click(log, "view", "click", "click")


@query
def ads_order_stats(s: Sample) -> DataFrame:
    orders = s.actions().where(F.col("action_code") == "order")
    return ads.ads_order_stats(orders, "action_time", "value")


@query
def ads_hot_sku(s: Sample) -> DataFrame:
    """Needs nothing of the order header, so the lines are not joined with it."""
    lines = s.table("lineitem").select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_partkey").alias("sku_id"),
        F.col("l_quantity").cast("bigint").alias("sku_num"),
        F.col("l_extendedprice").cast("decimal(16,2)").alias("order_amount"),
        F.lit(0).alias("is_paid"),
    )
    return ads.ads_hot_sku(lines)


@query
def ads_dau_by_device(s: Sample) -> DataFrame:
    return ads.ads_dau_by_device(s.device_stats())


@query
def ads_campaign_effect(s: Sample) -> DataFrame:
    return ads.ads_campaign_effect(s.campaign_stats())


@query
def ads_traffic_source(s: Sample) -> DataFrame:
    return ads.ads_traffic_source(s.traffic_stats())


@query
def ads_coupon_usage(s: Sample) -> DataFrame:
    return ads.ads_coupon_usage(s.coupon_uses(MONTH), dim.dim_coupon(s.coupons()), ORDER_DAY)


@query
def ads_activity_stats(s: Sample) -> DataFrame:
    return ads.ads_activity_stats(s.activity_orders(MONTH), dim.dim_activity(s.activities()), ORDER_DAY)


@query
def ads_customer_service(s: Sample) -> DataFrame:
    return ads.ads_customer_service(dwd.dwd_customer_service(s.tickets()), EVENT_DAY)


# Batch job ----------------------------------------------------------------


@query
def payment_way_stats(s: Sample) -> DataFrame:
    raw = s.table("orders").select(
        F.col("o_orderpriority").alias("payment_way"),
        F.col("o_totalprice").cast("decimal(16,2)").alias("total_amount"),
    )
    return batch.payment_way_stats(raw)


@query
def gmv_overview(s: Sample) -> DataFrame:
    return batch.gmv_overview(s.order_info())


@query
def hot_sku_top10(s: Sample) -> DataFrame:
    lines = s.table("lineitem").select(
        F.col("l_partkey").alias("sku_id"),
        F.col("l_quantity").cast("bigint").alias("sku_num"),
        F.col("l_extendedprice").cast("decimal(16,2)").alias("order_amount"),
    )
    return batch.hot_sku_top10(lines)


@query
def user_level_dist(s: Sample) -> DataFrame:
    return batch.user_level_dist(s.users())


@query
def daily_order_trend(s: Sample) -> DataFrame:
    return batch.daily_order_trend(s.order_info())


@query
def order_amount_summary(s: Sample) -> DataFrame:
    return batch.order_amount_summary(s.order_info())


@query
def order_amount_windows(s: Sample) -> DataFrame:
    """Quartiles of the last 1, 7 and 30 days from daily counts per amount."""
    return quantiles.amount_windows(quantiles.daily_amounts(_orders(s, MONTH)), ORDER_DAY)


# Behaviour log ------------------------------------------------------------


def _clicks(s: Sample) -> DataFrame:
    """The lines that adaptive cleaning keeps, which all analyses of the log read."""
    cleaned, _ = behavior.clean_adaptive(s.raw_lines(), RUN_TS)
    return behavior.valid(cleaned)


@query
def log_clean_adaptive(s: Sample) -> DataFrame:
    return _clicks(s)


@query
def log_clean_strict(s: Sample) -> DataFrame:
    return behavior.log_clean_strict(s.raw_lines())


@query
def log_clean_repair(s: Sample) -> DataFrame:
    return behavior.log_clean_repair(s.raw_lines())


@query
def log_clean_fill(s: Sample) -> DataFrame:
    return behavior.log_clean_fill(s.raw_lines(), RUN_TS).drop("reason")


@query
def log_quarantine(s: Sample) -> DataFrame:
    return behavior.quarantine(behavior.log_clean_strict(s.raw_lines()))


@query
def log_clean_outcomes(s: Sample) -> DataFrame:
    return behavior.clean_outcomes(behavior.log_clean_strict(s.raw_lines()))


@query
def clean_adaptive(s: Sample) -> DataFrame:
    return behavior.retention_by_strategy(s.raw_lines())


@query
def log_basic_stats(s: Sample) -> DataFrame:
    return behavior.log_basic_stats(_clicks(s))


@query
def action_type_stats(s: Sample) -> DataFrame:
    return behavior.action_type_stats(_clicks(s))


@query
def top_products(s: Sample) -> DataFrame:
    return behavior.top_products(_clicks(s))


@query
def hourly_activity(s: Sample) -> DataFrame:
    return behavior.hourly_activity(_clicks(s))


@query
def category_conversion(s: Sample) -> DataFrame:
    return behavior.category_conversion(_clicks(s), s.product_lookup(), "view", "click", "purchase")


@query
def user_paths(s: Sample) -> DataFrame:
    return behavior.user_paths(_clicks(s))


@query
def common_trigrams(s: Sample) -> DataFrame:
    return behavior.common_trigrams(_clicks(s))


@query
def burst_users(s: Sample) -> DataFrame:
    return behavior.burst_users(_clicks(s))


@query
def suspicious_ips(s: Sample) -> DataFrame:
    return behavior.suspicious_ips(_clicks(s))


@query
def data_range(s: Sample) -> DataFrame:
    return behavior.data_range(_clicks(s))


# Ingest filter and checks -------------------------------------------------


@query
def ingest_incremental(s: Sample) -> DataFrame:
    """The orders created on one day, as the incremental ingest selects them."""
    return created_on(s.order_info(), ORDER_DAY).select("id", "user_id", "total_amount", "create_time")


def _layers(s: Sample) -> dict[str, DataFrame]:
    return {
        "ods_user_info": s.users(),
        "ods_sku_info": s.sku_info(),
        "ods_order_info": s.order_info(),
        "ods_order_detail": s.table("lineitem"),
        "dwd_order_info": _orders(s),
        "dwd_action": s.actions(),
        "dwd_order_refund": s.refunds(),
        "dws_user_day": dws.dws_user_day(_orders(s)),
    }


@query
def layer_row_counts(s: Sample) -> DataFrame:
    return quality.layer_row_counts(_layers(s))


@query
def layer_row_counts_by_dt(s: Sample) -> DataFrame:
    """Rows per table and day."""
    orders = _orders(s).withColumnRenamed("date_id", "dt")
    actions = s.actions().withColumnRenamed("date_id", "dt")
    return quality.layer_row_counts({"dwd_order_info": orders, "dwd_action": actions}, by_dt=True)


@query
def quality_gate(s: Sample) -> DataFrame:
    """The gate over the layer counts, asking more users than there are."""
    return quality.quality_gate(
        quality.layer_row_counts(_layers(s)), {"ods_user_info": 10**12, "dwd_action": 1000}
    )


@query
def expired_partitions(s: Sample) -> DataFrame:
    days = s.actions().select(F.lit("dwd_action").alias("table_name"), F.col("date_id").alias("dt"))
    return quality.expired_partitions(days.distinct(), EVENT_DAY)
