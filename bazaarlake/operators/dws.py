"""Daily subject aggregates. Each covers every day of its input in one pass; the
daily run hands in one day."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bazaarlake.functions.common import (
    count_if,
    date_id,
    divide,
    money_sum,
    pct,
    sum_if,
)
from bazaarlake.operators.measures import (
    combine,
    line_measures,
    order_measures,
)


def dws_gmv_stats(orders: DataFrame) -> DataFrame:
    """Day: orders, buyers, money, and the paid and completed share of it."""
    return order_measures(orders, ["date_id"]).select(
        "date_id",
        "order_count",
        "order_user_count",
        "gmv",
        "goods_amount",
        "feight_fee",
        "discount_amount",
        "avg_order_amount",
        "paid_order_count",
        "paid_gmv",
        "completed_order_count",
        "completed_gmv",
    )


def action_counts(actions: DataFrame, keys: list[str]) -> DataFrame:
    """Page views, cart adds, favourites and orders of the action log per `keys`."""
    code = F.col("action_code")
    return actions.groupBy(*keys).agg(
        count_if(code == "page_view").alias("page_view_count"),
        count_if(code == "cart_add").alias("cart_add_count"),
        count_if(code == "favor_add").alias("favor_add_count"),
        count_if(code == "order").alias("action_order_count"),
    )


def dws_user_action_stats(
    actions: DataFrame,
    lines: DataFrame | None = None,
    refunds: DataFrame | None = None,
) -> DataFrame:
    """(user, sku, day): actions, and with lines and refunds given also the orders,
    payments and refunds. Without lines the log's own order actions are counted."""
    keys = ["user_id", "sku_id", "date_id"]
    logged = action_counts(actions, keys)
    if lines is None:
        return logged.withColumnRenamed("action_order_count", "order_count")
    bought = line_measures(lines, keys, refunds=refunds).drop(
        "order_num", "payment_num", "refund_num"
    )
    return combine([logged.drop("action_order_count"), bought], keys)


def dws_sku_stats(
    lines: DataFrame, refunds: DataFrame, sku_dim: DataFrame | None = None
) -> DataFrame:
    """(sku, day): orders, payments and refunds, optionally named from the SKU
    dimension, which joins the aggregate and not the lines."""
    stats = line_measures(lines, ["sku_id", "date_id"], refunds=refunds)
    return stats if sku_dim is None else stats.join(sku_dim, "sku_id", "left")


def dws_user_stats(
    orders: DataFrame, lines: DataFrame, biz_date: str, actions: DataFrame | None = None
) -> DataFrame:
    """User as of biz_date: order history totals, goods bought, recency, and with actions
    given the part of the day the user orders in most.

    orders: dwd_order_info rows up to biz_date; lines: their order lines.
    """
    paid = F.col("is_paid") == 1
    day = F.col("date_id").cast("date")
    history = orders.groupBy("user_id", "user_level").agg(
        F.count("id").alias("order_count"),
        money_sum("total_amount").alias("order_amount"),
        count_if(paid).alias("paid_order_count"),
        sum_if(paid, F.col("total_amount")).alias("paid_amount"),
        F.min(day).alias("first_day"),
        F.max(day).alias("last_day"),
        F.min("create_time").alias("first_order_time"),
        F.max("create_time").alias("last_order_time"),
    )
    goods = lines.groupBy("user_id").agg(F.count(F.lit(1)).alias("goods_num"))
    stats = history.join(goods, "user_id", "left").select(
        *history.drop("first_day", "last_day").columns,
        F.coalesce("goods_num", F.lit(0)).alias("goods_num"),
        date_id("first_day").alias("first_order_date"),
        date_id("last_day").alias("last_order_date"),
        divide(F.col("order_amount"), F.col("order_count")).alias("avg_order_amount"),
        F.datediff(F.lit(biz_date).cast("date"), F.col("last_day"))
        .cast("bigint")
        .alias("days_since_last_order"),
    )
    if actions is None:
        return stats
    return stats.join(user_favorite_period(actions), "user_id", "left")


def day_period(hour: Column) -> Column:
    """Position 0-3 of the part of the day: to 6, to 12, to 18, later."""
    return F.when(hour <= 6, 0).when(hour <= 12, 1).when(hour <= 18, 2).otherwise(3)


PERIODS = ("dawn", "morning", "afternoon", "evening")


def user_favorite_period(actions: DataFrame) -> DataFrame:
    """The part of the day a user orders in most; ties go to the earlier one."""
    period = day_period(F.hour("action_time"))
    counted = (
        actions.where(F.col("action_code") == "order")
        .groupBy("user_id", period.alias("period"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    best = F.max(F.struct("n", (-F.col("period")).alias("early"))).alias("best")
    names = F.array(*[F.lit(p) for p in PERIODS])
    return counted.groupBy("user_id").agg(best).select(
        "user_id", F.get(names, -F.col("best.early")).alias("favorite_period")
    )


def dws_province_stats(orders: DataFrame) -> DataFrame:
    """(province, region, day): buyers, orders, money."""
    keys = ["province_id", "province_name", "region_id", "region_name", "date_id"]
    return order_measures(orders, [k for k in keys if k in orders.columns]).select(
        *[k for k in keys if k in orders.columns],
        "order_user_count",
        "order_count",
        "gmv",
        "avg_order_amount",
        "goods_amount",
        "feight_fee",
        "discount_amount",
    )


def _sales(lines: DataFrame, keys: list[str]) -> DataFrame:
    return line_measures(lines, [*keys, "date_id"]).select(
        *keys,
        "date_id",
        "order_count",
        F.col("order_num").alias("sale_num"),
        F.col("order_amount").alias("sale_amount"),
        divide(F.col("order_amount"), F.col("order_num")).alias("avg_price"),
    )


def dws_trademark_stats(lines: DataFrame) -> DataFrame:
    """(brand, day): orders, pieces, money, price per piece."""
    return _sales(lines, [c for c in ("tm_id", "tm_name") if c in lines.columns])


CATEGORY_KEYS = (
    "category1_id",
    "category1_name",
    "category2_id",
    "category2_name",
    "category3_id",
    "category3_name",
)


def dws_category_stats(lines: DataFrame) -> DataFrame:
    """(category levels 1-3, day): orders, pieces, money, price per piece."""
    return _sales(lines, [c for c in CATEGORY_KEYS if c in lines.columns])


def _per_order(rows: DataFrame, keys: list[str], amount: str, prefix: str) -> DataFrame:
    """Distinct orders and money of refunds, coupons or campaigns per `keys`."""
    orders = rows.groupBy(*keys, "order_id").agg(money_sum(amount).alias("amount"))
    return orders.groupBy(*keys).agg(
        F.count(F.lit(1)).alias(f"{prefix}_count"), money_sum("amount").alias(f"{prefix}_amount")
    )


def dws_order_day(
    orders: DataFrame,
    refunds: DataFrame | None = None,
    coupon_uses: DataFrame | None = None,
    participations: DataFrame | None = None,
) -> DataFrame:
    """Day: orders and payments, and as far as given the orders refunded, bought with
    a coupon (used_time set) and bought in a campaign."""
    keys = ["date_id"]
    parts = [
        order_measures(orders, keys).select(
            "date_id",
            "order_count",
            "order_user_count",
            F.col("gmv").alias("order_amount"),
            "payment_count",
            "payment_user_count",
            "payment_amount",
        )
    ]
    if refunds is not None:
        parts.append(_per_order(refunds, keys, "refund_amount", "refund"))
    if coupon_uses is not None:
        used = coupon_uses.where(F.col("used_time").isNotNull() & F.col("order_id").isNotNull())
        parts.append(_per_order(used, keys, "reduce_amount", "coupon"))
    if participations is not None:
        parts.append(_per_order(participations, keys, "reduce_amount", "activity"))
    return parts[0] if len(parts) == 1 else combine(parts, keys)


def _interest(actions: DataFrame, keys: list[str]) -> DataFrame:
    return action_counts(actions, keys).select(
        *keys,
        F.col("cart_add_count").alias("cart_count"),
        F.col("favor_add_count").alias("favor_count"),
    )


def dws_user_day(
    orders: DataFrame, actions: DataFrame | None = None, comments: DataFrame | None = None
) -> DataFrame:
    """(user, day): orders and payments, and as far as given cart adds, favourites
    and comments."""
    keys = ["user_id", "date_id"]
    parts = [
        orders.groupBy(*keys).agg(
            F.count("id").alias("order_count"),
            money_sum("total_amount").alias("order_amount"),
            count_if("is_paid = 1").alias("payment_count"),
            sum_if("is_paid = 1", "total_amount").alias("payment_amount"),
        )
    ]
    if actions is not None:
        parts.append(_interest(actions, keys))
    if comments is not None:
        parts.append(comments.groupBy(*keys).agg(F.count(F.lit(1)).alias("comment_count")))
    return parts[0] if len(parts) == 1 else combine(parts, keys)


def dws_sku_day(
    lines: DataFrame, refunds: DataFrame | None = None, actions: DataFrame | None = None
) -> DataFrame:
    """(sku, day): orders, pieces, money and payments, and as far as given refunds,
    cart adds and favourites."""
    keys = ["sku_id", "date_id"]
    sold = line_measures(lines, keys, refunds=refunds)
    return sold if actions is None else combine([sold, _interest(actions, keys)], keys)


def _period_rollup(
    orders: DataFrame, refunds: DataFrame | None, start: Column, end: Column, name: str
) -> DataFrame:
    iso = "yyyy-MM-dd"
    keys = [f"{name}_start_date", f"{name}_end_date"]

    def dated(df: DataFrame) -> DataFrame:
        return df.select(
            "*", F.date_format(start, iso).alias(keys[0]), F.date_format(end, iso).alias(keys[1])
        )

    rollup = order_measures(dated(orders), keys).select(
        *keys,
        "order_count",
        "order_user_count",
        F.col("gmv").alias("order_amount"),
        "payment_count",
        "payment_user_count",
        "payment_amount",
    )
    if refunds is None:
        return rollup
    return combine([rollup, _per_order(dated(refunds), keys, "refund_amount", "refund")], keys)


def dws_order_week(orders: DataFrame, refunds: DataFrame | None = None) -> DataFrame:
    """Monday-to-Sunday weeks, from the orders themselves so that buyers are distinct."""
    monday = F.date_trunc("week", F.col("date_id").cast("date")).cast("date")
    return _period_rollup(orders, refunds, monday, F.date_add(monday, 6), "week")


def dws_order_month(orders: DataFrame, refunds: DataFrame | None = None) -> DataFrame:
    """Calendar months, from the orders themselves so that buyers are distinct."""
    day = F.col("date_id").cast("date")
    return _period_rollup(orders, refunds, F.trunc(day, "MM"), F.last_day(day), "month")


def first_days(activity: DataFrame) -> DataFrame:
    """user_id, create_date: the first day each user appears."""
    first = activity.groupBy("user_id").agg(F.min(F.col("date_id").cast("date")).alias("first"))
    return first.select("user_id", date_id("first").alias("create_date"))


def dws_user_new_day(activity: DataFrame, users: DataFrame | None = None) -> DataFrame:
    """One row per new user on the day of first appearance, with user attributes."""
    new = first_days(activity).withColumnRenamed("create_date", "date_id")
    if users is None:
        return new
    return new.join(users.withColumnRenamed("id", "user_id"), "user_id", "left")


def update_first_days(previous: DataFrame | None, activity: DataFrame) -> DataFrame:
    """first_days carried on: yesterday's table and today's activity, so that the
    history is not read again every day."""
    today = first_days(activity)
    if previous is None:
        return today
    day = F.col("create_date").cast("date")
    both = previous.select("user_id", "create_date").unionByName(today)
    return both.groupBy("user_id").agg(F.min(day).alias("first")).select(
        "user_id", date_id("first").alias("create_date")
    )


def user_offsets(activity: DataFrame, firsts: DataFrame | None = None) -> DataFrame:
    """user_id, create_date, date_id, day_offset: a user's active days counted from
    the first one, which is taken from `firsts` if given and from the activity if not.
    Deduplicated to days before the window, which bounds its groups."""
    days = activity.select("user_id", "date_id").distinct()
    if firsts is None:
        first = F.min("date_id").over(Window.partitionBy("user_id"))
        days = days.withColumn("create_date", first)
    else:
        days = days.join(firsts.select("user_id", "create_date"), "user_id")
    offset = F.datediff(F.col("date_id").cast("date"), F.col("create_date").cast("date"))
    return days.withColumn("day_offset", offset)


def dws_user_retention_day(
    activity: DataFrame, offsets: tuple[int, ...] = (1, 3, 7), firsts: DataFrame | None = None
) -> DataFrame:
    """One row per user and retention day the user came back on. With `firsts` the activity
    need not reach back to every user's first day."""
    return user_offsets(activity, firsts).where(F.col("day_offset").isin(*offsets)).select(
        "user_id",
        F.col("create_date").alias("cohort_day"),
        F.col("day_offset").cast("bigint").alias("retention_day"),
        F.col("date_id").alias("retention_date"),
    )


def dws_trademark_day(lines: DataFrame) -> DataFrame:
    """(brand, day) with payments."""
    return line_measures(lines, [c for c in ("tm_id", "tm_name", "date_id") if c in lines.columns])


def dws_category3_day(lines: DataFrame) -> DataFrame:
    """(category, day) with payments."""
    return line_measures(lines, [*[c for c in CATEGORY_KEYS if c in lines.columns], "date_id"])


def dws_province_day(orders: DataFrame) -> DataFrame:
    """(province, day) with payments."""
    keys = ("province_id", "province_name", "region_id", "region_name", "date_id")
    keys = [k for k in keys if k in orders.columns]
    return order_measures(orders, keys).select(
        *keys,
        "order_count",
        "order_user_count",
        F.col("gmv").alias("order_amount"),
        "payment_count",
        "payment_user_count",
        "payment_amount",
    )


def dws_coupon_day(uses: DataFrame, coupons: DataFrame) -> DataFrame:
    """(coupon, day): coupons taken and used, and the reduction they gave.

    uses: coupon_id, user_id, order_id, used_time (NULL until used), reduce_amount,
    date_id.
    """
    used = F.col("used_time").isNotNull()
    per_user = uses.groupBy("coupon_id", "date_id", "user_id").agg(
        F.count(F.lit(1)).alias("got"),
        count_if(used).alias("used"),
        sum_if(used, F.col("reduce_amount")).alias("reduced"),
    )
    per_order = (
        uses.where(used & F.col("order_id").isNotNull())
        .select("coupon_id", "date_id", "order_id")
        .distinct()
        .groupBy("coupon_id", "date_id")
        .agg(F.count(F.lit(1)).alias("order_count"))
    )
    counted = per_user.groupBy("coupon_id", "date_id").agg(
        F.sum("got").alias("get_count"),
        F.count("user_id").alias("get_user_count"),
        F.sum("used").alias("used_count"),
        count_if(F.col("used") > 0).alias("used_user_count"),
        money_sum("reduced").alias("coupon_amount"),
    )
    names = coupons.select("coupon_id", "coupon_name", "coupon_type")
    return combine([counted, per_order], ["coupon_id", "date_id"]).join(names, "coupon_id", "left")


def dws_activity_day(participations: DataFrame, activities: DataFrame) -> DataFrame:
    """(campaign, day): orders, participants, reduction."""
    keys = ["activity_id", "date_id"]
    per_order = participations.groupBy(*keys, "user_id", "order_id").agg(
        money_sum("reduce_amount").alias("reduced")
    )
    per_user = per_order.groupBy(*keys, "user_id").agg(
        F.count(F.lit(1)).alias("orders"), money_sum("reduced").alias("reduced")
    )
    counted = per_user.groupBy(*keys).agg(
        F.sum("orders").alias("order_count"),
        F.count("user_id").alias("order_user_count"),
        money_sum("reduced").alias("reduce_amount"),
    )
    names = activities.select("activity_id", "activity_name", "activity_type")
    return counted.join(names, "activity_id", "left")


# Handling states of a service ticket.
PENDING, PROCESSING, RESOLVED, UNSOLVED = "pending", "processing", "resolved", "unsolved"


def dws_customer_service_day(tickets: DataFrame) -> DataFrame:
    """(service type, day): tickets, open and resolved, resolution rate."""
    state = F.col("handle_result")
    counted = tickets.groupBy("date_id", "service_type").agg(
        F.count(F.lit(1)).alias("total_count"),
        count_if(state == PENDING).alias("pending_count"),
        count_if(state == RESOLVED).alias("resolved_count"),
    )
    return counted.withColumn(
        "resolved_rate", pct(F.col("resolved_count"), F.col("total_count"))
    )


def session_minutes(views: DataFrame, time: str, gap_seconds: int = 1800) -> DataFrame:
    """(user, minute): events, and the first and last of them in microseconds. Events of one user in
    one minute share a session, as gap_seconds must be at least 60; a window over a user
    then sees at most one row per minute of the log, however many events a user has."""
    if gap_seconds < 60:
        raise ValueError("gap_seconds must be at least 60")
    micros = F.unix_micros(F.col(time).cast("timestamp"))
    return views.groupBy("user_id", F.floor(micros / F.lit(60_000_000)).alias("minute")).agg(
        F.count(F.lit(1)).alias("events"), F.min(micros).alias("first"), F.max(micros).alias("last")
    )


def in_sessions(minutes: DataFrame, gap_seconds: int = 1800) -> DataFrame:
    """The minutes with session_start, the first event of the session they lie in."""
    ordered = Window.partitionBy("user_id").orderBy("minute")
    running = ordered.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    gap = F.col("first") - F.lag("last").over(ordered)
    starts = F.when(F.coalesce(gap > gap_seconds * 1_000_000, F.lit(True)), F.col("first"))
    return minutes.withColumn("starts", starts).withColumn(
        "session_start", F.last("starts", ignorenulls=True).over(running)
    )


def user_sessions(views: DataFrame, time: str, gap_seconds: int = 1800) -> DataFrame:
    """One row per session: a user's events no more than gap_seconds apart, which must be
    at least 60."""
    return (
        in_sessions(session_minutes(views, time, gap_seconds), gap_seconds)
        .groupBy("user_id", "session_start")
        .agg(F.sum("events").alias("views"), F.max("last").alias("session_end"))
        .withColumn(
            "duration_sec", (F.col("session_end") - F.col("session_start")) / F.lit(1_000_000)
        )
    )


def dws_page_view_day(views: DataFrame, time: str, gap_seconds: int = 1800) -> DataFrame:
    """(day, hour of the session start): views, visitors, sessions, average duration
    and bounce rate."""
    return page_view_hours(user_sessions(views, time, gap_seconds))


def page_view_hours(sessions: DataFrame) -> DataFrame:
    """dws_page_view_day of sessions (user_id, session_start, session_end, views)."""
    start = F.timestamp_micros("session_start")
    sessions = sessions.select(
        "user_id",
        "session_start",
        "session_end",
        "views",
        F.date_format(start, "yyyy-MM-dd").alias("date_id"),
        F.hour(start).cast("bigint").alias("hour_id"),
    )
    per_user = sessions.groupBy("date_id", "hour_id", "user_id").agg(
        F.sum("views").alias("views"),
        F.count(F.lit(1)).alias("sessions"),
        count_if(F.col("views") == 1).alias("bounces"),
        F.sum(F.col("session_end") - F.col("session_start")).alias("micros"),
    )
    return per_user.groupBy("date_id", "hour_id").agg(
        F.sum("views").alias("view_count"),
        F.count("user_id").alias("visitor_count"),
        F.sum("sessions").alias("session_count"),
        F.floor(F.sum("micros") / (F.sum("sessions") * 1_000_000))
        .cast("bigint")
        .alias("avg_duration_sec"),
        pct(F.sum("bounces"), F.sum("sessions")).alias("bounce_rate"),
    )
