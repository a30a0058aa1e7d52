"""Reports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bazaarlake.functions.common import (
    RECENT_DAYS,
    count_if,
    divide,
    expand_recent_days,
    growth,
    last_year,
    money_sum,
    pct,
    shift,
    sum_if,
)
from bazaarlake.functions.ranking import distributed_row_number
from bazaarlake.operators.dws import (
    CATEGORY_KEYS,
    PENDING,
    PROCESSING,
    RESOLVED,
    UNSOLVED,
    user_offsets,
)
from bazaarlake.operators.measures import (
    combine,
    line_measures,
    one_row,
    order_measures,
    recent_sums,
    with_share,
)

def _recent(df: DataFrame, biz_date: str, days: int) -> DataFrame:
    return df.where(F.col("date_id").between(shift(biz_date, 1 - days), biz_date))


def ads_gmv_day(
    orders: DataFrame, biz_date: str, refunds: DataFrame | None = None
) -> DataFrame:
    """recent_days: money, orders and buyers. order_user_count is the true distinct
    count over the window, order_user_days the sum of the daily ones."""
    totals = order_measures(orders, [], biz_date).select(
        "recent_days",
        "gmv",
        "order_count",
        "order_user_count",
        "order_user_days",
        "goods_amount",
        "feight_fee",
        "discount_amount",
        "payment_amount",
        "payment_count",
        "payment_user_count",
        F.col("completed_gmv").alias("completed_amount"),
        F.col("completed_order_count").alias("completed_count"),
        "avg_order_amount",
        "avg_pay_amount",
    )
    if refunds is None:
        return totals
    per_order = refunds.groupBy("order_id", "date_id").agg(
        money_sum("refund_amount").alias("amount")
    )
    refunded = (
        expand_recent_days(per_order, "date_id", biz_date)
        .groupBy("recent_days")
        .agg(
            money_sum("amount").alias("refund_amount"),
            F.count_distinct("order_id").alias("refund_count"),
        )
    )
    none = F.lit(0)
    return totals.join(refunded, "recent_days", "left").select(
        *totals.columns,
        F.coalesce("refund_amount", none).alias("refund_amount"),
        F.coalesce("refund_count", none).alias("refund_count"),
        (F.col("payment_amount") - F.coalesce("refund_amount", none)).alias("net_sales_amount"),
    )


def _cohorts(
    came_back: DataFrame, biz_date: str, cohort_days: int | None, offsets: Sequence[int]
) -> DataFrame:
    """One row per first-seen day: cohort size and users back on each offset, NULL
    where that day is not over yet."""
    in_scope = F.col("create_date") <= biz_date
    if cohort_days is not None:
        in_scope = in_scope & (F.col("create_date") >= shift(biz_date, -cohort_days))
    age = F.datediff(F.lit(biz_date).cast("date"), F.col("create_date").cast("date"))
    return (
        came_back.where(in_scope)
        .groupBy("create_date")
        .agg(
            count_if("day_offset = 0").alias("new_user_count"),
            *[count_if(f"day_offset = {k}").alias(f"__{k}") for k in offsets],
        )
        .select(
            "create_date",
            "new_user_count",
            *[F.when(age >= k, F.col(f"__{k}")).alias(f"back_{k}") for k in offsets],
        )
    )


def ads_user_retention(
    activity: DataFrame,
    biz_date: str,
    offsets: Sequence[int] = (1, 7, 14, 30),
    cohort_days: int | None = 30,
    firsts: DataFrame | None = None,
) -> DataFrame:
    """(cohort day, retention day): cohort size, users active that many days later,
    rate, and all users active that day. Days not over yet have no row.
    Cohorts of the last cohort_days days, or of the whole history with None.

    Without `firsts` (user_id, create_date) the activity has to reach back to every
    user's first day; with it, to the first cohort's day.
    """
    came_back = user_offsets(activity.where(F.col("date_id") <= biz_date), firsts)
    # One row per day of the log.
    active = came_back.groupBy("date_id").agg(F.count("user_id").alias("active"))
    return retention_rows(_cohorts(came_back, biz_date, cohort_days, offsets), active, offsets)


def retention_rows(cohorts: DataFrame, active: DataFrame, offsets: Sequence[int]) -> DataFrame:
    """Cohorts (create_date, new_user_count, back_<k>) as rows of (cohort day, retention day), with all
    users active (date_id, active) that day."""
    cells = F.array(
        *[
            F.struct(F.lit(k).alias("retention_day"), F.col(f"back_{k}").alias("retention_count"))
            for k in offsets
        ]
    )
    table = (
        cohorts.select("create_date", "new_user_count", F.explode(cells).alias("c"))
        .where(F.col("c.retention_count").isNotNull())
        .select(
            F.col("create_date").alias("cohort_day"),
            F.col("c.retention_day").cast("bigint").alias("retention_day"),
            "new_user_count",
            F.col("c.retention_count").alias("retention_count"),
            pct(F.col("c.retention_count"), F.col("new_user_count")).alias("retention_rate"),
            F.date_format(
                F.date_add(F.col("create_date").cast("date"), F.col("c.retention_day")), "yyyy-MM-dd"
            ).alias("date_id"),
        )
    )
    return table.join(active, "date_id", "left").select(
        *[c for c in table.columns if c != "date_id"],
        F.coalesce("active", F.lit(0)).alias("active_user_count"),
    )


def ads_user_retention_detail(
    activity: DataFrame,
    biz_date: str,
    offsets: Sequence[int] = (1, 3, 7, 14, 30),
    cohort_days: int = 90,
    firsts: DataFrame | None = None,
) -> DataFrame:
    """Cohort day with one count and one rate column per retention day. With `firsts`
    (user_id, create_date) the activity need not reach back beyond the first cohort's day."""
    came_back = user_offsets(activity.where(F.col("date_id") <= biz_date), firsts)
    return retention_columns(_cohorts(came_back, biz_date, cohort_days, offsets), offsets)


def retention_columns(cohorts: DataFrame, offsets: Sequence[int]) -> DataFrame:
    """Cohorts (create_date, new_user_count, back_<k>) with a count and a rate column per offset."""
    return cohorts.select(
        F.col("create_date").alias("cohort_day"),
        F.col("new_user_count").alias("total_new_users"),
        *[F.col(f"back_{k}").alias(f"day_{k}_retention") for k in offsets],
        *[pct(F.col(f"back_{k}"), F.col("new_user_count")).alias(f"day_{k}_rate") for k in offsets],
    )


def ads_sku_sales_rank(
    lines: DataFrame | None,
    biz_date: str,
    refunds: DataFrame | None = None,
    sku_dim: DataFrame | None = None,
    daily: DataFrame | None = None,
) -> DataFrame:
    """(recent_days, sku) with its place by money (`rank`) and by pieces
    (`sales_rank`); equal values are ordered by sku_id. SKUs not sold in a window have no place.

    From order lines and refunds, or from the days of dws_sku_stats given as `daily`.
    """
    if daily is not None:
        sold = recent_sums(daily, ["sku_id"], biz_date)
    else:
        sold = line_measures(lines, ["sku_id"], biz_date, refunds=refunds)
    if refunds is not None or daily is not None:
        sold = sold.where(F.col("order_count") > 0)
    ranked = distributed_row_number(
        sold, ["recent_days"], [F.col("order_amount").desc(), F.col("sku_id").asc()], "rank"
    )
    ranked = distributed_row_number(
        ranked, ["recent_days"], [F.col("order_num").desc(), F.col("sku_id").asc()], "sales_rank"
    )
    return ranked if sku_dim is None else ranked.join(sku_dim, "sku_id", "left")


def _top_skus(lines: DataFrame, order: list[Column], n: int) -> DataFrame:
    best = line_measures(lines, ["sku_id"]).orderBy(*order).limit(n)
    # At most n rows are left, so one window over all of them is bounded.
    return best.withColumn("rank", F.row_number().over(Window.orderBy(*order)).cast("bigint"))


def ads_sku_sales_rank_top100(
    lines: DataFrame, biz_date: str, sku_dim: DataFrame | None = None, days: int = 7, n: int = 100
) -> DataFrame:
    """The n best SKUs by money over the last days."""
    order = [F.col("order_amount").desc(), F.col("sku_id").asc()]
    top = _top_skus(_recent(lines, biz_date, days), order, n).select(
        "sku_id", "order_count", "order_amount", "rank"
    )
    return top if sku_dim is None else top.join(sku_dim.select("sku_id", "sku_name"), "sku_id", "left")


def ads_hot_sku(lines: DataFrame, n: int = 10) -> DataFrame:
    """The n best SKUs by money."""
    order = [F.col("order_amount").desc(), F.col("sku_id").asc()]
    return _top_skus(lines, order, n).select(
        "sku_id", "order_count", F.col("order_amount").alias("total_gmv"), "rank"
    )


def ads_conversion_rate(actions: DataFrame, biz_date: str) -> DataFrame:
    """recent_days: visits, cart adds, orders, payments and the step rates.

    actions: action_code, date_id, is_paid (0/1 on order actions).
    """
    code = F.col("action_code")
    daily = actions.groupBy("date_id").agg(
        count_if(code == "page_view").alias("visits"),
        count_if(code == "cart_add").alias("carts"),
        count_if(code == "order").alias("orders"),
        count_if((code == "order") & (F.col("is_paid") == 1)).alias("payments"),
    )
    steps = (
        expand_recent_days(daily, "date_id", biz_date)
        .groupBy("recent_days")
        .agg(
            F.sum("visits").alias("visit_count"),
            F.sum("carts").alias("cart_count"),
            F.sum("orders").alias("order_count"),
            F.sum("payments").alias("payment_count"),
        )
    )
    return steps.select(
        "*",
        pct(F.col("cart_count"), F.col("visit_count")).alias("visit_to_cart_rate"),
        pct(F.col("order_count"), F.col("cart_count")).alias("cart_to_order_rate"),
        pct(F.col("payment_count"), F.col("order_count")).alias("order_to_payment_rate"),
        pct(F.col("payment_count"), F.col("visit_count")).alias("total_conversion_rate"),
    )


FUNNEL = ("page_view", "favor_add", "cart_add", "order", "payment")


def ads_conversion_funnel(
    actions: DataFrame, biz_date: str, steps: Sequence[str] = FUNNEL
) -> DataFrame:
    """recent_days: users per named step and the rate from each step to the next."""
    order_paid = (F.col("action_code") == "order") & (F.col("is_paid") == 1)

    def reached(step: str) -> Column:
        return order_paid if step == "payment" else F.col("action_code") == step

    per_day = actions.groupBy("user_id", "date_id").agg(
        *[F.max(reached(s).cast("int")).alias(f"s{i}") for i, s in enumerate(steps, 1)]
    )
    per_user = (
        expand_recent_days(per_day, "date_id", biz_date)
        .groupBy("recent_days", "user_id")
        .agg(*[F.max(f"s{i}").alias(f"s{i}") for i in range(1, len(steps) + 1)])
    )
    counted = per_user.groupBy("recent_days").agg(
        *[F.sum(f"s{i}").alias(f"step{i}_count") for i in range(1, len(steps) + 1)]
    )
    return counted.select(
        "*",
        *[F.lit(s).alias(f"step{i}_name") for i, s in enumerate(steps, 1)],
        *[
            pct(F.col(f"step{i + 1}_count"), F.col(f"step{i}_count")).alias(
                f"step{i}_to_step{i + 1}_rate"
            )
            for i in range(1, len(steps))
        ],
        pct(F.col(f"step{len(steps)}_count"), F.col("step1_count")).alias("total_conversion_rate"),
    )


def ads_user_repurchase_rate(
    orders: DataFrame | None,
    biz_date: str,
    days: Sequence[int] = (7, 30),
    daily: DataFrame | None = None,
) -> DataFrame:
    """recent_days: buyers, buyers with at least two orders, orders per buyer. Given the
    daily table of users, orders are not read."""
    if daily is None:
        per_day = orders.groupBy("user_id", "date_id").agg(F.count("id").alias("orders"))
    else:
        per_day = daily.select("user_id", "date_id", F.col("order_count").alias("orders"))
    per_user = (
        expand_recent_days(per_day, "date_id", biz_date, days)
        .groupBy("recent_days", "user_id")
        .agg(F.sum("orders").alias("orders"))
    )
    repeat = F.col("orders") >= 2
    counted = per_user.groupBy("recent_days").agg(
        F.count("user_id").alias("total_user_count"),
        count_if(repeat).alias("repeat_user_count"),
        F.sum("orders").alias("__orders"),
        F.max("orders").alias("max_order_per_user"),
    )
    return counted.select(
        "recent_days",
        "total_user_count",
        "repeat_user_count",
        pct(F.col("repeat_user_count"), F.col("total_user_count")).alias("repurchase_rate"),
        divide(F.col("__orders"), F.col("total_user_count")).alias("avg_order_per_user"),
        "max_order_per_user",
    )


def ads_user_activity(activity: DataFrame, biz_date: str) -> DataFrame:
    """Daily, weekly and monthly active users and their ratios, one row.

    A user counts in a window if the last active day falls in it, so one aggregate
    per user serves all three.
    """
    day = F.col("date_id").cast("date")
    last = _recent(activity, biz_date, 30).groupBy("user_id").agg(F.max(day).alias("last"))
    counted = last.agg(
        count_if(F.col("last") >= F.lit(biz_date).cast("date")).alias("dau"),
        count_if(F.col("last") >= F.lit(shift(biz_date, -6)).cast("date")).alias("wau"),
        F.count("user_id").alias("mau"),
    )
    return counted.select(
        "*",
        pct(F.col("dau"), F.col("mau")).alias("dau_to_mau_rate"),
        pct(F.col("wau"), F.col("mau")).alias("wau_to_mau_rate"),
    )


def ads_user_active_day(activity: DataFrame, biz_date: str) -> DataFrame:
    """The three active-user counts repeated per recent_days."""
    days = F.explode(F.array(*[F.lit(k) for k in RECENT_DAYS])).alias("recent_days")
    return ads_user_activity(activity, biz_date).select(days, "dau", "wau", "mau")


def ads_category_sale_analysis(lines: DataFrame, refunds: DataFrame, biz_date: str) -> DataFrame:
    """(category 1-2, recent_days): sales, payments, refunds and their rates."""
    levels = [
        c
        for c in ("category1_id", "category1_name", "category2_id", "category2_name")
        if c in lines.columns
    ]
    stats = line_measures(lines, levels, biz_date, refunds=refunds)
    return stats.select(
        "recent_days",
        *levels,
        "order_count",
        F.col("order_num").alias("sale_num"),
        F.col("order_amount").alias("sale_amount"),
        divide(F.col("order_amount"), F.col("order_num")).alias("avg_price"),
        "payment_count",
        "payment_amount",
        "refund_count",
        "refund_amount",
        pct(F.col("payment_amount"), F.col("order_amount")).alias("payment_rate"),
        pct(F.col("refund_amount"), F.col("payment_amount")).alias("refund_rate"),
    )


PROVINCE_KEYS = ("province_id", "province_name", "region_id", "region_name")


def ads_province_sale(orders: DataFrame, biz_date: str) -> DataFrame:
    """(recent_days, province): orders, buyers, money and the place by money.

    The ranked rows are provinces, a fixed administrative list.
    """
    levels = [c for c in PROVINCE_KEYS if c in orders.columns]
    stats = order_measures(orders, levels, biz_date)
    place = Window.partitionBy("recent_days").orderBy(F.col("gmv").desc(), F.col("province_id"))
    return stats.select(
        "recent_days",
        *levels,
        "order_count",
        "order_user_count",
        "gmv",
        "avg_order_amount",
        "discount_amount",
        F.row_number().over(place).cast("bigint").alias("rank"),
    )


def ads_gmv_trend(orders: DataFrame, biz_date: str) -> DataFrame:
    """biz_date against the day before and the same day a year ago, in percent;
    NULL growth when there is nothing to compare with. One scan of the three days."""
    compared = {"": biz_date, "_dod": shift(biz_date, -1), "_yoy": last_year(biz_date)}
    days = order_measures(
        orders.where(F.col("date_id").isin(*compared.values())), ["date_id"]
    )
    row = days.agg(
        *[
            F.max(F.when(F.col("date_id") == day, F.col(c))).alias(f"{c}{tag}")
            for tag, day in compared.items()
            for c in ("gmv", "order_count", "order_user_count", "avg_order_amount")
        ]
    )
    return row.select(
        F.lit(biz_date).alias("date_id"),
        "gmv",
        "order_count",
        "order_user_count",
        "avg_order_amount",
        *[
            growth(F.col(c), F.col(f"{c}{tag}")).alias(f"{c}{tag}_rate")
            for c in ("gmv", "order_count")
            for tag in ("_dod", "_yoy")
        ],
    )


def ads_gmv_trend_series(orders: DataFrame) -> DataFrame:
    """Every day with the money of the calendar day before; a missing day is NULL."""
    days = order_measures(orders, ["date_id"]).select("date_id", "gmv")
    next_day = F.date_format(F.date_add(F.col("date_id").cast("date"), 1), "yyyy-MM-dd")
    before = days.select(next_day.alias("date_id"), F.col("gmv").alias("prev_gmv"))
    return days.join(before, "date_id", "left").select(
        "*", growth(F.col("gmv"), F.col("prev_gmv")).alias("gmv_dod_rate")
    )


def ads_sku_repurchase_analysis(
    lines: DataFrame,
    biz_date: str | None = None,
    days: int = 31,
    sku_dim: DataFrame | None = None,
) -> DataFrame:
    """SKU: orders, users, and what users bought after their first order of it, optionally
    with its name and categories.

    Lines of one order are merged first, so buying twice in one order is no repeat.
    The first order is found by an aggregate, not a ranked window.
    """
    if biz_date is not None:
        lines = _recent(lines, biz_date, days)
    per_order = lines.groupBy("sku_id", "user_id", "order_id").agg(
        F.min(F.col("date_id").cast("date")).alias("day"),
        money_sum("order_amount").alias("amount"),
    )
    per_user = per_order.groupBy("sku_id", "user_id").agg(
        F.count(F.lit(1)).alias("orders"),
        money_sum("amount").alias("amount"),
        F.min(F.struct("day", "order_id", "amount")).alias("first"),
    )
    repeat = F.col("orders") >= 2
    stats = per_user.groupBy("sku_id").agg(
        F.sum("orders").alias("total_order_count"),
        F.sum(F.col("orders") - 1).alias("repurchase_order_count"),
        count_if(repeat).alias("repurchase_user_count"),
        F.count("user_id").alias("total_user_count"),
        money_sum(F.col("amount") - F.col("first.amount")).alias("repurchase_amount"),
    )
    rated = stats.select(
        "*",
        pct(F.col("repurchase_user_count"), F.col("total_user_count")).alias("repurchase_rate"),
        divide(F.col("total_order_count"), F.col("total_user_count")).alias("avg_repurchase_times"),
    )
    if sku_dim is None:
        return rated
    names = [c for c in ("sku_name", "category1_name", "category2_name", "category3_name") if c in sku_dim.columns]
    return rated.join(sku_dim.select("sku_id", *names), "sku_id", "left")


def ads_refund_analysis(
    refunds: DataFrame, orders: DataFrame, biz_date: str | None = None
) -> DataFrame:
    """Refunds against all orders, the most refunded category and the reasons as JSON;
    with biz_date the refunds and orders of that day (date_id of both).

    refunds: order_id, user_id, refund_amount, refund_time, create_time,
    category_name, refund_reason_type. Ties for the category go to the first name.
    """
    if biz_date is not None:
        refunds = refunds.where(F.col("date_id") == biz_date)
        orders = orders.where(F.col("date_id") == biz_date)
    ids = refunds.agg(
        F.count_distinct("order_id").alias("refund_count"),
        F.count_distinct("user_id").alias("refund_user_count"),
    )
    # Each refund counts once for its category and once for its reason, so one scan
    # gives both lists; they are as long as the category and reason code tables.
    category, reason = (
        F.struct(F.lit(tag).alias("tag"), F.col(c).cast("string").alias("name"))
        for tag, c in (("category", "category_name"), ("reason", "refund_reason_type"))
    )
    named = refunds.select(
        "refund_amount",
        F.datediff(F.col("refund_time"), F.col("create_time")).alias("days"),
        F.explode(F.array(category, reason)).alias("k"),
    )
    counted = named.groupBy("k.tag", "k.name").agg(
        F.expr("count(1) AS n"),
        money_sum("refund_amount").alias("amount"),
        F.expr("sum(days) AS days"),
        F.expr("count(days) AS timed"),
    )
    listed = F.expr(
        "sort_array(collect_list(CASE WHEN tag = 'reason' AND name IS NOT NULL THEN struct(name, n) END))"
    )
    refunded = counted.agg(
        sum_if("tag = 'category'", "amount").alias("refund_amount"),
        F.expr("sum(CASE WHEN tag = 'category' THEN days END) AS days"),
        F.expr("sum(CASE WHEN tag = 'category' THEN timed END) AS timed"),
        # most refunds first, then the first name
        F.expr(
            "min(CASE WHEN tag = 'category' AND name IS NOT NULL THEN struct(-n AS n, name) END).name "
            "AS top_refund_category"
        ),
        F.to_json(F.map_from_entries(listed)).alias("refund_reason_distribution"),
    ).select(
        "refund_amount",
        divide(F.col("days"), F.col("timed")).alias("avg_refund_days"),
        "top_refund_category",
        "refund_reason_distribution",
    )
    total = orders.agg(
        F.count("id").alias("order_count"), money_sum("total_amount").alias("order_amount")
    )
    return one_row(ids, refunded, total).select(
        "*", pct(F.col("refund_count"), F.col("order_count")).alias("refund_rate")
    )


# Fixed value: the daily GMV target of the dashboard.
GMV_TARGET = 10_000_000


def ads_dashboard(
    actions: DataFrame,
    biz_date: str,
    hour: int,
    amount: str,
    category: str,
    gmv_target: float = GMV_TARGET,
) -> DataFrame:
    """One row: the given hour and the day so far. Peak hour, hot SKU and hot
    category are the ones with most orders; ties go to the earliest or smallest.

    actions: user_id, sku_id, action_code, action_time, date_id, `amount`, `category`.
    """
    today = actions.where(
        (F.col("date_id") == biz_date) & (F.hour("action_time") <= hour)
    ).withColumn("hour", F.hour("action_time"))
    now = F.col("hour") == hour
    is_order = F.col("action_code") == "order"
    is_view = F.col("action_code") == "page_view"
    per_user = today.groupBy("user_id").agg(
        count_if(is_order).alias("orders"),
        count_if(is_order & now).alias("orders_now"),
        count_if(is_view).alias("views"),
        count_if(is_view & now).alias("views_now"),
        sum_if(is_order, F.col(amount)).alias("gmv"),
        sum_if(is_order & now, F.col(amount)).alias("gmv_now"),
    )
    totals = per_user.agg(
        money_sum("gmv_now").alias("current_gmv"),
        money_sum("gmv").alias("today_gmv"),
        F.sum("orders_now").alias("current_order_count"),
        F.sum("orders").alias("today_order_count"),
        count_if(F.col("orders_now") > 0).alias("current_user_count"),
        count_if(F.col("orders") > 0).alias("today_user_count"),
        pct(F.sum("orders_now"), F.sum("views_now")).alias("current_conversion_rate"),
        pct(F.sum("orders"), F.sum("views")).alias("today_conversion_rate"),
    )
    # Each order counts once for its hour, its SKU and its category.
    keys = ("hour", "sku_id", category)
    marks = F.array(
        *[
            F.struct(F.lit(i).alias("tag"), *[(F.col(c) if c == key else F.lit(None)).alias(c) for c in keys])
            for i, key in enumerate(keys)
        ]
    )
    counted = (
        today.where(is_order)
        .select(F.explode(marks).alias("k"))
        .groupBy("k.tag", *[f"k.{c}" for c in keys])
        .agg(F.expr("count(1) AS n"))
    )
    # most orders first, then the smallest key
    most = counted.agg(
        *[
            F.expr(f"min(CASE WHEN tag = {i} AND `{c}` IS NOT NULL THEN struct(-n AS n, `{c}` AS v) END).v AS {name}")
            for i, (c, name) in enumerate(
                zip(keys, ("peak_hour", "hot_sku", "hot_category"), strict=True)
            )
        ]
    )
    merged = one_row(totals, most)
    return merged.select(
        F.lit(biz_date).alias("date_id"),
        F.lit(hour).cast("bigint").alias("hour"),
        *[c for c in merged.columns if c != "peak_hour"],
        F.col("peak_hour").cast("bigint").alias("peak_hour"),
        F.lit(float(gmv_target)).alias("gmv_target"),
        pct(F.col("today_gmv"), F.lit(float(gmv_target))).alias("gmv_progress"),
    )


def ads_gmv_province(orders: DataFrame, biz_date: str) -> DataFrame:
    """(recent_days, province): money and its share of the window's total."""
    levels = [c for c in PROVINCE_KEYS if c in orders.columns]
    stats = with_share(order_measures(orders, levels, biz_date), "gmv", "gmv_share")
    return stats.select(
        "recent_days",
        *levels,
        "gmv",
        "gmv_share",
        "order_count",
        "order_user_count",
        "payment_amount",
    )


def _gmv_by(lines: DataFrame, levels: list[str], biz_date: str) -> DataFrame:
    stats = line_measures(lines, levels, biz_date).withColumnRenamed("order_amount", "gmv")
    return with_share(stats, "gmv", "gmv_share").select(
        "recent_days", *levels, "gmv", "gmv_share", "order_count", "order_num", "payment_amount"
    )


def ads_gmv_trademark(lines: DataFrame, biz_date: str) -> DataFrame:
    """(recent_days, brand): money and its share."""
    return _gmv_by(lines, [c for c in ("tm_id", "tm_name") if c in lines.columns], biz_date)


def ads_gmv_category(lines: DataFrame, biz_date: str) -> DataFrame:
    """(recent_days, category): money and its share."""
    return _gmv_by(lines, [c for c in CATEGORY_KEYS if c in lines.columns], biz_date)


def ads_trademark_stats(lines: DataFrame, refunds: DataFrame, biz_date: str) -> DataFrame:
    """(recent_days, brand): sales, payments, refunds, share and place by money."""
    levels = [c for c in ("tm_id", "tm_name") if c in lines.columns]
    stats = line_measures(lines, levels, biz_date, refunds=refunds)
    return distributed_row_number(
        with_share(stats, "order_amount", "gmv_share"),
        ["recent_days"],
        [F.col("order_amount").desc(), F.col("tm_id").asc()],
        "amount_rank",
    )


def ads_province_stats(orders: DataFrame, refunds: DataFrame, biz_date: str) -> DataFrame:
    """(recent_days, province): orders, payments and refunds.

    refunds carry the province columns of their order.
    """
    levels = [c for c in PROVINCE_KEYS if c in orders.columns]
    keys = ["recent_days", *levels]
    sold = order_measures(orders, levels, biz_date).select(
        *keys,
        "order_count",
        "order_user_count",
        F.col("gmv").alias("order_amount"),
        "payment_count",
        "payment_amount",
    )
    per_order = refunds.groupBy(*levels, "order_id", "date_id").agg(
        money_sum("refund_amount").alias("amount")
    )
    refunded = (
        expand_recent_days(per_order, "date_id", biz_date)
        .groupBy(*keys)
        .agg(
            F.count_distinct("order_id").alias("refund_count"),
            money_sum("amount").alias("refund_amount"),
        )
    )
    return combine([sold, refunded], keys)


def ads_user_new_day(new_users: DataFrame, levels: Sequence[str]) -> DataFrame:
    """Day: new users in all, by gender where known, and per level."""
    genders = []
    if "gender" in new_users.columns:
        genders = [
            count_if(F.col("gender") == "M").alias("new_male_count"),
            count_if(F.col("gender") == "F").alias("new_female_count"),
        ]
    return new_users.groupBy("date_id").agg(
        F.count("user_id").alias("new_user_count"),
        *genders,
        *[
            count_if(F.col("user_level") == level).alias(f"new_user_level{i}_count")
            for i, level in enumerate(levels, 1)
        ],
    )


def ads_sku_exposure_click(
    actions: DataFrame, exposure: str = "page_view", click: str = "click", cart: str = "cart_add"
) -> DataFrame:
    """SKU: exposures, clicks, cart adds and their rates."""
    code = F.col("action_code")
    return (
        actions.groupBy("sku_id")
        .agg(
            count_if(code == exposure).alias("exposure_count"),
            count_if(code == click).alias("click_count"),
            count_if(code == cart).alias("cart_count"),
        )
        .select(
            "*",
            pct(F.col("click_count"), F.col("exposure_count")).alias("click_rate"),
            pct(F.col("cart_count"), F.col("click_count")).alias("cart_rate"),
        )
    )


def ads_order_stats(orders: DataFrame, time: str, amount: str) -> DataFrame:
    """Hour of the day: orders and money."""
    return orders.groupBy(F.hour(time).cast("bigint").alias("hour_slot")).agg(
        F.count(F.lit(1)).alias("order_count"), money_sum(amount).alias("gmv")
    )


def ads_dau_by_device(device_stats: DataFrame) -> DataFrame:
    """Device type: active, new and returning users, average time and views.

    device_stats: user_id, device_type, is_new, is_return, duration_minutes,
    page_view_count.
    """
    per_user = device_stats.groupBy("device_type", "user_id").agg(
        F.max("is_new").alias("is_new"),
        F.max("is_return").alias("is_return"),
        F.count(F.lit(1)).alias("rows"),
        F.sum("duration_minutes").alias("duration"),
        F.sum("page_view_count").alias("views"),
    )
    return per_user.groupBy("device_type").agg(
        F.count("user_id").alias("dau_count"),
        count_if(F.col("is_new") == 1).alias("new_user_count"),
        count_if(F.col("is_return") == 1).alias("return_user_count"),
        divide(F.sum("duration"), F.sum("rows")).alias("avg_duration"),
        divide(F.sum("views"), F.sum("rows")).alias("avg_page_view"),
    )


def ads_campaign_effect(campaign_stats: DataFrame) -> DataFrame:
    """(campaign, channel): reach, orders and return on cost, 0 without cost."""
    keys = ["campaign_id", "campaign_name", "start_date", "end_date", "channel"]
    sums = campaign_stats.groupBy(*keys).agg(
        F.sum("exposure_count").cast("bigint").alias("exposure_count"),
        F.sum("click_count").cast("bigint").alias("click_count"),
        F.sum("order_count").cast("bigint").alias("order_count"),
        money_sum("order_amount").alias("order_amount"),
        money_sum("cost").alias("cost"),
    )
    return sums.select(
        "*",
        pct(F.col("click_count"), F.col("exposure_count")).alias("click_rate"),
        pct(F.col("order_count"), F.col("click_count")).alias("conversion_rate"),
        F.when(F.col("cost") > 0, divide(F.col("order_amount"), F.col("cost")))
        .otherwise(F.lit(0.0))
        .alias("roi"),
    )


def ads_traffic_source(source_stats: DataFrame) -> DataFrame:
    """(source, channel): views, visitors, bounce, session time and conversions."""
    keys = ["source_type", "source_name", "channel"]
    per_user = source_stats.groupBy(*keys, "user_id").agg(
        F.sum("pv").alias("pv"),
        F.sum("bounce_count").alias("bounces"),
        F.sum("session_count").alias("sessions"),
        F.sum("session_duration").alias("duration"),
        F.count("session_duration").alias("rows"),
        F.sum("conversion_count").alias("conversions"),
    )
    return per_user.groupBy(*keys).agg(
        F.sum("pv").alias("pv"),
        F.count("user_id").alias("uv"),
        pct(F.sum("bounces"), F.sum("sessions")).alias("bounce_rate"),
        divide(F.sum("duration"), F.sum("rows")).alias("avg_session_duration"),
        F.sum("conversions").alias("conversion_count"),
        pct(F.sum("conversions"), F.count("user_id")).alias("conversion_rate"),
    )


def ads_coupon_usage(uses: DataFrame, coupons: DataFrame, biz_date: str) -> DataFrame:
    """(recent_days, coupon): taken, used, rate and reduction.

    uses: coupon_id, user_id, order_id, used_time, reduce_amount, date_id.
    """
    keys = ["recent_days", "coupon_id"]
    used = F.col("used_time").isNotNull()
    per_order = uses.groupBy("coupon_id", "date_id", "user_id", "order_id").agg(
        F.count(F.lit(1)).alias("got"),
        count_if(used).alias("used"),
        sum_if(used, F.col("reduce_amount")).alias("reduced"),
    )
    recent = expand_recent_days(per_order, "date_id", biz_date)
    orders = (
        recent.where((F.col("used") > 0) & F.col("order_id").isNotNull())
        .select(*keys, "order_id")
        .distinct()
        .groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("order_count"))
    )
    per_user = recent.groupBy(*keys, "user_id").agg(
        F.sum("got").alias("got"), F.sum("used").alias("used"), money_sum("reduced").alias("reduced")
    )
    counted = per_user.groupBy(*keys).agg(
        F.sum("got").alias("get_count"),
        F.count("user_id").alias("get_user_count"),
        F.sum("used").alias("used_count"),
        count_if(F.col("used") > 0).alias("used_user_count"),
        money_sum("reduced").alias("coupon_amount"),
    )
    names = coupons.select("coupon_id", "coupon_name", "coupon_type")
    return combine([counted, orders], keys).join(names, "coupon_id", "left").select(
        "*", pct(F.col("used_count"), F.col("get_count")).alias("used_rate")
    )


def ads_activity_stats(participations: DataFrame, activities: DataFrame, biz_date: str) -> DataFrame:
    """(recent_days, campaign): participants, orders, reduction and reduction per order."""
    keys = ["recent_days", "activity_id"]
    per_order = participations.groupBy("activity_id", "date_id", "user_id", "order_id").agg(
        money_sum("reduce_amount").alias("reduced")
    )
    per_user = (
        expand_recent_days(per_order, "date_id", biz_date)
        .groupBy(*keys, "user_id")
        .agg(F.count_distinct("order_id").alias("orders"), money_sum("reduced").alias("reduced"))
    )
    counted = per_user.groupBy(*keys).agg(
        F.count("user_id").alias("participant_count"),
        F.sum("orders").alias("participant_order_count"),
        money_sum("reduced").alias("reduce_amount"),
    )
    names = activities.select("activity_id", "activity_name", "activity_type")
    return counted.join(names, "activity_id", "left").select(
        "*",
        divide(F.col("reduce_amount"), F.col("participant_order_count")).alias(
            "avg_reduce_per_order"
        ),
    )


def ads_customer_service(tickets: DataFrame, biz_date: str) -> DataFrame:
    """(recent_days, service type): tickets by state, resolution rate and the average
    handling time in minutes over handled tickets."""
    state = F.col("handle_result")
    seconds = F.unix_timestamp(F.col("handle_time").cast("timestamp")) - F.unix_timestamp(
        F.col("create_time").cast("timestamp")
    )
    daily = tickets.groupBy("date_id", "service_type").agg(
        F.count(F.lit(1)).alias("total_count"),
        *[
            count_if(state == s).alias(f"{s}_count")
            for s in (PENDING, PROCESSING, RESOLVED, UNSOLVED)
        ],
        F.count("handle_time").alias("handled"),
        F.sum(seconds).alias("seconds"),
    )
    counted = (
        expand_recent_days(daily, "date_id", biz_date)
        .groupBy("recent_days", "service_type")
        .agg(
            *[
                F.sum(c).alias(c)
                for c in ("total_count", *[f"{s}_count" for s in (PENDING, PROCESSING, RESOLVED, UNSOLVED)])
            ],
            divide(F.sum("seconds"), F.sum("handled") * 60).alias("avg_handle_time_minutes"),
        )
    )
    return counted.withColumn("resolved_rate", pct(F.col("resolved_count"), F.col("total_count")))
