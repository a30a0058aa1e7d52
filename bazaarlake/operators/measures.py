"""Order measures shared by the daily aggregates and the reports.

Every distinct count goes through two aggregations, first per (group, id) and then
per group. Both combine before their shuffle and the first is keyed by the id, so a
group holding a large share of all rows is never gathered in one task, and no row
is copied once per distinct count.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bazaarlake.functions.common import (
    RECENT_DAYS,
    count_if,
    divide,
    expand_recent_days,
    money_sum,
    sum_if,
)
from bazaarlake.session import ensure_checkpoint_dir


def line_measures(
    lines: DataFrame,
    keys: Sequence[str],
    biz_date: str | None = None,
    days: Sequence[int] = RECENT_DAYS,
    refunds: DataFrame | None = None,
) -> DataFrame:
    """Orders, pieces and money per `keys` from order lines.

    lines: order_id, sku_num, order_amount, is_paid (0/1), date_id. With biz_date the
    result has one row per (recent_days, keys). With refunds (refund_num,
    refund_amount, date_id and the keys) their rows, pieces and money are counted in
    the same aggregation.
    """
    dated = [] if biz_date is None else ["date_id"]
    per_order = lines.groupBy(*dict.fromkeys([*keys, "order_id", *dated])).agg(
        F.sum("sku_num").alias("num"),
        money_sum("order_amount").alias("amount"),
        F.max("is_paid").alias("paid"),
    )
    group = list(keys)
    columns = list(dict.fromkeys([*keys, *dated]))
    measures = [
        F.expr("count(paid) AS order_count"),
        F.expr("cast(coalesce(sum(num), 0) AS bigint) AS order_num"),
        money_sum("amount").alias("order_amount"),
        count_if("paid = 1").alias("payment_count"),
        F.expr("coalesce(sum(CASE WHEN paid = 1 THEN num END), 0L) AS payment_num"),
        sum_if("paid = 1", "amount").alias("payment_amount"),
    ]
    rows = per_order.select(*columns, "num", "amount", F.expr("coalesce(paid, 0) AS paid"))
    if refunds is not None:
        refunded = refunds.select(*columns, "refund_num", "refund_amount", F.expr("1 AS refund"))
        rows = rows.unionByName(refunded, allowMissingColumns=True)
        measures += [
            F.expr("count(refund) AS refund_count"),
            F.expr("cast(coalesce(sum(refund_num), 0) AS bigint) AS refund_num"),
            money_sum("refund_amount").alias("refund_amount"),
        ]
    if biz_date is not None:
        rows = expand_recent_days(rows, "date_id", biz_date, days)
        group = ["recent_days", *keys]
    return rows.groupBy(*group).agg(*measures)


def recent_sums(
    daily: DataFrame, keys: Sequence[str], biz_date: str, days: Sequence[int] = RECENT_DAYS
) -> DataFrame:
    """(recent_days, keys) of a daily table that carries the columns of line_measures: counts of
    orders add up, as an order lies on one day. An order whose lines of one key were
    recorded on several days counts on each."""
    columns = ("order_num", "order_count", "payment_count", "payment_num", "refund_count", "refund_num")
    money = [c for c in ("order_amount", "payment_amount", "refund_amount") if c in daily.columns]
    counts = [c for c in columns if c in daily.columns]
    rows = expand_recent_days(daily.select(*keys, "date_id", *counts, *money), "date_id", biz_date, days)
    return rows.groupBy("recent_days", *keys).agg(
        *[F.sum(c).cast("bigint").alias(c) for c in counts], *[money_sum(c).alias(c) for c in money]
    )


def combine(parts: Sequence[DataFrame], keys: Sequence[str]) -> DataFrame:
    """Measures of the same grain side by side, 0 where a part has no row: a union
    and one aggregation in place of a chain of full outer joins."""
    stacked = parts[0]
    for part in parts[1:]:
        stacked = stacked.unionByName(part, allowMissingColumns=True)
    types = {f.name: f.dataType for f in stacked.schema.fields}
    measures = [c for c in stacked.columns if c not in keys]
    return stacked.groupBy(*keys).agg(
        *[
            F.coalesce(F.sum(c), F.lit(0)).cast(types[c]).alias(c)
            if types[c].typeName() != "decimal"
            else money_sum(c).alias(c)
            for c in measures
        ]
    )


def order_measures(
    orders: DataFrame,
    keys: Sequence[str],
    biz_date: str | None = None,
    days: Sequence[int] = RECENT_DAYS,
) -> DataFrame:
    """Orders, buyers and money per `keys` from order headers, one row per order.

    orders: id, user_id, total_amount, goods_amount, feight_fee,
    benefit_reduce_amount, order_status_name, is_paid, date_id. With biz_date the
    result has one row per (recent_days, keys) and order_user_days, the sum of the
    daily distinct buyers.
    """
    daily = list(keys) if biz_date is None else [*keys, "date_id"]
    paid, pending, completed = "is_paid = 1", "order_status_name = 'PAID'", "order_status_name = 'COMPLETED'"
    per_user = orders.groupBy(*dict.fromkeys([*daily, "user_id"])).agg(
        F.count("id").alias("orders"),
        money_sum("total_amount").alias("gmv"),
        money_sum("goods_amount").alias("goods_amount"),
        money_sum("feight_fee").alias("feight_fee"),
        money_sum("benefit_reduce_amount").alias("discount_amount"),
        count_if(paid).alias("payments"),
        sum_if(paid, "total_amount").alias("payment_amount"),
        count_if(pending).alias("paid_orders"),
        sum_if(pending, "total_amount").alias("paid_gmv"),
        count_if(completed).alias("completed_orders"),
        sum_if(completed, "total_amount").alias("completed_gmv"),
    )
    money = (
        "gmv",
        "goods_amount",
        "feight_fee",
        "discount_amount",
        "payment_amount",
        "paid_gmv",
        "completed_gmv",
    )
    counts = ("orders", "payments", "paid_orders", "completed_orders")
    group = list(keys)
    user_days = "1"
    if biz_date is not None:
        group = ["recent_days", *keys]
        per_user = (
            expand_recent_days(per_user, "date_id", biz_date, days)
            .groupBy(*group, "user_id")
            .agg(
                *[F.sum(c).alias(c) for c in counts],
                *[money_sum(c).alias(c) for c in money],
                F.count(F.lit(1)).alias("user_days"),
            )
        )
        user_days = "user_days"
    result = per_user.groupBy(*group).agg(
        F.sum("orders").alias("order_count"),
        F.count("user_id").alias("order_user_count"),
        F.expr(f"sum({user_days}) AS order_user_days"),
        F.sum("payments").alias("payment_count"),
        count_if("payments > 0").alias("payment_user_count"),
        F.sum("paid_orders").alias("paid_order_count"),
        F.sum("completed_orders").alias("completed_order_count"),
        *[money_sum(c).alias(c) for c in money],
    )
    return result.select(
        "*",
        divide(F.col("gmv"), F.col("order_count")).alias("avg_order_amount"),
        divide(F.col("payment_amount"), F.col("payment_count")).alias("avg_pay_amount"),
    )


def with_share(df: DataFrame, value: str, name: str, within: str = "recent_days") -> DataFrame:
    """Share of `value` in its total per `within`, four decimals. The aggregated rows
    are checkpointed, so that rows and totals come from one scan of the facts; the
    totals, one row per window, are joined back and the groups stay distributed."""
    ensure_checkpoint_dir(df.sparkSession)
    df = df.checkpoint()
    totals = df.groupBy(within).agg(F.sum(value).alias("__total"))
    return df.join(totals, within).select(
        *df.columns, divide(F.col(value), F.col("__total"), 4).alias(name)
    )


def one_row(*frames: DataFrame) -> DataFrame:
    """Merge frames of one row each into one row."""
    stacked = frames[0]
    for frame in frames[1:]:
        stacked = stacked.unionByName(frame, allowMissingColumns=True)
    return stacked.agg(*[F.max(c).alias(c) for c in stacked.columns])
