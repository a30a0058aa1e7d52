"""The warehouse's source tables, derived from the sample star schema and event log.

Every frame covers its whole input unless a window is asked for; a window filters
the order date or event time itself, below every join, so that it reaches the scan.
Inputs the sample does not have (campaigns, coupons, tickets, devices, …) are
derived from the columns that come closest, as said at each.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from bazaarlake.functions.common import (
    MONEY,
    date_id,
    in_recent_days,
    is_paid,
    order_status_name,
    shift,
)
from bazaarlake.session import bound_tasks

ORDER_DAY = "2000-12-31"
EVENT_DAY = "2024-01-30"
# Days on which the user feeds below close; the last feed takes all later orders.
FEED_DAYS = ("1996-12-31", "1999-06-30", "2001-12-31")
SNAPSHOT_DAYS = ("2000-12-31", "2001-12-31")

ACTION_OF = {"view": "page_view", "click": "cart_add", "signup": "favor_add", "purchase": "order"}


def _lookup(column: str, mapping: dict[str, str], otherwise: Column) -> Column:
    result = None
    for key, value in mapping.items():
        test = F.col(column) == key
        result = F.when(test, value) if result is None else result.when(test, value)
    return result.otherwise(otherwise)


class Sample:
    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path
        self._tables: dict[str, DataFrame] = {}
        self._bounded = False

    def table(self, name: str) -> DataFrame:
        """The table's scan; its files are listed once per query."""
        if name not in self._tables:
            self._tables[name] = self.spark.read.parquet(f"{self.path}/{name}.parquet")
        return self._tables[name]

    # Orders -------------------------------------------------------------

    def _raw_orders(self, days: int | None) -> DataFrame:
        orders = self.table("orders")
        if days is not None:
            orders = orders.where(in_recent_days("o_orderdate", ORDER_DAY, days))
        return orders

    def order_info(self, days: int | None = None) -> DataFrame:
        """Order headers. Freight and reductions, which the sample has not, come from the key's digits."""
        return self._raw_orders(days).select(
            F.col("o_orderkey").alias("id"),
            F.col("o_custkey").alias("user_id"),
            _lookup("o_orderstatus", {"O": "1001", "P": "1002", "F": "1004"}, F.lit(None)).alias(
                "order_status"
            ),
            _lookup(
                "o_orderpriority",
                {"1-URGENT": "1", "2-HIGH": "2", "3-MEDIUM": "3"},
                F.col("o_orderpriority"),
            ).alias("payment_way"),
            F.col("o_totalprice").cast(MONEY).alias("total_amount"),
            (F.col("o_orderkey") % 10).cast(MONEY).alias("feight_fee"),
            F.expr("cast(o_orderkey % 7 * 0.5BD AS decimal(16,2))").alias("benefit_reduce_amount"),
            F.col("o_orderdate").alias("create_time"),
        )

    def order_info_with_province(self, days: int | None = None) -> DataFrame:
        """Order headers with the buyer's nation as province."""
        home = self.table("customer").select(
            F.col("c_custkey").alias("user_id"), F.col("c_nationkey").alias("province_id")
        )
        return self.order_info(days).join(home, "user_id", "left")

    def provinces(self) -> DataFrame:
        return self.table("nation").select(
            F.col("n_nationkey").alias("id"),
            F.col("n_name").alias("name"),
            F.col("n_regionkey").alias("region_id"),
        )

    def regions(self) -> DataFrame:
        return self.table("region").select(
            F.col("r_regionkey").alias("id"), F.col("r_name").alias("region_name")
        )

    def users(self) -> DataFrame:
        return self.table("customer").select(
            F.col("c_custkey").alias("id"),
            F.col("c_name").alias("name"),
            F.col("c_mktsegment").alias("user_level"),
        )

    def user_feeds(self) -> DataFrame:
        """Users as of each feed day: those who ordered since the day before the feed,
        the priority of their latest order as level."""
        day = F.when(F.col("o_orderdate") < shift(FEED_DAYS[0], 1), FEED_DAYS[0])
        day = day.when(F.col("o_orderdate") < shift(FEED_DAYS[1], 1), FEED_DAYS[1])
        newest = F.max(F.struct("o_orderdate", "o_orderkey", "o_orderpriority")).alias("newest")
        return (
            self.table("orders")
            .groupBy(F.col("o_custkey").alias("id"), day.otherwise(FEED_DAYS[2]).alias("dt"))
            .agg(newest)
            .select("id", F.col("newest.o_orderpriority").alias("user_level"), "dt")
        )

    def user_feed(self, day: str) -> DataFrame:
        return self.user_feeds().where(F.col("dt") == day).drop("dt")

    def order_feed(self, day: str) -> DataFrame:
        """Orders created by `day`; an order younger than 30 days is still unpaid."""
        settled = F.col("o_orderdate") < shift(day, -29)
        real = _lookup("o_orderstatus", {"O": "1001", "P": "1002", "F": "1004"}, F.lit(None))
        return (
            self.table("orders")
            .where(F.col("o_orderdate") < shift(day, 1))
            .select(
                F.col("o_orderkey").alias("id"),
                F.col("o_custkey").alias("user_id"),
                F.col("o_totalprice").cast(MONEY).alias("total_amount"),
                F.when(settled, real).otherwise("1001").alias("order_status"),
                date_id("o_orderdate").alias("create_time"),
                F.lit(day).alias("operate_time"),
            )
        )

    def status_log(self) -> DataFrame:
        return self.order_info().select(
            "id",
            F.col("id").alias("order_id"),
            "order_status",
            F.col("create_time").alias("operate_time"),
            F.col("user_id").alias("operate_user_id"),
        )

    # Order lines --------------------------------------------------------

    def _lineitem(self) -> DataFrame:
        """The order lines' scan. Their joins and the aggregates over them hold nearly every line as a
        group of its own; its row count, from the file footers, sets the size of their tasks."""
        if not self._bounded:
            bound_tasks(self.spark, self.table("lineitem").count())
            self._bounded = True
        return self.table("lineitem")

    def order_detail(self, days: int | None = None) -> DataFrame:
        """Order lines; order and line number are no key in the sample, the id may
        repeat. order_price is the line's amount (the sample has no unit price)."""
        header = self._raw_orders(days).select(
            F.col("o_orderkey").alias("l_orderkey"), F.col("o_orderdate").alias("create_time")
        )
        return self._lineitem().join(header, "l_orderkey").select(
            (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("id"),
            F.col("l_orderkey").alias("order_id"),
            F.col("l_partkey").alias("sku_id"),
            F.col("l_quantity").cast("bigint").alias("sku_num"),
            F.col("l_extendedprice").cast(MONEY).alias("order_price"),
            "create_time",
        )

    def lines(self, days: int | None = None) -> DataFrame:
        """Order lines with their order's buyer, status and day: the detail fact the
        aggregates read, from one join."""
        header = self.order_info(days).select(
            F.col("id").alias("l_orderkey"),
            "user_id",
            is_paid(order_status_name()).cast("int").alias("is_paid"),
            "create_time",
            date_id("create_time").alias("date_id"),
        )
        amount = F.col("l_extendedprice").cast(MONEY)
        return self._lineitem().join(header, "l_orderkey").select(
            F.col("l_orderkey").alias("order_id"),
            "user_id",
            F.col("l_partkey").alias("sku_id"),
            F.col("l_quantity").cast("bigint").alias("sku_num"),
            amount.alias("order_amount"),
            F.col("l_discount").cast("decimal(4,2)").alias("discount"),
            F.col("l_tax").cast("decimal(4,2)").alias("tax"),
            F.col("l_returnflag").alias("return_flag"),
            F.col("l_linestatus").alias("line_status"),
            F.col("l_shipdate").alias("ship_time"),
            "is_paid",
            "create_time",
            "date_id",
        )

    def sku_lines(self, days: int | None = None) -> DataFrame:
        """Order lines with brand and category."""
        return self.lines(days).join(self.sku_dim(), "sku_id", "left")

    def refunds(self, days: int | None = None) -> DataFrame:
        """Returned lines as refunds of their whole amount on the day they were shipped: the
        refund's own day, which the window is about. It filters the line's scan; the order
        may be older. order_time is the order's."""
        lines = self._lineitem().where(F.col("l_returnflag") == "R")
        if days is not None:
            lines = lines.where(in_recent_days("l_shipdate", ORDER_DAY, days))
        header = self.order_info().select(
            F.col("id").alias("l_orderkey"), "user_id", F.col("create_time").alias("order_time")
        )
        return lines.join(header, "l_orderkey").select(
            F.col("l_orderkey").alias("order_id"),
            "user_id",
            F.col("l_partkey").alias("sku_id"),
            F.col("l_quantity").cast("bigint").alias("refund_num"),
            F.col("l_extendedprice").cast(MONEY).alias("refund_amount"),
            F.col("l_linestatus").alias("line_status"),
            "order_time",
            F.col("l_shipdate").alias("create_time"),
            date_id("l_shipdate").alias("date_id"),
        )

    def sku_refunds(self, days: int | None = None) -> DataFrame:
        """Refunds with brand and category."""
        return self.refunds(days).join(self.sku_dim(), "sku_id", "left")

    # Products -----------------------------------------------------------

    def sku_info(self) -> DataFrame:
        return self.table("part").select(
            F.col("p_partkey").alias("id"),
            F.col("p_name").alias("sku_name"),
            F.col("p_retailprice").cast(MONEY).alias("price"),
            F.col("p_brand").alias("tm_id"),
            self._category3().alias("category3_id"),
        )

    @staticmethod
    def _category3() -> Column:
        return F.concat(F.col("p_type"), F.lit("/"), F.floor(F.col("p_size") / 10).cast("string"))

    def trademarks(self) -> DataFrame:
        return self.table("part").select(
            F.col("p_brand").alias("tm_id"), F.col("p_brand").alias("tm_name")
        )

    def category3(self) -> DataFrame:
        c3 = self._category3()
        return self.table("part").select(
            c3.alias("id"), c3.alias("name"), F.col("p_type").alias("category2_id")
        )

    @staticmethod
    def _category1() -> Column:
        """The sample has one top category, which every typed part belongs to."""
        return F.when(F.col("p_type").isNotNull(), "ALL")

    def category2(self) -> DataFrame:
        return self.table("part").select(
            F.col("p_type").alias("id"),
            F.col("p_type").alias("name"),
            self._category1().alias("category1_id"),
        )

    def category1(self) -> DataFrame:
        top = self._category1()
        return self.table("part").select(top.alias("id"), top.alias("name"))

    def sku_dim(self) -> DataFrame:
        """Flattened SKU attributes. The sample's levels are their own names, so they
        come from part directly; dim_sku_full builds the same from the lookups."""
        c3 = self._category3()
        return self.table("part").select(
            F.col("p_partkey").alias("sku_id"),
            F.col("p_name").alias("sku_name"),
            F.col("p_brand").alias("tm_id"),
            self._category1().alias("category1_id"),
            F.col("p_type").alias("category2_id"),
            c3.alias("category3_id"),
            F.col("p_brand").alias("tm_name"),
            c3.alias("category3_name"),
        )

    # Behaviour ----------------------------------------------------------

    def events(self, days: int | None = None) -> DataFrame:
        events = self.table("events")
        if days is not None:
            events = events.where(in_recent_days("ts", EVENT_DAY, days))
        return events.withColumn("sku_id", F.get_json_object("props", "$.k").cast("bigint"))

    def actions(self, days: int | None = None) -> DataFrame:
        """Event log in action codes, errors left out. A purchase of positive value
        counts as paid."""
        return (
            self.events(days)
            .where(F.col("event_type").isin(*ACTION_OF))
            .select(
                "user_id",
                "sku_id",
                _lookup("event_type", ACTION_OF, F.lit(None)).alias("action_code"),
                F.col("ts").alias("action_time"),
                date_id("ts").alias("date_id"),
                F.col("value").cast(MONEY).alias("value"),
                ((F.col("event_type") == "purchase") & (F.col("value") > 0))
                .cast("int")
                .alias("is_paid"),
            )
        )

    def action_feed(self, event_type: str, key: str, time: str) -> DataFrame:
        """One behaviour feed in the shape its source table declares."""
        return (
            self.events()
            .where(F.col("event_type") == event_type)
            .select(
                "user_id",
                "sku_id",
                F.lit(None).cast("string").alias("session_id"),
                F.col("event_id").alias(key),
                F.col("event_id").alias("order_id"),
                F.col("ts").alias(time),
            )
        )

    def raw_lines(self) -> DataFrame:
        """The event log as 5-field text lines, with four kinds of damaged line: a
        slashed date, no product, a field missing, an unpadded date."""
        kind = F.pmod("event_id", F.lit(40))
        time = (
            F.when(kind == 0, F.date_format("ts", "MM/dd/yyyy HH:mm:ss"))
            .when(kind == 3, F.date_format("ts", "yyyy-M-d HH:mm:ss"))
            .otherwise(F.date_format("ts", "yyyy-MM-dd HH:mm:ss"))
        )
        product = F.when(kind == 1, "").otherwise(F.concat(F.lit("product"), "sku_id"))
        fields = [
            time,
            F.concat(F.lit("user"), "user_id"),
            F.concat(F.lit("192.168.1."), F.pmod("user_id", F.lit(255))),
            F.col("event_type"),
            F.when(kind != 2, product),
        ]
        # concat_ws leaves out the NULL of the missing field.
        return self.events().select(
            F.col("event_id").alias("line_id"), F.concat_ws(",", *fields).alias("line")
        )

    def product_lookup(self) -> DataFrame:
        return self.table("part").select(
            F.concat(F.lit("product"), "p_partkey").alias("product"),
            F.col("p_name").alias("name"),
            F.col("p_retailprice").alias("price"),
            F.col("p_type").alias("category"),
        )

    # Inputs without a counterpart in the sample -------------------------

    def activities(self) -> DataFrame:
        """Campaigns: one per discount step, running over its orders' days."""
        return (
            self.activity_orders()
            .groupBy(F.col("activity_id").alias("id"))
            .agg(F.min("date_id").alias("start_time"), F.max("date_id").alias("end_time"))
            .select(
                "id",
                F.concat(F.lit("discount "), "id").alias("activity_name"),
                F.lit("reduction").alias("activity_type"),
                "start_time",
                "end_time",
                F.col("start_time").alias("create_time"),
            )
        )

    def activity_orders(self, days: int | None = None) -> DataFrame:
        """Campaign participations: the discounted order lines."""
        return self.lines(days).where(F.col("discount") > 0).select(
            F.col("order_id").alias("id"),
            F.concat(F.lit("D"), F.col("discount").cast("string")).alias("activity_id"),
            "order_id",
            "user_id",
            "sku_id",
            (F.col("order_amount") * F.col("discount")).cast(MONEY).alias("reduce_amount"),
            "create_time",
            "date_id",
        )

    def coupons(self) -> DataFrame:
        """Coupons: one per tax step."""
        return (
            self.coupon_uses()
            .groupBy(F.col("coupon_id").alias("id"))
            .agg(F.min("date_id").alias("start_time"), F.max("date_id").alias("end_time"))
            .select(
                "id",
                F.concat(F.lit("coupon "), "id").alias("coupon_name"),
                F.lit("cash").alias("coupon_type"),
                F.lit(0).cast(MONEY).alias("discount_amount"),
                F.lit(0).cast(MONEY).alias("threshold_amount"),
                "start_time",
                "end_time",
                F.col("start_time").alias("create_time"),
            )
        )

    def coupon_uses(self, days: int | None = None) -> DataFrame:
        """Coupons taken: the taxed order lines; used if the line is finished."""
        used = F.col("line_status") == "F"
        return self.lines(days).where(F.col("tax") > 0).select(
            F.col("order_id").alias("id"),
            F.concat(F.lit("T"), F.col("tax").cast("string")).alias("coupon_id"),
            "user_id",
            "order_id",
            "create_time",
            F.when(used, F.col("create_time")).alias("used_time"),
            (F.col("order_amount") * F.col("tax")).cast(MONEY).alias("reduce_amount"),
            "date_id",
        )

    def tickets(self) -> DataFrame:
        """Service tickets: the error events; their value sets type and state."""
        value = F.col("value")
        state = (
            F.when(value < 5, "pending").when(value < 10, "processing").when(value < 40, "resolved")
        ).otherwise("unsolved")
        return (
            self.events()
            .where(F.col("event_type") == "error")
            .select(
                F.col("event_id").alias("id"),
                "user_id",
                "sku_id",
                F.when(value < 20, "quality").otherwise("delivery").alias("service_type"),
                F.date_trunc("second", "ts").alias("create_time"),
                F.when(
                    state.isin("resolved", "unsolved"),
                    F.date_trunc("second", "ts")
                    + F.make_dt_interval(mins=F.floor(value).cast("int")),
                ).alias("handle_time"),
                state.alias("handle_result"),
            )
        )

    def reviews(self) -> DataFrame:
        """Reviews: the signup events; their value sets the stars."""
        return (
            self.events()
            .where(F.col("event_type") == "signup")
            .select(
                F.col("event_id").alias("review_id"),
                "user_id",
                "sku_id",
                F.least(F.lit(5), F.floor(F.col("value") / 10) + 1).cast("bigint").alias("review_star"),
                F.col("ts").alias("create_time"),
            )
        )

    def device_stats(self) -> DataFrame:
        """(user, device) on the last event day; the event value tells the device."""
        device = F.when(F.col("value") < 10, "PC").when(F.col("value") < 25, "MOBILE").otherwise("APP")
        seen_before = self.events().groupBy("user_id").agg(
            F.min("ts").alias("first_seen"),
            F.max(F.when(F.col("ts") < EVENT_DAY, F.col("ts"))).alias("last_seen"),
        )
        today = (
            self.events(1)
            .groupBy("user_id", device.alias("device_type"))
            .agg(
                F.count(F.lit(1)).alias("page_view_count"),
                F.floor(
                    (
                        F.unix_micros(F.max("ts").cast("timestamp"))
                        - F.unix_micros(F.min("ts").cast("timestamp"))
                    )
                    / 60_000_000
                ).alias("duration_minutes"),
            )
        )
        return today.join(seen_before, "user_id").select(
            "user_id",
            "device_type",
            (F.col("first_seen") >= EVENT_DAY).cast("int").alias("is_new"),
            (F.col("last_seen") < shift(EVENT_DAY, -1)).cast("int").alias("is_return"),
            "duration_minutes",
            "page_view_count",
        )

    def campaign_stats(self) -> DataFrame:
        """(SKU, device) totals as campaigns of the SKU's brand; views are exposures,
        at a cost of one each."""
        kind = F.col("event_type")
        channel = F.when(F.col("value") < 10, "search").otherwise("social")
        brand = self.sku_dim().select("sku_id", F.col("tm_id").alias("campaign_id"))
        amount = F.when(kind == "purchase", F.col("value").cast(MONEY))
        views = F.count(F.when(kind == "view", 1))
        return (
            self.events()
            .groupBy("sku_id", channel.alias("channel"))
            .agg(
                views.alias("exposure_count"),
                F.count(F.when(kind == "click", 1)).alias("click_count"),
                F.count(F.when(kind == "purchase", 1)).alias("order_count"),
                F.sum(amount).alias("order_amount"),
                views.cast(MONEY).alias("cost"),
            )
            .join(brand, "sku_id")
            .select(
                "*",
                F.col("campaign_id").alias("campaign_name"),
                F.lit("2024-01-01").alias("start_date"),
                F.lit(EVENT_DAY).alias("end_date"),
            )
        )

    def traffic_stats(self) -> DataFrame:
        """One row per user, day and third of the day; the third stands for the
        source the visit came from."""
        hour = F.hour("ts")
        source = F.when(hour < 8, "direct").when(hour < 16, "search").otherwise("ads")
        seconds = F.floor(
            (
                F.unix_micros(F.max("ts").cast("timestamp"))
                - F.unix_micros(F.min("ts").cast("timestamp"))
            )
            / 1_000_000
        )
        return (
            self.events()
            .groupBy("user_id", date_id("ts").alias("date_id"), source.alias("source_type"))
            .agg(
                F.count(F.lit(1)).alias("pv"),
                seconds.alias("session_duration"),
                F.count(F.when(F.col("event_type") == "purchase", 1)).alias("conversion_count"),
            )
            .select(
                "*",
                F.col("source_type").alias("source_name"),
                F.lit("web").alias("channel"),
                F.lit(1).alias("session_count"),
                F.when(F.col("pv") == 1, 1).otherwise(0).alias("bounce_count"),
            )
        )
