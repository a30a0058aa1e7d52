"""The daily run: raw text → dimensions → details → aggregates → reports.

Layers are ORC tables in dt folders under one root. A step reads what the steps
before it wrote, so a rerun of a day, or of a failed step, replaces just that day's
folders, and a lost executor costs one step's tasks at most. Days have to run in
order, since the user zipper and the order snapshot continue from the day before:
without that day's folders the run stops, unless it is told that it is the first.

Lines, payments, refunds and actions are taken when they are delivered for the first time,
which the arrival ledger tells by their key: a row of an earlier day lands in that
day's folder, and the day's aggregates are done again. A row of a later day waits in the
ledger for that day's run.

Lines, payments and refunds take buyer, province and payment state from the order
snapshot, which knows every order seen so far. An order that changes after its day,
or is delivered late, is rewritten in the folder of its day, and so are its lines and
the aggregates of the days they lie in.
"""

from __future__ import annotations

from collections.abc import Callable, Collection, Sequence
from math import ceil

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bazaarlake.functions.common import date_id, is_paid, last_year, latest_per_key, present, shift
from bazaarlake.operators import activity, ads, bitmaps, dim, dwd, dws, quality, quantiles
from bazaarlake.operators.sessions import as_of, daily_sessions
from bazaarlake.sources.arrivals import KEY, Ledger
from bazaarlake.sources.bucketed import read_bucketed, stored_buckets, write_bucketed
from bazaarlake.sources.files import (
    append_partition,
    created_on,
    read_partition,
    read_raw,
    read_table,
    write_partition,
    write_partitions,
)
from bazaarlake.sources.quarantine import Profile, Rules, quarantine
from bazaarlake.sources.schemas import raw_schema

# Tables of events that need not occur on a day, and reports over them.
MAY_BE_EMPTY = (
    "dwd/dwd_payment_info",
    "dwd/dwd_order_refund",
    "dwd/dwd_action",
    "dws/dws_user_action_days",
    "dws/dws_session",
    "dws/dws_page_view_day",
    "dws/dws_refund_total",
    "dws/dws_refunded_orders",
    "ads/ads_conversion_rate",
    "ads/ads_user_activity",
    "ads/ads_user_retention",
    "ads/ads_user_retention_detail",
    "ads/ads_sku_repurchase_analysis",
)


# Buckets of the open users, taken on the first day: not fewer than the cluster's shuffle partitions.
BUCKETS = 64

# Feeds of events and the column that dates them.
EVENTS = {
    "order_detail": "create_time",
    "order_refund_info": "create_time",
    "payment_info": "create_time",
    "action_page_view": "action_time",
    "action_favor_add": "create_time",
    "action_cart_add": "create_time",
    "action_order": "create_time",
}
ACTIONS = ("action_page_view", "action_favor_add", "action_cart_add", "action_order")
# What a fact needs besides its day to be more than a damaged row.
NEEDED = {
    "order_detail": ("id", "order_id", "sku_id"),
    "order_refund_info": ("order_id",),
    "payment_info": ("order_id",),
    **{feed: ("user_id",) for feed in ACTIONS},
}
# What the raw lines of each table are checked for.
RAW_RULES = {
    **{feed: Rules(needed, time=EVENTS[feed]) for feed, needed in NEEDED.items()},
    "order_detail": Rules(
        NEEDED["order_detail"], {"sku_num": "sku_num > 0", "order_price": "order_price >= 0"}, EVENTS["order_detail"]
    ),
    "order_info": Rules(("id", "user_id"), time="create_time"),
    **{t: Rules(("id",)) for t in ("user_info", "sku_info", "base_province", "base_region")},
    **{t: Rules(("id",)) for t in ("base_category1", "base_category2", "base_category3")},
    "base_trademark": Rules(("tm_id",)),
}
# The share of a table's lines that may be rejected before the gate stops the day.
MAX_REJECTED = 0.5

FACTS = {
    "dwd_order_detail": ("order_detail",),
    "dwd_order_refund": ("order_refund_info",),
    "dwd_payment_info": ("payment_info",),
    "dwd_action": ACTIONS,
}


# Masks of the days on which users were active, and the facts they come from.
ACTIVE_DAYS = {"dws_user_order_days": "dwd_order_info", "dws_user_action_days": "dwd_action"}

# Dense numbers for bitmaps: the key that is numbered, and the facts it comes from.
NUMBERS = {
    "dim_buyer_number": ("user_id", "dwd_order_info"),
    "dim_refunded_order_number": ("order_id", "dwd_order_refund"),
}


class MissingInput(RuntimeError):
    """A raw table was not delivered, or the day before has not run."""


class DailyRun:
    def __init__(
        self,
        spark: SparkSession,
        raw_root: str,
        root: str,
        biz_date: str,
        first_day: bool = False,
        not_delivered: Collection[str] = (),
        buckets: int = BUCKETS,
        max_rejected: float = MAX_REJECTED,
    ):
        self.spark = spark
        self.raw_root = raw_root
        self.root = root
        self.dt = biz_date
        self.first_day = first_day
        self.not_delivered = frozenset(not_delivered)
        self.buckets = buckets
        self.max_rejected = max_rejected
        self.raw_profile: dict[str, Profile] = {}
        self.written: list[str] = []
        self.touched: list[str] = []
        self.late: dict[str, list[str]] = {}

    # Tables -------------------------------------------------------------

    def raw(self, table: str) -> DataFrame:
        """The day's raw rows; a table that the caller names as not delivered is empty."""
        schema = raw_schema(table)
        if table in self.not_delivered:
            return self.spark.createDataFrame([], schema)
        try:
            return read_raw(self.spark, f"{self.raw_root}/{table}", schema, self.dt).drop("dt")
        except AnalysisException as error:
            if error.getCondition() == "PATH_NOT_FOUND":
                raise MissingInput(f"{table} was not delivered for {self.dt}") from error
            raise

    def facts(self, table: str, time: str = "create_time") -> DataFrame:
        """Raw rows of events on the business day, one per id: a full export repeats
        older rows, an interrupted one may repeat rows of the day."""
        rows = created_on(self.raw(table), self.dt, time)
        if "id" not in rows.columns:
            return rows
        order = [c for c in ("operate_time", time) if c in rows.columns]
        return latest_per_key(rows, ["id"], order)

    def ledger(self, feed: str) -> Ledger:
        return Ledger(self.spark, self.path("arrivals", feed), raw_schema(feed))

    def arrive(self, feed: str) -> DataFrame:
        """Record the feed's new rows. Returns those that land today: all rows of the business day,
        and rows of earlier days that arrived today, with dt and seen."""
        ledger = self.ledger(feed)
        self.late[feed] = []
        if feed not in self.not_delivered or ledger.started():
            days = ledger.record(self.raw(feed), self.dt, EVENTS[feed])
            self.late[feed] = [d for d in days if d < self.dt]
        return self._landing(ledger.rows())

    def _landing(self, rows: DataFrame) -> DataFrame:
        back = (F.col("seen") == self.dt) & (F.col("dt") < self.dt)
        return rows.where((F.col("dt") == self.dt) | back)

    def land(self, table: str, facts: DataFrame) -> None:
        """Facts into the folders of their days. An earlier day keeps what arrived on other
        days; what a former run of today put there goes."""
        path = self.path("dwd", table)
        facts = facts.drop(KEY).withColumnRenamed("seen", "arrived_on")
        self.save("dwd", table, facts.where(F.col("dt") == self.dt))
        days = sorted({d for feed in FACTS[table] for d in self.late[feed]})
        if not days:
            return
        stored = read_table(self.spark, path).where(F.col("dt").isin(*days))
        kept = stored.where(F.col("arrived_on") != self.dt)
        late = facts.where(F.col("dt") < self.dt).select(*stored.columns)
        both = kept.unionByName(late)
        left = {r["dt"] for r in both.select("dt").distinct().collect()}
        write_partitions(both, path)
        for day in set(days) - left:
            write_partition(self.spark.createDataFrame([], stored.schema), path, day)

    def path(self, layer: str, table: str) -> str:
        return f"{self.root}/{layer}/{table}"

    def save(self, layer: str, table: str, df: DataFrame) -> DataFrame:
        write_partition(df, self.path(layer, table), self.dt)
        self.written.append(f"{layer}/{table}")
        return self.load(layer, table)

    def load(self, layer: str, table: str) -> DataFrame:
        return read_partition(self.spark, self.path(layer, table), self.dt)

    def load_days(self, layer: str, table: str, days: int) -> DataFrame:
        return read_table(self.spark, self.path(layer, table), shift(self.dt, 1 - days), self.dt)

    def yesterday(self, layer: str, table: str) -> DataFrame | None:
        """The table as the day before left it; None on the first day only."""
        if self.first_day:
            return None
        before = shift(self.dt, -1)
        rows = self.stored(layer, table, before)
        if rows is None:
            raise MissingInput(
                f"{layer}/{table} of {before} is missing: run that day, or start with first_day"
            )
        return rows

    def stored(self, layer: str, table: str, day: str) -> DataFrame | None:
        """The table as a day left it; None where that day has not run."""
        try:
            return read_partition(self.spark, self.path(layer, table), day).drop("dt")
        except AnalysisException as error:
            if error.getCondition() == "PATH_NOT_FOUND":
                return None
            raise

    def replace_days(self, layer: str, table: str, df: DataFrame, days: Collection[str]) -> None:
        """Replace the folders of some days; those that df has no rows for are empty then. df must
        not read these folders."""
        path = self.path(layer, table)
        for day in days:
            write_partition(df.limit(0), path, day)
        write_partitions(df, path)

    # Layers -------------------------------------------------------------

    def run_raw(self) -> None:
        """Damaged lines of the day's raw tables go to quarantine/raw, with their reasons."""
        tables = {t: (raw_schema(t), rules) for t, rules in RAW_RULES.items() if t not in self.not_delivered}
        for table in tables:
            self.raw(table)  # has to be there
        self.raw_profile = quarantine(self.spark, self.raw_root, tables, self.path("quarantine", "raw"), self.dt)

    def raw_gate(self) -> DataFrame:
        """Sound lines of each raw table against those it needs."""
        sound = [(f"raw/{t}", p.rows - p.rejected) for t, p in self.raw_profile.items()]
        counts = self.spark.createDataFrame(sound, "table_name string, row_count bigint")
        least = {f"raw/{t}": ceil(p.rows * (1 - self.max_rejected)) for t, p in self.raw_profile.items()}
        return quality.quality_gate(counts, least)

    def run_dim(self) -> None:
        users = latest_per_key(self.raw("user_info"), ["id"], ["operate_time", "create_time"])
        self._zip_users(users)
        self.save("dim", "dim_user_scd1", dim.dim_user_scd1(users, ["create_time"]))
        brands = self.save("dim", "dim_brand", dim.dim_brand(self.raw("base_trademark")))
        c1 = self.save("dim", "dim_category1", dim.dim_category1(self.raw("base_category1")))
        c2 = self.save("dim", "dim_category2", dim.dim_category2(self.raw("base_category2")))
        c3 = self.save("dim", "dim_category3", dim.dim_category3(self.raw("base_category3")))
        skus = self.raw("sku_info")
        flat = dim.dim_sku_full(
            skus.where(F.col("id").isNotNull()), *[d.drop("dt") for d in (brands, c3, c2, c1)]
        )
        self.save("dim", "dim_sku_full", flat)
        provinces = dim.dim_province(self.raw("base_province"), self.raw("base_region"))
        self.save("dim", "dim_province", provinces)

    def _zip_users(self, users: DataFrame) -> None:
        """The user zipper: open versions bucketed by id in a table of the day, closed ones once, in
        the folder of the day they end."""
        path, closed_path = self.path("dim", "dim_user_open"), self.path("dim", "dim_user_closed")
        if self.first_day:
            first = dim.dim_user_init(users, self.dt).repartition(self.buckets, "id")
            write_bucketed(first, path, self.dt, "id", self.buckets)
            return
        before = shift(self.dt, -1)
        open_users = self.open_before()
        # The number of buckets stays what it was on the first day.
        buckets = stored_buckets(self.spark, path, before)
        known, new, closed = dim.dim_user_open_update(open_users, users, self.dt)
        write_bucketed(known, path, self.dt, "id", buckets)
        write_bucketed(new.repartition(buckets, "id"), path, self.dt, "id", buckets, append=True)
        write_partition(closed, closed_path, before)

    def open_before(self) -> DataFrame | None:
        """The open users as the day before left them; None on the first day only."""
        if self.first_day:
            return None
        before = shift(self.dt, -1)
        users = read_bucketed(self.spark, self.path("dim", "dim_user_open"), before, "id")
        if users is None:
            raise MissingInput(f"dim/dim_user_open of {before} is missing: run that day, or start with first_day")
        return users

    def open_users(self) -> DataFrame:
        return read_bucketed(self.spark, self.path("dim", "dim_user_open"), self.dt, "id")

    def run_dwd(self) -> None:
        sku_dim = self.load("dim", "dim_sku_full").drop("dt", "create_time", "price")
        header, late = self._orders()
        orders = header.withColumnRenamed("order_id", "id")
        lines = dwd.dwd_order_detail(self.arrive("order_detail"), sku_dim)
        self.land("dwd_order_detail", self._with_header(lines, header))
        refunds = self.arrive("order_refund_info")
        self.land("dwd_order_refund", dwd.dwd_order_refund(refunds, orders, sku_dim))
        payments = self.arrive("payment_info").drop("user_id")
        paid_by = header.select("order_id", "user_id")
        self.land(
            "dwd_payment_info",
            dwd.dwd_payment_info(payments, orders).join(paid_by, "order_id", "left"),
        )
        self.land("dwd_action", dwd.dwd_action(*[self.arrive(feed) for feed in ACTIONS], sku_dim))
        days = self._carry_back(header, late)
        self.touched = sorted({*days, *(d for late_days in self.late.values() for d in late_days)})

    @staticmethod
    def _with_header(lines: DataFrame, header: DataFrame) -> DataFrame:
        """Lines with buyer, province and payment state of their order; a line whose order
        was never delivered stays, without them."""
        return (
            lines.join(header, "order_id", "left")
            .withColumn("is_paid", F.coalesce("is_paid", F.lit(0)))
            .withColumn("date_id", date_id("create_time"))
        )

    def _enriched(self, orders: DataFrame) -> DataFrame:
        return dwd.dwd_order_info(
            orders,
            self.open_users(),
            self.load("dim", "dim_province").drop("dt"),
        )

    def _orders(self) -> tuple[DataFrame, DataFrame]:
        """Orders of the day and the order snapshot. Returns the snapshot as order_id, user_id,
        province_id, is_paid, and the orders of earlier days that are new or have changed."""
        self.save("dwd", "dwd_order_info", self._enriched(self.facts("order_info")))
        feed = latest_per_key(self.raw("order_info"), ["id"], ["operate_time", "create_time"])
        before = self.yesterday("dim", "dim_order_accumulate_snapshot")
        if before is None:
            before = dim.empty_order_snapshot(self.spark, feed, ("province_id",))
        snapshot = self.save(
            "dim",
            "dim_order_accumulate_snapshot",
            dim.order_accumulating_snapshot(before, feed, self.dt, ("province_id",)),
        )
        header = snapshot.select(
            "order_id", "user_id", "province_id", is_paid("order_status").cast("int").alias("is_paid")
        )
        known = before.select(
            F.col("order_id").alias("id"),
            F.col("order_status").alias("known_status"),
            F.col("total_amount").alias("known_amount"),
            F.lit(1).alias("known"),
        )
        now = dwd.dwd_order_info_clean(feed.where(F.col("create_time") < self.dt))
        same = F.col("known_status").eqNullSafe(F.col("order_status_name")) & F.col(
            "known_amount"
        ).eqNullSafe(F.col("total_amount"))
        changed = now.join(known, "id", "left").where(F.col("known").isNull() | ~same)
        return header, feed.join(changed.select("id"), "id", "left_semi")

    def _carry_back(self, header: DataFrame, late: DataFrame) -> list[str]:
        """Rewrite earlier days' orders and lines that have changed; returns the days."""
        days = {r[0] for r in late.select(date_id("create_time")).distinct().collect()}
        if not days:
            return []
        path = self.path("dwd", "dwd_order_info")
        new = self._enriched(late).withColumn("dt", F.col("date_id"))
        old = read_table(self.spark, path).where(F.col("dt").isin(*days))
        kept = old.join(late.select("id"), "id", "left_anti")
        write_partitions(kept.unionByName(new, allowMissingColumns=True), path)
        # The ledger names the days on which lines of these orders lie.
        known = self.ledger("order_detail").rows().where(F.col("dt") < self.dt).select("order_id", "dt")
        of_late = known.join(late.select(F.col("id").alias("order_id")), "order_id", "left_semi")
        line_days = {r[0] for r in of_late.select("dt").distinct().collect()}
        if line_days:
            path = self.path("dwd", "dwd_order_detail")
            lines = read_table(self.spark, path).where(F.col("dt").isin(*line_days))
            stale = lines.drop("user_id", "province_id", "is_paid")
            columns = lines.columns
            write_partitions(self._with_header(stale, header).select(*columns), path)
        return sorted(days | line_days)

    def _number(self, days: Sequence[str]) -> None:
        """Number the keys that some days bring for the first time, in the folder of today. Numbers are
        only ever added, so a rerun changes none."""
        for name, (key, table) in NUMBERS.items():
            new = bitmaps.new_numbers(self._numbers(name), self._days(table, days), key)
            append_partition(new, self.path("dim", name), self.dt)

    def _numbers(self, name: str) -> DataFrame | None:
        try:
            return read_table(self.spark, self.path("dim", name)).drop("dt")
        except AnalysisException as error:
            if error.getCondition() == "PATH_NOT_FOUND":
                return None
            raise

    def run_dws(self) -> None:
        self._number([*self.touched, self.dt])
        for name, df in self._aggregates([self.dt]).items():
            self.save("dws", name, df)
        # Days with late rows set their bits again, an earlier first day included.
        days = [*self.touched, self.dt]
        for name, table in ACTIVE_DAYS.items():
            masks = activity.update_masks(self.yesterday("dws", name), self._days(table, days), self.dt)
            self.save("dws", name, masks)
        if self.touched:
            for name, df in self._aggregates(self.touched).items():
                write_partitions(df.withColumn("dt", F.col("date_id")), self.path("dws", name))

        self._page_views()

    def _page_views(self) -> None:
        """Sessions of the day's page views, those open at midnight taken up from the day before,
        and the hours in which they began. Days with late views are done again, and so
        is each day after them whose open sessions came out otherwise."""
        self.yesterday("dws", "dws_session")  # the day before has to have run
        days = sorted({*self.late["action_page_view"], self.dt})
        # The first day may bring a whole history, which is one span.
        starts = self._write_sessions(days[0], self.dt) if self.first_day else set()
        while days and not self.first_day:
            first = last = days.pop(0)
            while days and days[0] == shift(last, 1):
                last = days.pop(0)
            before = self._open_digest(last)
            starts |= self._write_sessions(first, last)
            if last < self.dt and self._open_digest(last) != before:
                days.insert(0, shift(last, 1))
        known = as_of(read_table(self.spark, self.path("dws", "dws_session"), min(starts), self.dt), self.dt)
        hours = dws.page_view_hours(known.where(F.col("date_id").isin(*starts)))
        self.replace_days("dws", "dws_page_view_day", hours.withColumn("dt", F.col("date_id")), starts)
        self.written += ["dws/dws_session", "dws/dws_page_view_day"]

    def _open_digest(self, day: str) -> tuple | None:
        """Tells the open sessions of a day from others; None if there are none."""
        rows = self.stored("dws", "dws_session", day)
        if rows is None:
            return None
        key = F.xxhash64("user_id", "session_start", "session_end", "views")
        n, folded, summed = (
            rows.where("is_open")
            .agg(F.count(F.lit(1)), F.bit_xor(key), F.sum(F.pmod(key, F.lit(1 << 31))))
            .first()
        )
        return (n, folded, summed) if n else None

    def _write_sessions(self, first: str, last: str) -> set[str]:
        """Replace the sessions of the days first to last; returns the days on which sessions begin
        that were or are among them."""
        path = self.path("dws", "dws_session")
        span = [first]
        while span[-1] < last:
            span.append(shift(span[-1], 1))
        starts = {first, last}
        for day in span:
            before = self.stored("dws", "dws_session", day)
            if before is not None:
                starts |= {r[0] for r in before.select("date_id").distinct().collect()}
        carried = None
        if not (self.first_day and last == self.dt):
            carried = self.stored("dws", "dws_session", shift(first, -1))
        views = read_table(self.spark, self.path("dwd", "dwd_action"), first, last)
        views = views.where(F.col("action_code") == "page_view").select("user_id", "action_time")
        self.replace_days("dws", "dws_session", daily_sessions(carried, views, "action_time", first, last), span)
        written = read_table(self.spark, path, first, last)
        return starts | {r[0] for r in written.select("date_id").distinct().collect()}

    def _days(self, table: str, days: Sequence[str]) -> DataFrame:
        return read_table(self.spark, self.path("dwd", table)).where(F.col("dt").isin(*days))

    def _aggregates(self, days: Sequence[str]) -> dict[str, DataFrame]:
        """The daily tables of some days, from the details of those days."""

        def of(table: str) -> DataFrame:
            return self._days(table, days).drop("dt")

        orders, lines = of("dwd_order_info"), of("dwd_order_detail")
        refunds, actions = of("dwd_order_refund"), of("dwd_action")
        return {
            "dws_gmv_stats": dws.dws_gmv_stats(orders),
            "dws_user_action_stats": dws.dws_user_action_stats(actions, lines, refunds),
            "dws_sku_stats": dws.dws_sku_stats(lines, refunds),
            "dws_province_stats": dws.dws_province_stats(orders),
            "dws_trademark_stats": dws.dws_trademark_stats(lines),
            "dws_category_stats": dws.dws_category_stats(lines),
            "dws_order_day": dws.dws_order_day(orders, refunds),
            "dws_user_day": dws.dws_user_day(orders),
            "dws_sku_day": dws.dws_sku_day(lines),
            "dws_order_total": bitmaps.order_totals(orders),
            "dws_order_amounts": quantiles.daily_amounts(orders),
            "dws_order_users": bitmaps.order_users(orders, self._numbers("dim_buyer_number")),
            "dws_refund_total": bitmaps.refund_totals(refunds),
            "dws_refunded_orders": bitmaps.refunded_orders(
                refunds, self._numbers("dim_refunded_order_number")
            ),
        }

    def reports(self) -> dict[str, Callable[[], DataFrame]]:
        """Reports read the month they need; only days in that range are scanned."""
        month = 30
        orders = self.load_days("dwd", "dwd_order_info", month)
        lines = self.load_days("dwd", "dwd_order_detail", month)
        refunds = self.load_days("dwd", "dwd_order_refund", month)
        actions = self.load_days("dwd", "dwd_action", month).withColumn("is_paid", F.lit(0))
        return {
            "ads_gmv_day": lambda: bitmaps.gmv_day(
                self.load_days("dws", "dws_order_total", month),
                self.load_days("dws", "dws_order_users", month),
                self.load_days("dws", "dws_refund_total", month),
                self.load_days("dws", "dws_refunded_orders", month),
                self.dt,
            ),
            "ads_order_amounts": lambda: quantiles.amount_windows(
                self.load_days("dws", "dws_order_amounts", month), self.dt
            ),
            "ads_sku_sales_rank": lambda: ads.ads_sku_sales_rank(
                None, self.dt, daily=self.load_days("dws", "dws_sku_stats", month)
            ),
            "ads_province_sale": lambda: ads.ads_province_sale(orders, self.dt),
            "ads_category_sale_analysis": lambda: ads.ads_category_sale_analysis(
                lines, refunds, self.dt
            ),
            "ads_user_repurchase_rate": lambda: ads.ads_user_repurchase_rate(
                None, self.dt, daily=self.load_days("dws", "dws_user_day", month)
            ),
            "ads_user_activity": lambda: activity.user_activity(
                self.load("dws", "dws_user_action_days"), self.dt
            ),
            "ads_conversion_rate": lambda: ads.ads_conversion_rate(
                self._paid_actions(actions, orders), self.dt
            ),
            "ads_gmv_trend": lambda: ads.ads_gmv_trend(
                read_table(self.spark, self.path("dwd", "dwd_order_info")).where(
                    F.col("dt").isin(self.dt, shift(self.dt, -1), last_year(self.dt))
                ),
                self.dt,
            ),
            "ads_user_retention": lambda: activity.user_retention(
                self.load("dws", "dws_user_order_days"), self.dt
            ),
            "ads_user_retention_detail": lambda: activity.user_retention_detail(
                self.load("dws", "dws_user_order_days"), self.dt
            ),
            "ads_hot_sku": lambda: ads.ads_hot_sku(lines),
            "ads_gmv_province": lambda: ads.ads_gmv_province(orders, self.dt),
            "ads_sku_repurchase_analysis": lambda: ads.ads_sku_repurchase_analysis(
                self.load_days("dwd", "dwd_order_detail", 31),
                self.dt,
                sku_dim=self.load("dim", "dim_sku_full"),
            ),
        }

    def run_ads(self) -> None:
        for name, build in self.reports().items():
            self.save("ads", name, build())

    @staticmethod
    def _paid_actions(actions: DataFrame, orders: DataFrame) -> DataFrame:
        """Order actions marked paid from their order; other actions, whose target is a
        page or a SKU, are not shuffled."""
        paid = orders.select(F.col("id").alias("action_target_id"), F.col("is_paid").alias("paid"))
        is_order = F.col("action_code") == "order"
        ordered = (
            actions.where(is_order)
            .join(paid, "action_target_id", "left")
            .withColumn("is_paid", F.coalesce("paid", F.lit(0)))
            .drop("paid")
        )
        return ordered.unionByName(actions.where(~is_order))

    def check(self) -> DataFrame:
        """Row counts of the day's tables against the gate: every table needs rows, but for those of
        events that may not occur. No row of a feed may be unknown to the ledger, and every valid
        arrival of today must be a fact, whichever day it lies on."""
        tables = {name: self.load(*name.split("/")) for name in self.written}
        minimum = {name: 0 for name in MAY_BE_EMPTY}
        rows = created_on(self.raw("order_info"), self.dt)
        valid = rows.where(present(rows, "id", "user_id"))
        minimum["dwd/dwd_order_info"] = max(1, valid.select("id").distinct().count())
        for table, feeds in FACTS.items():
            arrived = 0
            for feed in feeds:
                ledger = self.ledger(feed)
                if feed in self.not_delivered and not ledger.started():
                    continue
                unseen, days, _ = ledger.unseen(self.raw(feed), "", EVENTS[feed])
                tables[f"arrivals/{feed}"] = here = self._landing(ledger.rows())
                valid = present(here, *NEEDED[feed])
                if feed == "order_detail":
                    valid = valid & (F.col("sku_num") > 0) & (F.col("order_price") >= 0)
                rows, facts = here.agg(F.count(F.lit(1)), F.count_if(valid)).first()
                minimum[f"arrivals/{feed}"] = rows + (unseen.count() if days else 0)
                arrived += facts
            late = {d for feed in feeds for d in self.late[feed]}
            stored = self._days(table, [self.dt, *late]).withColumnRenamed("arrived_on", "seen")
            tables[f"dwd/{table}"] = self._landing(stored)
            minimum[f"dwd/{table}"] = arrived
        minimum["dwd/dwd_order_detail"] = max(1, minimum["dwd/dwd_order_detail"])
        return quality.quality_gate(quality.layer_row_counts(tables), minimum)


def user_history(spark: SparkSession, root: str, biz_date: str) -> DataFrame:
    """The user zipper as of a day: its open versions, and all that were closed until then."""
    users = read_bucketed(spark, f"{root}/dim/dim_user_open", biz_date, "id")
    if users is None:
        raise MissingInput(f"dim/dim_user_open of {biz_date} is missing")
    try:
        closed = read_table(spark, f"{root}/dim/dim_user_closed", last=shift(biz_date, -1)).drop("dt")
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return users
        raise
    return users.unionByName(closed)


def run_day(
    spark: SparkSession,
    raw_root: str,
    root: str,
    biz_date: str,
    first_day: bool = False,
    not_delivered: Collection[str] = (),
    buckets: int = BUCKETS,
    max_rejected: float = MAX_REJECTED,
) -> list[str]:
    """Run every layer for one day and fail the day if a table misses rows.

    first_day starts the history; on any other day the day before must have run.
    not_delivered names raw tables that are known to be absent; any other absent one
    fails the run before anything is replaced that depends on it. buckets is the number of buckets
    of the open users, which the first day settles. A raw table of which more than the share max_rejected
    of its lines is rejected stops the run at once; damaged lines are in quarantine/raw.
    """
    run = DailyRun(spark, raw_root, root, biz_date, first_day, not_delivered, buckets, max_rejected)
    run.open_before()  # the day before has to have run
    run.run_raw()
    quality.assert_quality(run.raw_gate())
    run.run_dim()
    run.run_dwd()
    run.run_dws()
    run.run_ads()
    quality.assert_quality(run.check())
    return run.written
