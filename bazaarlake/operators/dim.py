"""Dimensions: overwrite, zipper and previous-value history, snapshots, snowflake."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from bazaarlake.functions.common import (
    OPEN_END,
    latest_per_key,
    mask_all_but_last4,
    mask_email,
    mask_phone,
    order_status_name,
    payment_way_name,
    present,
    shift,
)

# The user columns whose change opens a new zipper version.
USER_TRACKED = (
    "login_name",
    "nick_name",
    "name",
    "phone_num",
    "email",
    "user_level",
    "status",
)


def dim_user_init(users: DataFrame, biz_date: str) -> DataFrame:
    """First zipper load: every valid user gets one open version."""
    return users.where(present(users, "id")).select(
        "*", F.lit(biz_date).alias("start_date"), F.lit(OPEN_END).alias("end_date")
    )


def _differs(left: str, right: str, tracked: Sequence[str]) -> Column:
    changed = F.lit(False)
    for name in tracked:
        changed = changed | ~F.col(f"{left}.{name}").eqNullSafe(F.col(f"{right}.{name}"))
    return changed


def dim_user_zip_update(
    history: DataFrame,
    feed: DataFrame,
    biz_date: str,
    tracked: Sequence[str] | None = USER_TRACKED,
) -> DataFrame:
    """One day of zipper maintenance.

    history: the previous day's zipper (all versions); feed: today's users, one row
    per id. A changed user's open version closes the day before biz_date and a new
    one opens; a new user opens one; unchanged and absent users keep theirs. With
    tracked=None every user in the feed counts as changed. Running the same day on
    its own output changes nothing.
    """
    attributes = [c for c in history.columns if c not in ("id", "start_date", "end_date")]
    feed = feed.where(present(feed, "id")).select("id", *attributes)
    is_open = F.col("end_date") == OPEN_END

    joined = (
        history.where(is_open).alias("o").join(feed.alias("f"), F.expr("o.id = f.id"), "full_outer")
    )
    changed = F.lit(True) if tracked is None else _differs("o", "f", tracked)

    def version(side: str, start: Column, end: Column) -> Column:
        return F.struct(
            F.col(f"{side}.id").alias("id"),
            *[F.col(f"{side}.{c}").alias(c) for c in attributes],
            start.alias("start_date"),
            end.alias("end_date"),
        )

    kept = version("o", F.col("o.start_date"), F.col("o.end_date"))
    closed = version("o", F.col("o.start_date"), F.lit(shift(biz_date, -1)))
    opened = version("f", F.lit(biz_date), F.lit(OPEN_END))
    versions = (
        F.when(F.col("f.id").isNull(), F.array(kept))
        .when(F.col("o.id").isNull(), F.array(opened))
        .when(~changed, F.array(kept))
        .when(F.col("o.start_date") >= biz_date, F.array(opened))
        .otherwise(F.array(closed, opened))
    )
    current = joined.select(F.explode(versions).alias("v")).select("v.*")
    return history.where(~is_open).select(*current.columns).unionByName(current)


def dim_user_open_update(
    open_users: DataFrame, feed: DataFrame, biz_date: str, tracked: Sequence[str] | None = USER_TRACKED
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """One day of zipper maintenance where open and closed versions are stored apart: the open versions
    of users known before, those of new users, and the versions that the day closes.

    open_users: yesterday's open versions, one per id; feed: today's users, one row per id. Together
    the three hold the versions of dim_user_zip_update that are open, or closed by this day; earlier
    closed ones are neither read nor written. Both joins keep the rows of open_users where they are
    stored: nothing but the feed is shuffled if that is bucketed by id.
    """
    attributes = [c for c in open_users.columns if c not in ("id", "start_date", "end_date")]
    feed = feed.where(present(feed, "id")).select("id", *attributes)
    joined = open_users.alias("o").join(feed.alias("f"), F.expr("o.id = f.id"), "left")
    there = F.col("f.id").isNotNull()
    changed = there if tracked is None else there & _differs("o", "f", tracked)
    known = joined.select(
        F.col("o.id").alias("id"),
        *[F.when(changed, F.col(f"f.{c}")).otherwise(F.col(f"o.{c}")).alias(c) for c in attributes],
        F.when(changed, F.lit(biz_date)).otherwise(F.col("o.start_date")).alias("start_date"),
        F.lit(OPEN_END).alias("end_date"),
    )
    # A version that this day itself opened is replaced, not closed.
    closed = joined.where(changed & (F.col("o.start_date") < biz_date)).select(
        "o.id", *[F.col(f"o.{c}") for c in attributes], "o.start_date", F.lit(shift(biz_date, -1)).alias("end_date")
    )
    new = feed.join(open_users.select("id"), "id", "left_anti")
    return known, dim_user_init(new, biz_date).select(*known.columns), closed.select(*known.columns)


def masked_contacts(users: DataFrame) -> DataFrame:
    """Users with phone and email masked, as far as they have them."""
    masks = {"phone_num": mask_phone, "email": mask_email}
    return users.withColumns({c: mask(c) for c, mask in masks.items() if c in users.columns})


def dim_user_scd2(
    history: DataFrame,
    feed: DataFrame,
    biz_date: str,
    tracked: Sequence[str] | None = None,
) -> DataFrame:
    """Zipper with an is_current flag and masked contacts; by default every user in the feed
    is re-versioned."""
    versions = dim_user_zip_update(
        history.drop("is_current"), masked_contacts(feed), biz_date, tracked
    )
    return versions.withColumn("is_current", F.when(F.col("end_date") == OPEN_END, "1").otherwise("0"))


def dim_user_scd3(
    previous: DataFrame,
    feed: DataFrame,
    biz_date: str,
    tracked: Sequence[str] = ("user_level", "gender"),
) -> DataFrame:
    """Previous-value history: `<col>_last` keeps the value a tracked column had
    before its last change, version counts the changes. Contacts are masked."""
    feed = masked_contacts(feed)
    extra = {f"{c}_last" for c in tracked} | {"version", "update_time"}
    attributes = [c for c in feed.columns if c != "id"]
    both = previous.alias("a").join(feed.alias("b"), F.expr("a.id = b.id"), "full_outer")
    in_both = F.col("a.id").isNotNull() & F.col("b.id").isNotNull()

    def value_changed(name: str) -> Column:
        return (
            in_both
            & F.col(f"b.{name}").isNotNull()
            & ~F.col(f"a.{name}").eqNullSafe(F.col(f"b.{name}"))
        )

    any_changed = F.lit(False)
    for name in tracked:
        any_changed = any_changed | value_changed(name)
    columns = [F.coalesce("b.id", "a.id").alias("id")]
    for name in attributes:
        if name in extra:
            continue
        if name == "create_time":
            columns.append(F.coalesce("a.create_time", "b.create_time").alias(name))
        else:
            columns.append(F.coalesce(f"b.{name}", f"a.{name}").alias(name))
    for name in tracked:
        last = f"{name}_last"
        columns.append(
            F.when(value_changed(name), F.col(f"a.{name}")).otherwise(F.col(f"a.{last}")).alias(last)
        )
    version = F.coalesce(F.col("a.version"), F.lit(1)) + F.when(any_changed, 1).otherwise(0)
    touched = F.col("a.id").isNull() | any_changed
    columns += [
        F.when(touched, F.lit(biz_date)).otherwise(F.col("a.update_time")).alias("update_time"),
        version.cast("int").alias("version"),
    ]
    return both.select(*columns)


def dim_user_scd3_init(users: DataFrame, biz_date: str, tracked: Sequence[str]) -> DataFrame:
    """First previous-value load: version 1, no previous values."""
    types = {f.name: f.dataType for f in users.schema.fields}
    return masked_contacts(users).select(
        "*",
        *[F.lit(None).cast(types[c]).alias(f"{c}_last") for c in tracked],
        F.lit(biz_date).alias("update_time"),
        F.lit(1).alias("version"),
    )


def dim_user_snapshot(
    feeds: DataFrame, biz_date: str, order: Sequence[str] = ("dt",)
) -> DataFrame:
    """State of every user as of biz_date: the latest row with dt <= biz_date, contacts masked."""
    newest = latest_per_key(feeds.where(F.col("dt") <= biz_date), ["id"], order)
    return masked_contacts(newest).drop("dt").withColumn("snapshot_date", F.lit(biz_date))


def dim_user_scd1(feeds: DataFrame, order: Sequence[str] = ("dt",)) -> DataFrame:
    """Overwrite-latest users with contact columns masked."""
    newest = latest_per_key(feeds, ["id"], order)
    masks = {"phone_num": mask_phone, "email": mask_email, "name": mask_all_but_last4}
    return newest.select(
        *[
            masks[c](c).alias("name_masked" if c == "name" else c) if c in masks else F.col(c)
            for c in newest.columns
        ]
    )


def dim_brand(trademarks: DataFrame) -> DataFrame:
    """Brand lookup: one row per brand id."""
    return trademarks.select("tm_id", "tm_name").distinct()


def dim_category1(categories: DataFrame) -> DataFrame:
    return categories.select(
        F.col("id").alias("category1_id"), F.col("name").alias("category1_name")
    ).distinct()


def dim_category2(categories: DataFrame) -> DataFrame:
    return categories.select(
        F.col("id").alias("category2_id"), F.col("name").alias("category2_name"), "category1_id"
    ).distinct()


def dim_category3(categories: DataFrame) -> DataFrame:
    return categories.select(
        F.col("id").alias("category3_id"), F.col("name").alias("category3_name"), "category2_id"
    ).distinct()


def dim_spu(spus: DataFrame) -> DataFrame:
    """Product family lookup."""
    return spus.where(present(spus, "id")).select(
        F.col("id").alias("spu_id"), "spu_name", "tm_id", "category3_id"
    )


def dim_payment_type(orders: DataFrame) -> DataFrame:
    """Payment types seen in the orders, with their normalised names."""
    return (
        orders.select(F.col("payment_way").alias("payment_type_id"))
        .distinct()
        .select("payment_type_id", payment_way_name("payment_type_id").alias("payment_type_name"))
    )


def dim_sku_full(
    skus: DataFrame,
    brands: DataFrame,
    category3: DataFrame,
    category2: DataFrame,
    category1: DataFrame,
) -> DataFrame:
    """Snowflake flattening of the SKU; the lookups broadcast while they are small
    enough for the session's threshold and are merged by sorting beyond it."""
    categories = category3.join(category2, "category2_id", "left").join(
        category1, "category1_id", "left"
    )
    return (
        skus.withColumnRenamed("id", "sku_id")
        .join(brands, "tm_id", "left")
        .join(categories, "category3_id", "left")
    )


def dim_sku(skus: DataFrame) -> DataFrame:
    """SKU dimension of one day."""
    keep = [
        c
        for c in ("id", "spu_id", "price", "sku_name", "sku_desc", "weight", "tm_id", "category3_id", "create_time")
        if c in skus.columns
    ]
    return skus.where(present(skus, "id")).select(*keep)


def dim_province(provinces: DataFrame, regions: DataFrame) -> DataFrame:
    """Province with its region's name; both are fixed administrative lists."""
    extra = [
        c for c in ("area_code", "population", "area_km2") if c in provinces.columns
    ]
    kind = F.col("province_type") if "province_type" in provinces.columns else F.lit("ordinary")
    named = regions.select(F.col("id").alias("region_id"), "region_name")
    return provinces.join(named, "region_id", "left").select(
        "id", "name", "region_id", "region_name", kind.alias("province_type"), *extra
    )


def dim_time(days: DataFrame, holidays: DataFrame | None = None) -> DataFrame:
    """Calendar over the span of a day column: `days` has one column `day` (date).

    holidays: optional (date_id, holiday_name, is_workday) overriding the weekday
    rule, for public holidays and make-up workdays.
    """
    span = days.agg(F.min("day").alias("first"), F.max("day").alias("last"))
    calendar = span.select(F.explode(F.expr("sequence(first, last, interval 1 day)")).alias("day"))
    weekday = F.weekday("day") + 1
    month = F.month("day")
    season = (
        F.when(month.between(3, 5), "spring")
        .when(month.between(6, 8), "summer")
        .when(month.between(9, 11), "autumn")
        .otherwise("winter")
    )
    base = calendar.select(
        F.date_format("day", "yyyy-MM-dd").alias("date_id"),
        F.year("day").cast("bigint").alias("year"),
        F.quarter("day").cast("bigint").alias("quarter"),
        month.cast("bigint").alias("month"),
        F.dayofmonth("day").cast("bigint").alias("day"),
        F.weekofyear("day").cast("bigint").alias("week_of_year"),
        weekday.cast("bigint").alias("week_day"),
        (F.pmod(month - 1, F.lit(3)) + 1).cast("bigint").alias("month_of_quarter"),
        season.alias("season_name"),
        F.when(weekday <= 5, "1").otherwise("0").alias("weekday_rule"),
    )
    if holidays is None:
        return base.select(
            "*", F.col("weekday_rule").alias("is_workday"), F.lit(None).cast("string").alias("holiday_name")
        ).drop("weekday_rule")
    return (
        base.join(holidays.withColumnRenamed("is_workday", "ruled"), "date_id", "left")
        .withColumn("is_workday", F.coalesce("ruled", "weekday_rule"))
        .drop("weekday_rule", "ruled")
    )


def dim_trademark(trademarks: DataFrame) -> DataFrame:
    columns = [c for c in ("tm_id", "tm_name", "logo_url") if c in trademarks.columns]
    return trademarks.select(*columns).distinct()


def dim_activity(activities: DataFrame) -> DataFrame:
    """Campaign dimension, valid ids only."""
    return activities.where(present(activities, "id")).select(
        F.col("id").alias("activity_id"),
        "activity_name",
        "activity_type",
        "start_time",
        "end_time",
        "create_time",
    )


def dim_coupon(coupons: DataFrame) -> DataFrame:
    """Coupon dimension, valid ids only."""
    return coupons.where(present(coupons, "id")).select(
        F.col("id").alias("coupon_id"),
        "coupon_name",
        "coupon_type",
        F.col("discount_amount").alias("coupon_amount"),
        F.col("threshold_amount").alias("condition_amount"),
        "start_time",
        "end_time",
        "create_time",
    )


def order_accumulating_snapshot(
    previous: DataFrame, feed: DataFrame, biz_date: str, extra: Sequence[str] = ()
) -> DataFrame:
    """One row per order with the time each milestone was first reached.

    previous: yesterday's snapshot; feed: today's orders with order_status (code or
    name) and operate_time. A milestone is set once, by the day whose feed first
    shows its status; other attributes take the newest non-null value, create_time
    the oldest. extra names further attributes to keep.
    """
    feed = feed.where(present(feed, "id")).withColumn("status_name", order_status_name())
    both = previous.alias("a").join(feed.alias("b"), F.expr("a.order_id = b.id"), "full_outer")

    def milestone(column: str, status: str) -> Column:
        reached = F.when(F.col("b.status_name") == status, F.col("b.operate_time"))
        return F.coalesce(F.col(f"a.{column}"), reached).alias(column)

    return both.select(
        F.coalesce("b.id", "a.order_id").alias("order_id"),
        F.coalesce("b.user_id", "a.user_id").alias("user_id"),
        F.coalesce("b.total_amount", "a.total_amount").alias("total_amount"),
        F.coalesce("b.status_name", "a.order_status").alias("order_status"),
        *[F.coalesce(f"b.{c}", f"a.{c}").alias(c) for c in extra],
        F.coalesce("a.create_time", "b.create_time").alias("create_time"),
        milestone("pay_time", "PAID"),
        milestone("ship_time", "SHIPPED"),
        milestone("finish_time", "COMPLETED"),
        milestone("refund_time", "REFUNDED"),
        F.lit(biz_date).alias("snapshot_date"),
    )


def empty_order_snapshot(
    spark: SparkSession, feed: DataFrame, extra: Sequence[str] = ()
) -> DataFrame:
    """Snapshot before the first day, typed after the feed."""
    fields = {f.name: f.dataType.simpleString() for f in feed.schema.fields}
    time = fields["operate_time"]
    return spark.createDataFrame(
        [],
        f"order_id {fields['id']}, user_id {fields['user_id']}, total_amount {fields['total_amount']}, "
        f"order_status string, create_time {fields['create_time']}, pay_time {time}, ship_time {time}, "
        f"finish_time {time}, refund_time {time}, snapshot_date string"
        + "".join(f", {c} {fields[c]}" for c in extra),
    )
