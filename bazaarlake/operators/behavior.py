"""Clickstream: cleaning of raw log lines and the analyses on the cleaned rows.

A raw line is `time,user,ip,action,product`. Lines come with a unique, increasing
line_id, which orders rows of equal time.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bazaarlake.functions.common import count_if, pct
from bazaarlake.functions.sequences import with_next_two, with_position

# Field count, accepted date prefix, fill words, the share of lines
# that must survive cleaning, and the burst threshold per user and hour.
FIELDS = ("event_time", "user", "ip", "action", "product")
DATE_PREFIX = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}"
FILL_FIELD = "unknown"
FILL_PRODUCT = "unknown_product"
MIN_RETENTION = 95.0
BURST_THRESHOLD = 3

TIME_FORMAT = "yyyy-MM-dd HH:mm:ss"
REPAIRABLE_FORMATS = ("M/d/yyyy[ H:m[:s]]", "yyyy-M-d[ H:m[:s]]")
STRICT, REPAIR, FILL = 0, 1, 2


def parse_lines(lines: DataFrame) -> DataFrame:
    """line_id, line → the parts of the line and what each cleaning strategy needs."""
    # Exploding one array splits each line once: as a plain column the split would be
    # repeated in every condition that uses a part of it.
    split = lines.withColumn("parts", F.explode(F.array(F.split("line", ",", -1))))
    first = F.get("parts", 0)
    date_ok = first.rlike(DATE_PREFIX)
    repaired = F.coalesce(*[F.try_to_timestamp(first, F.lit(f)) for f in REPAIRABLE_FORMATS])
    return split.select(
        "line_id",
        "line",
        "parts",
        date_ok.alias("date_ok"),
        F.when(~date_ok, F.date_format(repaired, TIME_FORMAT)).alias("repaired"),
    )


def _reject_reason(date_accepted: Column) -> Column:
    """First failing check: field count, date, product; NULL for a valid line."""
    return (
        F.when(F.size("parts") != len(FIELDS), F.lit("field_count"))
        .when(~date_accepted, F.lit("date_format"))
        .when(F.get("parts", len(FIELDS) - 1) == "", F.lit("empty_product"))
    )


def _strict_reason() -> Column:
    return _reject_reason(F.col("date_ok"))


def _repair_reason() -> Column:
    return _reject_reason(F.col("date_ok") | F.col("repaired").isNotNull())


def _fields(time: Column, rest: list[Column]) -> list[Column]:
    return [time.alias(FIELDS[0]), *[c.alias(n) for c, n in zip(rest, FIELDS[1:], strict=True)]]


def _plain_rest() -> list[Column]:
    return [F.get("parts", i) for i in range(1, len(FIELDS))]


def log_clean_strict(lines: DataFrame) -> DataFrame:
    """Every line with its fields and its reject reason (NULL = valid)."""
    return parse_lines(lines).select(
        "line_id", "line", *_fields(F.get("parts", 0), _plain_rest()), _strict_reason().alias("reason")
    )


def log_clean_repair(lines: DataFrame) -> DataFrame:
    """As strict, but a date in another known notation is rewritten."""
    time = F.when(F.col("date_ok"), F.get("parts", 0)).otherwise(F.col("repaired"))
    return parse_lines(lines).select(
        "line_id", "line", *_fields(time, _plain_rest()), _repair_reason().alias("reason")
    )


def log_clean_fill(lines: DataFrame, run_ts: str) -> DataFrame:
    """Nothing is dropped: missing fields, unreadable dates (→ run_ts) and empty
    products are filled in."""
    time = F.when(F.col("date_ok"), F.get("parts", 0)).otherwise(
        F.coalesce("repaired", F.lit(run_ts))
    )
    rest = [F.coalesce(F.get("parts", i), F.lit(FILL_FIELD)) for i in range(1, len(FIELDS))]
    rest[-1] = F.when(rest[-1] == "", FILL_PRODUCT).otherwise(rest[-1])
    return parse_lines(lines).select(
        "line_id", "line", *_fields(time, rest), F.lit(None).cast("string").alias("reason")
    )


def valid(cleaned: DataFrame) -> DataFrame:
    return cleaned.where(F.col("reason").isNull()).select("line_id", *FIELDS)


def quarantine(cleaned: DataFrame) -> DataFrame:
    """Rejected lines with the reason."""
    return cleaned.where(F.col("reason").isNotNull()).select("line_id", "line", "reason")


def clean_outcomes(cleaned: DataFrame) -> DataFrame:
    """Lines per outcome: 'ok' or the reject reason."""
    return cleaned.groupBy(F.coalesce("reason", F.lit("ok")).alias("outcome")).agg(
        F.count(F.lit(1)).alias("line_count")
    )


def retention_by_strategy(lines: DataFrame, minimum: float = MIN_RETENTION) -> DataFrame:
    """Kept lines and retention of the three strategies, from one pass over the
    lines, and which strategy is chosen: the first to reach `minimum`, else fill."""
    counted = parse_lines(lines).agg(
        F.count(F.lit(1)).alias("total"),
        count_if(_strict_reason().isNull()).alias("strict"),
        count_if(_repair_reason().isNull()).alias("repair"),
    )
    rate = {n: F.coalesce(pct(F.col(n), F.col("total")), F.lit(0.0)) for n in ("strict", "repair", "total")}
    chosen = (
        F.when(rate["strict"] >= minimum, STRICT).when(rate["repair"] >= minimum, REPAIR).otherwise(FILL)
    )
    rows = [
        F.struct(
            F.lit(i).cast("bigint").alias("strategy"),
            F.col(n).alias("kept_lines"),
            F.col("total").alias("total_lines"),
            rate[n].alias("retention_rate"),
            (chosen == i).alias("chosen"),
        )
        for i, n in ((STRICT, "strict"), (REPAIR, "repair"), (FILL, "total"))
    ]
    return counted.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def clean_adaptive(
    lines: DataFrame, run_ts: str, minimum: float = MIN_RETENTION
) -> tuple[DataFrame, int]:
    """Cleaned lines under the mildest strategy that keeps enough of them, and which
    one that is. Only the one chosen row reaches the driver."""
    strategy = retention_by_strategy(lines, minimum).where("chosen").first()["strategy"]
    if strategy == STRICT:
        return log_clean_strict(lines), strategy
    if strategy == REPAIR:
        return log_clean_repair(lines), strategy
    return log_clean_fill(lines, run_ts), strategy


def log_basic_stats(events: DataFrame) -> DataFrame:
    """Distinct users, distinct products, actions. Counted per (user, product) first,
    so that the two distinct counts copy pairs and not events."""
    pairs = events.groupBy("user", "product").agg(F.count(F.lit(1)).alias("n"))
    return pairs.agg(
        F.count_distinct("user").alias("total_users"),
        F.count_distinct("product").alias("total_products"),
        F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("total_actions"),
    )


def _top(events: DataFrame, column: str, n: int | None = None) -> DataFrame:
    """Counts by value, most first, equal counts by value descending."""
    counted = events.groupBy(column).agg(F.count(F.lit(1)).alias("event_count"))
    ordered = counted.orderBy(F.col("event_count").desc(), F.col(column).desc())
    return ordered if n is None else ordered.limit(n)


def action_type_stats(events: DataFrame) -> DataFrame:
    return _top(events, "action")


def top_products(events: DataFrame, n: int = 5) -> DataFrame:
    return _top(events, "product", n)


def suspicious_ips(events: DataFrame, n: int = 5) -> DataFrame:
    return _top(events, "ip", n)


def hourly_activity(events: DataFrame) -> DataFrame:
    """All 24 hours with their events, 0 where none, and whether the hour is the
    busiest; among equally busy hours the latest."""
    hour = F.coalesce(F.substring("event_time", 12, 2).try_cast("int"), F.lit(0))
    counted = events.groupBy(hour.alias("hour")).agg(F.count(F.lit(1)).alias("n"))
    hours = events.sparkSession.range(24).withColumnRenamed("id", "hour")
    filled = hours.join(counted, "hour", "left").select(
        F.col("hour").cast("bigint").alias("hour"), F.coalesce("n", F.lit(0)).alias("event_count")
    )
    # 24 rows: the two aggregates below are over a fixed list.
    busiest = filled.agg(F.max(F.struct("event_count", "hour")).alias("top"))
    top = busiest.select(F.col("top.hour").alias("hour"), F.lit(True).alias("is_peak"))
    return filled.join(top, "hour", "left").select(
        "hour", "event_count", F.coalesce("is_peak", F.lit(False)).alias("is_peak")
    )


# The action names of the funnel.
VIEW, CART, PURCHASE = "view_product", "add_to_cart", "purchase"


def category_conversion(
    events: DataFrame, products: DataFrame, view: str = VIEW, cart: str = CART, purchase: str = PURCHASE
) -> DataFrame:
    """Category: views, cart adds, purchases and purchases per view; products
    missing from the lookup and categories never viewed are left out.

    Events are counted per product first, so the lookup joins products.
    """
    action = F.col("action")
    per_product = events.groupBy("product").agg(
        count_if(action == view).alias("views"),
        count_if(action == cart).alias("carts"),
        count_if(action == purchase).alias("purchases"),
    )
    return (
        per_product.join(products.select("product", "category"), "product")
        .groupBy("category")
        .agg(*[F.sum(c).alias(c) for c in ("views", "carts", "purchases")])
        .where(F.col("views") > 0)
        .select("*", pct(F.col("purchases"), F.col("views")).alias("view_to_purchase_rate"))
    )


SEPARATOR = " -> "
PATH_PART = 1000


# Rows of one user and second are sliced further by blocks of 2^20 line ids.
TIE_BITS = 20


def _steps(events: DataFrame) -> DataFrame:
    """user, action and the slice columns day, event_time, block: a slice holds at most 2^20
    rows of a user, however many carry the same time (as filled-in times do), a day at most
    86,400 times, and a user one row per day."""
    block = F.shiftright("line_id", TIE_BITS).alias("block")
    day = F.substring("event_time", 1, 10).alias("day")
    return events.select("user", day, "event_time", block, "line_id", "action")


SLICES, WITHIN = ["day", "event_time", "block"], ["line_id"]


def user_paths(events: DataFrame, part_size: int = PATH_PART) -> DataFrame:
    """Each user's actions in time order as text. A path longer than part_size
    actions continues in the next part, so nothing is cut and no row is unbounded."""
    placed = with_position(_steps(events), "user", SLICES, WITHIN, "action", "position")
    steps = F.sort_array(F.collect_list(F.struct("position", "action")))
    return (
        placed.groupBy("user", F.floor((F.col("position") - 1) / part_size).alias("part"))
        .agg(steps.alias("steps"))
        .select(
            "user",
            F.col("part").cast("bigint").alias("part"),
            F.size("steps").cast("bigint").alias("action_count"),
            F.array_join(F.col("steps.action"), SEPARATOR).alias("path"),
        )
    )


def common_trigrams(events: DataFrame, n: int = 5) -> DataFrame:
    """The n most frequent runs of three successive actions of a user; equal counts
    by path descending."""
    followed = with_next_two(_steps(events), "user", SLICES, WITHIN, "action")
    path = F.concat_ws(SEPARATOR, "action", "next_1", "next_2")
    counted = followed.groupBy(path.alias("path")).agg(F.count(F.lit(1)).alias("path_count"))
    return counted.orderBy(F.col("path_count").desc(), F.col("path").desc()).limit(n)


def burst_users(events: DataFrame, threshold: int = BURST_THRESHOLD) -> DataFrame:
    """(user, hour) with at least `threshold` events."""
    return (
        events.groupBy("user", F.substring("event_time", 1, 13).alias("hour"))
        .agg(F.count(F.lit(1)).alias("event_count"))
        .where(F.col("event_count") >= threshold)
    )


def data_range(events: DataFrame) -> DataFrame:
    """First and last day of the log."""
    day = F.substring("event_time", 1, 10)
    return events.agg(F.min(day).alias("first_day"), F.max(day).alias("last_day"))
