"""Business-date arithmetic, null-safe ratios, windows and cleaning helpers."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

OPEN_END = "9999-12-31"
RECENT_DAYS = (1, 7, 30)
MONEY = T.DecimalType(16, 2)

# Order status codes, payment way codes, the statuses that count
# as paid, and the label for anything unmapped.
ORDER_STATUS = {
    "1001": "UNPAID",
    "1002": "PAID",
    "1003": "SHIPPED",
    "1004": "COMPLETED",
    "1005": "CLOSED",
    "1006": "REFUNDED",
}
PAYMENT_WAY = {"1": "ONLINE", "2": "OFFLINE", "3": "COUPON"}
PAID_STATUSES = ("PAID", "SHIPPED", "COMPLETED")
UNKNOWN = "UNKNOWN"


def shift(biz_date: str, days: int) -> str:
    """ISO date `days` after (or before, if negative) an ISO date."""
    return (date.fromisoformat(biz_date) + timedelta(days=days)).isoformat()


def last_year(biz_date: str) -> str:
    """Same calendar day one year earlier; 29 February becomes 28 February."""
    day = date.fromisoformat(biz_date)
    try:
        return day.replace(year=day.year - 1).isoformat()
    except ValueError:
        return day.replace(year=day.year - 1, day=28).isoformat()


def date_id(time_col: str | Column) -> Column:
    """Event time (timestamp or text) to the yyyy-MM-dd string used as day key."""
    return F.date_format(time_col, "yyyy-MM-dd")


def in_recent_days(time_col: str, biz_date: str, days: int) -> Column:
    """Rows of the `days` days ending at biz_date, as a half-open range on the raw
    column so that it reaches the scan."""
    column = F.col(time_col)
    return (column >= F.lit(shift(biz_date, 1 - days))) & (column < F.lit(shift(biz_date, 1)))


def on_days(time_col: str, days: Sequence[str]) -> Column:
    """Rows of the given days, as half-open ranges on the raw column."""
    column = F.col(time_col)
    chosen = F.lit(False)
    for day in days:
        chosen = chosen | ((column >= F.lit(day)) & (column < F.lit(shift(day, 1))))
    return chosen


def expand_recent_days(
    df: DataFrame, day_col: str, biz_date: str, days: Sequence[int] = RECENT_DAYS
) -> DataFrame:
    """Tag each row with every recent_days window it falls in: one scan for all
    windows. `day_col` is a yyyy-MM-dd string."""
    inside = df.where(F.col(day_col).between(shift(biz_date, 1 - max(days)), biz_date))
    tags = [F.when(F.col(day_col) >= shift(biz_date, 1 - k), F.lit(k)) for k in days]
    return inside.withColumn("recent_days", F.explode(F.array_compact(F.array(*tags))))


# Ratios are taken in decimals: a double quotient can miss an exact half, and the
# rounding then loses a cent. Four decimals hold money and counts alike.
_RATIO = T.DecimalType(24, 4)


def divide(numerator: Column, denominator: Column, scale: int = 2) -> Column:
    """numerator / denominator rounded half up; NULL when the base is 0 or NULL."""
    quotient = F.try_divide(numerator.cast(_RATIO), denominator.cast(_RATIO))
    return F.round(quotient, scale).cast("double")


def pct(numerator: Column, denominator: Column) -> Column:
    """Percentage with two decimals; NULL when the base is 0 or NULL."""
    return divide(numerator * 100, denominator)


def growth(current: Column, base: Column) -> Column:
    """Percentage change against a base; NULL when there is no positive base."""
    return F.when(base > 0, pct(current - base, base))


def money_sum(column: str | Column) -> Column:
    """Exact decimal sum, 0 for no rows. A column's name or an expression."""
    if isinstance(column, str):
        return F.expr(f"coalesce(sum({column}), cast(0 AS decimal(16,2)))")
    return F.coalesce(F.sum(column), F.lit(0).cast(MONEY))


def sum_if(condition: str | Column, value: str | Column) -> Column:
    if isinstance(condition, str):
        return money_sum(f"CASE WHEN {condition} THEN {value} END")
    return money_sum(F.when(condition, value))


def count_if(condition: str | Column) -> Column:
    if isinstance(condition, str):
        return F.expr(f"count(CASE WHEN {condition} THEN 1 END)")
    return F.count(F.when(condition, F.lit(1)))


def present(df: DataFrame, *names: str) -> Column:
    """All named columns are non-null and, where textual, non-empty."""
    check = F.lit(True)
    for name in names:
        check = check & F.col(name).isNotNull()
        if isinstance(df.schema[name].dataType, T.StringType):
            check = check & (F.col(name) != "")
    return check


def null_text_to_null(df: DataFrame, marker: str = "NULL") -> DataFrame:
    """Turn the word a text export prints for NULL back into NULL."""
    return df.select(
        *[
            F.nullif(F.col(f.name), F.lit(marker)).alias(f.name)
            if isinstance(f.dataType, T.StringType)
            else F.col(f.name)
            for f in df.schema.fields
        ]
    )


def _normalise(column: str, names: dict[str, str]) -> Column:
    """Accept a code, or a name in any case; everything else is UNKNOWN."""
    lookup = {**names, **{name: name for name in names.values()}}
    mapping = ", ".join(f"'{key}', '{name}'" for key, name in lookup.items())
    key = f"upper(trim(cast({column} AS string)))"
    return F.expr(f"coalesce(try_element_at(map({mapping}), {key}), '{UNKNOWN}')")


def order_status_name(column: str = "order_status") -> Column:
    return _normalise(column, ORDER_STATUS)


def payment_way_name(column: str = "payment_way") -> Column:
    return _normalise(column, PAYMENT_WAY)


def is_paid(status_name: str | Column) -> Column:
    column = F.col(status_name) if isinstance(status_name, str) else status_name
    return column.isin(*PAID_STATUSES)


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key, the last by `order`. An aggregate rather than a ranked
    window, so a key with very many versions is reduced before the shuffle."""
    rest = [c for c in df.columns if c not in keys]
    newest = F.max_by(F.struct(*rest), F.struct(*order)).alias("newest")
    return df.groupBy(*keys).agg(newest).select(*keys, "newest.*").select(*df.columns)


def mask_all_but_last4(column: str | Column) -> Column:
    return F.regexp_replace(column, r".(?=.{4})", "*")


def mask_phone(column: str | Column) -> Column:
    """Keep the first three and the last four characters."""
    return F.regexp_replace(column, r"(?<=^.{3}).*(?=.{4}$)", "****")


def mask_email(column: str | Column) -> Column:
    """Keep the first character of the mailbox and the whole domain."""
    return F.regexp_replace(column, r"(?<=^.)[^@]*(?=@)", "***")
