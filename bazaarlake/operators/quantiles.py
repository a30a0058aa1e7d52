"""Exact quartiles of order amounts over any window, out of stored daily counts.

A day keeps how often each amount occurs; counts of several days add up, so a window is summed from
its days' rows and no order is read. A KLL sketch over the window's distinct amounts cuts them
into buckets of about equal size. It only decides how the work is dealt out: ranks are counted exactly,
first over buckets, then inside the few that hold a rank looked for.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bazaarlake.functions.common import RECENT_DAYS, expand_recent_days
from bazaarlake.operators.batch import QUARTILES

BUCKETS = 256


def daily_amounts(orders: DataFrame) -> DataFrame:
    """date_id, amount, n: orders of the day by total_amount, those without an amount left out."""
    known = orders.where(F.col("total_amount").isNotNull())
    return known.groupBy("date_id", F.col("total_amount").alias("amount")).agg(F.count(F.lit(1)).alias("n"))


def _bounds(amounts: DataFrame, buckets: int) -> Column:
    """Amounts that cut the distinct amounts into about equal buckets, as a scalar subquery; none
    where there are no amounts."""
    ranks = F.array(*[F.lit(i / buckets) for i in range(1, buckets)])
    sketch = amounts.agg(F.kll_sketch_agg_double(F.col("amount").cast("double")).alias("s"), F.count("amount").alias("c"))
    return sketch.select(F.when(F.col("c") > 0, F.kll_sketch_get_quantile_double("s", ranks))).scalar()


def amount_windows(
    daily: DataFrame,
    biz_date: str,
    days: Sequence[int] = RECENT_DAYS,
    quantiles: Mapping[str, float] = QUARTILES,
    buckets: int = BUCKETS,
) -> DataFrame:
    """recent_days: orders with an amount, least and largest amount, and quantiles with linear
    interpolation, rounded half up to cents. Windows without orders have no row.

    A task sees one bucket of a window, or a row per bucket. Equal amounts are one row, whatever their
    count. buckets changes how many rows meet, never a result.
    """
    counted = (
        expand_recent_days(daily.select("date_id", "amount", "n"), "date_id", biz_date, days)
        .groupBy("recent_days", "amount")
        .agg(F.sum("n").alias("n"))
    )
    inside = daily.where(F.col("amount").isNotNull())
    bounds = _bounds(inside.select("amount").distinct(), buckets)
    value = F.col("amount").cast("double")
    # The number of bounds below an amount grows with the amount, whatever the bounds are.
    below = F.size(F.filter("bounds", lambda b: b < value))
    placed = counted.withColumn("bounds", bounds).select("*", below.alias("bucket")).drop("bounds")
    sizes = placed.groupBy("recent_days", "bucket").agg(
        F.sum("n").alias("rows"), F.min("amount").alias("least"), F.max("amount").alias("largest")
    )
    window = Window.partitionBy("recent_days")
    earlier = window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        "recent_days",
        "bucket",
        "rows",
        F.coalesce(F.sum("rows").over(earlier), F.lit(0)).alias("before"),
        F.sum("rows").over(window).alias("total"),
        F.min("least").over(window).alias("least"),
        F.max("largest").over(window).alias("largest"),
    )

    def position(q: float) -> Column:
        return (F.col("total") - 1) * F.lit(q)

    def holds(index: Column) -> Column:
        return (F.col("before") <= index) & (index < F.col("before") + F.col("rows"))

    wanted = F.lit(False)
    for q in quantiles.values():
        wanted = wanted | holds(F.floor(position(q))) | holds(F.ceil(position(q)))
    upto = F.sum("n").over(Window.partitionBy("recent_days", "bucket").orderBy("amount")) + F.col("before")
    ranked = placed.join(offsets.where(wanted), ["recent_days", "bucket"]).withColumn("upto", upto)

    def at(index: Column) -> Column:
        return F.min(F.when(F.col("upto") > index, F.col("amount")))

    found = ranked.groupBy("recent_days").agg(
        F.max("total").alias("cnt"),
        F.min("least").cast("double").alias("min_amount"),
        F.max("largest").cast("double").alias("max_amount"),
        *[at(F.floor(position(q))).alias(f"{name}_low") for name, q in quantiles.items()],
        *[at(F.ceil(position(q))).alias(f"{name}_high") for name, q in quantiles.items()],
    )
    total = F.col("cnt") - 1

    def between(name: str, q: float) -> Column:
        low, high = F.col(f"{name}_low"), F.col(f"{name}_high")
        # In decimals: a double can miss an exact half cent.
        part = (total * F.lit(q) - F.floor(total * F.lit(q))).cast("decimal(10,6)")
        return F.round(low + (high - low) * part, 2).cast("double").alias(name)

    return found.select(
        "recent_days", "cnt", "min_amount", *[between(name, q) for name, q in quantiles.items()], "max_amount"
    )
