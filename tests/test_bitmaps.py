"""Distinct counts over windows from daily bitmaps, against the rows themselves."""

import random

import pytest
from pyspark.sql import functions as F

from bazaarlake.functions.common import shift
from bazaarlake.operators import ads, bitmaps

START = "2024-01-01"
ORDER = ("id string, user_id string, total_amount decimal(16,2), goods_amount decimal(16,2), feight_fee decimal(16,2), "
         "benefit_reduce_amount decimal(16,2), order_status_name string, is_paid int, date_id string, province_id string")


def orders(spark, n=400, days=35, seed=3):
    rng = random.Random(seed)
    names = ("UNPAID", "PAID", "COMPLETED")
    made = []
    for i in range(n):
        status = rng.choice(names)
        user = "hot" if i % 3 == 0 else f"u{rng.randrange(60)}"
        made.append((f"o{i}", user, str(rng.randrange(1, 9999) / 100), status, int(status != "UNPAID"), shift(START, rng.randrange(days)),
                     rng.choice(("p1", "p2", None))))
    frame = spark.createDataFrame(made, "id string, user_id string, a string, order_status_name string, is_paid int, date_id string, province_id string")
    money = F.col("a").cast("decimal(16,2)")
    return frame.select("id", "user_id", money.alias("total_amount"), money.alias("goods_amount"), F.lit(0).cast("decimal(16,2)").alias("feight_fee"),
                        F.lit(1).cast("decimal(16,2)").alias("benefit_reduce_amount"), "order_status_name", "is_paid", "date_id", "province_id")


def refunds(spark, n=150, days=35, seed=4):
    rng = random.Random(seed)
    return spark.createDataFrame([(f"o{rng.randrange(50)}", shift(START, rng.randrange(days)), i) for i in range(n)],
                                 "order_id string, date_id string, refund_amount int").withColumn("refund_amount", F.col("refund_amount").cast("decimal(16,2)"))


def numbers_by_day(spark, rows_, key):
    """Numbers given in three steps, as the daily run gives them day by day."""
    known = None
    for first, last in ((0, 4), (5, 20), (21, 99)):
        new = bitmaps.new_numbers(known, rows_.where(F.col("date_id").between(shift(START, first), shift(START, last))), key)
        new = spark.createDataFrame(new.collect(), new.schema)
        known = new if known is None else spark.createDataFrame([*known.collect(), *new.collect()], new.schema)
    return known


def report(spark, o, r, day):
    users, back = numbers_by_day(spark, o, "user_id"), numbers_by_day(spark, r, "order_id")
    return bitmaps.gmv_day(bitmaps.order_totals(o), bitmaps.order_users(o, users), bitmaps.refund_totals(r), bitmaps.refunded_orders(r, back), day)


def test_numbers_are_dense_and_stay(spark, rows):
    o = orders(spark)
    numbers = numbers_by_day(spark, o, "user_id")
    users = {r[0] for r in o.select("user_id").distinct().collect()}
    assert {r["user_id"] for r in numbers.collect()} == users
    assert sorted(r["number"] for r in numbers.collect()) == list(range(len(users)))
    assert bitmaps.new_numbers(numbers, o, "user_id").count() == 0
    more = bitmaps.new_numbers(numbers, spark.createDataFrame([("x",), (None,), ("x",), ("hot",)], "user_id string"), "user_id")
    assert rows(more) == [("x", len(users))]


@pytest.mark.parametrize("day", [34, 0])
def test_report_equals_the_one_from_orders(spark, rows, day):
    o, r, last = orders(spark), refunds(spark), shift(START, day)
    want = ads.ads_gmv_day(o, last, r)
    got = report(spark, o, r, last)
    assert got.columns == want.columns
    assert rows(got) == rows(want) and len(rows(want)) == 3


def test_windows_without_orders_or_refunds(spark, rows):
    o, r, late = orders(spark, days=3), refunds(spark), shift(START, 12)
    none = r.limit(0)
    assert rows(report(spark, o, none, late)) == rows(ads.ads_gmv_day(o, late, none)) and report(spark, o, none, late).count() == 1
    assert report(spark, o.limit(0), r, late).count() == 0


def test_sets_by_group_across_buckets(spark, rows):
    """Numbers beyond one bitmap, a null group, null keys, a key in two groups and on two days."""
    n = 70_000
    seen = spark.range(n).select(F.concat(F.lit("k"), "id").alias("k"), F.when(F.col("id") % 3 > 0, F.col("id") % 3).alias("g"),
                                 F.lit(START).alias("date_id"))
    again = spark.createDataFrame([("k0", 1, shift(START, 1)), ("k1", 1, shift(START, 1)), (None, 1, START)], "k string, g long, date_id string")
    rows_ = seen.unionByName(again)
    numbers = bitmaps.new_numbers(None, rows_, "k")
    sets = bitmaps.daily_sets(rows_, numbers, "k", {"s": F.lit(True)}, ["g"])
    last = shift(START, 1)
    got = {(r["recent_days"], r["g"]): r["s"] for r in bitmaps.distinct_in_windows(sets, ["s"], last, ["g"], (1, 2)).collect()}
    third = n // 3
    assert got == {(1, None): 0, (1, 1): 2, (1, 2): 0, (2, None): third + 1, (2, 1): third + 1, (2, 2): third}
    assert rows(bitmaps.distinct_in_windows(sets, ["s"], last, (), (1, 2))) == [(1, 2), (2, n)]


def test_a_key_without_number_stops(spark):
    o = orders(spark, n=5)
    numbers = bitmaps.new_numbers(None, o.limit(0), "user_id")
    with pytest.raises(Exception, match="has no number"):
        bitmaps.order_users(o, numbers).collect()


def test_repurchase_from_the_daily_table(spark, rows):
    from bazaarlake.operators import dws

    o, last = orders(spark), shift(START, 34)
    assert rows(ads.ads_user_repurchase_rate(None, last, daily=dws.dws_user_day(o))) == rows(ads.ads_user_repurchase_rate(o, last))
