import random

from bazaarlake.operators import dim
from pyspark.sql import functions as F

USER = "id string, login_name string, nick_name string, name string, phone_num string, email string, user_level string, status string"


def users(spark, *rows):
    full = [(i, "l", "n", name, "1", email, level, "1") for i, name, email, level in rows]
    return spark.createDataFrame(full, USER)


def test_init_drops_missing_ids(spark, rows):
    got = dim.dim_user_init(users(spark, ("1", "a", "e", "1"), (None, "b", "e", "1"), ("", "c", "e", "1")), "2024-01-01")
    assert rows(got, "id", "start_date", "end_date") == [("1", "2024-01-01", "9999-12-31")]


def test_zipper_unchanged_changed_new_absent_and_null(spark, rows):
    first = dim.dim_user_init(
        users(spark, ("same", "a", "e", "1"), ("chg", "a", "e", "1"), ("gone", "a", "e", "1"), ("null", "a", None, "1")),
        "2024-01-01",
    )
    feed = users(
        spark, ("same", "a", "e", "1"), ("chg", "a", "e", "2"), ("new", "a", "e", "1"), ("null", "a", "x", "1")
    )
    got = dim.dim_user_zip_update(first, feed, "2024-01-02")
    assert rows(got, "id", "user_level", "email", "start_date", "end_date") == [
        ("chg", "1", "e", "2024-01-01", "2024-01-01"),
        ("chg", "2", "e", "2024-01-02", "9999-12-31"),
        ("gone", "1", "e", "2024-01-01", "9999-12-31"),
        ("new", "1", "e", "2024-01-02", "9999-12-31"),
        ("null", "1", "x", "2024-01-02", "9999-12-31"),
        ("null", "1", None, "2024-01-01", "2024-01-01"),
        ("same", "1", "e", "2024-01-01", "9999-12-31"),
    ]


def test_zipper_sees_values_whose_concatenation_collides(spark, rows):
    first = dim.dim_user_init(users(spark, ("1", "ab", "c", "1")), "2024-01-01")
    got = dim.dim_user_zip_update(first, users(spark, ("1", "a", "bc", "1")), "2024-01-02")
    assert len(rows(got)) == 2


def test_zipper_rerun_of_a_day_changes_nothing(spark, rows):
    first = dim.dim_user_init(users(spark, ("1", "a", "e", "1"), ("2", "a", "e", "1")), "2024-01-01")
    feed = users(spark, ("1", "a", "e", "2"), ("3", "a", "e", "1"))
    once = dim.dim_user_zip_update(first, feed, "2024-01-02")
    assert rows(dim.dim_user_zip_update(once, feed, "2024-01-02")) == rows(once)


def test_zipper_intervals_never_overlap(spark):
    rng = random.Random(3)
    history = None
    for day in range(1, 6):
        feed = users(
            spark, *[(str(i), "a", "e", str(rng.randint(1, 2))) for i in range(12) if rng.random() < 0.7]
        )
        dt = f"2024-01-0{day}"
        history = dim.dim_user_init(feed, dt) if history is None else dim.dim_user_zip_update(history, feed, dt)
    versions = {}
    for r in history.collect():
        versions.setdefault(r["id"], []).append((r["start_date"], r["end_date"]))
    for spans in versions.values():
        spans.sort()
        assert sum(end == "9999-12-31" for _, end in spans) == 1
        assert all(a[1] < b[0] for a, b in zip(spans, spans[1:]))
        assert all(start <= end for start, end in spans)


def test_scd2_reopens_every_fed_user(spark, rows):
    first = dim.dim_user_scd2(dim.dim_user_init(users(spark), "2024-01-01"), users(spark, ("1", "a", "e", "1"), ("2", "a", "e", "1")), "2024-01-01")
    got = dim.dim_user_scd2(first, users(spark, ("1", "a", "e", "1")), "2024-01-02")
    assert rows(got, "id", "start_date", "end_date", "is_current") == [
        ("1", "2024-01-01", "2024-01-01", "0"),
        ("1", "2024-01-02", "9999-12-31", "1"),
        ("2", "2024-01-01", "9999-12-31", "1"),
    ]


def test_scd3_two_changes_null_to_value_and_unchanged(spark, rows):
    schema = "id string, user_level string, gender string"
    tracked = ("user_level", "gender")
    day1 = spark.createDataFrame([("1", "A", "M"), ("2", None, "F"), ("3", "A", "F")], schema)
    state = dim.dim_user_scd3_init(day1, "d1", tracked)
    for day, level in (("d2", "B"), ("d3", "C")):
        feed = spark.createDataFrame([("1", level, "M"), ("2", "X", "F"), ("4", "N", None)], schema)
        state = dim.dim_user_scd3(state, feed, day, tracked)
    assert rows(state, "id", "user_level", "user_level_last", "gender_last", "version", "update_time") == [
        ("1", "C", "B", None, 3, "d3"),
        ("2", "X", None, None, 2, "d2"),
        ("3", "A", None, None, 1, "d1"),
        ("4", "N", None, None, 1, "d2"),
    ]


def test_snapshot_takes_the_latest_row_as_of_the_day(spark, rows):
    feeds = spark.createDataFrame(
        [("1", "A", "2024-01-01"), ("1", "B", "2024-01-02"), ("1", "C", "2024-01-03"), ("2", "A", "2024-01-01")],
        "id string, user_level string, dt string",
    )
    got = dim.dim_user_snapshot(feeds, "2024-01-02")
    assert rows(got) == [("1", "B", "2024-01-02"), ("2", "A", "2024-01-02")]


def test_scd1_masks_contact_columns(spark, rows):
    feeds = spark.createDataFrame(
        [("1", "Catherine", "13812345678", "cat@example.org", "d1")],
        "id string, name string, phone_num string, email string, dt string",
    )
    got = dim.dim_user_scd1(feeds).drop("dt")
    assert rows(got) == [("1", "*****rine", "138****5678", "c***@example.org")]


def test_accumulating_snapshot_sets_each_milestone_once(spark, rows):
    schema = "id string, user_id string, total_amount decimal(16,2), order_status string, create_time string, operate_time string"

    def feed(*items):
        return spark.createDataFrame([(i, "u", None, s, "c", t) for i, s, t in items], schema)

    days = [
        ("d1", feed(("1", "1001", "t1"), ("2", "1001", "t1"))),
        ("d2", feed(("1", "paid", "t2"))),
        ("d3", feed(("1", "1002", "t3"), ("2", "SHIPPED", "t3"))),
        ("d4", feed(("1", "1004", "t4"), ("2", "1006", "t4"))),
    ]
    state = dim.empty_order_snapshot(spark, days[0][1])
    for day, items in days:
        state = dim.order_accumulating_snapshot(state, items, day)
    assert rows(state, "order_id", "order_status", "create_time", "pay_time", "ship_time", "finish_time", "refund_time") == [
        ("1", "COMPLETED", "c", "t2", None, "t4", None),
        ("2", "REFUNDED", "c", None, "t3", None, "t4"),
    ]


def test_province_and_calendar(spark, rows):
    provinces = spark.createDataFrame([("1", "P", "9"), ("2", "Q", "8")], "id string, name string, region_id string")
    regions = spark.createDataFrame([("9", "North")], "id string, region_name string")
    assert rows(dim.dim_province(provinces, regions), "id", "region_name") == [("1", "North"), ("2", None)]
    days = spark.sql("SELECT date'2024-02-28' AS day UNION ALL SELECT date'2024-03-03'")
    holidays = spark.createDataFrame([("2024-03-02", "make-up", "1")], "date_id string, holiday_name string, is_workday string")
    got = rows(dim.dim_time(days, holidays), "date_id", "is_workday", "holiday_name", "month_of_quarter")
    assert got == [
        ("2024-02-28", "1", None, 2),
        ("2024-02-29", "1", None, 2),
        ("2024-03-01", "1", None, 3),
        ("2024-03-02", "1", "make-up", 3),
        ("2024-03-03", "0", None, 3),
    ]


def test_sku_full_keeps_a_sku_with_no_lookup_match(spark, rows):
    skus = spark.createDataFrame([("1", "a", "t1", "c31"), ("2", "b", "tx", "cx")], "id string, sku_name string, tm_id string, category3_id string")
    brands = spark.createDataFrame([("t1", "Brand")], "tm_id string, tm_name string")
    c3 = spark.createDataFrame([("c31", "C3", "c21")], "category3_id string, category3_name string, category2_id string")
    c2 = spark.createDataFrame([("c21", "C2", "c11")], "category2_id string, category2_name string, category1_id string")
    c1 = spark.createDataFrame([("c11", "C1")], "category1_id string, category1_name string")
    got = dim.dim_sku_full(skus, brands, c3, c2, c1)
    assert rows(got, "sku_id", "tm_name", "category1_name") == [("1", "Brand", "C1"), ("2", None, None)]


def test_histories_hold_masked_contacts(spark, rows):
    schema = "id string, phone_num string, email string, user_level string, dt string"
    feed = spark.createDataFrame([("u", "13812345678", "someone@x.org", "1", "2024-01-01"), ("v", None, None, "1", "2024-01-01")], schema)
    masked = [("u", "138****5678", "s***@x.org"), ("v", None, None)]
    columns = ("id", "phone_num", "email")
    assert rows(dim.dim_user_snapshot(feed, "2024-01-02"), *columns) == masked
    users = feed.drop("dt")
    third = dim.dim_user_scd3_init(users, "2024-01-01", ("user_level",))
    assert rows(third, *columns) == masked
    changed = users.withColumn("user_level", F.lit("2"))
    later = dim.dim_user_scd3(third, changed, "2024-01-02", ("user_level",))
    assert rows(later, *columns) == masked and rows(later, "user_level_last") == [("1",), ("1",)]
    history = dim.dim_user_init(dim.masked_contacts(users), "2024-01-01")
    assert set(rows(dim.dim_user_scd2(history, changed, "2024-01-02"), *columns)) == set(masked)
