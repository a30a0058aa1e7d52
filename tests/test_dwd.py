from decimal import Decimal

from bazaarlake.functions.common import null_text_to_null, order_status_name, payment_way_name
from bazaarlake.operators import dwd

SKU = "sku_id string, sku_name string, tm_id string, tm_name string"


def test_order_detail_cleaning_rules(spark, rows):
    schema = "id string, order_id string, sku_id string, order_price decimal(16,2), sku_num bigint, create_time string"
    bad = [
        (None, "o", "s", "1", 1), ("", "o", "s", "1", 1), ("b1", None, "s", "1", 1), ("b2", "o", "", "1", 1),
        ("b3", "o", "s", "1", 0), ("b4", "o", "s", "1", -1), ("b5", "o", "s", "-0.01", 1),
    ]
    good = [("g1", "o", "s", "0", 1), ("g2", "o", "s", "2.50", 2), ("g3", "o", "miss", "1", 1)]
    details = spark.createDataFrame(
        [(i, o, s, Decimal(p), n, "2024-01-15 09:30") for i, o, s, p, n in bad + good], schema
    )
    dims = spark.createDataFrame([("s", "name", "t", "brand")], SKU)
    got = dwd.dwd_order_detail(details, dims)
    assert rows(got, "id", "order_amount", "tm_name") == [
        ("g1", Decimal("0.00"), "brand"), ("g2", Decimal("5.00"), "brand"), ("g3", Decimal("1.00"), None),
    ]


def test_codes_are_normalised(spark, rows):
    df = spark.createDataFrame(
        [("1001", "1"), ("1002", "2"), ("1003", "3"), ("1004", "online"), ("1005", "ALIPAY"), ("1006", None),
         ("PAID", " 1 "), ("paid", "x"), ("9", "x"), (None, "x")],
        "order_status string, payment_way string",
    )
    got = [tuple(r) for r in df.select(order_status_name(), payment_way_name()).collect()]
    assert [g[0] for g in got] == [
        "UNPAID", "PAID", "SHIPPED", "COMPLETED", "CLOSED", "REFUNDED", "PAID", "PAID", "UNKNOWN", "UNKNOWN",
    ]
    assert [g[1] for g in got[:7]] == ["ONLINE", "OFFLINE", "COUPON", "ONLINE", "UNKNOWN", "UNKNOWN", "ONLINE"]


def test_order_info_matches_one_open_version(spark, rows):
    orders = spark.createDataFrame(
        [("1", "u", "p", "1002", "1", Decimal("10"), Decimal("2"), Decimal("0"), "2024-01-15 09:30"),
         ("2", "none", "none", "1001", "9", Decimal("10"), Decimal("0"), Decimal("0"), "2024-01-15 09:30"),
         ("", "u", "p", "1002", "1", Decimal("10"), Decimal("0"), Decimal("0"), "2024-01-15 09:30")],
        "id string, user_id string, province_id string, order_status string, payment_way string, "
        "total_amount decimal(16,2), feight_fee decimal(16,2), benefit_reduce_amount decimal(16,2), create_time string",
    )
    users = spark.createDataFrame(
        [("u", "old", "M", "2024-01-10"), ("u", "new", "M", "9999-12-31")],
        "id string, user_level string, gender string, end_date string",
    )
    provinces = spark.createDataFrame([("p", "North", "r", "R")], "id string, name string, region_id string, region_name string")
    got = dwd.dwd_order_info(orders, users, provinces)
    assert rows(got, "id", "user_level", "user_gender", "province_name", "goods_amount", "is_paid", "date_id") == [
        ("1", "new", "M", "North", Decimal("8.00"), 1, "2024-01-15"),
        ("2", "UNKNOWN", "UNKNOWN", "UNKNOWN", Decimal("10.00"), 0, "2024-01-15"),
    ]


def test_action_log_unions_four_feeds(spark, rows):
    base = "user_id string, sku_id string, session_id string"
    views = spark.createDataFrame([("u", "s", "x", "p1", "2024-01-01 10:00:00"), (None, "s", "x", "p2", "2024-01-01 10:00:00")],
                                  f"{base}, page_id string, action_time string")
    favors = spark.createDataFrame([("u", "s", "x", "f1", "2024-01-01 11:00:00")], f"{base}, favor_id string, create_time string")
    carts = spark.createDataFrame([("u", "s", "x", "c1", "2024-01-02 11:00:00")], f"{base}, cart_id string, create_time string")
    orders = spark.createDataFrame([("u", "z", "x", "d1", "o1", "2024-01-02 12:00:00")],
                                   f"{base}, order_detail_id string, order_id string, create_time string")
    dims = spark.createDataFrame([("s", "name", "t", "brand")], SKU)
    got = dwd.dwd_action(views, favors, carts, orders, dims)
    assert rows(got, "action_code", "action_id", "action_target_id", "date_id", "tm_name") == [
        ("cart_add", "c1", "s", "2024-01-02", "brand"),
        ("favor_add", "f1", "s", "2024-01-01", "brand"),
        ("order", "d1", "o1", "2024-01-02", None),
        ("page_view", None, "p1", "2024-01-01", "brand"),
    ]


def test_null_text_and_dedup(spark, rows):
    df = spark.createDataFrame([("NULL", 1), ("x", 2)], "a string, b int")
    assert rows(null_text_to_null(df)) == [("x", 2), (None, 1)]
    versions = spark.createDataFrame([("1", 1, "a"), ("1", 2, None), ("2", 1, "c")], "id string, v int, x string")
    assert rows(dwd.drop_duplicate_rows(versions, ["id"], ["v"])) == [("1", 2, None), ("2", 1, "c")]


def test_cart_flag_and_review(spark, rows):
    carts = spark.createDataFrame([("1", "u", "s", "2024-01-01"), ("2", "u", "t", "2024-01-01")], "id string, user_id string, sku_id string, create_time string")
    bought = spark.createDataFrame([("u", "s"), ("u", "s")], "user_id string, sku_id string")
    assert rows(dwd.dwd_cart_info(carts, bought), "id", "is_ordered") == [("1", "1"), ("2", "0")]
    reviews = spark.createDataFrame([("1", "u", "s"), ("2", None, "s")], "review_id string, user_id string, sku_id string")
    dims = spark.createDataFrame([("s", "name", "t", "brand")], SKU)
    assert rows(dwd.dwd_review_info(reviews, dims), "review_id", "tm_name") == [("1", "brand")]
