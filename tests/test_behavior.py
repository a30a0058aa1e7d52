import random

from bazaarlake.functions.ranking import distributed_row_number
from bazaarlake.operators import behavior as b
from pyspark.sql import functions as F

LINES = [
    "2025-06-15 10:00:00,u,ip,view_product,p1",
    "06/15/2025 10:00:00,u,ip,view_product,p1",
    "2025-6-5 9:05:07,u,ip,view_product,p1",
    "2025-6-5,u,ip,view_product,p1",
    "garbage,u,ip,view_product,p1",
    "2025-13-45x,u,ip,view_product,p1",
    "2025-06-15 10:00:00,u,ip,view_product,",
    "2025-06-15 10:00:00,u,ip,view_product",
    "2025-06-15 10:00:00,u,ip",
    "2025-06-15 10:00:00,u,ip,view_product,p1,",
    "",
]


def raw(spark, lines):
    return spark.createDataFrame(list(enumerate(lines)), "line_id bigint, line string")


def events(spark, items):
    return spark.createDataFrame(
        [(i, t, u, "ip", a, p) for i, (t, u, a, p) in enumerate(items)],
        "line_id bigint, event_time string, user string, ip string, action string, product string",
    )


def reasons(df):
    return [r["reason"] for r in df.orderBy("line_id").collect()]


def test_strict(spark):
    assert reasons(b.log_clean_strict(raw(spark, LINES))) == [
        None, "date_format", "date_format", "date_format", "date_format", None, "empty_product",
        "field_count", "field_count", "field_count", "field_count",
    ]


def test_repair(spark):
    got = b.log_clean_repair(raw(spark, LINES))
    assert reasons(got) == [
        None, None, None, None, "date_format", None, "empty_product",
        "field_count", "field_count", "field_count", "field_count",
    ]
    times = [r["event_time"] for r in got.orderBy("line_id").limit(4).collect()]
    assert times == ["2025-06-15 10:00:00", "2025-06-15 10:00:00", "2025-06-05 09:05:07", "2025-06-05 00:00:00"]


def test_fill_drops_nothing(spark):
    got = b.log_clean_fill(raw(spark, LINES), "2025-07-01 00:00:00").orderBy("line_id").collect()
    assert len(got) == len(LINES)
    assert got[4]["event_time"] == "2025-07-01 00:00:00"
    assert got[6]["product"] == "unknown_product"
    assert (got[8]["action"], got[8]["product"]) == ("unknown", "unknown")
    assert got[10]["user"] == "unknown"


def test_adaptive_escalates(spark):
    good = ["2025-06-15 10:00:00,u,ip,view_product,p1"] * 95
    slashed, short = "06/15/2025 10:00:00,u,ip,view_product,p1", "x"
    for bad, expected in (([short] * 5, 0), ([short] * 5 + [slashed] * 5, 1), ([short] * 10, 2)):
        df, strategy = b.clean_adaptive(raw(spark, good + bad), "2025-07-01 00:00:00")
        assert strategy == expected
        chosen = [r["strategy"] for r in b.retention_by_strategy(raw(spark, good + bad)).where("chosen").collect()]
        assert chosen == [expected]
        if expected == 2:
            assert b.valid(df).count() == 105
    assert b.clean_adaptive(raw(spark, []), "t")[1] == 2


def test_hourly_fills_and_breaks_ties_late(spark):
    df = events(spark, [("2025-06-15 09:00:00", "u", "a", "p"), ("2025-06-15 21:00:00", "u", "a", "p"), ("2025-06-16", "u", "a", "p")])
    got = {r["hour"]: (r["event_count"], r["is_peak"]) for r in b.hourly_activity(df).collect()}
    assert len(got) == 24
    assert got[9] == (1, False) and got[21] == (1, True) and got[0] == (1, False) and got[5] == (0, False)


def test_top_lists_and_bursts(spark, rows):
    df = events(spark, [("2025-06-15 09:00:00", "u", "a", "p"), ("2025-06-15 09:59:00", "u", "b", "q"),
                        ("2025-06-15 09:59:59", "u", "c", "r"), ("2025-06-15 10:00:00", "u", "a", "q"),
                        ("2025-06-15 10:00:00", "v", "a", "q"), ("2025-06-15 10:30:00", "v", "a", "z")])
    assert [tuple(r) for r in b.top_products(df, 3).collect()] == [("q", 3), ("z", 1), ("r", 1)]
    assert rows(b.burst_users(df)) == [("u", "2025-06-15 09", 3)]
    assert rows(b.data_range(df)) == [("2025-06-15", "2025-06-15")]


def test_category_conversion_lookup_and_no_views(spark, rows):
    items = [("t", "u", "view_product", "p1"), ("t", "u", "purchase", "p1"), ("t", "u", "view_product", "p1"),
             ("t", "u", "purchase", "p2"), ("t", "u", "view_product", "nowhere")]
    products = spark.createDataFrame([("p1", "n", 1, "c1"), ("p2", "n", 1, "c2")], "product string, name string, price int, category string")
    assert rows(b.category_conversion(events(spark, items), products)) == [("c1", 2, 0, 1, 50.0)]


def brute_trigrams(items):
    per_user, counts = {}, {}
    for i, (t, u, a, _) in enumerate(items):
        per_user.setdefault(u, []).append((t, i, a))
    for seq in per_user.values():
        seq.sort()
        names = [a for _, _, a in seq]
        for k in range(len(names) - 2):
            path = " -> ".join(names[k : k + 3])
            counts[path] = counts.get(path, 0) + 1
    return sorted(counts.items(), key=lambda x: (x[1], x[0]), reverse=True), per_user


def random_items(seed, n):
    rng = random.Random(seed)
    items = []
    for _ in range(n):
        user = "hot" if rng.random() < 0.4 else f"u{rng.randint(0, 12)}"
        # few minutes, many equal times: slices of one, two and many rows
        items.append((f"2025-06-15 10:{rng.randint(0, 40):02d}:{rng.choice((0, 30)):02d}", user, rng.choice("abc"), "p"))
    return items


def test_trigrams_and_paths_against_brute_force(spark, monkeypatch):
    for seed, n, bits in ((1, 60, 20), (2, 400, 20), (3, 400, 4), (4, 400, 0)):
        monkeypatch.setattr(b, "TIE_BITS", bits)
        items = random_items(seed, n)
        expected, per_user = brute_trigrams(items)
        got = [tuple(r) for r in b.common_trigrams(events(spark, items), 10**6).collect()]
        assert got == expected
        parts = {}
        for r in b.user_paths(events(spark, items), part_size=7).orderBy("user", "part").collect():
            assert r["action_count"] <= 7
            parts.setdefault(r["user"], []).append(r["path"])
        assert {u: " -> ".join(p) for u, p in parts.items()} == {
            u: " -> ".join(a for _, _, a in sorted(seq)) for u, seq in per_user.items()}


def test_trigrams_of_short_users(spark):
    items = [("t1", "one", "a", "p"), ("t1", "two", "a", "p"), ("t2", "two", "b", "p")]
    assert b.common_trigrams(events(spark, items)).count() == 0


def test_sessions_against_brute_force(spark, rows):
    from bazaarlake.operators.dws import user_sessions

    rng = random.Random(5)
    items = [("hot" if rng.random() < 0.4 else f"u{rng.randint(0, 5)}", rng.randint(0, 60_000)) for _ in range(500)]
    df = spark.createDataFrame(items, "user_id string, s bigint").withColumn("ts", F.timestamp_seconds("s"))
    expected = []
    for user in {u for u, _ in items}:
        times = sorted(s for u, s in items if u == user)
        start, last, n = times[0], times[0], 0
        for s in times:
            if s - last > 300:
                expected.append((user, n, float(last - start)))
                start, n = s, 0
            last, n = s, n + 1
        expected.append((user, n, float(last - start)))
    got = rows(user_sessions(df, "ts", 300), "user_id", "views", "duration_sec")
    assert got == sorted(expected, key=lambda t: tuple((v is None, str(v)) for v in t))


def test_distributed_row_number_against_brute_force(spark):
    rng = random.Random(9)
    # one value holds most rows: the tie-break alone orders them
    items = [(rng.choice((1, 7)), 5 if rng.random() < 0.7 else rng.randint(0, 9), i) for i in range(3000)]
    df = spark.createDataFrame(items, "g int, v int, id int").repartition(8)
    ranked = distributed_row_number(df, ["g"], [F.col("v").desc(), F.col("id").asc()], "rn")
    got = {(r["g"], r["id"]): r["rn"] for r in ranked.collect()}
    for g in (1, 7):
        ordered = sorted(((-v, i) for gg, v, i in items if gg == g))
        assert [got[(g, i)] for _, i in ordered] == list(range(1, len(ordered) + 1))
