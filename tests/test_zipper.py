"""Open and closed versions apart: the same zipper, no shuffle of what is stored."""

import random

from bazaarlake.operators import dim
from bazaarlake.sources.bucketed import read_bucketed, stored_buckets, write_bucketed

DAYS = [f"2024-01-{d:02d}" for d in range(10, 16)]
SCHEMA = "id string, login_name string, nick_name string, name string, phone_num string, email string, user_level string, status string"


def feeds(spark):
    """Users that stay, change, change back, appear late, and are absent for a day; null values."""
    rng = random.Random(3)
    out = []
    for n, _ in enumerate(DAYS):
        data = []
        for i in range(40 + 5 * n):
            if (i + n) % 7 == 0 and n:
                continue
            level = rng.choice(["1", "2", None]) if i % 3 == 0 else "1"
            data.append((f"u{i}", f"l{i}", None, f"n{i}", "1", None, level, "ok"))
        out.append(spark.createDataFrame([*data, (None, *["x"] * 7), ("", *["x"] * 7)], SCHEMA))
    return out


def test_replay_gives_the_versions_of_the_whole_zipper(spark, rows, tmp_path):
    path, whole, closed, sizes = str(tmp_path / "open"), None, [], []
    for day, feed in zip(DAYS, feeds(spark)):
        if whole is None:
            whole = dim.dim_user_init(feed, day)
            write_bucketed(whole.repartition(4, "id"), path, day, "id", 4)
            before = day
            continue
        whole = spark.createDataFrame(dim.dim_user_zip_update(whole, feed, day).collect(), whole.schema)
        known, new, ended = dim.dim_user_open_update(read_bucketed(spark, path, before, "id"), feed, day)
        write_bucketed(known, path, day, "id", 4)
        write_bucketed(new.repartition(4, "id"), path, day, "id", 4, append=True)
        closed += [tuple(r) for r in ended.collect()]
        sizes.append(ended.count())
        stored = [tuple(r) for r in read_bucketed(spark, path, day, "id").select(*known.columns).collect()]
        key = lambda t: tuple((v is None, str(v)) for v in t)
        assert sorted(stored + closed, key=key) == rows(whole, *known.columns)
        before = day
    assert len(closed) > 30 and max(sizes) < len(closed) / 2  # a day writes what it closes, not what was closed


def test_stored_users_are_not_shuffled(spark, tmp_path):
    path = str(tmp_path / "open")
    first, feed = feeds(spark)[:2]
    write_bucketed(dim.dim_user_init(first, DAYS[0]).repartition(8, "id"), path, DAYS[0], "id", 8)
    assert stored_buckets(spark, path, DAYS[0]) == 8 and stored_buckets(spark, path, DAYS[1]) is None
    assert read_bucketed(spark, path, DAYS[1], "id") is None
    files = [f for f in (tmp_path / "open" / f"dt={DAYS[0]}" / "buckets=8").iterdir() if f.suffix == ".orc"]
    assert 0 < len(files) <= 8
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for df in dim.dim_user_open_update(read_bucketed(spark, path, DAYS[0], "id"), feed, DAYS[1]):
            plan = df._jdf.queryExecution().executedPlan().toString()
            assert plan.count("Exchange ") == 1, plan  # the feed's
            assert "SelectedBucketsCount: 8 out of 8" in plan
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    # Another session finds the table by its folder.
    other = spark.newSession()
    other.sql(f"DROP TABLE IF EXISTS bucketed_{__import__('hashlib').md5(f'{path}/dt={DAYS[0]}/buckets=8'.encode()).hexdigest()}")
    assert read_bucketed(other, path, DAYS[0], "id").count() == 40
