"""Damaged raw lines: each kind of damage, and that no row leaves without a reason."""

import random

import pytest

from bazaarlake.operators import dwd, quality
from bazaarlake.plans.daily import RAW_RULES, DailyRun
from bazaarlake.sources import files
from bazaarlake.sources.arrivals import event_day
from bazaarlake.sources.quarantine import Rules, outcomes, quarantine, rejected_by_reason
from bazaarlake.sources.schemas import RAW_COLUMNS, raw_schema

D = "2024-01-21"
DETAIL = raw_schema("order_detail")
SOUND = {"id": "d1", "order_id": "o1", "sku_id": "s1", "sku_name": "a", "img_url": "\\N", "order_price": "5.00", "sku_num": "2",
         "create_time": f"{D} 09:30", "source_type": "", "source_id": "NULL"}


def line(**changed):
    return "\t".join({**SOUND, **changed}.values())


def reasons(spark, text, schema=DETAIL, rules=RAW_RULES["order_detail"]):
    (row,) = outcomes(spark.createDataFrame([(text,)], "value string"), schema, rules).collect()
    assert row["line"] == text
    return [tuple(r) for r in row["reasons"]], row["rejected"]


def test_each_damage(spark):
    cases = {
        line(): ([], False),
        line(sku_name="a\\tb\\nc"): ([], False),
        line() + "\tmore": ([(None, "too many fields")], False),
        line().rsplit("\t", 1)[0]: ([(None, "too few fields")], False),
        "d1\to1": ([(None, "too few fields"), ("sku_id", "missing"), ("order_price", "missing"), ("sku_num", "missing"),
                    ("create_time", "missing")], True),
        line(order_price="five"): ([("order_price", "unreadable number")], True),
        line(sku_num="99999999999999999999"): ([("sku_num", "unreadable number")], True),
        line(sku_num="0"): ([("sku_num", "out of range")], True),
        line(order_price="-1", sku_id=""): ([("sku_id", "missing"), ("order_price", "out of range")], True),
        line(create_time="soon"): ([("create_time", "unreadable time")], True),
        line(create_time="\\N"): ([("create_time", "missing")], True),
        line(id="NULL"): ([("id", "missing")], True),
        "": ([(None, "too few fields")] + [(n, "missing") for n in ("id", "order_id", "sku_id", "order_price", "sku_num", "create_time")], True),
    }
    order = list(cases)
    frame = spark.createDataFrame([(text,) for text in order], "value string")
    got = {r["line"]: ([tuple(x) for x in r["reasons"]], r["rejected"]) for r in outcomes(frame, DETAIL, RAW_RULES["order_detail"]).collect()}
    assert got == cases


def test_fields_that_are_not_needed_stay(spark):
    sku = raw_schema("sku_info")
    text = "\t".join({"id": "s1", "weight": "heavy", "create_time": "then"}.get(c, "\\N") for c in RAW_COLUMNS["sku_info"].split())
    assert reasons(spark, text, sku, RAW_RULES["sku_info"]) == ([("weight", "unreadable number"), ("create_time", "unreadable time")], False)
    assert reasons(spark, text, sku, Rules())[1] is False


def damaged_lines(n=400, seed=7):
    """Lines of which half carry one or two random damages; the ids tell them apart."""
    rng = random.Random(seed)
    bad = {"id": ("", "\\N"), "order_id": ("", "NULL"), "sku_id": ("\\N",), "order_price": ("-2", "x", "\\N", ""),
           "sku_num": ("0", "-1", "two", "\\N", "1.5"), "create_time": ("soon", "\\N", "2024-13-01"), "sku_name": ("\\N",), "source_id": ("",)}
    for i in range(n):
        changed = {f: rng.choice(bad[f]) for f in rng.sample(list(bad), rng.choice((0, 0, 1, 2)))}
        text = line(**{"id": f"d{i}", "img_url": f"n{i}", **changed})
        yield i, text + "\tx" if rng.random() < 0.05 else text


def test_no_row_leaves_without_a_reason(spark, tmp_path):
    made = dict(damaged_lines())
    spark.createDataFrame([(t,) for t in made.values()], "value string").write.text(f"{tmp_path}/raw/order_detail/dt={D}")
    rows = files.read_raw(spark, f"{tmp_path}/raw/order_detail", DETAIL, D)
    skus = spark.createDataFrame([], "sku_id string")
    facts = dwd.dwd_order_detail(rows.where(event_day("create_time").isNotNull()), skus)
    kept = {r["img_url"] for r in facts.select("img_url").collect()}
    path = f"{tmp_path}/quarantine"
    profile = quarantine(spark, f"{tmp_path}/raw", {"order_detail": (DETAIL, RAW_RULES["order_detail"])}, path, D)["order_detail"]
    stored = files.read_partition(spark, path, D).collect()
    rejected = {r["line"].split("\t")[4] for r in stored if r["rejected"]}
    assert rejected == {f"n{i}" for i in made} - kept and 50 < len(rejected) < 350
    assert (profile.rows, profile.damaged, profile.rejected) == (400, len(stored), len(rejected)) and len(stored) > len(rejected)
    assert all(r["reasons"] for r in stored)
    by_reason = rejected_by_reason(spark, path).collect()
    assert sum(r["line_count"] for r in by_reason) == sum(len(r["reasons"]) for r in stored)
    assert {r["dt"] for r in by_reason} == {D}


def test_the_share_stops_the_day(spark, tmp_path):
    raw, root = f"{tmp_path}/raw", f"{tmp_path}/wh"
    others = [t for t in RAW_RULES if t not in ("order_detail", "base_region")]
    texts = [line(), line(id="d2", sku_num="none"), line(id="d3")]
    for day in range(2):  # a rerun replaces the folder
        spark.createDataFrame([(t,) for t in texts[day:]], "value string").write.mode("overwrite").text(f"{raw}/order_detail/dt={D}")
        spark.createDataFrame([], "value string").write.mode("overwrite").text(f"{raw}/base_region/dt={D}")
        run = DailyRun(spark, raw, root, D, not_delivered=others, max_rejected=0.4)
        run.run_raw()
        assert files.read_partition(spark, f"{root}/quarantine/raw", D).count() == 1
        if day == 0:
            quality.assert_quality(run.raw_gate())
    with pytest.raises(quality.QualityError, match="raw/order_detail"):
        quality.assert_quality(run.raw_gate())
