"""Pfair mixing against a slot-by-slot schedule, extendible hashing against splitting buckets one by one."""

import hashlib
import math
import zlib

import pytest
from pyspark.sql import functions as F

from bazaarlake.llm import mixing, sharding
from bazaarlake.llm.mixing import given_quotas, mix, natural_quotas
from bazaarlake.llm.sharding import shards, write_shards


def schedule(parts, slots):
    """Slots of each lane's blocks, earliest deadline first, one slot after the other."""
    done, out = [0] * len(parts), [[] for _ in parts]
    for t in range(slots):
        ready = [
            (math.ceil((done[i] + 1) * slots / c), i)
            for i, c in enumerate(parts)
            if done[i] < c and done[i] * slots // c <= t
        ]
        i = min(ready)[1]
        out[i].append(t)
        done[i] += 1
    return out


def docs_of(spark, sizes):
    start = {s: zlib.crc32((s or "").encode()) % 7 for s in sizes}
    data = [(n, s) for s, count in sizes.items() for n in range(start[s], start[s] + count)]
    return spark.createDataFrame(data, "doc_id long, source string")


@pytest.mark.parametrize("slots", [16, 64])
def test_schedule_of_a_round(spark, slots):
    parts = [slots - 7, 4, 2, 1]
    lanes = spark.createDataFrame([(i, 10, c) for i, c in enumerate(parts)], "lane int, quota long, c long")
    got = mixing._round(lanes, slots).collect()
    want = schedule(parts, slots)
    assert {(r["lane"], r["j"], r["slot"]) for r in got} == {(i, j, t) for i, s in enumerate(want) for j, t in enumerate(s)}


@pytest.mark.parametrize("share", [None, 1 / 3])
def test_every_source_stays_within_a_block_of_its_share(spark, share):
    sizes = {"hot": 900, "a": 500, "b": 450, "c": 300, "": 40, None: 30, "one": 1}
    df = docs_of(spark, sizes)
    slots, block = 32, 4
    got = mix(df, round_slots=slots, block_docs=block, max_share=share).select("source", "mix.*").collect()
    assert len(got) == sum(sizes.values())
    mixed = [r for r in got if r["in_mix"]]
    rest = sum(n for s, n in sizes.items() if s != "hot")
    hot = 900 if share is None else rest // 2
    assert sum(r["source"] == "hot" for r in mixed) == hot and len(mixed) == rest + hot
    assert all(r["release"] <= r["slot"] < r["deadline"] for r in mixed)
    rounds = math.ceil(len(mixed) / (slots * block))
    assert max(r["slot"] for r in mixed) < rounds * slots
    for source in ("hot", "a", "b", "c"):
        own = [r for r in mixed if r["source"] == source]
        per_block = math.ceil(len(own) / (max(r["block"] for r in own) + 1))
        for t in range(0, rounds * slots, 7):
            there = sum(r["slot"] < t for r in own)
            assert abs(there - len(own) * t / (rounds * slots)) < per_block + 1
        order = sorted(own, key=lambda r: r["position"])
        assert [r["slot"] for r in order] == sorted(r["slot"] for r in own)


def test_documents_are_in_the_order_of_their_id_hash(spark):
    rows = mix(docs_of(spark, {"x": 30}), round_slots=8).select("doc_id", "mix.position").collect()
    key = lambda r: hashlib.md5(str(r["doc_id"]).encode()).hexdigest()
    assert [r["position"] for r in sorted(rows, key=key)] == list(range(30))


def test_quotas(spark):
    def quotas(sizes, share=1 / 3):
        counts = spark.createDataFrame(list(sizes.items()), "source string, n long")
        return {r["source"]: r["quota"] for r in natural_quotas(counts, share).collect()}

    assert quotas({"a": 900, "b": 100}) == {"a": 900, "b": 100}  # too few sources for a third each
    assert quotas({"a": 60, "b": 10, "c": 10, "d": 10}) == {"a": 15, "b": 10, "c": 10, "d": 10}
    assert quotas({"a": 500, "b": 400, "c": 50, "d": 50}) == {"a": 100, "b": 100, "c": 50, "d": 50}
    assert quotas({"a": 25, "b": 25, "c": 25, "d": 25}) == {"a": 25, "b": 25, "c": 25, "d": 25}
    counts = spark.createDataFrame([("a", 100), ("b", 50), (None, 10)], "source string, n long")
    weights = spark.createDataFrame([("a", 1.0), ("b", 2.0), ("gone", 5.0), ("zero", 0.0)], "source string, weight double")
    assert {r["source"]: r["quota"] for r in given_quotas(counts, weights).collect()} == {"a": 25, "b": 50, None: 0}
    mixed = mix(docs_of(spark, {"a": 100, "b": 50, None: 10}), weights, round_slots=8)
    assert {r["source"]: r["n"] for r in mixed.where("mix.in_mix").groupBy("source").agg(F.count("*").alias("n")).collect()} == {"a": 25, "b": 50}


def test_mixing_edges(spark):
    same = spark.createDataFrame([(1, "s", "t")] * 5 + [(None, "s", "u")], "doc_id long, source string, mix string")
    got = mix(same, round_slots=8).select("mix.position", "doc_id").collect()
    assert sorted(r["position"] for r in got) == list(range(6))
    assert mix(same.limit(0)).count() == 0
    none = spark.createDataFrame([], "source string, weight double")
    assert mix(same, none).where("mix.in_mix").count() == 0
    many = docs_of(spark, {f"s{i}": 2 for i in range(50)} | {"big": 60})
    spread = mix(many, round_slots=8, max_share=0.5)
    assert spread.count() == 160 and spread.where("mix.in_mix and mix.slot is null").count() == 0


def split(rows, limit):
    """{bits: rows}: buckets split on a further bit while they are too large and can be split."""
    out, todo = {}, [("", rows)]
    while todo:
        bits, group = todo.pop()
        if sum(b for _, b in group) <= limit or len({h for h, _ in group}) == 1:
            if group:
                out[bits] = group
            continue
        for bit in "01":
            todo.append((bits + bit, [r for r in group if r[0].startswith(bits + bit)]))
    return out


@pytest.mark.parametrize("limit, spare, more", [(900, 6, 8), (300, 0, 1), (10_000_000, 6, 8)])
def test_shards_equal_splitting_one_by_one(spark, monkeypatch, limit, spare, more):
    monkeypatch.setattr(sharding, "SPARE_BITS", spare)
    monkeypatch.setattr(sharding, "MORE_BITS", more)
    data = [(i, "é" * (i * 37 % 90)) for i in range(300)] + [(5, "x" * 5000), (6, None), (None, "y")] + [(9, "z" * 50)] * 30
    df = spark.createDataFrame(data, "doc_id long, text string").selectExpr("*", "0 AS shard")
    hashed = df.select(F.lpad(F.bin(F.xxhash64(F.struct("*"))), 64, "0").alias("h"), F.coalesce(F.octet_length("text"), F.lit(0)).alias("b"))
    want = split([(r["h"], r["b"]) for r in hashed.collect()], limit)
    got = {}
    for r in shards(df, limit).select("shard.*").collect():
        n = got.setdefault(r["id"], [0, r["bytes"], r["depth"], r["oversized"]])
        n[0] += 1
    assert got == {
        bits: [len(g), sum(b for _, b in g), len(bits), sum(b for _, b in g) > limit] for bits, g in want.items()
    }


def test_sharding_edges_and_files(spark, tmp_path):
    df = spark.createDataFrame([(i, "a" * 100) for i in range(50)], "doc_id long, text string")
    assert shards(df.limit(0), 10).count() == 0
    write_shards(shards(df, 1000), str(tmp_path / "s"))
    back = spark.read.parquet(str(tmp_path / "s"))
    assert back.count() == 50 and back.groupBy("shard_id").agg(F.sum(F.length("text")).alias("n")).where("n > 1000").isEmpty()
