"""Suffix-array decontamination against a search for every window at every place."""

import hashlib
import random
import re

import numpy as np

from bazaarlake.llm import decontaminate
from bazaarlake.llm.decontaminate import contamination, longest_matches, remove_contaminated, suffix_array


def words(text):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)


def brute(docs, items):
    windows = {}
    for item, text in items:
        w = words(text)
        for i in range(max(1, len(w) - 9)) if w else []:
            windows.setdefault(tuple(w[i : i + 10]), set()).add(str(item))
    out = []
    for doc_id, text in docs:
        w = words(text)
        hit, found = [0] * len(w), set()
        for size in {len(k) for k in windows}:
            for i in range(len(w) - size + 1):
                if tuple(w[i : i + size]) in windows:
                    found |= windows[tuple(w[i : i + size])]
                    hit[i : i + size] = [1] * size
        digest = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out.append((doc_id, len(w), sum(hit), len(found), digest, sum(hit) > 0))
    return out


def corpus(seed=2):
    rng = random.Random(seed)
    text = lambda n: " ".join(rng.choice("abcdefgh") for _ in range(n))
    items = [(i, text(rng.choice([0, 1, 3, 9, 10, 11, 25]))) for i in range(30)]
    items += [(3, items[5][1]), (99, None), (98, ".-,"), (97, "Ünï çödé A-B! " * 4)]
    docs = [(i, text(rng.randrange(0, 300))) for i in range(40)]
    for i in range(40, 70):
        item = rng.choice(items)[1] or ""
        docs.append((i, f"{text(20)}. {item.upper()} ... {text(20)}"))
    return docs + [(70, None), (71, ""), (72, "!!"), (40, docs[40][1]), (73, "ünï çödé a b ünï")], items


def test_digests_equal_brute_force(spark, rows, monkeypatch):
    docs, items = corpus()
    monkeypatch.setattr(decontaminate, "SHARD_WORDS", 500)
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = rows(contamination(df, bench).select("doc_id", "contamination.*"))
    assert got == sorted(brute(docs, items), key=lambda t: tuple((v is None, str(v)) for v in t))


def test_benchmark_in_blocks(spark, rows, monkeypatch):
    docs, items = corpus(4)
    monkeypatch.setattr(decontaminate, "BLOCK_BYTES", 100)
    df = spark.createDataFrame(docs, "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = rows(contamination(df, bench).select("doc_id", "contamination.*"))
    assert got == sorted(brute(docs, items), key=lambda t: tuple((v is None, str(v)) for v in t))


def test_longest_match_and_removal(spark, rows):
    item = " ".join(f"q{i}" for i in range(30))
    docs = [(1, f"x y {item[:-4]} z"), (2, item), (3, "nothing here"), (4, None)]
    df = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "7 AS contamination")
    bench = spark.createDataFrame([(5, item)], "item_id long, text string")
    assert rows(longest_matches(df.coalesce(1), bench)) == [("5", 0, 1, 2, 29), ("5", 0, 2, 0, 30)]
    assert rows(longest_matches(df.where("doc_id = 1"), bench)) == [("5", 0, 1, 2, 29)]
    clean = remove_contaminated(df, bench)
    assert clean.columns == ["doc_id", "text", "contamination"]
    assert rows(clean, "doc_id") == [(3,), (4,)]
    none = bench.limit(0)
    assert remove_contaminated(df, none).count() == 4 and longest_matches(df, none).count() == 0
    assert contamination(df.limit(0), bench).count() == 0


def test_suffix_array_orders_all_suffixes():
    rng = np.random.default_rng(5)
    ids = rng.integers(0, 3, 400)
    order = suffix_array(ids, len(ids))
    assert order.tolist() == sorted(range(400), key=lambda i: ids[i:].tolist())
