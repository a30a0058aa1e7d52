"""Results are whole: no row, place or token is lost beside another one."""

import itertools
import random
from collections import Counter

import corpus_pipeline
import pytest

from bazaarlake.llm import decontaminate, pii
from bazaarlake.llm.decontaminate import contamination, longest_matches
from bazaarlake.llm.mixing import mix
from tests.llm.test_decontamination import brute, words
from tests.llm.test_mixing_sharding import docs_of


def ordered(got):
    return sorted(got, key=lambda t: tuple((v is None, str(v)) for v in t))


@pytest.mark.parametrize("swap", [False, True])
def test_item_that_starts_another_ones_window(spark, rows, swap):
    long = "alpha beta gamma " + " ".join(f"d{i}" for i in range(4, 12))
    items = [(1, "alpha beta gamma"), (2, long)][:: -1 if swap else 1]
    # In the second batch every place of the short item is one of the long item's.
    for docs in ([(1, long), (2, "alpha beta gamma zz")], [(1, long)]):
        df = spark.createDataFrame(docs, "doc_id long, text string").coalesce(1)
        bench = spark.createDataFrame(items, "item_id long, text string").coalesce(1)
        assert rows(contamination(df, bench).select("doc_id", "contamination.*")) == ordered(brute(docs, items))


def maximal(docs, items, at_least):
    out = []
    for (item, a), (doc, b) in itertools.product(items, docs):
        a, b = words(a), words(b)
        for i, j in itertools.product(range(len(a)), range(len(b))):
            if i and j and a[i - 1] == b[j - 1]:
                continue
            n = 0
            while i + n < len(a) and j + n < len(b) and a[i + n] == b[j + n]:
                n += 1
            if n >= at_least:
                out.append((str(item), i, doc, j, n))
    return ordered(out)


def test_matches_do_not_depend_on_other_documents(spark, rows, monkeypatch):
    item = " ".join(f"q{i}" for i in range(30))
    cut = " ".join(f"q{i}" for i in range(1, 16))
    items = [(5, item), (6, "a b " * 8), (7, "q1 q2 q3"), (8, None)]
    docs = [(1, f"x y {item[:-4]} z"), (2, item), (3, cut), (4, None), (5, f"{cut} - {cut} q16"), (6, "b " + "a b " * 7), (7, cut)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    for at_least in (10, 3):
        want = maximal(docs, items, at_least)
        assert rows(longest_matches(df.coalesce(1), bench, at_least)) == want
    monkeypatch.setattr(decontaminate, "SHARD_WORDS", 20)
    monkeypatch.setattr(decontaminate, "PLACES", 5, raising=False)
    assert rows(longest_matches(df.repartition(4), bench)) == maximal(docs, items, 10)


def test_natural_shares_cut_nothing(spark):
    sizes = {"hot": 70, "a": 10, "b": 10, "c": 9, None: 1}
    df = docs_of(spark, sizes)
    got = mix(df, round_slots=16, block_docs=4).select("source", "mix.*").collect()
    assert len(got) == 100 and all(r["in_mix"] and r["release"] <= r["slot"] < r["deadline"] for r in got)
    kept = corpus_pipeline.mix_sources(spark, df.selectExpr("*", "'t' AS text"), "")
    assert {r["source"]: r["count"] for r in kept.groupBy("source").count().collect()} == sizes


def test_small_sources_keep_their_own_quota(spark):
    sizes = {"big": 200, "tiny": 20, "less": 100, "unlisted": 900, "zero": 300, None: 5}
    weights = spark.createDataFrame(
        [("big", 1.0), ("tiny", 0.05), ("less", 0.02), ("zero", 0.0)], "source string, weight double"
    )
    got = mix(docs_of(spark, sizes), weights, round_slots=16, block_docs=4).select("source", "mix.*").collect()
    assert len(got) == sum(sizes.values())
    mixed = [r for r in got if r["in_mix"]]
    assert Counter(r["source"] for r in mixed) == {"big": 200, "tiny": 10, "less": 4}
    assert all(r["release"] <= r["slot"] < r["deadline"] for r in mixed)
    assert sorted(r["position"] for r in mixed if r["source"] != "big") == list(range(14))
    assert sorted(r["position"] for r in got if not r["in_mix"]) == list(range(len(got) - len(mixed)))


def test_long_tokens_are_candidates(spark):
    rng = random.Random(3)
    hex_ = lambda n: "".join(rng.choice("0123456789abcdef") for _ in range(n))
    secret = [f'token = "{hex_(n)}"' for n in [128] * 20 + [65] * 20]
    plain = [f"in chapter {rng.randrange(10**7, 10**8)} of" for _ in range(40)]
    long = "1-" * 50_000 + "1"
    df = spark.createDataFrame(list(enumerate([*secret, *plain, long])), "doc_id long, text string")
    got = {r[0]: r[1] for r in pii.personal_data(df).select("doc_id", "pii.secret").collect()}
    assert all([(s["start"], s["end"]) for s in got[i]] == [(9, len(t) - 1)] for i, t in enumerate(secret))
    assert not any(got[i] for i in range(40, 80))
