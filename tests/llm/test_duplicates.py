"""Near-duplicate classes against an inverted index over all shingles."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from bazaarlake.llm import minhash
from bazaarlake.llm.components import connected_components
from bazaarlake.llm.minhash import deduplicate, near_duplicates, shingle_hashes, sketch


def words(text):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x20\x09-\x0D]+", lowered)


def brute(rows):
    """[(doc_id, n_shingles, component_id)] in the order of rows."""
    sets = []
    for _, text in rows:
        w = words(text)
        sets.append({tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set())
    where = defaultdict(list)
    for i, s in enumerate(sets):
        for x in s:
            where[x].append(i)
    parent = list(range(len(sets)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, s in enumerate(sets):
        for j, n in Counter(j for x in s for j in where[x] if j < i).items():
            if 100 * n >= 75 * (len(s) + len(sets[j]) - n):
                parent[root(i)] = root(j)
    low = {}
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            low[root(i)] = min(low.get(root(i), doc_id), doc_id)
    return [(d, len(s), low.get(root(i))) for i, ((d, _), s) in enumerate(zip(rows, sets))]


def edited(rng, text, share):
    return " ".join(f"x{rng.randrange(10**6)}" if rng.random() < share else w for w in text.split())


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(1)
    fresh = lambda n: " ".join(f"w{rng.randrange(5000)}" for _ in range(n))
    texts = [fresh(rng.randrange(1, 200)) for _ in range(60)]
    for size, share in ((80, 0.02), (30, 0.05), (6, 0.01)):
        base = fresh(150)
        texts += [edited(rng, base, share) for _ in range(size)]
    texts += [texts[0]] * 25 + ["a b c", "A B\tc", "a b c d", "", None, " \n ", "é Ü é Ü é", "É Ü é Ü é"]
    rng.shuffle(texts)
    return list(enumerate(texts))


def test_classes_equal_brute_force(spark, corpus, rows):
    df = spark.createDataFrame(corpus, "doc_id long, text string")
    got = rows(near_duplicates(df), "doc_id", "n_shingles", "component_id")
    assert got == sorted(brute(corpus), key=lambda t: tuple((v is None, str(v)) for v in t))


def test_large_groups_take_the_joined_way(spark, corpus, rows, monkeypatch):
    monkeypatch.setattr(minhash, "SMALL_BAND", 2)
    monkeypatch.setattr(minhash, "BLOCK_SETS", 8)
    df = spark.createDataFrame(corpus, "doc_id long, text string")
    got = rows(near_duplicates(df), "doc_id", "n_shingles", "component_id")
    assert got == sorted(brute(corpus), key=lambda t: tuple((v is None, str(v)) for v in t))


def test_edges(spark, rows):
    text = "one two three four five six seven eight nine ten"
    data = [(5, text), (5, text), (3, text.upper()), (None, text), (8, None), (9, ""), (9, "alone"), (None, "nobody else")]
    df = spark.createDataFrame(data, "doc_id long, text string").selectExpr("*", "'x' AS kept", "1 AS component_id")
    got = rows(near_duplicates(df))
    assert got == sorted(
        [
            (5, 6, 3, False), (5, 6, 3, False), (3, 6, 3, True), (None, 6, 3, False),
            (8, 0, 8, True), (9, 0, 9, True), (9, 1, 9, True), (None, 1, None, True),
        ],
        key=lambda t: tuple((v is None, str(v)) for v in t),
    )
    kept = rows(deduplicate(df), "doc_id", "text")
    assert [t[0] for t in kept] == [3, 8, 9, 9, None]
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert near_duplicates(empty).count() == 0 and deduplicate(empty).count() == 0


def test_sketch_is_filled_and_near_the_similarity():
    rng = np.random.default_rng(3)
    assert (sketch(np.array([7], np.uint64)) != 0).all()
    whole = np.unique(rng.integers(0, 2**63, 1000).astype(np.uint64))
    for cut in (1, 20, 500):
        a, b = whole[:-cut], whole[cut:]
        truth = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
        assert abs((sketch(a) == sketch(b)).mean() - truth) < 0.15


def test_very_long_text():
    text = (" ".join(f"w{i}" for i in range(200_000))).encode()
    assert len(shingle_hashes(text)) == 199_996


def test_components_of_a_chain(spark):
    links = [(i, i + 1) for i in range(50)] + [(100, 101), (7, 7), (None, 3)]
    df = spark.createDataFrame(links, "a long, b long")
    got = dict(connected_components(df).collect())
    assert got == {**{i: 0 for i in range(1, 51)}, 101: 100}
    assert connected_components(df.limit(0)).count() == 0
