"""The pipeline stage by stage against brute force, and whole."""

import random

import corpus_pipeline
import pytest
from tests.llm.test_decontamination import brute as contaminated
from tests.llm.test_duplicates import brute as classes
from tests.llm.test_duplicates import edited
from tests.llm.test_text_models import text_of


@pytest.fixture(scope="module")
def sf_dir(spark, tmp_path_factory):
    rng = random.Random(13)
    path = str(tmp_path_factory.mktemp("sf"))
    sources = ["hot"] * 6 + ["a", "b", "c", "d", None]
    docs, labels = [], []
    for i in range(300):
        good = i % 6 > 0
        docs.append((i, text_of(rng, good), "en", rng.choice(sources), 0))
        if i % 4 < 2:
            labels.append((i, int(good), 0))
    items = [(n, " ".join(f"q{n}x{k}" for k in range(15))) for n in range(5)]
    for n in range(20):
        docs.append((300 + n, edited(rng, docs[1][1], 0.02 if n < 10 else 0.0), "en", "a", 0))
        docs.append((400 + n, f"{text_of(rng, True)} {items[n % 5][1]}", "en", "b", 0))
    docs += [(500, None, None, None, None), (501, "", "en", "a", 0), docs[1], docs[1], (None, text_of(rng, True), "en", "c", 0)]
    frame = spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long")
    frame.selectExpr("*", "'mine' AS shard_id", "1 AS _mix", "2 AS kept").write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return path


def rows_of(df):
    return sorted((str(r["doc_id"]), str(r["text"])) for r in df.select("doc_id", "text").collect())


def test_stages_equal_brute_force(spark, sf_dir, tmp_path):
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["quality_classifier", "near_dedup", "decontamination", "source_mix", "sharding"]
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns = docs.columns

    def step(name, given):
        out = stages[name](spark, given, sf_dir)
        path = str(tmp_path / name)
        out.write.parquet(path)
        return spark.read.parquet(path)

    good = step("quality_classifier", docs)
    assert good.columns == columns
    ids = {r["doc_id"] for r in good.collect()}
    assert not ids & set(range(0, 300, 6)) and ids >= {i for i in range(300) if i % 6} | set(range(400, 420)) | {None}

    given = [(r["doc_id"], r["text"]) for r in good.collect()]
    one = step("near_dedup", good)
    of = {}
    for (doc_id, n, low), (_, text) in zip(classes(given), given):
        key = ("class", low) if n and low is not None else ("own", doc_id, text, n)
        of.setdefault(key, []).append((doc_id, text))
    want = []
    for key, members in of.items():
        wordless = key[0] == "own" and key[3] == 0
        want += members if wordless else [min(members, key=lambda m: (m[0] is None, m[0] or 0))]
    assert one.columns == columns and [i for i, _ in rows_of(one)] == sorted(str(i) for i, _ in want)

    clean = step("decontamination", one)
    given = [(r["doc_id"], r["text"]) for r in one.collect()]
    items = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    hit = {str(d) for d, *_, bad in contaminated(given, items) if bad}
    assert len(hit) == 20 and rows_of(clean) == [r for r in rows_of(one) if r[0] not in hit]

    mixed = step("source_mix", clean)
    assert mixed.columns == columns and rows_of(mixed) == rows_of(clean)
    assert {r["_mix"] for r in mixed.select("_mix").collect()} == {1}

    sharded = step("sharding", mixed)
    assert rows_of(sharded) == rows_of(mixed)
    assert [r["shard_id"] for r in sharded.select("shard_id").distinct().collect()] == [""]
    # The order of the mix is in the result: every source is spread over it.
    order = [r["source"] for r in sharded.orderBy("mix_slot", "mix_position").collect()]
    hot = order.count("hot")
    assert 40 < hot < len(order) and abs(order[: len(order) // 2].count("hot") - hot / 2) < hot / 10
    assert len({r["mix_slot"] for r in sharded.select("mix_slot").collect()}) > 1


def test_run(spark, sf_dir):
    final = corpus_pipeline.run(spark, sf_dir)
    assert {"shard_id", "shard_depth", "shard_bytes", "shard_oversized"} <= set(final.columns)
    ids = [r["doc_id"] for r in final.select("doc_id").collect()]
    assert len(ids) == len(set(ids)) and not set(ids) & {400, 401, 0, 6}


def test_given_weights_decide_what_stays(spark, sf_dir):
    final = corpus_pipeline.run(spark, sf_dir, weights={"hot": 1, "a": 1, "b": 1})
    sizes = {r["source"]: r["count"] for r in final.groupBy("source").count().collect()}
    assert set(sizes) == {"hot", "a", "b"} and len(set(sizes.values())) == 1


def test_empty_tables(spark, sf_dir, tmp_path):
    for name in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"{sf_dir}/{name}.parquet").limit(0).write.parquet(str(tmp_path / f"{name}.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
