"""What the mix settles decides where the sharding places documents."""

import corpus_pipeline
import pytest


def count_by_source(df):
    return {r["source"]: r["count"] for r in df.groupBy("source").count().collect()}


@pytest.mark.parametrize("weights", [None, {"a": 1, "b": 1}])
def test_sharding_places_by_the_settled_shares(spark, tmp_path, weights):
    rows = [(i, "t", "a" if i % 3 else "b") for i in range(120)] + [(900 + i, "t", None) for i in range(20)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    without = corpus_pipeline.assign_shards(spark, docs, "")
    assert without.count() == 140 and without.where("mix_slot IS NOT NULL").isEmpty()

    corpus_pipeline.mix_sources(spark, docs, "", weights).write.parquet(str(tmp_path / "mixed"))
    mixed = spark.read.parquet(str(tmp_path / "mixed"))
    shares = {"a": 80, "b": 40, None: 20} if weights is None else {"a": 40, "b": 40}
    assert mixed.columns == docs.columns and count_by_source(mixed) == shares
    placed = corpus_pipeline.assign_shards(spark, mixed, "")
    assert count_by_source(placed) == count_by_source(placed.where("mix_slot IS NOT NULL")) == shares

    # Half of a source lost behind the mix: the shares hold, and no document goes.
    fewer = mixed.where("source IS NULL OR source <> 'b' OR doc_id % 2 = 0")
    left = corpus_pipeline.assign_shards(spark, fewer, "")
    assert count_by_source(left) == count_by_source(fewer)
    lost = {s: fewer.where(f"source = '{s}'").count() for s in ("a", "b")}["b"] / shares["b"]
    assert count_by_source(left.where("mix_slot IS NOT NULL")) == {s: round(n * lost) for s, n in shares.items()}
