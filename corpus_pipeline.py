"""From raw documents to shards: five stages over the operators of bazaarlake.llm.

Each stage takes the documents its predecessor kept, and writes Parquet to the shared folder, from
which the next one reads: a lost executor costs tasks of one stage at most.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bazaarlake.llm import quality
from bazaarlake.llm.decontaminate import remove_contaminated
from bazaarlake.llm.minhash import deduplicate
from bazaarlake.llm.mixing import given_quotas, mix, natural_quotas
from bazaarlake.llm.shared import free_name, shared_folder, table
from bazaarlake.llm.sharding import shards

# Metadata of the source column: the folder with the shares of the mix.
SHARES = "mix_shares"


def _same_columns(df: DataFrame, docs: DataFrame) -> DataFrame:
    return df.select(*[F.col(f"`{c}`") for c in docs.columns])


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, learned from the labels, does not reject. Null and empty texts
    have a score as well; repeated rows share theirs; without labels nothing is rejected."""
    model = quality.fit(docs, table(spark, sf_dir, "labels"))
    score = free_name(docs, "_quality")
    scored = quality.score(docs, model, out=score)
    return _same_columns(scored.where(F.col(score) >= quality.REJECT_BELOW), docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate class; documents without words all stay."""
    return deduplicate(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no window of a benchmark item occurs; those without words all stay."""
    return remove_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(
    spark: SparkSession, docs: DataFrame, sf_dir: str, weights: Mapping[str, float] | None = None
) -> DataFrame:
    """The documents of the mix. With weights by source these are as many of each source as its share
    allows, and none of a source without a weight; without them all documents, at their natural
    shares. A null source is a source of its own, which weights cannot name. The shares are written
    to the shared folder, and the source column's metadata names them: by them, and only by them,
    the stages behind place the documents."""
    pairs = [(source, float(weight)) for source, weight in (weights or {}).items()]
    given = None if weights is None else spark.createDataFrame(pairs, "source string, weight double")
    counts = docs.groupBy("source").agg(F.count("*").alias("n"))
    quotas = natural_quotas(counts) if given is None else given_quotas(counts, given)
    path = f"{shared_folder(spark)}/mix-{uuid.uuid4().hex}"
    quotas.where("quota > 0").selectExpr("source", "cast(quota AS double) AS weight").write.parquet(path)
    out = free_name(docs, "_mix")
    mixed = _same_columns(mix(docs, given, out=out).where(F.col(out)["in_mix"]), docs)
    return mixed.withMetadata("source", {**mixed.select("source").schema[0].metadata, SHARES: path})


def settled_shares(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """(source, weight) as mix_sources has settled them; without a mix no rows."""
    path = docs.select("source").schema[0].metadata.get(SHARES)
    return spark.read.parquet(path) if path else docs.selectExpr("source", "1D AS weight").limit(0)


def assign_shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with shard_id, shard_depth, shard_bytes and shard_oversized, and mix_slot and
    mix_position: reading a shard, or all of them, in the order of mix_slot keeps every source within a
    block of its share. The shares are those that the mix has settled; documents beyond them, and all
    where there was no mix, have no slot."""
    mixed, shard = free_name(docs, "_mix"), free_name(docs, "_shard")
    sharded = shards(docs, out=shard)
    placed = mix(sharded, settled_shares(spark, docs), out=mixed)
    named = {f"shard_{p}": F.col(shard)[p] for p in ("id", "depth", "bytes", "oversized")}
    named |= {f"mix_{p}": F.col(mixed)[p] for p in ("slot", "position")}
    kept = [F.col(f"`{c}`") for c in docs.columns if c not in named]
    return placed.select(*kept, *[value.alias(name) for name, value in named.items()])


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_classifier", keep_good),
    ("near_dedup", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("source_mix", mix_sources),
    ("sharding", assign_shards),
]

# The classifier and the sketches have no SQL; tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str, weights: Mapping[str, float] | None = None) -> DataFrame:
    """All stages over the documents of sf_dir; the last one's result is returned, the
    others are written and read again. weights by source are the target of the mix."""
    folder = f"{shared_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    docs = table(spark, sf_dir, "documents")
    for number, (name, stage) in enumerate(STAGES, 1):
        if stage is mix_sources:
            stage = partial(stage, weights=weights)
        docs = stage(spark, docs, sf_dir)
        if number < len(STAGES):
            path = f"{folder}/{number}-{name}"
            docs.write.parquet(path)
            docs = spark.read.parquet(path)
    return docs
