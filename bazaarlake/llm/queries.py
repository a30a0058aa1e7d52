"""The registered queries of the package; their SQL, where DuckDB can say the same, is in oracle.py."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bazaarlake.llm import hmm, pii, quality
from bazaarlake.llm.codes import compress
from bazaarlake.llm.decontaminate import contamination
from bazaarlake.llm.licenses import license_scan
from bazaarlake.llm.minhash import near_duplicates
from bazaarlake.llm.mixing import mix
from bazaarlake.llm.oracle import ORACLE
from bazaarlake.llm.packing import pack
from bazaarlake.llm.phrases import collocations
from bazaarlake.llm.shared import fold, table
from bazaarlake.llm.sharding import shards
from bazaarlake.llm.topk import top_k
from bazaarlake.llm.warc import page_records


__all__ = ["ORACLE", "QUERIES"]


def op1_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    marked = contamination(docs, table(spark, sf_dir, "benchmark"))
    return marked.select("doc_id", "contamination.*")


def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return page_records(table(spark, sf_dir, "pages"))


def op4_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return top_k(vectors, vectors.where("vec_id % 50 = 0"))


def op5_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source")
    return mix(docs).select("doc_id", "source", "mix.*")


def op5_mix_weighted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shares like the roots of the sources' sizes, which leaves documents of large ones out."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "source")
    weights = docs.groupBy("source").agg(F.sqrt(F.count("*")).alias("weight"))
    return mix(docs, weights).select("doc_id", "source", "mix.*")


def op6_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return license_scan(docs).select("doc_id", "license.*").drop("spans")


def op7_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    sharded = shards(docs).select("doc_id", "shard.*")
    return sharded.withColumnsRenamed({"id": "shard_id", "bytes": "shard_bytes"})


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = fold(F.col("doc_id"), 5) == 0
    model = quality.fit(docs, table(spark, sf_dir, "labels"), train=~held_out)
    return quality.score(docs, model, out="score").select(
        "doc_id",
        held_out.alias("held_out"),
        "score",
        (F.col("score") >= quality.REJECT_BELOW).cast("int").alias("predicted"),
    )


def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = pii.personal_data(docs, out="p")
    p = F.col("p")
    base = pii.span_text(p, pii.KINDS)
    return found.select(
        "doc_id",
        *[F.size(p[k]).cast("bigint").alias(f"n_{k}") for k in pii.KINDS],
        F.sha2(base, 256).alias("base_sha256"),
        pii.span_text(p, (*pii.KINDS, pii.SECRET)).alias("spans"),
    )


def op10_hmm(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return hmm.score(docs, fold(F.col("doc_id"), 5) == 1)


def op11_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded, books = compress(table(spark, sf_dir, "embeddings"), keep=["label"])
    coded = coded.select(F.col("id").alias("vec_id"), F.col("kept.label").alias("label"), "code", "error")
    errors = coded.groupBy(F.col("label").alias("of")).agg(F.sum("error").alias("label_error"))
    joined = coded.join(errors, F.col("label").eqNullSafe(F.col("of")))
    digest = F.lit(books.sha256() if books else None).alias("codebooks_sha256")
    return joined.select("vec_id", "code", "error", "label_error", digest)


def op12_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    packed = pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    return packed.select(
        F.col("id").alias("doc_id"),
        "start",
        "length",
        F.crc32("ids").alias("ids_crc32"),
        F.col("tokens").alias("doc_tokens"),
        "sequence_id",
        "offset",
    )


def op13_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_minhash": op1_minhash,
    "op2_decontaminate": op2_decontaminate,
    "op3_warc": op3_warc,
    "op4_topk": op4_topk,
    "op5_mix": op5_mix,
    "op5_mix_weighted": op5_mix_weighted,
    "op6_licenses": op6_licenses,
    "op7_shards": op7_shards,
    "op8_quality": op8_quality,
    "op9_pii": op9_pii,
    "op10_hmm": op10_hmm,
    "op11_codes": op11_codes,
    "op12_pack": op12_pack,
    "op13_phrases": op13_phrases,
}
