"""Sharding by extendible hashing.

A row hashes to 64 bits. The directory knows a bucket by a prefix of them; a bucket over the byte
limit, and only such a bucket, splits on one bit more. The splits follow from the sizes of the
prefixes, so they are read off sums instead of being done one after the other: rows are
summed once per cell, a prefix somewhat longer than needed, and the cells' sums give the
sizes of all shorter prefixes. Cells that are still too large are summed on with more bits, from their
rows alone. The directory has a few entries a shard and joins the rows at the end.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bazaarlake.llm.shared import checkpointed

SHARD_BYTES = 64 << 20
# Bits beyond log2(total / limit) of the first cells, and bits added where those do not do.
SPARE_BITS, MORE_BITS = 6, 8
HASH_BITS = 64


def _prefix(value: str, bits: str, of: int = HASH_BITS) -> F.Column:
    """The first `bits` bits of a number of `of` bits; none of them is 0."""
    return F.expr(f"if({bits} = 0, 0L, shiftrightunsigned({value}, {of} - cast({bits} as int)))")


def _leaves(cells: DataFrame, low: int, high: int, limit: int) -> DataFrame:
    """Per cell of `high` bits its bucket: the shortest prefix of low..high bits that fits, or
    that no bit can split."""
    each = cells.withColumn("depth", F.explode(F.sequence(F.lit(low), F.lit(high)))).withColumn(
        "prefix", _prefix("cell", "depth", high)
    )
    buckets = each.groupBy("depth", "prefix").agg(
        F.sum("bytes").alias("bytes"), F.min("lo").alias("lo"), F.max("hi").alias("hi")
    )
    fit = buckets.where((F.col("bytes") <= limit) | (F.col("lo") == F.col("hi")))
    return (
        each.select("cell", "depth", "prefix")
        .join(fit.select("depth", "prefix", F.col("bytes").alias("shard_bytes")), ["depth", "prefix"])
        .groupBy("cell")
        .agg(F.min(F.struct("depth", "shard_bytes")).alias("leaf"))
        .select("cell", "leaf.depth", "leaf.shard_bytes")
    )


def shards(
    docs: DataFrame, limit: int = SHARD_BYTES, text_col: str = "text", out: str = "shard"
) -> DataFrame:
    """docs with a struct column `out`: id (the bucket's bits as text, '' for the only one), depth,
    bytes (of the whole shard), oversized.

    A row counts its text's UTF-8 bytes, a null text none. The hash covers all columns, so rows
    that repeat an id spread as others do. Rows equal in every column share all bits:
    they stay together, as does a single text beyond the limit; such shards are marked oversized. All
    rows and columns stay; a column named like `out` is replaced. No rows give no shards.
    """
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    rows = rows.withColumn("hash", F.xxhash64("row")).withColumn(
        "bytes", F.coalesce(F.octet_length(F.col("row")[text_col]), F.lit(0)).cast("bigint")
    )
    narrow = rows.select("hash", "bytes")
    total = narrow.agg(F.sum("bytes")).first()[0] or 0
    bits = min(HASH_BITS, max(0, math.ceil(math.log2(max(1.0, total / limit)))) + SPARE_BITS)
    low, pending, levels = 0, narrow, []
    while True:
        cells = checkpointed(
            pending.groupBy(_prefix("hash", str(bits)).alias("cell")).agg(
                F.sum("bytes").alias("bytes"), F.min("hash").alias("lo"), F.max("hash").alias("hi")
            )
        )
        leaves = checkpointed(_leaves(cells, low, bits, limit))
        levels.append((bits, leaves))
        left = cells.join(leaves, "cell", "left_anti").select("cell")
        if bits == HASH_BITS or left.isEmpty():
            break
        pending = pending.withColumn("cell", _prefix("hash", str(bits))).join(left, "cell", "left_semi").drop("cell")
        low, bits = bits + 1, min(HASH_BITS, bits + MORE_BITS)
    depth, size = F.lit(None).cast("int"), F.lit(None).cast("bigint")
    for i, (bits, leaves) in enumerate(levels):
        named = leaves.select(
            F.col("cell").alias(f"cell{i}"), F.col("depth").alias(f"depth{i}"), F.col("shard_bytes").alias(f"bytes{i}")
        )
        rows = rows.withColumn("cell", _prefix("hash", str(bits)))
        rows = rows.join(named, rows["cell"] == named[f"cell{i}"], "left").drop("cell", f"cell{i}")
        depth, size = F.coalesce(depth, f"depth{i}"), F.coalesce(size, f"bytes{i}")
    bucket = F.struct(
        F.substring(F.lpad(F.bin("hash"), HASH_BITS, "0"), F.lit(1), depth).alias("id"),
        depth.alias("depth"),
        size.alias("bytes"),
        (size > limit).alias("oversized"),
    )
    kept = [F.col("row")[c].alias(c) for c in docs.columns if c != out]
    return rows.select(*kept, bucket.alias(out))


def write_shards(sharded: DataFrame, path: str, out: str = "shard") -> None:
    """One folder per shard; AQE splits none, so a shard is one file unless Spark retries."""
    named = sharded.withColumn("shard_id", F.concat(F.lit("b"), F.col(out)["id"])).drop(out)
    named.repartition("shard_id").write.mode("overwrite").partitionBy("shard_id").parquet(path)
