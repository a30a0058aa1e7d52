"""Near-duplicate classes: fast similarity sketches, banding, exact verification.

A document is the set of its distinct five-word shingles, held as 64-bit hashes. Its sketch has
192 coordinates. In round i every shingle falls into one hashed bin with the value
(i, hash); a coordinate keeps its smallest value. Rounds go on until all coordinates are
filled; after 192 of them, round 192 + j puts every shingle into bin j, so that every
coordinate is filled with certainty. A coordinate of two sets agrees with the probability
of their similarity, and the number that agree is concentrated about it.

Four coordinates make a band, 48 bands a document. Sets that share a band are candidates;
a pair at similarity 0.75 shares none with probability (1 - 0.75^4)^48, about 1e-8.
Candidates are confirmed on their full sets.

Equal sets become one row first, so that copies cost nothing. Inside a band nobody is paired with
everybody: each set is checked against the hub of its band, and sets that became one class
need no more checks. Only what is left in different classes is compared, by the
bits of the sketch and then exactly, without a cap; where large groups are left, inside the join.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bazaarlake.llm.components import connected_components
from bazaarlake.llm.shared import LONG, as_bytes, checkpointed, small_batches, space_words, struct

WIDTH = 5
BANDS, ROWS = 48, 4
SIZE = BANDS * ROWS
WORDS64 = SIZE // 64
# Similarity: 100 * intersection >= PERCENT * union.
PERCENT = 75
# Differing sketch bits of a pair at similarity 0.75: 24 on average, deviation 4.6. Beyond this
# bound, 5.6 deviations up, a pair is no candidate of the exhaustive comparison.
FAR_BITS = 50
# What is left in bands of up to so many sets is compared band by band; in larger ones, where
# the same sets meet in many bands, once for all bands together.
SMALL_BAND = 32

# Sets of such a group that one task compares with all others of it.
BLOCK_SETS = 1024


def _mix(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


SEEDS = _mix(np.arange(1, 2 * SIZE + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
BAND_SEEDS = _mix(np.arange(1, BANDS + 1, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def shingle_hashes(text: bytes | None, width: int = WIDTH) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the shingles; a shorter text is one shingle."""
    words = space_words(text)
    if not words:
        return np.empty(0, np.uint64)
    line = b" ".join(words)
    if len(words) <= width:
        return np.array([xxhash.xxh3_64_intdigest(line)], np.uint64)
    ends = np.cumsum([len(w) + 1 for w in words])
    starts = np.concatenate(([0], ends[:-width]))
    digest = xxhash.xxh3_64_intdigest
    hashes = [digest(line[a:b]) for a, b in zip(starts.tolist(), (ends[width - 1 :] - 1).tolist())]
    return np.unique(np.array(hashes, np.uint64))


def sketch(hashes: np.ndarray) -> np.ndarray:
    """The 192 coordinates of a non-empty set."""
    out = np.zeros(SIZE, np.uint64)
    filled = np.zeros(SIZE, bool)
    step = max(1, 2048 // len(hashes))
    for first in range(0, SIZE, step):
        rounds = np.arange(first, min(first + step, SIZE))
        values = _mix(hashes[None, :] ^ SEEDS[rounds][:, None])
        bins = ((values >> np.uint64(32)) % np.uint64(SIZE)).astype(np.intp)
        # Smallest (round, value) last, so that it is what stays in its bin.
        key = ((rounds - first).astype(np.uint64)[:, None] << np.uint64(52)) | (values >> np.uint64(12))
        order = np.argsort(key, axis=None)[::-1]
        new = np.zeros(SIZE, np.uint64)
        hit = np.zeros(SIZE, bool)
        bins = bins.ravel()[order]
        new[bins] = values.ravel()[order]
        hit[bins] = True
        take = hit & ~filled
        out[take] = new[take]
        filled |= hit
        if filled.all():
            return out
    for j in np.flatnonzero(~filled):
        out[j] = _mix(hashes ^ SEEDS[SIZE + j]).min()
    return out


def band_keys(coordinates: np.ndarray) -> np.ndarray:
    rows = coordinates.reshape(BANDS, ROWS)
    key = BAND_SEEDS
    for r in range(ROWS):
        key = _mix(key ^ rows[:, r])
    return key


def has_words(text: Column) -> Column:
    return F.coalesce(text.rlike("[^\\x20\\x09-\\x0D]"), F.lit(False))


def set_id(hashes: np.ndarray) -> int:
    return xxhash.xxh3_64_intdigest(hashes.tobytes())


@F.arrow_udf(struct(n=LONG, set_id=LONG, bits=T.ArrayType(LONG), keys=T.ArrayType(LONG)))
def _fingerprint(texts: pa.Array) -> pa.Array:
    n, ids, bits, keys = [], [], [], []
    for text in as_bytes(texts):
        hashes = shingle_hashes(text)
        n.append(len(hashes))
        ids.append(set_id(hashes))
        if len(hashes):
            coordinates = sketch(hashes)
            bits.append(np.packbits((coordinates & np.uint64(1)).astype(np.uint8)).view(np.int64))
            keys.append(band_keys(coordinates).view(np.int64))
        else:
            bits.append(None)
            keys.append(None)
    return pa.StructArray.from_arrays(
        [
            pa.array(n, pa.int64()),
            pa.array(np.array(ids, np.uint64).view(np.int64)),
            pa.array(bits, pa.list_(pa.int64())),
            pa.array(keys, pa.list_(pa.int64())),
        ],
        names=["n", "set_id", "bits", "keys"],
    )


@F.arrow_udf(struct(n=LONG, set_id=LONG))
def _set_id(texts: pa.Array) -> pa.Array:
    n, ids = [], []
    for text in as_bytes(texts):
        hashes = shingle_hashes(text)
        n.append(len(hashes))
        ids.append(set_id(hashes))
    return pa.StructArray.from_arrays(
        [pa.array(n, pa.int64()), pa.array(np.array(ids, np.uint64).view(np.int64))], names=["n", "set_id"]
    )


@F.arrow_udf(struct(set_id=LONG, hashes=T.ArrayType(LONG)))
def _full_set(texts: pa.Array) -> pa.Array:
    ids, sets = [], []
    for text in as_bytes(texts):
        hashes = shingle_hashes(text)
        ids.append(set_id(hashes))
        sets.append(hashes.view(np.int64))
    return pa.StructArray.from_arrays(
        [
            pa.array(np.array(ids, np.uint64).view(np.int64)),
            pa.array(sets, pa.list_(pa.int64())),
        ],
        names=["set_id", "hashes"],
    )


def _pairs(rows: DataFrame, one: str, other: str) -> DataFrame:
    """Distinct pairs (a, b), a < b."""
    return (
        rows.where(F.col(one) != F.col(other))
        .select(F.least(one, other).alias("a"), F.greatest(one, other).alias("b"))
        .distinct()
    )


def _similar(set_a: str, set_b: str) -> Column:
    both = F.size(F.array_intersect(set_a, set_b))
    return both * 100 >= (F.size(set_a) + F.size(set_b) - both) * PERCENT


def _confirmed(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs whose full sets are similar enough."""
    a = sets.select(F.col("set_id").alias("a"), F.col("hashes").alias("set_a"))
    b = sets.select(F.col("set_id").alias("b"), F.col("hashes").alias("set_b"))
    return pairs.join(a, "a").join(b, "b").where(_similar("set_a", "set_b")).select("a", "b")


def _mixed(members: DataFrame, classes: DataFrame) -> DataFrame:
    """The members of bands whose sets are still in different classes, with the size of the band."""
    known = members.join(classes.withColumnRenamed("node", "set_id"), "set_id", "left").withColumn(
        "component", F.coalesce("component", "set_id")
    )
    mixed = (
        known.groupBy("key")
        .agg(F.min("component").alias("lo"), F.max("component").alias("hi"), F.count("*").alias("sets"))
        .where("lo <> hi")
        .select("key", "sets")
    )
    return known.join(mixed, "key")


def _near_bits() -> Column:
    differ = sum(
        (F.bit_count(F.col("x.bits")[i].bitwiseXOR(F.col("y.bits")[i])) for i in range(WORDS64)),
        F.lit(0),
    )
    return (
        (F.col("x.set_id") < F.col("y.set_id"))
        & (F.col("x.component") != F.col("y.component"))
        & (F.least("x.n", "y.n") * 100 >= F.greatest("x.n", "y.n") * PERCENT)
        & (differ <= FAR_BITS)
    )


def _left_in_small(left: DataFrame) -> DataFrame:
    """Members of one band in different classes whose sketch bits are near enough."""
    me = F.struct("set_id", "n", "component", "bits")
    x, y = left.select("key", me.alias("x")), left.select("key", me.alias("y"))
    return _pairs(x.join(y, "key").where(_near_bits()), "x.set_id", "y.set_id")


def _left_in_large(left: DataFrame, sets: DataFrame) -> DataFrame:
    """Links between classes in large bands. Bands that share sets make one group, so that a set
    is there once and not once a band. Pairs are confirmed inside the join, which gives
    out nothing but links."""
    low = left.groupBy("key").agg(F.min("set_id").alias("low"))
    lows = left.join(low, "key").select("set_id", "low")
    # A set goes with the smallest of its lows; only those lows are linked that a set has in common.
    mine = lows.groupBy("set_id").agg(F.min("low").alias("mine"))
    linked = lows.join(mine, "set_id").select(F.col("low").alias("a"), F.col("mine").alias("b"))
    groups = connected_components(linked).select(F.col("node").alias("mine"), F.col("component").alias("of"))
    nodes = left.groupBy("set_id").agg(*[F.first(c).alias(c) for c in ("n", "component", "bits")])
    rows = nodes.join(mine, "set_id").join(groups, "mine", "left")
    rows = rows.withColumn("of", F.coalesce("of", "mine")).drop("mine").join(sets, "set_id")
    # A large group is dealt out in blocks, and each block meets all sets of the group. The blocks are
    # the tasks: cutting both sides further, as for a skewed join, would multiply tasks.
    blocks = rows.groupBy("of").agg(F.ceil(F.count("*") / BLOCK_SETS).cast("int").alias("blocks"))
    me = F.struct("set_id", "n", "component", "bits", "hashes")
    rows = rows.join(blocks, "of").withColumn("me", me)
    x = rows.select("of", F.pmod(F.xxhash64("set_id"), "blocks").alias("block"), F.col("me").alias("x"))
    y = rows.select("of", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), F.col("me").alias("y"))
    near = (x["of"] == y["of"]) & (x["block"] == y["block"]) & _near_bits() & _similar("x.hashes", "y.hashes")
    x, y = x.repartition("of", "block"), y.repartition("of", "block")
    return x.join(y, near).select(F.col("x.set_id").alias("a"), F.col("y.set_id").alias("b"))


def _sets(rows: DataFrame, *more: Column) -> DataFrame:
    """One row per set of shingles among rows (doc_id, text): smallest id, size, sketch bits and bands."""
    # Rows without a word go by their text: a filter on the sketch would have it made twice.
    worded = rows.where(has_words(F.col("text")))
    sketched = worded.withColumn("f", _fingerprint("text")).select(*[c for c in rows.columns if c != "text"], "f.*")
    return checkpointed(
        sketched.groupBy("set_id")
        .agg(
            F.min("doc_id").alias("doc_id"),
            *[F.first(c).alias(c) for c in ("n", "bits", "keys")],
            *more,
        )
    )


def near_duplicate_sets(sets: DataFrame, docs: DataFrame) -> DataFrame:
    """(node, component) of the set ids that are linked with another set."""
    banded = sets.select("set_id", F.explode("keys").alias("key"))
    shared = banded.groupBy("key").agg(F.min("set_id").alias("hub"), F.max("set_id").alias("hi"))
    members = checkpointed(banded.join(shared.where("hub <> hi").drop("hi"), "key"))
    ids = members.select("set_id").distinct()
    wanted = sets.join(ids, "set_id", "left_semi").select(
        F.col("set_id").alias("wanted"), F.col("doc_id").alias("wanted_doc")
    )
    # Sets again from the texts, for candidates alone: less to move than the sets of all. An id that
    # repeats brings sets that nobody asks for; they do no harm.
    full = checkpointed(
        docs.join(wanted, F.col("doc_id").eqNullSafe(F.col("wanted_doc")))
        .select(_full_set("text").alias("full"))
        .select("full.*")
        .dropDuplicates(["set_id"])
    )
    to_hubs = _confirmed(_pairs(members, "set_id", "hub"), full)
    classes = connected_components(to_hubs)
    left = _mixed(members.drop("hub"), classes)
    left = checkpointed(left.join(sets.select("set_id", "n", "bits"), "set_id"))
    small = _confirmed(_left_in_small(left.where(F.col("sets") <= SMALL_BAND)), full)
    large = _left_in_large(left.where(F.col("sets") > SMALL_BAND), full)
    return connected_components(_links(classes).unionByName(small).unionByName(large))


def _links(classes: DataFrame) -> DataFrame:
    return classes.select(F.col("node").alias("a"), F.col("component").alias("b"))


def _components(sets: DataFrame, docs: DataFrame) -> DataFrame:
    """sets with the set id of their class."""
    classes = near_duplicate_sets(sets, docs)
    node = classes.select(F.col("node").alias("set_id"), "component")
    return sets.join(node, "set_id", "left").withColumn("component", F.coalesce("component", "set_id"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of docs: doc_id, n_shingles, component_id, kept.

    component_id is the smallest id among all documents that links of similarity 0.75 or more
    lead to, the document included; kept marks the document that carries it.

    A null or empty text, or one of white space, has no shingles and is linked with nothing.
    Fewer than five words are one shingle. Rows that repeat an id each get a row, and a text
    each; ids that are null take part in links but are no smallest id, and are kept only
    where a class has no other id. Other columns of docs are not read. No rows give no rows.
    """
    plain = small_batches(docs).select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    sets = _sets(plain)
    labelled = _components(sets.select("set_id", "doc_id", "n", "bits", "keys"), plain).select("set_id", "doc_id", "component")
    lowest = labelled.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    by_set = labelled.join(lowest, "component").select("set_id", "component_id")
    component_id = F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    # The set of each row once more, without its sketch: cheaper than keeping all until here.
    return (
        plain.withColumn("f", _set_id("text"))
        .select("doc_id", "f.*")
        .join(by_set, "set_id", "left")
        .select(
            "doc_id",
            F.col("n").alias("n_shingles"),
            component_id.alias("component_id"),
            F.col("doc_id").eqNullSafe(component_id).alias("kept"),
        )
    )


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of docs, one of each near-duplicate class: that with the smallest id, of equal ids
    that with the smallest hash of the row, and of rows equal in every column one. Rows without a
    word are in no class, and all stay. Columns stay as they are."""
    key = F.concat_ws(":", F.col(id_col).cast("string"), F.xxhash64(*[F.col(f"`{c}`") for c in docs.columns]).cast("string"))
    rows = small_batches(docs).select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
        key.alias("key"),
        F.col(id_col).alias("doc_id"),
        F.col(text_col).alias("text"),
    )
    order = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "row_key")
    sets = _sets(rows.select("doc_id", F.col("key").alias("row_key"), "text"), F.min(order).alias("first"))
    keep = (
        _components(sets, rows.select("doc_id", "text"))
        .groupBy("component")
        .agg(F.min("first").alias("first"))
        .select(F.col("first.row_key").alias("key"))
    )
    words = has_words(F.col("text"))
    one = rows.where(words).join(keep, "key", "left_semi").dropDuplicates(["key"])
    return one.select("row.*").unionByName(rows.where(~words).select("row.*"))
