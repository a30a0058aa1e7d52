"""Mixing sources to target weights by Pfair scheduling, in DataFrame operations only.

Time runs in slots, and each slot takes one block of one source. With weight w, block j of a source is
released at floor(j / w) and due at ceil((j + 1) / w); earliest deadline first keeps every
source within one block of its share at any slot. Weights are rounded to whole slots of
a round of ROUND_SLOTS, by largest remainder. At the end of a round all shares come out
even, so the schedule of one round holds for all of them: it is found by a fold over its slots,
in one row of at most ROUND_SLOTS lanes, whatever the size of the corpus. A source's documents are cut evenly into its
blocks, so that it is neither early nor late at the end of any round.

Documents are numbered within their source by the MD5 of their id. The numbers come from
counts per hash range, and windows hold one range of one source, so a source with a third of all
rows is spread like all others.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from bazaarlake.llm.shared import checkpointed

ROUND_SLOTS = 1024
BLOCK_DOCS = 64
RANGE_ROWS = 10_000
OUTSIDE = -1


def natural_quotas(counts: DataFrame, max_share: float | None = None) -> DataFrame:
    """(source, n, quota) from (source, n): every source whole or, where the caller gives max_share,
    none above it in the mix.

    Such a share can only be held with more sources than fit into it; with fewer, all
    documents are in the mix. Sources above it get an equal quota, so that each is max_share of
    the result. As c cut sources need c * max_share < 1, the few largest settle the quota.
    """
    if max_share is None:
        return counts.select("source", "n", F.col("n").alias("quota"))
    total, sources = counts.agg(F.sum("n"), F.count("*")).first()
    cap = None
    if sources * max_share > 1:
        largest = counts.orderBy(F.desc("n")).limit(math.ceil(1 / max_share)).collect()
        rest, size = total, total  # what uncut sources hold, and the size of the mix
        for c, row in enumerate(largest, 1):
            if c * max_share >= 1 or row["n"] <= size * max_share:
                break
            rest -= row["n"]
            size = rest / (1 - c * max_share)
            cap = math.floor(size * max_share + 1e-9)
    quota = F.col("n") if cap is None else F.least(F.col("n"), F.lit(cap))
    return counts.select("source", "n", quota.cast("bigint").alias("quota"))


def given_quotas(counts: DataFrame, weights: DataFrame) -> DataFrame:
    """(source, n, quota) for weights (source, weight): the largest mix in which every source that is
    there has its share. Sources without a positive weight are not in it."""
    wanted = weights.where("weight > 0").groupBy(F.col("source").alias("wanted")).agg(F.sum("weight").cast("double").alias("weight"))
    known = counts.join(wanted, F.col("source").eqNullSafe(F.col("wanted")), "left")
    # n / weight: the size of the mix, per unit of weight, at which the source runs out.
    per_weight = known.agg(F.min(F.col("n") / F.col("weight"))).first()[0] or 0.0
    quota = F.least(F.col("n"), F.round(F.coalesce("weight", F.lit(0.0)) * per_weight))
    return known.select("source", "n", quota.cast("bigint").alias("quota"))


def _with_lanes(quotas: DataFrame, size: int, slots: int) -> DataFrame:
    """quotas with a lane number. Sources with at least a slot's worth, at most `slots` of them, have
    their own; all smaller ones share lane 0. Sources without a quota are in no lane (OUTSIDE)."""
    large = F.col("quota") * slots >= max(size, 1)
    own = quotas.where(large).select(
        F.col("source").alias("named"),
        F.row_number().over(Window.orderBy(F.desc("quota"), F.col("source").asc_nulls_first())).alias("own"),
    )
    return (
        quotas.join(own, F.col("source").eqNullSafe(F.col("named")), "left")
        .withColumn("lane", F.when(F.col("quota") > 0, F.coalesce("own", F.lit(0))).otherwise(OUTSIDE))
        .select("source", "n", "quota", "lane")
    )


def _lanes(quotas: DataFrame, size: int, slots: int) -> DataFrame:
    """(lane, quota, c): the slots c of a round each lane gets, by largest remainder, one at least."""
    exact = F.col("quota") * slots / size
    lanes = (
        quotas.where("quota > 0")
        .groupBy("lane")
        .agg(F.sum("quota").alias("quota"))
        .withColumn("low", F.greatest(F.lit(1), F.floor(exact)).cast("bigint"))
        .withColumn("missing", slots - F.sum("low").over(Window.partitionBy()))
        .withColumn("turn", F.row_number().over(Window.orderBy(F.desc(exact - F.col("low")), "lane")))
    )
    extra = F.when(F.col("turn") <= F.col("missing"), 1).otherwise(0)
    return lanes.select("lane", "quota", (F.col("low") + extra).alias("c"))


def _round(lanes: DataFrame, slots: int) -> DataFrame:
    """(lane, j, slot): earliest deadline first over the slots of one round. The fold keeps how many
    blocks each lane has had, and its choices."""
    pick = f"""
        array_min(transform(sequence(0, size(c) - 1), i -> if(
            s.done[i] < c[i] and floor(s.done[i] * {slots} / c[i]) <= t,
            named_struct('due', ceil((s.done[i] + 1) * {slots} / c[i]), 'i', i),
            null)))
    """
    # transform over one element names the pick, so that it is made once per slot.
    fold = f"""
        aggregate(
            slice(sequence(0, {slots} - 1), 1, if(size(c) = 0, 0, {slots})),
            named_struct('done', transform(c, x -> 0L), 'picks', cast(array() as array<int>)),
            (s, t) -> transform(array({pick}.i), p -> named_struct(
                'done', transform(s.done, (x, k) -> if(k = p, x + 1L, x)),
                'picks', array_append(s.picks, p)))[0],
            s -> s.picks)
    """
    one = lanes.agg(F.sort_array(F.collect_list(F.struct("lane", "c"))).alias("l")).where("size(l) > 0")
    picks = one.select(F.col("l.lane").alias("lanes"), F.col("l.c").alias("c")).select("lanes", F.expr(fold).alias("picks"))
    slot = picks.select("lanes", F.posexplode("picks").alias("slot", "i")).select(
        F.col("lanes")[F.col("i")].alias("lane"), "slot"
    )
    j = F.row_number().over(Window.partitionBy("lane").orderBy("slot")) - 1
    return slot.select("lane", j.cast("bigint").alias("j"), "slot")


def _numbered(rows: DataFrame, group: str, out: str) -> DataFrame:
    """rows with a column `out`, their number within the group in the order of key."""
    ranges = rows.groupBy(group, "range").agg(F.count("*").alias("n"))
    behind = Window.partitionBy(group).orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    first = ranges.withColumn("first", F.coalesce(F.sum("n").over(behind), F.lit(0))).drop("n")
    inside = Window.partitionBy(group, "range").orderBy("key", F.xxhash64("row"))
    numbered = rows.join(first, [group, "range"]).withColumn(out, F.col("first") + F.row_number().over(inside) - 1)
    return numbered.drop("first")


def _within_own_quota(rows: DataFrame) -> DataFrame:
    """rows; those of lane 0 beyond the quota of their own source are in no lane."""
    # A null source is told from '' by the sign in front.
    name = F.coalesce(F.concat(F.lit("="), F.col("source").cast("string")), F.lit(""))
    small = _numbered(rows.where("lane = 0").withColumn("name", name), "name", "own")
    lane = F.when(F.col("own") < F.col("own_quota"), F.col("lane")).otherwise(OUTSIDE)
    return rows.where("lane <> 0").unionByName(small.withColumn("lane", lane).drop("name", "own"))


def mix(
    docs: DataFrame,
    weights: DataFrame | None = None,
    id_col: str = "doc_id",
    source_col: str = "source",
    max_share: float | None = None,
    block_docs: int = BLOCK_DOCS,
    round_slots: int = ROUND_SLOTS,
    out: str = "mix",
) -> DataFrame:
    """docs with a struct column `out`: position (within the lane, from 0), in_mix, block,
    release, deadline, slot (null outside the mix). Sources whose quota is below 1 / round_slots of
    the mix share a lane, each with its own quota of rows; rows in no lane are numbered together.

    weights (source, weight) are the target; without them sources keep their natural share, all
    rows are in the mix, and only a given max_share cuts the sources above it. A null source is a source of its own; so is ''. Texts are not read, and null ids
    are ordered as the empty text. Rows that repeat an id, or repeat altogether, each
    have a position. All rows and columns stay; a column named like `out` is replaced. Without
    rows, or where no source has a weight, nothing is in the mix.
    """
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    rows = rows.select(
        "row",
        F.col("row")[source_col].alias("source"),
        F.md5(F.coalesce(F.col("row")[id_col].cast("string"), F.lit("")).cast("binary")).alias("key"),
    )
    counts = checkpointed(rows.groupBy("source").agg(F.count("*").alias("n")))
    quotas = natural_quotas(counts, max_share) if weights is None else given_quotas(counts, weights)
    size = quotas.agg(F.coalesce(F.sum("quota"), F.lit(0))).first()[0]
    quotas = checkpointed(_with_lanes(quotas, size, round_slots))
    # Rows that lane 0 does not take are numbered with those of no lane.
    most = quotas.groupBy(F.greatest("lane", F.lit(0))).agg(F.sum("n").alias("n")).agg(F.coalesce(F.max("n"), F.lit(0))).first()[0]
    lanes = checkpointed(_lanes(quotas, size, round_slots) if size else quotas.selectExpr("lane", "quota", "n as c").limit(0))
    rounds = max(1, math.ceil(size / (block_docs * round_slots)))

    digits = max(0, math.ceil(math.log(max(1, most / RANGE_ROWS), 16)))
    named = quotas.select(F.col("source").alias("named"), "lane", F.col("quota").alias("own_quota"))
    rows = rows.join(named, F.col("source").eqNullSafe(F.col("named"))).withColumn(
        "range", F.substring("key", 1, digits)
    )
    if not quotas.where("lane = 0 and quota < n").isEmpty():
        rows = _within_own_quota(rows)
    placed = _numbered(rows, "lane", "position").join(lanes, "lane", "left")
    placed = placed.withColumn("in_mix", F.coalesce(F.col("position") < F.col("quota"), F.lit(False)))
    block = F.expr(f"position * {rounds} * c div quota")
    placed = placed.withColumn("block", F.when(F.col("in_mix"), block)).withColumn("j", F.expr("block % c"))
    placed = placed.join(_round(lanes, round_slots), ["lane", "j"], "left")
    start = F.expr(f"(block div c) * {round_slots}")
    info = F.struct(
        "position",
        "in_mix",
        "block",
        (start + F.expr(f"floor(j * {round_slots} / c)")).alias("release"),
        (start + F.expr(f"ceil((j + 1) * {round_slots} / c)")).alias("deadline"),
        (start + F.col("slot")).alias("slot"),
    )
    columns = [F.col("row")[c].alias(c) for c in docs.columns if c != out]
    return placed.select(*columns, info.alias(out))
