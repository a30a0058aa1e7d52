"""Quality classifier: naive Bayes support vectors.

Features are indicators of hashed n-grams: words and word pairs, pairs and triples of word
shapes, and how much of the text repeats itself. Each is scaled by the log ratio of its
smoothed frequencies among good and bad labelled documents; the ratios are counted over all
labelled training rows. A linear hinge-loss model on the scaled indicators is fitted by dual
coordinate descent, and a logistic curve, fitted on rows the model has not seen, turns its
margin into a probability.

Only the descent runs on a sample, in one task: FIT_ROWS rows and FIT_FEATURES indicators or so, chosen
by the hash of the id. Ids, labels, languages and sources are no features.
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bazaarlake.llm.shared import INT, as_bytes, checkpointed, small_batches

BITS = 18
SIZE = 1 << BITS
FIT_ROWS = 20_000
FIT_FEATURES = 20_000_000
# Labels up to this many (some 12 bytes each) may be broadcast; more are joined by a shuffle.
BROADCAST_LABELS = 4_000_000
EPOCHS = 8
COST = 1.0
SMOOTHING = 1.0
REJECT_BELOW = 0.3

# Letters to a or A, digits to 9; all else stays. Bytes outside ASCII are parts of letters here.
SHAPE = bytes(
    0x61 if 0x61 <= b <= 0x7A or b >= 0x80 else 0x41 if 0x41 <= b <= 0x5A else 0x39 if 0x30 <= b <= 0x39 else b
    for b in range(256)
)
RUNS = re.compile(rb"([aA9])\1+")


def _shape(word: bytes) -> bytes:
    """The shape of a word, runs of one class shortened: 'Word12!!' is 'Aa9!!'."""
    return RUNS.sub(rb"\1", word.translate(SHAPE))


def _repeated(words: list[bytes]) -> int:
    """Tenths of the word triples that occurred before."""
    n = len(words) - 2
    if n < 1:
        return 0
    return 10 * (n - len(set(zip(words, words[1:], words[2:])))) // n


def indicators(text: bytes | None, shapes: dict[bytes, bytes]) -> np.ndarray:
    """Sorted distinct feature numbers of a text."""
    raw = (text or b"").split()
    words = [w.lower() for w in raw]
    crc = zlib.crc32
    grams = set(words)
    grams.update(map(b" ".join, zip(words, words[1:])))
    found = {crc(g) for g in grams}
    form = []
    for w in raw:
        s = shapes.get(w)
        if s is None:
            s = _shape(w)
            if len(shapes) < 200_000:
                shapes[w] = s
        form.append(s)
    tri = set(zip(form, form[1:], form[2:]))
    tri.update(zip(form, form[1:]))
    found.update(crc(b"\0".join(g), 1) for g in tri)
    found.update(crc(s, 2) for s in set(form))
    if words:
        found.add(crc(b"repeated %d" % _repeated(words), 3))
    return np.unique(np.fromiter(found, np.int64, len(found)) & (SIZE - 1))


@F.arrow_udf(T.ArrayType(INT))
def _indicators(texts: pa.Array) -> pa.Array:
    shapes: dict[bytes, bytes] = {}
    return pa.array([indicators(t, shapes).astype(np.int32) for t in as_bytes(texts)], pa.list_(pa.int32()))


def _class_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per feature, documents of either class that have it: summed per task."""
    counts = np.zeros((2, SIZE), np.int64)
    for batch in batches:
        y = batch.column(0).to_numpy(zero_copy_only=False)
        lists = batch.column(1)
        values = lists.flatten().to_numpy(zero_copy_only=False)
        owner = np.repeat(y, lists.value_lengths().to_numpy(zero_copy_only=False))
        for c in (0, 1):
            counts[c] += np.bincount(values[owner == c], minlength=SIZE)
    some = np.flatnonzero(counts.any(axis=0))
    yield pa.RecordBatch.from_arrays(
        [pa.array(some), pa.array(counts[0, some]), pa.array(counts[1, some])], names=["feature", "bad", "good"]
    )


@dataclass
class QualityModel:
    """weights of the indicators (ratios multiplied in), bias, and the curve's slope and offset."""

    weights: np.ndarray
    bias: float
    slope: float
    offset: float

    def margin(self, features: np.ndarray) -> float:
        return float(self.weights[features].sum()) / math.sqrt(max(1, len(features))) + self.bias

    def probability(self, features: np.ndarray) -> float:
        z = self.slope * self.margin(features) + self.offset
        return 1 / (1 + math.exp(-z)) if z > -700 else 0.0


def _descend(rows: list[np.ndarray], y: np.ndarray, ratio: np.ndarray) -> tuple[np.ndarray, float]:
    """Dual coordinate descent for the hinge loss, classes weighted evenly."""
    w, bias = np.zeros(SIZE), 0.0
    alpha = np.zeros(len(rows))
    share = max(1e-9, float((y > 0).mean()))
    bound = np.where(y > 0, 0.5 / share, 0.5 / max(1e-9, 1 - share)) * COST
    rng = np.random.default_rng(8)
    for _ in range(EPOCHS):
        moved = 0.0
        for i in rng.permutation(len(rows)):
            f = rows[i]
            x = ratio[f] / math.sqrt(max(1, len(f)))
            slack = y[i] * (float(w[f] @ x) + bias) - 1
            new = min(max(alpha[i] - slack / (float(x @ x) + 1.0), 0.0), bound[i])
            step = (new - alpha[i]) * y[i]
            if step:
                w[f] += step * x
                bias += step
                alpha[i] = new
                moved = max(moved, abs(step))
        if moved < 1e-3:
            break
    return w * ratio, bias


def _curve(margin: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Logistic regression of the label on the margin: Newton steps, smoothed targets."""
    good, bad = int((y > 0).sum()), int((y <= 0).sum())
    target = np.where(y > 0, (good + 1) / (good + 2), 1 / (bad + 2))
    a, b = 1.0, math.log((good + 1) / (bad + 1))
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a * margin + b, -35, 35)))
        g = np.array([(margin * (p - target)).sum() + 1e-3 * a, (p - target).sum()])
        v = p * (1 - p)
        h = np.array([[(v * margin * margin).sum() + 1e-3, (v * margin).sum()], [(v * margin).sum(), v.sum() + 1e-6]])
        step = np.linalg.solve(h, g)
        step *= min(1.0, 2.0 / max(1e-9, np.abs(step).max()))
        a, b = a - step[0], b - step[1]
        if np.abs(step).max() < 1e-7:
            break
    return float(max(a, 1e-3)), float(b)


# Rows of a fitted model: cells below SIZE are weights, these are the rest of it.
BIAS, SLOPE, OFFSET = SIZE, SIZE + 1, SIZE + 2


def _fit_sample(ratio: np.ndarray):
    """The model of the sample in one task's batches (rank, y, features), as (cell, value)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranks, ys, rows = [], [], []
        for batch in batches:
            ranks.append(batch.column(0).to_numpy(zero_copy_only=False))
            ys.append(batch.column(1).to_numpy(zero_copy_only=False))
            lists = batch.column(2)
            values = lists.flatten().to_numpy(zero_copy_only=False)
            rows += np.split(values, np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False))[:-1])
        if not rows:
            return
        order = np.argsort(np.concatenate(ranks), kind="stable")
        rows = [rows[i] for i in order]
        y = np.where(np.concatenate(ys)[order] > 0, 1.0, -1.0)
        # Every fifth row is kept from the descent for the curve.
        for_curve = np.arange(len(y)) % 5 == 4
        if len(set(y[~for_curve])) < 2 or not for_curve.any():
            for_curve = np.zeros(len(y), bool)
        weights, bias = _descend([r for r, c in zip(rows, for_curve) if not c], y[~for_curve], ratio)
        model = QualityModel(weights, bias, 1.0, 0.0)
        use = for_curve if for_curve.any() else ~for_curve
        slope, offset = _curve(np.array([model.margin(r) for r, u in zip(rows, use) if u]), y[use])
        some = np.flatnonzero(weights)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.concatenate([some, [BIAS, SLOPE, OFFSET]])),
                pa.array(np.concatenate([weights[some], [bias, slope, offset]])),
            ],
            names=["cell", "value"],
        )

    return run


def fit(
    docs: DataFrame,
    labels: DataFrame,
    train: Column | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
    fit_rows: int = FIT_ROWS,
    fit_features: int = FIT_FEATURES,
) -> QualityModel:
    """A model from the labelled rows of docs; train, a condition on the id column, picks
    those it may learn from. Labels other than 0 and 1, null ids and null texts are ignored, an
    id with several labels has the smaller. Without rows of both classes the score is the
    smoothed share of label 1."""
    known = labels.where(F.col(id_col).isNotNull() & F.col(label_col).isin(0, 1))
    known = known.groupBy(F.col(id_col).alias("id")).agg(F.min(label_col).cast("int").alias("y"))
    rows = small_batches(docs if train is None else docs.where(train))
    rows = rows.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).where("id is not null and text is not null")
    known = checkpointed(known)
    if known.count() <= BROADCAST_LABELS:
        known = F.broadcast(known)
    features = checkpointed(rows.join(known, "id").select("id", "y", _indicators("text").alias("features")))
    total = {r["y"]: (r["n"], r["f"]) for r in features.groupBy("y").agg(F.count("*").alias("n"), F.sum(F.size("features")).alias("f")).collect()}
    good, bad = total.get(1, (0, 0))[0], total.get(0, (0, 0))[0]
    if not good or not bad:
        p = (good + 1) / (good + bad + 2)
        return QualityModel(np.zeros(SIZE), 0.0, 1.0, math.log(p / (1 - p)))
    counts = (
        features.select("y", "features")
        .mapInArrow(_class_counts, "feature bigint, bad bigint, good bigint")
        .groupBy("feature")
        .agg(F.sum("bad").alias("bad"), F.sum("good").alias("good"))
        .toPandas()  # SIZE rows at most
    )
    p, q = np.full(SIZE, SMOOTHING), np.full(SIZE, SMOOTHING)
    p[counts["feature"]] += counts["good"].to_numpy()
    q[counts["feature"]] += counts["bad"].to_numpy()
    ratio = np.log((p / (good + 2 * SMOOTHING)) / (q / (bad + 2 * SMOOTHING)))
    share = min(1.0, fit_rows / (good + bad), fit_features / max(1, sum(f for _, f in total.values())))
    rank = F.xxhash64("id")
    sample = features.where(F.pmod(rank, F.lit(1 << 20)) < math.ceil(share * (1 << 20))).select(
        rank.alias("rank"), "y", "features"
    )
    cells = sample.repartition(1).mapInArrow(_fit_sample(ratio), "cell bigint, value double").toPandas()
    if not len(cells):  # a sample of a few rows may miss all
        p = (good + 1) / (good + bad + 2)
        return QualityModel(np.zeros(SIZE), 0.0, 1.0, math.log(p / (1 - p)))
    model = np.zeros(SIZE + 3)
    model[cells["cell"]] = cells["value"]
    return QualityModel(model[:SIZE], *(float(model[c]) for c in (BIAS, SLOPE, OFFSET)))


def score(docs: DataFrame, model: QualityModel, text_col: str = "text", out: str = "quality_score") -> DataFrame:
    """docs with a column `out`, the probability of label 1. Null and empty texts have no
    indicators and get the model's score for none. All rows and columns stay; one named like `out` is
    replaced."""

    @F.arrow_udf("double")
    def probability(texts: pa.Array) -> pa.Array:
        shapes: dict[bytes, bytes] = {}
        return pa.array([model.probability(indicators(t, shapes)) for t in as_bytes(texts)], pa.float64())

    return small_batches(docs).withColumn(out, probability(F.col(text_col)))
