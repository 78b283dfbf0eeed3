"""Quality classifier: Naive Bayes support vectors (NB-SVM).

A document is its set of shape n-grams: a word becomes its shape (runs of
upper case, lower case, digits and each punctuation mark), a repeated word a
repeat mark, and the 1- to 4-grams of these tokens inside the document are the
indicators. Indicators are hashed to ``DIM`` buckets.

Training: Spark counts every indicator per class over all training rows; the
class log-count ratios scale the indicators; a linear hinge-loss model is fitted by
dual coordinate descent on a bounded sample of labelled rows (``SAMPLE`` rows of
least hash) and Platt-scaled on a part of that sample left out of the fit. The counts are
``DIM`` numbers per class however large the corpus is.

Defined cases: null and empty texts have one indicator (no words) and get a score;
documents without labels, or with a null label, are scored and not learned from;
several labels of one document count once each; with one class only, every score is
that class's smoothed share; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skyvane.llm._tables import begin, of_least_hash, read, small
from skyvane.llm._text import SPACE, U64, Words, buffers, doc_groups, mix
from skyvane.session import materialize

DIM = 1 << 18
ORDERS = (1, 2, 3, 4)
SAMPLE = 16_000
FOLDS = 5
THRESHOLD = 0.3

_SHAPE = np.arange(256, dtype=np.uint8)
_SHAPE[48:58] = ord("9")
_SHAPE[65:91] = ord("X")
_SHAPE[97:123] = ord("x")
_SHAPE[128:] = ord("x")
_SHAPE[SPACE] = 32
_REPEAT = U64(0x2545F4914F6CDD1D)


def shape_tokens(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per word of the documents a token hash, and where each document's words begin."""
    words = Words(data, off, lower=True)
    shape = _SHAPE[data]
    keep = np.ones(len(shape), bool)
    keep[1:] = shape[1:] != shape[:-1]
    inner = off[(off > 0) & (off < len(data))]
    keep[inner] = True
    small = shape[keep]
    new_off = np.concatenate([[0], np.cumsum(keep)])[off]
    shapes = Words(small, new_off)
    h = shapes.hash.copy()
    if len(h):
        first = np.zeros(len(h), bool)
        first[words.first[:-1][words.first[:-1] < len(h)]] = True
        same = np.zeros(len(h), bool)
        same[1:] = words.hash[1:] == words.hash[:-1]
        h[same & ~first] = _REPEAT
    return h, words.first


def indicators(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct indicator buckets of each document as CSR (pointers, buckets)."""
    h, first = shape_tokens(data, off)
    n = len(off) - 1
    doc = np.repeat(np.arange(n), np.diff(first))
    cells = [np.arange(n, dtype=np.int64)[np.diff(first) == 0] * DIM]          # no words
    acc = np.zeros(len(h), U64)
    for k in range(1, max(ORDERS) + 1):
        acc = acc * U64(0x9E3779B97F4A7C15)
        acc = acc[:len(h) - k + 1] + h[k - 1:] if k > 1 else h.copy()
        if not len(acc):
            break
        inside = doc[:len(acc)] == doc[k - 1:]
        bucket = (mix(acc + U64(k)) >> U64(46)).astype(np.int64)
        cells.append(np.unique((doc[:len(acc)] * DIM + bucket)[inside]))
    cells = np.unique(np.concatenate(cells))
    return np.searchsorted(cells, np.arange(n + 1) * DIM), cells % DIM


def fold_of(doc_id: str = "doc_id", folds: int = FOLDS) -> Column:
    """crc32 of the id's text modulo the number of folds; null ids belong to fold 0."""
    return F.coalesce(F.pmod(F.crc32(F.col(doc_id).cast("string").cast("binary")), F.lit(folds)), F.lit(0)).cast("int")


def cells_of(text: pa.Array) -> pa.Array:
    """The indicator buckets of each whole text, as packed 32-bit numbers."""
    data, off = buffers(text)
    out: list[bytes] = []
    for lo, hi in doc_groups(off):
        ptr, cells = indicators(data[off[lo]:off[hi]], off[lo:hi + 1] - off[lo])
        cells = cells.astype("<i4")
        out += [cells[x:y].tobytes() for x, y in zip(ptr[:-1], ptr[1:])]
    return pa.array(out, pa.binary())


def features(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """(doc_id, cells) of every document: the one pass over the texts."""
    cells = F.arrow_udf(cells_of, "binary")
    return docs.select(F.col(doc_id).alias("doc_id"), cells(F.col(text).cast("string")).alias("cells"))


def _csr(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    data, off = buffers(col)
    return off // 4, np.frombuffer(data.tobytes(), "<i4").astype(np.int64)


def _class_counts(rows: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Documents per class, and documents with each indicator per class, over all training rows."""
    def count(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, docs = np.zeros((2, DIM), np.int64), np.zeros(2, np.int64)
        for b in it:
            y = b.column(1).to_numpy(zero_copy_only=False)
            ptr, cells = _csr(b.column(0))
            label = np.repeat(y, np.diff(ptr))
            for c in (0, 1):
                seen[c] += np.bincount(cells[label == c], minlength=DIM)
                docs[c] += int((y == c).sum())
        used = np.flatnonzero(seen.sum(0))
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.append(used, -1)), *[pa.array(np.append(seen[c][used], docs[c])) for c in (0, 1)]],
            names=["bucket", "n0", "n1"])

    got = rows.select("cells", "label").mapInArrow(count, "bucket long, n0 long, n1 long").groupBy("bucket").agg(
        F.sum("n0").alias("n0"), F.sum("n1").alias("n1")).toPandas()          # at most DIM + 1 rows
    out = np.zeros((2, DIM + 1), np.int64)
    if len(got):
        out[0, got["bucket"]], out[1, got["bucket"]] = got["n0"], got["n1"]
    return out[:, -1], out[:, :DIM]


def dual_coordinate_descent(ptr, idx, val, y, c: float = 0.3, epochs: int = 12, seed: int = 1) -> np.ndarray:
    """Linear L1-loss SVM (Hsieh et al. 2008) over CSR rows; returns the weights.

    One coordinate, the dual variable of one example, is solved exactly at a time."""
    w = np.zeros(DIM)
    q = np.array([float(val[idx[a:b]] @ val[idx[a:b]]) for a, b in zip(ptr[:-1], ptr[1:])])
    alpha = np.zeros(len(y))
    # classes weigh the same, so a rare class still shapes the margin
    share = np.array([max(1, (y < 0).sum()), max(1, (y > 0).sum())]) / max(1, len(y))
    cap = np.where(y > 0, c * 0.5 / share[1], c * 0.5 / share[0])
    rng = np.random.default_rng(seed)
    for _ in range(epochs):
        moved = 0.0
        for i in rng.permutation(len(y)):
            if q[i] <= 0:
                continue
            j = idx[ptr[i]:ptr[i + 1]]
            g = y[i] * (w[j] @ val[j]) - 1.0
            a = min(max(alpha[i] - g / q[i], 0.0), cap[i])
            if a != alpha[i]:
                w[j] += (a - alpha[i]) * y[i] * val[j]
                moved = max(moved, abs(a - alpha[i]))
                alpha[i] = a
        if moved < 1e-3:
            break
    return w


def platt(margin: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Logistic calibration of margins with smoothed targets, by Newton steps."""
    pos, neg = (y > 0).sum(), (y <= 0).sum()
    t = np.where(y > 0, (pos + 1) / (pos + 2), 1 / (neg + 2))
    a, b = 1.0, float(np.log((pos + 1) / (neg + 1)))
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(a * margin + b, -35, 35)))
        ga, gb = ((p - t) * margin).sum() + 1e-3 * a, (p - t).sum()
        s = p * (1 - p) + 1e-9
        haa, hab, hbb = (s * margin ** 2).sum() + 1e-3, (s * margin).sum(), s.sum()
        det = haa * hbb - hab * hab
        da, db = (hbb * ga - hab * gb) / det, (haa * gb - hab * ga) / det
        step = min(1.0, 4.0 / max(abs(da), abs(db), 1e-12))
        a, b = a - step * da, b - step * db
        if max(abs(da), abs(db)) < 1e-8:
            break
    return max(a, 0.0), b


class Model:
    """weights per bucket (log-count ratio times SVM weight) and the calibration."""

    def __init__(self, weights: np.ndarray, a: float, b: float) -> None:
        self.weights, self.a, self.b = weights, a, b

    def margin(self, ptr: np.ndarray, cells: np.ndarray) -> np.ndarray:
        # each row's own sum: a difference of prefix sums would depend on the rows before it in the batch
        n = np.diff(ptr)
        total = np.bincount(np.repeat(np.arange(len(n)), n), weights=self.weights[cells], minlength=len(n))
        return total / np.sqrt(np.maximum(1, n))

    def score(self, cells: pa.Array) -> pa.Array:
        m = self.margin(*_csr(cells))
        return pa.array(1 / (1 + np.exp(-np.clip(self.a * m + self.b, -35, 35))))


def train(rows: DataFrame, sample: int = SAMPLE, alpha: float = 1.0) -> Model:
    """Fit from (doc_id, cells, label in 0/1). At most ``sample`` rows reach the driver; counts
    are over all rows."""
    docs, seen = _class_counts(rows)
    if not docs.all():
        share = (docs[1] + 1) / (docs.sum() + 2)
        return Model(np.zeros(DIM), 0.0, float(np.log(share / (1 - share))))
    p, q = seen[1] + alpha, seen[0] + alpha
    ratio = np.log(p / (docs[1] + 2 * alpha)) - np.log(q / (docs[0] + 2 * alpha))
    ratio[seen.sum(0) == 0] = 0.0
    few = of_least_hash(rows, F.col("doc_id"), sample, int(docs.sum()))
    got = (few.withColumn("h", F.xxhash64("doc_id")).orderBy("h", "doc_id", "label").limit(sample)
           .select("cells", "label", "h").toPandas().sort_values(["h", "label"], kind="stable"))
    y = np.where(got["label"].to_numpy() == 1, 1.0, -1.0)
    cells = [np.frombuffer(x, "<i4") for x in got["cells"]]
    held = np.arange(len(y)) % 4 == 3                       # for the calibration
    fit = np.flatnonzero(~held)
    idx = np.concatenate([cells[i] for i in fit])
    ptr = np.concatenate([[0], np.cumsum([len(cells[i]) for i in fit])])
    w = dual_coordinate_descent(ptr, idx, ratio / np.sqrt(max(1.0, len(idx) / len(fit))), y[fit])
    model = Model(w * ratio, 1.0, 0.0)
    margins = model.margin(np.concatenate([[0], np.cumsum([len(x) for x in cells])]), np.concatenate(cells))
    use = held if len(set(y[held])) == 2 else np.ones(len(y), bool)
    model.a, model.b = platt(margins[use], y[use])
    return model


def scorer(spark: SparkSession, model: Model):
    """A column function: cells -> score."""
    shared = spark.sparkContext.broadcast(model)             # DIM weights: 2 MB

    def run(cells: pa.Array) -> pa.Array:
        return shared.value.score(cells)
    return F.arrow_udf(run, "double")


def training_rows(feats: DataFrame, labels: DataFrame, label: str = "quality", folds: int = FOLDS,
                  held: int = 0) -> DataFrame:
    """(doc_id, cells, label) of the rows that may be learned from; the held-out fold never joins."""
    use = labels.filter(F.col(label).isin(0, 1) & (fold_of("doc_id", folds) != held)).select(
        "doc_id", F.col(label).cast("int").alias("label"))
    return feats.join(use, "doc_id").select("doc_id", "cells", "label")


def fit(docs: DataFrame, labels: DataFrame) -> Model:
    """A model from the labelled documents outside the held-out fold; only their texts are read for it."""
    begin(docs.sparkSession)
    use = labels.filter(F.col("quality").isin(0, 1) & (fold_of() != 0)).select(
        "doc_id", F.col("quality").cast("int").alias("label"))
    cells = F.arrow_udf(cells_of, "binary")
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text")).join(small(use), "doc_id").select(
        "doc_id", cells("text").alias("cells"), "label")
    return train(materialize(rows, "quality-train"))


def accepted(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """The documents that the model scores at the threshold or above, in their own columns; one pass, no shuffle."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def good(text: pa.Array) -> pa.Array:
        import pyarrow.compute as pc
        return pc.greater_equal(shared.value.score(cells_of(text)), threshold)
    return docs.filter(F.arrow_udf(good, "boolean")(F.col("text").cast("string")))


def classify(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score, predicted for every document."""
    spark = begin(docs.sparkSession)
    feats = materialize(features(docs), "quality-cells")
    model = train(materialize(training_rows(feats, labels), "quality-train"))
    return feats.select("doc_id", (fold_of() == 0).alias("held_out"), scorer(spark, model)("cells").alias("score")
                        ).withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))
