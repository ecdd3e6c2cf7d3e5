"""Quality classifier: ordinal cumulative-link regression on graded ratings.

P(grade <= k) = sigmoid(theta_k - w.x) with one weight vector w over hashed text features (words, beginnings of words, so
that inflected and compounded forms count together, and the text's shape), shared by all grades, and increasing thresholds theta_0 < theta_1.  The fitted model gives each document its expected grade and the tail
probability P(grade >= 2), by which documents are selected.

Grades come from the table of labels: 0 = poor quality, 1 = fair prose that is toxic, 2 = good and not toxic.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import arrow_map
from .textkit import Words, buffer_of, mix, pieces, prefix_hashes

BITS = 18
#: lengths in bytes of the beginnings of longer words that are features, too
PREFIXES = (4, 6)
GRADES = 3
#: most labelled documents that the model is fitted on (a bounded sample: those with the smallest hashes of doc_id)
FIT_ROWS = 8000
#: documents with P(grade >= 2) of at least this are selected
SELECT_AT = 0.5

_UPPER = np.zeros(256, bool)
_UPPER[65:91] = True
_MARK = np.zeros(256, bool)
_MARK[[*range(33, 44), 47, *range(58, 65), *range(91, 97), *range(123, 127)]] = True


def features(data: np.ndarray, offsets: np.ndarray, first: int, last: int) -> tuple[np.ndarray, np.ndarray]:
    """(hashed feature of each document's distinct words, beginnings of words and shape statistics, bounds by document)."""
    w = Words(data, offsets, first, last)
    n = last - first
    doc = w.doc - first
    bucket = (w.hash >> np.uint64(64 - BITS)).astype(np.int64)
    words = np.diff(w.bounds)
    key = np.unique(doc << BITS | bucket)
    distinct = np.bincount(key >> BITS, minlength=n)
    lo = int(offsets[first])
    seg = data[lo : int(offsets[last])]
    size = np.diff(offsets[first : last + 1])

    def share(mask: np.ndarray, of: np.ndarray) -> np.ndarray:
        c = np.concatenate([[0], np.cumsum(mask)])
        at = offsets[first : last + 1] - lo
        return (c[at[1:]] - c[at[:-1]]) / np.maximum(of, 1)

    stats = (
        np.minimum(15, np.log2(words + 1).astype(np.int64)),
        np.minimum(10, distinct * 10 // np.maximum(words, 1)),
        np.minimum(15, share(_UPPER[seg], words) * 5).astype(np.int64),
        np.minimum(15, share(_MARK[seg], words) * 10).astype(np.int64),
        np.minimum(15, share(seg == 10, words) * 40).astype(np.int64),
        np.minimum(15, size // np.maximum(words, 1)),
        np.minimum(15, share(np.concatenate([[False], (seg[1:] == seg[:-1])])[: len(seg)], words) * 5).astype(np.int64),
        np.minimum(12, np.log2(words + 1).astype(np.int64)) * 11 + np.minimum(10, distinct * 10 // np.maximum(words, 1)),
    )
    more = [np.arange(n) << BITS | (mix(np.uint64(1000 * i + 7) + np.asarray(s).astype(np.uint64)) >> np.uint64(64 - BITS)).astype(np.int64) for i, s in enumerate(stats)]
    more += [doc[longer] << BITS | (h >> np.uint64(64 - BITS)).astype(np.int64) for longer, h in prefix_hashes(w, PREFIXES)]
    key = np.unique(np.concatenate([key, *more]))
    return key & ((1 << BITS) - 1), np.searchsorted(key >> BITS, np.arange(n + 1))


def _sigmoid(z):
    return 0.5 * (1 + np.tanh(0.5 * z))


def _pool(w: np.ndarray, ids: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    c = np.concatenate([[0.0], np.cumsum(w[ids])])
    return c[bounds[1:]] - c[bounds[:-1]]


def fit(ids: np.ndarray, bounds: np.ndarray, grade: np.ndarray, epochs: int = 150, rate: float = 0.05, lasso: float = 8e-4, common: float = 0.003) -> tuple[np.ndarray, np.ndarray]:
    """(weights, thresholds) by full-batch Adam on the cumulative-link likelihood, with an L1 penalty (proximal step).

    Features in less than a share `common` of the rows keep weight 0. No rows, or none of a grade, is fine.
    """
    w, theta = np.zeros(1 << BITS), np.array([-1.0, 0.0])
    if not len(grade):
        return w, theta
    raw = np.array([theta[0], 0.0])  # theta_1 = theta_0 + exp(raw_1), which keeps the order
    doc = np.repeat(np.arange(len(grade)), np.diff(bounds))
    seen = np.bincount(ids, minlength=1 << BITS) >= max(2, common * len(grade))
    m, v = np.zeros(len(w) + 2), np.zeros(len(w) + 2)
    share = np.bincount(grade, minlength=GRADES)
    each = np.where(share[grade] > 0, len(grade) / (GRADES * np.maximum(share[grade], 1)), 0) ** 0.5
    each /= each.sum()
    for t in range(1, epochs + 1):
        theta = np.array([raw[0], raw[0] + np.exp(raw[1])])
        s = _pool(w, ids, bounds)
        cum = np.concatenate([np.zeros((len(s), 1)), _sigmoid(theta[None] - s[:, None]), np.ones((len(s), 1))], 1)
        rows = np.arange(len(s))
        up, low = cum[rows, grade + 1], cum[rows, grade]
        p = np.maximum(up - low, 1e-9)
        du, dl = up * (1 - up), low * (1 - low)
        ds = each * (du - dl) / p
        g0 = np.bincount(grade, -each * du / p, GRADES) + np.bincount(np.maximum(grade - 1, 0), np.where(grade > 0, each * dl / p, 0), GRADES)
        grad = np.empty(len(w) + 2)
        grad[:-2] = np.bincount(ids, ds[doc], len(w)) * seen
        grad[-2:] = g0[0] + g0[1], g0[1] * np.exp(raw[1])
        m = 0.9 * m + 0.1 * grad
        v = 0.999 * v + 0.001 * grad * grad
        pace = rate / (np.sqrt(v / (1 - 0.999**t)) + 1e-4)
        step = pace * (m / (1 - 0.9**t))
        w -= step[:-2]
        w = np.sign(w) * np.maximum(np.abs(w) - lasso * pace[:-2], 0)
        raw -= step[-2:]
    return w, np.array([raw[0], raw[0] + np.exp(raw[1])])


def predict(s: np.ndarray, theta: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(expected grade, P(grade >= 2)) of scores."""
    tail1, tail2 = _sigmoid(s - theta[0]), _sigmoid(s - theta[1])
    return tail1 + tail2, tail2


def graded(docs: DataFrame, labels: DataFrame) -> DataFrame:
    lab = labels.select("doc_id", "quality", "toxic").where("doc_id is not null and quality is not null")
    lab = lab.groupBy("doc_id").agg(F.min("quality").alias("quality"), F.max(F.coalesce("toxic", F.lit(0))).alias("toxic"))
    lab = lab.withColumn("grade", F.when(F.col("quality") <= 0, 0).when(F.col("toxic") > 0, 1).otherwise(2))
    pick = lab.orderBy(F.xxhash64("doc_id"), "doc_id").limit(FIT_ROWS).select("doc_id", "grade")
    return docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(F.broadcast(pick), "doc_id")


def _sparse(b: pa.RecordBatch):
    data, off = buffer_of(b.column("text"))
    for first, last in pieces(off):
        ids, bounds = features(data, off, first, last)
        ids = ids.astype(np.int32)
        yield pa.record_batch({"doc_id": b.column("doc_id")[first:last], "grade": b.column("grade")[first:last], "ids": pa.array([ids[a:z].tobytes() for a, z in zip(bounds, bounds[1:])], pa.binary())})


def train(docs: DataFrame, labels: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    rows = arrow_map(graded(docs, labels), _sparse, "doc_id long, grade int, ids binary").toPandas().sort_values(["doc_id", "grade"])
    parts = [np.frombuffer(x, np.int32) for x in rows["ids"]]
    bounds = np.concatenate([[0], np.cumsum([len(x) for x in parts])]).astype(np.int64)
    return fit(np.concatenate([*parts, np.zeros(0, np.int32)]).astype(np.int64), bounds, rows["grade"].to_numpy(np.int64))


def score(docs: DataFrame, model: tuple[np.ndarray, np.ndarray]) -> DataFrame:
    """One row per row of docs: doc_id, expected_grade, p_top = P(grade >= 2), selected.

    A null or empty text has only its shape features (length 0) and is never selected; a null doc_id is passed on;
    repeated rows each get their row; other columns are not read. Texts of any length are scored as a whole. An empty
    table gives an empty result. Without labels all weights are 0, and every text with a word is selected.
    """
    w, theta = model[0].astype(np.float32), model[1]
    spread = docs.sparkSession.sparkContext.broadcast(w)

    def run(b: pa.RecordBatch):
        data, off = buffer_of(b.column("text"))
        weights = spread.value
        for first, last in pieces(off):
            ids, bounds = features(data, off, first, last)
            grade, tail = predict(_pool(weights.astype(np.float64), ids, bounds), theta)
            some = np.diff(off[first : last + 1]) > 0
            yield pa.record_batch({"doc_id": b.column("doc_id")[first:last], "expected_grade": pa.array(np.round(grade, 6)), "p_top": pa.array(np.round(tail, 6)), "selected": pa.array((tail >= SELECT_AT) & some)})

    return arrow_map(docs.select("doc_id", "text"), run, "doc_id long, expected_grade double, p_top double, selected boolean")


def quality_scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    return score(docs, train(docs, labels))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .common import table

    return quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
