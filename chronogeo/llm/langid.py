"""Language ID: a byte convolutional network, trained in numpy on labelled text.

Bytes are embedded, convolved with filters of widths 2, 3 and 4, max-pooled over a window of fixed length and fed to a
softmax.  Inference cuts each whole text into consecutive windows, scores them in batches, and adds up the windows' log
probabilities, weighted by their length.  For inference a filter bank becomes tables of byte pairs, so that a window
costs a few table look-ups a byte and no matrix product.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import arrow_map, cut, table, tidied
from .textkit import buffer_of, pieces

WINDOW = 256
WIDTHS = (2, 3, 4)
FILTERS = 8
DIM = 6
#: labelled documents per language that the network is fitted on (a bounded sample, by the hash of doc_id), and the windows of
#: each, spread evenly over its text, that it is fitted on (inference reads all windows)
FIT_DOCS = 300
FIT_WINDOWS = 4
#: a text is rejected below this mean probability of its best language
ACCEPT_AT = 0.5
BATCH = 1024


def windows(data: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """Bytes of data[lo:hi] for each window, padded with zeros to WINDOW."""
    at = lo[:, None] + np.arange(WINDOW)
    x = data[np.minimum(at, max(len(data) - 1, 0))] if len(data) else np.zeros(at.shape, np.uint8)
    x[at >= hi[:, None]] = 0
    return x


def cuts(offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, start, end) of the consecutive windows that cover every text."""
    size = np.diff(offsets)
    n = -(-size // WINDOW)
    doc = np.repeat(np.arange(len(size)), n)
    k = np.arange(len(doc)) - np.repeat(np.cumsum(n) - n, n)
    lo = offsets[doc] + k * WINDOW
    return doc, lo, np.minimum(lo + WINDOW, offsets[doc + 1])


class Net:
    """emb: 256 x DIM; conv[w]: w x DIM x FILTERS; bias[w]: FILTERS; out: features x classes, and its bias."""

    def __init__(self, classes: list[str], seed: int = 7):
        r = np.random.default_rng(seed)
        self.classes = classes
        self.p = {"emb": r.normal(0, 0.5, (256, DIM)), "out": r.normal(0, 0.1, (FILTERS * len(WIDTHS), len(classes))), "b": np.zeros(len(classes))}
        for w in WIDTHS:
            self.p[f"c{w}"] = r.normal(0, (2 / (w * DIM)) ** 0.5, (w, DIM, FILTERS))
            self.p[f"d{w}"] = np.zeros(FILTERS)

    def forward(self, x: np.ndarray):
        e = self.p["emb"][x]
        feats, kept = [], []
        for w in WIDTHS:
            n = x.shape[1] - w + 1
            z = sum(e[:, j : j + n] @ self.p[f"c{w}"][j] for j in range(w))
            at = z.argmax(1)
            top = np.take_along_axis(z, at[:, None], 1)[:, 0] + self.p[f"d{w}"]
            feats.append(np.maximum(top, 0))
            kept.append((at, top > 0))
        f = np.concatenate(feats, 1)
        z = f @ self.p["out"] + self.p["b"]
        z -= z.max(1, keepdims=True)
        q = np.exp(z)
        return q / q.sum(1, keepdims=True), f, kept, e

    def step(self, x: np.ndarray, y: np.ndarray, state: dict, rate: float) -> float:
        q, f, kept, e = self.forward(x)
        n = len(y)
        loss = float(-np.log(q[np.arange(n), y] + 1e-12).mean())
        dz = q.copy()
        dz[np.arange(n), y] -= 1
        dz /= n
        g = {"out": f.T @ dz, "b": dz.sum(0), "emb": np.zeros_like(self.p["emb"])}
        df = dz @ self.p["out"].T
        rows = np.arange(n)[:, None]
        for i, w in enumerate(WIDTHS):
            at, on = kept[i]
            d = df[:, i * FILTERS : (i + 1) * FILTERS] * on
            g[f"d{w}"] = d.sum(0)
            c = np.zeros_like(self.p[f"c{w}"])
            for j in range(w):
                c[j] = np.einsum("nfd,nf->df", e[rows, at + j], d)
                np.add.at(g["emb"], x[rows, at + j], d[:, :, None] * self.p[f"c{w}"][j].T[None])
            g[f"c{w}"] = c
        state["t"] = t = state.get("t", 0) + 1
        for k, v in g.items():
            m, s = state.setdefault(k, (np.zeros_like(v), np.zeros_like(v)))
            state[k] = m, s = 0.9 * m + 0.1 * v, 0.999 * s + 0.001 * v * v
            self.p[k] = self.p[k] - rate * (m / (1 - 0.9**t)) / (np.sqrt(s / (1 - 0.999**t)) + 1e-8)
        return loss

    def compile(self) -> "Tables":
        return Tables(self)


class Tables:
    """The network as look-up tables of byte pairs."""

    def __init__(self, net: Net):
        e = net.p["emb"]
        one = {w: [(e @ net.p[f"c{w}"][j]).astype(np.float32) for j in range(w)] for w in WIDTHS}
        pair = lambda a, b: (a[:, None] + b[None]).reshape(65536, FILTERS)
        self.two, self.three, self.tail = pair(*one[2]), pair(*one[3][:2]), one[3][2]
        self.four = pair(*one[4][:2]), pair(*one[4][2:])
        self.bias = np.concatenate([net.p[f"d{w}"] for w in WIDTHS]).astype(np.float32)
        self.out, self.b, self.classes = net.p["out"].astype(np.float32), net.p["b"].astype(np.float32), net.classes

    def log_prob(self, x: np.ndarray) -> np.ndarray:
        x = np.ascontiguousarray(x.T)  # position by window: each step works on whole rows
        pair = (x[:-1].astype(np.int32) << 8) | x[1:]
        n = len(pair)
        best = np.full((3, x.shape[1], FILTERS), -np.inf, np.float32)
        for t in range(n):
            np.maximum(best[0], self.two[pair[t]], out=best[0])
            if t + 2 < len(x):
                z = self.three[pair[t]]
                z += self.tail[x[t + 2]]
                np.maximum(best[1], z, out=best[1])
            if t + 2 < n:
                z = self.four[0][pair[t]]
                z += self.four[1][pair[t + 2]]
                np.maximum(best[2], z, out=best[2])
        f = np.maximum(np.concatenate(list(best), 1) + self.bias, 0)
        z = f @ self.out + self.b
        z -= z.max(1, keepdims=True)
        return z - np.log(np.exp(z).sum(1, keepdims=True))


def sample(docs: DataFrame) -> DataFrame:
    """(lang, doc_id, windows) of FIT_DOCS documents of each language: those of the least hashes, picked by their ids alone, then cut
    to FIT_WINDOWS windows where they are, so that neither texts nor each task's candidates go to the driver."""
    text_key = F.xxhash64("text")
    rows = docs.select("doc_id", "text", "lang").where("lang is not null and text is not null and length(text) > 0 and doc_id is not null")
    ids = rows.select("lang", "doc_id", text_key.alias("text_key")).distinct()
    w = Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id", "text_key")
    pick = cut(ids.withColumn("r", F.row_number().over(w)).where(F.col("r") <= FIT_DOCS).drop("r"))
    # FIT_DOCS rows a language, whose number is that of the network's classes
    some = rows.withColumn("text_key", text_key).join(F.broadcast(pick), ["lang", "doc_id", "text_key"])

    def run(b: pa.RecordBatch):
        data, off = buffer_of(b.column("text"))
        doc, lo, hi = cuts(off)
        n = np.bincount(doc, minlength=len(off) - 1)
        turn = np.arange(len(doc)) - np.repeat(np.cumsum(n) - n, n)
        # window t of n is the first of one of FIT_WINDOWS equal parts
        keep = np.flatnonzero((turn * FIT_WINDOWS % n[doc] < FIT_WINDOWS) | (n[doc] <= FIT_WINDOWS))
        x = windows(data, lo[keep], hi[keep])
        parts = np.searchsorted(doc[keep], np.arange(len(off)))
        yield pa.record_batch({"lang": b.column("lang"), "doc_id": b.column("doc_id"), "text_key": b.column("text_key"), "windows": pa.array([x[a:z].tobytes() for a, z in zip(parts, parts[1:])], pa.binary())})

    return arrow_map(some, run, "lang string, doc_id long, text_key long, windows binary").dropDuplicates(["lang", "doc_id", "text_key"])


def train(docs: DataFrame, steps: int = 500, batch: int = 96, rate: float = 0.01) -> Net:
    """Fits a network to the languages in docs.lang; rows without language or text are left out."""
    rows = sample(docs).toPandas().sort_values(["lang", "doc_id", "text_key"])
    names = sorted(rows["lang"].unique())
    net = Net(names or ["und"])
    r = np.random.default_rng(11)
    xs = [np.frombuffer(b"".join(rows["windows"][rows["lang"] == name]), np.uint8).reshape(-1, WINDOW) for name in names]
    if len(names) < 2:
        return net
    groups, state = xs, {}
    for t in range(steps):
        pick = [(g[r.integers(0, len(g), batch // len(names) + 1)], k) for k, g in enumerate(groups)]
        x = np.concatenate([a for a, _ in pick])
        short = r.random(len(x)) < 0.3  # texts may be short: train on windows that end early, too
        end = np.where(short, r.integers(16, WINDOW, len(x)), WINDOW)
        x = np.where(np.arange(WINDOW)[None] < end[:, None], x, 0)
        net.step(x, np.concatenate([np.full(len(a), k) for a, k in pick]), state, rate * (1 - t / steps))
    return net


def decide(net: Tables, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(class, confidence) of each text: argmax and value of the length-weighted mean probability of its windows."""
    doc, lo, hi = cuts(offsets)
    n, k = len(offsets) - 1, len(net.classes)
    total = np.zeros((n, k))
    for a in range(0, len(doc), BATCH):
        z = slice(a, a + BATCH)
        p = np.exp(net.log_prob(windows(data, lo[z], hi[z]))) * (hi[z] - lo[z])[:, None]
        for c in range(k):
            total[:, c] += np.bincount(doc[z], p[:, c], n)
    size = np.diff(offsets)
    total /= np.maximum(size, 1)[:, None]
    best = total.argmax(1)
    conf = total[np.arange(n), best] if n else np.zeros(0)
    return np.where(size > 0, best, -1), np.where(size > 0, conf, 0.0)


def identify(docs: DataFrame, net: Net) -> DataFrame:
    """doc_id, pred_lang, confidence, accepted for each row of docs.

    A null or empty text has language 'und', confidence 0 and is not accepted. Null ids and repeated rows are passed on
    row by row; whole texts are read, of any length; further columns are not read; an empty table gives an empty result.
    """
    shared = docs.sparkSession.sparkContext.broadcast(net.compile())
    names = np.array([*net.classes, "und"], object)

    def run(b: pa.RecordBatch):
        data, off = buffer_of(b.column("text"))
        for first, last in pieces(off):
            lo = off[first]
            best, conf = decide(shared.value, data[lo : off[last]], off[first : last + 1] - lo)
            yield pa.record_batch({"doc_id": b.column("doc_id")[first:last], "pred_lang": pa.array(names[best], pa.string()), "confidence": pa.array(np.round(conf, 6)), "accepted": pa.array((conf >= ACCEPT_AT) & (best >= 0))})

    return arrow_map(docs.select("doc_id", "text"), run, "doc_id long, pred_lang string, confidence double, accepted boolean")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return identify(docs, train(docs))


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: the rows of docs whose language is recognised, with the columns of docs, whatever their names."""
    shared = spark.sparkContext.broadcast(train(docs).compile())

    def run(it):
        for b in it:
            data, off = buffer_of(b.column("text"))
            keep = np.zeros(len(off) - 1, bool)
            for first, last in pieces(off):
                lo = off[first]
                best, conf = decide(shared.value, data[lo : off[last]], off[first : last + 1] - lo)
                keep[first:last] = (conf >= ACCEPT_AT) & (best >= 0)
            yield b.filter(pa.array(keep))

    return docs.mapInArrow(tidied(run), docs.schema)
