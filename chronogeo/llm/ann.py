"""Approximate nearest neighbours by additive quantisation.

A vector is approximated by a sum of codewords, one of each of LEVELS codebooks, all of the vectors' full dimension.  The
codebooks are fitted to residuals, one after the other, on a bounded sample; codes are found by beam search for every row;
the norm of each approximation and its error are stored.

Queries, the rows whose id is divisible by QUERY_EVERY, go to all tasks in blocks of bounded size, and each task scans its
rows' codes: the squared distance s from a query q to a row's approximation is read from tables of inner products.  With the
row x, its error r of length e, and d = |q - x|, it is s = d^2 + e^2 + 2 (q - x).r.  Along x the error is known (g = x.r / x.x
is stored), and with u for what is across it, s = (1 - g) d^2 + e^2 + g (q.q - x.x) + 2 (q - x).u.  So if x is no further
than t, then s <= (1 - g) t^2 + e^2 + g (q.q - x.x) + 2 t |u|, and as u has no preferred direction, 2 SPREAD t |u| / sqrt(dim)
is enough for the last term but in a share of cases that SPREAD sets.  Rows that pass are reranked by their exact distance.
t starts as the distance of the nearest of some rows of the sample and falls as a task goes on.  No number of candidates is
fixed, so that groups of near copies are reranked as a whole; SPREAD = sqrt(dim) makes the search exact.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import cut, i64, table, tidied

TOP = 10
LEVELS = 16
CODES = 128
BEAM = 4
ITERATIONS = 5
#: rows that the codebooks are fitted on, about (a bounded sample, by the hash of vec_id)
FIT_ROWS = 16384
#: rows of the sample whose exact distances bound every query's search from the start
PIVOTS = 4096
#: standard deviations of a row's error along the way to the query that are allowed for
SPREAD = 2.5
#: the rows whose id is divisible by this are the queries
QUERY_EVERY = 50
#: queries that go to the tasks at once, about
BLOCK = 1 << 15
#: relative error that is allowed for in squared distances of 32 bits
LOOSE = 1e-5
_ROWS, _QUERIES = 2048, 512


def vectors_of(col: pa.Array, dim: int) -> tuple[np.ndarray, np.ndarray]:
    """(matrix, row numbers) of the rows with dim finite numbers."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    off = np.asarray(col.offsets)
    size = np.where(np.asarray(col.is_valid()), np.diff(off), 0)
    rows = np.flatnonzero(size == dim)
    values = np.asarray(col.values.cast(pa.float32()).fill_null(np.nan))
    x = values[off[:-1][rows][:, None] + np.arange(dim)] if len(rows) else np.zeros((0, dim), np.float32)
    good = np.isfinite(x).all(1)
    return x[good], rows[good]


def nearest(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    out = np.empty(len(x), np.int64)
    half = 0.5 * (c * c).sum(1)
    for a in range(0, len(x), 4096):
        out[a : a + 4096] = (half - x[a : a + 4096] @ c.T).argmin(1)
    return out


def beam_encode(x: np.ndarray, books: list[np.ndarray], beam: int = BEAM) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(codes, squared norms of the approximations, lengths of the errors, their parts along the rows g): the best of `beam` partial
    sums kept at each level."""
    codes, norms, errors, along = np.empty((len(x), len(books)), np.uint8), *np.empty((3, len(x)), np.float32)
    for a in range(0, len(x), 1024):
        y = x[a : a + 1024]
        n = len(y)
        r, trail = y[:, None, :], np.zeros((n, 1, 0), np.uint8)
        for c in books:
            d = (r * r).sum(2)[:, :, None] - 2 * (r @ c.T) + (c * c).sum(1)
            k = min(beam, d.shape[1] * d.shape[2])
            flat = d.reshape(n, -1)
            best = np.argpartition(flat, k - 1, axis=1)[:, :k]
            best = np.take_along_axis(best, np.argsort(np.take_along_axis(flat, best, 1), axis=1, kind="stable"), 1)
            b, code = best // len(c), best % len(c)
            r = np.take_along_axis(r, b[:, :, None], 1) - c[code]
            trail = np.concatenate([np.take_along_axis(trail, b[:, :, None], 1), code[:, :, None].astype(np.uint8)], 2)
        codes[a : a + 1024] = trail[:, 0]
        approx = y - r[:, 0]
        norms[a : a + 1024] = (approx * approx).sum(1)
        errors[a : a + 1024] = np.sqrt((r[:, 0].astype(np.float64) ** 2).sum(1))
        along[a : a + 1024] = (y * r[:, 0]).sum(1) / np.maximum((y * y).sum(1), 1e-30)
    return codes, norms, errors, along


def fit(sample: np.ndarray) -> list[np.ndarray]:
    """LEVELS codebooks, each by Lloyd's iterations over what the ones before leave of the sample."""
    r, books = sample.astype(np.float32), []
    for _ in range(LEVELS):
        c = np.unique(r[:CODES], axis=0)
        for _ in range(ITERATIONS):
            k = nearest(r, c)
            n = np.bincount(k, minlength=len(c))
            order = np.argsort(k, kind="stable")
            some = np.flatnonzero(n)
            c[some] = np.add.reduceat(r[order], np.cumsum(n)[some] - n[some], axis=0) / n[some, None]
        books.append(c)
        r = r - c[nearest(r, c)]
    return books


def first_of_equal(x: np.ndarray, ids: np.ndarray, most: int) -> np.ndarray:
    """The rows of x that fewer than `most` rows of lesser ids equal: no others can be among the nearest, as ties go to the least id."""
    _, same = np.unique(np.ascontiguousarray(x).view(f"V{x.shape[1] * x.itemsize}").ravel(), return_inverse=True)
    order = np.lexsort((ids, same))
    group = same[order]
    return np.sort(order[np.arange(len(order)) - np.searchsorted(group, group) < most])


class Search:
    """The nearest rows so far of the queries q; add() takes rows. bound: squared distances beyond which no row matters."""

    def __init__(self, ids: np.ndarray, q: np.ndarray, bound: np.ndarray, books: list[np.ndarray], top: int, spread: float):
        self.ids, self.q, self.bound, self.top = ids, q, bound.astype(np.float64), top
        self.wide = 2 * min(spread / q.shape[1] ** 0.5, 1.0)
        self.qq = (q * q).sum(1)
        self.lut = [np.ascontiguousarray(-2 * (c @ q.T)) for c in books]
        none = np.zeros(0, np.int64)
        self.best = (none, none, np.zeros(0))  # query, id, squared distance
        self.reranked = 0

    def add(self, ids: np.ndarray, x: np.ndarray, codes: np.ndarray, norm: np.ndarray, error: np.ndarray, along: np.ndarray) -> None:
        xx = np.einsum("ij,ij->i", x, x, dtype=np.float64)
        e, g = error.astype(np.float64), along.astype(np.float64)
        across = np.sqrt(np.maximum(e * e - g * g * xx, 0))
        # a row's side of the bound on s, in the order of the query's side below
        side = np.stack([e * e - g * xx + LOOSE * (norm + e * e + xx), np.maximum(1 - g, 0), g + LOOSE, self.wide * across], 1).astype(np.float32)
        for a in range(0, len(ids), _ROWS):
            rows = slice(a, a + _ROWS)
            for b in range(0, len(self.q), _QUERIES):
                cols = slice(b, b + _QUERIES)
                score = norm[rows][:, None] + self.qq[cols]
                for m, lut in enumerate(self.lut):
                    score += lut[codes[rows, m], cols]
                t = self.bound[cols]
                if np.isinf(t).any():  # fewer pivots than neighbours
                    i, j = np.nonzero(np.ones(score.shape, bool))
                else:
                    reach = side[rows] @ np.stack([np.ones(len(t)), t, self.qq[cols], np.sqrt(t)]).astype(np.float32)
                    i, j = np.nonzero(score <= reach)
                self._rerank(ids, x, a + i, b + j)

    def _rerank(self, ids, x, i, j) -> None:
        self.reranked += len(i)
        found = [self.best]
        for s in range(0, len(i), 1 << 16):
            r, c = i[s : s + (1 << 16)], j[s : s + (1 << 16)]
            d = ((x[r].astype(np.float64) - self.q[c]) ** 2).sum(1)
            good = (d <= self.bound[c]) & (ids[r] != self.ids[c])
            found.append((c[good], ids[r[good]], d[good]))
        c, nb, d = (np.concatenate(v) for v in zip(*found))
        if len(c) == len(self.best[0]):
            return
        order = np.lexsort((nb, d, c))
        c, nb, d = c[order], nb[order], d[order]
        place = np.arange(len(c)) - np.searchsorted(c, c)
        self.best = c[place < self.top], nb[place < self.top], d[place < self.top]
        last = place == self.top - 1
        self.bound[c[last]] = np.minimum(self.bound[c[last]], d[last])


def pivot_bound(ids: np.ndarray, q: np.ndarray, pivot_ids: np.ndarray, pivots: np.ndarray, top: int) -> np.ndarray:
    """For each query a squared distance within which lie at least `top` of the pivots that are not the query, if there are so many."""
    out = np.full(len(q), np.inf)
    if len(pivots) <= top:
        return out
    pp = (pivots.astype(np.float64) ** 2).sum(1)
    for a in range(0, len(q), 1024):
        y = q[a : a + 1024].astype(np.float64)
        d = (y * y).sum(1)[:, None] + pp - 2 * (y @ pivots.T)
        d[ids[a : a + 1024, None] == pivot_ids] = np.inf
        last = np.partition(d, top - 1, axis=1)[:, top - 1]
        out[a : a + 1024] = np.maximum(last, 0) + 1e-9 * ((y * y).sum(1) + pp.max())
    return out


KIND = "vec_id long, x binary, codes binary, norm float, error float, along float"


def index(e: DataFrame, dim: int, books: list[np.ndarray]) -> DataFrame:
    """Every row of e with its codes, the norm of their sum, and its error."""
    shared = e.sparkSession.sparkContext.broadcast(books)

    def encode(it):
        for b in it:
            x, rows = vectors_of(b.column("embedding"), dim)
            ids = np.asarray(b.column("vec_id"))[rows]
            for a in range(0, len(x), 4096):
                y = x[a : a + 4096]
                codes, norms, errors, along = beam_encode(y, shared.value)
                yield pa.record_batch({"vec_id": i64(ids[a : a + 4096]), "x": pa.array([v.tobytes() for v in y], pa.binary()), "codes": pa.array([v.tobytes() for v in codes], pa.binary()), "norm": pa.array(norms, pa.float32()), "error": pa.array(errors, pa.float32()), "along": pa.array(along, pa.float32())})

    return e.select("vec_id", "embedding").mapInArrow(tidied(encode), KIND)


def _arrays(b, dim: int, levels: int):
    x = np.frombuffer(b"".join(b.column("x").to_pylist()), np.float32).reshape(-1, dim)
    codes = np.frombuffer(b"".join(b.column("codes").to_pylist()), np.uint8).reshape(-1, levels)
    return np.asarray(b.column("vec_id")), x, codes, *(np.asarray(b.column(k)) for k in ("norm", "error", "along"))


def neighbours(emb: DataFrame, top: int = TOP, every: int = QUERY_EVERY, spread: float = SPREAD, block: int = BLOCK) -> DataFrame:
    """(vec_id, neighbour_id, rank, distance): the `top` nearest others, by Euclidean distance, of each vector whose id is
    divisible by `every`, among all vectors.

    Ties go to the least neighbour_id. Left out are rows with a null id or vector, with numbers that are null or not finite,
    or of another length than most. A row that repeats an id is no neighbour of it; an id's repeated rows with one vector
    count once, and of several vectors with one id the first in the order of their values is taken. With fewer than
    top + 1 vectors, lists are shorter. Extra columns are not read. An empty table gives an empty result.
    """
    spark = emb.sparkSession
    out = "vec_id long, neighbour_id long, rank int, distance double"
    e = emb.select("vec_id", F.col("embedding").cast("array<float>").alias("embedding")).where("vec_id is not null and embedding is not null and size(embedding) > 0")
    e = e.where(~F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))))
    dims = e.groupBy(F.size("embedding").alias("d")).count().orderBy(F.desc("count"), "d").limit(1).collect()
    if not dims:
        return spark.createDataFrame([], out)
    dim = dims[0]["d"]
    e = cut(e.where(F.size("embedding") == dim).groupBy("vec_id").agg(F.min("embedding").alias("embedding")))
    n, asked = e.agg(F.count("*"), F.sum(F.when(F.col("vec_id") % every == 0, 1).otherwise(0))).first()

    share = min(1 << 20, (FIT_ROWS << 20) // n + 1)  # so many of 2^20 hashes make the sample
    rows = e.where(F.pmod(F.xxhash64("vec_id"), F.lit(1 << 20)) < share).toPandas().sort_values("vec_id")
    if not len(rows):
        rows = e.limit(1).toPandas()
    sample, ids = np.stack([np.asarray(v, np.float32) for v in rows["embedding"]]), rows["vec_id"].to_numpy(np.int64)
    mixed = np.random.default_rng(3).permutation(len(ids))
    sample, ids = sample[mixed], ids[mixed]
    books = fit(sample)
    base = cut(index(e, dim, books))
    pivots = spark.sparkContext.broadcast((ids[:PIVOTS], sample[:PIVOTS]))
    shared = spark.sparkContext.broadcast(books)
    blocks = max(1, -(-int(asked or 0) // block))
    of_block = F.pmod(F.xxhash64("vec_id", F.lit("block")), F.lit(blocks))
    queries = base.where(F.col("vec_id") % every == 0).withColumn("b", of_block)

    def bounded(it):
        for b in it:
            q = np.frombuffer(b"".join(b.column("x").to_pylist()), np.float32).reshape(-1, dim)
            yield pa.record_batch({"b": b.column("b"), "vec_id": b.column("vec_id"), "x": b.column("x"), "bound": pa.array(pivot_bound(np.asarray(b.column("vec_id")), q, *pivots.value, top))})

    queries = queries.select("b", "vec_id", "x").mapInArrow(tidied(bounded), "b long, vec_id long, x binary, bound double")
    queries = cut(queries) if blocks > 1 else queries

    def scan(query):
        def run(it):
            qids, q, bound = query.value
            s = Search(qids, q, bound.copy(), shared.value, top, spread)
            for b in it:
                vid, x, *rest = _arrays(b, dim, len(shared.value))
                some = first_of_equal(x, vid, top + 1)
                s.add(vid[some], x[some], *(v[some] for v in rest))
            c, nb, d = s.best
            yield pa.record_batch({"vec_id": i64(s.ids[c]), "neighbour_id": i64(nb), "distance": pa.array(np.sqrt(d))})

        return base.mapInArrow(tidied(run), "vec_id long, neighbour_id long, distance double")

    found = None
    for k in range(blocks):  # a block is bounded, so its queries may go to the driver and to every task
        q = queries.where(F.col("b") == k).toPandas().sort_values("vec_id")
        if len(q):
            x = np.frombuffer(b"".join(q["x"]), np.float32).reshape(-1, dim)
            part = scan(spark.sparkContext.broadcast((q["vec_id"].to_numpy(np.int64), x, q["bound"].to_numpy())))
            w = Window.partitionBy("vec_id").orderBy("distance", "neighbour_id")
            part = part.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= top).select("vec_id", "neighbour_id", "rank", F.round("distance", 6).alias("distance"))
            part = cut(part) if blocks > 1 else part
            found = part if found is None else found.union(part)
    return spark.createDataFrame([], out) if found is None else found


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours(table(spark, sf_dir, "embeddings"))
