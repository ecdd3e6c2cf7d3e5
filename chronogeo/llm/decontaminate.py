"""Benchmark decontamination by greedy string tiling.

A document and a benchmark item that share seeds (runs of MIN_TILE words, compared by rolling hash) are tiled: the longest
common run of unmarked words is marked, again and again, until no run of MIN_TILE words is left.  The tiles never overlap,
so their share of the item's words is a coverage that does not depend on the order of passages; a document that covers
THRESHOLD of an item is contaminated.

The index of the benchmark's seeds goes to every task if its size, which is checked, allows; every document is then read
once and nothing is shuffled.  A larger benchmark is joined on the seeds.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import NULL_ID, arrow_map, i64, signed, table, tidied
from .textkit import Words, buffer_of, grams, pieces

MIN_TILE = 4
THRESHOLD = 0.5
#: bytes of the benchmark's seed index up to which it is sent to the tasks
INDEX_BYTES = 64 << 20
#: bytes of the index a byte of text: 16 a seed, and a seed a word, of which texts of the usual kind have one in four bytes or fewer
SEED_BYTES = 4


class Index:
    """Seeds of benchmark items: sorted hashes, with item and position; the items' numbers of words."""

    def __init__(self, item_ids: list[int], texts: pa.Array):
        data, off = buffer_of(texts)
        self.ids = np.asarray(item_ids, np.int64)
        w = Words(data, off, 0, len(off) - 1) if len(off) > 1 else None
        self.size = np.diff(w.bounds) if w else np.zeros(0, np.int64)
        h, at = w.grams(MIN_TILE) if w else (np.zeros(0, np.uint64), np.zeros(0, np.int64))
        item = w.doc[at] if w else at
        order = np.argsort(h, kind="stable")
        self.hash, self.item = h[order], item[order].astype(np.int32)
        self.pos = (at - w.bounds[item])[order].astype(np.int32) if w else at

    def nbytes(self) -> int:
        return self.hash.nbytes + self.item.nbytes + self.pos.nbytes


def tile(i: np.ndarray, j: np.ndarray, m: int, k: int = MIN_TILE) -> list[tuple[int, int, int]]:
    """Greedy string tiling from seed hits: item word i[x] and document word j[x] start equal runs of k words.

    Returns tiles (item start, document start, length), the longest first; ties go to the lowest item start, then the
    lowest document start.
    """
    order = np.lexsort((i, j - i))
    i, j = i[order], j[order]
    new = np.flatnonzero(np.concatenate([[True], (np.diff(i) != 1) | (np.diff(j) != 1)])) if len(i) else i
    size = np.diff(np.append(new, len(i))) + k - 1
    heap = [(-int(n), int(i[s]), int(j[s])) for s, n in zip(new, size)]
    heapq.heapify(heap)
    in_item, in_doc, tiles = np.zeros(m, bool), set(), []
    while heap:
        n, a, b = heapq.heappop(heap)
        free = [not in_item[a + t] and (b + t) not in in_doc for t in range(-n)]
        if all(free):
            in_item[a : a - n] = True
            in_doc.update(range(b, b - n))
            tiles.append((a, b, -n))
            continue
        t = 0
        while t < -n:  # what is still unmarked of this run competes again
            if free[t]:
                e = t
                while e < -n and free[e]:
                    e += 1
                if e - t >= k:
                    heapq.heappush(heap, (t - e, a + t, b + t))
                t = e
            t += 1
    return tiles


def _pairs(index: Index, data, off, first, last):
    """(document, item, coverage, tiles, matched words) of the pairs over THRESHOLD."""
    w = Words(data, off, first, last)
    h, at = w.grams(MIN_TILE)
    if not len(h) or not len(index.hash):
        return []
    lo = np.searchsorted(index.hash, h)
    hit = np.flatnonzero(index.hash[np.minimum(lo, len(index.hash) - 1)] == h)
    if not len(hit):
        return []
    lo = lo[hit]
    n = np.searchsorted(index.hash, h[hit], side="right") - lo
    which = np.repeat(lo, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    word = np.repeat(at[hit], n)
    doc = np.searchsorted(w.bounds, word, side="right") - 1
    item, i, j = index.item[which].astype(np.int64), index.pos[which].astype(np.int64), word - w.bounds[doc]
    order = np.lexsort((j, i, item, doc))
    doc, item, i, j = doc[order], item[order], i[order], j[order]
    cut = np.flatnonzero(np.concatenate([[True], (np.diff(doc) != 0) | (np.diff(item) != 0)]))
    # words of the item that any seed covers: an upper bound of the coverage
    gap = np.append(np.diff(i), MIN_TILE)
    gap[cut[1:] - 1] = MIN_TILE
    bound = np.add.reduceat(np.minimum(gap, MIN_TILE), cut)
    out = []
    for s, e, most in zip(cut, np.append(cut[1:], len(doc)), bound):
        m = int(index.size[item[s]])
        if most < THRESHOLD * m:
            continue
        tiles = tile(i[s:e], j[s:e], m)
        got = sum(t[2] for t in tiles)
        if got >= THRESHOLD * m:
            out.append((first + int(doc[s]), int(item[s]), got / m, len(tiles), got))
    return out


def index_of(bench: DataFrame) -> Index | None:
    """The index, or None if it is too large for the tasks (its size is checked before anything is collected)."""
    b = bench.select("item_id", "text").where("item_id is not null and text is not null")
    size = b.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    if size * SEED_BYTES > INDEX_BYTES:
        return None
    rows = b.orderBy("item_id", "text").toPandas()
    index = Index(rows["item_id"].tolist(), pa.array(rows["text"], pa.string()))
    return index if index.nbytes() <= INDEX_BYTES else None


def matches(docs: DataFrame, bench: DataFrame) -> DataFrame:
    """doc_id, item_id, coverage, n_tiles, matched_words for every document and item over THRESHOLD.

    Null and empty texts match nothing; items of fewer than MIN_TILE words, or with a null id or text, are left out of the
    benchmark; repeated items are items of their own; rows that repeat a document each get their rows; a null doc_id is
    passed on. Texts are read as a whole, of any length. Other columns are not read. Either table may be empty: no rows.
    """
    index = index_of(bench)
    if index is None:
        return _joined(docs, bench).drop("d")
    shared = docs.sparkSession.sparkContext.broadcast(index)

    def run(b: pa.RecordBatch):
        data, off = buffer_of(b.column("text"))
        ids = b.column("doc_id")
        for first, last in pieces(off):
            found = _pairs(shared.value, data, off, first, last)
            yield _batch(found, ids.take(pa.array([x[0] for x in found], pa.int64())), shared.value.ids)

    return arrow_map(docs.select("doc_id", "text"), run, SCHEMA)


SCHEMA = "doc_id long, item_id long, coverage double, n_tiles long, matched_words long"


def _batch(found, doc_ids, item_ids) -> pa.RecordBatch:
    return pa.record_batch({"doc_id": doc_ids, "item_id": i64([item_ids[x[1]] for x in found]), "coverage": pa.array([round(x[2], 6) for x in found], pa.float64()), "n_tiles": i64([x[3] for x in found]), "matched_words": i64([x[4] for x in found])})


#: shares that each seed's documents are split into, so that one of a third of all documents is no single task's
SALT = 16


def _seeds(df: DataFrame, name: str) -> DataFrame:
    """(name, h, n, words): the distinct seeds of each text, how often it has them, and its number of words."""

    def run(b: pa.RecordBatch):
        data, off = buffer_of(b.column("text"))
        ids = np.asarray(b.column(name))
        for first, last in pieces(off):
            w = Words(data, off, first, last)
            h, at = w.grams(MIN_TILE)
            if len(h):
                doc = np.searchsorted(w.bounds, at, side="right") - 1
                order = np.lexsort((h, doc))
                h, doc = h[order], doc[order]
                new = np.concatenate([[True], (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])])
                at = np.flatnonzero(new)
                yield pa.record_batch({name: i64(ids[first + doc[at]]), "h": signed(np.ascontiguousarray(h[at])), "n": i64(np.diff(np.append(at, len(h)))), "words": i64(np.diff(w.bounds)[doc[at]])})

    return arrow_map(df, run, f"{name} long, h long, n long, words long")


def _row_key():
    """A row's doc_id and text as one number: rows that share it are contaminated alike."""
    return F.xxhash64(F.coalesce("doc_id", F.lit(NULL_ID)), F.coalesce("text", F.lit("")))


def _joined(docs: DataFrame, bench: DataFrame) -> DataFrame:
    """matches(), and each row's key d, for a benchmark of any size: a shuffle join on the seeds, then tiling pair by pair."""
    d = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), _row_key().alias("d"))
    t = bench.select("item_id", "text").where("item_id is not null and text is not null").withColumn("b", F.xxhash64("item_id", "text"))
    mine = _seeds(d.select("d", "text").dropDuplicates(["d"]), "d").select("d", "h", F.pmod(F.hash("d"), F.lit(SALT)).alias("salt"))
    theirs = _seeds(t.select("b", "text").dropDuplicates(["b"]), "b").withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALT - 1))))
    # a seed covers MIN_TILE words of the item wherever it stands there: pairs that can't reach THRESHOLD end before texts are sent
    pairs = mine.join(theirs, ["h", "salt"]).groupBy("d", "b").agg(F.sum("n").alias("n"), F.max("words").alias("words")).where(F.col("n") * MIN_TILE >= F.col("words") * THRESHOLD).select("d", "b")
    full = pairs.join(d, "d").join(t.withColumnRenamed("text", "item_text"), "b")

    def run(b: pa.RecordBatch):
        data, off = buffer_of(b.column("text"))
        for k in range(len(off) - 1):
            index = Index([b.column("item_id")[k].as_py()], b.column("item_text")[k : k + 1])
            found = _pairs(index, data, off, k, k + 1)
            rows = pa.array([x[0] for x in found], pa.int64())
            yield _batch(found, b.column("doc_id").take(rows), index.ids).append_column("d", b.column("d").take(rows))

    return arrow_map(full.select("doc_id", "d", "text", "item_id", "item_text"), run, SCHEMA + ", d long")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def clean(docs: DataFrame, bench: DataFrame) -> DataFrame:
    """The rows of docs, with all their columns, that cover no item of bench; cases as in matches()."""
    index = index_of(bench)
    if index is None:
        name = "_bad" + "_" * max(map(len, docs.columns))  # no column of docs is so called
        bad = _joined(docs, bench).select(F.col("d").alias(name)).distinct()
        return docs.join(bad, _row_key() == F.col(name), "left_anti")
    shared = docs.sparkSession.sparkContext.broadcast(index)

    def run(it):
        for b in it:
            data, off = buffer_of(b.column("text"))
            keep = np.ones(len(off) - 1, bool)
            for first, last in pieces(off):
                keep[[x[0] for x in _pairs(shared.value, data, off, first, last)]] = False
            yield b.filter(pa.array(keep))

    return docs.mapInArrow(tidied(run), docs.schema)


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: the documents that are not contaminated, with the columns of docs."""
    return clean(docs, table(spark, sf_dir, "benchmark"))
