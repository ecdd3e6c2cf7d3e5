"""Suffix-array dedup with sparse suffix arrays.

Of all suffixes of the word sequences only those are retained that start at a minimiser: the position of the least hash of
K words in some window of WINDOW positions.  Which positions these are depends on the words around them alone, so both
copies of a passage of LENGTH words retain a suffix at the same place of it, in its first WINDOW words, with at least
LENGTH - WINDOW + 1 of its words to the right.

1. Suffixes are keyed by their first LENGTH - WINDOW + 1 words; keys that occur once end here.
2. The others come back with the WINDOW - 1 words on either side.  One task per key range sorts them, compares
   neighbours (the longest common prefix), and extends the matches left: every passage of LENGTH words at any offset
   around the suffix is compared, so the result is that of the full suffix array.  Of suffixes with the same words around
   them a task sends the first alone; the others follow it, and take their result from its.
3. Passages that occur earlier, by (doc_id, position), are joined into maximal spans.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import NULL_ID, arrow_map, cut, i64, signed, small, table, tidied
from .textkit import Words, buffer_of, mix, pieces

LENGTH = 50
WINDOW = 24
K = 4
RIGHT = LENGTH - WINDOW + 1
SIDE = WINDOW - 1
#: suffixes, and suffixes with the words around them, that a task holds before it reduces them and sends them on
HELD, HELD_AROUND = 4_000_000, 200_000


def minimisers(w: Words) -> tuple[np.ndarray, np.ndarray]:
    """(word index, key) of the retained suffixes: those with RIGHT words in their document."""
    h, at = w.grams(K)
    if len(h) < WINDOW:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    order = mix(h ^ np.uint64(0x6A09E667F3BCC909))
    # the leftmost least hash of each window: min over a doubling of lengths, with the position in the low bits
    pos = np.arange(len(order), dtype=np.uint64)
    low = (order & ~np.uint64(0xFFFFFFFF)) | pos
    reach, x = 1, low
    while reach * 2 <= WINDOW:
        x = np.minimum(x[:-reach], x[reach:])
        reach *= 2
    if reach < WINDOW:
        rest = WINDOW - reach
        x = np.minimum(x[: len(x) - rest], x[rest:])
    first = np.arange(len(x))
    # windows lie inside one document: their first and last gram are WINDOW - 1 words apart
    inside = at[first + WINDOW - 1] - at[first] == WINDOW - 1
    doc_of = np.searchsorted(w.bounds, at, side="right")
    inside &= doc_of[first + WINDOW - 1] == doc_of[first]
    pick = np.unique((x[inside] & np.uint64(0xFFFFFFFF)).astype(np.int64))
    start = at[pick]
    key, where = w.grams(RIGHT)
    i = np.searchsorted(where, start)
    ok = (i < len(where)) & (where[np.minimum(i, max(len(where) - 1, 0))] == start) if len(where) else np.zeros(len(start), bool)
    return start[ok], key[i[ok]]


def _docs(docs: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text"), F.lit(""))
    ident = F.coalesce("doc_id", F.lit(NULL_ID))
    return docs.select(ident.alias("id"), F.xxhash64(ident, text).alias("u"), text.alias("text"))


def recurring(docs: DataFrame, buckets: int) -> DataFrame:
    """(u, pos) of the retained suffixes whose key occurs more than once.

    A task that meets a key again knows that it recurs: those suffixes are told at once, and one row of the key goes on, so
    that a passage in a third of all documents is a row a task.
    """

    def rows(key, u, pos, k, kind):
        return pa.record_batch({"k": i64(k), "kind": pa.array(np.full(len(u), kind, np.int32)), "key": i64(key), "u": i64(u), "pos": pa.array(pos.astype(np.int32))})

    def told(key, u, pos):
        key, u, pos = key.view(np.int64), u, pos
        order = np.argsort(key, kind="stable")
        key, u, pos = key[order], u[order], pos[order]
        new = np.append(True, key[1:] != key[:-1])[: len(key)]
        first = np.flatnonzero(new)
        many = np.diff(np.append(first, len(key))) > 1
        alone, lead, more = first[~many], first[many], np.repeat(many, np.diff(np.append(first, len(key))))
        for at, kind in ((alone, 0), (lead, 1)):
            yield rows(key[at], u[at], pos[at], key[at], kind)
        yield rows(key[more], u[more], pos[more], mix(u[more].view(np.uint64)).view(np.int64), 2)

    def emit(it):
        held, n = [], 0
        for b in it:
            data, off = buffer_of(b.column("text"))
            u = np.asarray(b.column("u"))
            for first, last in pieces(off):
                w = Words(data, off, first, last)
                start, key = minimisers(w)
                doc = np.searchsorted(w.bounds, start, side="right") - 1
                held.append((key, u[first + doc], start - w.bounds[doc]))
                n += len(key)
                if n > HELD:
                    yield from told(*map(np.concatenate, zip(*held)))
                    held, n = [], 0
        if n:
            yield from told(*map(np.concatenate, zip(*held)))

    def keep(it):
        cols = {k: [] for k in ("kind", "key", "u", "pos")}
        for b in it:
            for k in cols:
                cols[k].append(np.asarray(b.column(k)))
        if not cols["key"]:
            return
        kind, key, u, pos = map(np.concatenate, cols.values())
        known = kind == 2
        at = np.flatnonzero(~known)
        order = at[np.argsort(key[at], kind="stable")]
        k = key[order]
        first = np.flatnonzero(np.append(True, k[1:] != k[:-1])[: len(k)])
        n = np.diff(np.append(first, len(k)))
        again = np.repeat((n > 1) | (np.maximum.reduceat(kind[order], first) == 1 if len(first) else n > 1), n)
        more = np.concatenate([np.flatnonzero(known), order[again & (kind[order] == 0)]])
        yield pa.record_batch({"u": i64(u[more]), "pos": pa.array(pos[more])})

    sent = _docs(docs).select("u", "text").mapInArrow(tidied(emit), "k long, kind int, key long, u long, pos int")
    return sent.repartition(buckets, "k").mapInArrow(tidied(keep), "u long, pos int")


def _around(tok: np.ndarray, bounds: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The SIDE words before each position, nearest first, then the SIDE words from RIGHT words after it; 0 outside."""
    doc = np.searchsorted(bounds, at, side="right") - 1
    left = at[:, None] - 1 - np.arange(SIDE)
    right = at[:, None] + RIGHT + np.arange(SIDE)
    x = np.concatenate([np.where(left >= bounds[doc][:, None], tok[np.maximum(left, 0)], 0), np.where(right < bounds[doc + 1][:, None], tok[np.minimum(right, len(tok) - 1)], 0)], 1)
    return x.astype(">u4")


def match(key: np.ndarray, ident: np.ndarray, pos: np.ndarray, ctx: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """For each suffix, bit l of its mask: the passage that starts l words before it occurs earlier; and the least id of such.
    Then the same of a later suffix with the same words around it: for that every passage that is one occurs earlier."""
    n = len(key)
    right = ctx[:, SIDE:]
    view = np.ascontiguousarray(right).view(f"S{4 * SIDE}")[:, 0]
    order = np.lexsort((np.arange(n), view, key)) if n else np.zeros(0, np.int64)
    key, ident, pos, ctx = key[order], ident[order], pos[order], ctx[order].astype(np.uint32)
    left, right = ctx[:, :SIDE], ctx[:, SIDE:]
    # neighbours in suffix order: words in common beyond the key, or -1 for another key
    differ = np.concatenate([(right[1:] != right[:-1]) | (right[1:] == 0), np.ones((max(n - 1, 0), 1), bool)], 1)
    lcp = np.concatenate([[-1], np.where(key[1:] == key[:-1], differ.argmax(1), -1)])[:n]
    _, rank = np.unique(np.rec.fromarrays([ident, pos]), return_inverse=True)
    mask, least, whole, lowest = np.zeros(n, np.int64), np.full(n, NULL_ID), np.zeros(n, np.int64), np.full(n, NULL_ID)
    back = np.zeros(n, np.uint64)
    has = np.ones(n, bool)
    for l in range(WINDOW):
        if l:  # extend left by a word
            with np.errstate(over="ignore"):
                back = mix(back * np.uint64(0xD1342543DE82EF95) + left[:, l - 1])
            has &= left[:, l - 1] != 0
        e = SIDE - l
        rows = np.flatnonzero(has & ((right[:, e - 1] != 0) if e else np.ones(n, bool)))
        whole[rows] |= 1 << l
        if len(rows) == 0:
            continue
        run = np.cumsum(lcp < e)[rows].astype(np.uint64)
        with np.errstate(over="ignore"):
            group = mix(back[rows] + mix(run + np.uint64(l * 1_000_003)))
        o = np.lexsort((rank[rows], group))
        g = group[o]
        new = np.concatenate([[True], g[1:] != g[:-1]])
        first = rows[o[np.flatnonzero(new)]][np.cumsum(new) - 1]
        r = rows[o]
        hit = rank[r] > rank[first]
        mask[r[hit]] |= 1 << l
        least[r[hit]] = np.minimum(least[r[hit]], ident[first[hit]])
        lowest[r] = np.minimum(lowest[r], ident[first])
    out = np.empty((4, n), np.int64)
    out[:, order] = mask, least, whole, lowest
    return tuple(out)


def repeats(docs: DataFrame) -> DataFrame:
    """(doc_id, start, stop, n_words, first_doc_id): the maximal spans whose every LENGTH words occur earlier.

    start and stop are character offsets in the original text; first_doc_id is the least document in which a part of the
    span occurs before. Order is by (doc_id, word), a null doc_id is last (and comes out as null); repeats inside one
    document count. Rows that repeat a doc_id and a text tie, neither is earlier, and each gets the other's spans. Texts of
    fewer than LENGTH words, null and empty ones have no spans; long ones are indexed as a whole. Extra columns are not
    read. An empty table gives an empty result.
    """
    buckets = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    d = _docs(docs)
    again = recurring(docs, buckets).groupBy("u").agg(F.collect_set("pos").alias("at"))
    again = cut(again)
    size = again.agg(F.count("*"), F.sum(F.size("at"))).first()
    found = d.join(small(again, 1, 40 * size[0] + 4 * (size[1] or 0)), "u")

    def around(it):
        """Leaders, with the words around them, and followers."""

        def parted(key, ident, u, pos, ctx):
            h = [np.zeros(len(key), np.uint64), np.zeros(len(key), np.uint64)]
            words = ctx.astype(np.uint64)
            with np.errstate(over="ignore"):
                for k in range(ctx.shape[1]):
                    h = [mix(x * np.uint64(0xD1342543DE82EF95) + words[:, k] + np.uint64(c)) for x, c in zip(h, (1, 77))]
            order = np.lexsort((u, pos, ident, h[1], h[0], key))
            key, ident, u, pos, ctx, h = key[order], ident[order], u[order], pos[order], ctx[order], [x[order] for x in h]
            new = np.append(True, (key[1:] != key[:-1]) | (h[0][1:] != h[0][:-1]) | (h[1][1:] != h[1][:-1]))[: len(key)]
            twin = np.append(False, ~new[1:] & (u[1:] == u[:-1]) & (pos[1:] == pos[:-1]))[: len(key)]  # of a repeated row
            first = np.flatnonzero(new)[np.cumsum(new) - 1]
            f = np.flatnonzero(~new & ~twin)
            lead = np.flatnonzero(new)
            none = pa.nulls(len(f), pa.binary())
            tie = (ident[f] == ident[first[f]]) & (pos[f] == pos[first[f]])
            spread = mix(u[f].view(np.uint64) + pos[f].astype(np.uint64)).view(np.int64)
            row = lambda k, at, to, tie, body: pa.record_batch({"k": i64(k), "key": i64(key[at].view(np.int64)), "id": i64(ident[at]), "u": i64(u[at]), "pos": pa.array(pos[at].astype(np.int32)), "lead_u": i64(u[to]), "lead_pos": pa.array(pos[to].astype(np.int32)), "tie": pa.array(tie), "ctx": body})
            for z in range(0, len(lead), 20_000):
                at = lead[z : z + 20_000]
                body = pa.FixedSizeBinaryArray.from_buffers(pa.binary(8 * SIDE), len(at), [None, pa.py_buffer(np.ascontiguousarray(ctx[at]).tobytes())]).cast(pa.binary())
                yield row(key[at].view(np.int64), at, at, np.zeros(len(at), bool), body)
            if len(f):
                yield row(spread, f, first[f], tie, none)

        held, n = [], 0
        for b in it:
            data, off = buffer_of(b.column("text"))
            ids, us, at = np.asarray(b.column("id")), np.asarray(b.column("u")), b.column("at")
            flat, ab = np.asarray(at.flatten()), np.asarray(at.offsets)
            ab = ab - ab[0]
            for first, last in pieces(off):
                w = Words(data, off, first, last)
                m = np.diff(ab[first : last + 1])
                doc = np.repeat(np.arange(last - first), m)
                p = flat[ab[first] : ab[last]].astype(np.int64)
                start = w.bounds[doc] + p
                key, where = w.grams(RIGHT)
                k = key[np.searchsorted(where, start)] if len(start) else np.zeros(0, np.uint64)
                tok = np.maximum((w.hash >> np.uint64(32)).astype(np.uint32), 1)
                for a in range(0, len(start), HELD_AROUND):
                    z = slice(a, a + HELD_AROUND)
                    held.append((k[z], ids[first + doc[z]], us[first + doc[z]], p[z], _around(tok, w.bounds, start[z])))
                    n += len(k[z])
                    if n > HELD_AROUND:
                        yield from parted(*map(np.concatenate, zip(*held)))
                        held, n = [], 0
        if n:
            yield from parted(*map(np.concatenate, zip(*held)))

    def compare(it):
        cols = {k: [] for k in ("key", "id", "u", "pos", "lead_u", "lead_pos", "tie", "ctx")}
        leads = []
        for b in it:
            leads.append(np.asarray(b.column("ctx").is_valid()))
            for k in cols:
                cols[k].append(buffer_of(b.column(k))[0] if k == "ctx" else b.column(k).to_numpy(zero_copy_only=False))
        if not leads:
            return
        c, lead = {k: np.concatenate(v) for k, v in cols.items()}, np.concatenate(leads)
        ctx = c.pop("ctx").view(">u4").reshape(-1, 2 * SIDE)
        found = np.zeros((4, len(lead)), np.int64)
        found[:, lead] = match(c["key"][lead], c["id"][lead], c["pos"][lead], ctx)
        yield pa.record_batch({"lead": pa.array(lead), **{k: pa.array(c[k]) for k in ("u", "pos", "lead_u", "lead_pos", "tie")}, **{k: i64(v) for k, v in zip(("mask", "least", "whole", "lowest"), found)}})

    def follow(it):
        """Marks of leaders, and of their followers."""
        cols = {k: [] for k in ("lead", "u", "pos", "lead_u", "lead_pos", "tie", "mask", "least", "whole", "lowest")}
        for b in it:
            for k in cols:
                cols[k].append(b.column(k).to_numpy(zero_copy_only=False))
        if not cols["u"]:
            return
        c = {k: np.concatenate(v) for k, v in cols.items()}
        order = np.lexsort((~c["lead"], c["lead_pos"], c["lead_u"]))
        c = {k: v[order] for k, v in c.items()}
        new = np.append(True, (c["lead_u"][1:] != c["lead_u"][:-1]) | (c["lead_pos"][1:] != c["lead_pos"][:-1]))
        first = np.flatnonzero(new)[np.cumsum(new) - 1]  # the leader
        same = c["lead"] | c["tie"]
        mask = np.where(same, c["mask"][first], c["whole"][first])
        least = np.where(same, c["least"][first], c["lowest"][first])
        hit = mask > 0
        yield pa.record_batch({"u": i64(c["u"][hit]), "pos": pa.array(c["pos"][hit]), "mask": i64(mask[hit]), "least": i64(least[hit])})

    at = "u long, pos int, lead_u long, lead_pos int, tie boolean"
    near = found.select("id", "u", "text", "at").mapInArrow(tidied(around), f"k long, key long, id long, {at}, ctx binary")
    compared = near.repartition(buckets, "k").mapInArrow(tidied(compare), f"lead boolean, {at}, mask long, least long, whole long, lowest long")
    marks = compared.repartition(buckets, "lead_u", "lead_pos").mapInArrow(tidied(follow), "u long, pos int, mask long, least long")

    def islands(it):
        cols = {k: [] for k in ("u", "pos", "mask", "least")}
        for b in it:
            for k in cols:
                cols[k].append(np.asarray(b.column(k)))
        if not cols["u"]:
            return
        u, pos, mask, least = map(np.concatenate, cols.values())
        row, back = np.nonzero((mask[:, None] >> np.arange(WINDOW)) & 1)
        u, start, least = u[row], pos[row].astype(np.int64) - back, least[row]
        order = np.lexsort((start, u))
        u, start, least = u[order], start[order], least[order]
        new = np.flatnonzero(np.concatenate([[True], (np.diff(u) != 0) | (np.diff(start) > LENGTH)]))
        yield pa.record_batch({"u": i64(u[new]), "first": i64(start[new]), "last": i64(start[np.append(new[1:], len(start)) - 1] + LENGTH), "least": i64(np.minimum.reduceat(least, new))})

    # spans are few, and only they go to the texts again, for their character offsets
    found = marks.repartition(buckets, "u").mapInArrow(tidied(islands), "u long, first long, last long, least long")
    found = cut(found.groupBy("u").agg(F.collect_list(F.struct("first", "last", "least")).alias("spans")))
    size = found.agg(F.count("*"), F.sum(F.size("spans"))).first()
    full = d.join(small(found, 1, 40 * size[0] + 48 * (size[1] or 0)), "u")

    def spans(b: pa.RecordBatch):
        data, off = buffer_of(b.column("text"))
        ids, m = np.asarray(b.column("id")), b.column("spans")
        flat, mb = m.flatten(), np.asarray(m.offsets)
        mb = mb - mb[0]
        begin, end, low = (np.asarray(flat.field(k)) for k in ("first", "last", "least"))
        for first, last in pieces(off):
            w = Words(data, off, first, last)
            n = np.diff(mb[first : last + 1])
            doc, z = np.repeat(np.arange(last - first), n), slice(mb[first], mb[last])
            lead = np.concatenate([[0], np.cumsum((data[off[first] : off[last]] & 0xC0) != 0x80)])
            char = lambda at: lead[at - off[first]] - lead[off[first + doc] - off[first]]  # noqa: B023,E731
            yield pa.record_batch({"doc_id": i64(ids[first + doc]), "start": i64(char(w.start[w.bounds[doc] + begin[z]])), "stop": i64(char(w.end[w.bounds[doc] + end[z] - 1])), "n_words": i64(end[z] - begin[z]), "first_doc_id": i64(low[z])})

    r = arrow_map(full.select("id", "text", "spans"), spans, "doc_id long, start long, stop long, n_words long, first_doc_id long")
    none = lambda c: F.when(F.col(c) != NULL_ID, F.col(c)).alias(c)
    return r.select(none("doc_id"), "start", "stop", "n_words", none("first_doc_id"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats(table(spark, sf_dir, "documents"))


#: windows of LENGTH words are compared by 64-bit hashes of hashes of 8 words, taken row by row: no text is copied for a window
_WORD = "[A-Za-z0-9\\x{80}-\\x{10FFFF}]+"
SQL = f"""
WITH t AS (SELECT doc_id, text, regexp_extract_all(text, '{_WORD}') AS ws, string_split_regex(text, '{_WORD}') AS gaps FROM documents WHERE text IS NOT NULL),
w AS (SELECT doc_id, unnest(ws) AS word, unnest(gaps[1:len(ws)]) AS gap, unnest(range(len(ws))) AS i FROM t WHERE len(ws) >= {LENGTH}),
p AS (SELECT doc_id, i, (sum(length(gap) + length(word)) OVER (PARTITION BY doc_id ORDER BY i ROWS UNBOUNDED PRECEDING))::BIGINT AS stop, length(word) AS n FROM w),
v AS (SELECT doc_id, i, hash(translate(word, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS h FROM w),
e8 AS (SELECT doc_id, i, hash(h, {", ".join(f"lead(h, {k}) OVER o" for k in range(1, 8))}) AS h FROM v WINDOW o AS (PARTITION BY doc_id ORDER BY i)),
g AS (SELECT doc_id, i AS s, hash(h, {", ".join(f"lead(h, {k}) OVER o" for k in (*range(8, LENGTH - 8, 8), LENGTH - 8))}) AS h FROM e8
      WINDOW o AS (PARTITION BY doc_id ORDER BY i) QUALIFY lead(i, {LENGTH - 1}) OVER o IS NOT NULL),
r AS (SELECT doc_id, s, row_number() OVER o AS k, first_value(doc_id) OVER o AS src FROM g WINDOW o AS (PARTITION BY h ORDER BY doc_id, s)),
m AS (SELECT *, CASE WHEN s - lag(s) OVER (PARTITION BY doc_id ORDER BY s) <= {LENGTH} THEN 0 ELSE 1 END AS new FROM r WHERE k > 1),
i AS (SELECT *, sum(new) OVER (PARTITION BY doc_id ORDER BY s ROWS UNBOUNDED PRECEDING) AS island FROM m),
x AS (SELECT doc_id, min(s) AS a, max(s) + {LENGTH} AS z, min(src) AS first_doc_id FROM i GROUP BY doc_id, island)
SELECT x.doc_id, b.stop - b.n AS start, e.stop AS stop, (z - a)::BIGINT AS n_words, first_doc_id
FROM x JOIN p b ON b.doc_id = x.doc_id AND b.i = a JOIN p e ON e.doc_id = x.doc_id AND e.i = z - 1
"""
