"""Substring dedup by paragraph and line hashing.

A unit is a paragraph cut by content: from the start of each clause (a run of text without . ! ? , ; : or line break) the
shortest run of whole clauses with at least MIN_WORDS words; a document of fewer words is one unit.  So a repeated passage
is found wherever it begins and ends in a line, but for the parts of clauses at its ends, while a stray boilerplate line
is no unit.  In the variant by lines each line with enough words is a unit instead.

A unit is normalised to its sequence of lower-case words and digested to 128 bits; digests are grouped globally, the
occurrence of the lowest (doc_id, text's hash, start) is kept, and every other one is cut from its document.  Units may
overlap: what goes from a document is the union of its repeated units.  Removed spans carry their character offsets in the
original text.

One shuffle groups the digests.  Before it each task reduces its own occurrences of a digest to the first: any other is
known to be a repeat there and then.  So a passage that is in a third of all documents is one row per map task in its
group, not one row per document.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import NULL_ID, arrow_map, cut, i64, signed, small, table, tidied
from .textkit import Words, _power, buffer_of, mix, pieces

#: words that a paragraph holds at least; passages that share fewer in whole clauses are left alone
MIN_WORDS = 30
#: units that a task holds before it reduces them and sends them on
HELD = 4_000_000

_SPLIT = np.zeros(256, bool)
_SPLIT[[ord(c) for c in ".!?,;:\n"]] = True
_SALTS = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F))


def _digests(h: np.ndarray, a: np.ndarray, z: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two digests of each range of words a..z-1, by sums over powers of the word's place."""
    out = []
    power, inverse = _power(len(h) + 1)
    with np.errstate(over="ignore"):
        for salt in _SALTS:
            c = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(h + salt) * power[: len(h)], dtype=np.uint64)])
            out.append(mix((c[z] - c[a]) * inverse[a] + (z - a).astype(np.uint64) * salt))
    return out[0], out[1]


def lines(w: Words, least: int = 1):
    """(document, byte start, byte end, two digests) of the lines with at least `least` words."""
    data, offsets, first, last = w.data, w.offsets, w.first, w.last
    lo, hi = int(offsets[first]), int(offsets[last])
    nl = np.flatnonzero(data[lo:hi] == 10) + lo
    in_doc = np.searchsorted(offsets, nl, side="right") - 1
    docs = np.arange(first, last)
    start, s_doc = np.concatenate([offsets[first:last], nl + 1]), np.concatenate([docs, in_doc])
    end, e_doc = np.concatenate([nl, offsets[first + 1 : last + 1]]), np.concatenate([in_doc, docs])
    start, doc = start[np.lexsort((start, s_doc))], np.sort(s_doc)
    end = end[np.lexsort((end, e_doc))]
    # a line's words: those that start before its end and after the last line's
    at = np.searchsorted(w.start, end, side="left")
    before = np.concatenate([[0], at[:-1]]) if len(at) else at
    keep = np.flatnonzero(at - before >= least)
    return doc[keep], start[keep], end[keep], *_digests(w.hash, before[keep], at[keep])


def paragraphs(w: Words, least: int = MIN_WORDS):
    """(document, byte start, byte end, two digests) of the shortest runs of whole clauses with at least `least` words from
    each clause, and of the documents with fewer words. A unit ends where the next clause's first word starts."""
    n = len(w.hash)
    if not n:
        none = np.zeros(0, np.int64)
        return none, none, none, np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    lo, hi = int(w.offsets[w.first]), int(w.offsets[w.last])
    marks = np.concatenate([[0], np.cumsum(_SPLIT[w.data[lo:hi]])])
    opens = np.ones(n, bool)
    opens[1:] = marks[w.start[1:] - lo] > marks[w.end[:-1] - lo]
    size = np.diff(w.bounds)
    opens[w.bounds[:-1][size > 0]] = True
    clause = np.flatnonzero(opens)
    doc = np.searchsorted(w.bounds, clause, side="right") - 1
    ends = np.append(clause[1:], n)  # in words; a document's last clause ends where the next document starts
    stop = np.searchsorted(ends, clause + least)
    full = stop < len(ends)
    z = ends[np.minimum(stop, len(ends) - 1)]
    full &= z <= w.bounds[doc + 1]
    short = (size[doc] < least) & (clause == w.bounds[doc])
    z = np.where(short, w.bounds[doc + 1], z)
    keep = np.flatnonzero(full | short)
    a, z, doc = clause[keep], z[keep], doc[keep]
    begin = w.start[a]
    end = np.where(z < w.bounds[doc + 1], w.start[np.minimum(z, n - 1)], w.offsets[w.first + doc + 1])
    return w.first + doc, begin, end, *_digests(w.hash, a, z)


def _chars(data, offsets, doc, at):
    """Byte positions as character offsets in their documents (doc ascending)."""
    if not len(at):
        return at
    lo, hi = int(offsets[doc[0]]), int(offsets[doc[-1] + 1])
    lead = np.concatenate([[0], np.cumsum((data[lo:hi] & 0xC0) != 0x80)])
    return lead[at - lo] - lead[offsets[doc] - lo]


def _keyed(docs: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select("doc_id", F.coalesce("doc_id", F.lit(NULL_ID)).alias("id"), F.xxhash64(text).alias("row_key"), text.alias("text"))


#: occurrences, by columns: digests, rank, end
OCCURS = ("d1", "d2", "id", "row_key", "start", "stop")


def _repeats(c: dict[str, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """(rows that are the first of their digest, rows of a later rank); rows that tie with the first, wholly equal documents', are neither."""
    n = len(c["d1"])
    order = np.argsort(c["d1"])
    same = np.append(False, c["d1"][order[1:]] == c["d1"][order[:-1]])[:n]
    some = same.copy()
    some[:-1] |= same[1:]
    alone, more = order[~some], order[some]
    if not len(more):
        return alone, more
    keys = [c[k][more] for k in OCCURS[:5]]
    o = np.lexsort(keys[::-1])
    more, keys = more[o], [k[o] for k in keys]
    new = np.append(True, (keys[0][1:] != keys[0][:-1]) | (keys[1][1:] != keys[1][:-1]))
    twin = np.append(False, np.logical_and.reduce([k[1:] == k[:-1] for k in keys]))
    first = np.flatnonzero(new)[np.cumsum(new) - 1]
    later = np.logical_or.reduce([k != k[first] for k in keys[2:]])
    return np.concatenate([alone, more[new]]), more[later & ~twin]


def removals(docs: DataFrame, units=paragraphs) -> DataFrame:
    """id, row_key and the spans (pairs of characters) of the repeated units of each document that has any, in order of starts."""
    buckets = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    kind = "k long, gone boolean, d1 long, d2 long, id long, row_key long, start int, stop int"

    def batch(c, rows, gone):
        c = {k: v[rows] for k, v in c.items()}
        # the first of a digest meets others by the digest; repeats are known, and are spread
        k = mix(c["row_key"].view(np.uint64) ^ c["start"].astype(np.uint64)) if gone else c["d1"]
        cols = {x: signed(np.ascontiguousarray(c[x])) if x in ("d1", "d2") else i64(c[x]) if x in ("id", "row_key") else pa.array(c[x].astype(np.int32)) for x in OCCURS}
        return pa.record_batch({"k": signed(np.ascontiguousarray(k)), "gone": pa.array(np.full(len(rows), gone)), **cols})

    def emit(it):
        held, n = {k: [] for k in OCCURS}, 0

        def flush():
            c = {k: np.concatenate(v) for k, v in held.items()}
            first, later = _repeats(c)
            for rows, gone in ((first, False), (later, True)):
                for a in range(0, len(rows), 100_000):
                    yield batch(c, rows[a : a + 100_000], gone)

        for b in it:
            data, off = buffer_of(b.column("text"))
            ids, keys = np.asarray(b.column("id")), np.asarray(b.column("row_key"))
            for first, last in pieces(off):
                doc, start, end, d1, d2 = units(Words(data, off, first, last))
                start, end = _chars(data, off, doc, start).astype(np.int32), _chars(data, off, doc, end).astype(np.int32)
                for k, v in zip(OCCURS, (d1, d2, ids[doc], keys[doc], start, end)):
                    held[k].append(v)
                n += len(doc)
                if n > HELD:
                    yield from flush()
                    held, n = {k: [] for k in OCCURS}, 0
        if n:
            yield from flush()

    def keep(it):
        cols = {k: [] for k in ("gone", *OCCURS)}
        for b in it:
            for k in cols:
                cols[k].append(b.column(k).to_numpy(zero_copy_only=False))
        if not cols["gone"]:
            return
        c = {k: np.concatenate(v) for k, v in cols.items()}
        known = c.pop("gone")
        rows = np.flatnonzero(~known)
        rows = np.concatenate([np.flatnonzero(known), rows[_repeats({k: v[rows] for k, v in c.items()})[1]]])
        yield pa.record_batch({k: pa.array(c[k][rows]) for k in OCCURS[2:]})

    def gather(it):
        cols = {k: [] for k in OCCURS[2:]}
        for b in it:
            for k in cols:
                cols[k].append(np.asarray(b.column(k)))
        if not cols["id"]:
            return
        ident, key, start, stop = map(np.concatenate, cols.values())
        o = np.lexsort((start, key, ident))
        ident, key, start, stop = ident[o], key[o], start[o], stop[o]
        twin = np.append(False, (ident[1:] == ident[:-1]) & (key[1:] == key[:-1]) & (start[1:] == start[:-1]))
        ident, key, start, stop = ident[~twin], key[~twin], start[~twin], stop[~twin]
        doc = np.append(True, (ident[1:] != ident[:-1]) | (key[1:] != key[:-1]))
        if units is paragraphs:  # overlapping and touching units are one span; ends ascend with starts
            new = doc | np.append(True, start[1:] > stop[:-1])
            at = np.flatnonzero(new)
            ident, key, start, stop, doc = ident[at], key[at], start[at], stop[np.append(at[1:], len(stop)) - 1], doc[at]
        at = np.flatnonzero(doc)
        pairs = np.stack([start, stop], 1).astype(np.int32).ravel()
        spans = pa.ListArray.from_arrays(pa.array(np.append(at, len(start)).astype(np.int32) * 2), pa.array(pairs))
        yield pa.record_batch({"id": i64(ident[at]), "row_key": i64(key[at]), "spans": spans})

    rows = _keyed(docs).select("id", "row_key", "text").mapInArrow(tidied(emit), kind).repartition(buckets, "k")
    gone = rows.mapInArrow(tidied(keep), "id long, row_key long, start int, stop int")
    return gone.repartition(buckets, "id", "row_key").mapInArrow(tidied(gather), "id long, row_key long, spans array<int>")


def dedup(docs: DataFrame, units=paragraphs) -> DataFrame:
    """doc_id, text (what is kept), n_removed, removed ('start-stop,...' in characters of the original) for each row.

    A paragraph goes with the marks and spaces after it, a line with its line break. Ranks are (doc_id, text's hash, start);
    a null doc_id ranks last. Rows that repeat a doc_id and a text tie and are treated alike, so a repeated row loses what
    its twin loses. Of a text that repeats itself the first occurrence stays; where its units overlap (a clause again and
    again) one period stays. A null text counts as empty; a text without words is unchanged; texts of any length are read
    as a whole; extra columns are not read; an empty table gives an empty result.
    """
    gone = cut(removals(docs, units))
    width = gone.agg(F.count("*"), F.sum(F.size("spans"))).first()
    joined = _keyed(docs).join(small(gone, 1, 40 * width[0] + 4 * (width[1] or 0)), ["id", "row_key"], "left")
    beyond = int(units is not paragraphs)  # the line break

    def run(b: pa.RecordBatch):
        spans = b.column("spans")
        texts = b.column("text")
        hit = np.flatnonzero(np.asarray(spans.is_valid()))
        n, removed = np.zeros(len(texts), np.int64), np.full(len(texts), "", object)
        new = texts
        if len(hit):  # only the documents that lose something become Python objects
            cutup = []
            for i in hit:
                t, s, at, parts = texts[int(i)].as_py(), spans[int(i)].as_py(), 0, []
                for a, z in zip(s[::2], s[1::2]):
                    parts.append(t[at:a])
                    at = min(len(t), z + beyond)
                parts.append(t[at:])
                n[i], removed[i] = len(s) // 2, ",".join(f"{a}-{z}" for a, z in zip(s[::2], s[1::2]))
                cutup.append("".join(parts))
            mask = np.zeros(len(texts), bool)
            mask[hit] = True
            new = pc.replace_with_mask(texts, pa.array(mask), pa.array(cutup, texts.type))
        yield pa.record_batch({"doc_id": b.column("doc_id"), "text": new, "n_removed": i64(n), "removed": pa.array(removed, pa.string())})

    return arrow_map(joined.select("doc_id", "text", "spans"), run, "doc_id long, text string, n_removed long, removed string")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup(table(spark, sf_dir, "documents"))


def query_all_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every line that has a word is a unit, however short."""
    return dedup(table(spark, sf_dir, "documents"), lines)


_NORM = "trim(regexp_replace(translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^a-z0-9\\x{{80}}-\\x{{10FFFF}}]+', ' ', 'g'), ' ')"
SQL = f"""
WITH cut AS (
  SELECT doc_id, text, unnest(string_split_regex(text, '[.!?,;:\n]')) AS clause, unnest(range(len(string_split_regex(text, '[.!?,;:\n]')))) AS pos
  FROM (SELECT doc_id, coalesce(text, '') AS text FROM documents)),
placed AS (
  SELECT *, {_NORM.format('clause')} AS norm,
         coalesce(sum(length(clause) + 1) OVER (PARTITION BY doc_id ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS place
  FROM cut),
clauses AS (
  SELECT doc_id, norm, len(string_split(norm, ' '))::BIGINT AS n, row_number() OVER (PARTITION BY doc_id ORDER BY pos) AS c,
         place + length(regexp_extract(clause, '^[^A-Za-z0-9\\x{{80}}-\\x{{10FFFF}}]*')) AS start, length(text) AS size
  FROM placed WHERE norm <> ''),
summed AS (
  SELECT *, sum(n) OVER w AS upto, sum(n) OVER w - n AS before, sum(n) OVER (PARTITION BY doc_id) AS total, count(*) OVER (PARTITION BY doc_id) AS last,
         coalesce(lead(start) OVER w, size) AS stop
  FROM clauses WINDOW w AS (PARTITION BY doc_id ORDER BY c)),
lists AS (SELECT doc_id, list(norm ORDER BY c) AS norms, list(upto ORDER BY c) AS uptos, list(stop ORDER BY c) AS stops FROM summed GROUP BY doc_id),
ends AS (
  SELECT s.doc_id, s.c, s.start, CASE WHEN s.total < {MIN_WORDS} AND s.c = 1 THEN s.last ELSE len(list_filter(l.uptos, lambda x: x < s.before + {MIN_WORDS})) + 1 END AS e, s.last, l.norms, l.stops
  FROM summed s JOIN lists l ON l.doc_id = s.doc_id),
units AS (SELECT doc_id, start, stops[e] AS stop, array_to_string(norms[c:e], ' ') AS body FROM ends WHERE e <= last),
gone AS (SELECT doc_id, start, stop FROM units QUALIFY row_number() OVER (PARTITION BY body ORDER BY doc_id, start) > 1),
steps AS (SELECT *, CASE WHEN start <= max(stop) OVER (PARTITION BY doc_id ORDER BY start ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) THEN 0 ELSE 1 END AS new FROM gone),
spans AS (SELECT doc_id, min(start) AS a, max(stop) AS z FROM (SELECT *, sum(new) OVER (PARTITION BY doc_id ORDER BY start) AS island FROM steps) GROUP BY doc_id, island),
kept AS (SELECT doc_id, a, z, coalesce(lag(z) OVER (PARTITION BY doc_id ORDER BY a), 0) AS after FROM spans),
parts AS (
  SELECT d.doc_id, string_agg(substring(d.text, k.after + 1, k.a - k.after), '' ORDER BY k.a) AS body, max(k.z) AS z, count(*) AS n, string_agg(k.a || '-' || k.z, ',' ORDER BY k.a) AS removed
  FROM documents d JOIN kept k ON k.doc_id = d.doc_id GROUP BY d.doc_id)
SELECT d.doc_id, CASE WHEN p.doc_id IS NULL THEN coalesce(d.text, '') ELSE p.body || substring(d.text, p.z + 1) END AS text, coalesce(p.n, 0)::BIGINT AS n_removed, coalesce(p.removed, '') AS removed
FROM documents d LEFT JOIN parts p ON p.doc_id = d.doc_id
"""

SQL_ALL_LINES = f"""
WITH lines AS (
  SELECT doc_id, text, unnest(string_split(text, chr(10))) AS line, unnest(range(len(string_split(text, chr(10))))) AS pos
  FROM documents),
placed AS (
  SELECT doc_id, line, pos,
         coalesce(sum(length(line) + 1) OVER (PARTITION BY doc_id ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS start,
         trim(regexp_replace(translate(line, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^a-z0-9\\x{{80}}-\\x{{10FFFF}}]+', ' ', 'g'), ' ') AS norm
  FROM lines),
marked AS (
  SELECT *, CASE WHEN norm <> '' AND len(string_split(norm, ' ')) >= 1
                 THEN row_number() OVER (PARTITION BY norm ORDER BY doc_id, start) > 1 ELSE false END AS gone
  FROM placed),
kept AS (
  SELECT doc_id, string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone) AS body,
         count(*) FILTER (WHERE gone) AS n_removed,
         string_agg(start || '-' || (start + length(line)), ',' ORDER BY pos) FILTER (WHERE gone) AS removed,
         bool_or(gone AND pos = last_pos) AS cut_end, count(*) FILTER (WHERE NOT gone) AS n_kept
  FROM (SELECT *, max(pos) OVER (PARTITION BY doc_id) AS last_pos FROM marked) GROUP BY doc_id)
SELECT doc_id, coalesce(body, '') || CASE WHEN cut_end AND n_kept > 0 THEN chr(10) ELSE '' END AS text, n_removed, coalesce(removed, '') AS removed
FROM kept
"""
