"""N-gram Jaccard join with token-combination prefixes.

A document's set holds the hashes of its word N-grams (all its words as one gram, if it has fewer than N), of HASH_BITS bits
at every step, so that Jaccard is exact but for collisions of them (less than one in a thousand in a pair of texts of
300,000 words).  Documents with equal sets are collapsed to one set; the distinct sets are joined at Jaccard >= THETA:

1. Order. Grams go, packed, to one task per bucket of their hashes, where those of one set only end.  The others come back
   to their sets, with their document frequency, by which they are ordered.  What only one set has can't be shared, so
   a set is dropped here if more of its grams than a match may miss are its own, and no text is read again.  A task sends
   each distinct set once, however many copies it has, and grams that would fill a share of a bucket by themselves, which
   are few and known beforehand, go to their sets directly.
2. Prefixes. A set of n grams may differ from a match in at most tau = n - ceil(THETA n) of its grams.  The prefix takes
   the grams of its own, then single grams of the rare class, and, where these do not suffice, is extended by pairs of grams of the frequent class
   (pairs inside partitions of the grams, whose number goes by the size of the sets, so that pairs stay few).  A
   partition with c grams in the prefix adds c - 1 to the prefix's strength, any other gram adds 1; the prefix ends at
   strength tau + 1, so that tau errors cannot break all that it shares with a match.
3. Candidates. Signatures are sent, packed, to one task per bucket of their hashes.  A posting does not become all pairs
   of its sets but a star about its least member, so a group of thousands of near copies costs a few edges per member.
4. Verification. A star's sets go to one task (to a triangle of tasks, if there are many), first as bitmaps, a fraction of
   their size, which tell for most pairs that they share too little.  Sets with a likely partner go to the star's task
   again, in full, to be intersected.  A pair that lies in several stars belongs to the one of the least leader: every member
   knows the lesser leaders of its other stars, so that tasks can tell without sending pairs.

What leaves the tasks is a number of links and a root for each set of a star, not pairs: a group of thousands of near copies
has millions of links, but a row a document.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import arrow_map, cut, i64, signed, small, table, tidied
from .textkit import Words, buffer_of, mix, pieces

N = 3
#: the threshold as a fraction, so that bounds are exact
THETA = (3, 5)
#: grams of at least this share of the sets are of the frequent class
FREQUENT = 0.005
HASH_BITS = 50
PIECE_DOCS = 1 << 11
#: signatures that a task holds before it packs and sends them
FLUSH = 500_000
#: most sets of one star that one task compares with each other
STAR = 2048
#: grams are hot that have more than one in HOT_SHARE of a bucket's entries, if buckets were equal, and are in one in HOT_SETS of all
#: sets: there are at most HOT_SETS times as many of them as a set has grams
HOT_SHARE, HOT_SETS = 8, 512
#: a set of more than one HOTth of all documents is matched with them by a broadcast, of fewer than HOT rows
HOT = 4096
#: passes in which a bucket's grams are sorted
PASSES = 4

_HASH = np.uint64((1 << HASH_BITS) - 1)
#: buckets of grams, at least: what a gram's bucket does not tell of it then fits 48 bits
LEAST_BUCKETS = 1 << (HASH_BITS - 48)


def _six(x: np.ndarray) -> bytes:
    """uint64 below 2^48 in six bytes each."""
    return np.ascontiguousarray(x).view(np.uint8).reshape(-1, 8)[:, :6].tobytes()


def _from_six(data: bytes) -> np.ndarray:
    x = np.zeros((len(data) // 6, 8), np.uint8)
    x[:, :6] = np.frombuffer(data, np.uint8).reshape(-1, 6)
    return x.view(np.uint64)[:, 0]


def least_overlap(n):
    """ceil(THETA n)."""
    p, q = THETA
    return (p * n + q - 1) // q


def _pieces(offsets):
    for a, z in pieces(offsets):
        for k in range(a, z, PIECE_DOCS):
            yield k, min(z, k + PIECE_DOCS)


def gram_sets(w: Words) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, offsets by document) of the sets of a piece."""
    n = w.last - w.first
    h, at = w.grams(N)
    doc = np.searchsorted(w.bounds, at, side="right") - 1
    words = np.diff(w.bounds)
    few = np.flatnonzero((words > 0) & (words < N))
    if len(few):  # a short text is one gram
        more = np.empty(len(few), np.uint64)
        with np.errstate(over="ignore"):
            for x, d in enumerate(few):
                v = np.uint64(words[d])
                for t in w.hash[w.bounds[d] : w.bounds[d + 1]]:
                    v = v * np.uint64(0xD1342543DE82EF95) + t
                more[x] = v
        h, doc = np.concatenate([h, mix(more)]), np.concatenate([doc, few])
    # one 64-bit sort: 14 bits of document, the others of hash
    key = np.unique(doc.astype(np.uint64) << np.uint64(HASH_BITS) | (h & _HASH))
    bounds = np.append(np.searchsorted(key, np.arange(n).astype(np.uint64) << np.uint64(HASH_BITS)), len(key))
    return key & _HASH, bounds


def digests(h: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        c = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(h * np.uint64(0x9E3779B97F4A7C15) + np.uint64(1)), dtype=np.uint64)])
        return mix((c[bounds[1:]] - c[bounds[:-1]]) + np.diff(bounds).astype(np.uint64))


def _texts(docs: DataFrame) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    return docs.select("doc_id", F.xxhash64(text).alias("row_key"), text.alias("text")).where("doc_id is not null")


def _firsts(dig: np.ndarray, seen: set, sizes: np.ndarray) -> np.ndarray:
    """The numbers of the sets that have grams and that the task has not met."""
    _, at = np.unique(dig, return_index=True)
    out = [k for k in np.sort(at).tolist() if sizes[k] and int(dig[k]) not in seen]
    seen.update(dig[out].tolist())
    return np.array(out, np.int64)


def _taken(h: np.ndarray, bounds: np.ndarray, sets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, offsets) of some sets of a piece."""
    n = np.diff(bounds)[sets]
    at = np.repeat(bounds[sets] - (np.cumsum(n) - n), n) + np.arange(n.sum())
    return h[at], np.concatenate([[0], np.cumsum(n)])


def survey(docs: DataFrame, buckets: int) -> DataFrame:
    """(doc_id, row_key, digest) of each document's set; the digest is null for texts without words. And, with a null doc_id, rows
    of (digest: a gram, n, total): grams that are hot in a piece, and the number of its sets that have them; for the gram -1 the
    piece's numbers of sets and of entries.

    A gram that is hot in all texts is so in some piece at least, and the pieces in which it is not can hide no more than
    half of what makes it hot, as pieces ask for half of that share.
    """

    def run(it):
        seen: set = set()
        for b in it:
            data, off = buffer_of(b.column("text"))
            for first, last in _pieces(off):
                h, bounds = gram_sets(Words(data, off, first, last))
                none = np.diff(bounds) == 0
                dig = digests(h, bounds)
                zero = i64(np.zeros(len(dig)))
                yield pa.record_batch({"doc_id": b.column("doc_id")[first:last], "row_key": b.column("row_key")[first:last], "digest": pa.array(dig.view(np.int64), pa.int64(), mask=none), "n": zero, "total": zero})
                sets = _firsts(dig, seen, np.diff(bounds))
                own, _ = _taken(h, bounds, sets)
                own.sort()
                new = np.flatnonzero(np.append(True, own[1:] != own[:-1])[: len(own)])
                n = np.diff(np.append(new, len(own)))
                hot = n > max(1, len(own) / (2 * HOT_SHARE * buckets), len(sets) / (2 * HOT_SETS))
                gram = np.concatenate([own[new[hot]].view(np.int64), [-1]])
                none = pa.nulls(len(gram), pa.int64())
                yield pa.record_batch({"doc_id": none, "row_key": none, "digest": i64(gram), "n": i64(np.append(n[hot], len(sets))), "total": i64(np.append(np.zeros(hot.sum()), len(own)))})

    return _texts(docs).mapInArrow(tidied(run), "doc_id long, row_key long, digest long, n long, total long")


def hot_grams(told: DataFrame, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """(grams in order, their levels)."""
    g = told.where("doc_id is null").groupBy("digest").agg(F.sum("n").alias("n"), F.sum("total").alias("total"))
    every = g.where("digest = -1").first()
    least = max(every["total"] / (2 * HOT_SHARE * buckets), every["n"] / (2 * HOT_SETS)) if every else 0
    rows = g.where((F.col("digest") >= 0) & (F.col("n") > F.lit(max(1.0, least)))).select("digest", "n").toPandas().sort_values("digest")
    return rows["digest"].to_numpy(np.int64).view(np.uint64), level_of(np.maximum(2, rows["n"].to_numpy(np.float64)))


#: columns of the messages by which sets get their shared grams back
RETURN = ("sets", "sizes", "counts", "low", "level")
PACKED = "bucket int, hot boolean, sets binary, sizes binary, counts binary, sigs binary"


def _packed(it, buckets: int, whole: bool, hot: np.ndarray | None = None):
    """Messages, one for each bucket, of signatures (in order of sets, `counts` of each set) from tuples (digests, sizes, counts, signatures).

    whole: bucket and message tell all of a signature, a gram of HASH_BITS bits; else 32 bits of it go, which is enough to
    propose candidates. hot: grams, in order, that go in messages of their own, by their places in hot, to their sets' buckets.
    """

    def flush():
        dig, size, count, sig = (np.concatenate(x) for x in zip(*held))
        n = np.uint64(buckets)
        doc = np.repeat(np.arange(len(count), dtype=np.int32), count)
        bucket = (sig % n if whole else (sig >> np.uint64(32)) % n).astype(np.uint32)
        low = sig // n if whole else sig.astype(np.uint32)
        if hot is not None and len(hot):
            at = np.minimum(np.searchsorted(hot, sig), len(hot) - 1)
            is_hot = hot[at] == sig
            low[is_hot] = at[is_hot].astype(np.uint64)
            bucket[is_hot] = buckets + (dig % n)[doc[is_hot]].astype(np.uint32)
            del at, is_hot
        bucket = bucket.astype(np.uint16 if buckets < 1 << 15 else np.uint32)
        order = np.argsort(bucket, kind="stable")
        doc, low = doc[order], low[order]
        edge = np.searchsorted(bucket[order], np.arange(2 * buckets + 1))
        rows: dict[str, list] = {k: [] for k in ("bucket", "hot", "sets", "sizes", "counts", "sigs")}
        for r in np.flatnonzero(np.diff(edge)):
            a, z = edge[r], edge[r + 1]
            new = np.flatnonzero(np.diff(doc[a:z], prepend=-1))
            d = doc[a:z][new]
            for k, v in (("bucket", r % buckets), ("hot", r >= buckets), ("sets", dig[d].tobytes()), ("sizes", size[d].astype(np.int32).tobytes()), ("counts", np.diff(new, append=z - a).astype(np.int32).tobytes()), ("sigs", _six(low[a:z]) if whole else low[a:z].tobytes())):
                rows[k].append(v)
        return pa.record_batch({"bucket": pa.array(rows["bucket"], pa.int32()), "hot": pa.array(rows["hot"], pa.bool_()), **{k: pa.array(rows[k], pa.binary()) for k in ("sets", "sizes", "counts", "sigs")}})

    held, n = [], 0
    for x in it:
        held.append(x)
        n += len(x[3])
        if n > FLUSH:
            yield flush()
            held, n = [], 0
    if held:
        yield flush()


def _postings(it, whole: bool):
    """(digests of the sets, their sizes, signature by posting entry, set by entry, bucket) of a bucket's messages, with equal
    signatures together, without signatures of one set; None if nothing is left. whole: as in _packed()."""
    cols = {k: [] for k in ("bucket", "sets", "sizes", "counts", "sigs")}
    for b in it:
        for k in cols:
            cols[k] += b.column(k).to_pylist()
    if not cols["sigs"]:
        return None
    bucket = cols["bucket"][0]
    dig, size, count = (np.frombuffer(b"".join(cols.pop(k)), t) for k, t in (("sets", np.uint64), ("sizes", np.int32), ("counts", np.int32)))
    sig = b"".join(cols.pop("sigs"))
    uniq, of = np.unique(dig, return_inverse=True)  # equal sets are one
    size_of = np.zeros(len(uniq), np.int64)
    size_of[of] = size
    if whole:
        every, member_of = _from_six(sig), np.repeat(of.astype(np.uint32), count)
        parts = []
        for r in range(PASSES):  # a share of the signatures at a time, for memory
            some = np.flatnonzero(every % np.uint64(PASSES) == r)
            sig, member = every[some], member_of[some]
            order = np.argsort(sig)
            same = np.append(False, sig[order[1:]] == sig[order[:-1]])[: len(sig)]
            same[:-1] |= same[1:]
            order = order[same]  # only those that occur again are put in full order
            sig, member = sig[order], member[order]
            order = np.lexsort((member, sig))
            sig, member = sig[order], member[order]
            new = np.append(True, (sig[1:] != sig[:-1]) | (member[1:] != member[:-1]))[: len(sig)]
            sig, member = sig[new], member[new]
            shared = np.append(False, sig[1:] == sig[:-1])[: len(sig)]
            shared[:-1] |= shared[1:]
            parts.append((sig[shared], member[shared].astype(np.int64)))
        sig, member = (np.concatenate(x) for x in zip(*parts))
        return (uniq, size_of, sig, member, bucket) if len(sig) else None
    key = np.frombuffer(sig, np.uint32).astype(np.uint64)
    del sig
    key <<= np.uint64(32)
    key |= np.repeat(of.astype(np.uint32), count)
    key.sort()
    key = key[np.append(True, key[1:] != key[:-1])]
    same = np.append(False, (key[1:] ^ key[:-1]) < np.uint64(1 << 32))  # the signature of the entry before
    shared = same.copy()
    shared[:-1] |= same[1:]
    key = key[shared]
    return (uniq, size_of, key >> np.uint64(32), (key & np.uint64(0xFFFFFFFF)).astype(np.int64), bucket) if len(key) else None


def level_of(df) -> np.ndarray:
    return np.minimum(255, 8 * np.log2(df)).astype(np.uint8)


def repeated(docs: DataFrame, buckets: int, frequent: int, hot: np.ndarray, hot_level: np.ndarray) -> DataFrame:
    """(digest, size, rare, grams) of the sets that may have a match: their grams that other sets have, too, in order (the
    first `rare` of them are of the rare class). hot: see hot_grams()."""
    shared = docs.sparkSession.sparkContext.broadcast((hot, hot_level))

    def emit(it):
        def parts():
            seen: set = set()
            for b in it:
                data, off = buffer_of(b.column("text"))
                for first, last in _pieces(off):
                    h, bounds = gram_sets(Words(data, off, first, last))
                    dig = digests(h, bounds)
                    new = _firsts(dig, seen, np.diff(bounds))
                    h, bounds = _taken(h, bounds, new)
                    yield dig[new], np.diff(bounds), np.diff(bounds), h

        yield from _packed(parts(), buckets, True, shared.value[0])

    def back(it):
        there = []

        def cold():
            for b in it:
                is_hot = b.column("hot")
                if not is_hot.true_count:
                    yield b
                    continue
                x = b.filter(is_hot)  # these are at their sets' buckets already
                level = [shared.value[1][_from_six(y).astype(np.int64)].tobytes() for y in x.column("sigs").to_pylist()]
                there.append(pa.record_batch({"goes": x.column("bucket"), "bucket": pa.array(np.full(len(x), -1, np.int32)), **{k: x.column(k) for k in ("sets", "sizes", "counts")}, "low": x.column("sigs"), "level": pa.array(level, pa.binary())}))
                yield b.filter(pc.invert(is_hot))

        p = _postings(cold(), True)
        while there:
            yield there.pop()
        if p is None:
            return
        uniq, size, sig, member, bucket = p
        new = np.flatnonzero(np.concatenate([[True], sig[1:] != sig[:-1]]))
        df = np.diff(np.append(new, len(sig)))
        level = np.repeat(level_of(df), df)
        goes = (uniq % np.uint64(buckets)).astype(np.int64)[member]
        order = np.lexsort((member, goes))
        goes, sig, level, member = goes[order], sig[order], level[order], member[order]
        edge = np.searchsorted(goes, np.arange(buckets + 1))
        rows: dict[str, list] = {k: [] for k in ("goes", *RETURN)}
        for r in np.flatnonzero(np.diff(edge)):
            a, z = edge[r], edge[r + 1]
            new = np.flatnonzero(np.diff(member[a:z], prepend=-1))
            m = member[a:z][new]
            for k, v in (("goes", r), ("sets", uniq[m].tobytes()), ("sizes", size[m].astype(np.int32).tobytes()), ("counts", np.diff(new, append=z - a).astype(np.int32).tobytes()), ("low", _six(sig[a:z])), ("level", level[a:z].tobytes())):
                rows[k].append(v)
        n = len(rows["goes"])
        yield pa.record_batch({"goes": pa.array(rows["goes"], pa.int32()), "bucket": pa.array(np.full(n, bucket, np.int32)), **{k: pa.array(rows[k], pa.binary()) for k in RETURN}})

    def gather(it):
        cols: dict[str, list] = {k: [] for k in ("bucket", *RETURN)}
        for b in it:
            for k in cols:
                cols[k] += b.column(k).to_pylist()
        if not cols["sets"]:
            return
        dig = np.frombuffer(b"".join(cols["sets"]), np.int64)
        size = np.frombuffer(b"".join(cols["sizes"]), np.int32).astype(np.int64)
        n = np.frombuffer(b"".join(cols["counts"]), np.int32)
        bucket = np.repeat(np.array(cols["bucket"], np.int32), [len(x) // 8 for x in cols.pop("sets")])
        bucket, gram = np.repeat(bucket, n), _from_six(b"".join(cols.pop("low")))
        at = np.flatnonzero(bucket < 0)
        hot_gram = shared.value[0][gram[at].astype(np.int64)]
        bucket[at] = 0
        gram *= np.uint64(buckets)
        np.add(gram, bucket, out=gram, dtype=np.uint64, casting="unsafe")
        gram[at] = hot_gram
        del bucket, hot_gram
        level = np.frombuffer(b"".join(cols.pop("level")), np.uint8)
        uniq, first, of = np.unique(dig, return_index=True, return_inverse=True)
        who = np.repeat(of, n)
        if len(at):  # several tasks may have sent the set
            order = at[np.lexsort((gram[at], who[at]))]
            twin = order[1:][(gram[order[1:]] == gram[order[:-1]]) & (who[order[1:]] == who[order[:-1]])]
            one = np.ones(len(who), bool)
            one[twin] = False
            who, level, gram = who[one], level[one], gram[one]
        r = np.bincount(who, minlength=len(uniq))
        size = size[first]
        may = (r >= least_overlap(size)) & (size > 1)
        keep = may[who]
        who, level, gram = who[keep], level[keep], gram[keep]
        order = np.lexsort((mix(gram), level, who))
        who, level, gram = who[order], level[order], gram[order]
        rare = np.bincount(who[level < frequent], minlength=len(uniq))
        edge = np.searchsorted(who, np.arange(len(uniq) + 1))
        at = np.flatnonzero(may)
        for k in range(0, len(at), 10_000):
            x = at[k : k + 10_000]
            yield pa.record_batch({"digest": i64(uniq[x]), "size": i64(size[x]), "rare": i64(rare[x]), "grams": pa.array([gram[edge[i] : edge[i + 1]].tobytes() for i in x], pa.binary())})

    rows = _texts(docs).mapInArrow(tidied(emit), PACKED).repartitionById(buckets, F.col("bucket")).mapInArrow(tidied(back), "goes int, bucket int, " + ", ".join(f"{k} binary" for k in RETURN))
    return rows.repartitionById(buckets, F.col("goes")).mapInArrow(tidied(gather), "digest long, size long, rare long, grams binary")


def _grams_of(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    data, off = buffer_of(col)
    return np.frombuffer(data.tobytes(), np.uint64), off // 8


def _combos(h: np.ndarray, n1: int, size: int, tau: int) -> list[np.ndarray]:
    """Signatures of the frequent class of one set: for each size class of its possible matches, pairs in partitions."""
    out = []
    p, q = THETA
    for b in range(int(least_overlap(size)).bit_length() - 1, int(size * q // p).bit_length()):
        parts = max(1, (1 << b) // 8)
        strength, groups, sigs = n1, {}, []
        with np.errstate(over="ignore"):
            own = mix(h[n1:] + np.uint64(b + 1) * np.uint64(0xA0761D6478BD642F))
            part = (own % np.uint64(parts)).tolist()
            for x, g in zip(own, part):
                have = groups.setdefault(g, [])
                sigs += [x * np.uint64(3) + y if x < y else y * np.uint64(3) + x for y in have]
                strength += bool(have)
                have.append(x)
                if strength > tau:
                    break
        if sigs:
            out.append(mix(np.array(sigs, np.uint64)))
    return out


def prefixes(h: np.ndarray, bounds: np.ndarray, size: np.ndarray, rare: np.ndarray):
    """(signatures, number of signatures of each set). h: the shared grams of each set, in order."""
    tau = size - least_overlap(size) - (size - np.diff(bounds))  # what may still be missed, beside the grams of its own
    singles = np.minimum(rare, tau + 1)
    at = np.repeat(bounds[:-1], singles) + np.arange(singles.sum()) - np.repeat(np.cumsum(singles) - singles, singles)
    sig, count = mix(h[at] + np.uint64(0x2545F4914F6CDD1D)), singles.copy()
    lacking = np.flatnonzero(singles < tau + 1)
    if len(lacking):
        cuts = np.cumsum(singles)
        parts, last = [], 0
        for d in lacking:
            parts.append(sig[last : cuts[d]])
            more = _combos(h[bounds[d] : bounds[d + 1]], int(rare[d]), int(size[d]), int(tau[d]))
            parts += more
            count[d] += sum(map(len, more))
            last = cuts[d]
        sig = np.concatenate([*parts, sig[last:]])
    return sig, count


def stars(sets: DataFrame, buckets: int) -> DataFrame:
    """(leader, member) digests of the sets that share a signature with their posting's least member."""

    def emit(it):
        def parts():
            for b in it:
                h, bounds = _grams_of(b.column("grams"))
                size = np.asarray(b.column("size"))
                sig, count = prefixes(h, bounds, size, np.asarray(b.column("rare")))
                yield np.asarray(b.column("digest")).view(np.uint64), size, count, sig

        yield from _packed(parts(), buckets, False, None)

    def reduce(it):
        p = _postings(it, False)
        if p is None:
            return
        uniq, size_of, sig, member, _ = p
        order = np.lexsort((size_of[member], sig))
        sig, member = sig[order], member[order]
        s = size_of[member]
        # a posting falls apart where sizes are too far from each other for a match
        new = np.concatenate([[True], (sig[1:] != sig[:-1]) | (least_overlap(s[1:]) > s[:-1])])
        run = np.cumsum(new) - 1
        lead = np.minimum.reduceat(member, np.flatnonzero(new))[run]
        pair = np.unique(lead[lead != member].astype(np.uint64) << np.uint64(32) | member[lead != member].astype(np.uint64))
        yield pa.record_batch({"leader": signed(uniq[(pair >> np.uint64(32)).astype(np.int64)]), "member": signed(uniq[(pair & np.uint64(0xFFFFFFFF)).astype(np.int64)])})

    return sets.mapInArrow(tidied(emit), PACKED).repartitionById(buckets, F.col("bucket")).mapInArrow(tidied(reduce), "leader long, member long").distinct()


def _compare(sets: list[np.ndarray], size: np.ndarray, first: np.ndarray, second: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(i, j, overlap) of the pairs i in first, j in second that reach THETA, i != j; each unordered pair once.

    sets: of each set of a size the grams that it shares with any other.
    """
    m = len(sets)
    who = np.repeat(np.arange(m), [len(x) for x in sets])
    tok = np.concatenate(sets)
    order = np.argsort(tok, kind="stable")
    tok, who = tok[order], who[order]
    new = np.concatenate([[True], tok[1:] != tok[:-1]])
    run = np.cumsum(new) - 1
    width = np.bincount(run)
    keep = width[run] > 1
    run, who = run[keep], who[keep]
    _, run = np.unique(run, return_inverse=True)
    width = np.bincount(run) if len(run) else np.zeros(0, np.int64)
    c = np.zeros((m, m), np.int32)
    heavy = width > max(4, m // 16)
    # grams of many sets: products of 0/1 matrices, some columns at a time; others: pair by pair
    cols = np.flatnonzero(heavy)
    if len(cols):
        place = np.full(len(width), -1)
        place[cols] = np.arange(len(cols))
        h = place[run] >= 0
        hw, hp = who[h], place[run][h]
        step = max(1, (8 << 20) // max(m, 1))
        for a in range(0, len(cols), step):
            part = (hp >= a) & (hp < a + step)
            x = np.zeros((m, min(step, len(cols) - a)), np.float32)
            x[hw[part], hp[part] - a] = 1
            c += (x @ x.T).astype(np.int32)
    light = ~heavy[run] if len(run) else np.zeros(0, bool)
    lr, lw = run[light], who[light]
    if len(lr):
        end = np.searchsorted(lr, lr, side="right")
        n = end - np.arange(len(lr)) - 1
        for a in range(0, len(lr), 1 << 18):
            z = slice(a, a + (1 << 18))
            left = np.repeat(np.arange(len(lr))[z], n[z])
            right = left + 1 + np.arange(len(left)) - np.repeat(np.cumsum(n[z]) - n[z], n[z])
            np.add.at(c, (lw[left], lw[right]), 1)
            np.add.at(c, (lw[right], lw[left]), 1)
    i, j = np.nonzero(np.triu(c, 1))
    p, q = THETA
    o = c[i, j].astype(np.int64)
    good = q * o >= p * (size[i] + size[j] - o)
    i, j, o = i[good], j[good], o[good]
    cross = (first[i] & second[j]) | (first[j] & second[i])
    return i[cross], j[cross], o[cross]


def bitmap(h: np.ndarray, size: int) -> np.ndarray:
    """A set's shared grams as bits, in a power of two of at least two bits a gram of the set."""
    width = 1 << max(6, int(2 * size - 1).bit_length())
    bits = np.zeros(width, bool)
    bits[(mix(h) & np.uint64(width - 1)).astype(np.int64)] = True
    return np.packbits(bits, bitorder="little").view(np.uint64)


def sift(size: np.ndarray, own: np.ndarray, maps: list[np.ndarray], first: np.ndarray, second: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(i, j) of the pairs that can reach THETA by size and bitmaps; each bit by which two maps differ is a gram that they don't share,
    as are the grams that only one set has (own: their numbers).

    Maps of sizes that can match differ in width by a factor of two at most, and the wider is folded.
    """
    p, q = THETA
    out = []
    words = np.array([len(x) for x in maps])
    for w in np.unique(words):
        at = np.flatnonzero((words == w) | (words == 2 * w))
        x = np.stack([maps[k] if len(maps[k]) == w else maps[k][:w] | maps[k][w:] for k in at])
        step = max(1, (2 << 20) // max(1, w * len(at)))
        for a in range(0, len(at), step):
            i, j = np.meshgrid(np.arange(a, min(a + step, len(at))), np.arange(len(at)), indexing="ij")
            i, j = i.ravel(), j.ravel()
            u, v = at[i], at[j]
            s = size[u] + size[v]
            fit = (i < j) & ((words[u] == w) | (words[v] == w)) & (q * np.minimum(size[u], size[v]) >= p * np.maximum(size[u], size[v])) & ((first[u] & second[v]) | (first[v] & second[u]))
            i, j, u, v, s = i[fit], j[fit], u[fit], v[fit], s[fit]
            apart = np.bitwise_count(x[i] ^ x[j]).sum(1, dtype=np.int64) + own[u] + own[v]
            good = (p + q) * (s - apart) >= 2 * p * s
            out.append((u[good], v[good]))
    return np.concatenate([o[0] for o in out]), np.concatenate([o[1] for o in out])


def membership(edges: DataFrame, rep: DataFrame) -> DataFrame:
    """(leader, member, copies, lower): the members of each star, with their numbers of documents and the lesser leaders of their other stars."""
    members = edges.select("leader", "member").union(edges.select("leader", F.col("leader").alias("member"))).distinct()
    other = members.groupBy("member").agg(F.collect_set("leader").alias("stars")).where(F.size("stars") > 1)
    copies = rep.where("n > 1").select(F.col("digest").alias("member"), F.col("n").alias("copies"))
    return members.join(other, "member", "left").join(copies, "member", "left").select("leader", "member", F.coalesce("copies", F.lit(1)).alias("copies"), F.filter("stars", lambda x: x < F.col("leader")).alias("lower"))


def _shipped(sets: DataFrame, members: DataFrame, buckets: int, as_bits: bool) -> DataFrame:
    """(leader, i, j, own, digest, copies, lower, size, shared, body): the sets of each star's members, as bitmaps or in full, in the star's tasks."""
    big = members.groupBy("leader").agg(F.count("*").alias("m")).where(F.col("m") > STAR)
    g = F.expr(f"(coalesce(m, 1) + {STAR - 1}) div {STAR}")
    routed = members.join(big, "leader", "left").withColumn("g", g).withColumn("own", F.pmod(F.hash("member"), F.col("g")))
    routed = routed.withColumn("other", F.explode(F.expr("sequence(0L, g - 1)")))
    routed = routed.select("leader", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", F.col("member").alias("digest"), "copies", "lower")

    def body(b: pa.RecordBatch):
        h, bounds = _grams_of(b.column("grams"))
        size = np.asarray(b.column("size"))
        own = [h[a:z] for a, z in zip(bounds, bounds[1:])]
        x = [bitmap(v, int(n)).tobytes() if as_bits else v.tobytes() for v, n in zip(own, size)]
        yield pa.record_batch({"digest": b.column("digest"), "size": i64(size), "shared": i64(np.diff(bounds)), "body": pa.array(x, pa.binary())})

    bodies = arrow_map(sets.select("digest", "size", "grams").join(members.select(F.col("member").alias("digest")).distinct(), "digest", "left_semi"), body, "digest long, size long, shared long, body binary")
    return routed.join(bodies, "digest").repartition(buckets, "leader", "i", "j")


def _stars_of(it):
    """(digests, numbers of documents, sizes, numbers of shared grams, bodies, in the first part, in the second part, pairs that are this star's) of each star of a task."""
    cols = {k: [] for k in ("leader", "i", "j", "own", "digest", "copies", "size", "shared")}
    body: list = []
    lower: list = []
    for b in it:
        for k in cols:
            cols[k].append(np.asarray(b.column(k)))
        body += b.column("body").to_pylist()
        lower += b.column("lower").to_pylist()
    if not body:
        return
    c = {k: np.concatenate(v) for k, v in cols.items()}
    order = np.lexsort((c["digest"], c["j"], c["i"], c["leader"]))
    c = {k: v[order] for k, v in c.items()}
    edge = np.flatnonzero(np.concatenate([[True], (np.diff(c["leader"]) != 0) | (np.diff(c["i"]) != 0) | (np.diff(c["j"]) != 0)]))
    for a, z in zip(edge, np.append(edge[1:], len(order))):
        if z - a > 1:
            own = c["own"][a:z]
            rows = order[a:z]
            yield c["leader"][a], c["digest"][a:z], c["copies"][a:z], c["size"][a:z], c["shared"][a:z], [body[k] for k in rows], own == c["i"][a], own == c["j"][a], _claims([lower[k] for k in rows])


def _claims(lower: list):
    """A function of pairs (i, j) that tells which of them no star of a lesser leader has, too. lower: lesser leaders of each member."""
    who = np.repeat(np.arange(len(lower)), [len(x) if x else 0 for x in lower])
    of = np.array([y for x in lower if x for y in x], np.int64)
    _, of, n = np.unique(of, return_inverse=True, return_counts=True)
    who, of = who[n[of] > 1], of[n[of] > 1]  # a leader of one member is no pair's
    _, of = np.unique(of, return_inverse=True)

    def mine(i: np.ndarray, j: np.ndarray) -> np.ndarray:
        out = np.ones(len(i), bool)
        for a in range(0, int(of.max()) + 1 if len(of) else 0, 4096):
            some = (of >= a) & (of < a + 4096)
            has = np.zeros((len(lower), min(4096, int(of.max()) + 1 - a)), bool)
            has[who[some], of[some] - a] = True
            bits = np.packbits(has, axis=1)
            for k in range(0, len(i), 1 << 16):
                z = slice(k, k + (1 << 16))
                out[z] &= ~(bits[i[z]] & bits[j[z]]).any(1)
        return out

    return mine


def _rows(names: tuple[str, ...], parts):
    """Record batches of some size from tuples of arrays."""
    held, n = [], 0
    for x in parts:
        held.append(x)
        n += len(x[0])
        if n > 500_000:
            yield pa.record_batch({k: i64(np.concatenate(v)) for k, v in zip(names, zip(*held))})
            held, n = [], 0
    if held:
        yield pa.record_batch({k: i64(np.concatenate(v)) for k, v in zip(names, zip(*held))})


def likely(sets: DataFrame, members: DataFrame, buckets: int) -> DataFrame:
    """The rows of members that have a partner in their star which can reach THETA by size and bitmaps."""

    def run(it):
        def parts():
            for lead, dig, _, size, shared, body, first, second, mine in _stars_of(it):
                i, j = sift(size, size - shared, [np.frombuffer(x, np.uint64) for x in body], first, second)
                good = mine(i, j)
                some = np.unique(np.concatenate([i[good], j[good]]))
                yield np.full(len(some), lead), dig[some]

        yield from _rows(("leader", "member"), parts())

    some = _shipped(sets, members, buckets, True).mapInArrow(tidied(run), "leader long, member long").distinct()
    return members.join(some, ["leader", "member"], "left_semi")


def _matching(it):
    """(digests, numbers of documents, sizes, i, j, overlaps) of the pairs at THETA or more of each star of a task, each pair once over all stars."""
    for _, dig, copies, size, _, body, first, second, mine in _stars_of(it):
        i, j, o = _compare([np.frombuffer(x, np.uint64) for x in body], size, first, second)
        good = mine(i, j)
        yield dig, copies, size, i[good], j[good], o[good]


def _roots(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """The least number of each one's connected group."""
    low = np.arange(n)
    while True:
        new = low.copy()
        np.minimum.at(new, i, low[j])
        np.minimum.at(new, j, low[i])
        new = new[new]
        if (new == low).all():
            return low
        low = new


def _prepared(docs: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame, int]:
    """(sets by document, representatives, shared grams by set, members of stars that may match, buckets)."""
    buckets = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    wide = max(LEAST_BUCKETS, min(buckets, max(16, buckets // 2)))
    told = cut(survey(docs, wide))
    sets = cut(told.where("doc_id is not null").select("doc_id", "row_key", "digest").distinct())
    rep = sets.where("digest is not null").groupBy("digest").agg(F.min("doc_id").alias("rep"), F.count("*").alias("n"))
    frequent = int(level_of(max(2.0, FREQUENT * sets.count())))
    # a set is named once in each bucket, so for all its grams there are fewer, larger ones
    shared = cut(repeated(docs, wide, frequent, *hot_grams(told, wide)))
    members = cut(membership(stars(shared, buckets), rep))
    return sets, rep, shared, cut(likely(shared, members, buckets)), buckets


def classes(docs: DataFrame) -> DataFrame:
    """(doc_id, class_id, n_links) of each document, and its row_key, the hash of its text.

    Two documents are linked if their sets are equal or have a Jaccard of THETA or more. n_links counts all the documents
    that one is linked to; class_id is the least doc_id that chains of links lead to. So no link is lost, and neither
    copies nor near copies are expanded into pairs: there is a row a document.

    Null ids are left out; texts without words (null, empty or of marks only) have no links and are classes of their own.
    Rows that repeat a doc_id and a text are one document; with different texts they are documents each. Texts are read as
    a whole. Extra columns are not read. An empty table gives an empty result.
    """
    sets, rep, shared, members, buckets = _prepared(docs)

    def run(it):
        def parts():
            for dig, copies, _, i, j, _ in _matching(it):
                n = np.bincount(i, copies[j], len(dig)) + np.bincount(j, copies[i], len(dig))
                some = np.flatnonzero(n)
                yield dig[some], dig[_roots(len(dig), i, j)][some], n[some]

        yield from _rows(("digest", "root", "links"), parts())

    found = cut(_shipped(shared, members, buckets, False).mapInArrow(tidied(run), "digest long, root long, links long"))
    links = found.groupBy("digest").agg(F.sum("links").alias("links"))
    root = rep.select(F.col("digest").alias("root"), F.col("rep").alias("doc_b"))
    edges = found.where("digest <> root").select("digest", "root").distinct().join(rep, "digest").join(root, "root")
    group = components(edges.select(F.col("rep").alias("doc_a"), "doc_b").where("doc_a <> doc_b")).select(F.col("doc_id").alias("rep"), F.col("root").alias("least"))
    known = rep.join(links, "digest", "left").join(group, "rep", "left").select("digest", F.coalesce("least", "rep").alias("class_id"), (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"))
    # sets of very many copies are few, as all rows are at most HOT times as many: their rows are not sent to one task
    hot = F.broadcast(known.join(rep.where(F.col("n") > F.lit(sets.count() / HOT)).select("digest"), "digest", "left_semi"))
    rest = sets.join(hot, "digest", "left_anti").join(known, "digest", "left")
    every = rest.select("doc_id", "row_key", "class_id", "n_links").union(sets.join(hot, "digest").select("doc_id", "row_key", "class_id", "n_links"))
    return every.select("doc_id", F.coalesce("class_id", "doc_id").alias("class_id"), F.coalesce("n_links", F.lit(0)).alias("n_links"), "row_key")


def join(docs: DataFrame) -> DataFrame:
    """(doc_a, doc_b, jaccard), doc_a < doc_b: the links of classes() as pairs of representatives, with their Jaccard.

    Documents with equal sets are listed once each, as a pair of Jaccard 1 with their least doc_id, which stands for all of
    them in the pairs of unequal sets. Groups of near copies have as many rows as pairs: for small corpora, and for what
    is known to have few of them. Cases are as in classes(); a document is no match of itself.
    """
    sets, rep, shared, members, buckets = _prepared(docs)

    def run(it):
        def parts():
            for dig, _, size, i, j, o in _matching(it):
                low = dig[i] < dig[j]
                i, j = np.where(low, i, j), np.where(low, j, i)
                yield dig[i], dig[j], o, size[i], size[j]

        yield from _rows(("x", "y", "overlap", "sx", "sy"), parts())

    pairs = _shipped(shared, members, buckets, False).mapInArrow(tidied(run), "x long, y long, overlap long, sx long, sy long")
    copies = sets.join(rep.where("n > 1"), "digest").where("doc_id > rep").select(F.col("rep").alias("doc_a"), F.col("doc_id").alias("doc_b"), F.lit(1.0).alias("jaccard"))
    a, b = rep.select(F.col("digest").alias("x"), F.col("rep").alias("rx")), rep.select(F.col("digest").alias("y"), F.col("rep").alias("ry"))
    named = pairs.join(a, "x").join(b, "y").where("rx <> ry")
    jac = F.round(F.col("overlap") / (F.col("sx") + F.col("sy") - F.col("overlap")), 6)
    near = named.select(F.least("rx", "ry").alias("doc_a"), F.greatest("rx", "ry").alias("doc_b"), jac.alias("jaccard"))
    return near.union(copies).groupBy("doc_a", "doc_b").agg(F.max("jaccard").alias("jaccard"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row a document, with its class and number of links."""
    return classes(table(spark, sf_dir, "documents")).drop("row_key")


def components(pairs: DataFrame) -> DataFrame:
    """(doc_id, root): each document of a pair with the least doc_id of its connected group."""
    e = pairs.select(F.col("doc_a").alias("a"), F.col("doc_b").alias("b"))
    e = cut(e.select(F.greatest("a", "b").alias("v"), F.least("a", "b").alias("u")).distinct())
    while True:
        # large star: every neighbour and v itself point to the least of them; small star: the same among smaller ones
        both = e.union(e.select(F.col("u").alias("v"), F.col("v").alias("u")))
        low = both.groupBy("v").agg(F.least(F.min("u"), F.first("v")).alias("m"))
        large = both.where("u > v").join(low, "v").select(F.col("u").alias("v"), F.col("m").alias("u"))
        low = large.groupBy("v").agg(F.min("u").alias("m"))
        moved = large.join(low, "v")
        nxt = moved.select("v", F.col("m").alias("u")).union(moved.where("u <> m").select(F.col("u").alias("v"), F.col("m").alias("u"))).where("v <> u").distinct()
        nxt = cut(nxt)
        if nxt.count() == e.count() and nxt.exceptAll(e).isEmpty():
            break
        e = nxt
    return e.groupBy("v").agg(F.min("u").alias("root")).select(F.col("v").alias("doc_id"), "root")


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: of each class of near copies the document of the least doc_id stays, with all its columns.

    Repeated rows stay or go alike; rows without id or without words stay.
    """
    gone = cut(classes(docs).where("class_id <> doc_id").select(F.col("doc_id").alias("_id"), F.col("row_key").alias("_key")).distinct())
    kept = docs.withColumns({(name := "_row" + "_" * max(map(len, docs.columns))): F.xxhash64(F.coalesce("text", F.lit("")))})
    at = small(gone.select(F.col("_id").alias(name + "i"), F.col("_key").alias(name + "k")), gone.count(), 24)
    return kept.join(at, (F.col("doc_id") == F.col(name + "i")) & (F.col(name) == F.col(name + "k")), "left_anti").select(*docs.columns)


SQL = f"""
WITH RECURSIVE w AS (SELECT doc_id, list_filter(string_split(regexp_replace(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^a-z0-9\\x{{80}}-\\x{{10FFFF}}]+', ' ', 'g'), ' '), lambda x: x <> '') AS ws
           FROM documents WHERE doc_id IS NOT NULL),
g AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) >= {N} THEN list_transform(range(1, len(ws) - {N - 2}), lambda i: array_to_string(ws[i:i + {N - 1}], ' '))
                                          WHEN len(ws) > 0 THEN ['#' || array_to_string(ws, ' ')] ELSE [] END) AS gram FROM w),
s AS (SELECT doc_id, count(*) AS n, md5(string_agg(gram, '|' ORDER BY gram)) AS digest FROM g GROUP BY doc_id),
r AS (SELECT doc_id, n, min(doc_id) OVER (PARTITION BY digest) AS rep, count(*) OVER (PARTITION BY digest) AS copies FROM s),
u AS (SELECT g.* FROM g JOIN r ON g.doc_id = r.doc_id AND r.rep = r.doc_id),
c AS (SELECT a.doc_id AS doc_a, b.doc_id AS doc_b, count(*) AS o FROM u a JOIN u b ON a.gram = b.gram AND a.doc_id < b.doc_id GROUP BY ALL),
p AS (SELECT doc_a, doc_b FROM c JOIN s x ON x.doc_id = doc_a JOIN s y ON y.doc_id = doc_b WHERE {THETA[1]} * o >= {THETA[0]} * (x.n + y.n - o)),
e AS (SELECT doc_a AS a, doc_b AS b FROM p UNION ALL SELECT doc_b, doc_a FROM p),
reach AS (SELECT a, b FROM e UNION SELECT reach.a, e.b FROM reach JOIN e ON reach.b = e.a),
links AS (SELECT a, sum(copies) AS n FROM e JOIN r ON r.doc_id = e.b GROUP BY a),
class AS (SELECT a, min(b) AS least FROM reach GROUP BY a)
SELECT w.doc_id, coalesce(least(class.least, r.rep), r.rep, w.doc_id)::BIGINT AS class_id, coalesce(coalesce(links.n, 0) + r.copies - 1, 0)::BIGINT AS n_links
FROM w LEFT JOIN r ON r.doc_id = w.doc_id LEFT JOIN links ON links.a = r.rep LEFT JOIN class ON class.a = r.rep
"""
