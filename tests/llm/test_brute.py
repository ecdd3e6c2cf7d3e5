"""The operators against plain Python on small inputs, and trained models against held-out labels."""

import itertools
import json
import random
import re

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from chronogeo.llm import ann, chat, decontaminate, jaccard_join, langid, mixing, pii, quality, queries, substring_dedup, suffix_dedup
from chronogeo.llm.common import table

WORD = re.compile(r"[A-Za-z0-9\x80-\U0010ffff]+")


def words(text):
    return [w.translate({c: c + 32 for c in range(65, 91)}) for w in WORD.findall(text or "")]


def grams(text, n=jaccard_join.N):
    w = words(text)
    return {tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else {tuple(w)} if w else set()


@pytest.fixture(scope="module")
def copies(spark):
    """Groups of near copies around random texts from vocabularies of any size, some of few words."""
    r = random.Random(3)
    rows = []
    for g in range(40):
        vocab = [f"v{r.randrange(10 ** r.randint(1, 4))}" for _ in range(60)]
        base = [r.choice(vocab) for _ in range(r.randint(1, 90))]
        for _ in range(r.randint(1, 6)):
            w = [x if r.random() > 0.04 else r.choice(vocab) for x in base]
            rows.append((len(rows), " ".join(w[: len(w) - r.randint(0, len(w) // 4)])))
    return rows


def brute_pairs(rows):
    sets = {i: grams(t) for i, t in rows}
    rep, first = {}, {}
    for i in sorted(sets):
        if sets[i]:
            rep[i] = first.setdefault(frozenset(sets[i]), i)
    p, q = jaccard_join.THETA
    out = {(rep[i], i): 1.0 for i in rep if rep[i] != i}
    for a, b in itertools.combinations(sorted(set(rep.values())), 2):
        o = len(sets[a] & sets[b])
        if o and q * o >= p * (len(sets[a]) + len(sets[b]) - o):
            out[a, b] = round(o / (len(sets[a]) + len(sets[b]) - o), 6)
    return out


def brute_classes(rows, pairs):
    """(class, number of links) of each row, from the pairs of representatives."""
    rep, first = {}, {}
    for i, t in sorted(rows):
        s = grams(t)
        rep[i] = first.setdefault(frozenset(s), i) if s else i
    copies = {}
    for r in rep.values():
        copies[r] = copies.get(r, 0) + 1
    links = {r: n - 1 for r, n in copies.items()}
    up = {i: i for i in rep}

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for a, b in pairs:
        if rep[b] != a:
            links[a] += copies[b]
            links[b] += copies[a]
        a, b = sorted((root(a), root(b)))
        up[b] = a
    return {i: (root(i), links[rep[i]]) for i in rep}


def brute_kept(rows, pairs):
    up = {i: i for i, _ in rows}

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for a, b in pairs:
        a, b = sorted((root(a), root(b)))
        up[b] = a
    return {i for i in up if root(i) == i}


def test_jaccard_join_is_exact(spark, copies, monkeypatch):
    want = brute_pairs(copies)
    assert len(want) > 50
    df = spark.createDataFrame(copies, "doc_id long, text string").repartition(3)
    for star, frequent in ((2048, 0.005), (3, 0.02), (2048, 0.3)):  # small stars are split; more or fewer grams are frequent
        monkeypatch.setattr(jaccard_join, "STAR", star)
        monkeypatch.setattr(jaccard_join, "FREQUENT", frequent)
        assert {(r.doc_a, r.doc_b): r.jaccard for r in jaccard_join.join(df).collect()} == want
        assert {r.doc_id: (r.class_id, r.n_links) for r in jaccard_join.classes(df).collect()} == brute_classes(copies, want)
    monkeypatch.setattr(jaccard_join, "HOT_SHARE", 500)  # many grams are hot; and so are copies, of which tasks send one
    more = copies + [(1000 + k, t) for k in range(3) for _, t in copies[:40]]
    more = [(k, t) for k, (_, t) in enumerate(more)]
    df = spark.createDataFrame(more, "doc_id long, text string").repartition(3)
    buckets = max(jaccard_join.LEAST_BUCKETS, 2)
    assert len(jaccard_join.hot_grams(jaccard_join.survey(df, buckets), buckets)[0]) > 50
    want = brute_pairs(more)
    assert {(r.doc_a, r.doc_b): r.jaccard for r in jaccard_join.join(df).collect()} == want
    assert {r.doc_id: (r.class_id, r.n_links) for r in jaccard_join.classes(df).collect()} == brute_classes(more, want)


def test_jaccard_of_long_texts(spark):
    """Sets of 300,000 grams, in which hashes of 34 bits would collide."""
    r = np.random.default_rng(4)
    base = r.integers(0, 50_000, 300_000)
    texts = []
    for k in range(4):
        w = base.copy()
        at = r.integers(0, len(w), 600 * (k + 1))
        w[at] = r.integers(0, 50_000, len(at))
        texts.append(w)
    sets = [np.unique((w[:-2] * 50_000 + w[1:-1]) * 50_000 + w[2:]) for w in texts]
    want = {}
    for a, b in itertools.combinations(range(4), 2):
        o = len(np.intersect1d(sets[a], sets[b]))
        want[a, b] = round(o / (len(sets[a]) + len(sets[b]) - o), 6)
    df = spark.createDataFrame([(k, " ".join(f"w{x}" for x in w)) for k, w in enumerate(texts)], "doc_id long, text string")
    assert {(x.doc_a, x.doc_b): x.jaccard for x in jaccard_join.join(df).collect()} == want


def test_a_group_of_near_copies_is_a_row_each(spark):
    """600 near copies have 180,000 links."""
    r = random.Random(2)
    base = [f"b{r.randrange(900)}" for _ in range(200)]
    rows = [(i, " ".join(x if k != i % 200 else f"n{i}" for k, x in enumerate(base))) for i in range(600)]
    got = jaccard_join.classes(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert len(got) == 600 and {(x.class_id, x.n_links) for x in got} == {(0, 599)}


def brute_passages(rows, least=substring_dedup.MIN_WORDS):
    """What is left of each text, unit by unit in order of ranks."""
    units, order = [], sorted(rows)
    for i, t in order:
        ms = list(WORD.finditer(t))
        opens = [k for k in range(len(ms)) if k == 0 or re.search("[.!?,;:\n]", t[ms[k - 1].end() : ms[k].start()])] + [len(ms)]
        w = words(t)
        for x, k in enumerate(opens[:-1]):
            z = next((e for e in opens[x + 1 :] if e - k >= least), len(ms) if k == 0 and len(ms) < least else None)
            if z is not None:
                units.append((i, ms[k].start(), ms[z].start() if z < len(ms) else len(t), tuple(w[k:z])))
    seen, gone = set(), {i: set() for i, _ in rows}
    for i, a, z, u in units:
        if u in seen:
            gone[i] |= set(range(a, z))
        seen.add(u)
    return {i: "".join(c for k, c in enumerate(t) if k not in gone[i]) for i, t in rows}


def test_passages_are_cut(spark, monkeypatch):
    r = random.Random(12)
    phrase = lambda n: " ".join(f"w{r.randrange(40)}" for _ in range(n))
    passages = ["".join(phrase(r.randint(1, 9)) + r.choice([". ", ", ", "\n", "; é! "]) for _ in range(12)) for _ in range(6)]
    rows = []
    for i in range(60):
        parts = []
        for _ in range(r.randint(0, 3)):
            p = r.choice(passages)
            a = r.randint(0, 30)
            parts += [phrase(r.randint(0, 12)) + r.choice([" ", ". "]), p[a : len(p) - r.randint(0, 30)], " Üb " + phrase(3)]
        rows.append((i, "".join(parts)))
    rows += [(97, "one. two, three"), (98, "One two; three!"), (99, "again and. " * 60)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    want = brute_passages(rows)
    assert sum(want[i] != t for i, t in rows) > 20 and want[98] == ""
    for held in (substring_dedup.HELD, 50):  # tasks that reduce their units once, or again and again
        monkeypatch.setattr(substring_dedup, "HELD", held)
        got = substring_dedup.dedup(df).collect()
        assert {x.doc_id: x.text for x in got} == want
        assert all(x.n_removed == len([y for y in x.removed.split(",") if y]) for x in got)


def test_near_duplicates_leave_one_of_each_group(spark, copies, sf):
    df = spark.createDataFrame(copies, "doc_id long, text string")
    assert {r.doc_id for r in jaccard_join.stage(spark, df, sf).collect()} == brute_kept(copies, brute_pairs(copies))


def brute_tiles(item, doc, k):
    """Greedy string tiling as it is told: the longest common run of unmarked words, first in item, then in document."""
    mi, md, tiles = set(), set(), []
    while True:
        best = (0, 0, 0)
        for a in range(len(item)):
            for b in range(len(doc)):
                n = 0
                while a + n < len(item) and b + n < len(doc) and item[a + n] == doc[b + n] and a + n not in mi and b + n not in md:
                    n += 1
                if n > best[0]:
                    best = (n, a, b)
        if best[0] < k:
            return tiles
        n, a, b = best
        mi |= set(range(a, a + n))
        md |= set(range(b, b + n))
        tiles.append((a, b, n))


def brute_matches(doc, item):
    i, d = words(item), words(doc)
    tiles = brute_tiles(i, d, decontaminate.MIN_TILE)
    got = sum(t[2] for t in tiles)
    return (round(got / len(i), 6), len(tiles), got) if i and tiles and got >= decontaminate.THRESHOLD * len(i) else None


def tiling_case():
    r = random.Random(8)
    items = [(k, " ".join(f"b{r.randrange(30)}" for _ in range(r.randint(2, 25)))) for k in range(12)]
    docs = []
    for k in range(40):
        parts = [f"x{r.randrange(9)} " * r.randint(1, 6)]
        for _ in range(r.randint(0, 3)):
            w = r.choice(items)[1].split()
            a = r.randrange(len(w))
            cut = [" ".join(w[a:]), " ".join(w[:a])]  # reordered
            parts += [*cut, f"y{r.randrange(9)}"]
        docs.append((k, " ".join(parts)))
    return items, docs


def test_string_tiling(spark, monkeypatch):
    items, docs = tiling_case()
    want = {(d, i): m for d, t in docs for i, x in items if (m := brute_matches(t, x))}
    assert len(want) > 10 and any(m[1] > 1 for m in want.values())
    a, b = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    read = lambda df: {(r.doc_id, r.item_id): (r.coverage, r.n_tiles, r.matched_words) for r in df.collect()}
    assert read(decontaminate.matches(a, b)) == want
    assert {r.doc_id for r in decontaminate.clean(a, b).collect()} == {d for d, _ in docs} - {d for d, _ in want}
    monkeypatch.setattr(decontaminate, "INDEX_BYTES", 0)  # a benchmark too large for the tasks
    assert read(decontaminate.matches(a, b)) == want
    assert {r.doc_id for r in decontaminate.clean(a, b).collect()} == {d for d, _ in docs} - {d for d, _ in want}


def brute_spans(rows):
    n, seen, out = suffix_dedup.LENGTH, {}, []
    for i, t in sorted(rows):
        ms = list(WORD.finditer(t))
        w = words(t)
        hit = []
        for s in range(len(w) - n + 1):
            k = tuple(w[s : s + n])
            if k in seen:
                hit.append((s, seen[k]))
            else:
                seen[k] = i
        for s, src in hit:
            if out and out[-1][0] == i and s <= out[-1][2]:
                out[-1][2], out[-1][3] = s + n, min(out[-1][3], src)
            else:
                out.append([i, s, s + n, src])
        for o in out:
            if o[0] == i and len(o) == 4:
                o += [ms[o[1]].start(), ms[o[2] - 1].end()]
    return sorted((i, a, z, e - s, src) for i, s, e, src, a, z in out)


def test_suffix_array_is_exact(spark, monkeypatch):
    r = random.Random(5)
    passages = [" ".join(f"p{k}q{r.randrange(40)}" for _ in range(r.randint(50, 120))) for k in range(8)]
    rows = []
    for i in range(40):
        parts = []
        for _ in range(r.randint(1, 4)):
            w = r.choice(passages).split()
            a = r.randint(0, 20)
            parts += [" ".join(w[a : len(w) - r.randint(0, 20)]), "é, " * r.randint(0, 2) + " ".join(f"u{r.randrange(10**6)}" for _ in range(r.randint(0, 30)))]
        rows.append((i, ". ".join(parts)))
    rows.append((99, "same word " * 200))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    # many tasks or one, which holds all its suffixes or few: more or fewer of them follow others
    for held, parts in ((suffix_dedup.HELD, 4), (suffix_dedup.HELD, 1), (40, 2)):
        monkeypatch.setattr(suffix_dedup, "HELD", held)
        monkeypatch.setattr(suffix_dedup, "HELD_AROUND", min(held, 200_000))
        got = sorted(map(tuple, suffix_dedup.repeats(df.repartition(parts)).collect()))
        assert len(got) > 20 and got == brute_spans(rows)


def test_neighbours_recall(spark, sf):
    e = table(spark, "/root/testdata/sf0.1", "embeddings")
    x = e.toPandas().sort_values("vec_id")
    v, ids = np.stack(x["embedding"]), x["vec_id"].to_numpy()
    ask = ids % ann.QUERY_EVERY == 0
    d = ((v[ask][:, None] - v[None]) ** 2).sum(2)
    d[ids[ask][:, None] == ids] = np.inf
    best = ids[np.argsort(d, 1)[:, : ann.TOP]]
    got = {}
    for block in (ann.BLOCK, 16):  # queries that go at once, or in blocks
        rows = ann.neighbours(e, block=block).collect()
        got = {}
        for r in rows:
            got.setdefault(r.vec_id, set()).add(r.neighbour_id)
        assert set(got) == set(ids[ask].tolist()) and all(len(s) == ann.TOP for s in got.values())
        assert sum(len(got[i] & set(b.tolist())) for i, b in zip(ids[ask], best)) / best.size >= 0.9


def test_codes_do_the_work():
    """On 20,000 vectors in wide groups the codes leave a small share for exact distances, and recall stays high."""
    r = np.random.default_rng(6)
    x = r.normal(size=(20_000, 64)) + r.normal(size=(10, 64))[r.integers(0, 10, 20_000)]
    x = (x / np.linalg.norm(x, axis=1)[:, None]).astype(np.float32)
    ids = np.arange(len(x))
    books = ann.fit(x[: ann.FIT_ROWS])
    index = ann.beam_encode(x, books)
    q = ids % ann.QUERY_EVERY == 0
    want = np.argsort(((x[q] ** 2).sum(1)[:, None] + (x**2).sum(1) - 2 * x[q] @ x.T) + np.where(ids[q][:, None] == ids, 9, 0), 1)[:, : ann.TOP]

    def search(spread):
        s = ann.Search(ids[q], x[q], ann.pivot_bound(ids[q], x[q], ids[: ann.PIVOTS], x[: ann.PIVOTS], ann.TOP), books, ann.TOP, spread)
        s.add(ids, x, *index)
        hit = {(c, n) for c, n, _ in zip(*s.best)}
        return sum((c, n) in hit for c, row in enumerate(want) for n in row.tolist()) / want.size, s.reranked / (q.sum() * len(x))

    recall, share = search(ann.SPREAD)
    print("recall", recall, "reranked", share)
    assert recall >= 0.95 and share < 0.1
    assert search(8.0)[0] == 1.0  # the root of the dimension: exact


def test_beam_search_beats_greedy():
    r = np.random.default_rng(1)
    x = r.normal(size=(300, 8)).astype(np.float32)
    books = [r.normal(size=(16, 8)).astype(np.float32) for _ in range(3)]
    err = lambda codes: ((x - sum(b[codes[:, k]] for k, b in enumerate(books))) ** 2).sum()
    greedy, beam = ann.beam_encode(x, books, 1), ann.beam_encode(x, books, 16)
    assert err(beam[0]) < err(greedy[0])
    approx = sum(b[beam[0][:, k]] for k, b in enumerate(books))
    assert np.allclose(beam[1], (approx**2).sum(1), rtol=1e-3, atol=1e-3) and np.allclose(beam[2], np.sqrt(((x - approx) ** 2).sum(1)), rtol=1e-3, atol=1e-3)
    assert np.allclose(beam[3], ((x - approx) * x).sum(1) / (x * x).sum(1), rtol=1e-3, atol=1e-3)


def test_language_accuracy(spark):
    docs = table(spark, "/root/testdata/sf0.01", "documents")
    train, rest = docs.where("doc_id % 2 = 0"), docs.where("doc_id % 2 = 1")
    got = langid.identify(rest, langid.train(train)).join(rest.select("doc_id", "lang"), "doc_id").where("lang is not null and pred_lang <> 'und'").toPandas()
    assert (got["pred_lang"] == got["lang"]).mean() > 0.97 and got["accepted"].mean() > 0.98


def test_tables_are_the_network():
    r = np.random.default_rng(2)
    net = langid.Net(["a", "b", "c"])
    x = r.integers(0, 256, (20, langid.WINDOW)).astype(np.uint8)
    assert np.allclose(np.exp(net.compile().log_prob(x)), net.forward(x)[0], atol=1e-4)


def test_decisions_are_the_networks_mean():
    """decide() against the network run on every window of every text."""
    r = random.Random(3)
    net = langid.Net(["a", "b", "c"], seed=3)
    texts = ["", "x", "é" * 200, "".join(chr(r.randrange(32, 900)) for _ in range(3000)), "ab " * 85, "abc" * 100]
    data = np.frombuffer("".join(texts).encode(), np.uint8)
    off = np.cumsum([0, *(len(t.encode()) for t in texts)])
    best, conf = langid.decide(net.compile(), data, off)
    for k, t in enumerate(texts):
        b = t.encode()
        if not b:
            assert (best[k], conf[k]) == (-1, 0)
            continue
        mean = np.zeros(3)
        for a in range(0, len(b), langid.WINDOW):
            w = b[a : a + langid.WINDOW]
            mean += net.forward(np.frombuffer(w.ljust(langid.WINDOW, b"\0"), np.uint8)[None])[0][0] * len(w) / len(b)
        assert best[k] == mean.argmax() and abs(conf[k] - mean.max()) < 1e-4


def test_scores_are_the_models_sums(spark):
    """score() of a batch against each text by itself, and the link function written out."""
    r = np.random.default_rng(5)
    w, theta = r.normal(size=1 << quality.BITS), np.array([-0.3, 0.8])
    texts = ["", None, "Some words, and SOME more!\n\nAgain.", "é" * 50, " ".join(f"w{i}" for i in range(70_000))]
    got = {x.doc_id: x for x in quality.score(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1), (w, theta)).collect()}
    for k, t in enumerate(texts):
        b = np.frombuffer((t or "").encode(), np.uint8)
        ids, _ = quality.features(b, np.array([0, len(b)]), 0, 1)
        assert len(set(ids.tolist())) == len(ids) and len(ids) >= len(set(words(t))) * 0.8  # hashed words may meet
        s = sum(float(np.float32(w[i])) for i in ids)
        tail = [1 / (1 + np.exp(min(700, th - s))) for th in theta]
        assert abs(got[k].p_top - tail[1]) < 1e-5 and abs(got[k].expected_grade - sum(tail)) < 1e-5
        assert got[k].selected == (bool(t) and tail[1] >= quality.SELECT_AT)


def test_one_grade_only(spark):
    docs = spark.createDataFrame([(i, f"some words of text {i}") for i in range(8)], "doc_id long, text string")
    for q, toxic in ((0, 0), (1, 1), (1, 0)):
        out = quality.quality_scores(docs, spark.createDataFrame([(i, q, toxic) for i in range(8)], "doc_id long, quality int, toxic int")).collect()
        assert len(out) == 8 and all(np.isfinite(x.p_top) and 0 <= x.expected_grade <= 2 for x in out)


def test_quality_on_held_out_labels(spark):
    docs, lab = table(spark, "/root/testdata/sf0.1", "documents"), table(spark, "/root/testdata/sf0.1", "labels")
    model = quality.train(docs, lab.where("doc_id % 3 <> 0"))
    assert model[1][0] < model[1][1]
    got = quality.score(docs, model).join(lab.where("doc_id % 3 = 0"), "doc_id").toPandas()
    good = (got["quality"] == 1) & (got["toxic"] == 0)
    assert got["selected"][good].mean() > 0.9 and got["selected"][got["toxic"] == 1].mean() < 0.3
    assert got["expected_grade"][good].mean() > got["expected_grade"][got["quality"] == 0].mean() + 0.5


def test_pii_held_out():
    m = pii.model()
    x, y, _ = pii.examples(1500, seed=77)
    p = m.probability(m.trees.decision(x))
    assert ((p >= 0.5) == (y > 0)).mean() > 0.95
    r = random.Random(9)
    for _ in range(300):  # spans of personal data go, whatever stands around
        key, span = pii._personal(r)
        text = "Words stand here " + key + span + " and here."
        left = pii.redact(text, m.spans(text))
        assert span not in left and left.startswith("Words stand here") and left.endswith("and here.")
    for clean in ("Version 2.10.3 was released on 2020-05-17.", "See page 12, section 3.4.", "The total was $1,204.50 in 1999.", "It costs 45 euros."):
        assert m.spans(clean) == []


def test_chosen_spans_by_brute_force():
    """spans(): of what the trees let pass, the most probable first, and no span that meets one chosen before."""
    m, r = pii.model(), random.Random(21)
    for _ in range(60):
        text = " ".join("".join((pii._personal if r.random() < 0.6 else pii._harmless)(r)) + r.choice([" ", ", ", "\n", "=", "@"]) for _ in range(r.randint(1, 12)))
        scored = []
        for c in pii.candidates(text):
            p = float(m.probability(m.trees.decision(np.array([pii.describe(text, c)], float)))[0])
            if p >= m.at[pii.KINDS.index(c[2])]:
                scored.append((-round(p, 3), c[0] - c[1], c[0], c[2], c[1]))
        taken = []
        for _, _, a, kind, z in sorted(scored):
            if all(z <= x or y <= a for x, y, _ in taken):
                taken.append((a, z, kind))
        assert m.spans(text) == sorted(taken)


def test_overlapping_candidates():
    text = "mail bob.smith77@example.org, or token = ghp_abcdef0123456789abcdefABCDEF9876"
    spans = pii.model().spans(text)
    assert all(a[1] <= b[0] for a, b in zip(spans, spans[1:])) and len(spans) == 2


def test_chat_links(spark):
    tools = {"tools": [{"name": "add", "parameters": {"type": "object", "properties": {"x": {"type": "integer", "minimum": 0}, "y": {"type": "string"}}, "required": ["x"], "additionalProperties": False}}]}
    call = lambda i, a: {"id": i, "name": "add", "arguments": a}
    turns = [
        ("system", json.dumps(tools)), ("tool", json.dumps({"tool_call_id": "c1", "content": "4"})), ("assistant", json.dumps({"tool_calls": [call("c1", {"x": 1, "y": "é"})]})),
        ("assistant", json.dumps({"tool_calls": [call("c3", {"x": 2, "y": "$c2"}), call("c4", '{"x": -1}')]})), ("assistant", json.dumps({"tool_calls": [call("c2", {"x": "a", "z": 1})]})),
        ("tool", json.dumps({"tool_call_id": "c2", "content": {"b": 1, "a": None}})), ("tool", json.dumps({"tool_call_id": "nope", "content": "?"})),
    ]
    rows = [(7, i, r, t) for i, (r, t) in enumerate(turns)]
    out = chat.formatted(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).first()
    ms = json.loads(out.json)["messages"]
    at = {c["id"]: i for i, m in enumerate(ms) for c in m.get("tool_calls", [])}
    res = {m["tool_call_id"]: i for i, m in enumerate(ms) if "tool_call_id" in m}
    assert at["c1"] < res["c1"] and at["c2"] < res["c2"] < at["c3"]
    assert (out.n_calls, out.n_linked, out.n_unanswered, out.n_orphans, out.n_invalid, out.n_cyclic) == (4, 2, 2, 1, 2, 0)
    errors = {c["id"]: c["errors"] for m in ms for c in m.get("tool_calls", [])}
    assert errors == {"c1": [], "c3": [], "c4": ["$.x: below minimum"], "c2": ["$.x: not integer", "$.z: unknown"]}
    assert out.json == json.dumps(json.loads(out.json), ensure_ascii=False, sort_keys=True, separators=(",", ":"))


def brute_conversation(turns):
    """Order and counts of a conversation of (role, text), as told in chat's docstring, step by step."""
    load = lambda t: x if t.lstrip()[:1] == "{" and isinstance(x := _json(t), dict) else None
    nodes = [(role, text, load(text)) for role, text in turns]
    calls = [[c for c in x["tool_calls"] if isinstance(c, dict)] if role == "assistant" and x and isinstance(x.get("tool_calls"), list) else [] for role, _, x in nodes]
    answer = [x["tool_call_id"] if role == "tool" and x and isinstance(x.get("tool_call_id"), str) else None for role, _, x in nodes]
    call_of = lambda i: next((k for k, cs in enumerate(calls) if any(c.get("id") == i for c in cs)), None)
    result_of = lambda i: next((k for k, a in enumerate(answer) if a == i), None)
    needs = []
    for k in range(len(nodes)):
        need = {call_of(answer[k])} if answer[k] is not None else set()
        need |= {result_of(v[1:]) for c in calls[k] for v in c["arguments"].values() if isinstance(v, str) and v[:1] == "$"}
        needs.append(need - {None})
    done, cyclic = [], 0
    while len(done) < len(nodes):
        left = [k for k in range(len(nodes)) if k not in done]
        free = [k for k in left if needs[k] <= set(done)]
        cyclic += not free
        done.append((free or left)[0])
    every = [c for cs in calls for c in cs]
    linked = sum(k == result_of(a) and call_of(a) is not None for k, a in enumerate(answer) if a is not None)
    return done, (len(every), linked, sum(result_of(c.get("id")) is None for c in every), sum(call_of(a) is None for a in answer if a is not None), cyclic)


def _json(t):
    try:
        return json.loads(t)
    except ValueError:
        return None


def test_conversations_by_brute_force(spark):
    r = random.Random(31)
    rows, want = [], {}
    for conv in range(120):
        turns = []
        for k in range(r.randint(1, 9)):
            ref = lambda: r.choice([f"$c{r.randrange(4)}", "$none", 3, "x"])
            turns.append(r.choice([
                ("user", f"text {k}"), ("assistant", "{broken"), ("tool", f'{{"tool_call_id": "c{r.randrange(5)}", "content": "{k}"}}'), ("tool", f' {{"tool_call_id": "c{r.randrange(4)}", "content": "{k}"}}'),
                ("assistant", json.dumps({"content": str(k), "tool_calls": [{"id": f"c{r.randrange(4)}", "name": "f", "arguments": {"a": ref()}} for _ in range(r.randint(0, 3))]})),
            ]))
        rows += [(conv, k, role, text) for k, (role, text) in enumerate(turns)]
        want[conv] = turns, *brute_conversation(turns)
    assert sum(w[2][4] for w in want.values()) > 0 and sum(w[2][1] for w in want.values()) > 50
    r.shuffle(rows)
    for out in chat.formatted(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect():
        turns, order, counts = want[out.conv_id]
        assert (out.n_calls, out.n_linked, out.n_unanswered, out.n_orphans, out.n_cyclic) == counts
        told = [(m["role"], m["content"], m.get("tool_call_id"), [c["id"] for c in m.get("tool_calls", [])]) for m in json.loads(out.json)["messages"]]
        plain = []
        for k in order:
            role, text = turns[k]
            x = _json(text)
            x = x if isinstance(x, dict) else None
            plain.append((role, x.get("content", "") if x else text, x.get("tool_call_id") if x else None, [c["id"] for c in x.get("tool_calls", [])] if x else []))
        assert told == plain


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_sql(spark, sf, name):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in ("documents", "benchmark", "conversations", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    df = queries.QUERIES[name](spark, sf)
    rel = con.execute(queries.ORACLES[name])
    cols = [c[0] for c in rel.description]
    assert sorted(cols) == sorted(df.columns)
    want = sorted((tuple(r[cols.index(c)] for c in df.columns) for r in rel.fetchall()), key=repr)
    assert sorted(map(tuple, df.collect()), key=repr) == want


def test_points_of_high_slots(spark):
    slots = [0, 1, 2, 65535, 65536, 3_470_000_000, 1 << 32, (1 << 32) + 5, 1 << 45, (1 << 62) + 12345]
    got = spark.createDataFrame([(s,) for s in slots], "slot long").select(mixing.point(F.col("slot"))).collect()
    assert [x[0] for x in got] == [s * mixing.GOLDEN % (1 << 32) for s in slots]


def test_mixing_to_a_budget(spark, sf):
    docs = table(spark, sf, "documents")
    whole, part = mixing.mix(docs), mixing.mix(docs, tokens=10 * mixing.BLOCK_TOKENS - 1)
    assert sorted(part.collect()) == sorted(whole.where("slot < 10").collect())


def test_mixing_meets_its_weights(spark, sf):
    docs = table(spark, sf, "documents")
    weights = {r[0]: 1 + i for i, r in enumerate(sorted(docs.select("source").distinct().collect()))}
    got = mixing.mix(docs, weights).select("slot", "source").distinct().toPandas().sort_values("slot")
    n, total = len(got), sum(weights.values())
    for s, w in weights.items():
        assert abs((got["source"] == s).sum() - n * w / total) <= mixing.MARGIN
        half = got.iloc[: n // 2]
        assert abs((half["source"] == s).sum() - len(half) * w / total) <= mixing.MARGIN


def test_pipeline_is_its_stages_by_brute_force(spark, sf):
    import corpus_pipeline

    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "near_duplicates", "decontaminate", "pii", "mix"]
    docs = table(spark, sf, "documents")
    ok = {r.doc_id for r in queries.QUERIES["op8_language_id"](spark, sf).collect() if r.accepted}
    rows = [r for r in docs.collect() if r.doc_id in ok]
    texts = [(r.doc_id, r.text) for r in rows]
    keep = brute_kept(texts, brute_pairs(texts))
    items = [r.text for r in table(spark, sf, "benchmark").collect()]
    seeds = [{tuple(w[i : i + 4]) for i in range(len(w) - 3)} for w in map(words, items)]
    bad = set()
    for i, t in texts:
        if i in keep:
            w = words(t)
            mine = {tuple(w[k : k + 4]) for k in range(len(w) - 3)}
            bad |= {i} if any(mine & s and 4 * len(mine & s) * 2 >= len(words(x)) and brute_matches(t, x) for s, x in zip(seeds, items)) else set()
    m = pii.model()
    left = [dict(r.asDict(), text=pii.redact(r.text, m.spans(r.text))) for r in rows if r.doc_id in keep - bad]
    con = duckdb.connect()
    con.register("documents", pa.Table.from_pylist(left))
    rel = con.execute(mixing.sql())
    cols = [c[0] for c in rel.description]
    out = corpus_pipeline.run(spark, sf)
    want = sorted(tuple(r[cols.index(c)] for c in out.columns) for r in rel.fetchall())
    assert sorted(map(tuple, out.collect())) == want
