"""Cases that a cap, a pre-check or a switch by size once left out."""

import random
import string
import sys
import time

import numpy as np
import pytest

from chronogeo.llm import ann, decontaminate, pii, queries, substring_dedup


def mixed(r, n):
    return "".join(r.choice(string.ascii_letters + string.digits) for _ in range(n))


def test_long_secrets_go_whole():
    r = random.Random(4)
    m = pii.model()
    for n in (150, 201, 300, 342, 2000):
        for before, after in (('token="', '" end'), ("api_key=", " end"), ("use ", " now")):
            value = mixed(r, n)
            assert pii.redact(before + value + after, m.spans(before + value + after)) == before + "[SECRET]" + after
        jwt = "eyJhbGciOiJSUzI1NiJ9." + mixed(r, 120) + "." + mixed(r, n)
        assert pii.redact("jwt " + jwt, m.spans("jwt " + jwt)) == "jwt [SECRET].[SECRET].[SECRET]"


def test_long_runs_are_searched_in_linear_time():
    for text in ("A" * 1_000_000, "token=" + "x1" * 500_000, "é" + "Ab1" * 300_000 + "é", "k=" * 500_000):
        t = time.process_time()
        pii.candidates(text)
        assert time.process_time() - t < 20


def test_the_pre_check_passes_all_that_the_generators_propose(spark):
    r = random.Random(6)
    keys = ["AKIA" + "".join(r.choice(string.ascii_uppercase) for _ in range(16)) for _ in range(40)]
    texts = [f"use {k} now" for k in keys] + keys + ["", "no key", "SHORT CAPITALS"]
    m = pii.model()
    got = {x.doc_id: x.text for x in pii.redacted(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    assert got == {i: pii.redact(t, m.spans(t)) for i, t in enumerate(texts)}
    assert got[0] == "use [SECRET] now" and sum("[SECRET]" in t for t in got.values()) > 70
    # digits of every script, capitals with any joint, and runs that only two texts together would make
    digits = [c for c in map(chr, range(sys.maxunicode + 1)) if c.isdecimal()]
    cases = [f"call {c * 10} now" for c in digits] + ["A" * 15 + c for c in "AZ_/+-="] + ["a@b", "ab: cd2e"]
    for t in [x for x in cases if pii.candidates(x)]:
        data = np.frombuffer(t.encode(), np.uint8)
        assert pii._may_hold(data, np.array([0, len(data)])).all(), t
    two = np.frombuffer(b"A" * 20, np.uint8)
    assert pii._may_hold(two, np.array([0, 0, 10, 20])).tolist() == [False] * 3


@pytest.mark.parametrize("index_bytes", [decontaminate.INDEX_BYTES, 0])
def test_decontamination_is_by_row_at_any_size(spark, monkeypatch, index_bytes):
    from pyspark.sql import functions as F

    monkeypatch.setattr(decontaminate, "INDEX_BYTES", index_bytes)
    item = "the quick brown fox jumps over the lazy dog"
    data = [(None, item), (None, "clean words"), (None, None), (None, "clean words"), (1, item), (1, "other clean words"), (1, "lead " + item), (2, item), (2, item), (3, "")]
    docs = spark.createDataFrame(data, "doc_id long, text string")
    bench = spark.createDataFrame([(7, item)], "item_id long, text string")
    want = sorted([(i, t) for i, t in data if item not in (t or "")], key=repr)
    for d in (docs, docs.select("*", *[F.lit("x").alias(c) for c in ("_bad", "_BAD_", "d", "b", "h", "item_id", "item_text")])):
        out = decontaminate.clean(d, bench)
        assert out.columns == d.columns
        assert sorted([(r.doc_id, r.text) for r in out.collect()], key=repr) == want
        assert sorted([(r.doc_id, r.item_id) for r in decontaminate.matches(d, bench).collect()], key=repr) == sorted([(i, 7) for i, t in data if item in (t or "")], key=repr)


def nearest_by_brute_force(x, top):
    """Rows' nearest others; ties go to the least row."""
    y = x.astype(np.float64)
    return np.array([np.lexsort((np.arange(len(y)), np.where(np.arange(len(y)) == i, np.inf, ((y - y[i]) ** 2).sum(1))))[:top] for i in range(len(y))])


def test_neighbours_in_dense_groups_and_among_equals(spark):
    r = np.random.default_rng(7)
    x = r.normal(size=(8000, 64)).astype(np.float32)
    x[:2000] = x[0] + 0.01 * r.normal(size=(2000, 64))  # near copies
    x[2000:2300] = x[2000]  # copies
    emb = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<float>").repartition(4)
    got = {}
    for n in ann.neighbours(emb, every=1).collect():
        got.setdefault(n.vec_id, {})[n["rank"]] = n.neighbour_id
    want = nearest_by_brute_force(x, ann.TOP)
    mine = np.array([[got[i].get(k + 1, -1) for k in range(ann.TOP)] for i in range(len(x))])
    recall = lambda a, z: np.mean([len({*mine[i]} & {*want[i]}) / ann.TOP for i in range(a, z)])
    print("recall: dense group", recall(0, 2000), "others", recall(2300, 8000))
    assert recall(0, 2000) >= 0.97 and recall(2300, 8000) >= 0.9
    assert (mine[2000:2300] == want[2000:2300]).all()  # the least ids of the equal ones


def test_an_exact_search_is_brute_force():
    r = np.random.default_rng(3)
    for n, spread in ((5, 1.0), (300, 1.0), (300, 1e-4), (300, 0.0)):
        x = (5 + spread * r.normal(size=(n, 8))).astype(np.float32)
        ids = np.arange(n)
        want = nearest_by_brute_force(x, 10)[:, : n - 1]
        some = ann.first_of_equal(x, ids, 11)
        for noise in (0.0, 1.0, 30.0):  # approximations, however bad, only cost time
            books = [np.unique((x + noise * r.normal(size=x.shape)).astype(np.float32)[:50], axis=0)]
            s = ann.Search(ids, x, ann.pivot_bound(ids, x, ids[:40], x[:40], 10), books, 10, 8**0.5)
            index = ann.beam_encode(x, books)
            for a in range(0, len(some), 64):
                rows = some[a : a + 64]
                s.add(ids[rows], x[rows], *(v[rows] for v in index))
            assert (s.best[1].reshape(n, -1) == want).all() and (s.best[0].reshape(n, -1) == ids[:, None]).all()


def test_short_lines_are_units(spark, tmp_path):
    assert substring_dedup.SQL_ALL_LINES != substring_dedup.SQL
    chinese = "这是一个很长的没有空格的句子"
    data = [(1, "All rights reserved.\n" + chinese), (2, "one of its own\nall rights  RESERVED"), (3, chinese + "\n---\n"), (4, "---")]
    spark.createDataFrame(data, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    got = queries.QUERIES["op1_substring_dedup_all_lines"](spark, str(tmp_path)).collect()
    assert {r.doc_id: r.text for r in got} == {1: data[0][1], 2: "one of its own\n", 3: "---\n", 4: "---"}
