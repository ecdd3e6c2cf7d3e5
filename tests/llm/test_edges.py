"""Nulls, empty and very long texts, ties, repeated rows, empty tables and clashing columns: each has its defined result."""

import pytest

from chronogeo.llm import ann, chat, decontaminate, jaccard_join, langid, mixing, pii, quality, substring_dedup, suffix_dedup

A = "the quick brown fox jumps over the lazy dog near the old river bank"
B = "completely different words stand in this other line of plain prose here"
LONG = " ".join(f"w{i % 5000}x{i // 7}" for i in range(60_000))
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
CLASH = ["id", "u", "at", "digest", "leader", "spans", "accepted", "pred_lang", "confidence", "block", "rank", "key", "grade", "order", "tokens", "_bad"]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(1, A + "\n" + B, "en", "s", 1), (1, A + "\n" + B, "en", "s", 1), (2, A + "\n" + B, "en", None, None), (None, A, None, "t", 3), (None, A, None, "t", 3), (3, None, "en", "s", 0), (4, "", "en", "s", 0), (5, LONG, "en", "s", 9), (6, "!!! ...", "en", "s", 7)]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="module")
def wide(docs):
    from pyspark.sql import functions as F

    return docs.select("*", *[F.lit("x").alias(c) for c in CLASH])


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def bench(spark, data=((1, A), (2, None), (None, A), (3, ""))):
    return spark.createDataFrame(list(data), "item_id long, text string")


def labels(spark, data=((1, 1, 0), (5, 0, None), (None, 1, 1), (2, None, 1))):
    return spark.createDataFrame(list(data), "doc_id long, quality int, toxic int")


OPS = {
    "passages": lambda s, d: substring_dedup.dedup(d),
    "lines": lambda s, d: substring_dedup.dedup(d, substring_dedup.lines),
    "jaccard": lambda s, d: jaccard_join.join(d),
    "classes": lambda s, d: jaccard_join.classes(d),
    "suffix": lambda s, d: suffix_dedup.repeats(d),
    "decontaminate": lambda s, d: decontaminate.matches(d, bench(s)),
    "pii": lambda s, d: pii.redacted(d),
    "quality": lambda s, d: quality.quality_scores(d, labels(s)),
    "langid": lambda s, d: langid.identify(d, langid.train(d, steps=5)),
    "mixing": lambda s, d: mixing.mix(d),
}


@pytest.mark.parametrize("name", OPS)
def test_other_columns_change_nothing(spark, docs, wide, name):
    assert rows(OPS[name](spark, docs)) == rows(OPS[name](spark, wide))


@pytest.mark.parametrize("name", OPS)
def test_empty_table(spark, empty, name):
    assert OPS[name](spark, empty).count() == 0


def test_lines(spark, docs):
    got = rows(substring_dedup.dedup(docs, substring_dedup.lines).select("doc_id", "n_removed", "removed"))
    n = len(A)
    # the twins of doc 1 tie and keep what they have; doc 2 and the null id come later
    assert got.count((1, 0, "")) == 2
    assert (2, 2, f"0-{n},{n + 1}-{n + 1 + len(B)}") in got
    assert got.count((None, 1, f"0-{n}")) == 2
    assert (5, 0, "") in got and (3, 0, "") in got and (4, 0, "") in got


def test_passages(spark, docs):
    got = rows(substring_dedup.dedup(docs).select("doc_id", "text", "removed"))
    assert got.count((1, A + "\n" + B, "")) == 2  # the twins tie
    # doc 2 is a document of 26 words, one unit, and goes; the texts with null id tie, too, and are one of another text
    assert (2, "", f"0-{len(A) + 1 + len(B)}") in got and got.count((None, A, "")) == 2
    assert (5, LONG, "") in got and (3, "", "") in got and (6, "!!! ...", "") in got
    long = "; ".join([A, B, A + " again"])
    d = spark.createDataFrame([(None, long + "."), (None, "Lead. " + long), (7, None), (8, "Start, " + long + "! End")], "doc_id long, text string")
    assert rows(substring_dedup.dedup(d).select("doc_id", "text")) == sorted([(None, ""), (None, "Lead. "), (7, ""), (8, "Start, " + long + "! End")], key=repr)


def test_jaccard(spark, docs):
    assert rows(jaccard_join.join(docs)) == [(1, 2, 1.0)]
    # a row for each document with an id: (doc_id, text) that repeats is one, texts without words are alone
    got = rows(jaccard_join.classes(docs).drop("row_key"))
    assert got == [(1, 1, 1), (2, 1, 1), (3, 3, 0), (4, 4, 0), (5, 5, 0), (6, 6, 0)]
    # an id with two texts is two documents, of which the pipeline's stage drops one
    d = spark.createDataFrame([(5, A), (5, B), (3, B + "!"), (None, B)], "doc_id long, text string")
    assert rows(jaccard_join.classes(d).drop("row_key")) == [(3, 3, 1), (5, 3, 1), (5, 5, 0)]
    assert rows(jaccard_join.stage(spark, d, "")) == sorted([(5, A), (3, B + "!"), (None, B)], key=repr)


def test_suffix(spark):
    long = " ".join(f"a{i}" for i in range(60))
    d = spark.createDataFrame([(1, long), (1, long), (2, "lead " + long + " tail"), (None, long), (3, None), (4, ""), (5, long + "\n" + long)], "doc_id long, text string")
    got = rows(suffix_dedup.repeats(d))
    assert (2, 5, 5 + len(long), 60, 1) in got
    assert got.count((None, 0, len(long), 60, 1)) == 1
    assert (5, 0, 2 * len(long) + 1, 120, 1) in got  # the second copy repeats, and so does the first
    assert not [r for r in got if r[0] == 1]


def test_decontaminate(spark, docs):
    got = rows(decontaminate.matches(docs, bench(spark)).select("doc_id", "item_id", "coverage"))
    assert got == sorted([(1, 1, 1.0), (1, 1, 1.0), (2, 1, 1.0), (None, 1, 1.0), (None, 1, 1.0)], key=repr)
    assert decontaminate.matches(docs, bench(spark, [])).count() == 0


def test_pii_passes_rows_on(docs):
    got = rows(pii.redacted(docs))
    assert len(got) == docs.count() and (3, None, 0, "") in got and (4, "", 0, "") in got


def test_quality(spark, docs):
    got = {r.doc_id: r for r in quality.quality_scores(docs, labels(spark)).collect()}
    assert not got[3].selected and not got[4].selected and 0 <= got[5].expected_grade <= 2
    none = quality.quality_scores(docs, labels(spark, [])).collect()
    assert len(none) == docs.count() and {r.selected for r in none if r.doc_id in (1, 2, 5)} == {True}


def test_langid(docs):
    got = {r.doc_id: r for r in langid.identify(docs, langid.train(docs, steps=5)).collect()}
    assert (got[3].pred_lang, got[3].confidence, got[3].accepted) == ("und", 0.0, False) and got[4].pred_lang == "und" and got[5].pred_lang == "en"


def test_mixing(docs):
    got = mixing.mix(docs).collect()
    by = {}
    for r in got:
        if r.epoch == 0:
            by.setdefault((r.source, r.doc_id), 0)
            by[r.source, r.doc_id] += r.tok_stop - r.tok_start
    assert by[("s", 5)] == 60_000 and by[("", 2)] == len((A + " " + B).split()) and by[("t", None)] == 2 * len(A.split())
    assert mixing.mix(docs, {}).count() == 0
    assert {r.source for r in mixing.mix(docs, {"s": 3, "none": 1}).collect()} == {"s"}


def test_stages_keep_columns(spark, wide, sf):
    for stage in (langid.stage, jaccard_join.stage, decontaminate.stage, pii.stage):
        out = stage(spark, wide, sf)
        assert out.columns == wide.columns
        kept = out.collect()
        assert kept and all(r.accepted == "x" and r.pred_lang == "x" and r.leader == "x" for r in kept)


def test_neighbours(spark):
    v = lambda *x: [float(t) for t in x]
    data = [(1, v(0, 0)), (1, v(0, 0)), (2, v(1, 0)), (3, v(0, 1)), (None, v(0, 0)), (4, None), (5, v(1)), (6, v(float("nan"), 0)), (7, [None, 1.0]), (8, [])]
    df = spark.createDataFrame(data, "vec_id long, embedding array<float>")
    got = rows(ann.neighbours(df, 2, 1))
    from pyspark.sql import functions as F

    wide = df.select("*", *[F.lit("x").alias(c) for c in ("x", "codes", "norm", "error", "along", "b", "bound", "rank", "distance", "neighbour_id", "d", "count")])
    assert rows(ann.neighbours(wide, 2, 1)) == got and ann.neighbours(df, 2).count() == 0  # no id is divisible by 50
    assert got == sorted([(1, 2, 1, 1.0), (1, 3, 2, 1.0), (2, 1, 1, 1.0), (2, 3, 2, 1.414214), (3, 1, 1, 1.0), (3, 2, 2, 1.414214)], key=repr)
    assert ann.neighbours(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0
    assert ann.neighbours(spark.createDataFrame([(50, v(2, 2))], "vec_id long, embedding array<float>")).count() == 0


def test_chat_edges(spark):
    data = [(1, None, None, None), (1, 2, "user", "b"), (1, 2, "user", "b"), (1, 2, "assistant", "{broken"), (None, 1, "user", "gone"), (2, 1, "user", "x" * 300_000)]
    c = spark.createDataFrame(data, "conv_id long, turn long, role string, text string")
    got = {r.conv_id: r for r in chat.formatted(c).collect()}
    assert set(got) == {1, 2} and got[2].n_messages == 1 and len(got[2].json) > 300_000
    assert got[1].json == '{"messages":[{"content":"","role":"user"},{"content":"{broken","role":"assistant"},{"content":"b","role":"user"},{"content":"b","role":"user"}]}'
    assert chat.formatted(spark.createDataFrame([], c.schema)).count() == 0
    from pyspark.sql import functions as F

    wide = c.select("*", *[F.lit("x").alias(x) for x in ("seq", "id", "calls", "call_at", "result_at", "linked", "turns", "json")])
    assert rows(chat.formatted(wide)) == rows(chat.formatted(c))


def test_stages_on_an_empty_table(spark, empty, sf):
    for stage in (langid.stage, jaccard_join.stage, decontaminate.stage, pii.stage, mixing.stage):
        assert stage(spark, empty, sf).count() == 0
