"""Golden cases, a row-at-a-time model of the draw, and readers on small files."""

import gzip
import json
import random
import time

import pytest
from pyspark.sql import functions as F

from chronogeo.functions import columns as C
from chronogeo.functions.classify import category_of, founding_kind, is_institution
from chronogeo.functions.scoring import scored
from chronogeo.functions.text import slug_of
from chronogeo.model import EVENTS, TIERS, EngineConfig, with_missing_columns
from chronogeo.operators import curate, graph, search, store, timeline
from chronogeo.sources import dump, seed, sparql, wikitext
from chronogeo.streaming.ingest import ingest
from chronogeo.streaming.limiter import limited, limited_stream, step


def one(spark, col, *values, kind="string"):
    df = spark.createDataFrame([(v,) for v in values], f"x {kind}")
    return [r[0] for r in df.select(col(F.col("x"))).collect()]


def test_dates(spark):
    got = one(spark, C.parse_date, "1871", "1871-10", "1871-10-08", "1871-00", "1871-02-00", "12345", "October 8, 1871", "october 1871", "Foo 1871", "nonsense", None, "1900-02", "2000-02")
    flat = [tuple(r) if r else None for r in got]
    assert flat == [
        ("1871-01-01", "1871-12-31", "year"), ("1871-10-01", "1871-10-31", "month"), ("1871-10-08", "1871-10-08", "day"), ("1871-01-01", "1871-12-31", "year"), ("1871-02-01", "1871-02-28", "month"),
        ("1234-01-01", "1234-12-31", "year"), ("1871-10-08", "1871-10-08", "day"), ("1871-10-01", "1871-10-31", "month"), ("1871-01-01", "1871-12-31", "year"), (None, None, None), (None, None, None),
        ("1900-02-01", "1900-02-28", "month"), ("2000-02-01", "2000-02-29", "month"),
    ]


def test_dates_of_other_forms(spark):
    got = one(spark, C.parse_date, "8 October 1871", "08 Oct 1871", "Sun, 08 Oct 1871 00:00:00 GMT", "10/8/1871", "13/8/1871", "8 Foo 1871", "40 October 1871", " 8-Oct-1871 ", "10/8/71")
    day = ("1871-10-08", "1871-10-08", "day")
    assert [tuple(r) if r and r.lo else None for r in got] == [day, day, day, day, None, None, None, day, None]


def test_identifiers(spark):
    assert one(spark, C.hash36, "19th century")[0] == "lz306o"
    assert slug_of("Zürich: a Fair!") == "zu-rich-a-fair"
    assert one(spark, C.truncate_ip, "1.2.3.4", "::ffff:1.2.3.4", "2001:db8:1:2::3", None, "x", "1.2.3") == ["1.2.3.0", "1.2.3.0", "2001:db8:1::/48", "unknown", "unknown", "unknown"]
    assert one(spark, C.wikilinks, "[[A|b]] and [[ C ]] [[File:x]] [[D]]") == [["A", "C", "D"]]
    url = spark.range(1).select(C.source_url(F.lit("L'été (1911)"), F.lit("Q1")).alias("a"), C.source_url(F.lit(None), F.lit("Q1")).alias("b")).first()
    assert url.a == "https://en.wikipedia.org/wiki/L'%C3%A9t%C3%A9_(1911)" and url.b == "http://www.wikidata.org/entity/Q1"
    t = spark.range(1).select(C.wikidata_time(F.lit("+1871-00-00T00:00:00Z"), F.lit(9)).alias("a"), C.wikidata_time(F.lit("-0044-03-15T00:00:00Z"), F.lit(11)).alias("b"), C.wikidata_time(F.lit("x"), F.lit(11)).alias("c")).first()
    assert tuple(t.a) == ("1871-01-01", "year") and tuple(t.b) == ("BCE", None) and tuple(t.c) == (None, None)


def test_classifiers(spark):
    kinds = {"university in the city of Toronto": "institution", "city in the state of Nevada": "settlement", "sovereign state in South America": "country", "state of the United States": "subnational", "republic in Russia": "subnational", "kingdom in Africa": "country", "éwar": None, None: None, "": None}
    assert one(spark, founding_kind, *kinds) == list(kinds.values())
    assert one(spark, is_institution, "school in Cook County", "school shooting in Cook County", "fire at a hospital", "man, founder of a university", None) == [True, False, False, False, False]
    assert one(spark, category_of, "A treaty ends the war", "the Éwar", "gains independence", "a thing") == ["treaty", "conflict", "founding", "event"]


def event(i, **x):
    base = {"id": f"Q{i}", "title": f"T{i}", "date_start": "1900-01-01", "date_precision": "day", "lat": 10.0, "lng": 20.0, "category": "event", "notability": 0.5, "ingest_version": "dump-v1"}
    return {**{f.name: None for f in EVENTS.fields}, **base, **x}


def table(spark, rows):
    return spark.createDataFrame([tuple(r[f.name] for f in EVENTS.fields) for r in rows], EVENTS)


def test_scores(spark):
    rows = [event(0, notability=None), event(1, notability=0.1), event(2, notability=0.9), event(3, notability=0.1), event(4, category="birth", notability=0.3), event(5, date_start="1500", notability=0.2), event(6, ingest_version="seed-x", scope="global", notability=0.0), event(7, lat=None)]
    got = {r.id: r for r in scored(table(spark, rows)).collect()}
    assert [got[f"Q{i}"].significance for i in (0, 1, 2, 3, 4, 5)] == [0.333, 0.667, 1.0, 0.667, 0.5, 0.5]
    assert got["Q6"].scope == "global" and got["Q6"].reach_km == 20038.0 and got["Q6"].reach_min_lng == -180.0
    assert got["Q1"].scope == "local" and got["Q1"].reach_km == 57.0 and got["Q2"].scope == "global"
    assert got["Q7"].reach_km is None and got["Q7"].reach_min_lat is None


def model(pools, segments, cfg):
    """The draw as a loop, segment by segment."""
    seen, out = set(), []
    for s in range(segments):
        rows = sorted((r for r in pools if r["segment_index"] == s and r["id"] not in seen), key=lambda r: (-r["score"], r["date_start_iso"], r["id"]))
        by = {t: [r for r in rows if r["tier"] == t][: cfg.quota(t)] for t in TIERS}
        taken = []
        for k in range(max(cfg.quota(t) for t in TIERS)):
            taken += [by[t][k] for t in TIERS if k < len(by[t])]
        out += [(r["person"], s, r["id"]) for r in taken[: cfg.max_per_segment]]
        seen |= {r["id"] for r in taken[: cfg.max_per_segment]}
    return out


def test_draw_is_the_loop(spark):
    r = random.Random(4)
    for cfg in (EngineConfig(), EngineConfig.of(max_per_segment=5, person_quota=0, scope_quota={"local": 1, "global": 9})):
        rows, want = [], []
        for p in range(12):
            own = [{"person": f"p{p}", "segment_index": s, "id": f"e{i}", "tier": TIERS[i % 5], "score": r.randint(0, 5) / 10, "date_start_iso": f"19{i % 3:02d}-01-01"} for s in range(4) for i in range(40) if r.random() < 0.6]
            rows += own
            want += model(own, 4, cfg)
        df = spark.createDataFrame(rows)
        assert sorted((x.person, x.segment_index, x.id) for x in timeline.draw(df, cfg, 4).collect()) == sorted(want)


def test_matching_edges(spark):
    e = [
        event(1, lat=10.0, lng=179.9), event(2, lat=85.0, lng=20.0), event(3, scope="odd"), event(4, date_start="1899-12-31", date_end="1900-06-01"), event(5, date_start="1900"), event(6, significance=0.01),
    ]
    rows = [{**x, "scope": x["scope"] or "local", "significance": x["significance"] or 0.5, "reach_km": 55.0, "reach_min_lat": x["lat"] - 0.5, "reach_max_lat": x["lat"] + 0.5, "reach_min_lng": x["lng"] - 0.5, "reach_max_lng": x["lng"] + 0.5} for x in e]
    seg = spark.createDataFrame([("a", 0, 10.0, 20.0, "1900-01", None), ("a", 1, 10.0, -179.9, "1900", "1901"), ("b", 0, 85.0, 20.3, "January 1900", "1900")], "person string, segment_index int, seg_lat double, seg_lng double, seg_start string, seg_end string")
    got = {(r.person, r.segment_index, r.id): r for r in timeline.matches(table(spark, rows), seg).collect()}
    # the box does not wrap; an event that began in an earlier year is left out; precision 'day' of a bare year is that of its column
    assert set(got) == {("a", 0, "Q3"), ("a", 0, "Q5"), ("b", 0, "Q2")}
    assert got["a", 0, "Q3"].tier == "local" and got["a", 0, "Q3"].scope == "odd" and got["a", 0, "Q5"].date == "January 1, 1900"


def test_config():
    c = EngineConfig.of(significance_floor=0.4, scope_floor={"global": 0.1})
    assert c.scope_floor == {"global": 0.1, "local": 0.4, "national": 0.4, "regional": 0.4} and c.least_floor == 0.1
    bad = timeline.validate_request
    assert bad({"segments": [{"place": {"lat": 1, "lng": 2}, "start": "1900"}]}) == [] and bad({"segments": []}) and bad({"segments": [{"place": {"lat": 91, "lng": True}, "start": " "}]})[2].endswith("start: no date") and bad([])


def test_older_tables_are_read(spark):
    old = table(spark, [event(1)]).drop("display_title", "founding_kind")
    assert set(with_missing_columns(old).columns) == set(EVENTS.fieldNames())


def test_writes(spark):
    old = spark.createDataFrame([("a", 1, "x"), ("b", 2, "y")], "id string, n int, keep string")
    new = spark.createDataFrame([("b", None), ("c", 3), (None, 4)], "id string, n int")
    assert sorted(map(tuple, store.insert_ignore(old, new, ["n"]).collect())) == [("a", 1, "x"), ("b", 2, "y"), ("c", 3, None)]
    assert sorted(map(tuple, store.insert_replace(old, new, ["n"]).collect())) == [("a", 1, "x"), ("b", None, None), ("c", 3, None)]
    assert sorted(map(tuple, store.upsert(old, new.where("id is not null"), ("n",)).collect())) == [("a", 1, "x"), ("b", None, "y"), ("c", 3, None)]
    with pytest.raises(ValueError):
        store.require_empty(store.duplicate_ids(new.union(new).withColumn("title", F.lit("t"))), "twice")
    meta = store.set_meta(spark.createDataFrame([("dataset_version", "v1")], "key string, value string"), {"last_prune": "x", "reach_version": "r"})
    assert store.build_id(meta).first()[0] == "v1+unscored+r+prune1" and store.build_id(meta.limit(0)).first()[0] == "unknown-ingest+unscored+no-reach+unpruned"


def test_series(spark):
    rows = [event(i, title=f"{1900 + i} Cup") for i in range(6)] + [event(10, title="1903 Cup", ingest_version="SEED-1"), event(11, title="1906 San Francisco earthquake"), event(12, title="1900 Summer Olympics", ingest_version=None)]
    t = table(spark, rows)
    assert [(r.series, r.n, r.seeded) for r in curate.series(t).collect()] == [("Cup", 7, 1)]
    assert {r.id for r in curate.without_series(t).collect()} == {"Q10", "Q11", "Q12"} and curate.without_series(t, keep="cup|x").count() == 9


def test_closure_with_a_cycle(spark):
    edges = spark.createDataFrame([("b", "a"), ("c", "b"), ("a", "c"), ("d", "c"), ("x", "y"), (None, "a")], "child string, parent string")
    roots = spark.createDataFrame([("a", "late", 2), ("c", "early", 1), ("z", "alone", 3)], "node string, category string, priority int")
    assert dict(map(tuple, graph.type_closure(edges, roots).collect())) == {"a": "early", "b": "early", "c": "early", "d": "early", "z": "alone"}


def test_search(spark):
    t = table(spark, [event(1, title="École of Zürich", blurb="a big city"), event(2, title="Zurich war", blurb=None, notability=0.9), event(3, title="City hall", blurb="zur")])
    ids = lambda q: [r.id for r in search.search(t, q).collect()]
    assert ids("zurich") == ["Q2", "Q1"] and ids("ZÜRICH city") == ["Q1"] and ids('"big city"') == ["Q1"] and ids("zur*") == ["Q2", "Q1", "Q3"] and ids("title:city") == ["Q3"] and ids("zurich NOT (war OR hall)") == ["Q1"]
    for bad in ("", "AND", '"', "(a", "a)", "title:", "nope:a"):
        with pytest.raises(search.Syntax):
            search.search(t, bad)
    index = search.index_of(t, "id", ("title", "blurb"))
    assert {r.id for r in search.by_index(index, ["zurich", "war"]).collect()} == {"Q2"}


def claim(**v):
    return [{"mainsnak": {"datavalue": {"value": v}}}]


def test_dump(spark, tmp_path):
    place = {"type": "item", "id": "Q64", "labels": {"en": {"value": "Berlin"}}, "claims": {"P31": claim(id="Q515"), "P625": claim(latitude=52.5, longitude=13.4), "P571": claim(time="+1237-00-00T00:00:00Z", precision=9)}, "sitelinks": {f"w{i}": {"title": "x"} for i in range(40)}}
    man = {"type": "item", "id": "Q1", "labels": {"en": {"value": "Ann"}}, "claims": {"P31": claim(id="Q5"), "P569": claim(time="+1900-02-03T00:00:00Z", precision=11), "P19": claim(id="Q64"), "P570": claim(time="-0010-01-01T00:00:00Z", precision=11), "P20": claim(id="Q64")}, "sitelinks": {**{f"w{i}": {"title": "x"} for i in range(34)}, "enwiki": {"title": "Ann X"}}}
    war = {"type": "item", "id": "Q2", "labels": {"en": {"value": "War"}}, "claims": {"P31": claim(id="Q999"), "P580": claim(time="+1914-07-00T00:00:00Z", precision=10), "P625": claim(latitude=1.0, longitude=2.0)}, "sitelinks": {f"w{i}": {"title": "x"} for i in range(6)}}
    kind = {"type": "item", "id": "Q999", "labels": {}, "claims": {"P279": claim(id="Q180684")}, "sitelinks": {}}
    path = str(tmp_path / "dump.json.gz")
    with gzip.open(path, "wt") as f:
        f.write("[\n" + ",\n".join([json.dumps(x) for x in (place, man, war, kind)] + ["{broken"]) + "\n]\n")
    e = dump.read_dump(spark, path, 3)
    closure = graph.type_closure(dump.subclass_edges(e), dump.roots(spark))
    got = {r.id: r for r in dump.events(e, closure, 1200, 2000).collect()}
    assert set(got) == {"Q64", "Q1#birth", "Q2"}
    assert (got["Q1#birth"].lat, got["Q1#birth"].notability, got["Q1#birth"].source_url) == (52.5, 0.35, "https://en.wikipedia.org/wiki/Ann_X")
    assert (got["Q2"].category, got["Q2"].date_start, got["Q2"].date_precision) == ("conflict", "1914-07-01", "month") and got["Q64"].date_start == "1237-01-01"


def test_sparql(spark):
    b = lambda q, n, **x: {"item": f"http://www.wikidata.org/entity/{q}", "itemLabel": q, "date": "1900-05-06T00:00:00Z", "coords": "Point(2.5 1.5)", "sitelinks": str(n), **x}
    res = [("event", 6, 1900, sparql.as_json([b("Q1", 9), b("Q2", 300, article="a"), b("Q3", 5, coords="nowhere")])), ("conflict", 0, 1900, sparql.as_json([b("Q1", 9)])), ("birth", 4, 1900, sparql.as_json([b("Q1", 30)])), ("event", 6, 1901, "not json")]
    got = {r.id: r for r in sparql.rows_of(spark.createDataFrame(res, "category string, priority int, year int, body string")).collect()}
    assert set(got) == {"Q1", "Q2", "Q1#birth"} and got["Q1"].category == "conflict" and (got["Q2"].notability, got["Q2"].source_url, got["Q2"].lat) == (1.0, "a", 1.5)
    text = sparql.query_of(sparql.HARVESTERS[0], 1900)
    assert "1901-01-01" in text and "LIMIT 250" in text
    reader = sparql.SparqlReader({"from": "1900", "to": "1901", "categories": "birth,event", "endpoint": "x"})
    assert [(p.year, p.order) for p in reader.partitions()] == [(1901, 4), (1901, 6), (1900, 4), (1900, 6)]


def test_wikitext(spark):
    page = "{|\n|-\n|1500||3 May||[[Rome]] declares war on [[Spain|the Spanish]]\n|-\n| ||||[[Rome]] and [[Spain]] make peace\n|}"
    rows = wikitext.table_rows(spark.createDataFrame([("P", page)], "page string, wikitext string"))
    titles = spark.createDataFrame([("Rome", "Q1"), ("Spain", "Q2")], "title string, qid string")
    things = spark.createDataFrame([("Q1", 5, ["Q515"], 41.9, 12.5, None), ("Q2", 90, ["Q6256"], None, None, "Q3"), ("Q3", 1, ["Q9"], 40.0, -3.0, None)], "qid string, sitelinks int, types array<string>, lat double, lng double, country string")
    got = wikitext.events(rows, titles, things).orderBy("line").collect()
    assert [(r.title, r.date_start, r.lat, r.category) for r in got] == [("Spain", "1500-05-03", 40.0, "conflict"), ("Spain", "1500-01-01", 40.0, "event")]
    assert got[0].blurb == "Rome declares war on Spain" and got[0].id.startswith("timeline:")


def test_seed_files(spark, tmp_path):
    p = tmp_path / "things.json"
    p.write_text(json.dumps([{"Title": " Radio ", "Date start": "1895", "Lat": 1.5, "Lng": 2.5, "Notability": 0.5, "Scope (intended)": "global", "Seed ID": ""}, {"Title": "X", "Seed ID": "Own Id"}, {"Title": ""}]))
    got = {r.id: r for r in seed.seeds(seed.read_raw(spark, [str(p)])).collect()}
    assert set(got) == {"seed:radio", "seed:own-id"} and got["seed:radio"].category == "milestone" and json.loads(got["seed:radio"].source_ids) == {"seed": "things", "place": None}
    assert seed.without_ids(seed.read_raw(spark, [str(p)]), spark.createDataFrame([("seed:radio",)], "id string")).count() == 2
    t = tmp_path / "v.tsv"
    t.write_bytes("﻿verdict\tseed_id\tdump_id\r\ndrop\t a \t\r\nmerge\tb\r\n".encode())
    assert [(r.seed_id, r.dump_id) for r in seed.read_tsv(spark, str(t)).collect()] == [("a", ""), ("b", "")]
    with pytest.raises(ValueError):
        seed.read_tsv(spark, str(t), ("nope",))


def test_limiter(spark, tmp_path):
    import numpy as np

    rows, _, _ = step(np.array([0, 10, 20, 59_999, 60_000, 60_001]), -(1 << 62), 0, 60_000, 2)
    assert [(c, ok) for c, ok, _, _ in rows] == [(1, True), (2, True), (3, False), (4, False), (1, True), (2, True)]
    data = [("a", 0), ("a", 10), ("a", 20), ("b", 5), (None, 1)]
    df = spark.createDataFrame(data, "key string, ts_ms long")
    want = sorted(map(tuple, limited(df, 60_000, 2).collect()))
    assert len(want) == 4
    df.coalesce(1).write.parquet(str(tmp_path / "in"))
    s = spark.readStream.schema(df.schema).parquet(str(tmp_path / "in"))
    q = limited_stream(s, 60_000, 2).writeStream.format("memory").queryName("lim").option("checkpointLocation", str(tmp_path / "cp")).start()
    for _ in range(90):  # timeouts keep such a query busy, so it never says that it is done
        if not q.isActive or spark.table("lim").count() >= len(want):
            break
        time.sleep(1)
    q.stop()
    assert sorted(map(tuple, spark.table("lim").collect())) == want


def test_stream_ingest(spark, tmp_path):
    schema = "id string, title string, date_start string"
    for k, rows in enumerate(([("a", "1", "1900"), ("a", "2", "1900")], [("a", "3", "1900"), ("b", "1", "1901")])):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        s = spark.readStream.schema(schema).parquet(str(tmp_path / "in"))
        ingest(s, str(tmp_path / "out"), str(tmp_path / "cp")).trigger(availableNow=True).start().awaitTermination()
    got = spark.read.parquet(str(tmp_path / "out"))
    assert sorted((r.id, r.title) for r in got.collect()) == [("a", "1"), ("b", "1")]
