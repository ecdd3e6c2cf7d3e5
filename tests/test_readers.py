"""Readers of web interfaces against a local server, search by index against the scan, and the timeline against all its pairs."""

import json
import random
import threading
import urllib.parse
from http.server import BaseHTTPRequestHandler, ThreadingHTTPServer

import pytest
from pyspark.sql import functions as F

from chronogeo.model import EngineConfig
from chronogeo.operators import search, timeline
from chronogeo.sources import mediawiki, seed, sparql
from chronogeo.sources.fixtures import requests, scored_events
from chronogeo.storage import shared_dir, stored


@pytest.fixture
def server():
    """Answers by the handler's `answer`: (path and parameters, tries of them so far) to (status, body)."""
    tries = {}

    class Handler(BaseHTTPRequestHandler):
        answer = staticmethod(lambda p, n: (200, "{}"))

        def _send(self, params):
            key = json.dumps(params, sort_keys=True)
            tries[key] = tries.get(key, 0) + 1
            code, body = Handler.answer(params, tries[key])
            self.send_response(code)
            self.end_headers()
            self.wfile.write(body.encode())

        def do_GET(self):
            self._send(dict(urllib.parse.parse_qsl(self.path.partition("?")[2])))

        def do_POST(self):
            self._send(dict(urllib.parse.parse_qsl(self.rfile.read(int(self.headers["Content-Length"])).decode())))

        def log_message(self, *a):
            pass

    s = ThreadingHTTPServer(("127.0.0.1", 0), Handler)
    threading.Thread(target=s.serve_forever, daemon=True).start()
    yield Handler, f"http://127.0.0.1:{s.server_port}/", tries
    s.shutdown()


def test_endpoint_is_asked_again_and_failures_are_told(spark, server):
    handler, url, tries = server

    def answer(params, n):
        q = params["query"]
        if "1903" in q.split("FILTER")[1].split("&&")[1]:
            return 500, "broken"
        if n == 1:
            return 503, "later"
        return 200, sparql.as_json([{"item": "http://x/entity/Q" + q.split('"')[1][:4], "date": q.split('"')[1], "coords": "Point(2 1)", "sitelinks": "9"}])

    handler.answer = staticmethod(answer)
    spark.dataSource.register(sparql.SparqlSource)
    opts = {"endpoint": url, "from": "1901", "to": "1903", "categories": "conflict", "wait": "0", "delay": "0"}
    got = spark.read.format("sparql").options(**opts).load().collect()
    assert {(r.year, r.body is None, r.error is None) for r in got} == {(1901, False, True), (1902, False, True), (1903, True, False)}
    rows = sparql.rows_of(spark.createDataFrame(got, "category string, priority int, year int, body string, error string")).collect()
    assert {(r.id, r.date_start) for r in rows} == {("Q1901", "1901-01-01"), ("Q1902", "1902-01-01")}
    with pytest.raises(Exception, match="500"):
        spark.read.format("sparql").options(**opts, strict="true").load().collect()


def test_wiki_is_asked_in_batches(spark, server):
    handler, url, tries = server
    asked = []

    def answer(params, n):
        names = params["titles"].split("|")
        asked.append(len(names))
        if params["prop"] == "pageprops":
            return 200, mediawiki.as_pages([{"title": t, "pageprops": {"wikibase_item": "Q" + t[1:]}} if int(t[1:]) % 2 else {"title": t} for t in names])
        return 200, mediawiki.as_pages([{"title": t, "revisions": [{"slots": {"main": {"*": "text of " + t}}}]} if int(t[1:]) % 3 else {"title": t, "missing": ""} for t in names])

    handler.answer = staticmethod(answer)
    names = spark.createDataFrame([(f"T{i}",) for i in range(120)] + [("T5",), (None,)], "title string").coalesce(1)
    texts = mediawiki.wikitexts(mediawiki.asked(names, mediawiki.PAGES, mediawiki.http_get(url)))
    assert {(r.page, r.wikitext) for r in texts.collect()} == {(f"T{i}", f"text of T{i}") for i in range(120) if i % 3}
    assert max(asked) <= 50 and sum(asked) == 120
    items = mediawiki.items(mediawiki.asked(names, mediawiki.ITEMS, mediawiki.http_get(url)))
    assert {(r.title, r.qid) for r in items.collect()} == {(f"T{i}", f"Q{i}") for i in range(120) if i % 2}


def test_entities_of_a_body(spark):
    full = {"sitelinks": {"enwiki": {"title": "x"}, "dewiki": {}}, "claims": {"P625": [{"mainsnak": {"datavalue": {"value": {"latitude": 1.5, "longitude": 2}}}}], "P31": [{"mainsnak": {"datavalue": {"value": {"id": "Q5"}}}}, {"mainsnak": {}}], "P17": [{"mainsnak": {"datavalue": {"value": {"id": "Q30"}}}}]}}
    body = json.dumps({"entities": {"Q1": full, "Q2": {"missing": ""}}})
    got = {r.qid: tuple(r) for r in mediawiki.entities(spark.createDataFrame([(body,), ("{broken",), (None,)], "body string")).collect()}
    assert got == {"Q1": ("Q1", 2, 1.5, 2.0, ["Q5"], "Q30"), "Q2": ("Q2", 0, None, None, [], None)}


def _query(r, depth=2):
    words = ["alpha", "beta", "gamma", "delta", "été"]
    if depth and r.random() < 0.6:
        return "(" + _query(r, depth - 1) + r.choice([" AND ", " OR ", " NOT ", " "]) + _query(r, depth - 1) + ")"
    only = r.choice(["", "", "title: ", "-title: ", "{title blurb}: "])
    if r.random() < 0.25:
        return f"{only}NEAR({r.choice(words)} {r.choice(words)[:3]}* \"{r.choice(words)} {r.choice(words)}\", {r.randrange(4)})" if r.random() < 0.4 else f"{only}NEAR({r.choice(words)} {r.choice(words)}, {r.randrange(3)})"
    term = r.choice([r.choice(words), r.choice(words)[:2] + "*", '"' + " ".join(r.choice(words) for _ in range(2)) + '"'])
    return only + r.choice(["", "", "^"]) + term


def test_the_index_answers_as_the_scan_does(spark, tmp_path):
    r = random.Random(8)
    text = lambda: " ".join(r.choice(["alpha", "Beta", "gamma,", "delta", "Été", "x"]) for _ in range(r.randint(0, 7)))
    rows = [(f"Q{i}", text() if i % 9 else None, text()) for i in range(150)]
    t = spark.createDataFrame(rows, "id string, title string, blurb string").cache()
    search.write_index(search.index_of(t, "id", ("title", "blurb")), str(tmp_path / "index"), 2)
    index = spark.read.parquet(str(tmp_path / "index")).cache()
    some = 0
    for _ in range(40):
        q = _query(r)
        want = {x.id for x in search.matching(t, q).collect()}
        assert {x.id for x in search.found(index, q).collect()} == want, q
        some += bool(want) and len(want) < 150
    assert some > 20
    for bad in ("NEAR(alpha, x)", "NEAR()", "{title: x", "nosuch: x", "alpha NEAR(beta"):
        with pytest.raises(search.Syntax):
            search.found(index, bad).collect()


def test_near_counts_the_words_between(spark):
    t = spark.createDataFrame([("1", "a x x b"), ("2", "a b x x c"), ("3", "b x a c"), ("4", "a c x b")], "id string, title string").withColumn("blurb", F.lit(""))
    ids = lambda q: {x.id for x in search.matching(t, q).collect()}
    assert ids("NEAR(a b, 2)") == {"1", "2", "3", "4"} and ids("NEAR(a b, 1)") == {"2", "3"} and ids("NEAR(a b, 0)") == {"2"}
    assert ids("NEAR(a b c, 3)") == {"2", "3", "4"} and ids("NEAR(a b c, 2)") == {"3", "4"}


@pytest.mark.parametrize("first", [1, 64])
def test_the_timeline_is_that_of_all_pairs(spark, sf, monkeypatch, first):
    monkeypatch.setattr(timeline, "FIRST", first)  # fewer events are met first: more are met after
    e, s = stored(scored_events(spark, sf)), requests(spark, sf).where("person < 'Customer#000000040'")
    s = s.unionByName(s.where("segment_index = 0").withColumn("person", F.lit(None).cast("string")).limit(1))
    cfg = EngineConfig.of(max_per_segment=5)
    m = timeline.matches(e, s, cfg)
    want = timeline.draw(m, cfg, 2).select("person", "segment_index", "id", "score").collect()
    got, totals = timeline.timeline_and_totals(e, s, cfg, 2)
    assert want and sorted(map(repr, got.select("person", "segment_index", "id", "score").collect())) == sorted(map(repr, want))
    assert sorted(map(repr, totals.collect())) == sorted(map(repr, m.groupBy("person").agg(F.count("*").alias("total_matched")).collect()))


def test_curated_files_are_written_back(spark, tmp_path):
    rows = [{"Title": f"Thing {i}", "Blurb": None, "Lat": 1.5, "Lng": 2.0, "Notability": 0.5} for i in range(4)]
    (tmp_path / "a.json").write_text(json.dumps(rows))
    (tmp_path / "b.json").write_text(json.dumps([{"Title": "Other é", "Lat": 0}]))
    raw = seed.read_raw(spark, [str(tmp_path / "a.json"), str(tmp_path / "b.json")])
    kept = seed.without_ids(raw, spark.createDataFrame([("seed:thing-2",)], "id string"))
    out = {r.file: json.loads(r.json) for r in seed.json_files(kept).collect()}
    assert [x["Title"] for x in out["a"]] == ["Thing 0", "Thing 1", "Thing 3"] and out["b"][0]["Title"] == "Other é" and out["a"][0]["Blurb"] is None
    seed.write_back(kept, str(tmp_path / "out"))
    again = spark.read.text(str(tmp_path / "out"), wholetext=True).collect()
    assert sorted(len(json.loads(r.value)) for r in again) == [1, 3]


def test_shared_folder_is_the_sessions(spark):
    assert shared_dir(spark) == shared_dir(spark) and spark.sparkContext.getCheckpointDir() is not None
