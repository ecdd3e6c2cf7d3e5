"""Equal segments are matched once, whoever asks for them, and what is the same for all that ask is made once."""

import json
from datetime import date

from pyspark.sql import functions as F

from chronogeo.functions.columns import parse_date
from chronogeo.functions.scoring import scope_ladder
from chronogeo.model import TIERS, EngineConfig
from chronogeo.operators import timeline
from chronogeo.storage import spread

SEGMENTS = "person string, segment_index int, seg_lat double, seg_lng double, seg_start string, seg_end string"
EVENTS = """id string, title string, display_title string, blurb string, date_start string, date_end string, date_precision string, lat double, lng double, reach_km double, scope string, significance double, category string,
 founding_kind string, source_url string, reach_min_lat double, reach_max_lat double, reach_min_lng double, reach_max_lng double"""


def events(spark, n=200):
    rows = [(f"Q{k}", f"t{k}", None, "b", date(1900 + k % 3, 1 + k % 12, 1).isoformat(), None, "day", 10.0 + k % 5 / 10, 20.0, 80.0, "local" if k % 4 else "global", (k + 50) / 1000, "event", None, None, 9.0, 11.0, 19.0, 21.0) for k in range(n)]
    return spark.createDataFrame(rows, EVENTS)


def segments(spark, persons=6):
    # everyone has another number of the same two segments, under one index
    rows = [(f"p{p}", 0, 10.0 + k % 2 / 10, 20.0, "1900", "1902") for p in range(persons) for k in range(p + 1)]
    return spark.createDataFrame(rows, SEGMENTS)


def test_lists_share_their_segments(spark):
    members, lists, segs = timeline.shared(segments(spark), EngineConfig(), "person", "segment_index")
    # before, each of the six lists had its own segments, 21 in all
    assert segs.count() == 2 and lists.count() == 21 and members.select("request").distinct().count() == 6


def test_the_best_are_all_that_quotas_admit(spark):
    cfg, by = EngineConfig(), ("request", "tier")
    some, members = timeline.shared_best(events(spark), segments(spark), cfg)
    every, of_all = timeline.shared_matches(events(spark), segments(spark), cfg, slim=True)
    assert some.count() < every.count() / 5 and some.groupBy("request", "tier", "id").count().count() <= 2 * 6 * sum(cfg.quota(t) for t in TIERS)

    def drawn(m, members):
        rows = timeline.tier_ranked(m, cfg, "request").groupBy(*by).agg(F.sum("score").alias("s"), F.count("*").alias("n")).join(members, "request").collect()
        return sorted((r.person, r.tier, round(r.s, 6), r.n) for r in rows)

    assert drawn(some, members) == drawn(every, of_all) and len(drawn(some, members)) == 12


def test_a_draw_reaches_beyond_copies_of_kept_events(spark):
    # 40 copies of each of three events that the first segment keeps come before the one event that the second one has for itself
    rows = [("p", 0, f"Q{k}", "global", "1900-01-01", 1.0, 0.9) for k in range(3)]
    rows += [("p", 1, f"Q{k}", "global", "1900-01-01", 1.0, 0.9) for k in range(3) for _ in range(40)] + [("p", 1, "Q99", "global", "1900-01-01", 1.0, 0.1)]
    m = spark.createDataFrame(rows, "person string, segment_index int, id string, tier string, date_start_iso string, distance_km double, score double")
    assert [r.id for r in timeline.draw(m, segments=2).collect() if r.segment_index == 1] == ["Q99"]


def test_an_answer_is_put_together_from_what_all_share(spark):
    same = spark.createDataFrame([(f'p"{p}', i, 10.0, 20.0, "1900", "1902") for p in range(5) for i in (0, 25)], SEGMENTS)
    bodies = []
    p = timeline.payloads(events(spark), same, n_segments=1, dataset_version="v", shape=lambda x: bodies.append(b := timeline.answer_body(x)) or b)
    got = {r.person: json.loads(r.json) for r in timeline.answers(p).collect()}
    assert bodies[0].count() == 1 and set(got) == {f'p"{k}' for k in range(5)}  # before, one body a person
    a = got['p"3']
    assert list(a) == ["datasetVersion", "person", "generatedWith", "entries", "meta"] and a["person"] == 'p"3' and a["datasetVersion"] == "v"
    assert a["meta"]["segmentCount"] == 2 and a["meta"]["returned"] == len(a["entries"]) > 0 and a["entries"][0]["sourceUrl"] is None
    m = timeline.markdown(timeline.payloads(events(spark), same, n_segments=1, shape=timeline.markdown_body)).collect()
    assert len(m) == 5 and all(r.markdown.startswith(f"# Timeline — {r.person}\n\n- **") and r.markdown.endswith("matched events_") for r in m)


def test_whole_dates_are_taken_as_they_are(spark):
    given = ["1871-10-08", "1871-10-08T00:00", "1871-02-31", "1871-13-01", "0871-01-01", " 1871-10-08", "1871-00-08", "1871-10-00", "1871-10", "871-10-08", "October 8, 1871", "", None]
    d = spark.createDataFrame([(k, x) for k, x in enumerate(given)], "k int, x string").select("k", parse_date(F.col("x")).alias("p")).orderBy("k").collect()
    assert [tuple(r.p) for r in d] == [
        ("1871-10-08", "1871-10-08", "day"), ("1871-10-08", "1871-10-08", "day"), ("1871-02-31", "1871-02-31", "day"), ("1871-13-01", "1871-13-01", "day"), ("0871-01-01", "0871-01-01", "day"),
        ("1871-10-08", "1871-10-08", "day"), ("1871-01-01", "1871-12-31", "year"), ("1871-10-01", "1871-10-31", "month"), ("1871-10-01", "1871-10-31", "month"), ("0871-10-08", "0871-10-08", "day"),
        ("1871-10-08", "1871-10-08", "day"), (None, None, None), (None, None, None),
    ]


def test_the_ladder_by_table(spark):
    given = [("conflict", 0.6), ("conflict", 0.1), ("election", 0.9), ("election", None), ("treaty", 0.2), ("birth", 1.0), ("other", 0.6), (None, 0.9), ("discovery", float("nan")), ("election", float("nan"))]
    d = spark.createDataFrame(given, "c string, n double").select(scope_ladder(F.col("c"), F.col("n"), F.lit(None).cast("string"), F.lit("x")).alias("s")).collect()
    assert [r.s for r in d] == ["global", "local", "national", "regional", "regional", "local", "national", "national", "global", "national"]


def test_spread_keeps_its_number_after_a_grouping(spark):
    # before, the exchange was left out of the plan as the groups were by the same column, and theirs was coalesced to one task
    d = spread(spark.range(400).withColumn("p", F.concat(F.lit("p"), "id")).groupBy("p").count(), "p")
    assert len({r.t for r in d.select(F.spark_partition_id().alias("t")).collect()}) == 4
