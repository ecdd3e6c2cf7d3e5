"""The registered queries over the driver's tables; the oracle's SQL for each is in oracle_sql.py."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import columns as C
from ..functions.classify import category_of, display_rule, display_title, founding_kind, is_institution
from ..functions.scoring import decade_percentile, scope_ladder, with_scope
from ..functions.text import slugify
from ..model import EngineConfig
from ..operators import curate, graph, report, search, store
from ..operators import timeline as T
from ..sources import dump, mediawiki, seed, wikitext
from ..sources.fixtures import classified, geo_events, requests, scored_events, scored_table
from ..storage import delete_on_exit, shared_dir, spread, stored
from ..streaming.limiter import limited

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ENTRY = ("person", "segment_index", "id", "title", "display_title", "blurb", "date", "date_start_iso", "date_end_iso", "precision", "distance_km", "reach_km", "scope", "significance", "category", "score")


def register(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def _shared(spark, d) -> tuple[DataFrame, DataFrame]:
    """Matches by request, and the segments that made each."""
    return T.shared_matches(scored_table(spark, d), requests(spark, d), slim=True)


def _best(spark, d) -> tuple[DataFrame, DataFrame]:
    """The matches by request that a tier's quota can admit, and the segments that made each."""
    return T.shared_best(scored_table(spark, d), requests(spark, d))


def _payloads(spark, d, shape) -> DataFrame:
    return T.payloads(scored_table(spark, d), requests(spark, d), n_segments=2, dataset_version="dump-v0", shape=shape)


# --- timeline ---------------------------------------------------------------------------------------------------------


@register
def timeline_flagship(spark, d):
    return T.timeline(scored_table(spark, d), requests(spark, d), n_segments=2).select(*ENTRY)


@register
def timeline_total_matched(spark, d):
    m, members = _shared(spark, d)
    return T.handed_out(m.groupBy("request").agg(F.count("*").alias("n")), members).groupBy("person").agg(F.sum("n").alias("total_matched"))


@register
def timeline_config_floor(spark, d):
    cfg = EngineConfig.of(significance_floor=0.5, scope_floor={"local": 0.3}, max_per_segment=6)
    return T.timeline(scored_table(spark, d), requests(spark, d), cfg, 2).select("person", "segment_index", "id", "score")


@register
def timeline_matches(spark, d):
    return T.all_handed_out(*_shared(spark, d), "id").select("person", "segment_index", "id", "tier", "distance_km", "score")


@register
def timeline_payload(spark, d):
    ids = F.array_join(F.transform(F.coalesce("entries", F.expr("slice(entries, 1, 0)")), lambda x: x["id"]), ",").alias("ids")
    cols = ("person", "total_matched", "returned", ids, "dataset_version")
    return _payloads(spark, d, lambda p: p.select(*cols)).drop("segment_count")


@register
def timeline_markdown(spark, d):
    return T.markdown(_payloads(spark, d, T.markdown_body))


@register
def match_rank(spark, d):
    m, members = _shared(spark, d)
    return T.all_handed_out(T.ranked(m, "request").select("request", "id", "match_rank", "tier_rank"), members, "id")


@register
def tier_quota(spark, d):
    m, members = _best(spark, d)
    r = T.tier_ranked(m, EngineConfig(), "request").groupBy("request", "tier").agg(F.count("*").alias("n"), F.max("tier_rank").alias("most"))
    return T.handed_out(r, members).groupBy("segment_index", "tier").agg(F.sum("n").alias("n"), F.max("most").alias("most"))


@register
def round_robin_draw(spark, d):
    """Each segment for itself."""
    m, members = _best(spark, d)
    k = T.draw(m.withColumnRenamed("request", "person").withColumn("segment_index", F.lit(0)), segments=1)
    k = k.groupBy(F.col("person").alias("request"), "tier").agg(F.count("*").alias("n"), F.min("score").alias("least"))
    return T.handed_out(k, members).select(F.concat_ws("|", "person", F.col("segment_index").cast("string")).alias("person"), "tier", "n", "least")


# --- scores ------------------------------------------------------------------------------------------------------------


@register
def geo_events_adapter(spark, d):
    return geo_events(spark, d)


@register
def decade_percentiles(spark, d):
    return decade_percentile(classified(spark, d)).select("id", "significance")


@register
def scope_ladders(spark, d):
    e = classified(spark, d)
    ladder = scope_ladder(F.col("category"), F.col("notability"), F.col("founding_kind"), F.col("blurb"))
    return with_scope(e.withColumn("ladder", ladder)).select("id", "ladder", "scope")



@register
def reach_formula(spark, d):
    return scored_events(spark, d).select("id", "scope", "reach_km")


@register
def reach_bbox(spark, d):
    cols = [f"reach_{m}_{x}" for x in ("lat", "lng") for m in ("min", "max")]
    return scored_events(spark, d).select("id", *[C.half_up(F.col(c), 6).alias(c) for c in cols])


@register
def score_report(spark, d):
    before = geo_events(spark, d).select("id", F.col("scope").alias("old_scope"))
    return report.score_report(scored_events(spark, d).join(before, "id"))


@register
def haversine(spark, d):
    e = geo_events(spark, d)
    return e.select("id", C.half_up(C.haversine_km(F.lit(38.2544), F.lit(-104.6091), F.col("lat"), F.col("lng")), 1).alias("km"))


@register
def reach_filters(spark, d):
    """Events whose box, and whose circle, holds the first demo place."""
    e = scored_events(spark, d)
    lat, lng = F.lit(38.2544), F.lit(-104.6091)
    box = lat.between(F.col("reach_min_lat"), F.col("reach_max_lat")) & lng.between(F.col("reach_min_lng"), F.col("reach_max_lng"))
    circle = C.haversine_km(lat, lng, F.col("lat"), F.col("lng")) <= F.col("reach_km")
    return e.where(box).groupBy("scope").agg(F.count("*").alias("in_box"), F.count_if(circle).alias("in_circle"))


@register
def date_overlap(spark, d):
    p = C.parse_date(F.col("date_start"))
    return geo_events(spark, d).select("id", p.alias("p")).where(C.overlaps(F.col("p.lo"), F.col("p.hi"), F.lit("1902-01-01"), F.lit("1921-06-30"))).select("id", F.col("p.lo").alias("lo"), F.col("p.hi").alias("hi"))


# --- text and dates ------------------------------------------------------------------------------------------------------


@register
def institutions(spark, d):
    return geo_events(spark, d).select("id", is_institution(F.col("blurb")).alias("institution"))


@register
def founding_classify(spark, d):
    return geo_events(spark, d).where("category = 'founding'").select("id", founding_kind(F.col("blurb")).alias("kind"))


@register
def founding_tally(spark, d):
    return report.founding_tally(classified(spark, d))


@register
def display_titles(spark, d):
    e = classified(spark, d)
    rule = display_rule(F.col("title"), F.col("blurb"), F.col("category"), F.col("founding_kind"))
    return e.select("id", rule.alias("rule"), display_title(F.col("title"), rule).alias("display_title"))


@register
def display_rule_counts(spark, d):
    return curate.rule_counts(classified(spark, d))


@register
def rule_samples(spark, d):
    return curate.rule_samples(classified(spark, d))


@register
def category_from_text(spark, d):
    return geo_events(spark, d).select("id", category_of(F.coalesce("blurb", F.lit(""))).alias("kind"))


@register
def parse_dates(spark, d):
    """Partial dates of every form: year, month, day, month 00, and dates in words."""
    e = geo_events(spark, d)
    text = F.when(F.col("date_precision") == "year", F.substring("date_start", 1, 4)).when(F.col("date_precision") == "month", F.substring("date_start", 1, 7)).otherwise(F.col("date_start"))
    e = e.select("id", text.alias("iso"), C.format_date(F.col("date_start"), F.col("date_precision")).alias("words"))
    a, b = C.parse_date(F.col("iso")), C.parse_date(F.col("words"))
    return e.select("id", a["lo"].alias("lo"), a["hi"].alias("hi"), a["precision"].alias("precision"), b["lo"].alias("lo_words"), b["hi"].alias("hi_words"))


@register
def format_dates(spark, d):
    return geo_events(spark, d).select("id", C.format_date(F.col("date_start"), F.col("date_precision")).alias("date"))


@register
def hash36(spark, d):
    return table(spark, d, "customer").select("c_custkey", C.hash36(F.col("c_name")).alias("h"))


@register
def slugs(spark, d):
    return geo_events(spark, d).select("id", slugify(F.col("title")).alias("slug"))


@register
def wkt_points(spark, d):
    e = geo_events(spark, d).withColumn("w", F.format_string("Point(%.2f %.2f)", "lng", "lat"))
    return e.select("id", C.wkt_point(F.col("w"))["lat"].alias("lat"), C.wkt_point(F.col("w"))["lng"].alias("lng"))


@register
def wikidata_times(spark, d):
    e = geo_events(spark, d)
    month = F.when(F.col("date_precision") == "year", F.concat(F.substring("date_start", 1, 4), F.lit("-00-00"))).otherwise(F.col("date_start"))
    t = C.wikidata_time(F.concat(F.lit("+"), month, F.lit("T00:00:00Z")), C.pick({"day": 11, "month": 10, "year": 9}, F.col("date_precision")))
    return e.select("id", t["date"].alias("date"), t["precision"].alias("kind"))


@register
def truncate_ips(spark, d):
    """IPv4, IPv4 in IPv6, IPv6, and what is no address."""
    k = F.col("c_custkey")
    v4 = F.concat_ws(".", *[(k * x % 256).cast("string") for x in (3, 5, 7, 11)])
    v6 = F.concat(F.lit("2001:db8:"), (k % 10000).cast("string"), F.lit(":8a2e::7334"))
    ip = F.when(k % 4 == 0, v4).when(k % 4 == 1, v6).when(k % 4 == 2, F.concat(F.lit("::ffff:"), v4)).otherwise("nowhere")
    return table(spark, d, "customer").select("c_custkey", C.truncate_ip(ip).alias("ip"))


# --- statistics and curation ---------------------------------------------------------------------------------------------


@register
def stats_by_category(spark, d):
    return report.by(geo_events(spark, d), "category")


@register
def stats_by_precision(spark, d):
    return report.by(geo_events(spark, d), "date_precision")


@register
def stats_by_scope(spark, d):
    return report.by(geo_events(spark, d), "scope", "(unscored)")


@register
def year_span(spark, d):
    return report.year_span(geo_events(spark, d))


@register
def modal_version(spark, d):
    return report.modal_version(geo_events(spark, d))


@register
def year_samples(spark, d):
    return report.top_titles(geo_events(spark, d), "1912")


@register
def year_precision_samples(spark, d):
    return report.precision_samples(geo_events(spark, d))


@register
def unclassified_foundings(spark, d):
    return report.unclassified_foundings(classified(spark, d))


@register
def series_detect(spark, d):
    return curate.series(scored_events(spark, d))


@register
def series_delete(spark, d):
    return curate.without_series(geo_events(spark, d), keep="BUILDING Championship").select("id")


@register
def series_doomed(spark, d):
    return curate.doomed(scored_events(spark, d), keep="BUILDING Championship")


@register
def series_semi(spark, d):
    return curate.series_sample(scored_events(spark, d))


@register
def prune_by_scope(spark, d):
    return report.by(scored_events(spark, d).where("category = 'election'"), "scope", "(unscored)")


@register
def prune_histogram(spark, d):
    return curate.histogram(geo_events(spark, d), "election")


@register
def prune_candidate_floors(spark, d):
    return curate.candidate_floors(geo_events(spark, d), "election")


@register
def prune_apply(spark, d):
    return store.delete_where(geo_events(spark, d), store.below_floor("election", 0.25)).groupBy("category").agg(F.count("*").alias("n"))


@register
def least_notable(spark, d):
    return curate.least_notable(geo_events(spark, d), "election", 0.25)


def _verdicts(e: DataFrame) -> tuple[DataFrame, DataFrame]:
    k = F.regexp_extract("id", "([0-9]+)", 1).cast("long")
    seeds = e.where(store.seeded()).select("id", k.alias("k"))
    drops = seeds.where("k % 3 = 0").select(F.col("id").alias("seed_id"))
    date = F.concat(F.lit("1900-01-"), F.lpad((F.col("k") % 28 + 1).cast("string"), 2, "0"))
    other = F.when(F.col("k") % 5 == 0, F.lit("Q-none")).otherwise(F.concat(F.lit("Q"), (F.col("k") + 1).cast("string")))
    merges = seeds.where("k % 3 = 1").select(F.col("id").alias("seed_id"), other.alias("dump_id"), date.alias("seed_date"))
    return drops, merges


@register
def merge_date(spark, d):
    e = geo_events(spark, d)
    return curate.merge_status(e, _verdicts(e)[1])


@register
def dupe_anti(spark, d):
    e = geo_events(spark, d)
    return curate.dupes_applied(e, *_verdicts(e)).select("id", "date_start", "date_precision")


@register
def verdict_overlap(spark, d):
    e = geo_events(spark, d)
    drops, merges = _verdicts(e)
    return curate.contradictions(drops.union(merges.where("substr(seed_date, 9, 2) = '06'").select("seed_id")), merges)


# --- writes --------------------------------------------------------------------------------------------------------------


def _layers(spark, d) -> tuple[DataFrame, DataFrame]:
    """An older table, and a layer that partly overlaps it and repeats ids."""
    e = geo_events(spark, d).select("id", "title", "notability", "scope", F.regexp_extract("id", "([0-9]+)", 1).cast("long").alias("k"))
    old = e.where("k % 3 <> 0").drop("k")
    new = e.where("k % 2 = 0").select("id", F.concat(F.lit("new "), "title").alias("title"), (F.col("k") % 7).cast("double").alias("notability"), F.lit(0).alias("ord"))
    again = new.where("notability < 2").select("id", F.lit("again").alias("title"), "notability", F.lit(1).alias("ord"))
    return old, new.union(again)


@register
def insert_ignore(spark, d):
    old, new = _layers(spark, d)
    return store.insert_ignore(old, new, ["ord"])


@register
def insert_replace(spark, d):
    old, new = _layers(spark, d)
    return store.insert_replace(old, new, [F.desc("ord")])


@register
def upsert_update(spark, d):
    old, new = _layers(spark, d)
    return store.upsert(old, new.where("ord = 0").drop("ord"), ("title", "notability"))


@register
def dup_id_check(spark, d):
    return store.duplicate_ids(_layers(spark, d)[1]).select("id", "n", F.array_join("claimants", "|").alias("claimants"))


@register
def dataset_build_id(spark, d):
    version = report.modal_version(geo_events(spark, d)).select(F.lit("dataset_version").alias("key"), F.col("ingest_version").alias("value"))
    rest = spark.createDataFrame([("scoring_version", "struct-1"), ("reach_version", ""), ("last_prune", "election<0.25"), ("last_series_prune", "2 series")], "key string, value string")
    return store.build_id(version.union(rest))


# --- joins of the ingest -------------------------------------------------------------------------------------------------


def type_edges(spark, d) -> DataFrame:
    """child k -> parent k div 3 for parts, and a cycle of two."""
    p = table(spark, d, "part").select(F.col("p_partkey").alias("k")).where("k > 0")
    tree = p.select(F.concat(F.lit("T"), "k").alias("child"), F.concat(F.lit("T"), F.expr("k div 3")).alias("parent"))
    return tree.union(spark.createDataFrame([("T1", "T7"), ("T7", "T1")], "child string, parent string"))


def type_roots(spark) -> DataFrame:
    return spark.createDataFrame([("T5", "conflict", 0), ("T2", "treaty", 2), ("T1", "event", 6), ("T6", "discovery", 4)], "node string, category string, priority int")


@register
def type_closure(spark, d):
    return graph.type_closure(type_edges(spark, d), type_roots(spark))


def entities(spark, d) -> DataFrame:
    """Entities made from parts, in the layout of the dump reader; every seventh is a person, every eleventh a country."""
    k = F.col("p_partkey")
    q = lambda x: F.concat(F.lit("Q"), x.cast("string"))
    country = q(k % 40 * 11)
    claim = lambda y, p: F.struct(F.concat(F.lit("+"), y.cast("string"), F.lit("-05-00T00:00:00Z")).alias("time"), F.lit(p).alias("precision"))
    none = F.lit(None).cast("struct<time:string,precision:int>")
    person = k % 7 == 0
    types = F.when(person, F.array(F.lit("Q5"))).otherwise(F.array(F.concat(F.lit("T"), (k * 5 % 2000).cast("string")), F.concat(F.lit("T"), (k * 3 % 700).cast("string"))))
    return table(spark, d, "part").select(
        q(k).alias("qid"), F.col("p_name").alias("title"), F.col("p_type").alias("blurb"), F.when(k % 4 == 0, F.col("p_name")).alias("page"), (k % 90).cast("int").alias("sitelinks"), types.alias("types"),
        F.array().cast("array<string>").alias("parents"), F.when((k % 11 == 0) | (k % 3 == 0), F.struct((k % 90).cast("double").alias("lat"), (k % 180).cast("double").alias("lng"))).alias("own"),
        country.alias("P17"), q(k * 11 % 500).alias("P19"), q(k * 9 % 500).alias("P20"), q(k * 3 % 300).alias("P495"),
        F.when(~person & (k % 5 != 0), claim(1500 + k % 500, 10)).otherwise(none).alias("P585"), F.when(~person, claim(1600 + k % 400, 9)).otherwise(none).alias("P580"),
        none.alias("P571"), F.when(~person, claim(1700 + k % 300, 11)).otherwise(none).alias("P575"), F.when(person, claim(1800 + k % 100, 11)).otherwise(none).alias("P569"), F.when(person, claim(1850 + k % 100, 9)).otherwise(none).alias("P570"),
    )


@register
def dump_events(spark, d):
    closure = graph.type_closure(type_edges(spark, d), type_roots(spark))
    return dump.events(entities(spark, d), closure, 1550, 1950).select("id", "category", "date_start", "date_precision", "lat", "lng", "notability")


@register
def type_category_join(spark, d):
    closure = graph.type_closure(type_edges(spark, d), type_roots(spark))
    return dump.category_of_types(entities(spark, d), closure)


@register
def top_k_per_year(spark, d):
    from pyspark.sql import Window

    w = Window.partitionBy("yr", "category").orderBy(F.desc_nulls_last("notability"), "id")
    e = geo_events(spark, d).withColumn("yr", F.substring("date_start", 1, 4))
    return e.withColumn("rank", F.row_number().over(w)).where("rank <= 2").select("yr", "category", "id", "rank")


@register
def set_ops(spark, d):
    c = lambda m: geo_events(spark, d).where(F.col("category") == m).select("title")
    a, b, x = c("event"), c("conflict"), c("treaty")
    return a.intersect(b).select(F.lit("both").alias("set"), "title").union(a.subtract(x).select(F.lit("only"), "title")).union(a.union(b).distinct().select(F.lit("any"), "title"))


# --- wikitext --------------------------------------------------------------------------------------------------------------


def nation_pages(spark, d) -> DataFrame:
    """A page for each nation: a table whose years span several rows, and bullets below a heading."""
    n, k = F.col("n_name"), F.col("n_nationkey")
    y = (1500 + k * 10).cast("string")
    text = F.concat_ws(
        "\n", F.lit("intro || not || a row"), F.lit("{| class=wikitable"), F.lit("! Year !! Date !! Event"), F.lit("|-"),
        F.concat(F.lit("|rowspan=2 "), y, F.lit("||3 May||[["), n, F.lit("]] conquers [[REGION|the region]] in a war")), F.lit("|-"),
        F.concat(F.lit("| ||August||[["), n, F.lit("]] signs a treaty, see [[File:x.png]]")), F.lit("|}"), F.lit("| ||May||no year holds here any more"),
        F.lit("== Events =="), F.concat(F.lit("* 1453: The "), n, F.lit(" is founded and declares independence")), F.lit("* 1454: short"), F.lit("== Births =="), F.lit("* 1455: is no event but a birth"),
    )
    return table(spark, d, "nation").select(n.alias("page"), text.alias("wikitext"))


@register
def carry_year(spark, d):
    t = wikitext.table_rows(nation_pages(spark, d))
    date = wikitext.dated(F.col("year"), F.col("date"))
    return t.select("page", "line", "year", date["date_start"].alias("date_start"), date["date_precision"].alias("precision"), C.strip_wikilinks(F.col("event")).alias("blurb"), category_of(F.col("event")).alias("category"), F.array_join(C.wikilinks(F.col("event")), "|").alias("links"))


@register
def section_bullets(spark, d):
    return wikitext.bullets(nation_pages(spark, d)).select("page", "line", "year", "event", category_of(F.col("event")).alias("category"))


@register
def pick_place(spark, d):
    n = table(spark, d, "nation")
    titles = n.select(F.col("n_name").alias("title"), F.concat(F.lit("N"), "n_nationkey").alias("qid")).union(spark.createDataFrame([("REGION", "R")], "title string, qid string"))
    things = n.select(F.concat(F.lit("N"), "n_nationkey").alias("qid"), F.col("n_nationkey").cast("int").alias("sitelinks"), F.array(F.lit("Q6256")).alias("types")).union(spark.createDataFrame([("R", 5, ["Q82794"])], "qid string, sitelinks int, types array<string>"))
    return wikitext.place_of(wikitext.table_rows(nation_pages(spark, d)), titles, things)


# --- search ------------------------------------------------------------------------------------------------------------------


_indexes: dict[tuple[str, str], DataFrame] = {}


def event_index(spark, d) -> DataFrame:
    """The inverted index of the events, written once by each application."""
    key = spark.sparkContext.applicationId, d
    if key not in _indexes:
        raw = stored(search.index_of(geo_events(spark, d), "id", ("title", "blurb")))  # read to count, to find ranges and to sort: made once
        _indexes[key] = stored(search.in_ranges(raw), "token")
    return _indexes[key]


def _search(spark, d, query: str) -> DataFrame:
    return search.search_by(event_index(spark, d), geo_events(spark, d), query).select("id", "title", "notability", "date_start")


@register
def search_scan(spark, d):
    """Without an index."""
    return search.search(geo_events(spark, d), "city nevada").select("id", "title", "notability", "date_start")


@register
def search_near(spark, d):
    return _search(spark, d, '(blurb: ^university AND {title blurb}: NEAR(university canada, 2)) OR title: NEAR(place 7, 0) OR -title: ^"state of"')


@register
def search_topk(spark, d):
    return _search(spark, d, "city nevada")


@register
def search_phrase(spark, d):
    return _search(spark, d, '"sovereign state" OR title:championship NOT machinery')


@register
def search_prefix(spark, d):
    return _search(spark, d, "uni* tor*")


@register
def search_documents(spark, d):
    return search.matching(table(spark, d, "documents").select("doc_id", "text"), "the AND (of OR und) NOT que", ("text",)).select("doc_id")


@register
def inverted_index(spark, d):
    i = search.index_of(geo_events(spark, d), "id", ("title", "blurb"))
    return i.groupBy("token", "field").agg(F.count("*").alias("n"), F.count_distinct("id").alias("df"), F.max("pos").alias("last"))


# --- keyed state -----------------------------------------------------------------------------------------------------------


@register
def fixed_window_limiter(spark, d):
    r = table(spark, d, "events").select(F.col("user_id").cast("string").alias("key"), F.unix_millis(F.col("ts").cast("timestamp")).alias("ts_ms"))
    return limited(r, window=6 * 3_600_000, most=2)


# --- the service's answers -------------------------------------------------------------------------------------------------


@register
def timeline_answers(spark, d):
    """What is in the JSON that a service sends."""
    a = T.answers(_payloads(spark, d, T.answer_body))
    shape = "datasetVersion string, person string, generatedWith string, entries array<struct<id string, displayTitle string, segmentIndex int, score double>>, meta struct<segmentCount bigint, totalMatched bigint, returned int>"
    a = a.select(F.from_json("json", shape).alias("j")).select("j.*")
    total = lambda c: F.aggregate("entries", F.lit(0.0), lambda s, x: s + x[c])
    return a.select(
        "person", F.col("datasetVersion").alias("dataset_version"), F.col("generatedWith").alias("generated_with"), F.col("meta.segmentCount").alias("segment_count"), F.col("meta.totalMatched").alias("total_matched"),
        F.col("meta.returned").alias("returned"), F.array_join("entries.id", ",").alias("ids"), F.array_join("entries.displayTitle", "|").alias("titles"),
        C.half_up(total("score"), 3).alias("score"), total("segmentIndex").cast("long").alias("later"),
    )


@register
def segment_errors(spark, d):
    """Requests with dates that cannot be read, or in the wrong order."""
    k = F.col("c_custkey") % 5
    c = table(spark, d, "customer")
    bad = c.select(F.col("c_name").alias("person"), k.cast("int").alias("segment_index"), F.lit(1.0).alias("seg_lat"), F.lit(1.0).alias("seg_lng"), F.when(k == 0, "nonsense").otherwise("1900").alias("seg_start"), F.when(k == 1, "??").when(k == 2, "1899").otherwise("1901").alias("seg_end"))
    return T.segment_errors(bad)


def _meta(spark, d) -> DataFrame:
    version = report.modal_version(geo_events(spark, d)).select(F.lit("dataset_version").alias("key"), F.col("ingest_version").alias("value"))
    return version.union(spark.createDataFrame([("scoring_version", "struct-1"), ("reach_version", ""), ("last_prune", "election<0.25"), ("last_series_prune", "2 series")], "key string, value string"))


@register
def service_meta(spark, d):
    j = report.service_meta(geo_events(spark, d), _meta(spark, d))
    paths = {
        "engine": "engine", "build": "datasetBuild", "scoring": "datasetLayers.scoring", "reach": "datasetLayers.reach", "prunes": "datasetLayers.prunes", "total": "dataset.totalEvents",
        "max_per_segment": "defaults.max_per_segment", "local_floor": "defaults.scope_floor.local", "global_quota": "defaults.scope_quota.global", "max_segments": "limits.max_segments",
    }
    return j.select(*[F.get_json_object("json", f"$.{p}").alias(n) for n, p in paths.items()])


@register
def service_health(spark, d):
    return report.health(geo_events(spark, d))


@register
def meta_lookup(spark, d):
    return store.set_meta(_meta(spark, d), {"scored_at": "now"}).where("key = 'dataset_version'").select("value")


@register
def reset_founding_kinds(spark, d):
    e = store.reset(store.reset(classified(spark, d), "founding_kind", F.col("category") == "founding"), "display_title")
    return e.groupBy("category").agg(F.count("*").alias("n"), F.count("founding_kind").alias("kinds"), F.count("display_title").alias("display_titles"))


@register
def verdict_counts(spark, d):
    drops, merges = _verdicts(geo_events(spark, d))
    return curate.verdict_counts(drops.union(drops.where("seed_id like '%9'")), merges)


# --- readers, on bodies and files made from the tables ---------------------------------------------------------------------


def _bodies(spark, d, page) -> DataFrame:
    """Bodies of 50 pages each: page numbers to JSON objects."""
    p = table(spark, d, "part").select(F.expr("p_partkey div 50").alias("b"), F.col("p_partkey").cast("string").alias("k"), page.alias("p"))
    return p.groupBy("b").agg(F.to_json(F.struct(F.struct(F.map_from_entries(F.collect_list(F.struct("k", "p"))).alias("pages")).alias("query"))).alias("body")).select("body")


@register
def wiki_pages(spark, d):
    k = F.col("p_partkey")
    text = F.struct(F.struct(F.struct(F.when(k % 5 != 0, F.concat(F.lit("* 1453: [["), "p_type", F.lit("]]"))).alias("*")).alias("main")).alias("slots"))
    return mediawiki.wikitexts(_bodies(spark, d, F.struct(F.col("p_name").alias("title"), F.when(k % 7 == 0, "").alias("missing"), F.when(k % 7 != 0, F.array(text)).alias("revisions"))))


@register
def wiki_items(spark, d):
    k = F.col("p_partkey")
    props = F.when((k % 7 != 0) & (k % 3 != 0), F.struct(F.concat(F.lit("Q"), k.cast("string")).alias("wikibase_item")))
    return mediawiki.items(_bodies(spark, d, F.struct(F.col("p_name").alias("title"), props.alias("pageprops"))))


def _snak(value) -> object:
    return F.array(F.struct(F.struct(F.struct(value.alias("value")).alias("datavalue")).alias("mainsnak")))


@register
def wiki_entities(spark, d):
    k = F.col("p_partkey")
    q = F.concat(F.lit("Q"), k.cast("string"))
    links = F.map_from_arrays(F.transform(F.sequence(F.lit(1), F.lit(4)), lambda x: F.concat(x.cast("string"), F.lit("wiki"))), F.array_repeat(F.struct(F.lit("t").alias("title")), 4))
    links = F.map_filter(links, lambda key, _: F.substring(key, 1, 1).cast("int") <= k % 4)
    at = F.when(k % 3 != 0, _snak(F.struct((k % 90).cast("double").alias("latitude"), (k % 180).cast("double").alias("longitude"))))
    kinds = F.when(k % 2 == 0, F.concat(_snak(F.struct(F.lit("Q515").alias("id"))), _snak(F.struct(F.concat(F.lit("Q"), F.col("p_size").cast("string")).alias("id")))))
    land = F.when(k % 5 == 0, _snak(F.struct(F.lit("Q30").alias("id"))))
    e = F.struct(links.alias("sitelinks"), F.struct(at.alias("P625"), kinds.alias("P31"), land.alias("P17")).alias("claims"))
    p = table(spark, d, "part").select(F.expr("p_partkey div 50").alias("b"), q.alias("k"), e.alias("e"))
    bodies = p.groupBy("b").agg(F.to_json(F.struct(F.map_from_entries(F.collect_list(F.struct("k", "e"))).alias("entities"))).alias("body")).select("body")
    return mediawiki.entities(bodies).withColumn("types", F.array_join("types", "|"))


@register
def dump_lines(spark, d):
    """Entities from lines of JSON, with brackets, commas, and lines that are none."""
    k = F.col("p_partkey")
    value = lambda x: F.struct(x.alias("value"))
    links = F.map_from_arrays(F.transform(F.sequence(F.lit(1), F.lit(4)), lambda x: F.concat(x.cast("string"), F.lit("wiki"))), F.array_repeat(F.struct(F.lit("t").alias("title")), 4))
    body = F.struct(
        F.concat(F.lit("Q"), k.cast("string")).alias("id"), F.when(k % 11 == 0, "property").otherwise("item").alias("type"), F.struct(value(F.col("p_name")).alias("en")).alias("labels"), F.when(k % 2 == 0, F.struct(value(F.col("p_type")).alias("en"))).alias("descriptions"),
        F.map_filter(links, lambda key, _: F.substring(key, 1, 1).cast("int") <= k % 4).alias("sitelinks"),
        F.struct(
            _snak(F.struct(F.concat(F.lit("Q"), F.col("p_size").cast("string")).alias("id"))).alias("P31"), F.when(k % 3 == 0, _snak(F.struct((k % 90).cast("double").alias("latitude"), F.lit(1.0).alias("longitude")))).alias("P625"),
            _snak(F.struct(F.concat(F.lit("+"), (1500 + k % 500).cast("string"), F.lit("-00-00T00:00:00Z")).alias("time"), F.lit(9).alias("precision"))).alias("P585"),
        ).alias("claims"),
    )
    parts = spread(table(spark, d, "part"), "p_partkey")  # few row groups would be few tasks
    lines = parts.select(F.concat(F.to_json(body), F.lit(",")).alias("value")).union(spark.createDataFrame([("[",), ("]",), ("",), ("{broken",)], "value string"))
    e = dump.entities(lines)
    return e.select("qid", "title", "blurb", "sitelinks", F.array_join("types", "|").alias("types"), F.col("own.lat").alias("lat"), F.col("P585.time").alias("time"))


@register
def seed_rows(spark, d):
    """Curated files written as JSON, less the rows that verdicts name, and read again."""
    e = geo_events(spark, d).where(store.seeded()).withColumn("k", F.regexp_extract("id", "([0-9]+)", 1).cast("long"))
    title = F.concat_ws(" ", "title", F.col("k").cast("string"))
    raw = e.select(
        title.alias("Title"), F.lit(None).cast("string").alias("Blurb"), F.col("date_start").alias("Date start"), F.lit("day").alias("Precision"), "category", F.lit("x").alias("Place"), F.col("lat").alias("Lat"), F.col("lng").alias("Lng"),
        F.coalesce("notability", F.lit(0.0)).alias("Notability"), F.col("scope").alias("Scope (intended)"), F.lit(None).cast("string").alias("Source URL"), F.lit("seed-v0").alias("Ingest version"), F.lit(None).cast("string").alias("Seed ID"),
        F.concat(F.lit("part"), (F.col("k") % 4).cast("string")).alias("file"), "k",
    ).withColumnRenamed("category", "Category")
    named = seed.seed_id(raw.where("k % 3 = 0")).select("id")
    files = seed.json_files(seed.without_ids(raw.drop("k"), named))
    rows = files.select("file", F.explode(F.from_json("json", f"array<struct<{seed.RAW.replace(' string', ':string').replace(' double', ':double')}>>")).alias("r")).select("file", "r.*")
    return seed.seeds(rows).select("id", "title", "date_start", "scope", "notability", F.get_json_object("source_ids", "$.seed").alias("file"))


@register
def scan_events(spark, d):
    """The events written, and read again for some years."""
    path = f"{shared_dir(spark)}/events-{uuid.uuid4().hex}"
    store.write_events(geo_events(spark, d), path, 8)
    delete_on_exit(spark, path)
    return store.read_events(spark, path).where("date_start >= '1850' and date_start < '1870'").select("id", "title", "date_start", "category", "scope", "significance", "founding_kind")
