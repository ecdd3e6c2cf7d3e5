"""Dated sentences of wikitext pages, and the places that their links name.

Lines keep their number, and what the lines before say (inside a table? which year?) comes from running windows over a
page, so pages are parsed in parallel and inside the JVM.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.classify import category_of
from ..functions.columns import MONTHS, hash36, source_url, strip_wikilinks, trimmed, wikilinks

PLACE_TYPES = ("Q10864048", "Q15284", "Q1549591", "Q3624078", "Q486972", "Q515", "Q532", "Q618123", "Q6256", "Q82794")
VERBS = (
    "admitted annex annexed annexes capitulates cede ceded cedes conquer conquered conquers declared declares dissolves established "
    "establishes gained gains independence moved moves seceded secedes transferred transfers"
).split()


def lines_of(pages: DataFrame) -> DataFrame:
    """pages: page, wikitext."""
    return pages.select("page", F.posexplode(F.split("wikitext", "\n")).alias("line", "t")).withColumn("t", trimmed(F.col("t")))


def table_rows(pages: DataFrame) -> DataFrame:
    """page, line, year, date, event of tables whose cells stand in one line; a year holds until the next or the table's end."""
    w = Window.partitionBy("page").orderBy("line").rowsBetween(Window.unboundedPreceding, 0)
    mark = F.when(F.col("t").startswith("{|"), 1).when(F.col("t").startswith("|}"), 0)
    d = lines_of(pages).withColumn("inside", F.last(mark, ignorenulls=True).over(w)).withColumn("part", F.sum(F.when(F.col("t").startswith("|}"), 1).otherwise(0)).over(w))
    cells = F.split("t", r"\|\|")
    row = (F.col("inside") == 1) & F.col("t").startswith("|") & ~F.col("t").startswith("|-") & ~F.col("t").startswith("|}") & (F.size(cells) >= 3)
    d = d.where(row).withColumn("c", cells)
    year = trimmed(F.regexp_replace(F.regexp_replace(F.col("c")[0], r"^\|", ""), r"rowspan=[0-9]+", ""))
    own = F.when(year.rlike("^[0-9]{3,4}$"), year.try_cast("int"))
    text = trimmed(F.regexp_replace(F.regexp_replace(F.col("c")[2], r"style=[^|]+", ""), r"^\|", ""))
    carry = Window.partitionBy("page", "part").orderBy("line").rowsBetween(Window.unboundedPreceding, 0)
    d = d.select("page", "line", F.last(own, ignorenulls=True).over(carry).alias("year"), trimmed(F.col("c")[1]).alias("date"), text.alias("event"))
    return d.where((F.col("year") > 0) & (F.length("event") >= 10))


def bullets(pages: DataFrame) -> DataFrame:
    """page, line, year, date (empty), event of '* 1453: ...' lines below a heading 'Events', up to the next heading."""
    w = Window.partitionBy("page").orderBy("line").rowsBetween(Window.unboundedPreceding, 0)
    head = F.when(F.col("t").rlike(r"^==+\s*Events\s*==+"), 1).when(F.col("t").startswith("=="), 0)
    rx = r"^[-*]\s*([0-9]{4})[:–—]\s*(.+)$"
    d = lines_of(pages).withColumn("inside", F.last(head, ignorenulls=True).over(w)).where((F.col("inside") == 1) & F.col("t").rlike(rx))
    d = d.select("page", "line", F.regexp_extract("t", rx, 1).cast("int").alias("year"), F.lit("").alias("date"), F.regexp_extract("t", rx, 2).alias("event"))
    return d.where((F.col("year") > 0) & (F.length("event") > 10))


def dated(year: Column, text: Column) -> Column:
    """struct(date_start, date_precision) of a year with '3 may', 'may 3', 'may' or anything else."""
    s = F.lower(trimmed(F.coalesce(text, F.lit(""))))
    names = F.array(*[F.lit(m.lower()) for m in MONTHS])
    month = lambda c: F.nullif(F.array_position(names, c), F.lit(0))
    first, last = r"^([0-9]{1,2})\s+([0-9a-z_]+)$", r"^([0-9a-z_]+)\s+([0-9]{1,2})$"
    day = F.when(s.rlike(first), F.regexp_extract(s, first, 1)).when(s.rlike(last), F.regexp_extract(s, last, 2)).try_cast("int")
    of = F.when(s.rlike(first), month(F.regexp_extract(s, first, 2))).when(s.rlike(last), month(F.regexp_extract(s, last, 1)))
    two = lambda c: F.lpad(c.cast("string"), 2, "0")
    y = F.lpad(year.cast("string"), 4, "0")
    to_day = of.isNotNull() & (day > 0)
    date = F.when(to_day, F.concat_ws("-", y, two(of), two(day))).when(month(s).isNotNull(), F.concat_ws("-", y, two(month(s)), F.lit("01"))).otherwise(F.concat(y, F.lit("-01-01")))
    kind = F.when(to_day, "day").when(month(s).isNotNull(), "month").otherwise("year")
    return F.struct(date.alias("date_start"), kind.alias("date_precision"))


def verb_at(event: Column) -> Column:
    """Where the earliest verb of change begins (1-based), 0 if there is none."""
    at = F.filter(F.array(*[F.instr(F.lower(event), v) for v in VERBS]), lambda p: p > 0)
    return F.coalesce(F.array_min(at), F.lit(0))


def place_of(rows: DataFrame, titles: DataFrame, things: DataFrame, keys: tuple[str, ...] = ("page", "line")) -> DataFrame:
    """keys and the place (qid) of each row's event: the first place after the earliest verb; else the last one with more than
    ten sitelinks; else the last. titles: title, qid; things: qid, sitelinks, types."""
    links = rows.select(*keys, "event", F.posexplode(wikilinks(F.col("event"))).alias("k", "title"))
    places = things.where(F.arrays_overlap("types", F.array(*map(F.lit, PLACE_TYPES)))).select("qid", "sitelinks")
    near = links.join(titles, "title").join(places, "qid")
    at = F.expr("locate(concat('[[', title), event)")
    near = near.withColumns({"at": at, "verb": verb_at(F.col("event"))})
    after = F.when((F.col("verb") > 0) & (F.col("at") > F.col("verb")), F.col("k"))
    known = F.when(F.col("sitelinks") > 10, F.col("k"))
    best = near.groupBy(*keys).agg(F.min_by("qid", after).alias("a"), F.max_by("qid", known).alias("b"), F.max_by("qid", "k").alias("c"))
    return best.select(*keys, F.coalesce("a", "b", "c").alias("qid"))


def events(rows: DataFrame, titles: DataFrame, things: DataFrame, version: str = "wikitext-v1") -> DataFrame:
    """Events in the stored layout. things: qid, sitelinks, types, lat, lng, country; rows without a point are dropped."""
    at = things.select("qid", "sitelinks", "lat", "lng", "country")
    land = things.select(F.col("qid").alias("country"), F.col("lat").alias("c_lat"), F.col("lng").alias("c_lng"))
    # the first title of an entity in order of insertion, where the table tells it; else the least
    name = titles.groupBy("qid").agg((F.min_by("title", "ord") if "ord" in titles.columns else F.min("title")).alias("title"))
    d = rows.join(place_of(rows, titles, things), ["page", "line"]).join(at, "qid").join(land, "country", "left").join(name, "qid")
    own = F.col("lat").isNotNull() & F.col("lng").isNotNull()
    d = d.withColumns({"lat": F.when(own, F.col("lat")).otherwise(F.col("c_lat")), "lng": F.when(own, F.col("lng")).otherwise(F.col("c_lng")), "t": dated(F.col("year"), F.col("date")), "title": F.substring("title", 1, 60)})
    key = F.concat_ws(":", F.lit("timeline"), hash36(F.col("page")), F.col("t.date_start"), hash36(F.col("title")))
    return d.where("lat is not null and lng is not null").select(
        key.alias("id"), "title", strip_wikilinks(F.col("event")).alias("blurb"), "t.date_start", "t.date_precision", "lat", "lng", category_of(F.col("event")).alias("category"),
        F.least(F.lit(1.0), F.col("sitelinks") / F.lit(100.0)).alias("notability"), source_url(F.col("page"), F.lit("")).alias("source_url"),
        F.to_json(F.struct(F.col("page").alias("wikipedia"), F.col("qid").alias("place"))).alias("source_ids"), F.lit(version).alias("ingest_version"), "page", "line",
    )
