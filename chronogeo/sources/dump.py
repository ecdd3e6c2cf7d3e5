"""Entity dumps: one JSON entity a line, with brackets around and commas between the lines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.columns import notability_of, source_url, wikidata_time

HUMAN, HUMAN_FLOOR = "Q5", 30
#: in order of priority: category, root types, date properties, least sitelinks, where the place is looked for
CATEGORIES = (
    ("conflict", ("Q178561", "Q180684", "Q198", "Q831663"), ("P585", "P580"), 5, "own"),
    ("election", ("Q40231",), ("P585", "P580"), 12, "own_country"),
    ("treaty", ("Q131569",), ("P585", "P580"), 10, "own_country"),
    ("founding", ("Q10864048", "Q1549591", "Q3624078", "Q3957", "Q515", "Q532", "Q6256"), ("P571",), 5, "own"),
    ("discovery", ("Q11019", "Q12772819"), ("P575", "P571"), 3, "own"),
    ("milestone", ("Q495307", "Q5916"), ("P585", "P580", "P575", "P571"), 25, "country_own"),
    ("event", ("Q1190554", "Q1656682"), ("P585", "P580"), 8, "own"),
)
DATES = ("P585", "P580", "P571", "P575", "P569", "P570")
ITEMS = ("P17", "P19", "P20", "P495")
_SNAK = "array<struct<mainsnak:struct<datavalue:struct<value:struct<{}>>>>>"
_CLAIMS = ",".join(
    [f"{p}:{_SNAK.format('id:string')}" for p in ("P31", "P279", *ITEMS)] + [f"{p}:{_SNAK.format('time:string,precision:int')}" for p in DATES]
    + [f"P625:{_SNAK.format('latitude:double,longitude:double')}"]
)
ENTITY = f"id string, type string, labels struct<en:struct<value:string>>, descriptions struct<en:struct<value:string>>, sitelinks map<string,struct<title:string>>, claims struct<{_CLAIMS}>"


def entities(lines: DataFrame, partitions: int | None = None) -> DataFrame:
    """Items of a table of text lines ('value'); lines that are no JSON entity are skipped.

    A gzip file is one task: its lines are spread (partitions) before the costly parsing.
    """
    if partitions:
        lines = lines.repartition(partitions)
    body = F.regexp_replace(F.trim("value"), r",$", "")
    # a filter above from_json would be pushed below it, with a parse of its own for each field that it names
    wanted = F.filter(F.array(F.from_json(body, ENTITY)), lambda x: (x["type"] == "item") & x["id"].startswith("Q"))
    e = lines.where(F.ltrim("value").startswith("{")).select(F.inline(wanted))
    value = lambda p: F.get(F.col(f"claims.{p}"), 0)["mainsnak"]["datavalue"]["value"]
    every = lambda p: F.filter(F.transform(F.col(f"claims.{p}"), lambda c: c["mainsnak"]["datavalue"]["value"]["id"]), lambda x: x.isNotNull())
    place = value("P625")
    return e.select(
        F.col("id").alias("qid"), F.col("labels.en.value").alias("title"), F.col("descriptions.en.value").alias("blurb"), F.col("sitelinks.enwiki.title").alias("page"),
        F.coalesce(F.size(F.map_keys("sitelinks")), F.lit(0)).alias("sitelinks"), every("P31").alias("types"), every("P279").alias("parents"),
        F.when(place["latitude"].isNotNull() & place["longitude"].isNotNull(), F.struct(place["latitude"].alias("lat"), place["longitude"].alias("lng"))).alias("own"),
        *[value(p)["id"].alias(p) for p in ITEMS], *[value(p).alias(p) for p in DATES],
    )


def read_dump(spark: SparkSession, path: str, partitions: int | None = None, limit: int | None = None) -> DataFrame:
    """limit: lines of the file, for a trial run."""
    lines = spark.read.text(path)
    return entities(lines.limit(limit) if limit else lines, partitions)


def coords(e: DataFrame) -> DataFrame:
    first = e.where("own is not null").groupBy("qid").agg(F.min("own").alias("own"))
    return first.select("qid", "own.lat", "own.lng")


def subclass_edges(e: DataFrame) -> DataFrame:
    return e.select(F.col("qid").alias("child"), F.explode("parents").alias("parent"))


def roots(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(q, c, i) for i, (c, qs, *_) in enumerate(CATEGORIES) for q in qs], "node string, category string, priority int")


def _when(props: tuple[str, ...]) -> Column:
    """The first property with a well-formed date; one before the common era ends the search."""
    return F.coalesce(*[F.when(t["date"].isNotNull(), t) for t in (wikidata_time(F.col(p)["time"], F.col(p)["precision"]) for p in props)])


def _at(df: DataFrame, c: DataFrame, item: str, name: str) -> DataFrame:
    at = c.select(F.col("qid").alias(item), F.struct("lat", "lng").alias(name))
    return df.join(at, item, "left")


def category_of_types(typed: DataFrame, closure: DataFrame) -> DataFrame:
    """qid, category: the first of an entity's types, in its own order, that has a category."""
    t = typed.select("qid", F.posexplode("types").alias("pos", "node")).join(closure, "node")
    return t.groupBy("qid").agg(F.min_by("category", "pos").alias("category"))


def events(e: DataFrame, closure: DataFrame, lo: int, hi: int, version: str = "dump-v1") -> DataFrame:
    """Births, deaths and typed events with a title, a date in lo..hi, a place, and enough sitelinks."""
    c = coords(e)
    named = e.where((F.size("types") > 0) & (F.coalesce("title", F.lit("")) != ""))
    human = F.array_contains("types", HUMAN)
    people = named.where(human & (F.col("sitelinks") >= HUMAN_FLOOR))
    parts = []
    for category, prop, item in (("birth", "P569", "P19"), ("death", "P570", "P20")):
        p = people.withColumn("t", wikidata_time(F.col(prop)["time"], F.col(prop)["precision"]))
        parts.append(_at(p.where("t.date is not null").drop("own"), c, item, "at").where("at is not null").select(F.concat("qid", F.lit(f"#{category}")).alias("id"), "qid", "title", "blurb", "page", "sitelinks", F.lit(category).alias("category"), "t", "at"))
    things = named.where(~human)
    things = things.join(category_of_types(things, closure), "qid")
    things = _at(_at(things, c, "P17", "country"), c, "P495", "origin")
    state = F.coalesce("country", "origin")
    ok, when, at = F.lit(False), None, None
    for category, _, props, floor, mode in CATEGORIES:
        here = F.col("category") == category
        ok = ok | (here & (F.col("sitelinks") >= floor))
        place = {"own": F.col("own"), "own_country": F.coalesce(F.col("own"), state), "country_own": F.coalesce(state, F.col("own"))}[mode]
        when = (F if when is None else when).when(here, _when(props))
        at = (F if at is None else at).when(here, place)
    things = things.where(ok).withColumns({"t": when, "at": at}).where("at is not null and t.date is not null")
    parts.append(things.select(F.col("qid").alias("id"), "qid", "title", "blurb", "page", "sitelinks", "category", "t", "at"))
    rows = parts[0].unionByName(parts[1]).unionByName(parts[2])
    year = F.regexp_extract("t.date", "^([0-9]+)-", 1).try_cast("int")
    rows = rows.where(year.between(lo, hi))
    out = rows.select(
        "id", "title", "blurb", F.col("t.date").alias("date_start"), F.col("t.precision").alias("date_precision"), "at.lat", "at.lng", "category", notability_of(F.col("sitelinks")).alias("notability"),
        source_url(F.col("page"), F.col("qid")).alias("source_url"), F.to_json(F.struct(F.col("qid").alias("wikidata"))).alias("source_ids"), F.lit(version).alias("ingest_version"),
    )
    first = Window.partitionBy("id").orderBy("title", "date_start")
    return out.withColumn("_n", F.row_number().over(first)).where("_n = 1").drop("_n")
