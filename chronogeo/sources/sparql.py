"""Harvesting of an endpoint's query results: one query a year and category.

The reader is a Python data source, with a partition for each query; `fetch` may be replaced by anything that returns the
result's JSON, such as files (see rows_of, which parses results that are there already).
"""

from __future__ import annotations

import json
import time
import urllib.error
import urllib.parse
import urllib.request
from collections.abc import Callable, Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from ..functions.columns import notability_of, qid_of, wkt_point

RESULT = "struct<results:struct<bindings:array<map<string,struct<value:string>>>>>"
VARS = ("item", "itemLabel", "itemDescription", "date", "coords", "sitelinks", "article")


@dataclass(frozen=True)
class Harvester:
    category: str
    roots: tuple[str, ...]
    dates: tuple[str, ...]
    least: int
    cap: int
    place: str = ""  # property of the place that has the coordinates, or the item itself
    suffix: str = ""


#: in the order in which they claim an id: the most general one last
HARVESTERS = (
    Harvester("conflict", ("Q180684",), ("P585", "P580"), 5, 250),
    Harvester("election", ("Q40231",), ("P585",), 3, 150),
    Harvester("founding", ("Q10864048", "Q3624078", "Q3957", "Q515", "Q532", "Q6256"), ("P571",), 5, 250),
    Harvester("discovery", ("Q11019", "Q12772819"), ("P575", "P571"), 3, 150),
    Harvester("birth", ("Q5",), ("P569",), 25, 300, "P19", "#birth"),
    Harvester("death", ("Q5",), ("P570",), 25, 300, "P20", "#death"),
    Harvester("event", ("Q1190554",), ("P585",), 8, 400),
)


def query_of(h: Harvester, year: int) -> str:
    """Years are half-open: from its first instant to before the next year's."""
    dates = "|".join(f"wdt:{p}" for p in h.dates)
    path = "wdt:P31" if h.suffix else "wdt:P31/wdt:P279*"
    where = f"?item wdt:{h.place} ?place . ?place wdt:P625 ?coords ." if h.place else "?item wdt:P625 ?coords ."
    lines = [
        "SELECT " + " ".join(f"?{v}" for v in VARS) + " WHERE {",
        "VALUES ?kind { " + " ".join(f"wd:{r}" for r in h.roots) + " }",
        f"?item {path} ?kind ; wikibase:sitelinks ?sitelinks ; ({dates}) ?date .",
        where,
        f'FILTER(?sitelinks >= {h.least} && ?date >= "{year}-01-01T00:00:00Z"^^xsd:dateTime && ?date < "{year + 1}-01-01T00:00:00Z"^^xsd:dateTime)',
        "OPTIONAL { ?article schema:isPartOf <https://en.wikipedia.org/> ; schema:about ?item . }",
        'SERVICE wikibase:label { bd:serviceParam wikibase:language "en" . } }',
        f"ORDER BY DESC(?sitelinks) LIMIT {h.cap}",
    ]
    return "\n".join(lines)


def http_fetch(endpoint: str, agent: str, tries: int = 4, wait: float = 3.0) -> Callable[[str], str]:
    def fetch(query: str) -> str:
        for k in range(1, tries + 1):
            try:
                req = urllib.request.Request(endpoint, urllib.parse.urlencode({"query": query}).encode(), {"Accept": "application/sparql-results+json", "User-Agent": agent})
                with urllib.request.urlopen(req, timeout=120) as r:
                    return r.read().decode()
            except urllib.error.HTTPError as e:
                if e.code not in (429, 502, 503, 504) or k == tries:
                    raise
            except OSError:
                if k == tries:
                    raise
            time.sleep(wait * k)
        raise AssertionError

    return fetch


class _Query(InputPartition):
    def __init__(self, year: int, order: int):
        self.year, self.order = year, order


class SparqlReader(DataSourceReader):
    def __init__(self, options: dict):
        self.lo, self.hi = int(options["from"]), int(options["to"])
        names = options.get("categories", "")
        self.chosen = [i for i, h in enumerate(HARVESTERS) if not names or h.category in names.split(",")]
        self.endpoint, self.agent = options["endpoint"], options.get("agent", "chronogeo")
        self.delay, self.wait, self.strict = float(options.get("delay", 0.25)), float(options.get("wait", 3)), options.get("strict", "false").lower() == "true"

    def partitions(self) -> list[InputPartition]:
        return [_Query(y, i) for y in range(self.hi, self.lo - 1, -1) for i in self.chosen]

    def read(self, part: _Query) -> Iterator[tuple]:
        h = HARVESTERS[part.order]
        time.sleep(self.delay)  # before each query, to spare the endpoint
        try:
            body, error = http_fetch(self.endpoint, self.agent, wait=self.wait)(query_of(h, part.year)), None
        except OSError as e:  # after all tries; one year of one category is missing then, and the others go on
            if self.strict:
                raise
            body, error = None, str(e)
        yield (h.category, part.order, part.year, body, error)


class SparqlSource(DataSource):
    """spark.dataSource.register(SparqlSource); spark.read.format('sparql').options(endpoint=..., **{'from': 1900, 'to': 1950}).load()

    Further options: categories, agent, delay and wait (seconds before a query, and, times the try, before another one), and
    strict: whether a query that fails ends the job; else its row has an error in place of a body.
    """

    @classmethod
    def name(cls) -> str:
        return "sparql"

    def schema(self) -> str:
        return "category string, priority int, year int, body string, error string"

    def reader(self, schema) -> DataSourceReader:
        return SparqlReader(dict(self.options))


def rows_of(results: DataFrame, version: str = "live-v1") -> DataFrame:
    """Events of results (category, priority, year, body); bindings without item, date or point are left out.

    The first harvester in order that returns an id has it; each (category, year) gives at most its cap, most linked first.
    """
    cap = F.coalesce(*[F.when(F.col("category") == h.category, F.lit(h.cap)) for h in HARVESTERS], F.lit(1 << 30))
    suffix = F.coalesce(*[F.when(F.col("category") == h.category, F.lit(h.suffix)) for h in HARVESTERS], F.lit(""))
    b = results.select("category", "priority", "year", F.posexplode(F.from_json("body", RESULT)["results"]["bindings"]).alias("pos", "b"))
    b = b.select("category", "priority", "year", "pos", *[F.col("b")[v]["value"].alias(v) for v in VARS])
    b = b.withColumn("p", wkt_point(F.col("coords"))).where("item <> '' and date <> '' and p.lat is not null and p.lng is not null")
    links = F.coalesce(F.regexp_extract("sitelinks", r"^\s*([0-9]+)", 1).try_cast("int"), F.lit(0))
    b = b.withColumns({"links": links, "qid": qid_of(F.col("item"))}).withColumn("id", F.concat("qid", suffix))
    per = Window.partitionBy("category", "year").orderBy(F.desc("links"), "pos")
    b = b.withColumn("_n", F.row_number().over(per)).where(F.col("_n") <= cap)
    b = b.withColumn("_n", F.row_number().over(Window.partitionBy("id").orderBy(F.desc("year"), "priority", "pos"))).where("_n = 1")
    return b.select(
        "id", F.coalesce("itemLabel", "qid").alias("title"), F.when(F.col("itemDescription") != "", F.substring("itemDescription", 1, 280)).alias("blurb"), F.substring("date", 1, 10).alias("date_start"),
        F.lit(None).cast("string").alias("date_precision"), "p.lat", "p.lng", "category", notability_of(F.col("links")).alias("notability"), F.coalesce("article", "item").alias("source_url"),
        F.to_json(F.struct(F.col("qid").alias("wikidata"))).alias("source_ids"), F.lit(version).alias("ingest_version"),
    )


def as_json(bindings: list[dict[str, str]]) -> str:
    """A result as the endpoint would send it."""
    return json.dumps({"results": {"bindings": [{k: {"value": v} for k, v in b.items()} for b in bindings]}})
