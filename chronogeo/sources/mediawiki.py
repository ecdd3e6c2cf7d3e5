"""Readers of a wiki's web interface: page texts, the entities of titles, and what is known of entities.

A request takes up to BATCH names.  `asked` sends them, batch by batch, from the tasks that hold them; what comes back is one
JSON body a batch, and is parsed inside the JVM, so bodies that are there already (files) take the same way.
"""

from __future__ import annotations

import json
import time
import urllib.error
import urllib.parse
import urllib.request
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BATCH = 50
#: what is asked for, by reader: the parameter that takes the names, and the fixed ones
PAGES = ("titles", {"rvslots": "main", "rvprop": "content", "prop": "revisions", "action": "query"})
ITEMS = ("titles", {"ppprop": "wikibase_item", "prop": "pageprops", "action": "query"})
ENTITIES = ("ids", {"action": "wbgetentities", "props": "claims|sitelinks"})

_VALUE = "array<struct<mainsnak:struct<datavalue:struct<value:struct<{}>>>>>"
_PAGE = "struct<title:string,missing:string,revisions:array<struct<slots:struct<main:struct<`*`:string>>>>,pageprops:struct<wikibase_item:string>>"
_QUERY = f"struct<query:struct<pages:map<string,{_PAGE}>>>"
_CLAIMS = f"struct<P625:{_VALUE.format('latitude:double,longitude:double')},P31:{_VALUE.format('id:string')},P17:{_VALUE.format('id:string')}>"
_ENTITY = f"struct<entities:map<string,struct<sitelinks:map<string,string>,claims:{_CLAIMS}>>>"


def http_get(url: str, agent: str = "chronogeo", tries: int = 4, wait: float = 3.0) -> Callable[[dict], str]:
    """A fetch for `asked`: parameters to a body."""

    def fetch(params: dict) -> str:
        for k in range(1, tries + 1):
            try:
                req = urllib.request.Request(url + "?" + urllib.parse.urlencode({**params, "format": "json"}), headers={"User-Agent": agent})
                with urllib.request.urlopen(req, timeout=60) as r:
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


def asked(names: DataFrame, request: tuple[str, dict], fetch: Callable[[dict], str]) -> DataFrame:
    """(body) for each BATCH of a one-column table of names; nulls and repeats are not asked for."""
    by, fixed = request
    column = names.columns[0]

    def run(batches):
        held: list[str] = []
        for b in batches:
            held += b.column(0).to_pylist()
            while len(held) >= BATCH:
                yield pa.record_batch({"body": pa.array([fetch({**fixed, by: "|".join(held[:BATCH])})])})
                held = held[BATCH:]
        if held:
            yield pa.record_batch({"body": pa.array([fetch({**fixed, by: "|".join(held)})])})

    return names.where(F.col(column).isNotNull()).select(F.col(column).cast("string")).distinct().mapInArrow(run, "body string")


def _pages(bodies: DataFrame) -> DataFrame:
    return bodies.select(F.explode(F.map_values(F.from_json("body", _QUERY)["query"]["pages"])).alias("p"))


def wikitexts(bodies: DataFrame) -> DataFrame:
    """(page, wikitext) of the pages that exist and have a text."""
    text = F.get(F.col("p.revisions"), 0)["slots"]["main"]["*"]
    return _pages(bodies).where("p.missing is null").select(F.col("p.title").alias("page"), text.alias("wikitext")).where("wikitext <> ''")


def items(bodies: DataFrame) -> DataFrame:
    """(title, qid) of the titles that have an entity."""
    return _pages(bodies).select(F.col("p.title").alias("title"), F.col("p.pageprops.wikibase_item").alias("qid")).where("qid <> ''")


def entities(bodies: DataFrame) -> DataFrame:
    """(qid, sitelinks, lat, lng, types, country) of entities, as the wikitext reader takes them."""
    e = bodies.select(F.explode(F.from_json("body", _ENTITY)["entities"]).alias("qid", "e"))
    value = lambda c: F.get(c, 0)["mainsnak"]["datavalue"]["value"]
    at = value(F.col("e.claims.P625"))
    ids: Column = F.filter(F.transform(F.coalesce("e.claims.P31", F.array().cast(_VALUE.format("id:string"))), lambda c: c["mainsnak"]["datavalue"]["value"]["id"]), lambda x: x != "")
    placed = at["latitude"].isNotNull()
    return e.select(
        "qid", F.coalesce(F.size(F.map_keys("e.sitelinks")), F.lit(0)).alias("sitelinks"), F.when(placed, at["latitude"]).alias("lat"), F.when(placed, at["longitude"]).alias("lng"),
        ids.alias("types"), value(F.col("e.claims.P17"))["id"].alias("country"),
    )


def as_pages(pages: list[dict]) -> str:
    """A body of pages as the interface would send it."""
    return json.dumps({"query": {"pages": {str(k): p for k, p in enumerate(pages)}}})
