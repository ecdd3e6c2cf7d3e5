"""Counts that describe a table of events."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import half_up
from ..functions.scoring import is_person, is_seed
from ..functions.classify import is_institution
from ..model import ENGINE, EngineConfig
from .store import build_id

KINDS = ("settlement", "institution", "subnational", "country", "unclassified")


def by(events: DataFrame, column: str, absent: str = "(null)") -> DataFrame:
    return events.groupBy(F.coalesce(column, F.lit(absent)).alias(column)).agg(F.count("*").alias("c"))


def year_span(events: DataFrame) -> DataFrame:
    y = F.substring("date_start", 1, 4)
    return events.agg(F.min(y).alias("lo"), F.max(y).alias("hi"), F.count("*").alias("total"))


def modal_version(events: DataFrame) -> DataFrame:
    """The most frequent version; ties go to the least name."""
    return events.groupBy("ingest_version").agg(F.count("*").alias("c")).orderBy(F.desc("c"), F.asc("ingest_version")).limit(1)


def founding_tally(events: DataFrame) -> DataFrame:
    """Count and share of each kind of founding, with zeros."""
    f = events.where("category = 'founding'").groupBy(F.coalesce("founding_kind", F.lit("unclassified")).alias("kind")).agg(F.count("*").alias("c"))
    kinds = events.sparkSession.createDataFrame([(k,) for k in KINDS], "kind string")
    total = f.agg(F.sum("c").alias("t"))
    c = F.coalesce("c", F.lit(0))
    return kinds.join(f, "kind", "left").crossJoin(total).select("kind", c.alias("n"), half_up(c * 100.0 / F.col("t"), 1).alias("share"))


def score_report(events: DataFrame) -> DataFrame:
    """events before and after scoring share their rows; scope is the one after, old_scope the one before (if any)."""
    person, inst = is_person(F.col("category")), is_institution(F.col("blurb")) & ~is_seed(F.col("ingest_version")) & ~is_person(F.col("category"))
    old = F.col("old_scope") if "old_scope" in events.columns else F.lit(None).cast("string")
    kinds = (F.col("category") == "founding") & F.col("founding_kind").isin(*KINDS[:4])
    return events.agg(
        F.count_if(person).alias("persons"), F.count_if(~person).alias("history"), F.count_if(kinds).alias("by_kind"), F.count_if(inst).alias("institutions"),
        F.count_if(inst & old.isin("global", "national")).alias("demoted"),
    )


def top_titles(events: DataFrame, year: str, top: int = 10) -> DataFrame:
    rows = events.where(F.substring("date_start", 1, 4) == year)
    return rows.select("id", "title", "notability").orderBy(F.desc_nulls_last("notability"), "id").limit(top)


def precision_samples(events: DataFrame, precision: str = "year", top: int = 10) -> DataFrame:
    """The most notable of all events whose dates have this precision."""
    rows = events.where(F.col("date_precision") == precision)
    return rows.select("id", "title", "date_start", "date_precision", "notability").orderBy(F.desc_nulls_last("notability"), "id").limit(top)


def unclassified_foundings(events: DataFrame, top: int = 20) -> DataFrame:
    """The most notable foundings of no kind."""
    rows = events.where("category = 'founding' AND founding_kind IS NULL").orderBy(F.desc_nulls_last("notability"), "id").limit(top)
    return rows.select("id", "notability", F.substring("title", 1, 40).alias("title"), F.substring(F.coalesce("blurb", F.lit("(none)")), 1, 70).alias("blurb"))


def service_meta(events: DataFrame, meta: DataFrame, cfg: EngineConfig = EngineConfig(), limits: dict | None = None) -> DataFrame:
    """One row, `json`: the engine, what the table records of its layers, the defaults and the limits of requests."""
    layers = {"ingest": "dataset_version", "scoring": "scoring_version", "reach": "reach_version"}
    prunes = ("last_prune", "last_series_prune", "last_dupe_prune")
    known = meta.where("value is not null").agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct("key", "value")))).alias("m"))
    said = lambda k: F.nullif(F.try_element_at("m", F.lit(k)), F.lit(""))
    total = events.agg(F.count("*").alias("total"))
    row = known.crossJoin(total).crossJoin(build_id(meta))  # one row each
    defaults = {k: getattr(cfg, k) for k in ("significance_floor", "max_per_segment", "max_segments", "person_quota")}
    tables = {k: getattr(cfg, k) for k in ("scope_floor", "scope_quota", "category_weights", "founding_kind_weights")}
    caps = {"max_body_bytes": 65536, "max_segments": 40, "search_limit": 100, "requests": 60, "window_seconds": 60, **(limits or {})}
    body = F.struct(
        F.lit(ENGINE).alias("engine"), said("dataset_version").alias("datasetVersion"), F.col("build_id").alias("datasetBuild"),
        F.struct(*[said(k).alias(n) for n, k in layers.items()], F.filter(F.array(*map(said, prunes)), lambda x: x.isNotNull()).alias("prunes")).alias("datasetLayers"),
        F.map_concat(F.create_map(F.lit("totalEvents"), F.col("total").cast("string")), "m").alias("dataset"),
        F.struct(*[F.lit(v).alias(k) for k, v in defaults.items()], *[F.struct(*[F.lit(x).alias(n) for n, x in sorted(t.items())]).alias(k) for k, t in tables.items()]).alias("defaults"),
        F.struct(*[F.lit(v).alias(k) for k, v in caps.items()]).alias("limits"),
    )
    return row.select(F.to_json(body, {"ignoreNullFields": "false"}).alias("json"))


def health(events: DataFrame) -> DataFrame:
    """ok and the number of events: whether there is a table to answer from."""
    return events.agg((F.count("*") > 0).alias("ok"), F.count("*").alias("events"))
