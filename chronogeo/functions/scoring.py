"""Build-time scores: significance within a decade, scope, reach and its bounding box."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..model import PERSON
from .classify import is_institution
from .columns import decade_of, half_up, let, pick

#: notability from which a category's row is global, national, regional; None: never; the last is what is left
LADDER = {
    "conflict": (0.6, 0.3, 0.15, "local"),
    "discovery": (0.4, 0.2, 0.1, "local"),
    "election": (None, 0.5, None, "regional"),
    "event": (0.6, 0.35, 0.2, "local"),
    "founding": (None, 0.75, 0.4, "local"),
    "milestone": (0.75, 0.45, 0.25, "local"),
    "treaty": (0.6, 0.3, None, "regional"),
    "birth": (None, None, None, "local"),
    "death": (None, None, None, "local"),
}
OTHER = (None, 0.6, None, "local")
BASE_KM = {"local": 50.0, "regional": 300.0, "national": 1500.0, "global": 20038.0}


def is_person(category: Column) -> Column:
    return F.coalesce(category.isin(*PERSON), F.lit(False))


def is_seed(version: Column) -> Column:
    return F.coalesce(version.startswith("seed-"), F.lit(False))


def _rungs(category: Column) -> Column:
    """The category's rungs, looked up: a branch for each would make the generated method too long for Java to compile."""
    known = F.create_map(*[x for name, r in LADDER.items() for x in (F.lit(name), _numbers(r))])
    return F.coalesce(F.try_element_at(known, category), _numbers(OTHER))


def _numbers(rungs: tuple) -> Column:
    return F.array(*[F.lit(x).cast("double") for x in rungs[:3]])


def scope_ladder(category: Column, notability: Column, kind: Column, blurb: Column) -> Column:
    n = F.coalesce(notability, F.lit(0.0))
    institution = F.when(n >= 0.5, "regional").otherwise("local")
    out = F.when(~is_person(category) & is_institution(blurb), institution)
    f = category == "founding"
    out = out.when(f & (kind == "institution"), institution).when(f & (kind == "settlement"), "local").when(f & (kind == "subnational"), "national")
    out = out.when(f & (kind == "country"), F.when(n >= 0.6, "global").otherwise("national"))
    for i, scope in enumerate(("global", "national", "regional")):
        out = out.when(n >= F.get(_rungs(category), F.lit(i)), scope)
    low = [name for name, r in LADDER.items() if r[3] == "regional"]
    return out.when(category.isin(*low), "regional").otherwise("local")


def decade_percentile(events: DataFrame) -> DataFrame:
    """events with significance: the share of rows of the same kind and decade that are at most as notable, to 3 places.

    Persons (births, deaths) are ranked among themselves. A null notability is 0; a row alone in its decade gets 0.5.

    A window over a whole decade would put it into one task, and decades are few. So distinct notabilities are counted
    first (they have 3 places, so a decade has about a thousand), ranks are cumulated over these counts, and joined back.
    """
    keyed = events.withColumns({"_person": is_person(F.col("category")), "_decade": decade_of(F.col("date_start")), "_n": F.coalesce("notability", F.lit(0.0))})
    keys = ["_person", "_decade", "_n"]
    counts = keyed.groupBy(*keys).agg(F.count("*").alias("_c"))
    pop = Window.partitionBy("_person", "_decade")
    counts = counts.withColumns({"_upto": F.sum("_c").over(pop.orderBy("_n").rangeBetween(Window.unboundedPreceding, 0)), "_all": F.sum("_c").over(pop)})
    share = F.when(F.col("_all") <= 1, 0.5).otherwise(half_up(F.col("_upto") / F.col("_all"), 3))
    ranked = counts.select(*keys, share.alias("significance"))
    return keyed.drop("significance").join(ranked, keys).drop(*keys)


def with_scope(events: DataFrame) -> DataFrame:
    """Scope by the ladder; curated rows keep the one that their author gave."""
    authored = is_seed(F.col("ingest_version")) & F.coalesce(F.col("scope") != "", F.lit(False))
    # by let, apart from the method that is generated for all columns: with the ladder that would be too long for Java to compile
    read = F.struct("category", "notability", "founding_kind", "blurb", F.when(authored, F.col("scope")).alias("own"))
    ladder = let(read, lambda v: F.coalesce(v["own"], scope_ladder(v["category"], v["notability"], v["founding_kind"], v["blurb"])))
    return events.withColumn("scope", ladder)


def reach_km(scope: Column, significance: Column) -> Column:
    sig = F.coalesce(significance, F.lit(0.0))
    base = F.coalesce(pick(BASE_KM, scope), F.lit(BASE_KM["local"]))
    wide = F.coalesce(scope.isin("regional", "national"), F.lit(False))
    factor = F.when(wide, F.lit(0.7) + F.lit(0.6) * sig).otherwise(F.lit(1.0) + F.lit(0.2) * sig)
    return F.when(scope == "global", F.lit(BASE_KM["global"])).otherwise(F.floor(base * factor + 0.5).cast("double"))


def with_reach(events: DataFrame) -> DataFrame:
    """reach_km and its box; rows without a place get nulls. The box isn't wrapped at the antimeridian."""
    placed = F.col("lat").isNotNull() & F.col("lng").isNotNull()
    world = F.col("scope") == "global"
    dlat = F.col("reach_km") / 111.0
    dlng = F.col("reach_km") / (F.lit(111.0) * F.greatest(F.lit(0.2), F.cos(F.col("lat") * 3.141592653589793 / 180.0)))
    all_round = F.coalesce(world, F.lit(False)) | (dlng >= 180)
    out = events.withColumn("reach_km", F.when(placed, reach_km(F.col("scope"), F.col("significance"))))
    return out.withColumns({
        "reach_min_lat": F.when(placed, F.when(world, -90.0).otherwise(F.greatest(F.lit(-90.0), F.col("lat") - dlat))),
        "reach_max_lat": F.when(placed, F.when(world, 90.0).otherwise(F.least(F.lit(90.0), F.col("lat") + dlat))),
        "reach_min_lng": F.when(placed, F.when(all_round, -180.0).otherwise(F.col("lng") - dlng)),
        "reach_max_lng": F.when(placed, F.when(all_round, 180.0).otherwise(F.col("lng") + dlng)),
    })


def scored(events: DataFrame) -> DataFrame:
    # the ladder comes before the join that ranks, so that its patterns are not spelled out again in all that reads scope
    return events.transform(with_scope).transform(decade_percentile).transform(with_reach)
