"""Curation passes: series, floors, verdicts on duplicates, phrased titles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.classify import display_rule, display_title
from ..functions.columns import half_up
from ..model import with_missing_columns
from .store import delete_ids, patch, seeded

#: detection is blind to what a series is; these are kept by default
KEEP = ("FIFA World Cup", "Summer Olympics", "United States presidential election", "Winter Olympics")
FLOORS = (0.15, 0.2, 0.25, 0.3, 0.35, 0.4)


def year_titled() -> Column:
    return F.col("title").rlike("^[12][0-9]{3} ")


def series_of() -> Column:
    return F.substring("title", 6, 1 << 20)


def series(events: DataFrame, least: int = 5) -> DataFrame:
    """Titles that differ by a leading year only, with at least `least` (2 or more) editions."""
    events = with_missing_columns(events)
    seed = F.when(F.coalesce(seeded(), F.lit(False)), 1).otherwise(0)
    year = F.substring("date_start", 1, 4)
    g = events.where(year_titled()).groupBy(series_of().alias("series")).agg(
        F.count("*").alias("n"), F.min(year).alias("first_yr"), F.max(year).alias("last_yr"), half_up(F.avg("notability"), 3).alias("avg_notability"),
        half_up(F.avg("significance"), 3).alias("avg_sig"), F.min("category").alias("category"), F.sum(seed).alias("seeded"),
    )
    return g.where(F.col("n") >= max(2, least)).orderBy(F.desc("n"), F.asc("series"))


def kept(name: Column, extra: str = "") -> Column:
    """extra: further names, split at '|'."""
    return F.lower(name).isin(*[x.strip().lower() for x in (*KEEP, *extra.split("|")) if x.strip()])


def without_series(events: DataFrame, least: int = 5, keep: str = "") -> DataFrame:
    """events without the editions of series that are not kept; curated rows, and rows of no version, stay."""
    doomed = series(events, least).where(~kept(F.col("series"), keep)).select(F.col("series").alias("_series"))
    marked = events.withColumn("_s", F.when(year_titled() & ~F.coalesce(seeded(), F.lit(True)), series_of()))
    return marked.join(doomed, F.col("_s") == F.col("_series"), "left_anti").drop("_s")


def doomed(events: DataFrame, least: int = 5, keep: str = "") -> DataFrame:
    """One row: series and rows that would go, and the rows' percentage of the table."""
    s = series(events, least).where(~kept(F.col("series"), keep)).agg(F.count("*").alias("n_series"), F.coalesce(F.sum(F.col("n") - F.col("seeded")), F.lit(0)).alias("n_rows"))
    return s.crossJoin(events.agg(F.count("*").alias("total"))).select("n_series", "n_rows", half_up(F.col("n_rows") * 100.0 / F.col("total"), 2).alias("percent"))


def series_sample(events: DataFrame, least: int = 5, top: int = 15) -> DataFrame:
    """The most significant rows of all detected series, as a check on what pruning would take."""
    s = series(events, least).select(F.col("series").alias("_series"))
    rows = events.where(year_titled() & ~seeded()).join(s, series_of() == F.col("_series"), "left_semi")
    return rows.select("id", "title", F.substring("date_start", 1, 4).alias("yr"), "significance").orderBy(F.desc_nulls_last("significance"), "id").limit(top)


def histogram(events: DataFrame, category: str) -> DataFrame:
    bucket = F.floor(F.least(F.lit(0.99), F.greatest(F.lit(0.0), F.col("notability"))) * 10.0) / F.lit(10.0)
    return events.where((F.col("category") == category) & F.col("notability").isNotNull()).groupBy(bucket.alias("bucket")).agg(F.count("*").alias("c"))


def candidate_floors(events: DataFrame, category: str) -> DataFrame:
    """For each floor how many rows it removes and keeps, in one pass over the table."""
    below = [F.coalesce(F.count_if(F.col("notability") < f), F.lit(0)).alias(f"b{i}") for i, f in enumerate(FLOORS)]
    one = events.where(F.col("category") == category).agg(F.count("*").alias("total"), *below)
    rows = F.array(*[F.struct(F.lit(f).alias("floor"), F.col(f"b{i}").alias("removed"), (F.col("total") - F.col(f"b{i}")).alias("kept")) for i, f in enumerate(FLOORS)])
    return one.select(F.explode(rows).alias("r")).select("r.*")


def least_notable(events: DataFrame, category: str, floor: float, top: int = 25) -> DataFrame:
    rows = events.where((F.col("category") == category) & (F.col("notability") < floor))
    return rows.select("id", "title", "date_start", "notability").orderBy("notability", "date_start", "id").limit(top)


def contradictions(drops: DataFrame, merges: DataFrame) -> DataFrame:
    """Ids that both lists name: there must be none."""
    return drops.select("seed_id").where("seed_id <> ''").intersect(merges.select("seed_id").where("seed_id <> ''"))


def merge_status(events: DataFrame, merges: DataFrame) -> DataFrame:
    """dump_id, seed_date, status of each verdict: missing, exact or patched."""
    m = merges.where("dump_id <> '' and seed_date <> ''").select("dump_id", "seed_date")
    e = events.select(F.col("id").alias("dump_id"), F.col("date_start").alias("_old"), F.lit(True).alias("_here"))
    status = F.when(F.col("_here").isNull(), "missing").when(F.col("_old") == F.col("seed_date"), "exact").otherwise("patched")
    return m.join(e, "dump_id", "left").select("dump_id", "seed_date", status.alias("status"))


def dupes_applied(events: DataFrame, drops: DataFrame, merges: DataFrame) -> DataFrame:
    """events with merged dates (to the day) and without the curated rows that either list names.

    Of several dates for one row the greatest wins.
    """
    dates = merge_status(events, merges).where("status = 'patched'").groupBy(F.col("dump_id").alias("id")).agg(F.max("seed_date").alias("date_start"))
    ids = drops.select(F.col("seed_id").alias("id")).union(merges.select(F.col("seed_id").alias("id"))).where("id <> ''").distinct()
    return delete_ids(patch(events, dates.withColumn("date_precision", F.lit("day")), ["date_start", "date_precision"]), ids)


def titled(events: DataFrame) -> DataFrame:
    """The foundings and discoveries that are not curated, with rule and phrased title (null where they keep their own)."""
    rows = events.where(F.col("category").isin("founding", "discovery") & ~seeded())
    rule = display_rule(F.col("title"), F.col("blurb"), F.col("category"), F.col("founding_kind"))
    return rows.withColumn("rule", rule).withColumn("display_title", display_title(F.col("title"), F.col("rule")))


def rule_counts(events: DataFrame) -> DataFrame:
    return titled(events).groupBy(F.coalesce("rule", F.lit("(skipped)")).alias("rule")).agg(F.count("*").alias("n"))


def rule_samples(events: DataFrame, each: int = 4, most: int = 20) -> DataFrame:
    """Up to `each` rows a rule and `most` in all, in the order of their ids."""
    t = titled(events).where("rule is not null").withColumn("_n", F.row_number().over(Window.partitionBy("rule").orderBy("id")))
    return t.where(F.col("_n") <= each).select("id", "rule", F.col("title").alias("before"), F.col("display_title").alias("after")).orderBy("id").limit(most)


def verdict_counts(drops: DataFrame, merges: DataFrame, key: str = "seed_id") -> DataFrame:
    """verdict, pairs (rows of the list), rows (curated rows that it removes), and both lists' rows together."""
    kinds = drops.select(F.lit("drop").alias("verdict"), key).union(merges.select(F.lit("merge"), key))
    each = kinds.groupBy("verdict").agg(F.count("*").alias("pairs"), F.count_distinct(key).alias("rows"))
    return each.union(kinds.agg(F.lit("all"), F.count("*"), F.count_distinct(key)))
