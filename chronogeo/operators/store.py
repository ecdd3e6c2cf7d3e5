"""Writes as set operations: a table's next version is a DataFrame, and the caller saves it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..model import EVENTS, with_missing_columns

SEED_COLUMNS = ("title", "blurb", "date_start", "date_precision", "lat", "lng", "scope", "category", "notability", "source_url", "source_ids", "ingest_version")


def one_per(df: DataFrame, key: str, order: list) -> DataFrame:
    return df.withColumn("_n", F.row_number().over(Window.partitionBy(key).orderBy(*order))).where("_n = 1").drop("_n")


def insert_ignore(old: DataFrame, new: DataFrame, order: list, key: str = "id") -> DataFrame:
    """old, and of new the first row, by order, of each key that old lacks. Null keys of new are left out."""
    add = one_per(new.where(F.col(key).isNotNull()), key, order).join(old.select(key).distinct(), key, "left_anti")
    return old.unionByName(with_missing_columns(add, old.schema).select(*old.columns))


def insert_replace(old: DataFrame, new: DataFrame, order: list, key: str = "id") -> DataFrame:
    """new's row that is first by order (latest first) replaces old's as a whole: columns that new lacks become null."""
    add = one_per(new.where(F.col(key).isNotNull()), key, order)
    kept = old.join(add.select(key), key, "left_anti")
    return kept.select(*old.columns).unionByName(with_missing_columns(add, old.schema).select(*old.columns))


def upsert(old: DataFrame, new: DataFrame, columns: tuple[str, ...] = SEED_COLUMNS, key: str = "id") -> DataFrame:
    """Rows of new are added, or overwrite the listed columns (with nulls, too); other columns keep their values."""
    cols = [c for c in columns if c in new.columns]
    n = new.select(F.col(key).alias("_key"), *[F.col(c).alias(f"_new_{c}") for c in cols])
    j = old.join(n, F.col(key) == F.col("_key"), "full_outer")
    hit = F.col("_key").isNotNull()
    value = lambda c: F.coalesce(F.col(key), F.col("_key")) if c == key else F.when(hit, F.col(f"_new_{c}")).otherwise(F.col(c)) if c in cols else F.col(c)
    return j.select(*[value(c).alias(c) for c in old.columns])


def duplicate_ids(new: DataFrame, title: str = "title", key: str = "id") -> DataFrame:
    """Keys that several rows claim, with the claimants' titles: a curated set must have none."""
    return new.groupBy(key).agg(F.count("*").alias("n"), F.sort_array(F.collect_list(title)).alias("claimants")).where("n > 1")


def require_empty(df: DataFrame, what: str) -> None:
    row = df.first()
    if row is not None:
        raise ValueError(f"{what}: {row.asDict()}")


def delete_where(df: DataFrame, cond: Column) -> DataFrame:
    """SQL's DELETE: a condition that is null deletes nothing."""
    return df.where(~F.coalesce(cond, F.lit(False)))


def below_floor(category: str, floor: float) -> Column:
    return (F.col("category") == category) & (F.col("notability") < floor)


def seeded() -> Column:
    """LIKE 'seed-%' as the store has it, in either case; null counts as no seed row where rows are to be deleted."""
    return F.lower("ingest_version").startswith("seed-")


def delete_ids(df: DataFrame, ids: DataFrame, key: str = "id") -> DataFrame:
    """Only curated rows can be deleted by id."""
    gone = df.where(seeded()).select(key).join(ids.select(key).distinct(), key, "left_semi")
    return df.join(gone, key, "left_anti").select(*df.columns)


def patch(df: DataFrame, changes: DataFrame, columns: list[str], key: str = "id") -> DataFrame:
    """UPDATE ... FROM: the listed columns of rows with a change (one change a key)."""
    c = changes.select(F.col(key).alias("_key"), *[F.col(x).alias(f"_new_{x}") for x in columns])
    j = df.join(c, F.col(key) == F.col("_key"), "left")
    hit = F.col("_key").isNotNull()
    return j.select(*[F.when(hit, F.col(f"_new_{x}")).otherwise(F.col(x)).alias(x) if x in columns else F.col(x) for x in df.columns])


def set_meta(meta: DataFrame, values: dict[str, str]) -> DataFrame:
    new = meta.sparkSession.createDataFrame(list(values.items()), "key string, value string")
    return upsert(meta, new, ("value",), "key")


def build_id(meta: DataFrame) -> DataFrame:
    """The name of an artefact by the layers that its meta table records; empty values count as absent."""
    keys = ("dataset_version", "scoring_version", "reach_version", "last_prune", "last_series_prune", "last_dupe_prune")
    m = meta.where(F.col("key").isin(*keys) & (F.col("value") != "")).agg(*[F.max(F.when(F.col("key") == k, F.col("value"))).alias(k) for k in keys])
    n = sum((F.col(k).isNotNull().cast("int") for k in keys[3:]), F.lit(0))
    prunes = F.when(n > 0, F.concat(F.lit("prune"), n.cast("string"))).otherwise("unpruned")
    return m.select(F.concat_ws("+", F.coalesce("dataset_version", F.lit("unknown-ingest")), F.coalesce("scoring_version", F.lit("unscored")), F.coalesce("reach_version", F.lit("no-reach")), prunes).alias("build_id"))


def reset(df: DataFrame, column: str, cond: Column | None = None) -> DataFrame:
    """A derived column set to null, for all rows or those that a condition holds for, before it is derived anew."""
    gone = F.lit(True) if cond is None else F.coalesce(cond, F.lit(False))
    return df.withColumn(column, F.when(~gone, F.col(column)))


def write_events(events: DataFrame, path: str, files: int | None = None) -> None:
    """The table of events as Parquet, in the stored layout, by ranges of dates and sorted, so that years are found by row groups."""
    e = with_missing_columns(events).select(*EVENTS.names)
    by = [files, "date_start"] if files else ["date_start"]
    e.repartitionByRange(*by).sortWithinPartitions("date_start", "id").write.mode("overwrite").parquet(path)


def read_events(spark: SparkSession, path: str) -> DataFrame:
    """The table of events in today's layout, whatever columns it was written with."""
    return with_missing_columns(spark.read.option("mergeSchema", "true").parquet(path)).select(*EVENTS.names)
