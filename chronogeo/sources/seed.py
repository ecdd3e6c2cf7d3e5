"""Curated rows (JSON arrays) and verdict files (TSV)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import trimmed
from ..functions.text import slugify

RAW = (
    "`Title` string, `Blurb` string, `Date start` string, `Precision` string, `Category` string, `Place` string, `Lat` double, `Lng` double, "
    "`Notability` double, `Scope (intended)` string, `Source URL` string, `Ingest version` string, `Seed ID` string"
)


def read_raw(spark: SparkSession, paths: list[str]) -> DataFrame:
    file = F.regexp_extract(F.input_file_name(), r"([^/]+)\.json$", 1)
    return spark.read.json(paths, schema=RAW, multiLine=True).withColumn("file", file)


def seed_id(raw: DataFrame) -> DataFrame:
    own, title = trimmed(F.coalesce("Seed ID", F.lit(""))), trimmed(F.coalesce("Title", F.lit("")))
    return raw.withColumn("id", F.concat(F.lit("seed:"), slugify(F.when(own != "", own).otherwise(title))))


def seeds(raw: DataFrame, version: str = "seed-v1") -> DataFrame:
    """Raw rows in the stored layout; rows without a title are left out."""
    r = seed_id(raw.where(trimmed(F.coalesce("Title", F.lit(""))) != ""))
    ids = F.to_json(F.struct(F.col("file").alias("seed"), F.col("Place").alias("place")), {"ignoreNullFields": "false"})
    return r.select(
        "id", trimmed(F.col("Title")).alias("title"), F.col("Blurb").alias("blurb"), F.col("Date start").alias("date_start"), F.col("Precision").alias("date_precision"),
        F.col("Lat").alias("lat"), F.col("Lng").alias("lng"), F.col("Scope (intended)").alias("scope"), F.coalesce("Category", F.lit("milestone")).alias("category"),
        F.col("Notability").alias("notability"), F.col("Source URL").alias("source_url"), ids.alias("source_ids"), F.coalesce("Ingest version", F.lit(version)).alias("ingest_version"),
    )


def without_ids(raw: DataFrame, ids: DataFrame) -> DataFrame:
    """Raw rows whose id no verdict names; written back by json_files."""
    return seed_id(raw).join(ids.select("id").distinct(), "id", "left_anti").select(*raw.columns)


def json_files(raw: DataFrame) -> DataFrame:
    """(file, json): each curated file's rows as one JSON array, in the order of their ids. Curated files are small, as people edit them."""
    cols = [c for c in raw.columns if c != "file"]
    row = F.to_json(F.struct(*[F.col(f"`{c}`") for c in cols]), {"ignoreNullFields": "false"})
    one = seed_id(raw).select("file", F.struct("id", row.alias("row")).alias("r"))
    rows = F.transform(F.sort_array(F.collect_list("r")), lambda r: r["row"])
    return one.groupBy("file").agg(F.concat(F.lit("[\n  "), F.array_join(rows, ",\n  "), F.lit("\n]\n")).alias("json"))


def write_back(raw: DataFrame, folder: str) -> None:
    """json_files() as folder/file=<name>/part-*.txt; the files that were read stay as they are until the caller swaps them."""
    json_files(raw).repartition("file").write.mode("overwrite").partitionBy("file").option("lineSep", "\n").text(folder)


def read_tsv(spark: SparkSession, path: str, required: tuple[str, ...] = ("seed_id",)) -> DataFrame:
    """Columns by header, cells trimmed, absent cells empty; a byte order mark and CRLF are dropped."""
    raw = spark.read.csv(path, sep="\t", header=True, quote="", encoding="UTF-8")
    df = raw.toDF(*[c.lstrip("﻿").strip() for c in raw.columns])
    lacking = [c for c in required if c not in df.columns]
    if lacking:
        raise ValueError(f"{path} lacks {', '.join(lacking)}; it has {', '.join(df.columns)}")
    return df.select(*[F.trim(F.coalesce(c, F.lit(""))).alias(c) for c in df.columns])
