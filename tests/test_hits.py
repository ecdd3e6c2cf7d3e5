"""Hits of a query are gathered by many tasks."""

from pyspark.sql import functions as F

from chronogeo.operators import search


def test_hits_are_parted_by_their_number(spark, monkeypatch):
    monkeypatch.setattr(search, "HITS", 500)
    t = spark.range(6000).select(F.concat(F.lit("e"), "id").alias("id"), F.lit("sovereign state").alias("title"), F.lit(None).cast("string").alias("blurb"), F.lit(1.0).alias("notability"), F.lit("1900").alias("date_start"))
    index = search.index_of(t, "id", ("title", "blurb"))
    # before, the exchange of hits was coalesced by its bytes, to one task
    tasks = [r["count"] for r in search.found(index, '"sovereign state"').groupBy(F.spark_partition_id()).count().collect()]
    assert sum(tasks) == 6000 and len(tasks) == 24 and max(tasks) < 500
    assert [r.id for r in search.search_by(index, t, '"sovereign state" NOT title:championship', 3).collect()] == ["e0", "e1", "e10"]
