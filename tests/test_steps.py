"""Steps that few tasks did, or did several times for each row."""

from pyspark.sql import functions as F

from chronogeo.operators import search
from chronogeo.operators.timeline import segment_errors
from chronogeo.sources import dump


def test_segments_are_spread(spark):
    s = spark.createDataFrame([(f"p{k}", 0, 1.0, 1.0, "nonsense" if k % 2 else "1900", "1901") for k in range(400)], "person string, segment_index int, seg_lat double, seg_lng double, seg_start string, seg_end string").coalesce(1)
    out = segment_errors(s).withColumn("task", F.spark_partition_id()).collect()
    assert len(out) == 200 and len({r.task for r in out}) == 4


def test_lines_are_parsed_once(spark):
    lines = spark.createDataFrame([('{"id": "Q1", "type": "item"},',), ('{"id": "P1", "type": "property"}',), ("{broken",), ('  {"id": "Q2", "type": "item"}',), (None,)], "value string")
    e = dump.entities(lines)
    assert sorted(r.qid for r in e.collect()) == ["Q1", "Q2"]
    assert e._jdf.queryExecution().optimizedPlan().toString().count("from_json") == 1


def test_a_common_token_is_many_tasks(spark, monkeypatch):
    t = spark.range(6000).select(F.concat(F.lit("e"), "id").alias("id"), F.lit("place").alias("title"), F.lit(None).cast("string").alias("blurb"))
    monkeypatch.setattr(search, "FILE_ROWS", 500)
    index = search.in_ranges(search.index_of(t, "id", ("title", "blurb")))
    sizes = [r["count"] for r in index.groupBy(F.spark_partition_id()).count().collect()]
    assert len(sizes) >= 8 and max(sizes) < 2000 and sum(sizes) == 6000
    assert search.found(index, "place").count() == 6000
