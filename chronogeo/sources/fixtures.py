"""The adapter that turns the star-schema tables into geo-located events and timeline requests (see FIXTURES.md)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.classify import founding_kind
from ..functions.scoring import scored
from ..model import with_missing_columns
from ..storage import stored

DEMO = (("Pueblo", 38.2544, -104.6091), ("Chicago", 41.8781, -87.6298))


def _case(key: str, values: list[str | None]) -> str:
    return f"CASE {key} " + " ".join(f"WHEN {i} THEN '{v}'" for i, v in enumerate(values) if v is not None) + " END"


def _d(x) -> str:
    return f"CAST({x} AS DOUBLE)"


_Y, _MM, _DD = "CAST(1700 + (k * 7919) % 321 AS STRING)", "lpad(CAST(1 + k % 12 AS STRING), 2, '0')", "lpad(CAST(1 + k % 28 AS STRING), 2, '0')"
BLURBS = [
    "city in Nevada, United States", "state of the United States", "university in Toronto, Ontario, Canada", "sovereign state in South America",
    "school shooting in Cook County", "province of Canada", "republic in Russia", "museum in Paris, France", "kingdom in Africa",
    "hospital fire in Ohio", "annual sporting event", None,
]
CATEGORIES = ["event", "conflict", "election", "treaty", "founding", "founding", "discovery", "birth", "death", "milestone"]


def _near(centre: float, f: int) -> str:
    return f"{_d(centre)} + {_d(f'(k * {f}) % 200 - 100')} / {_d(100)}"


#: column -> SQL that both Spark and the oracle read; k: order key, p: total price, m: market segment
ADAPTER = {
    "id": "concat(CASE WHEN k % 20 = 9 THEN 'seed:' ELSE 'Q' END, CAST(k AS STRING), CASE k % 10 WHEN 7 THEN '#birth' WHEN 8 THEN '#death' ELSE '' END)",
    "title": f"CASE WHEN k % 10 = 0 THEN concat({_Y}, ' ', m, ' Championship') ELSE concat('Place ', CAST(k % 500 AS STRING)) END",
    "blurb": _case("k % 12", BLURBS),
    "date_start": f"CASE k % 4 WHEN 0 THEN concat({_Y}, '-01-01') WHEN 1 THEN concat({_Y}, '-', {_MM}, '-01') ELSE concat({_Y}, '-', {_MM}, '-', {_DD}) END",
    "date_precision": _case("k % 4", ["year", "month", "day", "day"]),
    "lat": f"CASE k % 3 WHEN 0 THEN {_near(38.2544, 37)} WHEN 1 THEN {_near(41.8781, 41)} ELSE {_d('(k * 3571) % 18001')} / {_d(100)} - {_d(90)} END",
    "lng": f"CASE k % 3 WHEN 0 THEN {_near(-104.6091, 53)} WHEN 1 THEN {_near(-87.6298, 59)} ELSE {_d('(k * 7907) % 36001')} / {_d(100)} - {_d(180)} END",
    "category": _case("k % 10", CATEGORIES),
    "notability": f"CASE WHEN k % 97 <> 0 THEN floor((p / {_d(500000)}) * (p / {_d(500000)}) * {_d(1000)} + {_d(0.5)}) / {_d(1000)} END",
    "ingest_version": "CASE WHEN k % 20 = 9 THEN 'seed-v0' ELSE 'dump-v0' END",
    "scope": f"CASE WHEN k % 20 = 9 THEN {_case('k % 4', ['local', 'regional', 'national', 'global'])} END",
}
EVENTS_SQL = "SELECT " + ", ".join(f"{e} AS {c}" for c, e in ADAPTER.items()) + " FROM (SELECT o_orderkey AS k, o_totalprice AS p, c_mktsegment AS m FROM orders JOIN customer ON o_custkey = c_custkey)"

_OFF = f"{_d('(q * 13) % 100 - 50')} / {_d(100)}"
REQUESTS_SQL = " UNION ALL ".join(
    f"SELECT person, {i} AS segment_index, {_d(lat)} + {_OFF} AS seg_lat, {_d(lng)} + {_OFF} AS seg_lng, CAST({start} AS STRING) AS seg_start, CAST({end} AS STRING) AS seg_end FROM (SELECT c_name AS person, c_custkey AS q FROM customer)"
    for i, ((_, lat, lng), start, end) in enumerate(zip(DEMO, ("1700 + q % 300", "1710 + q % 300"), ("1720 + q % 300", "1744 + q % 300")))
)


def geo_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = spark.read.parquet(f"{sf_dir}/orders.parquet").select(F.col("o_orderkey").alias("k"), "o_custkey", F.col("o_totalprice").alias("p"))
    o = o.repartition("k")  # slim rows are spread before they are made wide: few row groups would be few tasks
    c = spark.read.parquet(f"{sf_dir}/customer.parquet").select("c_custkey", F.col("c_mktsegment").alias("m"))
    return o.join(c, F.col("o_custkey") == F.col("c_custkey")).selectExpr(*[f"{e} AS {col}" for col, e in ADAPTER.items()])


def requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """person, segment_index, seg_lat, seg_lng, seg_start, seg_end: two segments a customer."""
    c = spark.read.parquet(f"{sf_dir}/customer.parquet").select(F.col("c_name").alias("person"), F.col("c_custkey").alias("q"))
    cols = []
    for i, ((_, lat, lng), lo, span) in enumerate(zip(DEMO, (1700, 1710), (20, 34))):
        start = F.col("q") % 300 + lo
        off = ((F.col("q") * 13) % 100 - 50).cast("double") / 100.0
        cols.append(F.struct(F.lit(i).alias("segment_index"), (F.lit(lat) + off).alias("seg_lat"), (F.lit(lng) + off).alias("seg_lng"), start.cast("string").alias("seg_start"), (start + span).cast("string").alias("seg_end")))
    return c.select("person", F.explode(F.array(*cols)).alias("s")).select("person", "s.*")


def classified(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events in the stored layout, with foundings classified."""
    e = with_missing_columns(geo_events(spark, sf_dir))
    return e.withColumn("founding_kind", F.when(F.col("category") == "founding", founding_kind(F.col("blurb"))))


def scored_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scored(classified(spark, sf_dir))


_tables: dict[tuple[str, str], DataFrame] = {}


def scored_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """scored_events as a table, written once by each application: scores are frozen when the events are built, not with each query."""
    key = spark.sparkContext.applicationId, sf_dir
    if key not in _tables:
        _tables[key] = stored(scored_events(spark, sf_dir).repartition("id"))  # else files are as uneven as decades are
    return _tables[key]
