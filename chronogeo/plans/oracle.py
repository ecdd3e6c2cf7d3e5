"""The oracle's common tables: DuckDB SQL that scores the adapter's events, written apart from the Spark expressions."""

from __future__ import annotations

from ..sources.fixtures import EVENTS_SQL, REQUESTS_SQL
from . import oracle_terms as C


def rx(pattern: str, col: str) -> str:
    p = pattern.replace("'", "''")
    return f"regexp_matches({col}, '\\b(?:{p})\\b')"


INSTITUTION = f"coalesce(NOT {rx(C.INCIDENT, 'lower(blurb)')} AND {rx(C.INSTITUTION, 'substr(trim(split_part(lower(blurb), chr(44), 1)), 1, 80)')}, false)"
KIND = f"""CASE WHEN {INSTITUTION} THEN 'institution' WHEN {rx(C.SETTLEMENT, 'lower(blurb)')} THEN 'settlement' WHEN {rx(C.SOVEREIGN, 'lower(blurb)')} THEN 'country'
 WHEN {rx(C.SUBNATIONAL, 'lower(blurb)')} THEN 'subnational' WHEN {rx(C.COUNTRY, 'lower(blurb)')} THEN 'country' END"""
PERSON = "coalesce(category IN ('birth', 'death'), false)"
N0 = "coalesce(notability, 0.0::DOUBLE)"
SCOPE = f"""CASE WHEN ingest_version LIKE 'seed-%' AND scope <> '' THEN scope
 WHEN NOT {PERSON} AND {INSTITUTION} OR category = 'founding' AND founding_kind = 'institution' THEN CASE WHEN {N0} >= 0.5 THEN 'regional' ELSE 'local' END
 WHEN category = 'founding' AND founding_kind = 'settlement' THEN 'local' WHEN category = 'founding' AND founding_kind = 'subnational' THEN 'national'
 WHEN category = 'founding' AND founding_kind = 'country' THEN CASE WHEN {N0} >= 0.6 THEN 'global' ELSE 'national' END
 WHEN category = 'election' THEN CASE WHEN {N0} >= 0.5 THEN 'national' ELSE 'regional' END
 WHEN category = 'conflict' THEN CASE WHEN {N0} >= 0.6 THEN 'global' WHEN {N0} >= 0.3 THEN 'national' WHEN {N0} >= 0.15 THEN 'regional' ELSE 'local' END
 WHEN category = 'founding' THEN CASE WHEN {N0} >= 0.75 THEN 'national' WHEN {N0} >= 0.4 THEN 'regional' ELSE 'local' END
 WHEN category = 'discovery' THEN CASE WHEN {N0} >= 0.4 THEN 'global' WHEN {N0} >= 0.2 THEN 'national' WHEN {N0} >= 0.1 THEN 'regional' ELSE 'local' END
 WHEN category = 'milestone' THEN CASE WHEN {N0} >= 0.75 THEN 'global' WHEN {N0} >= 0.45 THEN 'national' WHEN {N0} >= 0.25 THEN 'regional' ELSE 'local' END
 WHEN category = 'treaty' THEN CASE WHEN {N0} >= 0.6 THEN 'global' WHEN {N0} >= 0.3 THEN 'national' ELSE 'regional' END
 WHEN category = 'event' THEN CASE WHEN {N0} >= 0.6 THEN 'global' WHEN {N0} >= 0.35 THEN 'national' WHEN {N0} >= 0.2 THEN 'regional' ELSE 'local' END
 WHEN {PERSON} THEN 'local' ELSE CASE WHEN {N0} >= 0.6 THEN 'national' ELSE 'local' END END"""
RAW = f"raw AS (SELECT *, NULL::VARCHAR AS display_title, NULL::VARCHAR AS source_url FROM ({EVENTS_SQL}))"
CLASSED = f"{RAW}, cls AS (SELECT *, CASE WHEN category = 'founding' THEN {KIND} END AS founding_kind FROM raw)"
DECADE = "(floor(CAST(substr(date_start, 1, 4) AS DOUBLE) / 10) * 10)::INT"
SIGNED = f"""{CLASSED}, sig AS (SELECT * REPLACE ({SCOPE} AS scope), CASE WHEN count(*) OVER (PARTITION BY {PERSON}, {DECADE}) <= 1 THEN 0.5::DOUBLE
 ELSE floor(cume_dist() OVER (PARTITION BY {PERSON}, {DECADE} ORDER BY {N0}) * 1000::DOUBLE + 0.5::DOUBLE) / 1000::DOUBLE END AS significance FROM cls)"""
REACH = """CASE scope WHEN 'global' THEN 20038.0::DOUBLE WHEN 'national' THEN floor(1500::DOUBLE * (0.7::DOUBLE + 0.6::DOUBLE * significance) + 0.5::DOUBLE)
 WHEN 'regional' THEN floor(300::DOUBLE * (0.7::DOUBLE + 0.6::DOUBLE * significance) + 0.5::DOUBLE) ELSE floor(50::DOUBLE * (1.0::DOUBLE + 0.2::DOUBLE * significance) + 0.5::DOUBLE) END"""
SCORED = f"""{SIGNED}, rch AS (SELECT *, {REACH} AS reach_km FROM sig),
sc AS (SELECT *, CASE WHEN scope = 'global' THEN -90 ELSE greatest(-90, lat - reach_km / 111) END::DOUBLE AS reach_min_lat, CASE WHEN scope = 'global' THEN 90 ELSE least(90, lat + reach_km / 111) END::DOUBLE AS reach_max_lat,
 CASE WHEN scope = 'global' THEN -180 ELSE lng - reach_km / (111 * greatest(0.2::DOUBLE, cos(radians(lat)))) END::DOUBLE AS reach_min_lng,
 CASE WHEN scope = 'global' THEN 180 ELSE lng + reach_km / (111 * greatest(0.2::DOUBLE, cos(radians(lat)))) END::DOUBLE AS reach_max_lng FROM rch)"""


def round_to(x: str, places: int) -> str:
    return f"floor(({x}) * {10**places}::DOUBLE + 0.5::DOUBLE) / {10**places}::DOUBLE"


LO = """CASE WHEN length(date_start) >= 10 THEN substr(date_start, 1, 10) WHEN length(date_start) = 7 THEN date_start || '-01' ELSE date_start || '-01-01' END"""
DIST = "2 * 6371 * asin(least(1.0::DOUBLE, sqrt(sin(radians(lat - seg_lat) / 2) ** 2 + cos(radians(seg_lat)) * cos(radians(lat)) * sin(radians(lng - seg_lng) / 2) ** 2)))"
TIER = "CASE WHEN category IN ('birth', 'death') THEN 'person' WHEN scope IN ('local', 'regional', 'national', 'global') THEN scope ELSE 'local' END"
WEIGHT = """CASE WHEN category = 'founding' AND founding_kind IS NOT NULL THEN CASE founding_kind WHEN 'settlement' THEN 0.35 WHEN 'institution' THEN 0.5 ELSE 0.9 END
 WHEN category = 'birth' THEN 0.4 WHEN category = 'death' THEN 0.5 WHEN category = 'founding' THEN 0.7 ELSE 1.0 END::DOUBLE"""
DATE = "CASE date_precision WHEN 'day' THEN strftime(lo::DATE, '%B ') || day(lo::DATE) || ', ' || year(lo::DATE) WHEN 'month' THEN strftime(lo::DATE, '%B ') || year(lo::DATE) ELSE year(lo::DATE)::VARCHAR END"


def matched(floors: tuple[float, float, float, float, float] = (0.05, 0.15, 0.15, 0.2, 0.15)) -> str:
    """... m: the pairs of segments and events. floors: local, regional, national, global, person."""
    local, regional, national, world, person = floors
    return f"""{SCORED}, ev AS (SELECT *, {LO} AS lo, {TIER} AS tier FROM sc),
seg AS ({REQUESTS_SQL}),
j AS (SELECT seg.*, ev.*, {DIST} AS d FROM seg JOIN ev ON ev.reach_min_lat <= seg_lat AND ev.reach_max_lat >= seg_lat AND ev.reach_min_lng <= seg_lng AND ev.reach_max_lng >= seg_lng
      AND substr(date_start, 1, 4) BETWEEN seg_start AND seg_end AND lo BETWEEN seg_start || '-01-01' AND seg_end || '-12-31'
      AND significance >= CASE tier WHEN 'local' THEN {local} WHEN 'regional' THEN {regional} WHEN 'national' THEN {national} WHEN 'global' THEN {world} ELSE {person} END::DOUBLE),
m AS (SELECT *, {DATE} AS date, {round_to('d', 1)} AS distance_km, {round_to(f'significance * {WEIGHT} * (0.6::DOUBLE + 0.4::DOUBLE * (1 - least(1.0::DOUBLE, d / reach_km)))', 3)} AS score FROM j WHERE d <= reach_km)"""


RANK = "ORDER BY score DESC, lo ASC, id ASC"
QUOTA = "CASE tier WHEN 'local' THEN 4 WHEN 'regional' THEN 3 WHEN 'national' THEN 4 WHEN 'global' THEN 5 ELSE 2 END"
TURN = "CASE tier WHEN 'local' THEN 0 WHEN 'regional' THEN 1 WHEN 'national' THEN 2 WHEN 'global' THEN 3 ELSE 4 END"


def drawn(source: str, name: str, most: int = 12) -> str:
    """name: what the segments in source keep."""
    return f"""{name}_t AS (SELECT *, row_number() OVER (PARTITION BY person, segment_index, tier {RANK}) AS turn FROM {source}),
{name}_p AS (SELECT *, row_number() OVER (PARTITION BY person, segment_index ORDER BY turn, {TURN}) AS place FROM {name}_t WHERE turn <= {QUOTA}),
{name} AS (SELECT * FROM {name}_p WHERE place <= {most})"""


def kept(floors: tuple = (0.05, 0.15, 0.15, 0.2, 0.15), most: int = 12) -> str:
    """... k: both segments' entries, without the first one's events in the second."""
    return f"""{matched(floors)}, m0 AS (SELECT * FROM m WHERE segment_index = 0), {drawn('m0', 'k0', most)},
m1 AS (SELECT m.* FROM m ANTI JOIN k0 ON m.person = k0.person AND m.id = k0.id WHERE m.segment_index = 1), {drawn('m1', 'k1', most)},
k AS (SELECT * FROM k0 UNION ALL BY NAME SELECT * FROM k1)"""
