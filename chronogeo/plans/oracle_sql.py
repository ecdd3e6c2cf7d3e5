"""For each registered query the SQL by which DuckDB gets the same rows from the same tables."""

from __future__ import annotations

from . import oracle_terms as K
from .oracle import CLASSED, DATE, DIST, INSTITUTION, KIND, LO, QUOTA, RANK, RAW, REACH, SCOPE, SCORED, SIGNED, drawn, kept, matched, round_to, rx

_PARSED = f"{RAW}, pd AS (SELECT *, {LO} AS lo FROM raw)"
_ENTRY = """person, segment_index, id, title, title AS display_title, blurb, date, lo AS date_start_iso, lo AS date_end_iso, date_precision AS precision, distance_km, reach_km, scope, significance, category, score"""
_NUM = "regexp_replace({}::VARCHAR, '\\.0$', '')"
_YEARLY = "regexp_matches(title, '^[12][0-9]{3} ')"
_SERIES = f"""ser AS (SELECT substr(title, 6) AS series, count(*) AS n, min(substr(date_start, 1, 4)) AS first_yr, max(substr(date_start, 1, 4)) AS last_yr, {round_to('avg(notability)', 3)} AS avg_notability,
 {round_to('avg(significance)', 3)} AS avg_sig, min(category) AS category, sum(CASE WHEN ingest_version LIKE 'seed-%' THEN 1 ELSE 0 END)::BIGINT AS seeded FROM sig WHERE {_YEARLY} GROUP BY 1 HAVING count(*) >= 5)"""
_KEEP = "lower(series) NOT IN ('fifa world cup', 'summer olympics', 'united states presidential election', 'winter olympics', 'building championship')"
_RULE = f"""CASE WHEN trim(title) = '' OR {rx(K.PHRASED, 'lower(title)')} THEN NULL WHEN category = 'discovery' THEN 'discovery' WHEN category = 'founding' THEN
 CASE WHEN founding_kind = 'settlement' THEN 'settlement' WHEN founding_kind = 'subnational' AND coalesce(contains(lower(blurb), 'state of the united states'), false) THEN 'statehood'
 WHEN founding_kind = 'subnational' THEN 'subnational' WHEN founding_kind = 'country' THEN 'country' ELSE 'founding-unclassified' END END"""
_TITLE = "CASE WHEN rule = 'discovery' THEN 'Discovery of ' || trim(title) WHEN rule = 'statehood' THEN trim(title) || ' Statehood' WHEN rule IS NOT NULL THEN 'Founding of ' || trim(title) END"
_TITLED = f"{CLASSED}, tt AS (SELECT *, {_RULE} AS rule FROM cls WHERE category IN ('founding', 'discovery') AND ingest_version NOT LIKE 'seed-%')"
_KEYED = f"{RAW}, e AS (SELECT *, regexp_extract(id, '([0-9]+)', 1)::BIGINT AS k FROM raw)"
_VERDICTS = f"""{_KEYED}, drops AS (SELECT id AS seed_id FROM e WHERE ingest_version LIKE 'seed-%' AND k % 3 = 0),
merges AS (SELECT id AS seed_id, CASE WHEN k % 5 = 0 THEN 'Q-none' ELSE 'Q' || (k + 1) END AS dump_id, '1900-01-' || lpad((k % 28 + 1)::VARCHAR, 2, '0') AS seed_date FROM e WHERE ingest_version LIKE 'seed-%' AND k % 3 = 1)"""
_LAYERS = f"""{_KEYED}, old AS (SELECT id, title, notability, scope FROM e WHERE k % 3 <> 0),
n0 AS (SELECT id, 'new ' || title AS title, (k % 7)::DOUBLE AS notability, 0 AS ord FROM e WHERE k % 2 = 0),
n AS (SELECT * FROM n0 UNION ALL SELECT id, 'again', notability, 1 FROM n0 WHERE notability < 2)"""
_EDGES = "ed AS (SELECT 'T' || p_partkey AS child, 'T' || (p_partkey // 3) AS parent FROM part WHERE p_partkey > 0 UNION SELECT * FROM (VALUES ('T1', 'T7'), ('T7', 'T1')))"
_CLOSURE = f"""{_EDGES}, rt AS (SELECT * FROM (VALUES ('T5', 'conflict', 0), ('T2', 'treaty', 2), ('T1', 'event', 6), ('T6', 'discovery', 4)) v(node, category, priority)),
cl AS (SELECT node, category, priority FROM rt UNION SELECT ed.child, cl.category, cl.priority FROM cl JOIN ed ON ed.parent = cl.node),
clo AS (SELECT node, arg_min(category, priority) AS category FROM cl GROUP BY node)"""
_ENTITIES = """en AS (SELECT p_partkey AS k, 'Q' || p_partkey AS qid, p_name AS title, (p_partkey % 90)::INT AS sitelinks, p_partkey % 7 = 0 AS person,
 p_partkey % 11 = 0 OR p_partkey % 3 = 0 AS placed, (p_partkey % 90)::DOUBLE AS lat, (p_partkey % 180)::DOUBLE AS lng FROM part)"""
_TYPED = "ty AS (SELECT qid, 0 AS pos, 'T' || (k * 5 % 2000) AS node FROM en WHERE NOT person UNION ALL SELECT qid, 1, 'T' || (k * 3 % 700) FROM en WHERE NOT person UNION ALL SELECT qid, 0, 'Q5' FROM en WHERE person)"
_TCAT = "tc AS (SELECT qid, arg_min(category, pos) AS category FROM ty JOIN clo USING (node) GROUP BY qid)"
_PAGES = """tb AS (SELECT n_name AS page, n_nationkey AS k, 1500 + n_nationkey * 10 AS year FROM nation)"""
_NORM = "(' ' || regexp_replace(lower(strip_accents(coalesce({0}, ''))), '[^\\p{{L}}\\p{{N}}]+', ' ', 'g') || ' ')"
_T, _B = _NORM.format("title"), _NORM.format("blurb")
_SHOW = "ORDER BY notability DESC NULLS LAST, date_start ASC NULLS FIRST, id LIMIT 25"


def _has(word: str) -> str:
    return f"(contains({_T}, '{word}') OR contains({_B}, '{word}'))"


ORACLES = {
    "timeline_flagship": f"WITH {kept()} SELECT {_ENTRY} FROM k",
    "timeline_total_matched": f"WITH {matched()} SELECT person, count(*) AS total_matched FROM m GROUP BY person",
    "timeline_config_floor": f"WITH {kept((0.3, 0.5, 0.5, 0.5, 0.5), 6)} SELECT person, segment_index, id, score FROM k",
    "timeline_matches": f"WITH {matched()} SELECT person, segment_index, id, tier, distance_km, score FROM m",
    "timeline_payload": f"""WITH {kept()}, t AS (SELECT person, count(*) AS total_matched FROM m GROUP BY person),
g AS (SELECT person, count(*) AS n, string_agg(id, ',' ORDER BY lo, id) AS ids FROM k GROUP BY person)
SELECT person, total_matched, coalesce(n, 0)::INT AS returned, coalesce(ids, '') AS ids, 'dump-v0' AS dataset_version FROM t LEFT JOIN g USING (person)""",
    "timeline_markdown": f"""WITH {kept()}, t AS (SELECT person, count(*) AS total_matched FROM m GROUP BY person),
g AS (SELECT person, count(*) AS n, string_agg('- **' || date || '** — ' || title || chr(10) || CASE WHEN coalesce(blurb, '') <> '' THEN '  ' || blurb || chr(10) ELSE '' END || '  _' || scope || ' · sig ' || {_NUM.format('significance')} || ' · ' || {_NUM.format('distance_km')} || '/' || {_NUM.format('reach_km')} || ' km_', chr(10) ORDER BY lo, id) AS body FROM k GROUP BY person)
SELECT person, '# Timeline — ' || person || chr(10) || chr(10) || CASE WHEN body IS NULL THEN '' ELSE body || chr(10) END || chr(10) || '_Dataset dump-v0 · ' || coalesce(n, 0) || ' of ' || total_matched || ' matched events_' AS markdown FROM t LEFT JOIN g USING (person)""",
    "match_rank": f"WITH {matched()} SELECT person, segment_index, id, row_number() OVER (PARTITION BY person, segment_index {RANK}) AS match_rank, row_number() OVER (PARTITION BY person, segment_index, tier {RANK}) AS tier_rank FROM m",
    "tier_quota": f"WITH {matched()}, r AS (SELECT *, row_number() OVER (PARTITION BY person, segment_index, tier {RANK}) AS tier_rank FROM m) SELECT segment_index, tier, count(*) AS n, max(tier_rank) AS most FROM r WHERE tier_rank <= {QUOTA} GROUP BY ALL",
    "round_robin_draw": f"WITH {matched()}, mm AS (SELECT * FROM m), {drawn('mm', 'k')} SELECT person || '|' || segment_index AS person, tier, count(*) AS n, min(score) AS least FROM k GROUP BY ALL",
    "geo_events_adapter": f"WITH {RAW} SELECT * EXCLUDE (display_title, source_url) FROM raw",
    "decade_percentiles": f"WITH {SIGNED} SELECT id, significance FROM sig",
    "scope_ladders": f"WITH {CLASSED}, a AS (SELECT *, {SCOPE} AS final FROM cls), b AS (SELECT * REPLACE ('none' AS ingest_version) FROM a) SELECT id, {SCOPE} AS ladder, final AS scope FROM b",
    "reach_formula": f"WITH {SIGNED} SELECT id, scope, {REACH} AS reach_km FROM sig",
    "reach_bbox": f"WITH {SCORED} SELECT id, " + ", ".join(f"{round_to(c, 6)} AS {c}" for c in ("reach_min_lat", "reach_max_lat", "reach_min_lng", "reach_max_lng")) + " FROM sc",
    "score_report": f"""WITH {CLASSED}, x AS (SELECT *, coalesce(category IN ('birth', 'death'), false) AS p, {INSTITUTION} AND NOT coalesce(category IN ('birth', 'death'), false) AND ingest_version NOT LIKE 'seed-%' AS i FROM cls)
SELECT count(*) FILTER (p) AS persons, count(*) FILTER (NOT p) AS history, count(*) FILTER (category = 'founding' AND founding_kind IS NOT NULL) AS by_kind, count(*) FILTER (i) AS institutions, count(*) FILTER (i AND scope IN ('global', 'national')) AS demoted FROM x""",
    "haversine": f"WITH {RAW}, s AS (SELECT *, 38.2544::DOUBLE AS seg_lat, -104.6091::DOUBLE AS seg_lng FROM raw) SELECT id, {round_to(DIST, 1)} AS km FROM s",
    "reach_filters": f"""WITH {SCORED}, s AS (SELECT *, 38.2544::DOUBLE AS seg_lat, -104.6091::DOUBLE AS seg_lng FROM sc)
SELECT scope, count(*) AS in_box, count(*) FILTER ({DIST} <= reach_km) AS in_circle FROM s WHERE seg_lat BETWEEN reach_min_lat AND reach_max_lat AND seg_lng BETWEEN reach_min_lng AND reach_max_lng GROUP BY scope""",
    "date_overlap": f"WITH {_PARSED} SELECT id, lo, lo AS hi FROM pd WHERE lo BETWEEN '1902-01-01' AND '1921-06-30'",
    "institutions": f"WITH {RAW} SELECT id, {INSTITUTION} AS institution FROM raw",
    "founding_classify": f"WITH {RAW} SELECT id, {KIND} AS kind FROM raw WHERE category = 'founding'",
    "founding_tally": f"""WITH {CLASSED}, f AS (SELECT coalesce(founding_kind, 'unclassified') AS kind, count(*) AS c FROM cls WHERE category = 'founding' GROUP BY 1)
SELECT v.kind, coalesce(c, 0) AS n, {round_to('coalesce(c, 0) * 100::DOUBLE / (SELECT sum(c) FROM f)', 1)} AS share FROM (VALUES ('settlement'), ('institution'), ('subnational'), ('country'), ('unclassified')) v(kind) LEFT JOIN f USING (kind)""",
    "display_titles": f"WITH {CLASSED}, t AS (SELECT *, {_RULE} AS rule FROM cls) SELECT id, rule, {_TITLE} AS display_title FROM t",
    "display_rule_counts": f"WITH {_TITLED} SELECT coalesce(rule, '(skipped)') AS rule, count(*) AS n FROM tt GROUP BY 1",
    "rule_samples": f"WITH {_TITLED}, r AS (SELECT *, row_number() OVER (PARTITION BY rule ORDER BY id) AS k FROM tt WHERE rule IS NOT NULL) SELECT id, rule, title AS before, {_TITLE} AS after FROM r WHERE k <= 4 ORDER BY id LIMIT 20",
    "category_from_text": f"""WITH {RAW} SELECT id, CASE WHEN {rx(K.KIND_WORDS['treaty'], "lower(coalesce(blurb, ''))")} THEN 'treaty' WHEN {rx(K.KIND_WORDS['conflict'], "lower(coalesce(blurb, ''))")} THEN 'conflict'
 WHEN {rx(K.KIND_WORDS['founding'], "lower(coalesce(blurb, ''))")} THEN 'founding' ELSE 'event' END AS kind FROM raw""",
    "parse_dates": f"""WITH {_PARSED}, x AS (SELECT id, date_precision AS precision, substr(lo, 1, 4) || CASE WHEN date_precision = 'year' THEN '-01-01' WHEN date_precision = 'month' THEN substr(lo, 5, 3) || '-01' ELSE substr(lo, 5) END AS a,
 CASE date_precision WHEN 'year' THEN substr(lo, 1, 4) || '-12-31' WHEN 'month' THEN strftime(last_day(lo::DATE), '%Y-%m-%d') ELSE lo END AS z FROM pd)
SELECT id, a AS lo, z AS hi, precision, CASE precision WHEN 'year' THEN substr(a, 1, 4) || '-01-01' ELSE a END AS lo_words, z AS hi_words FROM x""",
    "format_dates": f"WITH {_PARSED} SELECT id, {DATE} AS date FROM pd",
    "hash36": """WITH RECURSIVE h AS (SELECT c_custkey, c_name AS s, 1 AS i, 0::BIGINT AS v FROM customer UNION ALL
 SELECT c_custkey, s, i + 1, ((v * 31 + ord(s[i]) + 2147483648) % 4294967296 + 4294967296) % 4294967296 - 2147483648 FROM h WHERE i <= length(s)),
b AS (SELECT c_custkey, abs(v) AS v FROM h WHERE i = length(s) + 1)
SELECT c_custkey, array_to_string(list_transform(range(CASE WHEN v >= 2176782336 THEN 6 ELSE 5 END, -1, -1), lambda p: '0123456789abcdefghijklmnopqrstuvwxyz'[(v // (36 ** p)::BIGINT % 36 + 1)::INT]), '') AS h FROM b""",
    "slugs": f"WITH {RAW} SELECT id, substr(trim(regexp_replace(lower(title), '[^a-z0-9]+', '-', 'g'), '-'), 1, 90) AS slug FROM raw",
    "wkt_points": f"WITH {RAW} SELECT id, round(lat, 2) AS lat, round(lng, 2) AS lng FROM raw",
    "wikidata_times": f"WITH {RAW} SELECT id, CASE WHEN date_precision = 'year' THEN substr(date_start, 1, 4) || '-01-01' ELSE date_start END AS date, date_precision AS kind FROM raw",
    "truncate_ips": """SELECT c_custkey, CASE c_custkey % 4 WHEN 1 THEN '2001:db8:' || (c_custkey % 10000) || '::/48' WHEN 3 THEN 'unknown'
 ELSE (c_custkey * 3 % 256) || '.' || (c_custkey * 5 % 256) || '.' || (c_custkey * 7 % 256) || '.0' END AS ip FROM customer""",
    "stats_by_category": f"WITH {RAW} SELECT coalesce(category, '(null)') AS category, count(*) AS c FROM raw GROUP BY 1",
    "stats_by_precision": f"WITH {RAW} SELECT coalesce(date_precision, '(null)') AS date_precision, count(*) AS c FROM raw GROUP BY 1",
    "stats_by_scope": f"WITH {RAW} SELECT coalesce(scope, '(unscored)') AS scope, count(*) AS c FROM raw GROUP BY 1",
    "year_span": f"WITH {RAW} SELECT min(substr(date_start, 1, 4)) AS lo, max(substr(date_start, 1, 4)) AS hi, count(*) AS total FROM raw",
    "modal_version": f"WITH {RAW} SELECT ingest_version, count(*) AS c FROM raw GROUP BY 1 ORDER BY c DESC, ingest_version LIMIT 1",
    "year_samples": f"WITH {RAW} SELECT id, title, notability FROM raw WHERE substr(date_start, 1, 4) = '1912' ORDER BY notability DESC NULLS LAST, id LIMIT 10",
    "year_precision_samples": f"WITH {RAW} SELECT id, title, date_start, date_precision, notability FROM raw WHERE date_precision = 'year' ORDER BY notability DESC NULLS LAST, id LIMIT 10",
    "unclassified_foundings": f"WITH {CLASSED} SELECT id, notability, substr(title, 1, 40) AS title, substr(coalesce(blurb, '(none)'), 1, 70) AS blurb FROM cls WHERE category = 'founding' AND founding_kind IS NULL ORDER BY notability DESC NULLS LAST, id LIMIT 20",
    "series_detect": f"WITH {SIGNED}, {_SERIES} SELECT * FROM ser",
    "series_delete": f"WITH {SIGNED}, {_SERIES} SELECT id FROM raw WHERE NOT ({_YEARLY} AND ingest_version NOT LIKE 'seed-%' AND substr(title, 6) IN (SELECT series FROM ser WHERE {_KEEP}))",
    "series_doomed": f"WITH {SIGNED}, {_SERIES} SELECT count(*) AS n_series, coalesce(sum(n - seeded), 0)::BIGINT AS n_rows, {round_to('coalesce(sum(n - seeded), 0)::DOUBLE * 100::DOUBLE / (SELECT count(*) FROM raw)', 2)} AS percent FROM ser WHERE {_KEEP}",
    "series_semi": f"WITH {SIGNED}, {_SERIES} SELECT id, title, substr(date_start, 1, 4) AS yr, significance FROM sig WHERE {_YEARLY} AND ingest_version NOT LIKE 'seed-%' AND substr(title, 6) IN (SELECT series FROM ser) ORDER BY significance DESC NULLS LAST, id LIMIT 15",
    "prune_by_scope": f"WITH {SIGNED} SELECT coalesce(scope, '(unscored)') AS scope, count(*) AS c FROM sig WHERE category = 'election' GROUP BY 1",
    "prune_histogram": f"WITH {RAW} SELECT floor(least(0.99::DOUBLE, greatest(0::DOUBLE, notability)) * 10::DOUBLE) / 10::DOUBLE AS bucket, count(*) AS c FROM raw WHERE category = 'election' AND notability IS NOT NULL GROUP BY 1",
    "prune_candidate_floors": f"WITH {RAW} SELECT v.floor, count(*) FILTER (notability < v.floor) AS removed, count(*) FILTER (notability IS NULL OR notability >= v.floor) AS kept FROM raw, (SELECT unnest([0.15, 0.2, 0.25, 0.3, 0.35, 0.4]::DOUBLE[]) AS floor) v WHERE category = 'election' GROUP BY 1",
    "prune_apply": f"WITH {RAW} SELECT category, count(*) AS n FROM raw WHERE NOT coalesce(category = 'election' AND notability < 0.25::DOUBLE, false) GROUP BY 1",
    "least_notable": f"WITH {RAW} SELECT id, title, date_start, notability FROM raw WHERE category = 'election' AND notability < 0.25::DOUBLE ORDER BY notability, date_start, id LIMIT 25",
    "merge_date": f"WITH {_VERDICTS} SELECT dump_id, seed_date, CASE WHEN e.id IS NULL THEN 'missing' WHEN date_start = seed_date THEN 'exact' ELSE 'patched' END AS status FROM merges LEFT JOIN e ON e.id = dump_id",
    "dupe_anti": f"""WITH {_VERDICTS}, p AS (SELECT dump_id, max(seed_date) AS seed_date FROM merges GROUP BY 1) SELECT e.id, coalesce(seed_date, date_start) AS date_start, CASE WHEN seed_date IS NOT NULL AND seed_date <> date_start THEN 'day' ELSE date_precision END AS date_precision
FROM e LEFT JOIN p ON p.dump_id = e.id WHERE e.id NOT IN (SELECT seed_id FROM drops UNION SELECT seed_id FROM merges)""",
    "verdict_overlap": f"WITH {_VERDICTS} SELECT seed_id FROM merges WHERE substr(seed_date, 9, 2) = '06'",
    "insert_ignore": f"WITH {_LAYERS} SELECT * FROM old UNION ALL SELECT id, title, notability, NULL FROM n0 WHERE id NOT IN (SELECT id FROM old)",
    "insert_replace": f"WITH {_LAYERS} SELECT * FROM old WHERE id NOT IN (SELECT id FROM n0) UNION ALL SELECT id, CASE WHEN notability < 2 THEN 'again' ELSE title END, notability, NULL FROM n0",
    "upsert_update": f"WITH {_LAYERS} SELECT coalesce(old.id, n0.id) AS id, CASE WHEN n0.id IS NULL THEN old.title ELSE n0.title END AS title, CASE WHEN n0.id IS NULL THEN old.notability ELSE n0.notability END AS notability, old.scope FROM old FULL JOIN n0 USING (id)",
    "dup_id_check": f"WITH {_LAYERS} SELECT id, count(*) AS n, string_agg(title, '|' ORDER BY title) AS claimants FROM n GROUP BY id HAVING count(*) > 1",
    "dataset_build_id": f"WITH {RAW} SELECT (SELECT ingest_version FROM raw GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1) || '+struct-1+no-reach+prune2' AS build_id",
    "type_closure": f"WITH RECURSIVE {_CLOSURE} SELECT node, category FROM clo",
    "type_category_join": f"WITH RECURSIVE {_CLOSURE}, {_ENTITIES}, {_TYPED}, {_TCAT} SELECT qid, category FROM tc",
    "dump_events": f"""WITH RECURSIVE {_CLOSURE}, {_ENTITIES}, {_TYPED}, {_TCAT},
co AS (SELECT qid, lat, lng FROM en WHERE placed),
b AS (SELECT en.qid || '#birth' AS id, 'birth' AS category, (1800 + k % 100) || '-05-01' AS date_start, 'day' AS date_precision, co.lat, co.lng, sitelinks FROM en JOIN co ON co.qid = 'Q' || (k * 11 % 500) WHERE person AND sitelinks >= 30),
x AS (SELECT en.qid || '#death' AS id, 'death' AS category, (1850 + k % 100) || '-05-01' AS date_start, 'year' AS date_precision, co.lat, co.lng, sitelinks FROM en JOIN co ON co.qid = 'Q' || (k * 9 % 500) WHERE person AND sitelinks >= 30),
t AS (SELECT en.*, tc.category, CASE WHEN tc.category = 'discovery' THEN (1700 + k % 300) || '-05-01' WHEN k % 5 <> 0 THEN (1500 + k % 500) || '-05-01' ELSE (1600 + k % 400) || '-05-01' END AS date_start,
      CASE WHEN tc.category = 'discovery' THEN 'day' WHEN k % 5 <> 0 THEN 'month' ELSE 'year' END AS date_precision, coalesce(c1.lat, c2.lat) AS s_lat, coalesce(c1.lng, c2.lng) AS s_lng
      FROM en JOIN tc USING (qid) LEFT JOIN co c1 ON c1.qid = 'Q' || (k % 40 * 11) LEFT JOIN co c2 ON c2.qid = 'Q' || (k * 3 % 300)
      WHERE NOT person AND sitelinks >= CASE tc.category WHEN 'conflict' THEN 5 WHEN 'treaty' THEN 10 WHEN 'discovery' THEN 3 ELSE 8 END),
y AS (SELECT qid AS id, category, date_start, date_precision, CASE WHEN placed THEN lat WHEN category = 'treaty' THEN s_lat END AS lat, CASE WHEN placed THEN lng WHEN category = 'treaty' THEN s_lng END AS lng, sitelinks FROM t),
u AS (SELECT * FROM b UNION ALL SELECT * FROM x UNION ALL SELECT * FROM y)
SELECT id, category, date_start, date_precision, lat, lng, {round_to('least(1::DOUBLE, sitelinks / 100::DOUBLE)', 3)} AS notability FROM u WHERE lat IS NOT NULL AND substr(date_start, 1, 4)::INT BETWEEN 1550 AND 1950""",
    "top_k_per_year": f"WITH {RAW}, r AS (SELECT *, substr(date_start, 1, 4) AS yr, row_number() OVER (PARTITION BY substr(date_start, 1, 4), category ORDER BY notability DESC NULLS LAST, id) AS rank FROM raw) SELECT yr, category, id, rank FROM r WHERE rank <= 2",
    "set_ops": f"""WITH {RAW}, a AS (SELECT title FROM raw WHERE category = 'event'), b AS (SELECT title FROM raw WHERE category = 'conflict'), c AS (SELECT title FROM raw WHERE category = 'treaty')
SELECT 'both' AS set, title FROM (SELECT * FROM a INTERSECT SELECT * FROM b) UNION ALL SELECT 'only', title FROM (SELECT * FROM a EXCEPT SELECT * FROM c) UNION ALL SELECT 'any', title FROM (SELECT * FROM a UNION SELECT * FROM b)""",
    "carry_year": f"""WITH {_PAGES} SELECT page, 4 AS line, year::INT AS year, year || '-05-03' AS date_start, 'day' AS precision, page || ' conquers REGION in a war' AS blurb, 'conflict' AS category, page || '|REGION' AS links FROM tb
UNION ALL SELECT page, 6, year::INT, year || '-08-01', 'month', page || ' signs a treaty, see File:x.png', 'treaty', page FROM tb""",
    "section_bullets": f"WITH {_PAGES} SELECT page, 10 AS line, 1453 AS year, 'The ' || page || ' is founded and declares independence' AS event, 'founding' AS category FROM tb",
    "pick_place": f"WITH {_PAGES} SELECT page, 4 AS line, 'R' AS qid FROM tb UNION ALL SELECT page, 6, 'N' || k FROM tb",
    "search_topk": f"WITH {RAW} SELECT id, title, notability, date_start FROM raw WHERE {_has(' city ')} AND {_has(' nevada ')} {_SHOW}",
    "search_phrase": f"WITH {RAW} SELECT id, title, notability, date_start FROM raw WHERE {_has(' sovereign state ')} OR contains({_T}, ' championship ') AND NOT {_has(' machinery ')} {_SHOW}",
    "search_prefix": f"WITH {RAW} SELECT id, title, notability, date_start FROM raw WHERE {_has(' uni')} AND {_has(' tor')} {_SHOW}",
    "search_documents": "WITH t AS (SELECT doc_id, " + _NORM.format("text") + " AS x FROM documents) SELECT doc_id FROM t WHERE contains(x, ' the ') AND (contains(x, ' of ') OR contains(x, ' und ')) AND NOT contains(x, ' que ')",
    "inverted_index": f"""WITH {RAW}, p AS (SELECT id, 'title' AS field, string_split(trim({_T}), ' ') AS ws FROM raw UNION ALL SELECT id, 'blurb', string_split(trim({_B}), ' ') FROM raw),
i AS (SELECT id, field, unnest(ws) AS token, unnest(range(len(ws))) AS pos FROM p) SELECT token, field, count(*) AS n, count(DISTINCT id) AS df, max(pos)::INT AS last FROM i WHERE token <> '' GROUP BY ALL""",
    "search_near": f"""WITH {RAW} SELECT id, title, notability, date_start FROM raw WHERE starts_with({_B}, ' university ') AND regexp_matches({_B}, ' university (?:[^ ]+ ){{0,2}}canada | canada (?:[^ ]+ ){{0,2}}university ')
 OR contains({_T}, ' place 7 ') OR contains({_T}, ' 7 place ') OR starts_with({_B}, ' state of ') {_SHOW}""",
    "scan_events": f"WITH {RAW} SELECT id, title, date_start, category, scope, NULL::DOUBLE AS significance, NULL::VARCHAR AS founding_kind FROM raw WHERE date_start >= '1850' AND date_start < '1870'",
    "search_scan": f"WITH {RAW} SELECT id, title, notability, date_start FROM raw WHERE {_has(' city ')} AND {_has(' nevada ')} {_SHOW}",
    "timeline_answers": f"""WITH {kept()}, t AS (SELECT person, count(*) AS total_matched FROM m GROUP BY person),
g AS (SELECT person, count(*) AS n, string_agg(id, ',' ORDER BY lo, id) AS ids, string_agg(title, '|' ORDER BY lo, id) AS titles, sum(score) AS score, sum(segment_index)::BIGINT AS later FROM k GROUP BY person)
SELECT person, 'dump-v0' AS dataset_version, 'chronogeo-1' AS generated_with, 2 AS segment_count, total_matched, coalesce(n, 0)::INT AS returned, coalesce(ids, '') AS ids, coalesce(titles, '') AS titles,
       {round_to('coalesce(score, 0)', 3)} AS score, coalesce(later, 0) AS later FROM t LEFT JOIN g USING (person)""",
    "segment_errors": """SELECT c_name AS person, i::INT AS segment_index, CASE i WHEN 0 THEN 'start: cannot be read' WHEN 1 THEN 'end: cannot be read' ELSE 'ends before it starts' END AS error
FROM customer, (SELECT unnest([0, 1, 2]) AS i) WHERE c_custkey % 5 = i""",
    "service_meta": f"""WITH {RAW} SELECT 'chronogeo-1' AS engine, 'dump-v0+struct-1+no-reach+prune2' AS build, 'struct-1' AS scoring, NULL::VARCHAR AS reach, '["election<0.25","2 series"]' AS prunes,
 (SELECT count(*) FROM raw)::VARCHAR AS total, '12' AS max_per_segment, '0.05' AS local_floor, '5' AS global_quota, '40' AS max_segments""",
    "service_health": f"WITH {RAW} SELECT count(*) > 0 AS ok, count(*) AS events FROM raw",
    "meta_lookup": f"WITH {RAW} SELECT ingest_version AS value FROM raw GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1",
    "reset_founding_kinds": f"WITH {CLASSED} SELECT category, count(*) AS n, 0 AS kinds, 0 AS display_titles FROM cls GROUP BY category",
    "verdict_counts": f"""WITH {_VERDICTS}, v AS (SELECT 'drop' AS verdict, seed_id FROM drops UNION ALL SELECT 'drop', seed_id FROM drops WHERE seed_id LIKE '%9' UNION ALL SELECT 'merge', seed_id FROM merges)
SELECT verdict, count(*) AS pairs, count(DISTINCT seed_id) AS rows FROM v GROUP BY verdict UNION ALL SELECT 'all', count(*), count(DISTINCT seed_id) FROM v""",
    "wiki_pages": "SELECT p_name AS page, '* 1453: [[' || p_type || ']]' AS wikitext FROM part WHERE p_partkey % 7 <> 0 AND p_partkey % 5 <> 0",
    "wiki_items": "SELECT p_name AS title, 'Q' || p_partkey AS qid FROM part WHERE p_partkey % 7 <> 0 AND p_partkey % 3 <> 0",
    "wiki_entities": """SELECT 'Q' || p_partkey AS qid, (p_partkey % 4)::INT AS sitelinks, CASE WHEN p_partkey % 3 <> 0 THEN (p_partkey % 90)::DOUBLE END AS lat, CASE WHEN p_partkey % 3 <> 0 THEN (p_partkey % 180)::DOUBLE END AS lng,
 CASE WHEN p_partkey % 2 = 0 THEN 'Q515|Q' || p_size ELSE '' END AS types, CASE WHEN p_partkey % 5 = 0 THEN 'Q30' END AS country FROM part""",
    "dump_lines": """SELECT 'Q' || p_partkey AS qid, p_name AS title, CASE WHEN p_partkey % 2 = 0 THEN p_type END AS blurb, (p_partkey % 4)::INT AS sitelinks, 'Q' || p_size AS types, CASE WHEN p_partkey % 3 = 0 THEN (p_partkey % 90)::DOUBLE END AS lat,
 '+' || (1500 + p_partkey % 500) || '-00-00T00:00:00Z' AS time FROM part WHERE p_partkey % 11 <> 0""",
    "seed_rows": f"""WITH {_KEYED}, s AS (SELECT * FROM e WHERE ingest_version LIKE 'seed-%' AND k % 3 <> 0) SELECT 'seed:' || lower(replace(title, ' ', '-')) || '-' || k AS id, title || ' ' || k AS title, date_start, scope, coalesce(notability, 0) AS notability, 'part' || (k % 4) AS file FROM s""",
    "fixed_window_limiter": """WITH RECURSIVE e AS (SELECT user_id::VARCHAR AS key, epoch_us(ts) // 1000 AS ts_ms, row_number() OVER (PARTITION BY user_id ORDER BY ts) AS i FROM events WHERE user_id IS NOT NULL),
s AS (SELECT key, ts_ms, i, ts_ms + 21600000 AS resets, 1::BIGINT AS c FROM e WHERE i = 1 UNION ALL
 SELECT e.key, e.ts_ms, e.i, CASE WHEN s.resets <= e.ts_ms THEN e.ts_ms + 21600000 ELSE s.resets END, CASE WHEN s.resets <= e.ts_ms THEN 1 ELSE s.c + 1 END FROM s JOIN e ON e.key = s.key AND e.i = s.i + 1)
SELECT key, ts_ms, c AS count, c <= 2 AS allowed, greatest(0, 2 - c) AS remaining, greatest(1, (resets - ts_ms + 999) // 1000) AS retry_after FROM s""",
}
