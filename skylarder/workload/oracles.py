"""Each query's result stated as SQL, independent of how the operators compute it."""

from __future__ import annotations

ORACLES: dict[str, str] = {}

_TEMPERATURE = """CASE WHEN event_type = 'error' THEN NULL
     WHEN value < 1 THEN 0.0::DOUBLE ELSE value % 50 - 5 END"""


def _prep_time(name: str) -> str:
    def has(words: str) -> str:
        return " OR ".join(f"contains(lower({name}), '{w}')" for w in words.split())

    base = f"(length({name}) % 20 + 20)"
    return f"""CASE WHEN {name} IS NULL OR {name} = '' THEN 30
     WHEN {has('soup stew roast casserole')} THEN least(120, {base} + 60)
     WHEN {has('salad sandwich pancake')} THEN greatest(10, {base} - 10)
     ELSE {base} + 15 END::INTEGER"""


def _clean_steps(text: str) -> str:
    return f"""coalesce(array_to_string(list_filter(list_transform(
     string_split(replace({text}, chr(13) || chr(10), chr(10)), chr(10)),
     lambda x: trim(x)), lambda x: x <> '')[1:10], '; '), '')"""


def _category(t: str) -> str:
    return f"""CASE WHEN {t} IS NULL THEN NULL WHEN {t} < 5 THEN 'cold' WHEN {t} < 15 THEN 'cool'
     WHEN {t} < 25 THEN 'moderate' WHEN {t} < 35 THEN 'warm' ELSE 'hot' END"""


def _half_even(x: str, digits: int) -> str:
    return f"CAST(printf('%.{digits}f', {x}) AS DOUBLE)"


def _size(n: str) -> str:
    n = f"({n})::DOUBLE"
    return f"""CASE WHEN {n} < 1024 THEN printf('%.1f B', {n})
     WHEN {n} < 1024.0**2 THEN printf('%.1f KB', {n} / 1024)
     WHEN {n} < 1024.0**3 THEN printf('%.1f MB', {n} / 1024.0**2)
     WHEN {n} < 1024.0**4 THEN printf('%.1f GB', {n} / 1024.0**3)
     ELSE printf('%.1f TB', {n} / 1024.0**4) END"""


def _slot(key: str, table: str) -> str:
    digits = f"substr(md5({key}::VARCHAR || '|menu'), 1, 15)"
    return f"('0x' || {digits})::BIGINT % (SELECT count(*) FROM {table})"


_NUMBERED_PARTS = """SELECT *, row_number() OVER (
     ORDER BY md5(p_partkey::VARCHAR), p_partkey) - 1 AS pos FROM part"""

_SIZE_ADVICE = """SELECT p_size AS k, arg_min(p_name, p_partkey) AS v, min(p_partkey) AS p
     FROM part GROUP BY p_size"""


ORACLES["prep_time"] = f"SELECT p_partkey, {_prep_time('p_name')} AS minutes FROM part"

ORACLES["prep_time_documents"] = (
    f"SELECT doc_id, {_prep_time('text')} AS minutes FROM documents"
)

ORACLES["clean_steps"] = f"SELECT doc_id, {_clean_steps('text')} AS steps FROM documents"

ORACLES["wide_pairs"] = """
SELECT p_partkey, array_to_string(list_filter([
    CASE WHEN p_type = 'SMALL' THEN p_brand ELSE p_brand || ': ' || p_type END,
    CASE WHEN p_name <> 'blue bolt' THEN p_name || ': ' || p_size END,
    CASE WHEN p_type <> 'PROMO' THEN p_type || ': ' END
  ], lambda x: x IS NOT NULL), '; ') AS pairs
FROM part"""

ORACLES["temp_category"] = f"""
SELECT event_id, {_category('t')} AS category
FROM (SELECT event_id, {_TEMPERATURE} AS t FROM events)"""

ORACLES["fallback_advice"] = f"""
SELECT event_id, CASE WHEN t IS NULL THEN NULL
  WHEN t < 10 THEN 'Perfect weather for hot soups and warm comfort food!'
  WHEN t < 20 THEN 'Great weather for hearty meals and moderate cooking!'
  WHEN t < 30 THEN 'Pleasant weather for fresh dishes and light cooking!'
  ELSE 'Hot weather - perfect for cold dishes and minimal cooking!' END AS advice
FROM (SELECT event_id, {_TEMPERATURE} AS t FROM events)"""

ORACLES["normalise_measures"] = f"""
SELECT l_orderkey, l_linenumber, {_half_even('l_extendedprice * l_discount', 1)} AS measure,
  {_half_even('l_extendedprice / 1000', 4)} AS coordinate,
  {_half_even('l_quantity / 2', 0)}::BIGINT AS elevation
FROM lineitem"""

ORACLES["format_size"] = f"""
SELECT doc_id, {_size('n_chars')} AS size, {_size('n_chars * n_chars * 64')} AS large_size,
  {_size('n_chars * n_chars * n_chars * 256')} AS huge_size
FROM documents"""

ORACLES["layer_route"] = """
SELECT page_id, CASE WHEN contains(url, '/en/') THEN 'raw' WHEN contains(url, '/fr/') THEN 'formatted'
  WHEN contains(url, '/de/') THEN 'usage' ELSE 'backup' END AS layer
FROM pages"""

ORACLES["snapshot_names"] = """
SELECT event_id, strftime(ts, 'raw_weather_%Y%m%d_%H%M%S.json') AS name,
  strftime(ts, '%Y-%m-%d %H:%M:%S') AS parsed
FROM events"""

ORACLES["time_texts"] = """
SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S+00:00') AS iso, strftime(ts, '%Y-%m-%d') AS day,
  strftime(ts, '%Y-%m-%d %H:%M:%S') AS plain
FROM events"""

ORACLES["repair_timezone"] = "SELECT c_custkey, c_mktsegment AS timezone FROM customer"

ORACLES["json_records"] = """
SELECT event_id, '{"event_type":"' || event_type || '","kind":'
  || CASE WHEN event_type = 'view' THEN 'null' ELSE '"' || event_type || '"' END
  || ',"value":' || value::VARCHAR || '}' AS record
FROM events"""

ORACLES["json_parse"] = """
SELECT event_id, CASE WHEN event_type <> 'error' THEN (props->>'k')::INTEGER END AS k,
  (event_type = 'error')::INTEGER AS is_broken
FROM events"""

ORACLES["empty_to_null"] = """
SELECT doc_id, CASE WHEN lang <> 'fr' THEN lang END AS lang,
  CASE WHEN source = 'src1' THEN ' ' ELSE source END AS source
FROM documents"""

ORACLES["null_gate"] = f"""
SELECT event_id, t AS temperature FROM (SELECT event_id, {_TEMPERATURE} AS t FROM events)
WHERE t IS NOT NULL AND t <> 0"""

ORACLES["dq_nulls"] = """
SELECT count(*) AS total, count(*) FILTER (ts IS NULL) AS ts_nulls,
  count(*) FILTER (event_type = 'error') AS temperature_nulls,
  count(*) FILTER (event_type = 'view') AS kind_nulls
FROM events"""

ORACLES["time_grid_zip"] = """
SELECT vec_id, 1704067200 + vec_id * 86400 + i * 3600 AS at, embedding[i + 1]::DOUBLE AS value
FROM embeddings, range(72) r(i)
WHERE i < least(64, CASE WHEN label < 5 THEN 24 ELSE 72 END)"""

ORACLES["renest"] = """
SELECT conv_id, part, any_value(total) AS total, count(*) AS n,
  string_agg(role || ': ' || text, chr(10) ORDER BY turn) AS transcript
FROM (SELECT *, count(*) OVER (PARTITION BY conv_id) AS total,
        (row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1) // 3 AS part FROM conversations)
GROUP BY conv_id, part"""

ORACLES["explode_series"] = "SELECT conv_id, turn, role, text FROM conversations"

ORACLES["envelope_check"] = """
SELECT count(*) AS found, count(*) AS declared, true AS consistent FROM conversations"""

ORACLES["number_rows"] = """
SELECT o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) - 1 AS pos,
  count(*) OVER (PARTITION BY o_custkey) AS orders
FROM orders"""

ORACLES["nearest_advice"] = f"""
WITH a AS ({_SIZE_ADVICE}), e AS (SELECT event_id, {_TEMPERATURE} AS t FROM events)
SELECT event_id, t AS temperature,
  CASE WHEN t IS NOT NULL THEN (SELECT arg_min(v, {{'d': abs(k - t), 'p': p}}) FROM a) END AS advice
FROM e"""

ORACLES["nearest_price"] = """
WITH a AS (SELECT p_retailprice AS k, arg_min(p_name, p_partkey) AS v, min(p_partkey) AS p
           FROM part GROUP BY p_retailprice),
  i AS (SELECT l_orderkey, l_linenumber, l_extendedprice / l_quantity AS t FROM lineitem)
SELECT l_orderkey, l_linenumber, t AS unit_price, arg_min(v, {'d': abs(k - t), 'p': p}) AS part_name
FROM i, a GROUP BY l_orderkey, l_linenumber, t"""

ORACLES["random_pick"] = f"""
SELECT o_orderkey, p_partkey, p_name
FROM (SELECT o_orderkey, {_slot('o_orderkey', 'part')} AS slot FROM orders)
  JOIN ({_NUMBERED_PARTS}) ON pos = slot"""

_GEO = """SELECT n_nationkey, CASE WHEN n_regionkey = 4 THEN 'Unknown Location' ELSE
    CASE WHEN n_regionkey = 0 OR n_name <> 'NATION_1' THEN n_name ELSE 'Unknown' END
    || ', ' || CASE WHEN n_regionkey = 2 THEN 'Unknown' ELSE r_name END END AS place
  FROM nation JOIN region ON n_regionkey = r_regionkey"""

ORACLES["place_name"] = f"""
SELECT c_custkey, coalesce(place, 'Unknown Location') AS place
FROM customer LEFT JOIN ({_GEO}) ON c_nationkey = n_nationkey"""

ORACLES["dedup_first"] = """
SELECT * FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) = 1"""

ORACLES["union_dedup"] = """
SELECT 'a' AS shard, item_id AS id, text FROM benchmark
UNION ALL
SELECT 'b', doc_id, text FROM documents WHERE doc_id NOT IN (SELECT item_id FROM benchmark)"""

ORACLES["duplicate_report"] = """
SELECT count(*) AS total, count(*) - count(DISTINCT (event_type, value)) AS duplicates,
  count(DISTINCT (event_type, value)) AS distinct_patterns
FROM events"""

ORACLES["duplicate_examples"] = """
WITH g AS (SELECT event_type, user_id, count(*) AS times, min(event_id) AS first
           FROM events GROUP BY event_type, user_id HAVING count(*) > 1 ORDER BY first LIMIT 1)
SELECT any_value(times) AS times,
  array_to_string(list(strftime(ts, '%Y-%m-%d %H:%M:%S') ORDER BY event_id)[1:5], ', ') AS first_times
FROM events JOIN g USING (event_type, user_id)"""

ORACLES["latest_snapshot"] = """
SELECT * FROM orders QUALIFY rank() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC) = 1"""

ORACLES["latest_snapshot_all"] = """
SELECT * FROM orders WHERE o_orderdate = (SELECT max(o_orderdate) FROM orders)"""

ORACLES["storage_inventory"] = f"""
SELECT source, files, bytes, {_size('bytes')} AS size
FROM (SELECT source, count(*) AS files, sum(n_chars)::BIGINT AS bytes FROM documents GROUP BY ROLLUP (source))"""

ORACLES["inventory_diff"] = f"""
SELECT layer, files_removed, bytes_freed, {_size('bytes_freed')} AS size_freed FROM (
  SELECT lang AS layer, count(*) FILTER (q.doc_id IS NULL) AS files_removed,
    coalesce(sum(n_chars) FILTER (q.doc_id IS NULL), 0)::BIGINT AS bytes_freed
  FROM documents d LEFT JOIN (SELECT DISTINCT doc_id FROM labels) q USING (doc_id)
  GROUP BY ROLLUP (lang))"""

ORACLES["throttle"] = """
WITH RECURSIVE kept AS (
  SELECT * FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) = 1
  UNION ALL
  SELECT n.* FROM (
    SELECT e.*, row_number() OVER (PARTITION BY e.user_id ORDER BY e.ts, e.event_id) AS rn
    FROM kept k JOIN events e ON e.user_id = k.user_id AND e.ts >= k.ts + INTERVAL 1 DAY
  ) t, LATERAL (SELECT t.event_id, t.ts, t.user_id, t.event_type, t.value, t.props) n
  WHERE rn = 1
)
SELECT * FROM kept"""

ORACLES["format_meals"] = f"""
SELECT p_partkey::VARCHAR AS meal_id, p_name AS meal_name, p_brand AS category, p_type AS region,
  array_to_string(list_filter([
    CASE WHEN p_type = 'SMALL' THEN p_brand ELSE p_brand || ': ' || p_type END,
    CASE WHEN p_type <> 'ECONOMY' THEN p_type || ': ' || p_size END,
    CASE WHEN p_type <> 'PROMO' THEN p_name || ': ' END
  ], lambda x: x IS NOT NULL), '; ') AS ingredients,
  {_clean_steps('text')} AS instructions, {_prep_time('p_name')} AS preparation_time,
  'img/' || p_partkey AS image_url, '2024-12-19' AS processed_date,
  '2024-12-19T15:30:45' AS processed_timestamp
FROM part LEFT JOIN documents ON p_partkey = doc_id
WHERE p_name <> 'red widget'"""

ORACLES["land_meals"] = """
SELECT p_partkey::VARCHAR AS "idMeal", p_brand AS "strCategory", text AS "strInstructions",
  '20241219_153045' AS fetch_timestamp
FROM part LEFT JOIN documents ON p_partkey = doc_id"""

ORACLES["normalise_weather"] = f"""
SELECT vec_id, {_half_even('embedding[1]::DOUBLE * 90', 4)} AS latitude,
  {_half_even('embedding[2]::DOUBLE * 180', 4)} AS longitude,
  {_half_even('embedding[3]::DOUBLE * 1000', 0)}::BIGINT AS elevation,
  strftime(day, '%Y-%m-%dT%H:%M:%S+00:00') AS current_time,
  {_half_even('embedding[6]::DOUBLE', 1)} AS wind_speed,
  strftime(day, '%Y-%m-%d') AS day, {_half_even('embedding[7]::DOUBLE', 1)} AS uv,
  strftime(day + to_hours(i), '%Y-%m-%dT%H:%M:%S+00:00') AS time,
  {_half_even('embedding[i + 1]::DOUBLE', 1)} AS temperature_2m
FROM (SELECT *, TIMESTAMP '2024-01-01' + to_days(vec_id::INTEGER) AS day FROM embeddings), range(24) r(i)"""

ORACLES["format_weather"] = f"""
SELECT c_custkey, coalesce(place, 'Unknown Location') AS name, c_nationkey * 2.0::DOUBLE AS latitude,
  c_mktsegment AS timezone, c_acctbal AS temperature, '2024-12-19T15:30:45' AS formatted_timestamp
FROM customer LEFT JOIN ({_GEO}) ON c_nationkey = n_nationkey"""

_LOCATION = """coalesce(nullif(c_mktsegment, 'HOUSEHOLD'), 'UTC') AS timezone,
  coalesce(nullif(c_name, 'Customer#000000007'), 'Unknown') AS location,
  c_nationkey * 2.5::DOUBLE AS latitude, c_custkey / 4.0::DOUBLE AS longitude"""

ORACLES["timeseries"] = f"""
SELECT strftime(ts, '%Y-%m-%d %H:%M:%S') AS "@timestamp", {_TEMPERATURE} AS temperature, {_LOCATION}
FROM events LEFT JOIN customer ON user_id = c_custkey"""

ORACLES["recommend"] = f"""
WITH a AS ({_SIZE_ADVICE}), m AS ({_NUMBERED_PARTS}),
  e AS (SELECT *, {_TEMPERATURE} AS t, {_slot('event_id', 'part')} AS slot FROM events),
  advised AS (SELECT event_id, arg_min(v, {{'d': abs(k - t), 'p': p}}) AS recommended_advice
              FROM e, a WHERE t IS NOT NULL GROUP BY event_id)
SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS "@timestamp", {_LOCATION},
  t AS current_temperature, value % 100 AS relative_humidity, value / 8 AS wind_speed,
  recommended_advice, {_category('t')} AS temperature_category,
  CASE WHEN event_type <> 'view' THEN value % 12 END AS uv_index_max,
  p_name AS suggested_meal, {_prep_time('p_name')}::VARCHAR || ' minutes' AS preparation_time,
  p_type AS instructions, p_brand || ': ' || p_size AS ingredients,
  p_brand AS meal_category, p_type AS meal_region
FROM e JOIN advised USING (event_id) JOIN m ON m.pos = slot
  LEFT JOIN customer ON user_id = c_custkey"""

ORACLES["index_docs"] = """
SELECT event_id, event_type, strftime(ts, '%Y-%m-%d %H:%M:%S') AS at,
  md5(event_id::VARCHAR || '|' || event_type || '|' || strftime(ts, '%Y-%m-%d %H:%M:%S')) AS doc_id
FROM events WHERE event_type <> 'purchase'"""

ORACLES["stream_dedup"] = "SELECT DISTINCT user_id FROM events"

ORACLES["stream_first_seen"] = """
SELECT user_id, event_id, event_type
FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) = 1"""

ORACLES["stream_throttle"] = f"SELECT event_id, user_id FROM ({ORACLES['throttle']})"

ORACLES["stream_recommend"] = ORACLES["recommend"]

ORACLES["nearest_place"] = """
WITH c AS (SELECT c_custkey, radians(c_custkey * 37 % 181 - 90.0::DOUBLE) AS la,
             radians(c_custkey * 73 % 361 - 180.0::DOUBLE) AS lo FROM customer),
  s AS (SELECT s_name,
          radians(CASE WHEN s_suppkey % 3 = 0 THEN 48 + s_suppkey * 0.0001::DOUBLE ELSE s_suppkey * 17 % 181 - 90.0 END) AS pa,
          radians(CASE WHEN s_suppkey % 3 = 0 THEN 2 + s_suppkey * 0.0001::DOUBLE ELSE s_suppkey * 101 % 361 - 180.0 END) AS po
        FROM supplier),
  d AS (SELECT c_custkey, s_name, round(2 * 6371008.8::DOUBLE * asin(least(1.0::DOUBLE, sqrt(
          sin((pa - la) / 2) ** 2 + cos(la) * cos(pa) * sin((po - lo) / 2) ** 2))))::BIGINT AS m FROM c, s)
SELECT c_custkey, arg_min(s_name, {'m': m, 'n': s_name}) AS place, min(m) AS metres FROM d GROUP BY c_custkey"""

ORACLES["as_of_menu"] = """
WITH o AS (SELECT o_custkey, o_orderdate, max(o_orderkey) AS o_orderkey FROM orders GROUP BY ALL),
  e AS (SELECT event_id, user_id, TIMESTAMP '1995-01-01' + to_days((event_id * 7 % 2500)::INTEGER) AS read_at FROM events)
SELECT event_id, o_orderkey, o_orderdate
FROM e ASOF LEFT JOIN o ON user_id = o_custkey AND read_at >= o_orderdate"""

_DIGITS = "('0x' || substr(md5(event_id::VARCHAR || '|menu'), 1, 15))::BIGINT"

ORACLES["recommend_history"] = f"""
WITH a AS ({_SIZE_ADVICE}),
  d AS (SELECT *, TIMESTAMP '2024-01-03' + to_days((p_size % 9 * 3)::INTEGER) AS snap FROM part),
  m AS (SELECT *, row_number() OVER (PARTITION BY snap ORDER BY md5(p_partkey::VARCHAR), p_partkey) - 1 AS pos,
          count(*) OVER (PARTITION BY snap) AS n FROM d),
  s AS (SELECT DISTINCT snap, n FROM m),
  e AS (SELECT events.*, {_TEMPERATURE} AS t, snap, {_DIGITS} % n AS slot
        FROM events ASOF LEFT JOIN s ON ts >= s.snap),
  advised AS (SELECT event_id, arg_min(v, {{'d': abs(k - t), 'p': p}}) AS recommended_advice
              FROM e, a WHERE t IS NOT NULL GROUP BY event_id)
SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS "@timestamp", {_LOCATION},
  t AS current_temperature, value % 100 AS relative_humidity, value / 8 AS wind_speed,
  recommended_advice, {_category('t')} AS temperature_category,
  CASE WHEN event_type <> 'view' THEN value % 12 END AS uv_index_max,
  p_name AS suggested_meal, CASE WHEN p_name IS NOT NULL THEN {_prep_time('p_name')}::VARCHAR || ' minutes' END AS preparation_time,
  p_type AS instructions, p_brand || ': ' || p_size AS ingredients,
  p_brand AS meal_category, p_type AS meal_region
FROM e JOIN advised USING (event_id) LEFT JOIN m ON m.snap = e.snap AND m.pos = e.slot
  LEFT JOIN customer ON user_id = c_custkey"""

ORACLES["index_recommendations"] = f"""
SELECT DISTINCT strftime(ts, '%Y-%m-%d %H:%M:%S') AS "@timestamp", location, latitude, longitude,
  strftime(ts, '%Y-%m-%d') AS day
FROM (SELECT ts, {_TEMPERATURE} AS t, {_LOCATION} FROM events LEFT JOIN customer ON user_id = c_custkey)
WHERE t IS NOT NULL"""

ORACLES["stream_throttle_keyed"] = ORACLES["stream_throttle"]

ORACLES["stream_first_seen_keyed"] = ORACLES["stream_first_seen"]

_AS_FLOAT = "CAST({} AS FLOAT)::DOUBLE"

ORACLES["stream_lake"] = f"""
WITH RECURSIVE e AS (SELECT event_id, user_id, date_trunc('second', ts) AS moment, event_type, value FROM events),
  kept AS (
    SELECT * FROM e QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY moment, event_id) = 1
    UNION ALL
    SELECT n.* FROM (
      SELECT e.*, row_number() OVER (PARTITION BY e.user_id ORDER BY e.moment, e.event_id) AS rn
      FROM kept k JOIN e ON e.user_id = k.user_id AND e.moment >= k.moment + INTERVAL 1 DAY
    ) t, LATERAL (SELECT t.event_id, t.user_id, t.moment, t.event_type, t.value) n
    WHERE rn = 1
  ),
  a AS ({_SIZE_ADVICE}),
  m AS (SELECT *, row_number() OVER (ORDER BY md5(meal_id), meal_id) - 1 AS pos FROM ({ORACLES['format_meals']})),
  r AS (SELECT *, {_half_even(_AS_FLOAT.format('(' + _TEMPERATURE + ')'), 1)} AS t,
          coalesce(c_name || ', ' || c_mktsegment, 'Unknown Location') AS location,
          user_id % 25 * 2.0::DOUBLE AS latitude, user_id / 4.0::DOUBLE AS longitude
        FROM kept LEFT JOIN customer ON user_id = c_custkey),
  k AS (SELECT *, location || '|' || latitude::VARCHAR || '|' || longitude::VARCHAR || '|'
          || strftime(moment, '%Y-%m-%dT%H:%M:%S+00:00') AS key FROM r),
  advised AS (SELECT event_id, arg_min(v, {{'d': abs(a.k - t), 'p': p}}) AS recommended_advice
              FROM k, a WHERE t IS NOT NULL GROUP BY event_id)
SELECT strftime(moment, '%Y-%m-%d %H:%M:%S') AS "@timestamp", 'Etc/UTC' AS timezone, t AS current_temperature,
  {_half_even(_AS_FLOAT.format('value % 100'), 1)} AS relative_humidity,
  {_half_even(_AS_FLOAT.format('value / 8'), 1)} AS wind_speed,
  location, latitude, longitude, recommended_advice, {_category('t')} AS temperature_category,
  {_half_even(_AS_FLOAT.format('value % 12'), 1)} AS uv_index_max,
  meal_name AS suggested_meal, m.preparation_time::VARCHAR || ' minutes' AS preparation_time,
  instructions, ingredients, category AS meal_category, region AS meal_region
FROM k JOIN advised USING (event_id)
  JOIN m ON m.pos = ('0x' || substr(md5(key || '|menu'), 1, 15))::BIGINT % (SELECT count(*) FROM m)"""
