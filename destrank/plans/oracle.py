"""DuckDB SQL computing the same rows as each registered query.

Written independently of the Spark code path (window ``rank()``,
``string_agg``, ``arg_min``, ``row_number``) so that agreement means
something. Regex and JSON paths are the same fixed values.
"""

from __future__ import annotations

from destrank.functions import html as H
from destrank.functions.numeric import NUMERIC_TEXT, SIGNED_NUMBER
from destrank.functions.text import HOST_PATTERN


def _round(expr: str) -> str:
    return f"round(({expr}) + 1e-9, 4)"


def _coerce(expr: str) -> str:
    return f"CASE WHEN regexp_matches({expr}, '{NUMERIC_TEXT}') THEN TRY_CAST({expr} AS DOUBLE) END"


def _avg_rank(v: str, desc: bool = False) -> str:
    direction = "DESC" if desc else "ASC"
    return (
        f"CASE WHEN {v} IS NULL THEN NULL ELSE CAST(rank() OVER (ORDER BY {v} {direction} NULLS LAST)"
        f" + (count(*) OVER (PARTITION BY {v}) - 1) / 2.0 AS DOUBLE) END"
    )


def _capture(text: str, pattern: str) -> str:
    return _coerce(f"NULLIF(regexp_extract({text}, '{pattern}', 1), '')")


def _clean(fragment: str) -> str:
    out = f"regexp_replace({fragment}, '<[^>]*>', '', 'g')"
    for entity, char in H.ENTITIES:
        char_sql = char.replace("'", "''")
        out = f"replace({out}, '{entity}', '{char_sql}')"
    return f"regexp_replace({out}, '^\\s+|\\s+$', '', 'g')"


NOISE_FREE = f"regexp_replace(html, '{H.NOISE}', '', 'g')"


def _element_text(body: str, tag: str) -> str:
    return _clean(f"NULLIF(regexp_extract({body}, '(?is)<{tag}\\b[^>]*>(.*?)</{tag}\\s*>', 1), '')")


def _attribute(body: str, tag: str, attr: str) -> str:
    return f"NULLIF(regexp_extract({body}, '(?is)<{tag}\\b[^>]*?\\s{attr}\\s*=\\s*\"([^\"]*)\"', 1), '')"


USER_DAILY = """
SELECT CAST(user_id AS VARCHAR) AS city, strftime(ts, '%Y-%m-%d') AS date,
       min(value) AS temp_min, max(value) AS temp_max,
       avg(CAST(json_extract_string(props, '$.k') AS BIGINT)) AS humidity,
       max(value / 500.0) AS pop, arg_min(props, ts) AS description
FROM events GROUP BY 1, 2
"""

USER_MEANS = f"""
SELECT city, {_round('avg(temp_max)')} AS avg_temp_max, {_round('avg(humidity)')} AS avg_humidity,
       {_round('avg(pop)')} AS avg_pop
FROM ({USER_DAILY}) GROUP BY city
"""

NATION_WEATHER = """
SELECT CAST(c.c_nationkey AS VARCHAR) AS city, o.o_totalprice / 10000.0 AS temp_max,
       CAST(substr(o.o_orderpriority, 1, 1) AS INTEGER) * CAST(20.0 AS DOUBLE) AS humidity,
       CASE o.o_orderstatus WHEN 'F' THEN CAST(1.0 AS DOUBLE) WHEN 'P' THEN CAST(0.5 AS DOUBLE)
            ELSE CAST(0.0 AS DOUBLE) END AS pop
FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
"""

# The same with the day of every row in front.
NATION_DAYS = NATION_WEATHER.replace("SELECT ", "SELECT strftime(o.o_orderdate, '%Y-%m-%d') AS date, ", 1)

NATION_MEANS = f"""
SELECT city, {_round('avg(temp_max)')} AS avg_temp_max, {_round('avg(humidity)')} AS avg_humidity,
       {_round('avg(pop)')} AS avg_pop
FROM ({NATION_WEATHER}) GROUP BY city
"""


def _scores(means: str, wt: int, wr: int, wh: int) -> str:
    return f"""
SELECT city, avg_temp_max, avg_humidity, avg_pop, rank_temp, rank_rain, rank_humidity,
       CAST(rank_temp * {wt} + rank_rain * {wr} + rank_humidity * {wh} AS DOUBLE) AS score
FROM (SELECT *, {_avg_rank('avg_temp_max')} AS rank_temp, {_avg_rank('avg_pop', True)} AS rank_rain,
             {_avg_rank('avg_humidity', True)} AS rank_humidity
      FROM ({means}))
"""


NATION_TOP = f"SELECT city, score FROM ({_scores(NATION_MEANS, 5, 5, 5)}) ORDER BY score DESC NULLS LAST, city LIMIT 5"

EVENT_TYPE_DAILY = """
SELECT event_type AS city, strftime(ts, '%Y-%m-%d') AS date, min(value) AS temp_min, max(value) AS temp_max,
       {humidity} AS humidity, max(value / 500.0) AS pop, arg_min(props, ts) AS description{extra}
FROM events GROUP BY ALL
"""

PAGE_FIELDS = f"""
SELECT page_id,
       {_attribute('html', 'html', 'lang')} AS lang,
       {_element_text(NOISE_FREE, 'title')} AS title,
       {_element_text(NOISE_FREE, 'h1')} AS h1,
       {_attribute(NOISE_FREE, 'a', 'href')} AS first_href
FROM pages
"""

TRACK = _capture("html", f"track\\({SIGNED_NUMBER}\\)")

#: Column -> kind, per table: t(ext), i(nteger), f(loating) or o(ther).
COLUMNS = {
    "region": "r_regionkey i, r_name t",
    "nation": "n_nationkey i, n_name t, n_regionkey i",
    "customer": "c_custkey i, c_name t, c_nationkey i, c_acctbal f, c_mktsegment t",
    "supplier": "s_suppkey i, s_name t, s_nationkey i, s_acctbal f",
    "part": "p_partkey i, p_name t, p_brand t, p_type t, p_size i, p_retailprice f",
    "orders": "o_orderkey i, o_custkey i, o_orderstatus t, o_totalprice f, o_orderdate o, o_orderpriority t",
    "lineitem": "l_orderkey i, l_partkey i, l_suppkey i, l_linenumber i, l_quantity f, l_extendedprice f, l_discount f, "
    "l_tax f, l_returnflag t, l_linestatus t, l_shipdate o",
    "events": "event_id i, ts o, user_id i, event_type t, value f, props t",
    "documents": "doc_id i, text t, lang t, source t, n_chars i",
    "embeddings": "vec_id i, embedding o, label i",
    "pages": "page_id i, url t, html t",
    "benchmark": "item_id i, text t",
    "labels": "doc_id i, quality i, toxic i",
    "conversations": "conv_id i, turn i, role t, text t",
}


def _profile(table: str, column: str, kind: str) -> str:
    missing = f"{column} IS NULL" + (f" OR isnan({column})" if kind == "f" else "")
    length = f"strlen({column})" if kind == "t" else "CAST(NULL AS BIGINT)"
    few = f"d BETWEEN 1 AND 60 AND coalesce(hi, 0) <= 64 AND {kind in 'ti'}"
    return f"""SELECT '{table}' AS table_name, '{column}' AS column_name, n_rows, null_count, CAST(lo AS BIGINT) AS min_length,
  CAST(hi AS BIGINT) AS max_length, CASE WHEN {few} THEN v END AS top_value, CASE WHEN {few} THEN n END AS top_count
FROM (SELECT count(*) AS n_rows, count(*) FILTER (WHERE {missing}) AS null_count, min({length}) AS lo, max({length}) AS hi,
             count(DISTINCT {column}) AS d FROM {table})
LEFT JOIN (SELECT CAST({column} AS VARCHAR) AS v, count(*) AS n FROM {table} WHERE {column} IS NOT NULL GROUP BY 1
           ORDER BY n DESC, v LIMIT 1) ON true"""


ORACLE: dict[str, str] = {
    "recommendations": f"""
WITH w AS ({NATION_WEATHER}),
wa AS (SELECT city, avg(temp_max) AS avg_temp, avg(pop) AS avg_rain FROM w WHERE city IS NOT NULL GROUP BY city),
h AS (SELECT CAST(s_nationkey AS VARCHAR) AS city, avg(s_acctbal) AS avg_score FROM supplier GROUP BY 1)
SELECT city, {_round('avg_temp')} AS avg_temp, {_round('avg_rain')} AS avg_rain, {_round('avg_score')} AS avg_score,
       {_round('avg_temp - avg_rain * 10 + avg_score')} AS score
FROM wa JOIN h USING (city)
""",
    "daily_rollup": EVENT_TYPE_DAILY.format(
        humidity=_round("avg(CAST(json_extract_string(props, '$.k') AS BIGINT))"), extra=""
    ),
    "place_means": f"""
SELECT city, {_round('avg(temp_max)')} AS avg_temp_max, {_round('avg(temp_min)')} AS avg_temp_min,
       {_round('avg(humidity)')} AS avg_humidity, {_round('avg(pop)')} AS avg_pop
FROM ({USER_DAILY}) GROUP BY city
""",
    "union_rollups": EVENT_TYPE_DAILY.format(
        humidity=_round("avg(CAST(json_extract_string(props, '$.k') AS BIGINT))"),
        extra=", CASE WHEN ts < TIMESTAMP '2024-01-16 00:00:00' THEN 'first' ELSE 'second' END AS batch",
    ),
    "average_rank": f"""
SELECT l_orderkey, l_linenumber, l_quantity, {_avg_rank('l_quantity')} AS rank_qty FROM lineitem
""",
    "average_rank_desc": f"""
SELECT user_id, avg_value, {_avg_rank('avg_value', True)} AS rank_value_desc
FROM (SELECT user_id, {_round('avg(value)')} AS avg_value FROM events GROUP BY user_id)
""",
    "rank_sum": _scores(USER_MEANS, 1, 1, 1),
    "notebook_ranking": f"""
SELECT city, avg_temp_max, avg_temp_min, avg_humidity, avg_pop, rank_temp, rank_rain, rank_humidity,
       CAST(rank_temp + rank_rain + rank_humidity AS DOUBLE) AS score
FROM (SELECT *, {_avg_rank('avg_temp_max')} AS rank_temp, {_avg_rank('avg_pop', True)} AS rank_rain,
             {_avg_rank('avg_humidity', True)} AS rank_humidity
      FROM (SELECT city, {_round('avg(temp_max)')} AS avg_temp_max, {_round('avg(temp_min)')} AS avg_temp_min,
                   {_round('avg(humidity)')} AS avg_humidity, {_round('avg(pop)')} AS avg_pop
            FROM ({USER_DAILY}) GROUP BY city))
""",
    "weighted_score": _scores(USER_MEANS, 5, 5, 5),
    "weighted_score_10_0_3": _scores(USER_MEANS, 10, 0, 3),
    "top_places": f"SELECT * FROM ({_scores(USER_MEANS, 5, 5, 5)}) ORDER BY score DESC NULLS LAST, city LIMIT 5",
    "top_map": f"""
SELECT CAST(n.n_nationkey AS VARCHAR) AS city, CAST(n.n_regionkey AS DOUBLE) AS latitude,
       CAST(n.n_nationkey AS DOUBLE) AS longitude, t.score
FROM nation n JOIN ({NATION_TOP}) t ON CAST(n.n_nationkey AS VARCHAR) = t.city
""",
    "top_hotels": f"""
SELECT s_name AS name, CAST(s_nationkey AS VARCHAR) AS city, CAST(NULL AS DOUBLE) AS latitude,
       CAST(NULL AS DOUBLE) AS longitude, s_acctbal AS score
FROM supplier WHERE CAST(s_nationkey AS VARCHAR) IN (SELECT city FROM ({NATION_TOP}))
ORDER BY s_acctbal DESC NULLS LAST, 'https://hotels.example.com/' || CAST(s_suppkey AS VARCHAR) LIMIT 20
""",
    "preview": "SELECT * FROM part ORDER BY p_partkey LIMIT 5",
    "json_field": "SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events",
    "forecast_flatten": """
SELECT CAST(user_id AS VARCHAR) AS city, strftime(ts, '%Y-%m-%d') AS date, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS ts,
       value AS temp, CAST(json_extract_string(props, '$.k') AS BIGINT) AS humidity, value / 500.0 AS pop,
       event_type AS description
FROM events
WHERE CAST(user_id AS VARCHAR) IN (SELECT CAST(c_custkey AS VARCHAR) FROM customer
                                   WHERE c_acctbal IS NOT NULL AND c_nationkey IS NOT NULL)
""",
    "forecast_ingest": """
SELECT CAST(user_id AS VARCHAR) AS city, strftime(ts, '%Y-%m-%d') AS date, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS ts,
       value AS temp, CAST(json_extract_string(props, '$.k') AS BIGINT) AS humidity, value / 500.0 AS pop,
       event_type AS description
FROM events
""",
    "forecast_rollup": f"""
SELECT CAST(user_id AS VARCHAR) AS city, strftime(ts, '%Y-%m-%d') AS date, min(value) AS temp_min, max(value) AS temp_max,
       {_round("avg(CAST(json_extract_string(props, '$.k') AS BIGINT))")} AS humidity, max(value / 500.0) AS pop,
       arg_min(event_type, ts) AS description
FROM events
WHERE CAST(user_id AS VARCHAR) IN (SELECT CAST(c_custkey AS VARCHAR) FROM customer
                                   WHERE c_acctbal IS NOT NULL AND c_nationkey IS NOT NULL)
GROUP BY 1, 2
""",
    "json_salvage": """
SELECT user_id, CAST(sum(CAST(json_extract_string(props, '$.k') AS BIGINT)) AS BIGINT) AS k_sum, count(*) AS n_objects
FROM events WHERE event_type <> 'error' GROUP BY user_id
""",
    "salvage_report": """
SELECT count(*) FILTER (WHERE event_type <> 'error') AS kept, count(*) FILTER (WHERE event_type = 'error') AS rejected
FROM events
""",
    "coerce_numeric": f"""
SELECT p_partkey, {_coerce("split_part(p_brand, '#', 2)")} AS brand_number, {_coerce('p_type')} AS type_number,
       p_retailprice AS price_number
FROM part
""",
    "capture_number": f"""
SELECT page_id, {TRACK} AS track_no,
       {_capture('html', H.LATITUDE_VAR + chr(92) + 's*=' + chr(92) + 's*' + SIGNED_NUMBER)} AS latitude,
       {_capture('html', H.LONGITUDE_VAR + chr(92) + 's*=' + chr(92) + 's*' + SIGNED_NUMBER)} AS longitude
FROM pages
""",
    "url_strip": "SELECT page_id, split_part(url, '?', 1) AS url FROM pages WHERE url IS NOT NULL AND url <> ''",
    "page_links": f"""
SELECT page_id, CAST(len(l) AS INTEGER) AS n_links, array_to_string(l, ' ') AS links
FROM (SELECT page_id, regexp_extract_all({NOISE_FREE}, '(?is)<a\\b[^>]*?\\shref\\s*=\\s*"([^"]*)"', 1) AS l FROM pages)
""",
    "page_extract": f"SELECT *, substring(title, 1, 20) AS title_preview FROM ({PAGE_FIELDS})",
    "page_blocks": f"""
SELECT page_id, CAST(i - 2 AS INTEGER) AS block_pos, {_attribute('parts[i]', 'a', 'href')} AS href,
       {_element_text('parts[i]', 'a')} AS label
FROM (SELECT page_id, parts, unnest(generate_series(2, len(parts))) AS i
      FROM (SELECT page_id, regexp_split_to_array({NOISE_FREE}, '(?i)<li\\b[^>]*>') AS parts FROM pages))
""",
    "text_join": "SELECT conv_id, string_agg(text, ' ' ORDER BY turn) AS text FROM conversations GROUP BY conv_id",
    "build_lookup_key": """
SELECT p_partkey, p_name || ', France' AS lookup_key,
       printf('https://www.booking.com/searchresults.html?ss=%s&lang=en-gb', url_encode(p_name)) AS search_url
FROM part
""",
    "zip_positions": """
WITH u AS (SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS pos, turn AS user_turn
           FROM conversations WHERE role = 'user'),
a AS (SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS pos, turn AS assistant_turn
      FROM conversations WHERE role = 'assistant')
SELECT COALESCE(u.conv_id, a.conv_id) AS conv_id, COALESCE(u.pos, a.pos) AS pos, u.user_turn, a.assistant_turn
FROM u FULL OUTER JOIN a ON u.conv_id = a.conv_id AND u.pos = a.pos
""",
    "geocode_left": """
WITH l AS (SELECT doc_id, quality, toxic FROM labels
           QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY quality, toxic) = 1)
SELECT d.doc_id, d.lang, l.quality, l.toxic FROM documents d LEFT JOIN l ON d.doc_id = l.doc_id
""",
    "detail_merge": f"""
WITH l AS (SELECT page_id, split_part(url, '?', 1) AS url FROM pages WHERE url IS NOT NULL AND url <> ''),
f AS (SELECT page_id, title FROM ({PAGE_FIELDS})),
d AS (SELECT split_part(p.url, '?', 1) AS url, f.title, {TRACK} AS track_no FROM pages p JOIN f USING (page_id)
      WHERE split_part(p.url, '?', 1) <> ''
      QUALIFY row_number() OVER (PARTITION BY split_part(p.url, '?', 1) ORDER BY p.page_id) = 1)
SELECT l.page_id, l.url, d.title, d.track_no FROM l LEFT JOIN d USING (url)
""",
    "dedup_by_url": f"""
SELECT host, page_id, url FROM (
  SELECT NULLIF(regexp_extract(url, '{HOST_PATTERN}', 1), '') AS host, page_id, url FROM pages)
WHERE host IS NOT NULL
QUALIFY row_number() OVER (PARTITION BY host ORDER BY page_id) = 1
""",
    "city_seed": """
SELECT event_type AS city, count(*) AS n_readings FROM events
WHERE event_type IN ('view', 'click', 'signup', 'error', 'purchase') GROUP BY 1
""",
    "sql_scan": "SELECT * FROM supplier",
    "csv_roundtrip": "SELECT * FROM conversations",
    "json_roundtrip": "SELECT * FROM pages",
    "row_count_report": " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, count(*) AS n_rows FROM {t}"
        for t in [
            "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
            "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
        ]
    ),
    "null_audit": " UNION ALL ".join(
        f"SELECT 'labelled' AS table_name, '{c}' AS column_name, "
        f"CAST(count(*) FILTER (WHERE {t}.{c} IS NULL) AS BIGINT) AS null_count "
        "FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id"
        for t, c in [("d", "doc_id"), ("d", "lang"), ("l", "quality"), ("l", "toxic")]
    ),
    "hotel_collection": """
WITH h AS (SELECT page_id, url, split_part(split_part(split_part(url, '//', 2), '/', 1), '?', 1) AS host FROM pages WHERE url LIKE '%//%'),
c AS (SELECT * FROM h QUALIFY row_number() OVER (PARTITION BY host ORDER BY page_id) = 1),
d AS (SELECT * FROM h WHERE url LIKE '%page=%' AND page_id % 4 <> 0 QUALIFY row_number() OVER (PARTITION BY host ORDER BY page_id) = 1)
SELECT CAST(c.page_id % 7 AS VARCHAR) AS city, 'Hotel ' || c.page_id AS name,
       CASE WHEN c.page_id % 3 <> 0 THEN (c.page_id % 10) || '.5' END AS score, 'https://' || c.host || '/hotel.html' AS url,
       'Room ' || d.page_id AS description, d.page_id + CAST(0.25 AS DOUBLE) AS latitude, -(d.page_id + CAST(0.5 AS DOUBLE)) AS longitude
FROM c LEFT JOIN d USING (host)
""",
    "full_batch": f"""
WITH w AS ({NATION_WEATHER}),
m AS (SELECT city, avg(temp_max) AS avg_temp_max, avg(humidity) AS avg_humidity, avg(pop) AS avg_pop FROM w GROUP BY city),
top AS (SELECT city, score FROM ({_scores('SELECT * FROM m', 5, 5, 5)}) ORDER BY score DESC NULLS LAST, city LIMIT 5),
s AS (SELECT CAST(s_nationkey AS VARCHAR) AS city, avg(s_acctbal) AS avg_score FROM supplier GROUP BY 1),
hotels AS (SELECT s_name AS row_key, s_acctbal AS score FROM supplier WHERE CAST(s_nationkey AS VARCHAR) IN (SELECT city FROM top)
           ORDER BY s_acctbal DESC NULLS LAST, 'https://hotels.example.com/' || CAST(s_suppkey AS VARCHAR) LIMIT 20),
written AS (
  SELECT 'recommendations' AS table_name, city AS row_key, avg_temp_max - avg_pop * 10 + avg_score AS score FROM m JOIN s USING (city)
  UNION ALL SELECT 'top_map', city, score FROM top JOIN nation ON CAST(n_nationkey AS VARCHAR) = city
  UNION ALL SELECT 'top_hotels', row_key, score FROM hotels)
SELECT table_name, row_key, {_round('score')} AS score, count(*) OVER (PARTITION BY table_name) AS n_rows FROM written
""",
    "landed_batch": f"""
WITH w AS (SELECT city, date, max(temp_max) AS temp_max, avg(humidity) AS humidity, max(pop) AS pop FROM ({NATION_DAYS})
           WHERE CAST(city AS INT) % 7 <> 3 GROUP BY city, date),
m AS (SELECT city, avg(temp_max) AS avg_temp_max, avg(humidity) AS avg_humidity, avg(pop) AS avg_pop FROM w GROUP BY city),
top AS (SELECT city, score FROM ({_scores('SELECT * FROM m', 5, 5, 5)}) ORDER BY score DESC NULLS LAST, city LIMIT 5),
s AS (SELECT CAST(s_nationkey AS VARCHAR) AS city, avg(s_acctbal) AS avg_score FROM supplier GROUP BY 1),
best AS (SELECT s_name AS row_key, s_acctbal AS score FROM supplier WHERE CAST(s_nationkey AS VARCHAR) IN (SELECT city FROM top)
         ORDER BY s_acctbal DESC NULLS LAST, 'https://hotels.example.com/' || CAST(s_suppkey AS VARCHAR) LIMIT 20),
r AS (SELECT city, avg_temp_max - avg_pop * 10 + avg_score AS score FROM m JOIN s USING (city)),
written AS (
  SELECT 'cities' AS table_name, CAST(n_nationkey AS VARCHAR) AS row_key,
         CASE WHEN n_nationkey % 7 <> 3 THEN CAST(n_regionkey AS DOUBLE) END AS score, CAST(NULL AS BIGINT) AS rank FROM nation
  UNION ALL SELECT 'weather', city || ' ' || date, temp_max, NULL FROM w
  UNION ALL SELECT 'hotels', s_name, s_acctbal, NULL FROM supplier
  UNION ALL SELECT 'city_recommendations', city, score, row_number() OVER (ORDER BY score DESC NULLS LAST, city) FROM r
  UNION ALL SELECT 'top_map', city, score, NULL FROM top
  UNION ALL SELECT 'top_hotels', row_key, score, NULL FROM best)
SELECT table_name, row_key, {_round('score')} AS score, rank, count(*) OVER (PARTITION BY table_name) AS n_rows,
       CAST(1 AS BIGINT) AS version FROM written
""",
    "tables_replaced": f"""
WITH w AS ({NATION_WEATHER}),
named AS (
  SELECT v AS version, 'cities' AS table_name, CAST(n_nationkey AS VARCHAR) AS row_key
  FROM nation, (SELECT unnest([1, 2])::BIGINT AS v)
  UNION ALL SELECT 1, 'weather', city FROM w WHERE pop = 1
  UNION ALL SELECT 2, 'weather', city FROM w
  UNION ALL SELECT 1, 'hotels', s_name FROM supplier
  UNION ALL SELECT 2, 'hotels', s_name FROM supplier WHERE s_acctbal > 0)
SELECT version, table_name, count(*) OVER (PARTITION BY version, table_name) AS n_rows, row_key FROM named
""",
    "csv_blocks": "SELECT doc_id, text, lang, source, n_chars FROM documents",
    "feed_objects": """
SELECT user_id, CASE event_type WHEN 'error' THEN '{error}' ELSE event_type END AS note, count(*) AS kept,
       CAST(0 AS BIGINT) AS rejected, CAST(sum(CAST(json_extract(props, '$.k') AS BIGINT)) AS BIGINT) AS sum_k
FROM events GROUP BY ALL
""",
    "forecast_newest": """
SELECT CAST(user_id AS VARCHAR) AS city, strftime(ts, '%Y-%m-%d') AS date, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS ts,
       v AS temp, CAST(json_extract(props, '$.k') AS BIGINT) AS humidity, v / 500.0::DOUBLE AS pop, event_type AS description
FROM (SELECT *, CASE WHEN event_id % 3 = 0 THEN value ELSE value + 1000 END AS v FROM events)
""",
    "column_profile": " UNION ALL ".join(
        f"({_profile(t, *column.split())})" for t, columns in COLUMNS.items() for column in columns.split(", ")
    ),
    "interactive_top": " UNION ALL ".join(
        f"(SELECT '{w}' AS weights, city, score FROM ({_scores(USER_MEANS, *w)}) ORDER BY score DESC NULLS LAST, city LIMIT 5)"
        for w in [(5, 5, 5), (10, 0, 3), (0, 0, 1), (1, 9, 0), (0, 0, 0)]
    ),
    "nearest_place": """
WITH s AS (SELECT CAST(s_suppkey AS VARCHAR) AS city, s_acctbal AS v, s_nationkey AS g FROM supplier),
c AS (SELECT CAST(c_custkey AS VARCHAR) AS city, c_acctbal AS v, c_nationkey AS g FROM customer),
spots AS (SELECT 's' AS side, * FROM s UNION ALL SELECT 'c', * FROM c),
degrees AS (
  SELECT side, city, fmod(fmod(v, 180.0::DOUBLE) + 180.0::DOUBLE, 180.0::DOUBLE) - 90 AS lat,
         fmod(fmod(v * 7 + g * 13, 360.0::DOUBLE) + 360.0::DOUBLE, 360.0::DOUBLE) - 180 AS lon FROM spots),
sphere AS (SELECT side, city, cos(radians(lat)) * cos(radians(lon)) AS x, cos(radians(lat)) * sin(radians(lon)) AS y,
                  sin(radians(lat)) AS z FROM degrees),
pairs AS (
  SELECT p.city, q.city AS nearest, (p.x - q.x) * (p.x - q.x) + (p.y - q.y) * (p.y - q.y) + (p.z - q.z) * (p.z - q.z) AS d
  FROM sphere p JOIN sphere q ON p.side = 's' AND q.side = 'c')
SELECT city, nearest, round(2 * 6371.0088::DOUBLE * asin(least(sqrt(d) / 2, 1.0)), 3) AS distance_km
FROM pairs QUALIFY row_number() OVER (PARTITION BY city ORDER BY d, nearest) = 1
""",
    "nearest_name": """
WITH t AS (
  SELECT p_partkey, upper(p_name[1:p_partkey % length(p_name)]) || p_name[p_partkey % length(p_name) + 2:] ||
         CASE WHEN p_partkey % 3 = 0 THEN 'x' WHEN p_partkey % 7 = 0 THEN 'xyz' ELSE '' END AS text FROM part),
n AS (SELECT p_name AS name, min(p_partkey) AS key FROM part GROUP BY 1),
a AS (SELECT DISTINCT trim(lower(text)) AS asked FROM t),
best AS (
  SELECT asked, key, levenshtein(regexp_replace(asked, ' +', ' ', 'g'), name) AS edits FROM a JOIN n ON true
  QUALIFY row_number() OVER (PARTITION BY asked ORDER BY edits, key) = 1)
SELECT p_partkey, text, CASE WHEN edits <= 2 THEN key END AS found,
       CASE WHEN edits <= 2 THEN CAST(edits AS INTEGER) END AS found_edits
FROM t JOIN best ON trim(lower(text)) = asked
""",
}
