"""Independent DuckDB SQL for every registered query (the correctness oracle).

Each statement starts from the driver's raw tables and rebuilds the mapped
inputs itself, so it shares no code with the Spark side.
"""

from __future__ import annotations

# Category id -> name (same table as functions.categories).
_CATEGORIES = """(VALUES (1,'Film & Animation'),(2,'Autos & Vehicles'),(10,'Music'),
 (15,'Pets & Animals'),(17,'Sports'),(18,'Short Movies'),(19,'Travel & Events'),(20,'Gaming'),
 (21,'Videoblogging'),(22,'People & Blogs'),(23,'Comedy'),(24,'Entertainment'),
 (25,'News & Politics'),(26,'Howto & Style'),(27,'Education'),(28,'Science & Technology'),
 (29,'Nonprofits & Activism'),(30,'Movies'),(31,'Anime/Animation'),(32,'Action/Adventure'),
 (33,'Classics'),(34,'Comedy'),(35,'Documentary'),(36,'Drama'),(37,'Family'),(38,'Foreign'),
 (39,'Horror'),(40,'Sci-Fi/Fantasy'),(41,'Thriller'),(42,'Shorts'),(43,'Shows'),(44,'Trailers'))
 AS cat(cid, cname)"""

OBS = f"""
WITH raw AS (
  SELECT r.r_name AS region_code,
         CAST(l.l_partkey AS VARCHAR) AS video_id,
         p.p_name AS title,
         CAST(o.o_orderdate AS TIMESTAMP) AS published_at,
         CAST(l.l_suppkey AS VARCHAR) AS channel_id,
         s.s_name AS channel_title,
         p.p_size AS category_id,
         CAST(l.l_shipdate AS DATE) AS trending_date,
         CASE WHEN p.p_size % 10 = 0 THEN p.p_brand
              ELSE replace(p.p_name, ' ', '|') || '|' || p.p_brand || '|' || p.p_type END AS tags,
         CAST(floor(l.l_extendedprice) AS BIGINT) AS view_count,
         CAST(floor(l.l_quantity) AS BIGINT) AS likes,
         CAST(l.l_linenumber AS BIGINT) AS dislikes,
         CAST(floor(l.l_extendedprice * l.l_discount / 1000) AS BIGINT) AS comment_count,
         'PT' || CASE WHEN p.p_size > 40 THEN '1H' ELSE '' END || CAST(p.p_size AS VARCHAR) || 'M'
              || CAST(CAST(floor(l.l_quantity) AS BIGINT) AS VARCHAR) || 'S' AS duration
  FROM lineitem l
  JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN nation n ON c.c_nationkey = n.n_nationkey
  JOIN region r ON n.n_regionkey = r.r_regionkey
  JOIN part p ON l.l_partkey = p.p_partkey
  JOIN supplier s ON l.l_suppkey = s.s_suppkey
),
obs AS (
  SELECT raw.* EXCLUDE (duration),
         COALESCE(cat.cname, 'Unknown') AS category_name,
         CAST(COALESCE(TRY_CAST(regexp_extract(duration, 'PT(\\d+)H', 1) AS INTEGER), 0) * 3600
            + COALESCE(TRY_CAST(regexp_extract(duration, 'PT(?:\\d+H)?(\\d+)M', 1) AS INTEGER), 0) * 60
            + COALESCE(TRY_CAST(regexp_extract(duration, 'PT(?:\\d+H)?(?:\\d+M)?(\\d+)S', 1) AS INTEGER), 0)
            AS INTEGER) AS duration_seconds,
         CASE WHEN view_count > 0 THEN (likes + comment_count) / view_count ELSE 0.0 END AS engagement
  FROM raw LEFT JOIN {_CATEGORIES} ON raw.category_id = cat.cid
  WHERE view_count <= 25000000000
)
"""

# Stream mapping over `events`: 1-hour windows, history before 06:00 on day one.
EV = """
WITH ev AS (
  SELECT ts AS event_time,
         CAST(user_id AS VARCHAR) AS video_id,
         CAST(user_id % 50 AS VARCHAR) AS channel_id,
         'Channel#' || CAST(user_id % 50 AS VARCHAR) AS channel_title,
         event_type AS region_code,
         value AS view_count,
         CAST(regexp_extract(props, '"k":\\s*(\\d+)', 1) AS BIGINT) * 60 AS duration_sec,
         time_bucket(INTERVAL '1 hour', ts) AS ws
  FROM events
),
hist AS (SELECT * FROM ev WHERE event_time < TIMESTAMP '2024-01-01 06:00:00')
"""

HALF_UP = "CAST((2 * sum(CAST(round({v} * 100) AS HUGEINT)) + count({v})) // (2 * count({v})) AS DOUBLE) / 100.0"

ORACLE: dict[str, str] = {
    "popularity_over_time": OBS + """
, daily AS (
  SELECT trending_date, avg(view_count) AS average_views,
         CAST(sum(view_count) AS BIGINT) AS total_views, count(video_id) AS video_count
  FROM obs GROUP BY trending_date)
SELECT trending_date, average_views, total_views, video_count,
       avg(average_views) OVER (ORDER BY trending_date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)
         AS moving_avg_7d
FROM daily ORDER BY trending_date""",
}

_R = "'ASIA'"

ORACLE.update({
    "top_categories": OBS + """
SELECT category_id, category_name, count(*) AS number_of_videos
FROM obs GROUP BY category_id, category_name
ORDER BY number_of_videos DESC, category_id ASC NULLS FIRST, category_name ASC NULLS FIRST LIMIT 10""",

    "top_engagement": OBS + """
SELECT channel_id, channel_title, max(engagement) AS peak_engagement
FROM obs GROUP BY channel_id, channel_title
ORDER BY peak_engagement DESC NULLS LAST, channel_id ASC NULLS FIRST, channel_title ASC NULLS FIRST LIMIT 20""",

    "view_count_change_per_day": OBS + f"""
, r AS (SELECT * FROM obs WHERE region_code = {_R})
, most AS (
  SELECT video_id, title, count(*) AS trending_days FROM r GROUP BY video_id, title
  ORDER BY trending_days DESC, video_id ASC NULLS FIRST, title ASC NULLS FIRST LIMIT 10)
, daily AS (
  SELECT video_id, trending_date AS date, max(view_count) AS view_count, max(title) AS title
  FROM r WHERE video_id IN (SELECT video_id FROM most) GROUP BY video_id, trending_date)
SELECT video_id, title, date, view_count,
       lag(view_count) OVER (PARTITION BY video_id ORDER BY date) AS previous_day_views,
       view_count - lag(view_count) OVER (PARTITION BY video_id ORDER BY date) AS views_difference
FROM daily""",

    "fastest_growth_videos": OBS + """
, daily AS (
  SELECT video_id, region_code, trending_date, max(view_count) AS view_count, max(title) AS title
  FROM obs GROUP BY video_id, region_code, trending_date)
, lagged AS (
  SELECT *, lag(view_count) OVER w AS prev_views, lag(trending_date) OVER w AS prev_date
  FROM daily WINDOW w AS (PARTITION BY video_id, region_code ORDER BY trending_date))
, growth AS (
  SELECT video_id, title, view_count - prev_views AS g FROM lagged
  WHERE prev_views IS NOT NULL AND date_diff('day', prev_date, trending_date) = 1
    AND view_count - prev_views BETWEEN 0 AND 200000000)
SELECT video_id, title, max(g) AS max_daily_views_growth FROM growth GROUP BY video_id, title
ORDER BY max_daily_views_growth DESC, video_id ASC NULLS FIRST, title ASC NULLS FIRST LIMIT 20""",

    "engagement_by_region": OBS + """
SELECT region_code, avg(engagement) AS average_engagement, avg(likes) AS average_likes,
       avg(comment_count) AS average_comments, avg(view_count) AS average_views
FROM obs GROUP BY region_code ORDER BY average_engagement DESC""",

    "regional_engagement": OBS + """
SELECT region_code, avg(engagement) AS average_engagement FROM obs GROUP BY region_code
ORDER BY average_engagement DESC NULLS LAST, region_code ASC NULLS FIRST LIMIT 20""",

    "top_tags": OBS + """
, t AS (SELECT unnest(string_split(tags, '|')) AS tag FROM obs WHERE tags IS NOT NULL)
SELECT tag, count(*) AS number_of_videos FROM t GROUP BY tag
ORDER BY number_of_videos DESC, tag ASC NULLS FIRST LIMIT 20""",

    "top_tag_combinations": OBS + f"""
, items AS (
  SELECT video_id, count(DISTINCT trending_date) AS trending_days, min(tags) AS tags
  FROM obs WHERE region_code = {_R} GROUP BY video_id)
, arr AS (SELECT trending_days, list_sort(string_split(tags, '|')) AS a FROM items WHERE tags IS NOT NULL)
, pairs AS (
  SELECT trending_days, a[i] || '|' || a[j] AS tag_pair
  FROM arr, generate_series(1, len(a)) AS g1(i), generate_series(1, len(a)) AS g2(j)
  WHERE i < j)
SELECT tag_pair, avg(trending_days) AS average_trending_days, count(*) AS video_count
FROM pairs GROUP BY tag_pair HAVING count(*) >= 20
ORDER BY average_trending_days DESC, tag_pair ASC NULLS FIRST LIMIT 20""",

    "avg_comments_per_category": OBS + """
SELECT category_id, category_name, avg(comment_count) AS average_comments
FROM obs GROUP BY category_id, category_name
ORDER BY average_comments DESC NULLS LAST, category_id ASC NULLS FIRST, category_name ASC NULLS FIRST
LIMIT 20""",

    "trending_by_day_of_week": OBS + """
SELECT CAST(dayofweek(trending_date) + 1 AS INTEGER) AS day_of_week, count(video_id) AS video_count,
       avg(view_count) AS average_views, avg(likes) AS average_likes,
       avg(dislikes) AS average_dislikes, avg(comment_count) AS average_comments,
       avg(engagement) AS average_engagement
FROM obs GROUP BY 1 ORDER BY 1""",

    "duration_vs_popularity": OBS + """
SELECT CASE WHEN duration_seconds < 240 THEN 'short (< 4 min)'
            WHEN duration_seconds <= 1200 THEN 'medium (4-20 min)'
            ELSE 'long (> 20 min)' END AS duration_length,
       avg(view_count) AS average_views
FROM obs GROUP BY 1 ORDER BY 1""",

    "hist_region_stats": OBS + """
SELECT region_code, avg(view_count) AS hist_avg_views, stddev_samp(view_count) AS hist_stddev_views
FROM obs GROUP BY region_code""",

    "hist_channel_ids": OBS + "SELECT DISTINCT channel_id FROM obs",
})

_STREAM = {
    "duration_distribution": EV + """
SELECT count(*) FILTER (WHERE duration_sec < 240) AS short_videos_count,
       count(*) FILTER (WHERE duration_sec >= 240 AND duration_sec < 1200) AS medium_videos_count,
       count(*) FILTER (WHERE duration_sec >= 1200) AS long_videos_count,
       CAST(ws AS VARCHAR) AS window_start, CAST(ws + INTERVAL '1 hour' AS VARCHAR) AS window_end
FROM ev GROUP BY ws""",

    "channel_regional_reach": EV + """
, per_window AS (
  SELECT channel_title, count(DISTINCT region_code) AS reach
  FROM ev GROUP BY ws, channel_id, channel_title)
, best AS (SELECT channel_title, max(reach) AS regional_reach FROM per_window GROUP BY channel_title)
SELECT channel_title, regional_reach FROM best
QUALIFY rank() OVER (ORDER BY regional_reach DESC) <= 15""",

    "trending_freshness": EV + """
, seen AS (SELECT video_id, min(event_time) AS t FROM ev GROUP BY video_id)
SELECT count(*) AS fresh_count, CAST(time_bucket(INTERVAL '1 hour', t) AS VARCHAR) AS window_start
FROM seen GROUP BY 2""",

    "historical_overlap": EV + """
, keyed AS (SELECT DISTINCT ws, channel_id FROM ev)
, hc AS (SELECT DISTINCT channel_id FROM hist)
, flagged AS (SELECT k.ws, k.channel_id, hc.channel_id AS h FROM keyed k LEFT JOIN hc ON k.channel_id = hc.channel_id)
SELECT CAST(ws AS VARCHAR) AS window_start, count(*) AS total_channels, count(h) AS hist_overlap,
       count(*) - count(h) AS new_channels,
       CAST((2 * count(h) * 10000 + count(*)) // (2 * count(*)) AS DOUBLE) / 100.0 AS overlap_pct
FROM flagged GROUP BY ws""",

    "current_vs_historical_views": EV + f"""
, cur AS (
  SELECT ws, max(view_count) AS current_max_views, {HALF_UP.format(v='view_count')} AS current_avg_views
  FROM ev GROUP BY ws)
, base AS (
  SELECT max(view_count) AS hist_max_views, {HALF_UP.format(v='view_count')} AS hist_avg_views FROM hist)
SELECT CAST(ws AS VARCHAR) AS window_start, current_max_views, current_avg_views,
       hist_max_views, hist_avg_views
FROM cur, base""",
}
ORACLE.update(_STREAM)
ORACLE.update({f"{k}_stream": v for k, v in _STREAM.items()})

_RAW = OBS.replace("\nobs AS (", "\nunused AS (")

_MSG = """
WITH msg AS (
  SELECT strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') || '+00:00' AS collected_at,
         event_type AS region_code,
         CAST(user_id AS VARCHAR) AS video_id,
         'Item ' || CAST(user_id AS VARCHAR) AS title,
         CAST(user_id % 50 AS VARCHAR) AS channel_id,
         'Channel#' || CAST(user_id % 50 AS VARCHAR) AS channel_title,
         value AS view_count,
         'PT' || regexp_extract(props, '"k":\\s*(\\d+)', 1) || 'M' AS duration,
         CAST(ts AS TIMESTAMP) AS kafka_ts,
         CAST(ts AS TIMESTAMP) AS event_time,
         CAST(regexp_extract(props, '"k":\\s*(\\d+)', 1) AS BIGINT) * 60 AS duration_sec
  FROM events)
"""

ORACLE.update({
    "category_lookup": OBS + "SELECT DISTINCT category_id, category_name FROM obs",
    "iso8601_duration": _RAW + """
SELECT DISTINCT duration,
       CAST(COALESCE(TRY_CAST(regexp_extract(duration, 'PT(\\d+)H', 1) AS INTEGER), 0) * 3600
          + COALESCE(TRY_CAST(regexp_extract(duration, 'PT(?:\\d+H)?(\\d+)M', 1) AS INTEGER), 0) * 60
          + COALESCE(TRY_CAST(regexp_extract(duration, 'PT(?:\\d+H)?(?:\\d+M)?(\\d+)S', 1) AS INTEGER), 0)
          AS INTEGER) AS duration_seconds
FROM raw""",
    "engagement_rate": OBS + """
SELECT video_id, region_code, trending_date, view_count, likes, comment_count, engagement FROM obs""",
    "prepare_observations": OBS + "SELECT * FROM obs",
    "snake_case_columns": _RAW + "SELECT * FROM raw",
    "typed_casts": _RAW + "SELECT * FROM raw",
    "outlier_filter": _RAW + "SELECT * FROM raw WHERE view_count <= 50000",
    "csv_prepare": OBS + "SELECT * FROM obs",
    "prepared_table": OBS + f"""
SELECT region_code, video_id, trending_date, view_count, duration_seconds FROM obs WHERE region_code = {_R}""",
    "result_roundtrip": ORACLE["top_tags"],
    "stream_parse": _MSG + """
SELECT collected_at, region_code, video_id, title, channel_id, channel_title, view_count, duration,
       kafka_ts, event_time, duration_sec FROM msg""",
    "event_time": """
SELECT CAST(user_id AS VARCHAR) AS video_id,
       CASE user_id % 4 WHEN 0 THEN strftime(ts, '%Y-%m-%d %H:%M:%S')
            WHEN 1 THEN strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') || '+00:00'
            WHEN 2 THEN '' ELSE 'yesterday, about noon' END AS collected_at,
       CAST(ts AS TIMESTAMP) + INTERVAL 1 DAY AS kafka_ts,
       CASE user_id % 4 WHEN 0 THEN date_trunc('second', CAST(ts AS TIMESTAMP)) WHEN 1 THEN CAST(ts AS TIMESTAMP)
            ELSE CAST(ts AS TIMESTAMP) + INTERVAL 1 DAY END AS event_time
FROM events""",
    "stream_duration": _MSG + "SELECT DISTINCT duration, duration_sec FROM msg",
})

# Stored and streamed features ---------------------------------------------------------------

_LAST = "(SELECT max(event_time) - INTERVAL 30 SECONDS FROM ev)"  # how far the watermark gets

# Four of fifty messages are spoilt, by their id; the others are accepted.
_FAULTY = """
WITH spoilt AS (
  SELECT *, CASE event_id % 50 WHEN 0 THEN 'malformed' WHEN 1 THEN 'future' WHEN 2 THEN 'late' WHEN 3 THEN 'untimed'
         ELSE 'accepted' END AS verdict FROM events)
"""

ORACLE.update({
    "fresh_within_ttl_stream": EV + """
, gaps AS (
  SELECT event_time, event_time - lag(event_time) OVER (PARTITION BY video_id ORDER BY event_time) AS since FROM ev)
SELECT count(*) AS fresh_count, CAST(time_bucket(INTERVAL '1 hour', event_time) AS VARCHAR) AS window_start
FROM gaps WHERE (since IS NULL OR since > INTERVAL 12 HOURS) AND event_time <= """ + _LAST + """
GROUP BY 2""",

    "trending_freshness_append_stream": EV + """
, seen AS (SELECT time_bucket(INTERVAL '1 hour', min(event_time)) AS ws FROM ev GROUP BY video_id)
SELECT count(*) AS fresh_count, CAST(ws AS VARCHAR) AS window_start FROM seen
WHERE ws + INTERVAL '1 hour' <= """ + _LAST + " GROUP BY ws",

    "rejected_messages_stream": _FAULTY + """
SELECT verdict, count(*) AS n_messages FROM spoilt GROUP BY verdict""",

    "duration_distribution_guarded_stream": EV.replace("FROM events", "FROM events WHERE event_id % 50 > 3") +
    _STREAM["duration_distribution"][len(EV):],

    "duration_distribution_twice_stream": _STREAM["duration_distribution"],

    "first_seen_state_stream": EV + "SELECT video_id, min(event_time) AS first_seen FROM ev GROUP BY video_id",

    "channel_regional_reach_upsert_stream": _STREAM["channel_regional_reach"],

    "channel_reach_by_day_stream": EV + """
SELECT CAST(ws AS DATE) AS day, channel_title, count(DISTINCT region_code) AS regional_reach
FROM ev GROUP BY day, channel_title""",
})

# Gaps and islands: a session begins where the item's last message lies further back than the gap.
_SESSIONS = EV + """
, marked AS (
  SELECT *, CASE WHEN event_time - lag(event_time) OVER w <= INTERVAL 6 HOURS THEN 0 ELSE 1 END AS begins
  FROM ev WINDOW w AS (PARTITION BY video_id ORDER BY event_time))
, numbered AS (
  SELECT *, sum(begins) OVER (PARTITION BY video_id ORDER BY event_time ROWS UNBOUNDED PRECEDING) AS nth FROM marked)
, found AS (
  SELECT video_id, min(event_time) AS first_at, max(event_time) AS last_at, count(*) AS n_messages,
         max(view_count) AS max_views FROM numbered GROUP BY video_id, nth)
SELECT * FROM found"""

ORACLE.update({
    "item_sessions": _SESSIONS,
    "item_sessions_stream": _SESSIONS + f" WHERE last_at + INTERVAL 6 HOURS <= {_LAST}",
    "daily_popularity": ORACLE["popularity_over_time"],
    "daily_breakdowns": OBS + """
, a2 AS (SELECT category_id, category_name, count(*) AS n FROM obs GROUP BY 1, 2
  ORDER BY n DESC, category_id ASC NULLS FIRST, category_name ASC NULLS FIRST LIMIT 10)
, a10 AS (SELECT category_id, category_name, avg(comment_count) AS v FROM obs GROUP BY 1, 2
  ORDER BY v DESC NULLS LAST, category_id ASC NULLS FIRST, category_name ASC NULLS FIRST LIMIT 20)
SELECT 'number_of_videos' AS question, category_name AS label, CAST(n AS DOUBLE) AS value FROM a2
UNION ALL SELECT 'average_engagement', region_code, avg(engagement) FROM obs GROUP BY region_code
UNION ALL SELECT 'average_views', region_code, avg(view_count) FROM obs GROUP BY region_code
UNION ALL SELECT 'average_comments', category_name, v FROM a10
UNION ALL SELECT 'average_likes', CAST(dayofweek(trending_date) + 1 AS VARCHAR), avg(likes) FROM obs GROUP BY 2
UNION ALL SELECT 'video_count', CAST(dayofweek(trending_date) + 1 AS VARCHAR), CAST(count(video_id) AS DOUBLE)
  FROM obs GROUP BY 2""",
    "fastest_growth_bucketed": ORACLE["fastest_growth_videos"],
    # The vocabulary fits the sketch, so its counts are exact; 3.5 / 8192 of the total is its bound.
    "frequent_tag_sketch": OBS + """
, t AS (SELECT unnest(string_split(tags, '|')) AS tag FROM obs WHERE tags IS NOT NULL)
, c AS (SELECT tag, count(*) AS n, sum(count(*)) OVER () AS total FROM t GROUP BY tag)
, e AS (SELECT *, CAST(ceil(total * 3.5 / 8192) AS BIGINT) AS error FROM c)
SELECT tag, n AS estimate, greatest(n - error, 0) AS least, CAST(total AS BIGINT) AS total FROM e
WHERE n + error >= total * 0.01""",
})
