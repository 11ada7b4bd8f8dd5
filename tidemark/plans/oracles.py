"""SQL counterparts of the registered queries, over the same tables.

They share the definitions below, which restate the derived inputs in SQL.
"""

from __future__ import annotations

LONG_MAX = 9223372036854775807

EVENTS = """
ev AS (
  SELECT event_id, event_id // 10 AS message_id,
         strftime(ts, '%Y%m%d%H%M') AS bucket, epoch_ms(date_trunc('minute', ts)) AS ms,
         'h' || (user_id % 7) AS host, 'i' || (event_id % 3) AS instance,
         CASE WHEN event_id % 5 < 2 THEN NULL WHEN event_id % 5 = 2 THEN ''
              WHEN user_id % 2 = 0 THEN 'qa' ELSE 'prod' END AS environment,
         CASE WHEN event_id % 4 <> 0 THEN 'shop' END AS appname,
         event_type AS name, value, user_id,
         CAST(json_extract(props, '$.k') AS BIGINT) AS k
  FROM events)"""

METRIC_IDS = """
meta AS (
  SELECT CASE event_type WHEN 'error' THEN 1 WHEN 'click' THEN 2 WHEN 'purchase' THEN 3
              WHEN 'signup' THEN 4 END AS id, event_type AS name
  FROM events WHERE event_type <> 'view'
  UNION ALL SELECT 5, 'dsmetrics' FROM events
  UNION ALL SELECT 9, 'error' FROM events WHERE event_type = 'error'),
mids AS (SELECT name, CAST(min(id) AS INTEGER) AS mid FROM meta GROUP BY name)"""

HIERARCHY = """
seen AS (
  SELECT DISTINCT user_id % 7 AS k, CASE WHEN (user_id % 7) % 2 = 0 THEN 'qa' ELSE 'prod' END AS env,
         CASE (user_id % 7) // 2 WHEN 0 THEN 'cart' WHEN 1 THEN 'web' ELSE 'api' END AS app
  FROM events WHERE user_id % 7 < 6),
kv AS (
  SELECT 'environment' AS rowkey, CASE env WHEN 'prod' THEN ' prod ' ELSE env END AS qualifier FROM seen
  UNION SELECT 'environment', ' ' FROM seen
  UNION SELECT env || '.appname', app FROM seen
  UNION SELECT env || '.' || app || '.hosts', 'h' || k FROM seen
  UNION SELECT 'prod.appname', 'a.b' FROM seen
  UNION SELECT 'prod.a.b.hosts', 'h9' FROM seen),
envs AS (SELECT DISTINCT trim(qualifier) AS env FROM kv WHERE rowkey = 'environment' AND trim(qualifier) <> ''),
apps AS (SELECT DISTINCT env, qualifier AS app FROM envs JOIN kv ON kv.rowkey = env || '.appname'
         WHERE trim(qualifier) <> ''),
hosts AS (
  SELECT host, env, app FROM (
    SELECT qualifier AS host, env, app,
           row_number() OVER (PARTITION BY qualifier ORDER BY env, app) AS pick
    FROM apps JOIN kv ON kv.rowkey = env || '.' || app || '.hosts') WHERE pick = 1)"""

ROWS = f"""
placed AS (
  SELECT ev.*, trim(coalesce(environment, hosts.env)) AS env, trim(coalesce(appname, hosts.app)) AS app
  FROM ev LEFT JOIN hosts ON ev.host = hosts.host),
ordinary AS (
  SELECT event_id, mid AS "MID", {LONG_MAX} - ms AS "RTIME", env AS "ENV", app AS "APP",
         host AS "HOST", instance AS "INSTANCE", CAST(1 AS BIGINT) AS metric_count,
         round(value, 4) AS metric_sum, value AS metric_min, value AS metric_max, ms
  FROM placed JOIN mids ON placed.name = mids.name),
rows_kept AS (SELECT * FROM ordinary WHERE "ENV" <> '' AND "HOST" <> ''),
items AS (
  SELECT event_id, '{{"k":' || k || '}}' AS item FROM ev
  UNION ALL SELECT event_id, '{{"n":' || user_id || '}}' FROM ev),
bundles AS (
  SELECT event_id, '[' || string_agg(item, ',' ORDER BY item) || ']' AS metric_items
  FROM items GROUP BY event_id),
datasource AS (
  SELECT placed.event_id, mid AS "MID", {LONG_MAX} - ms AS "RTIME", env AS "ENV", app AS "APP",
         host AS "HOST", instance AS "INSTANCE", metric_items
  FROM placed JOIN bundles ON placed.event_id = bundles.event_id
  JOIN mids ON mids.name = 'dsmetrics' WHERE env <> '' AND host <> ''),
everything AS (
  SELECT event_id, "MID", "RTIME", "ENV", "APP", "HOST", "INSTANCE",
         metric_count, metric_sum, metric_min, metric_max, CAST(NULL AS VARCHAR) AS metric_items
  FROM rows_kept
  UNION ALL
  SELECT event_id, "MID", "RTIME", "ENV", "APP", "HOST", "INSTANCE", NULL, NULL, NULL, NULL, metric_items
  FROM datasource)"""

VERSIONS = f"""
days AS (SELECT *, epoch_ms(ts) // 86400000 AS day, CAST(user_id % 7 AS INTEGER) AS k FROM events),
names AS (
  SELECT name, since, CAST(min(id) AS INTEGER) AS mid FROM (
    SELECT CASE event_type WHEN 'error' THEN 1 WHEN 'click' THEN 2 WHEN 'purchase' THEN 3 WHEN 'signup' THEN 4 END
           + 10 * day % 30 AS id, event_type AS name, day * 86400000 AS since
    FROM days WHERE day % 2 = 0 AND event_type <> 'view') GROUP BY name, since),
moves AS (
  SELECT DISTINCT 'h' || k AS host, CASE WHEN (k + day) % 2 = 0 THEN 'qa' ELSE 'prod' END AS env,
         CASE (k + day) % 3 WHEN 0 THEN 'cart' WHEN 1 THEN 'web' ELSE 'api' END AS app,
         day * 86400000 + k * 3600000 AS since, CASE WHEN k = 2 THEN day * 86400000 + k * 3600000 + 86400000 END AS until
  FROM days WHERE day % 3 = 0 AND k < 6),
named AS (SELECT ev.*, names.mid FROM ev ASOF JOIN names ON ev.name = names.name AND ev.ms >= names.since),
settled AS (
  SELECT named.*, trim(coalesce(environment, CASE WHEN until IS NULL OR ms < until THEN moves.env END)) AS env,
         trim(coalesce(appname, CASE WHEN until IS NULL OR ms < until THEN moves.app END)) AS app
  FROM named ASOF LEFT JOIN moves ON named.host = moves.host AND named.ms >= moves.since)"""

KEY = '"MID", "RTIME", "ENV", "APP", "HOST", "INSTANCE"'
SERIES = '"MID", "ENV", "APP", "HOST", "INSTANCE"'
MEASURES = "metric_count, metric_sum, metric_min, metric_max"

DAMAGE = """
found AS (
  SELECT event_id AS message_id, unnest(CASE event_id % 16
      WHEN 0 THEN [('message', 'bad_payload')] WHEN 1 THEN [('message', 'bad_payload')]
      WHEN 2 THEN [('message', 'bad_payload')] WHEN 3 THEN [('message', 'bad_payload')]
      WHEN 4 THEN [('message', 'bad_json')]
      WHEN 6 THEN [('bucket', 'bad_rowkey'), ('bucket', 'bad_rowkey')]
      WHEN 7 THEN [('bucket', 'bad_rowkey')]
      WHEN 8 THEN [('bucket', 'bad_time'), ('bucket', 'bad_time')]
      WHEN 9 THEN [('event', 'bad_event')] WHEN 10 THEN [('metric', 'bad_metric')]
      WHEN 12 THEN [('message', 'bad_json')] WHEN 13 THEN [('message', 'bad_json')]
      WHEN 14 THEN [('message', 'bad_json')] WHEN 15 THEN [('bucket', 'bad_item')]
      ELSE [] END) AS found
  FROM events)"""

WINDOWS = """
starts AS (
  SELECT ms - ms % 60000 - o.o * 60000 AS window_start_ms, ms - ms % 60000 - o.o * 60000 + 300000 AS window_end_ms,
         rows_kept.*
  FROM rows_kept, range(0, 5) AS o(o))"""


def _with(parts: list[str], query: str) -> str:
    return "WITH " + ",".join(parts) + query


def _rolled(key: str, where: str = "") -> str:
    return f"""
SELECT window_start_ms, window_end_ms, {key}, CAST(sum(metric_count) AS BIGINT) AS metric_count,
       round(sum(metric_min), 4) AS metric_sum, min(metric_min) AS metric_min, max(metric_max) AS metric_max
FROM starts {where} GROUP BY window_start_ms, window_end_ms, {key}"""


def oracles() -> dict[str, str]:
    base = [EVENTS, METRIC_IDS, HIERARCHY, ROWS]
    metric_rows = _with(base, f"\nSELECT event_id, {KEY}, {MEASURES} FROM rows_kept")
    as_of = _with(
        [EVENTS, VERSIONS],
        f"""
SELECT event_id, mid AS "MID", {LONG_MAX} - ms AS "RTIME", env AS "ENV", app AS "APP", host AS "HOST",
       instance AS "INSTANCE", CAST(1 AS BIGINT) AS metric_count, round(value, 4) AS metric_sum,
       value AS metric_min, value AS metric_max FROM settled WHERE env <> '' AND host <> ''""",
    )
    typed = _with(base, f"\nSELECT event_id, {KEY} FROM rows_kept")
    window_rows = _with(
        [*base, WINDOWS],
        f"\nSELECT window_start_ms, window_end_ms, event_id, {KEY}, {MEASURES} FROM starts",
    )
    upserts = _with(
        base,
        f""",
sent AS (
  SELECT {KEY}, event_id AS seq, {MEASURES} FROM rows_kept
  UNION ALL
  SELECT {KEY}, event_id + 1000000, metric_count, round(metric_min + 1, 4), metric_min + 1, metric_max + 1
  FROM rows_kept WHERE "MID" = 3)
SELECT {KEY}, seq, {MEASURES} FROM (
  SELECT *, row_number() OVER (PARTITION BY {KEY} ORDER BY seq DESC) AS pick FROM sent) WHERE pick = 1""",
    )
    everything = _with(base, f"\nSELECT event_id, {KEY}, {MEASURES}, metric_items FROM everything")
    return {
        "decode_payload": _with(
            [EVENTS],
            """
SELECT message_id, event_id, environment, appname, bucket || '|' || host || '|' || instance AS rowkey,
       name, host, instance, CAST(1 AS BIGINT) AS n, value, k AS pool_k, user_id AS queue_n FROM ev""",
        ),
        "explode_events": _with(
            [EVENTS],
            """
SELECT message_id, event_id, environment, appname,
       CAST(1 AS INTEGER) AS metric_buckets, CAST(1 AS INTEGER) AS datasource_buckets FROM ev""",
        ),
        "unpivot_metrics": _with(
            [EVENTS],
            """
SELECT event_id, bucket || '|' || host || '|' || instance AS rowkey, name, host, instance,
       CAST(1 AS BIGINT) AS metric_count, round(value, 4) AS metric_sum,
       value AS metric_min, value AS metric_max FROM ev""",
        ),
        "reverse_time": _with(
            [EVENTS], f'\nSELECT event_id, bucket, {LONG_MAX} - ms AS "RTIME" FROM ev'
        ),
        "metric_dictionary": _with([METRIC_IDS], '\nSELECT name AS "NAME", mid AS "MID" FROM mids'),
        "metric_conflicts": _with(
            [METRIC_IDS],
            """
SELECT name AS "NAME", count(DISTINCT id) AS ids, CAST(min(id) AS INTEGER) AS "MID"
FROM meta GROUP BY name HAVING count(DISTINCT id) > 1""",
        ),
        "hierarchy_row": _with(
            [HIERARCHY], "\nSELECT DISTINCT qualifier FROM kv WHERE rowkey = 'environment'"
        ),
        "hierarchy_rows": _with([HIERARCHY], "\nSELECT env, app FROM apps"),
        "host_hierarchy": _with([HIERARCHY], "\nSELECT host, env, app FROM hosts"),
        "known_metrics": _with(
            [EVENTS, METRIC_IDS],
            """
SELECT event_id, ev.name, mid AS "MID" FROM ev JOIN mids ON ev.name = mids.name
UNION ALL
SELECT event_id, mids.name, mid FROM ev JOIN mids ON mids.name = 'dsmetrics'""",
        ),
        "unknown_metrics": _with(
            [EVENTS, METRIC_IDS],
            """
SELECT name, count(*) AS entries FROM ev
WHERE NOT EXISTS (SELECT 1 FROM mids WHERE mids.name = ev.name) GROUP BY name""",
        ),
        "host_lookup": _with(base, '\nSELECT event_id, host, env AS "ENV", app AS "APP" FROM placed'),
        "metric_rows": metric_rows,
        "metric_rows_large_dictionary": metric_rows,
        "metric_rows_as_of": as_of,
        "metric_rows_as_of_large_dictionary": as_of,
        "stream_hot_keys": metric_rows,
        "metric_rows_default_env": _with(
            base,
            f"""
SELECT event_id, "MID", "RTIME", coalesce("ENV", 'unplaced') AS "ENV", "APP", "HOST", "INSTANCE", {MEASURES}
FROM ordinary""",
        ),
        "datasource_rows": _with(base, f"\nSELECT event_id, {KEY}, metric_items FROM datasource"),
        "all_rows": everything,
        "union_rows": everything,
        "quarantine": _with(
            [DAMAGE], "\nSELECT message_id, found[1] AS unit, found[2] AS reason FROM found"
        ),
        "recovered_entries": _with(
            [EVENTS],
            """
SELECT event_id AS message_id, event_id,
       CASE WHEN event_id % 16 = 7 THEN bucket || '|' || host
            ELSE bucket || '|' || host || '|' || instance END AS rowkey, name
FROM ev WHERE event_id % 16 IN (5, 7, 9, 11, 15)
UNION ALL
SELECT event_id, event_id, bucket || '|' || host || '|' || instance, 'dsmetrics'
FROM ev WHERE event_id % 16 IN (5, 9, 11)""",
        ),
        "redriven_rows": everything,
        "unknown_fields": _with(
            base,
            f"""
SELECT event_id, {KEY}, user_id AS trace_user, "HOST" AS trace_host, '["' || name || '","' || "HOST" || '"]' AS trace_tags
FROM rows_kept JOIN (SELECT event_id, user_id, name FROM ev) USING (event_id)""",
        ),
        "row_json": _with(
            base,
            """
SELECT event_id, CAST(json_object('MID', "MID", 'RTIME', "RTIME", 'ENV', "ENV", 'APP', "APP",
       'HOST', "HOST", 'INSTANCE', "INSTANCE") AS VARCHAR) AS value FROM rows_kept""",
        ),
        "json_typed_rows": typed,
        "stored_metric_decode": _with(
            base,
            f"""
SELECT event_id, "MID", {MEASURES}, metric_items, metric_sum / metric_count AS average
FROM everything""",
        ),
        "drop_counts": _with(
            [*base, DAMAGE],
            """,
read AS (
  SELECT placed.name, placed.env, placed.host FROM placed WHERE event_id % 16 IN (5, 7, 9, 11, 15)
  UNION ALL SELECT 'dsmetrics', env, host FROM placed WHERE event_id % 16 IN (5, 9, 11)),
fates AS (
  SELECT CASE WHEN mid IS NULL THEN 'unknown_name' WHEN coalesce(env, '') = '' OR coalesce(host, '') = '' THEN 'no_place'
              ELSE 'kept' END AS fate FROM read LEFT JOIN mids ON read.name = mids.name
  UNION ALL SELECT found[2] FROM found)
SELECT fate, count(*) AS records FROM fates GROUP BY fate""",
        ),
        "row_schema": _with(base, f"\nSELECT {KEY}, {MEASURES}, metric_items FROM everything"),
        "upsert_latest": upserts,
        "stream_upserts": upserts,
        "compacted_log": _with(
            base,
            f"""
SELECT {KEY}, event_id, {MEASURES}, metric_items FROM (
  SELECT *, row_number() OVER (PARTITION BY {KEY} ORDER BY event_id DESC) AS pick FROM everything)
WHERE pick = 1""",
        ),
        "compacted_dates": _with(
            base,
            f"""
SELECT {KEY}, event_id, CASE WHEN "MID" = 3 THEN round(metric_sum + 1, 4) ELSE metric_sum END AS metric_sum, metric_items
FROM (SELECT *, row_number() OVER (PARTITION BY {KEY} ORDER BY event_id DESC) AS pick FROM everything)
WHERE pick = 1""",
        ),
        "merged_buckets": _with(
            base,
            f"""
SELECT {KEY}, event_id, CASE WHEN "MID" = 3 THEN round(metric_sum + 1, 4) ELSE metric_sum END AS metric_sum, metric_items
FROM (SELECT *, row_number() OVER (PARTITION BY {KEY} ORDER BY event_id DESC) AS pick FROM everything)
WHERE pick = 1""",
        ),
        "store_rows": _with(
            base,
            f"""
SELECT {KEY}, {MEASURES}, metric_items FROM (
  SELECT *, row_number() OVER (PARTITION BY {KEY} ORDER BY event_id DESC) AS pick FROM everything)
WHERE pick = 1""",
        ),
        "batch_peek": _with(
            base,
            f"""
SELECT event_id, {KEY}, {MEASURES} FROM rows_kept
ORDER BY "RTIME", "MID", "ENV", "HOST", "INSTANCE", event_id LIMIT 20""",
        ),
        "sliding_window_rows": window_rows,
        "rollup_5m": _with([*base, WINDOWS], _rolled(SERIES)),
        "rollup_5m_by_env": _with([*base, WINDOWS], _rolled('"MID", "ENV"')),
        "refreshed_rollup": _with(
            base,
            f""",
kept_last AS (
  SELECT {SERIES}, ms, metric_count, CASE WHEN "MID" = 3 THEN metric_min + 1 ELSE metric_min END AS low,
         CASE WHEN "MID" = 3 THEN metric_max + 1 ELSE metric_max END AS high
  FROM (SELECT *, row_number() OVER (PARTITION BY {KEY} ORDER BY event_id DESC) AS pick FROM rows_kept) WHERE pick = 1)
SELECT ms - ms % 60000 - o.o * 60000 AS window_start_ms, ms - ms % 60000 - o.o * 60000 + 300000 AS window_end_ms, {SERIES},
       CAST(sum(metric_count) AS BIGINT) AS metric_count, round(sum(low), 4) AS metric_sum, min(low) AS metric_min, max(high) AS metric_max
FROM kept_last, range(0, 5) AS o(o) GROUP BY ALL""",
        ),
        "stream_metric_rows": metric_rows,
        "stream_quarantine": _with([DAMAGE], "\nSELECT message_id, found[2] AS reason FROM found"),
        "stream_row_json": typed,
        "stream_window_rows": window_rows,
        "stream_open_rollup": _with([*base, WINDOWS], _rolled(SERIES)),
        # A window is out once the newest row lies the watermark's delay past its end.
        "stream_rollup_5m": _with(
            [*base, WINDOWS],
            _rolled(SERIES, "WHERE window_end_ms <= (SELECT max(ms) FROM rows_kept) - 600000"),
        ),
    }
