"""The same results in plain SQL over the given tables."""

from __future__ import annotations

from eventbase.plans import timeline

_K = r"cast(regexp_extract(props, '\d+') AS INTEGER)"
_MONEY = "cast(value AS DECIMAL(18,2))"
_LATEST = f"""
SELECT event_id AS eventid, ts AS eventtime, event_type AS eventtype, user_id AS userid, value, {_K} AS k
FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY event_id DESC) AS n FROM events)
WHERE n = 1"""


def _windows(size: str, step: str, where: str = "") -> str:
    """Windows of ``size`` starting every ``step``, counted from the epoch."""
    return f"""
SELECT window_start, window_start + INTERVAL {size} AS window_end, event_type, count(*) AS n,
       cast(sum({_MONEY}) AS DOUBLE) AS total, cast(max({_MONEY}) AS DOUBLE) AS top
FROM (
  SELECT e.*, time_bucket(INTERVAL {step}, ts, TIMESTAMP '1970-01-01') - back.i * INTERVAL {step} AS window_start
  FROM events e, (SELECT unnest(range(24)) AS i) back
)
WHERE window_start + INTERVAL {size} > ts {where}
GROUP BY ALL"""


_FACTS = f"""
facts AS (
  SELECT event_type AS eventtype, cast(ts AS DATE) AS day, c_mktsegment AS segment, {_MONEY} AS amount
  FROM events LEFT JOIN customer ON user_id = c_custkey
)"""


def _summary(clause: str) -> str:
    return f"""
WITH {_FACTS}
SELECT eventtype, day, segment, cast(grouping(eventtype, day, segment) AS BIGINT) AS grouping_id, count(*) AS n,
       cast(sum(amount) AS DOUBLE) AS total, cast(min(amount) AS DOUBLE) AS lowest, cast(max(amount) AS DOUBLE) AS highest
FROM facts GROUP BY {clause}"""


ORACLE = {
    "flagship": f"""
SELECT event_type AS eventtype, count(*) AS events, cast(sum({_MONEY}) AS DOUBLE) AS total FROM events GROUP BY 1""",
    "ingest_typed": f"""
SELECT event_id AS eventid, ts AS eventtime, event_type AS eventtype, user_id AS userid, value, {_K} AS k FROM events""",
    "ingest_fields_missing_unknown": """
SELECT event_id AS eventid, CASE WHEN event_id % 4 >= 2 THEN value END AS value, event_type AS eventtype,
       cast(NULL AS DATE) AS never FROM events""",
    "ingest_quarantine_counts": """
SELECT CASE WHEN n = 0 THEN 'blank' WHEN n IN (1, 2, 3) THEN 'malformed' WHEN n IN (4, 5, 7, 8, 9) THEN 'bad_value' ELSE 'good' END AS outcome,
       CASE n WHEN 4 THEN 'value' WHEN 5 THEN 'userid' WHEN 7 THEN 'eventtime' WHEN 8 THEN 'props' WHEN 9 THEN 'props' ELSE '' END AS bad_field_names,
       count(*) AS records, count(*) FILTER (WHERE n >= 10) AS with_user
FROM (SELECT event_id % 12 AS n FROM events) GROUP BY 1, 2""",
    "ingest_epoch_units": """
SELECT 's' AS unit, event_id, date_trunc('second', ts) AS t FROM events
UNION ALL SELECT 'ms', event_id, date_trunc('millisecond', ts) FROM events
UNION ALL SELECT 'us', event_id, ts FROM events""",
    "ingest_epoch_days": """
SELECT event_id, CASE WHEN event_id % 4 < 3 THEN cast(ts AS DATE) END AS d,
       CASE WHEN event_id % 4 = 3 THEN 'bad_value' END AS reason FROM events""",
    "ingest_integers_bool": """
SELECT event_id, CASE WHEN good THEN cast(b AS TINYINT) END AS b, CASE WHEN good THEN cast(s AS SMALLINT) END AS s,
       CASE WHEN good THEN cast(i AS INTEGER) END AS i, CASE WHEN good THEN l END AS l, CASE WHEN good THEN f END AS f,
       concat_ws(',', CASE WHEN s > 32767 THEN 's' END, CASE WHEN i > 2147483647 THEN 'i' END) AS bad_field_names
FROM (SELECT *, s <= 32767 AND i <= 2147483647 AS good FROM (
  SELECT event_id, CASE WHEN event_id % 256 > 127 THEN event_id % 256 - 256 ELSE event_id % 256 END AS b,
         event_id % 40000 AS s, event_id * 1000003 AS i, event_id * 3000000000 AS l, event_id % 2 = 0 AS f FROM events))""",
    "ingest_decimal": f"""
SELECT event_id, CASE WHEN {_MONEY} + 0.01 < 100 THEN cast({_MONEY} + 0.01 AS DOUBLE) END AS wide,
       CASE WHEN {_MONEY} + 0.01 >= 100 THEN 'bad_value' END AS reason FROM events""",
    "ingest_special_floats": f"""
SELECT mode, event_id, CASE n WHEN 0 THEN 'nan' WHEN 1 THEN 'inf' WHEN 2 THEN '-inf'
         WHEN 3 THEN CASE mode WHEN 'strict' THEN 'rejected' ELSE 'nan' END
         WHEN 4 THEN CASE mode WHEN 'strict' THEN 'rejected' ELSE 'inf' END
         WHEN 5 THEN CASE mode WHEN 'strict' THEN 'rejected' ELSE '-inf' END
         WHEN 6 THEN 'rejected' WHEN 7 THEN 'rejected' WHEN 8 THEN 'null' WHEN 9 THEN 'nan'
         ELSE cast({_MONEY} AS VARCHAR) END AS kind
FROM (SELECT *, event_id % 11 AS n FROM events), (VALUES ('strict'), ('lenient')) AS m(mode)""",
    "ingest_json_text": """
SELECT event_id, replace(props, ' ', '') AS props, cast(event_id AS VARCHAR) AS num,
       '[' || user_id || ',"' || event_type || '",null]' AS list FROM events""",
    "ingest_nested": """
SELECT event_id, user_id AS a, ts AS at, cast(ts AS DATE) AS d, 3 AS xs_size, true AS xs_gap, event_id AS xs_last,
       2 AS m_size, value AS m_x, cast(ts AS DATE) AS ds_first, event_type AS b FROM events""",
    "ingest_object_as_array": """
SELECT event_id, CASE WHEN good THEN 2 - CASE WHEN event_id % 2 = 0 THEN 1 ELSE 0 END END AS items,
       CASE WHEN good THEN event_id END AS last_id, CASE WHEN good THEN ts END AS last_at,
       CASE WHEN good THEN '' ELSE 'ns' END AS bad_field_names
FROM (SELECT *, event_id % 3 <> 0 AS good FROM events)""",
    "ingest_root_array_explode": """
SELECT event_id, event_id AS id, cast(NULL AS DOUBLE) AS v, cast(NULL AS VARCHAR) AS reason FROM events WHERE event_id % 5 = 0
UNION ALL SELECT event_id, event_id, value, NULL FROM events WHERE event_id % 5 <> 0
UNION ALL SELECT event_id, NULL, NULL, 'bad_value' FROM events WHERE event_id % 5 <> 0
UNION ALL SELECT event_id, user_id, NULL, NULL FROM events WHERE event_id % 5 <> 0
UNION ALL SELECT event_id, NULL, NULL, 'malformed' FROM events WHERE event_id % 5 <> 0""",
    "ingest_syntax_options": """
SELECT mode, event_id, CASE WHEN good THEN event_id END AS a, CASE WHEN NOT good THEN 'malformed' END AS reason,
       CASE WHEN NOT good THEN cast(chars + length(cast(event_id AS VARCHAR)) AS INTEGER) END AS kept_chars
FROM (SELECT mode, event_id, n, n IN (0, 4) OR (mode = 'lenient' AND n IN (1, 2, 3)) AS good,
             CASE n WHEN 1 THEN 4 WHEN 2 THEN 8 WHEN 3 THEN 16 ELSE 7 END AS chars
      FROM (SELECT event_id, event_id % 6 AS n FROM events), (VALUES ('default'), ('lenient')) AS m(mode))""",
    "ingest_texts": """
SELECT 'document' AS kind, doc_id AS id, cast(0 AS BIGINT) AS turn, md5(text) AS digest, cast(length(text) AS INTEGER) AS chars FROM documents
UNION ALL SELECT 'page', page_id, 0, md5(html), cast(length(html) AS INTEGER) FROM pages
UNION ALL SELECT 'turn', conv_id, turn, md5(text), cast(length(text) AS INTEGER) FROM conversations""",
    "ingest_vectors": """
SELECT vec_id, label, cast(unnest(range(len(embedding))) AS INTEGER) AS pos, cast(unnest(embedding) AS DOUBLE) AS x FROM embeddings""",
    "route_table_counts": """
SELECT CASE WHEN event_type <> 'view' THEN 'app_' || event_type END AS table_name, count(*) AS messages FROM events GROUP BY 1""",
    "registered_semi": """
SELECT 'app|' || event_type AS key, cast(user_id % 4 AS INTEGER) AS partition, event_id AS "offset" FROM events WHERE event_type <> 'view'""",
    "unregistered_anti": """
SELECT 'app|' || event_type AS key, cast(user_id % 4 AS INTEGER) AS partition, event_id AS "offset" FROM events WHERE event_type = 'view'""",
    "registry_duplicates": """
SELECT 'u' || user_id AS app_key, event_type, count(*) AS entries FROM events GROUP BY 1, 2 HAVING count(*) > 1""",
    "application_keys": """
SELECT c_custkey, sha256('["' || c_name || '","' || c_mktsegment || '"]') AS app_key FROM customer""",
    "mapped_columns": """
SELECT o_orderkey AS order_id, cast(o_custkey AS DOUBLE) AS o_custkey, o_orderstatus, o_totalprice AS price,
       cast(o_orderdate AS DATE) AS o_orderdate, o_orderpriority AS "Priority class" FROM orders""",
    "publish_envelope": """
SELECT 'app' AS app_key, event_type, 'events' AS topic, cast(user_id % 4 AS INTEGER) AS partition, event_id AS "offset",
       user_id AS userid, value FROM events""",
    "upsert_latest": _LATEST,
    "upsert_two_batches": _LATEST,
    "read_base_and_deltas": _LATEST,
    "read_during_compaction": _LATEST,
    "ingest_many_types": f"""
SELECT event_id AS eventid, ts AS eventtime, event_type AS eventtype, user_id AS userid, value, {_K} AS k
FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS n FROM events) WHERE n = 1""",
    "upsert_root_lists": """
SELECT user_id AS userid, max(event_id) AS eventid, 2 AS n, NULL AS reason FROM events WHERE event_id % 5 <> 0 GROUP BY 1
UNION ALL SELECT NULL, event_id, NULL, 'empty_list' FROM events WHERE event_id % 5 = 0""",
    "widened_columns": """
SELECT event_id AS id, CASE WHEN event_id % 3 = 0 THEN user_id ELSE user_id + 10000000000 END AS who,
       CASE WHEN event_id % 3 = 0 THEN cast(cast(value AS FLOAT) AS DOUBLE) ELSE value END AS score,
       cast(CASE WHEN event_id % 3 = 0 THEN cast(value AS DECIMAL(18,2)) ELSE cast(value AS DECIMAL(18,2)) + 100000000 END AS DOUBLE) AS amount,
       NULL AS reason
FROM events
UNION ALL SELECT event_id, NULL, NULL, NULL, 'schema_conflict' FROM events WHERE event_id % 100 = 0""",
    "quarantine_table": """
SELECT event_id AS "offset", CASE n WHEN 5 THEN 'app|unknown' WHEN 7 THEN 'app|taken' WHEN 6 THEN NULL ELSE 'app|good' END AS key,
       CASE n WHEN 0 THEN 'blank' WHEN 1 THEN 'malformed' WHEN 2 THEN 'bad_value' WHEN 3 THEN 'null_key' WHEN 4 THEN 'stored'
              WHEN 7 THEN 'schema_conflict' ELSE 'unregistered' END AS reason,
       CASE n WHEN 2 THEN 'id,v' ELSE '' END AS bad_field_names,
       CASE n WHEN 0 THEN 1 WHEN 2 THEN 18 WHEN 3 THEN 9 WHEN 4 THEN NULL
              ELSE length('{"id":' || event_id || ',"v":' || value::VARCHAR || '}') END AS chars
FROM (SELECT *, event_id % 8 AS n FROM events)""",
    "mapped_nested_columns": f"""
SELECT user_id, event_type AS who_kind, {_K} AS props_k, event_id
FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY event_id DESC) AS n FROM events) WHERE n = 1""",
    "ingest_repeated_fields": """
SELECT event_id, CASE WHEN n IN (1, 2, 5, 6, 8, 9) THEN 'bad_value' END AS reason,
       CASE WHEN n IN (0, 7, 10) THEN event_id END AS a, CASE WHEN n = 11 THEN event_id END AS x,
       CASE WHEN n = 10 THEN TIMESTAMP '2019-01-01 00:00:00' END AS t, CASE WHEN n = 10 THEN DATE '2018-02-01' END AS d
FROM (SELECT *, event_id % 12 AS n FROM events)""",
    "ingest_times_without_dates": """
SELECT event_id, CASE WHEN event_id % 5 < 3 THEN 'bad_value' END AS reason,
       CASE event_id % 5 WHEN 3 THEN date_trunc('second', ts) + INTERVAL 8 HOURS WHEN 4 THEN date_trunc('second', ts) END AS t FROM events""",
    "agg_stream_new_checkpoint": _windows("6 HOURS", "6 HOURS"),
    "append_two_streams": """
SELECT event_id, event_type FROM events""",
    "cube_users": f"""
WITH facts AS (
  SELECT event_type AS eventtype, cast(ts AS DATE) AS day, c_mktsegment AS segment, user_id FROM events LEFT JOIN customer ON user_id = c_custkey
)
SELECT eventtype, day, segment, cast(grouping(eventtype, day, segment) AS BIGINT) AS grouping_id, count(*) AS n, count(DISTINCT user_id) AS users
FROM facts GROUP BY CUBE (eventtype, day, segment)""",
    "sink_types_roundtrip": f"""
SELECT event_id AS id, CASE WHEN keep THEN cast(ts AS DATE) END AS d, CASE WHEN keep THEN ts END AS t,
       CASE WHEN keep THEN cast(event_id % 100 AS INTEGER) END AS b, CASE WHEN keep THEN cast({_MONEY} AS DOUBLE) END AS dec,
       CASE WHEN keep THEN event_type END AS bin, CASE WHEN keep THEN user_id > 50 END AS flag,
       CASE WHEN keep THEN user_id END AS xs0, CASE WHEN keep THEN event_id END AS xs2,
       CASE WHEN keep THEN value END AS mv, CASE WHEN keep THEN props END AS p
FROM (SELECT *, event_id % 7 <> 0 AS keep FROM events)""",
    "stream_ingest": _LATEST,
    "stream_resume": _LATEST,
    "stream_progress": """
SELECT 'events' AS topic, cast(user_id % 4 AS INTEGER) AS partition, min(event_id) AS min_offset, max(event_id) AS max_offset,
       count(*) AS messages FROM events GROUP BY 1, 2""",
    "saved_offsets": """
SELECT 'events' AS topic, string_agg(p || ':' || o, ',' ORDER BY p) AS offsets
FROM (SELECT user_id % 4 AS p, min(event_id) AS o FROM events GROUP BY 1)""",
    "agg_stream_tumbling": _windows("6 HOURS", "6 HOURS"),
    "agg_stream_sliding": _windows("1 DAY", "6 HOURS"),
    "agg_stream_late": _windows(
        "1 HOUR",
        "1 HOUR",
        "AND window_start + INTERVAL 1 HOUR <= (SELECT date_trunc('millisecond', max(ts)) - INTERVAL 10 MINUTES FROM events)",
    ),
    "agg_stream_session": f"""
WITH starts AS (
  SELECT *, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts) <= INTERVAL 2 HOURS THEN 0 ELSE 1 END AS is_new FROM events
), numbered AS (
  SELECT *, sum(is_new) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS s FROM starts
)
SELECT min(ts) AS window_start, max(ts) + INTERVAL 2 HOURS AS window_end, user_id, count(*) AS n,
       cast(sum({_MONEY}) AS DOUBLE) AS total, cast(max({_MONEY}) AS DOUBLE) AS top
FROM numbered GROUP BY user_id, s
HAVING max(ts) + INTERVAL 2 HOURS <= (SELECT date_trunc('millisecond', max(ts)) - INTERVAL 10 MINUTES FROM events)""",
    "enrich_stream": """
SELECT event_id, event_type, c_name, c_mktsegment FROM events LEFT JOIN customer ON user_id = c_custkey""",
    "agg_batch": f"""
SELECT event_type AS eventtype, count(*) AS n, count(DISTINCT user_id) AS users, cast(sum({_MONEY}) AS DOUBLE) AS total,
       cast(min({_MONEY}) AS DOUBLE) AS lowest, cast(max({_MONEY}) AS DOUBLE) AS highest,
       cast(sum({_MONEY}) AS DOUBLE) / count(*) AS mean FROM events GROUP BY 1""",
    "agg_approx_users": """
SELECT event_type AS eventtype, count(DISTINCT user_id) AS users, true AS within_a_fifth FROM events GROUP BY 1""",
    "enrich_dimension": """
SELECT event_id, user_id, value, c_name, c_nationkey, n_name, n_regionkey, r_name FROM events
LEFT JOIN customer ON user_id = c_custkey LEFT JOIN nation ON c_nationkey = n_nationkey
LEFT JOIN region ON n_regionkey = r_regionkey""",
    "cube_events": _summary("CUBE (eventtype, day, segment)"),
    "rollup_events": _summary("ROLLUP (eventtype, day, segment)"),
    "grouping_sets_events": _summary("GROUPING SETS ((eventtype, segment), (day), ())"),
    "sql_filter_project": f"""
SELECT event_id AS eventid, user_id AS userid, value * 2 AS doubled, upper(event_type) AS kind FROM events
WHERE event_type = 'purchase' AND value >= 10 AND {_K} < 50""",
    "sql_window": """
SELECT event_id AS eventid, user_id AS userid, cast(row_number() OVER w AS INTEGER) AS visit, value - lag(value) OVER w AS change
FROM events WHERE event_type = 'click' WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)""",
    "sql_topk": """
SELECT o_orderkey, o_custkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 25""",
    "sql_setops": """
WITH seen AS (SELECT event_type, user_id AS userid, cast(ts AS DATE) AS d FROM events)
(SELECT userid, d FROM seen WHERE event_type = 'click' INTERSECT SELECT userid, d FROM seen WHERE event_type = 'view')
EXCEPT SELECT userid, d FROM seen WHERE event_type IN ('error', 'signup')""",
    "sql_join": """
SELECT o_orderstatus, count(*) AS pairs, count(DISTINCT user_id) AS users FROM events JOIN orders ON user_id = o_custkey
WHERE event_type = 'purchase' GROUP BY 1""",
    "sql_range_join": """
SELECT s.event_id AS signup_id, count(e.event_id) AS errors
FROM (SELECT * FROM events WHERE event_type = 'signup') s LEFT JOIN (SELECT * FROM events WHERE event_type = 'error') e
  ON s.user_id = e.user_id AND e.ts >= s.ts AND e.ts < s.ts + INTERVAL 1 HOUR GROUP BY 1""",
}

ORACLE |= timeline.SQL
