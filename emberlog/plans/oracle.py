"""For each query the same question in SQL, written apart from the DataFrame code."""

from __future__ import annotations

HIGH = 1.5
BURST = "timestamp >= TIMESTAMP '2024-01-02 12:00:00' AND timestamp < TIMESTAMP '2024-01-02 16:00:00'"
SILENT = "timestamp >= TIMESTAMP '2024-01-03 08:00:00' AND timestamp < TIMESTAMP '2024-01-03 12:00:00'"

LOGS = """
raw AS (
  SELECT event_id, user_id, event_type, props, date_trunc('millisecond', ts) AS timestamp,
         greatest(1, CAST(floor(value * 10) AS BIGINT)) AS response_time_ms,
         CASE WHEN event_type <> 'error' THEN 200 WHEN event_id % 3 = 0 THEN 500 WHEN event_id % 3 = 1 THEN 502
              ELSE 503 END AS status_code
  FROM events),
logs AS (
  SELECT event_id, timestamp, 'svc-' || (user_id % 3) AS service_id, '/api/' || event_type AS endpoint,
         CAST(status_code AS INTEGER) AS status_code, response_time_ms, 'ua-' || (user_id % 5) AS user_agent,
         CAST(hour(timestamp) AS INTEGER) AS hour_of_day,
         CASE WHEN isodow(timestamp) >= 6 THEN 1 ELSE 0 END AS is_weekend,
         CAST(1.0 AS DOUBLE) AS throughput_velocity, CAST(0.0 AS DOUBLE) AS error_acceleration, 0 AS is_surge,
         '[SVC-' || (user_id % 3) || ']:[' || upper(event_type) || ']:[' || (status_code // 100) || 'xx]'
           AS log_signature,
         props AS log_payload,
         CASE WHEN status_code >= 500 OR response_time_ms > 2000 THEN 1 ELSE 0 END AS is_anomaly
  FROM raw)"""

SCORED = LOGS + """,
latency AS (SELECT service_id, avg(response_time_ms) AS m, stddev_pop(response_time_ms) AS s FROM logs GROUP BY 1),
scored AS (
  SELECT logs.*, round(coalesce((response_time_ms - m) / nullif(s, 0), 0), 6) AS anomaly_score
  FROM logs JOIN latency USING (service_id))"""

MESSAGES = LOGS + """,
messages AS (
  SELECT *, CASE status_code
      WHEN 500 THEN 'Call to ' || endpoint || ' failed: TimeoutException after ' || response_time_ms || 'ms'
      WHEN 502 THEN 'Call to ' || endpoint || ' failed: connection reset by peer'
      WHEN 503 THEN 'Call to ' || endpoint || ' failed: OrderValidationException: missing field'
      ELSE 'rid=' || event_id || ' msg=ok' END AS message
  FROM logs)"""

KINDS = MESSAGES + """,
kinds AS (
  SELECT *, nullif(regexp_extract(message, '([A-Za-z0-9_]+(?:Exception|Error))', 1), '') AS exception_class,
    CASE WHEN message LIKE '%OrderValidationException%' THEN 'VALIDATION'
         WHEN lower(message) LIKE '%timeout%' THEN 'TIMEOUT'
         WHEN lower(message) LIKE '%connection reset%' THEN 'CONNECTION'
         WHEN status_code >= 500 THEN 'UNEXPECTED' END AS error_kind,
    CASE WHEN status_code >= 500 THEN 'ERROR' ELSE 'INFO' END AS log_level
  FROM messages)"""


def islands(source: str, gap: str) -> str:
    """Rows of ``source`` by episode: a row more than ``gap`` after the one before it begins a new one."""
    return f""",
marks AS (
  SELECT *, CASE WHEN timestamp <= lag(timestamp) OVER w + INTERVAL {gap} THEN 0 ELSE 1 END AS fresh
  FROM {source} WINDOW w AS (PARTITION BY service_id ORDER BY timestamp, event_id)),
numbered AS (SELECT *, sum(fresh) OVER (PARTITION BY service_id ORDER BY timestamp, event_id ROWS UNBOUNDED PRECEDING) AS island FROM marks),
ranked AS (SELECT *, row_number() OVER (PARTITION BY service_id, island ORDER BY anomaly_score DESC, event_id) AS place FROM numbered),
episodes AS (
  SELECT service_id, min(timestamp) AS episode_start, max(timestamp) AS episode_end, count(*) AS n_alerts, max(anomaly_score) AS peak_score,
         string_agg(event_id, ',' ORDER BY place) FILTER (WHERE place <= 3) AS examples, min(event_id) FILTER (WHERE place = 1) AS peak_id
  FROM ranked GROUP BY service_id, island)"""


FIRST_SEEN = """, hours AS (
  SELECT service_id, log_signature, date_trunc('hour', timestamp) AS window_start, count(*) AS n FROM logs GROUP BY ALL),
since AS (SELECT *, lag(window_start) OVER (PARTITION BY service_id, log_signature ORDER BY window_start) AS before FROM hours)
SELECT service_id, log_signature, window_start, n FROM since WHERE (before IS NULL OR window_start > before + INTERVAL 6 HOUR)"""

# A service that had an episode within the eight hours before is not notified again.
NOTIFIED = """CASE WHEN episode_start <= lag(episode_end) OVER (PARTITION BY service_id ORDER BY episode_start) + INTERVAL 8 HOUR
    THEN 0 ELSE 1 END AS is_notified"""


def template_sql(source: str, depth: int, fanout: int) -> str:
    """The template of each ``message`` of ``source``, level by level."""
    sql = f"""
split0 AS (SELECT *, list_transform(list_filter(regexp_split_to_array(coalesce(message, ''), '\\s+'), lambda w: w <> ''),
             lambda w: CASE WHEN regexp_matches(w, '[0-9]') THEN '<*>' ELSE w END) AS words FROM {source}),
path0 AS (SELECT *, CAST(len(words) AS VARCHAR) AS path FROM split0)"""
    for i in range(1, depth + 1):
        sql += f""",
path{i} AS (SELECT * REPLACE (CASE WHEN words[{i}] IS NULL THEN path ELSE path || ' ' ||
             CASE WHEN count(DISTINCT words[{i}]) OVER (PARTITION BY path) > {fanout} THEN '<*>' ELSE words[{i}] END END AS path) FROM path{i - 1})"""
    return sql + f""",
places AS (SELECT event_id, path, words[i] AS word, i FROM path{depth}, unnest(range({depth + 1}, len(words) + 1)) AS r(i)),
judged AS (SELECT event_id, i, CASE WHEN count(DISTINCT word) OVER (PARTITION BY path, i) > {fanout} THEN '<*>' ELSE word END AS word FROM places),
tails AS (SELECT event_id, string_agg(word, ' ' ORDER BY i) AS tail FROM judged GROUP BY 1)
SELECT event_id, service_id, CASE WHEN len(words) > 0 THEN substr(path, instr(path, ' ') + 1) || coalesce(' ' || tail, '') END AS template
FROM path{depth} LEFT JOIN tails USING (event_id)"""


def buckets(unit: str, source: str = "logs") -> str:
    return f""",
buckets AS (
  SELECT service_id, date_trunc('{unit}', timestamp) AS window_start, count(*) AS total_reqs,
         count(*) FILTER (WHERE status_code >= 500) AS error_reqs
  FROM {source} GROUP BY ALL),
rates AS (SELECT *, error_reqs / nullif(total_reqs, 0) AS error_rate FROM buckets)"""


def row_context(unit: str, source: str = "logs") -> str:
    return buckets(unit, source) + """,
ctx AS (
  SELECT *, total_reqs / nullif(avg(total_reqs) OVER ten, 0) AS velocity,
         lag(error_rate, 10) OVER series AS then_rate,
         (total_reqs - avg(total_reqs) OVER hour61) / nullif(stddev_pop(total_reqs) OVER hour61, 0) AS z
  FROM rates
  WINDOW series AS (PARTITION BY service_id ORDER BY window_start),
         ten AS (PARTITION BY service_id ORDER BY window_start ROWS BETWEEN 9 PRECEDING AND CURRENT ROW),
         hour61 AS (PARTITION BY service_id ORDER BY window_start ROWS BETWEEN 60 PRECEDING AND CURRENT ROW))"""


HOUR_RANGE_CONTEXT = buckets("hour") + """,
ctx AS (
  SELECT a.*, total_reqs / nullif(avg(total_reqs) OVER ten, 0) AS velocity, b.error_rate AS then_rate,
         (total_reqs - avg(total_reqs) OVER hour61) / nullif(stddev_pop(total_reqs) OVER hour61, 0) AS z
  FROM rates a LEFT JOIN (SELECT service_id, window_start + INTERVAL 10 HOUR AS window_start, error_rate FROM rates) b
    USING (service_id, window_start)
  WINDOW ten AS (PARTITION BY service_id ORDER BY window_start
                 RANGE BETWEEN INTERVAL 9 HOUR PRECEDING AND CURRENT ROW),
         hour61 AS (PARTITION BY service_id ORDER BY window_start
                 RANGE BETWEEN INTERVAL 60 HOUR PRECEDING AND CURRENT ROW))"""

CONTEXT_REPORT = """
SELECT service_id, window_start, total_reqs, error_reqs, round(error_rate, 6) AS error_rate,
       round(coalesce(velocity, 1), 6) AS throughput_velocity,
       round(coalesce(error_rate / nullif(then_rate, 0), 0), 6) AS error_acceleration,
       CASE WHEN z > 3.000000001 THEN 1 ELSE 0 END AS is_surge, coalesce(then_rate > 0, false) AS has_baseline
FROM ctx"""


def context_view(unit: str, where: str = "true") -> str:
    return f"""
SELECT l.event_id, l.timestamp, l.service_id, l.endpoint, l.status_code, l.response_time_ms, l.hour_of_day,
       round(coalesce(velocity, 1), 6) AS throughput_velocity,
       round(coalesce(error_rate / nullif(then_rate, 0), 0), 6) AS error_acceleration,
       CASE WHEN z > 3.000000001 THEN 1 ELSE 0 END AS is_surge, l.log_signature, l.log_payload, l.is_anomaly
FROM logs l LEFT JOIN ctx ON ctx.service_id = l.service_id AND ctx.window_start = date_trunc('{unit}', l.timestamp)
WHERE {where}"""


V2 = """event_id, timestamp, service_id, endpoint, status_code, response_time_ms, user_agent, hour_of_day, is_weekend,
throughput_velocity, error_acceleration, is_surge, log_signature, log_payload, is_anomaly"""

# Derived signatures carry the endpoint's template, which for these endpoints is the endpoint.
TEMPLATED = "'[' || upper(service_id) || ']:[' || endpoint || ']:[' || (status_code // 100) || 'xx]'"

ADAPTED = f"""WITH {LOGS}
SELECT event_id, timestamp, service_id, endpoint, status_code, response_time_ms, user_agent, log_payload, hour_of_day,
       is_weekend, {TEMPLATED} AS log_signature,
       CASE status_code WHEN 502 THEN 'DEPENDENCY_FAILURE' WHEN 503 THEN 'DEPENDENCY_FAILURE' WHEN 500 THEN 'UNEXPECTED'
            END AS error_kind,
       CASE WHEN status_code >= 500 THEN 'ERROR' ELSE 'INFO' END AS log_level
FROM logs"""

MIXED = LOGS + """,
mixed AS (
  SELECT event_id, timestamp, service_id, endpoint, status_code, response_time_ms, user_agent, is_anomaly, hour_of_day,
         is_weekend, throughput_velocity, error_acceleration, is_surge,
         CASE WHEN service_id <> 'svc-0' THEN log_signature END AS log_signature,
         CASE WHEN service_id <> 'svc-0' THEN log_payload END AS log_payload,
         CASE WHEN service_id = 'svc-0' THEN 1 ELSE 2 END AS schema_version
  FROM logs)"""

MINUTE_ROLLUP = """SELECT service_id, date_trunc('minute', timestamp) AS window_start, hour_of_day,
       count(*) AS total_reqs, count(*) FILTER (WHERE status_code >= 500) AS error_reqs
FROM logs GROUP BY ALL"""

STATS = """count(*) AS n, min(anomaly_score) AS min_score, max(anomaly_score) AS max_score,
       round(avg(anomaly_score), 6) AS avg_score, count(*) - count(anomaly_score) AS null_scores"""


def confusion(t: str) -> str:
    return f"""count(*) FILTER (WHERE is_anomaly = 1 AND anomaly_score >= {t}) AS tp,
       count(*) FILTER (WHERE is_anomaly = 0 AND anomaly_score >= {t}) AS fp,
       count(*) FILTER (WHERE is_anomaly = 1 AND anomaly_score < {t}) AS fn,
       count(*) FILTER (WHERE is_anomaly = 0 AND anomaly_score < {t}) AS tn"""


RATES = """round(CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0 END, 6) AS precision,
       round(CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0 END, 6) AS recall,
       round(CASE WHEN 2 * tp + fp + fn > 0 THEN 2 * tp / (2 * tp + fp + fn) ELSE 0 END, 6) AS f1"""


def near(spans: str, target: str) -> str:
    """Rows inside a closed span of their service, as a flag."""
    return f"""
SELECT event_id, timestamp, service_id,
       CASE WHEN EXISTS (SELECT 1 FROM {spans} s WHERE s.service_id = logs.service_id
                           AND logs.timestamp >= s.lo AND logs.timestamp <= s.hi) THEN 1 ELSE 0 END AS {target}
FROM logs"""


SHIFTED = LOGS + f""",
shifted AS (SELECT * REPLACE (CASE WHEN {SILENT} THEN '[ORDER]:[CHECKOUT]:[EMPTY_RESULT]' ELSE log_signature END
                              AS log_signature) FROM logs)"""

BURSTED = LOGS + f""",
bursted AS (
  SELECT * REPLACE (CASE WHEN {BURST} THEN 200 ELSE status_code END AS status_code,
                    CASE WHEN {BURST} THEN least(1000, response_time_ms) ELSE response_time_ms END AS response_time_ms,
                    CASE WHEN {BURST} THEN 0 ELSE is_anomaly END AS is_anomaly)
  FROM logs, (SELECT unnest(range(10)) AS copy) WHERE copy = 0 OR ({BURST}))"""

WORDS = r"""words AS (
  SELECT doc_id, token, count(*) AS n
  FROM (SELECT doc_id, unnest(regexp_split_to_array(lower(text), '[ \t\r\n]+')) AS token FROM documents)
  WHERE token <> '' GROUP BY ALL),
corpus AS (SELECT token, sum(n) AS corpus_n FROM words GROUP BY 1),
total AS (SELECT sum(n) AS t FROM words)"""

MASKED = r"""regexp_replace(regexp_replace(regexp_replace(regexp_replace(text,
  '[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+', '<email>', 'g'),
  '[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}', '<guid>', 'g'),
  '0x[0-9a-fA-F]+', '<hex>', 'g'), '[0-9]+', '<num>', 'g')"""

PLACE = "CAST('0x' || substr(md5('42|' || event_id), 1, 8) AS BIGINT) % 100"

def isolation_sql(features: tuple[str, ...], trees: int, tree_rows: int, depth: int) -> str:
    """The forest grown and walked level by level; a node's children have twice its number, and one more."""
    values = "[" + ", ".join(f"CAST({c} AS DOUBLE)" for c in features) + "]"
    pick = "CAST('0x' || substr(md5('42:' || tree || ':' || node), 1, 6) AS BIGINT)"
    share = "CAST('0x' || substr(md5('42:' || tree || ':' || node), 7, 6) AS BIGINT) / 16777216.0::DOUBLE"
    path = "CASE WHEN n <= 1 THEN 0 WHEN n = 2 THEN 1 ELSE 2 * (ln(n - 1) + 0.5772156649015329::DOUBLE) - 2 * (n - 1) / n END"
    parts = [f"""WITH {LOGS},
pool AS (SELECT {values} AS v, row_number() OVER (ORDER BY md5('42|' || event_id), event_id) - 1 AS k FROM logs),
total AS (SELECT least(count(*), {trees * tree_rows}) AS n FROM pool),
s0 AS MATERIALIZED (SELECT k % {trees} AS tree, 1 AS node, v FROM pool WHERE k < {trees * tree_rows}),
r0 AS MATERIALIZED (SELECT event_id, {values} AS v, tree, 1 AS node FROM logs, (SELECT unnest(range({trees})) AS tree))"""]
    for level in range(depth + 1):
        last = "true" if level == depth else "n <= 1 OR low = high"
        parts.append(f"""n{level} AS MATERIALIZED (
  SELECT *, low + (high - low) * ({share}) AS cut, {last} AS leaf FROM (
    SELECT tree, node, f, count(*) AS n, min(v[f + 1]) AS low, max(v[f + 1]) AS high
    FROM (SELECT *, {pick} % {len(features)} AS f FROM s{level}) GROUP BY ALL)),
e{level} AS (SELECT event_id, {level} + {path} AS path FROM r{level} JOIN n{level} USING (tree, node) WHERE leaf)""")
        if level < depth:
            for rows, own in (("s", ""), ("r", "event_id, ")):
                parts.append(f"""{rows}{level + 1} AS MATERIALIZED (SELECT {own}v, tree, 2 * node + CAST(v[f + 1] >= cut AS INTEGER) AS node
  FROM {rows}{level} JOIN n{level} USING (tree, node) WHERE NOT leaf)""")
    # A side that no sampled row is on is a leaf without rows.
    for level in range(1, depth + 1):
        parts.append(f"x{level} AS (SELECT event_id, {level} AS path FROM r{level} ANTI JOIN n{level} USING (tree, node))")
    ends = " UNION ALL ".join([f"SELECT * FROM e{level}" for level in range(depth + 1)] + [f"SELECT * FROM x{level}" for level in range(1, depth + 1)])
    return ",\n".join(parts) + f""",
paths AS (SELECT event_id, sum(path) AS path FROM ({ends}) GROUP BY 1),
typical AS (SELECT {path} AS c FROM (SELECT CAST(ceil(n / {trees}.0) AS BIGINT) AS n FROM total))
SELECT event_id, {', '.join(features)}, round(pow(2.0::DOUBLE, -path / ({trees} * c)), 6) AS anomaly_score
FROM logs JOIN paths USING (event_id), typical"""


ORACLE: dict[str, str] = {
    "envelope_v2": f"WITH {LOGS} SELECT {V2} FROM logs",
    "envelope_v1": f"""WITH {LOGS} SELECT event_id, timestamp, service_id, endpoint, status_code, response_time_ms,
        user_agent, is_anomaly FROM logs""",
    "training_frame": f"""WITH {LOGS} SELECT status_code, response_time_ms, throughput_velocity, error_acceleration,
        hour_of_day, service_id, endpoint, log_signature, is_anomaly FROM logs""",
    "training_frame_v1": f"""WITH {LOGS} SELECT status_code, response_time_ms, service_id, endpoint, user_agent,
        is_anomaly FROM logs""",
    "calendar_features": f"""WITH {LOGS} SELECT event_id, hour_of_day,
        CAST(isodow(timestamp) - 1 AS INTEGER) AS day_of_week, is_weekend,
        least(1000, greatest(1, response_time_ms)) AS clamped_ms FROM logs""",
    "range_violations": f"""WITH {LOGS} SELECT
        count(*) FILTER (WHERE status_code NOT BETWEEN 0 AND 65535) AS status_code,
        count(*) FILTER (WHERE response_time_ms NOT BETWEEN 0 AND 4294967295) AS response_time_ms,
        count(*) FILTER (WHERE hour_of_day NOT BETWEEN 0 AND 23) AS hour_of_day,
        count(*) FILTER (WHERE is_weekend NOT IN (0, 1)) AS is_weekend,
        count(*) FILTER (WHERE is_surge NOT IN (0, 1)) AS is_surge,
        count(*) FILTER (WHERE is_anomaly NOT IN (0, 1)) AS is_anomaly FROM logs""",
    "json_adapter": ADAPTED,
    "text_adapter": ADAPTED,
    # Two of the three formats carry no label, which then is unknown.
    "union_sources": f"""WITH {LOGS} SELECT * REPLACE (CASE WHEN service_id = 'svc-2' THEN is_anomaly END AS is_anomaly,
        CASE WHEN service_id = 'svc-2' THEN log_signature ELSE {TEMPLATED} END AS log_signature) FROM logs""",
    "unlabelled_rows": f"""WITH {LOGS} SELECT CASE WHEN service_id <> 'svc-2' THEN 'none' ELSE CAST(is_anomaly AS VARCHAR) END AS what,
        count(*) AS n FROM logs GROUP BY 1
        UNION ALL SELECT 'training', count(*) FROM logs WHERE service_id = 'svc-2'""",
    "adapter_rejects": """WITH f AS (SELECT unnest(['json', 'text']) AS format), k AS (
        SELECT format, event_id, CASE event_id % 10 WHEN 3 THEN 'malformed'
          WHEN 4 THEN 'bad value: ' || CASE format WHEN 'json' THEN 'status_code' ELSE 'event_id' END ELSE 'ok' END AS outcome FROM events, f)
        SELECT format, outcome, count(*) AS n, count(*) AS lines_kept FROM k GROUP BY ALL""",
    "derived_signatures": f"""WITH {LOGS}, s AS (SELECT CASE event_id % 6
          WHEN 0 THEN CASE WHEN status_code >= 500 THEN upper(service_id) || ']:[PaymentException]:[shop.Pay.charge'
                           ELSE upper(service_id) || ']:[/orders/*/items]:[' || (status_code // 100) || 'xx' END
          WHEN 1 THEN 'UNKNOWN]:[UNKNOWN]:[' || (status_code // 100) || 'xx'
          WHEN 2 THEN upper(service_id) || ']:[checkout]:[' || CASE WHEN status_code >= 500 THEN 'DEPENDENCY_FAILURE' ELSE '2xx' END
          WHEN 3 THEN 'ORDERS]:[/orders/*]:[' || (status_code // 100) || 'xx'
          WHEN 4 THEN 'PAYMENTS]:[PaymentGateway.charge]:[TIMEOUT'
          ELSE 'CHECKOUT]:[OrderValidationException]:[VALIDATION' END AS rest FROM logs)
        SELECT '[' || rest || ']' AS log_signature, count(*) AS n FROM s GROUP BY ALL""",
    "mixed_versions": f"WITH {MIXED} SELECT * FROM mixed",
    "version_filter": f"WITH {MIXED} SELECT event_id, service_id, schema_version FROM mixed WHERE schema_version = 2",
    "append_readback": f"WITH {LOGS} SELECT {V2} FROM logs WHERE {BURST}",
    "append_whole": f"WITH {LOGS} SELECT {V2}, (SELECT count(*) FROM events) AS written FROM logs",
    "catalog_roundtrip": f"""WITH {LOGS} SELECT 15 AS columns, count(*) AS n, CAST(sum(response_time_ms) AS BIGINT) AS total_ms,
        count(*) FILTER (WHERE is_anomaly = 1) AS n_bad, CAST(0 AS BIGINT) AS left, true AS there, true AS gone FROM logs""",
    "export_anomalies": f"""WITH {SCORED} SELECT event_id, timestamp, service_id, anomaly_score FROM scored
        WHERE anomaly_score > {HIGH}""",
    "rollup_minute": f"WITH {LOGS} {MINUTE_ROLLUP}",
    "rollup_hour": f"WITH {LOGS} {buckets('hour')} SELECT service_id, window_start, total_reqs, error_reqs FROM buckets",
    "rollup_partial_merge": f"WITH {LOGS} {MINUTE_ROLLUP}",
    "control_totals": f"""WITH {LOGS} SELECT count(DISTINCT (service_id, date_trunc('minute', timestamp))) AS buckets,
        count(*) AS total_reqs, count(*) FILTER (WHERE status_code >= 500) AS error_reqs FROM logs""",
    "retention_14d": f"""WITH {LOGS}, r AS ({MINUTE_ROLLUP})
        SELECT * FROM r WHERE window_start >= (SELECT max(ts) FROM events) - INTERVAL 14 DAY""",
    "context_rows": f"WITH {LOGS} {row_context('hour')} {CONTEXT_REPORT}",
    "context_rows_minute": f"WITH {LOGS} {row_context('minute')} {CONTEXT_REPORT}",
    "context_chunked": f"WITH {LOGS} {row_context('hour')} {CONTEXT_REPORT}",
    "context_range": f"WITH {LOGS} {HOUR_RANGE_CONTEXT} {CONTEXT_REPORT}",
    "scored_context": f"WITH {LOGS} {row_context('hour')} {context_view('hour')}",
    "scored_context_minute": f"WITH {LOGS} {row_context('minute')} {context_view('minute')}",
    "live_view": f"WITH {LOGS} {row_context('minute')} {context_view('minute')}",
    "training_events": f"""WITH {LOGS} {row_context('minute')}, v AS ({context_view('minute')})
        SELECT event_id, status_code, response_time_ms, throughput_velocity, error_acceleration, hour_of_day, service_id, endpoint,
               log_signature, is_anomaly FROM v""",
    "split_rows": f"SELECT event_id, CASE WHEN {PLACE} < 80 THEN 'train' ELSE 'test' END AS side FROM events",
    "model_quality": f"SELECT count(*) AS n, CAST(0 AS BIGINT) AS null_scores, true AS good_f1 FROM events WHERE {PLACE} >= 80",
    "model_roundtrip": "SELECT count(*) AS n, count(*) AS n_equal FROM events",
    "model_record": """SELECT 'v2' AS version, 'status_code,response_time_ms,throughput_velocity,error_acceleration,hour_of_day,'
        || 'service_id,endpoint,log_signature' AS features, 500 AS rounds, CAST(count(*) AS DOUBLE) AS n_rows FROM events""",
    "burst_quiet": f"WITH {LOGS} SELECT 10 * count(*) AS n, true AS fast, true AS quiet FROM logs WHERE {BURST}",
    "cluster_assign": f"""WITH {LOGS}, far AS (SELECT event_id, status_code, response_time_ms, unnest([0, 1, 2]) AS cluster,
          sqrt(pow(status_code / 100.0 - unnest([2.0, 2.0, 5.0]), 2) + pow(response_time_ms / 1000.0 - unnest([0.5, 2.5, 1.0]), 2)) AS d FROM logs)
        SELECT event_id, any_value(status_code) AS status_code, any_value(response_time_ms) AS response_time_ms,
               CAST(arg_min(cluster, d + cluster * 1e-12) AS INTEGER) AS cluster, round(min(d), 6) AS distance FROM far GROUP BY event_id""",
    "scored_between": f"WITH {LOGS} {HOUR_RANGE_CONTEXT} {context_view('hour', BURST)}",
    "rolling_latency": f"""WITH {LOGS}, h AS (
        SELECT service_id, date_trunc('hour', timestamp) AS window_start, count(*) AS total_reqs,
               CAST(sum(response_time_ms) AS BIGINT) AS latency_sum FROM logs GROUP BY ALL)
        SELECT *, round(latency_sum / total_reqs, 6) AS avg_latency,
               round(sum(latency_sum) OVER w / sum(total_reqs) OVER w, 6) AS rolling_latency
        FROM h WINDOW w AS (PARTITION BY service_id ORDER BY window_start ROWS BETWEEN 9 PRECEDING AND CURRENT ROW)""",
    "seasonal_baseline": f"""WITH {LOGS} {buckets('hour')}, b AS (
        SELECT service_id, window_start, total_reqs, error_reqs, CAST(hour(window_start) AS INTEGER) AS hour_of_day
        FROM buckets),
        u AS (SELECT service_id, hour_of_day, avg(total_reqs) AS usual_reqs,
                     sum(error_reqs) / sum(total_reqs) AS usual_error_rate FROM b GROUP BY ALL)
        SELECT service_id, window_start, total_reqs, error_reqs, hour_of_day, round(usual_reqs, 6) AS usual_reqs,
               round(usual_error_rate, 6) AS usual_error_rate, round(total_reqs / usual_reqs, 6) AS vs_usual
        FROM b JOIN u USING (service_id, hour_of_day)""",
    "score_stats": f"WITH {SCORED} SELECT {STATS} FROM scored",
    "score_by_label": f"WITH {SCORED} SELECT is_anomaly, {STATS} FROM scored GROUP BY is_anomaly ORDER BY is_anomaly",
    "score_center": f"""WITH {SCORED} SELECT is_anomaly, count(*) AS n, round(avg(anomaly_score), 6) AS avg_score,
        round(median(anomaly_score), 6) AS median_score FROM scored GROUP BY is_anomaly""",
    "score_histogram": f"""WITH {SCORED} SELECT floor(anomaly_score / 0.25) * 0.25 AS bin_start, count(*) AS n
        FROM scored GROUP BY 1""",
    "threshold_p90": f"WITH {SCORED} SELECT round(quantile_cont(anomaly_score, 0.9), 6) AS threshold FROM scored",
    "confusion": f"WITH {SCORED} SELECT {confusion(str(HIGH))} FROM scored",
    "precision_recall_f1": f"""WITH {SCORED}, c AS (SELECT {confusion(str(HIGH))} FROM scored)
        SELECT tp, fp, fn, tn, {RATES} FROM c""",
    "validation_report": f"""WITH {SCORED}, q AS (SELECT quantile_cont(anomaly_score, 0.9) AS t FROM scored),
        c AS (SELECT count(*) AS total_rows, count(*) FILTER (WHERE is_anomaly IS NULL) AS n_unlabelled, count(*) - count(anomaly_score) AS null_scores,
          min(anomaly_score) AS min_score, max(anomaly_score) AS max_score, round(avg(anomaly_score), 6) AS avg_score,
          count(*) FILTER (WHERE is_anomaly = 0) AS n_0, min(anomaly_score) FILTER (WHERE is_anomaly = 0) AS min_score_0,
          max(anomaly_score) FILTER (WHERE is_anomaly = 0) AS max_score_0,
          round(avg(anomaly_score) FILTER (WHERE is_anomaly = 0), 6) AS avg_score_0,
          count(*) FILTER (WHERE is_anomaly = 1) AS n_1, min(anomaly_score) FILTER (WHERE is_anomaly = 1) AS min_score_1,
          max(anomaly_score) FILTER (WHERE is_anomaly = 1) AS max_score_1,
          round(avg(anomaly_score) FILTER (WHERE is_anomaly = 1), 6) AS avg_score_1,
          round(max(t), 6) AS threshold, {confusion('t')}
          FROM scored, q)
        SELECT *, {RATES} FROM c""",
    "anomaly_ratio": f"""WITH {LOGS} SELECT service_id, count(*) AS n, count(*) FILTER (WHERE is_anomaly = 1)
        AS n_anomalies, round(avg(is_anomaly), 6) AS anomaly_ratio FROM logs GROUP BY service_id""",
    "count_parity": f"""WITH {SCORED} SELECT (SELECT count(*) FROM events) AS left_rows,
        (SELECT count(*) FROM scored) AS right_rows, (SELECT count(*) FROM events) = (SELECT count(*) FROM scored)
        AS equal""",
    "max_score_in_range": f"""WITH {SCORED} SELECT count(*) AS n, max(anomaly_score) AS max_score FROM scored
        WHERE {BURST}""",
    "distinct_signatures": f"WITH {LOGS} SELECT log_signature, count(*) AS n FROM logs GROUP BY 1",
    "top_scores": f"""WITH {SCORED} SELECT event_id, timestamp, service_id, endpoint, status_code, response_time_ms,
        anomaly_score FROM scored ORDER BY anomaly_score DESC, event_id LIMIT 20""",
    "latest_events": f"""WITH {LOGS} SELECT event_id, timestamp, service_id, endpoint FROM logs
        ORDER BY timestamp DESC, event_id LIMIT 20""",
    "recent_hour": f"""WITH {SCORED} SELECT event_id, timestamp, endpoint, status_code, anomaly_score FROM scored
        WHERE timestamp >= (SELECT max(ts) FROM events) - INTERVAL 1 HOUR""",
    "above_threshold": f"""WITH {SCORED} SELECT event_id, timestamp, service_id, endpoint, anomaly_score FROM scored
        WHERE anomaly_score > {HIGH}""",
    "top_endpoints": f"""WITH {SCORED} SELECT endpoint, count(*) AS n FROM scored WHERE anomaly_score > {HIGH}
        GROUP BY endpoint ORDER BY n DESC, endpoint""",
    "top_n_per_hour": f"""WITH {SCORED}, r AS (
        SELECT date_trunc('hour', timestamp) AS hour_start, event_id, service_id, endpoint, anomaly_score,
               CAST(row_number() OVER (PARTITION BY date_trunc('hour', timestamp)
                                       ORDER BY anomaly_score DESC, event_id) AS INTEGER) AS rank FROM scored)
        SELECT * FROM r WHERE rank <= 3""",
    "service_percentiles": f"""WITH {SCORED} SELECT service_id, round(quantile_cont(anomaly_score, 0.9), 6) AS p90,
        round(quantile_cont(anomaly_score, 0.95), 6) AS p95 FROM scored GROUP BY service_id""",
    "service_thresholds": f"""WITH {SCORED}, t AS (
        SELECT *, CAST(CASE service_id WHEN 'svc-0' THEN 1.0 WHEN 'svc-1' THEN 2.0 ELSE {HIGH} END AS DOUBLE)
               AS threshold FROM scored)
        SELECT event_id, service_id, anomaly_score, threshold,
               CASE WHEN anomaly_score > threshold THEN 1 ELSE 0 END AS is_alert FROM t""",
    "p99_latency_rule": f"""WITH {LOGS} SELECT event_id, response_time_ms,
        CASE WHEN response_time_ms > (SELECT quantile_cont(response_time_ms, 0.99) FROM logs) THEN 1 ELSE 0 END
        AS is_slow FROM logs""",
    "rule_labels": f"""WITH {KINDS} SELECT event_id, status_code, log_level, error_kind, exception_class,
        CASE WHEN status_code >= 500 OR log_level IN ('ERROR', 'FATAL')
                  OR error_kind IN ('TIMEOUT', 'DEPENDENCY_FAILURE')
                  OR exception_class = 'OrderValidationException' THEN 1 ELSE 0 END AS is_anomaly FROM kinds""",
    "incident_labels": f"""WITH {LOGS} {row_context('hour')}, spans AS (
        SELECT service_id, window_start - INTERVAL 30 MINUTE AS lo, window_start + INTERVAL 30 MINUTE AS hi
        FROM ctx WHERE z > 3.000000001) {near('spans', 'is_anomaly')}""",
    "open_incidents": f"""WITH {LOGS} {row_context('hour')}, spans AS (
        SELECT service_id, window_start AS lo, CASE WHEN hour(window_start) % 2 = 0 THEN window_start + INTERVAL 1 HOUR
          ELSE (SELECT max(ts) FROM events) END AS hi FROM ctx WHERE z > 3.000000001) {near('spans', 'is_anomaly')}""",
    "tag_labels": f"""WITH {LOGS} SELECT event_id, CASE WHEN event_id IN (SELECT doc_id FROM labels WHERE toxic = 1)
        THEN 1 ELSE 0 END AS tagged FROM logs""",
    "tag_ranges": f"""WITH {LOGS}, spans AS (
        SELECT service_id, timestamp AS lo, timestamp + INTERVAL 30 MINUTE AS hi FROM (
          SELECT *, row_number() OVER (PARTITION BY service_id, CAST(timestamp AS DATE)
                                       ORDER BY response_time_ms DESC, event_id DESC) AS place FROM logs)
        WHERE place = 1) {near('spans', 'tagged')}""",
    "blocklist_agents": f"""WITH {LOGS} SELECT event_id, user_agent, CASE WHEN user_agent IN ('ua-4') THEN 1 ELSE 0 END
        AS is_blocked FROM logs""",
    "new_signatures": f"""WITH {SHIFTED} SELECT service_id, log_signature, count(*) AS n, min(timestamp) AS first_seen
        FROM shifted s WHERE timestamp >= TIMESTAMP '2024-01-03 08:00:00' AND NOT EXISTS (
          SELECT 1 FROM shifted h WHERE h.timestamp < TIMESTAMP '2024-01-03 08:00:00'
            AND h.service_id = s.service_id AND h.log_signature = s.log_signature)
        GROUP BY service_id, log_signature""",
    "signature_rarity": f"""WITH {SHIFTED} SELECT event_id, service_id, log_signature,
        round(-ln(count(*) OVER (PARTITION BY service_id, log_signature) / count(*) OVER (PARTITION BY service_id)), 6)
        + 0.0 AS rarity FROM shifted""",
    "signature_check": fr"""WITH {LOGS} SELECT
        regexp_full_match(log_signature, '\[[^\]]+\]:\[[^\]]+\]:\[[^\]]+\]') AS valid,
        CAST(status_code // 100 AS VARCHAR) || 'xx' AS status_class, count(*) AS n FROM logs GROUP BY ALL""",
    "endpoint_template": r"""WITH p AS (
        SELECT page_id, regexp_replace(split_part(split_part(url, '#', 1), '?', 1), '^[a-zA-Z]+://[^/]*', '') AS path
        FROM pages)
        SELECT page_id, CASE WHEN path = '' THEN '/' ELSE
          regexp_replace(regexp_replace(path, '/[0-9]+(/|\.|$)', '/*\1', 'g'), '/[0-9]+(/|\.|$)', '/*\1', 'g') END
          AS template FROM p""",
    "mask_tokens": f"SELECT doc_id, {MASKED} AS masked FROM documents",
    "error_kind": f"WITH {KINDS} SELECT error_kind, status_code, count(*) AS n FROM kinds GROUP BY ALL",
    "exception_class": f"WITH {KINDS} SELECT event_id, exception_class FROM kinds",
    "payload_split": f"WITH {MESSAGES} SELECT event_id, log_signature AS prefix, message AS payload FROM messages",
    "payload_kv": f"""WITH {LOGS} SELECT event_id,
        CASE WHEN status_code < 500 THEN CAST(event_id AS VARCHAR) END AS rid,
        CASE WHEN status_code < 500 THEN 'ok' END AS msg FROM logs""",
    "json_fields": "SELECT event_id, TRY_CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events",
    "outcome_enum": f"""WITH {LOGS} SELECT service_id, CASE WHEN status_code = 499 THEN 'CANCELLED'
        WHEN status_code >= 400 THEN 'FAIL' ELSE 'SUCCESS' END AS outcome,
        count(*) AS n FROM logs GROUP BY ALL""",
    "text_features": r"""SELECT doc_id,
        CAST(len(string_split(lower(text), 'timeout')) - 1 AS INTEGER) AS n_timeout,
        CAST(len(string_split(lower(text), 'connection reset')) - 1 AS INTEGER) AS n_connection_reset,
        CAST(len(string_split(lower(text), 'validation error')) - 1 AS INTEGER) AS n_validation_error,
        CAST(length(text) AS INTEGER) AS n_length,
        CAST(len(string_split(text, chr(10))) AS INTEGER) AS n_lines,
        CAST(len(regexp_extract_all(text, '(^|\n)[ \t]+at [^\n]*\(')) AS INTEGER) AS n_stack_frames
        FROM documents""",
    "embedding_columns": "SELECT vec_id, " + ", ".join(
        f"CAST(embedding[{i}] AS DOUBLE) AS payload_emb_{i}" for i in range(1, 65)) + " FROM embeddings",
    "payload_score": f"""WITH {WORDS} SELECT doc_id, CAST(sum(n) AS BIGINT) AS n_tokens,
        round(sum(n * -ln(corpus_n / t)) / sum(n), 6) AS payload_anomaly_score
        FROM words JOIN corpus USING (token), total GROUP BY doc_id""",
    "payload_score_blanks": f"""WITH {WORDS.replace('FROM documents)', 'FROM documents WHERE doc_id % 50 NOT IN (7, 8, 9))')},
        s AS (SELECT doc_id, CAST(sum(n) AS BIGINT) AS n_tokens, round(sum(n * -ln(corpus_n / t)) / sum(n), 6) AS payload_anomaly_score
              FROM words JOIN corpus USING (token), total GROUP BY doc_id)
        SELECT d.doc_id, coalesce(n_tokens, 0) AS n_tokens, payload_anomaly_score FROM documents d LEFT JOIN s USING (doc_id)""",
    "outlier_zscore": f"WITH {SCORED} SELECT event_id, service_id, response_time_ms, anomaly_score FROM scored",
    "outlier_mad": f"""WITH {LOGS}, m AS (SELECT service_id, median(response_time_ms) AS med,
        mad(CAST(response_time_ms AS DOUBLE)) AS dev FROM logs GROUP BY 1)
        SELECT event_id, service_id, response_time_ms, round(coalesce((response_time_ms - med) / nullif(dev, 0), 0), 6)
        AS anomaly_score FROM logs JOIN m USING (service_id)""",
    "sigmoid_score": f"""WITH {SCORED} SELECT event_id, anomaly_score, round(1 / (1 + exp(-anomaly_score)), 6)
        AS probability FROM scored""",
    "anomaly_series": f"""WITH {SCORED} SELECT date_trunc('hour', timestamp) AS bucket_start,
        count(*) FILTER (WHERE anomaly_score > {HIGH}) AS n_anomalies FROM scored GROUP BY 1""",
    "sliding_alerts": f"""WITH {SCORED}, starts AS (
        SELECT service_id, date_trunc('hour', timestamp) - back AS window_start
        FROM scored, (SELECT unnest([INTERVAL 0 HOUR, INTERVAL 1 HOUR]) AS back) WHERE anomaly_score > {HIGH})
        SELECT service_id, window_start, window_start + INTERVAL 2 HOUR AS window_end, count(*) AS n_anomalies
        FROM starts GROUP BY ALL HAVING count(*) >= 2""",
    "zscore_alerts": f"""WITH {SCORED}, s AS (
        SELECT service_id, date_trunc('hour', timestamp) AS bucket_start,
               count(*) FILTER (WHERE anomaly_score > {HIGH}) AS n_anomalies FROM scored GROUP BY ALL),
        z AS (SELECT *, (n_anomalies - avg(n_anomalies) OVER w) / nullif(stddev_pop(n_anomalies) OVER w, 0) AS z FROM s
        WINDOW w AS (PARTITION BY service_id ORDER BY bucket_start ROWS BETWEEN 60 PRECEDING AND CURRENT ROW))
        SELECT service_id, bucket_start, n_anomalies, round(z, 6) AS z FROM z WHERE z > 3.000000001""",
    "count_alert": f"""WITH {SCORED} SELECT count(*) AS n_anomalies FROM scored WHERE anomaly_score > {HIGH}
        HAVING count(*) > 10""",
    "alert_examples": f"""WITH {SCORED}, h AS (
        SELECT *, date_trunc('hour', timestamp) AS bucket_start FROM scored WHERE anomaly_score > {HIGH}),
        r AS (SELECT service_id, bucket_start, count(*) OVER (PARTITION BY service_id, bucket_start) AS n_anomalies,
                CAST(row_number() OVER (PARTITION BY service_id, bucket_start ORDER BY anomaly_score DESC, event_id)
                     AS INTEGER) AS rank, event_id, log_signature, log_payload,
                CASE status_code WHEN 502 THEN 'DEPENDENCY_FAILURE' WHEN 503 THEN 'DEPENDENCY_FAILURE' WHEN 500 THEN 'UNEXPECTED' END
                AS error_kind, anomaly_score FROM h)
        SELECT * FROM r WHERE n_anomalies >= 3 AND rank <= 2""",
    "alert_episodes": f"""WITH {SCORED}, high AS (SELECT * FROM scored WHERE anomaly_score > {HIGH}) {islands('high', '5 HOUR')}
        SELECT * EXCLUDE (peak_id), {NOTIFIED} FROM episodes""",
    "ordered_codes": f"""WITH {LOGS} SELECT event_id, """ + ", ".join(f"""
        round((coalesce(sum(is_anomaly) OVER {c}, 0) + 1) / (count(is_anomaly) OVER {c} + 10), 6) AS code_{c}""" for c in ("service_id", "log_signature", "user_agent")) + """
        FROM logs WINDOW """ + ", ".join(f"""{c} AS (PARTITION BY {c} ORDER BY timestamp RANGE BETWEEN UNBOUNDED PRECEDING
        AND INTERVAL 1 MICROSECOND PRECEDING)""" for c in ("service_id", "log_signature", "user_agent")) + "",
    "burst_whatif": f"""WITH {BURSTED} SELECT event_id, CAST(copy AS INTEGER) AS copy, timestamp, service_id,
        status_code, response_time_ms, is_anomaly FROM bursted""",
    "burst_context": f"""WITH {BURSTED} {row_context('hour', 'bursted')} {CONTEXT_REPORT}
        WHERE window_start >= TIMESTAMP '2024-01-02 12:00:00' AND window_start < TIMESTAMP '2024-01-02 16:00:00'""",
    "signature_shift_whatif": f"WITH {SHIFTED} SELECT event_id, timestamp, log_signature, is_anomaly FROM shifted",
    "stream_rollup": f"WITH {LOGS} {buckets('minute')} SELECT service_id, window_start, total_reqs, error_reqs FROM buckets",
    "partials_compacted": f"WITH {LOGS}, r AS ({MINUTE_ROLLUP}) SELECT * FROM r WHERE window_start >= TIMESTAMP '2024-01-04'",
    "stream_sliding_alerts": f"""WITH {LOGS}, slow AS (SELECT * FROM logs WHERE response_time_ms > 2000), starts AS (
        SELECT service_id, date_trunc('hour', timestamp) - back AS window_start
        FROM slow, (SELECT unnest([INTERVAL 0 HOUR, INTERVAL 1 HOUR]) AS back))
        SELECT service_id, window_start, window_start + INTERVAL 2 HOUR AS window_end, count(*) AS n_anomalies FROM starts
        WHERE window_start + INTERVAL 2 HOUR <= (SELECT max(timestamp) FROM slow) - INTERVAL 10 MINUTE
        GROUP BY ALL HAVING count(*) >= 2""",
    "stream_context": f"""WITH {LOGS} {row_context('hour')} SELECT service_id, window_start, total_reqs, error_reqs,
        round(velocity, 6) AS throughput_velocity, round(error_rate / nullif(then_rate, 0), 6) AS error_acceleration,
        CASE WHEN z > 3.000000001 THEN 1 ELSE 0 END AS is_surge FROM ctx
        WHERE window_start + INTERVAL 1 HOUR <= (SELECT max(timestamp) FROM logs) - INTERVAL 10 MINUTE""",
    "first_seen_signatures": f"WITH {LOGS} {FIRST_SEEN}",
    "stream_new_signatures": f"""WITH {LOGS} {FIRST_SEEN}
        AND window_start + INTERVAL 1 HOUR <= (SELECT max(timestamp) FROM logs) - INTERVAL 10 MINUTE""",
    "stream_alert_episodes": f"""WITH {LOGS}, slow AS (SELECT *, CAST(response_time_ms AS DOUBLE) AS anomaly_score FROM logs WHERE response_time_ms > 2000)
        {islands('slow', '5 HOUR')}
        SELECT service_id, episode_start, episode_end, n_alerts, peak_score, peak_id, {NOTIFIED} FROM episodes
        WHERE episode_end + INTERVAL 5 HOUR <= (SELECT max(timestamp) FROM slow) - INTERVAL 10 MINUTE""",
    "stream_incident_labels": f"""WITH {LOGS} {row_context('hour')}, surges AS (SELECT service_id, window_start AS began FROM ctx WHERE z > 3.000000001),
        seen AS (SELECT least((SELECT max(timestamp) FROM logs), (SELECT max(began) + INTERVAL 3 HOUR FROM surges)) - INTERVAL 10 MINUTE AS mark),
        hit AS (SELECT event_id, service_id, timestamp, CASE WHEN EXISTS (SELECT 1 FROM surges s WHERE s.service_id = l.service_id
            AND l.timestamp BETWEEN began - INTERVAL 30 MINUTE AND began + INTERVAL 30 MINUTE) THEN 1 ELSE 0 END AS is_anomaly FROM logs l)
        SELECT hit.* FROM hit, seen WHERE is_anomaly = 1 OR timestamp < mark - INTERVAL 6 HOUR""",
    "learned_templates": f"""WITH {LOGS}, told AS (
        SELECT event_id, service_id, CASE event_id % 50 WHEN 7 THEN ' ' WHEN 8 THEN 'ok' WHEN 9 THEN NULL ELSE CASE WHEN status_code >= 500
          THEN 'Call of ' || chr(CAST(97 + event_id % 20 AS INTEGER)) || ' failed: ' || CASE status_code WHEN 500 THEN 'timeout' ELSE 'connection reset' END
          ELSE 'Served ' || endpoint || ' to ' || chr(CAST(97 + event_id % 20 AS INTEGER)) || ' in ' || response_time_ms || 'ms with ' || log_payload
          END END AS message FROM logs),""" + template_sql("told", 3, 3),
    "stream_scored_model": f"""WITH {LOGS} {row_context('minute')}
        SELECT l.event_id, round(velocity, 6) AS throughput_velocity, CASE WHEN z > 3.000000001 THEN 1 ELSE 0 END AS is_surge,
               true AS scored, CAST(least((day(l.timestamp) - 1) // 8, 3) AS INTEGER) AS batch_id
        FROM logs l JOIN ctx ON ctx.service_id = l.service_id AND ctx.window_start = date_trunc('minute', l.timestamp)""",
    "stream_scored": f"""WITH {LOGS} {row_context('minute')}
        SELECT l.event_id, l.timestamp, l.service_id, round(velocity, 6) AS throughput_velocity,
               CASE WHEN z > 3.000000001 THEN 1 ELSE 0 END AS is_surge,
               round(1 / (1 + exp(1 - velocity)), 6) AS anomaly_score
        FROM logs l JOIN ctx ON ctx.service_id = l.service_id
          AND ctx.window_start = date_trunc('minute', l.timestamp)""",
    "thresholds_asof": f"""WITH {SCORED}, changes AS (
          SELECT service_id, timestamp AS valid_from, max(1 + (event_id % 5) / 2) AS threshold FROM scored WHERE event_id % 97 = 0 GROUP BY ALL)
        SELECT event_id, s.service_id, anomaly_score, coalesce(threshold, 1.25::DOUBLE) AS threshold,
               CASE WHEN anomaly_score > coalesce(threshold, 1.25::DOUBLE) THEN 1 ELSE 0 END AS is_alert
        FROM scored s ASOF LEFT JOIN changes c ON s.service_id = c.service_id AND s.timestamp >= c.valid_from""",
    "batch_scores": "SELECT count(*) AS n, count(*) AS n_close FROM events",
    "stream_rescored": f"""WITH {LOGS} {row_context('minute')}
        SELECT l.event_id, l.service_id, round(coalesce(velocity, 1), 6) AS throughput_velocity,
               round(coalesce(error_rate / nullif(then_rate, 0), 0), 6) AS error_acceleration,
               CASE WHEN z > 3.000000001 THEN 1 ELSE 0 END AS is_surge, round(1 / (1 + exp(1 - velocity)), 6) AS anomaly_score
        FROM logs l JOIN ctx ON ctx.service_id = l.service_id AND ctx.window_start = date_trunc('minute', l.timestamp)""",
    # The answers of sketches lie within their stated error; what they are is up to the sketch.
    "sketch_percentiles": f"""WITH {LOGS} SELECT service_id, count(*) AS total_reqs, count(*) FILTER (WHERE status_code >= 500) AS error_reqs,
        true AS p50_close, true AS p90_close, true AS p99_close, true AS distinct_close FROM logs GROUP BY 1""",
    "sketch_hours": f"""WITH {LOGS} SELECT service_id, date_trunc('hour', timestamp) AS window_start, count(*) AS total_reqs,
        count(*) FILTER (WHERE status_code >= 500) AS error_reqs, min(response_time_ms) AS least, max(response_time_ms) AS most,
        count(DISTINCT log_signature) AS n_signatures FROM logs GROUP BY 1, 2""",
    "isolation_score": isolation_sql(("status_code", "response_time_ms", "hour_of_day"), 16, 256, 8),
}
