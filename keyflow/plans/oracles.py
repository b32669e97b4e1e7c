"""DuckDB SQL oracles for the registered queries (tables are pre-registered views).

Each statement computes the same result as the Spark query of the same key,
by a direct (often brute-force) route, with the same column names and types.
Integer sums are cast to BIGINT (DuckDB would return HUGEINT); floating sums
go through exact decimals, as the Spark side does.
"""

from __future__ import annotations

# Java's \s class, as an RE2 character class.
_WS = r"'[ \t\n\x0B\f\r]+'"

_WORDS = f"regexp_split_to_array(lower(text), {_WS})"

_PAGES = r"""
pages_raw AS (
  SELECT ts AS arrival,
         regexp_split_to_array(
           regexp_replace(concat_ws('|', CAST(ts AS VARCHAR), CAST(user_id AS VARCHAR), event_type),
                          '\|+$', ''), '\|') AS parts
  FROM events),
pages AS (SELECT arrival, parts[3] AS page FROM pages_raw WHERE len(parts) >= 3)
"""

_BEHAVIOR = r"""
lines AS (
  SELECT event_id, 0 AS variant,
         concat_ws(',', CAST(user_id AS VARCHAR), CAST(event_id AS VARCHAR), event_type,
                   CAST(epoch_us(ts) // 1000 AS VARCHAR)) AS line
  FROM events
  UNION ALL
  SELECT event_id, 1 AS variant,
         concat_ws(',', CAST(user_id AS VARCHAR), CAST(event_id AS VARCHAR), event_type, props) AS line
  FROM events),
split AS (
  SELECT event_id, variant, line,
         regexp_split_to_array(regexp_replace(line, ',+$', ''), ',') AS p
  FROM lines),
parsed AS (
  SELECT event_id, variant, line, p,
         CASE WHEN line IS NULL THEN 'null_line'
              WHEN len(p) <> 4 THEN 'field_count'
              WHEN NOT regexp_matches(p[4], '^[+-]?[0-9]+$') THEN 'bad_number'
              WHEN TRY_CAST(p[4] AS BIGINT) IS NULL THEN 'out_of_range'
         END AS reject_reason
  FROM split)
"""

_BEHAVIOR_COUNTS_TAIL = """
SELECT time_bucket(INTERVAL '1 minute', make_timestamp(ts_ms * 1000), TIMESTAMP '1970-01-01') AS window_start,
       time_bucket(INTERVAL '1 minute', make_timestamp(ts_ms * 1000), TIMESTAMP '1970-01-01')
         + INTERVAL '1 minute' AS window_end,
       behavior_type, CAST(COUNT(*) AS BIGINT) AS cnt
FROM ok GROUP BY 1, 2, 3
"""

_BRAND_PAIRS = """
WITH v AS (
  SELECT o.o_custkey AS u, p.p_brand AS item
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
                  JOIN part p ON l.l_partkey = p.p_partkey),
n AS (SELECT u, item, COUNT(*) AS n FROM v GROUP BY u, item),
pairs AS (
  SELECT a.item AS item_a, b.item AS item_b, CAST(SUM(a.n * b.n) AS BIGINT) AS cnt
  FROM n a JOIN n b ON a.u = b.u AND a.item < b.item
  GROUP BY 1, 2)
"""

_FRAUD = """
WITH e AS (
  SELECT user_id AS card, event_id, ts, value AS amount, event_type AS location,
         LEAD(event_id) OVER w AS n_id, LEAD(ts) OVER w AS n_ts,
         LEAD(value) OVER w AS n_amount, LEAD(event_type) OVER w AS n_location
  FROM events
  WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id))
SELECT card,
       event_id AS first_event_id, ts AS first_ts, amount AS first_amount, location AS first_location,
       n_id AS second_event_id, n_ts AS second_ts, n_amount AS second_amount, n_location AS second_location,
       'Potential Fraud Detected for Card: ' || CAST(card AS VARCHAR)
         || ' - Transaction 1: ' || CAST(amount AS VARCHAR) || ' at ' || location
         || ' (Time: ' || CAST(epoch_us(ts) // 1000 AS VARCHAR) || ')'
         || ' - Transaction 2: ' || CAST(n_amount AS VARCHAR) || ' at ' || n_location
         || ' (Time: ' || CAST(epoch_us(n_ts) // 1000 AS VARCHAR) || ')' AS alert
FROM e
WHERE n_id IS NOT NULL AND amount < 50 AND n_amount < 50
  AND n_ts < ts + INTERVAL 5 MINUTE AND location <> n_location
"""

_EVENT_TIME_COUNTS = """
SELECT time_bucket(INTERVAL '5 seconds', ts, TIMESTAMP '1970-01-01') AS window_start,
       time_bucket(INTERVAL '5 seconds', ts, TIMESTAMP '1970-01-01') + INTERVAL '5 seconds' AS window_end,
       event_type, CAST(COUNT(*) AS BIGINT) AS cnt
FROM events GROUP BY 1, 2, 3
"""

_RUNNING_EVENT_COUNT = """
SELECT event_id, user_id, event_type,
       CAST(COUNT(*) OVER (PARTITION BY user_id ORDER BY ts, event_id
                           ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS cnt
FROM events
"""

_PARITY_COUNTER = """
SELECT event_id, event_id % 2 AS parity, cnt,
       'Key: ' || CAST(event_id % 2 AS VARCHAR) || ', Value: ' || CAST(event_id AS VARCHAR)
         || ', CountForThisKey: ' || CAST(cnt AS VARCHAR) AS message
FROM (SELECT event_id,
             CAST(COUNT(*) OVER (PARTITION BY event_id % 2 ORDER BY event_id
                                 ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS cnt
      FROM events)
"""

ORACLES: dict[str, str] = {
    "word_count": f"""
SELECT word, CAST(COUNT(*) AS BIGINT) AS cnt
FROM (SELECT unnest({_WORDS}) AS word FROM documents)
WHERE word <> ''
GROUP BY word
""",
    "rolling_word_count": f"""
WITH t AS (SELECT conv_id, turn, {_WORDS} AS arr FROM conversations),
w AS (SELECT conv_id, turn, unnest(arr) AS word, unnest(range(len(arr))) AS pos FROM t)
SELECT conv_id, turn, CAST(pos AS INTEGER) AS pos, word,
       CAST(COUNT(*) OVER (PARTITION BY word ORDER BY conv_id, turn, pos
                           ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS cnt
FROM w WHERE word <> ''
""",
    "windowed_word_count": f"""
SELECT time_bucket(INTERVAL '5 seconds', ts, TIMESTAMP '1970-01-01') AS window_start,
       time_bucket(INTERVAL '5 seconds', ts, TIMESTAMP '1970-01-01') + INTERVAL '5 seconds' AS window_end,
       word, CAST(COUNT(*) AS BIGINT) AS cnt
FROM (SELECT ts, unnest(regexp_split_to_array(lower(event_type), {_WS})) AS word FROM events)
WHERE word <> ''
GROUP BY 1, 2, 3
""",
    "length_filter": r"""
SELECT doc_id, text, text_len
FROM (SELECT doc_id, text,
             CAST(length(text) + length(regexp_replace(text, '[^\x{10000}-\x{10FFFF}]', '', 'g'))
                  AS BIGINT) AS text_len
      FROM documents)
WHERE text_len >= 30
""",
    "text_lengths": r"""
SELECT doc_id, text,
       CAST(length(text) + length(regexp_replace(text, '[^\x{10000}-\x{10FFFF}]', '', 'g'))
            AS BIGINT) AS text_len
FROM documents
""",
    "upper_map": "SELECT p_partkey, p_name, upper(p_name) AS upper_name FROM part",
    "double_even": """
SELECT event_id, event_id * 2 AS doubled FROM events WHERE (event_id * 2) % 2 = 0
""",
    "even_double": """
SELECT event_id, event_id * 2 AS doubled FROM events WHERE event_id % 2 = 0
""",
    "event_time_counts": _EVENT_TIME_COUNTS,
    "arrival_window_sum": """
SELECT 'key' AS key,
       time_bucket(INTERVAL '5 seconds', ts, TIMESTAMP '1970-01-01') AS window_start,
       time_bucket(INTERVAL '5 seconds', ts, TIMESTAMP '1970-01-01') + INTERVAL '5 seconds' AS window_end,
       CAST(COUNT(*) AS BIGINT) AS total
FROM events GROUP BY 1, 2, 3
""",
    "running_event_count": _RUNNING_EVENT_COUNT,
    "running_average": """
SELECT event_id, user_id, value,
       CAST(SUM(CAST(value AS DECIMAL(18,2))) OVER w AS DOUBLE) / COUNT(*) OVER w AS avg_value
FROM events
WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id
             ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
""",
    "parity_counter": _PARITY_COUNTER,
    "guarded_double": """
SELECT event_id,
       CASE WHEN event_id % 10 = 0 AND event_id > 0 THEN NULL ELSE event_id * 2 END AS doubled,
       (event_id % 10 = 0 AND event_id > 0) AS quarantined
FROM events
""",
    "resumed_events": """
SELECT event_id, 'Event-' || CAST(event_id AS VARCHAR) AS label FROM events
""",
    "fraud_pairs": _FRAUD,
    "sliding_page_views": f"""
WITH {_PAGES}
SELECT ws AS window_start, ws + INTERVAL '10 seconds' AS window_end, page,
       CAST(COUNT(*) AS BIGINT) AS cnt
FROM (SELECT time_bucket(INTERVAL '5 seconds', arrival, TIMESTAMP '1970-01-01') - to_seconds(5 * k) AS ws,
             page
      FROM pages, (VALUES (0), (1)) AS s(k))
GROUP BY 1, 2, 3
""",
    "traffic_alerts": f"""
WITH {_PAGES},
counts AS (
  SELECT time_bucket(INTERVAL '1 hour', arrival, TIMESTAMP '1970-01-01') AS window_start,
         time_bucket(INTERVAL '1 hour', arrival, TIMESTAMP '1970-01-01') + INTERVAL '1 hour' AS window_end,
         page, CAST(COUNT(*) AS BIGINT) AS cnt
  FROM pages GROUP BY 1, 2, 3)
SELECT window_start, window_end, page, cnt,
       '[告警] 页面 ' || page || ' 访问量异常: ' || CAST(cnt AS VARCHAR) AS alert
FROM counts WHERE cnt > 5
""",
    "item_cooccurrence": _BRAND_PAIRS + "SELECT item_a, item_b, cnt FROM pairs",
    "related_items": _BRAND_PAIRS + """,
dirs AS (SELECT item_a AS item, item_b AS related, cnt FROM pairs
         UNION ALL SELECT item_b AS item, item_a AS related, cnt FROM pairs)
SELECT item, related, cnt, rank FROM (
  SELECT item, related, cnt,
         CAST(ROW_NUMBER() OVER (PARTITION BY item ORDER BY cnt DESC, related) AS INTEGER) AS rank
  FROM dirs)
WHERE rank <= 3
""",
    "rolling_cooccurrence": """
WITH prior AS (
  SELECT e.event_id, e.ts, e.user_id, e.event_type, p.event_type AS other, COUNT(*) AS inc
  FROM events e JOIN events p
    ON p.user_id = e.user_id
   AND (p.ts < e.ts OR (p.ts = e.ts AND p.event_id < e.event_id))
   AND p.event_type <> e.event_type
  GROUP BY 1, 2, 3, 4, 5)
SELECT event_id, ts, user_id, event_type,
       least(event_type, other) AS item_a, greatest(event_type, other) AS item_b,
       CAST(inc AS BIGINT) AS inc,
       CAST(SUM(inc) OVER (PARTITION BY least(event_type, other), greatest(event_type, other)
                           ORDER BY ts, event_id
                           ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS cnt
FROM prior
""",
    "behavior_counts": f"""
WITH {_BEHAVIOR},
ok AS (SELECT p[3] AS behavior_type, CAST(p[4] AS BIGINT) AS ts_ms FROM parsed WHERE reject_reason IS NULL)
{_BEHAVIOR_COUNTS_TAIL}
""",
    "behavior_rejects": f"""
WITH {_BEHAVIOR}
SELECT event_id, variant, line, reject_reason FROM parsed WHERE reject_reason IS NOT NULL
""",
    "behavior_json": f"""
WITH ok AS (SELECT event_type AS behavior_type, epoch_us(ts) // 1000 AS ts_ms FROM events)
{_BEHAVIOR_COUNTS_TAIL}
""",
    "product_sales": """
SELECT l_partkey AS product_id,
       CAST(SUM(CAST(l_quantity AS DECIMAL(12,2)) * CAST(l_extendedprice AS DECIMAL(12,2))) AS DOUBLE)
         AS total_sales
FROM lineitem GROUP BY l_partkey
""",
    "sales_changelog": """
WITH r AS (
  SELECT o_custkey AS product_id, o_orderkey, CAST(o_totalprice AS DECIMAL(18,2)) AS v,
         SUM(CAST(o_totalprice AS DECIMAL(18,2))) OVER w AS new_total,
         ROW_NUMBER() OVER w AS n
  FROM orders
  WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderkey
               ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))
SELECT product_id, o_orderkey, '-' AS op, 0 AS seq, CAST(new_total - v AS DOUBLE) AS total
FROM r WHERE n > 1 AND v <> 0
UNION ALL
SELECT product_id, o_orderkey, '+' AS op, 1 AS seq, CAST(new_total AS DOUBLE) AS total
FROM r WHERE n = 1 OR v <> 0
""",
    "behavior_mode": """
WITH n AS (
  SELECT event_type, date_trunc('day', ts) AS window_start, user_id, COUNT(*) AS n FROM events
  WHERE user_id IS NOT NULL GROUP BY ALL),
most AS (SELECT event_type, window_start, MAX(n) AS n FROM n GROUP BY 1, 2)
SELECT event_type, CAST(window_start AS TIMESTAMP) AS window_start, MIN(user_id) AS mode_user, CAST(COUNT(*) AS BIGINT) AS ties,
       CAST(n AS BIGINT) AS mode_cnt
FROM n JOIN most USING (event_type, window_start, n) GROUP BY event_type, window_start, n
""",
    # Rows arrive in four equal parts of the arrival span; before each part the watermark is six hours behind the newest row so far.
    "stream_late_rows": """
WITH e AS (
  SELECT *, epoch_us(ts) AS us, epoch_us(ts) + (CASE WHEN event_id % 10 = 3 THEN (event_id % 4 + 1) * 86400 ELSE 0 END) * 1000000 AS arrival
  FROM events),
s AS (
  SELECT *, least(3, (arrival - lo) * 4 // (hi - lo + 1)) AS slice, (us // 3600000000 + 1) * 3600000000 AS window_us
  FROM e, (SELECT min(arrival) AS lo, max(arrival) AS hi FROM e)),
marks AS (
  SELECT p.slice, greatest(0, coalesce(max(s.us // 1000) - 6 * 3600000, 0)) AS mark
  FROM (SELECT unnest(range(4)) AS slice) AS p LEFT JOIN s ON s.slice < p.slice GROUP BY p.slice),
judged AS (SELECT s.*, window_us // 1000 <= mark AS late FROM s JOIN marks USING (slice))
SELECT 'window' AS output, event_type, make_timestamp(window_us - 3600000000) AS window_start, make_timestamp(window_us) AS window_end,
       CAST(COUNT(*) AS BIGINT) AS cnt, CAST(NULL AS BIGINT) AS event_id, CAST(NULL AS TIMESTAMP) AS ts
FROM judged WHERE NOT late GROUP BY event_type, window_us
UNION ALL
SELECT 'late', event_type, NULL, NULL, NULL, event_id, ts FROM judged WHERE late
""",
    "stream_processing_windows": """
SELECT event_type, CAST(COUNT(*) AS BIGINT) AS total, CAST(0 AS BIGINT) AS repeated_windows FROM events GROUP BY event_type
""",
    # Streaming twins produce the batch results.
    "stream_event_time_counts": _EVENT_TIME_COUNTS,
    "stream_running_event_count": _RUNNING_EVENT_COUNT,
    "stream_parity_counter": _PARITY_COUNTER,
    "stream_fraud_pairs": _FRAUD,
}
for _twin in ("sales_changelog", "windowed_word_count", "behavior_counts", "rolling_word_count",
              "rolling_cooccurrence", "product_sales", "sliding_page_views", "traffic_alerts",
              "upper_map", "double_even", "guarded_double", "running_average", "arrival_window_sum",
              "item_cooccurrence", "behavior_mode"):
    ORACLES[f"stream_{_twin}"] = ORACLES[_twin]
ORACLES |= {"stream_fraud_pairs_disordered": _FRAUD, "stream_closed_event_time_counts": _EVENT_TIME_COUNTS,
            "stream_rebucketed_word_count": ORACLES["rolling_word_count"], "stream_product_changelog": ORACLES["product_sales"]}
