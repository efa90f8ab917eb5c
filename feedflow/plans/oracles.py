"""What each registered query must return, as SQL over the base tables.

The statements say what happens to a row's message from the row's own attributes; they run no JSON feed. Numbers in
``q IN (..)`` are the quantities that mark unusual messages in ``feedflow.plans.table_feed``.
"""

from __future__ import annotations

# One row per transaction message: its fields and its text.
TX = """
WITH base AS (
  SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_tax, l_shipdate, l_linestatus,
         CAST(l_quantity AS INT) AS q,
         'tx' || l_orderkey || '-' || l_linenumber AS h,
         l_orderkey * 10 + l_linenumber AS tx_index,
         CASE CAST(l_quantity AS INT) WHEN 19 THEN NULL WHEN 20 THEN 9223372036854775807 ELSE CAST(epoch(l_shipdate) AS BIGINT) END AS t,
         CAST(round(l_extendedprice * 100) AS BIGINT) AS cents,
         CASE CAST(l_quantity AS INT) WHEN 21 THEN 9223372036854775807 ELSE CAST(round(l_extendedprice * 100) AS BIGINT) END AS paid,
         CAST(l_linenumber - 1 AS INT) AS part,
         CAST(round(l_extendedprice * 100) AS BIGINT) * CAST(round(l_tax * 100) AS BIGINT) // 100 AS tax
  FROM lineitem
), sized AS (
  SELECT *, 100 + q AS size, CASE WHEN q = 9 THEN 0 WHEN l_tax > 0 THEN 2 ELSE 1 END AS n_out FROM base
), plain AS (
  SELECT *,
    '{' || CASE WHEN q IN (4, 32) THEN '' WHEN q = 8 THEN '"op":"block",' WHEN q IN (3, 33) THEN '"op": "utx",'
                WHEN q = 12 THEN '"op":"utx","note":{"seen":1},' WHEN q = 17 THEN '"op":"old","op":"utx",'
                WHEN q = 24 THEN '"op":"utx","note":NaN,' ELSE '"op":"utx",' END AS opening,
    '"x":{"lock_time":0,"ver":' || CASE WHEN q = 6 THEN '4294967295' WHEN q = 10 THEN 'true' ELSE '1' END ||
    ',"size":' || size || ',"inputs":[{"sequence":4294967295,"prev_out":{"spent":false,"tx_index":' || l_partkey ||
    ',"type":0,"addr":"p' || l_partkey || '","value":' || (cents + 1) || ',"n":0,"script":""},"script":""}],' || coalesce('"time":' || t || ',', '') ||
    '"tx_index":' || tx_index || ',"vin_sz":1,' ||
    CASE WHEN q = 5 THEN '"hash":12,' WHEN q = 26 THEN '"hash":true,' WHEN q = 18 THEN '' ELSE '"hash":"' || h || '",' END ||
    '"vout_sz":' || n_out || ',"relayed_by":' || CASE WHEN q = 13 THEN '"height"' WHEN q = 25 THEN '{"a":1}' ELSE '"0.0.0.0"' END || ',"out":[' ||
    CASE WHEN n_out = 0 THEN '' ELSE
      '{"spent":false,"tx_index":' || l_orderkey || ',"type":0,' ||
      CASE WHEN q = 2 THEN '' WHEN q = 11 THEN '"addr":null,' ELSE '"addr":"s' || l_suppkey || '",' END ||
      '"value":' || paid || CASE WHEN q = 7 THEN '.5' ELSE '' END || ',"n":0,"script":""}' END ||
    CASE WHEN n_out < 2 THEN '' ELSE
      ',{"spent":false,"tx_index":' || l_orderkey || ',"type":0,"addr":"tax","value":' || tax || ',"n":1,"script":""}' END ||
    ']}}' AS body
  FROM sized
), whole AS (
  SELECT *, opening || body AS whole, '{"op":"utx",' || replace(body, '"addr":null,', '') AS published FROM plain
), tx AS (
  SELECT *, CASE WHEN q = 22 THEN whole || ',"zzz":1' WHEN q = 23 THEN whole || ',"record":{"op":"utx","x":{"hash":"other"}}'
                 WHEN q = 1 THEN left(whole, length(whole) - 7) WHEN q = 14 THEN whole || ' trailing'
                 WHEN q = 15 THEN '   ' WHEN q = 16 THEN '[' || whole || ']' ELSE whole END AS text,
         CASE WHEN q = 5 THEN '12' WHEN q = 26 THEN 'true' WHEN q <> 18 THEN h END AS read_hash,
         q NOT IN (3, 4, 8, 15, 32, 33) AS marked,
         q IN (1, 16) AS unreadable,
         -- Without a topic and without an op, a message is no transaction in strict mode.
         q <> 32 AS strict_tx,
         q NOT IN (1, 4, 5, 7, 8, 10, 14, 15, 16, 22, 23, 24, 25, 26, 32) AS strict_ok,
         CASE WHEN q = 15 THEN 'blank message' WHEN q IN (4, 8) THEN 'op: not utx'
              WHEN q IN (1, 5, 7, 10, 14, 16, 22, 23, 24, 25, 26) THEN 'malformed or mistyped JSON' WHEN q = 32 THEN 'unrouted' END AS strict_reason,
         CASE WHEN q IN (1, 14, 15, 22, 23, 24) THEN 'malformed JSON' WHEN q = 19 THEN 'x.time: missing'
              WHEN q = 25 THEN 'x.relayed_by: not string' WHEN q = 26 THEN 'x.hash: not string' WHEN q = 32 THEN 'op: missing' WHEN q = 2 THEN 'x.out[].addr: missing' WHEN q = 11 THEN 'x.out[].addr: not string'
              WHEN q = 4 THEN 'op: missing' WHEN q = 5 THEN 'x.hash: not string' WHEN q = 8 THEN 'op: not utx'
              WHEN q = 10 THEN 'x.ver: not integer' WHEN q = 16 THEN 'root: not object'
              WHEN q = 18 THEN 'x.hash: missing' END AS contract_reason
  FROM whole
)
"""

# One row per block message. ``d`` is the priority of an order with status P and NULL for others.
BLOCKS = """
ordered AS (
  SELECT o_orderkey AS k, o_custkey, CASE WHEN o_orderstatus = 'P' THEN o_orderpriority END AS d,
         CAST(epoch(o_orderdate) AS BIGINT) AS t, CAST(substr(o_orderpriority, 1, 1) AS INT) AS n,
         CAST(round(o_totalprice * 100) AS BIGINT) AS fee, o_orderstatus
  FROM orders
), block_plain AS (
  SELECT *, '{"hash":' || CASE WHEN d = '4-NOT SPECIFIED' THEN '12' ELSE '"b' || k || '"' END ||
    ',"ver":2,"prev_block":"b' || (k - 1) || '","mrkl_root":"m' || o_custkey || '","time":' || t ||
    ',"bits":400000000,"fee":' || fee || ',"nonce":' || CASE WHEN d = '3-MEDIUM' THEN '4294967295' ELSE CAST(o_custkey AS VARCHAR) END ||
    ',"n_tx":' || n || ',"size":' || n * 250 || ',"block_index":' || k ||
    ',"main_chain":' || CASE WHEN o_orderstatus = 'F' THEN 'true' ELSE 'false' END ||
    ',"height":' || CASE WHEN d = '2-HIGH' THEN '"tall"' WHEN d = '5-LOW' THEN 'true' ELSE CAST(k AS VARCHAR) END ||
    ',"weight":' || n * 1000 || ',"tx":[' ||
    array_to_string(list_transform(range(1, n + 1), lambda i: '"tx' || k || '-' || i || '"'), ',') || ']}' AS whole
  FROM ordered
), blocks AS (
  SELECT *, CASE WHEN d = '1-URGENT' THEN left(whole, length(whole) - 7) ELSE whole END AS text,
         d IS NULL OR d = '3-MEDIUM' AS strict_ok,
         CASE WHEN d = '3-MEDIUM' THEN 4294967295 ELSE o_custkey END AS nonce
  FROM block_plain
)
"""
BLOCKS_ONLY = f"WITH {BLOCKS}"
BOTH = f"{TX.rstrip()}, {BLOCKS}"

LOGS = """
WITH logs AS (
  SELECT event_type, event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS stamp, date_trunc('hour', ts) AS bucket,
         'worker ' || user_id AS thread, 'event ' || event_id || ' props ' || props AS message,
         CASE event_type WHEN 'error' THEN 'ERROR' WHEN 'click' THEN 'DEBUG' WHEN 'purchase' THEN 'INFO'
                         WHEN 'signup' THEN 'WARNING' END AS level,
         CASE event_type WHEN 'error' THEN 'feed.Sink' WHEN 'click' THEN 'feed.Click' WHEN 'purchase' THEN 'feed.Cart' END AS logger
  FROM events
)
"""

DAY = 86400
# Transactions and the blocks that list them, both as compat and strict parsing read them.
CONFIRMED = BOTH + f""", seen AS (
  SELECT CASE WHEN NOT unreadable THEN read_hash END AS hash, CASE WHEN NOT unreadable AND q <> 20 THEN t END AS t FROM tx WHERE marked
), listed AS (
  SELECT k AS height, t, 'tx' || k || '-' || i AS h FROM (SELECT k, t, unnest(range(1, n + 1)) AS i FROM blocks WHERE strict_ok)
), confirmed AS (
  SELECT s.hash, s.t AS seen_at, l.height, l.t - s.t AS delay_seconds
  FROM seen s LEFT JOIN listed l ON s.hash = l.h AND l.t - s.t BETWEEN {-150 * DAY} AND {100 * DAY}
)
"""
# Every output's address, time and value, and runs of them that are at most five days apart.
COINS = TX + """, coins AS (
  SELECT CASE WHEN q <> 20 THEN t END AS t, CASE WHEN q NOT IN (2, 11) THEN 's' || l_suppkey END AS addr, CASE WHEN q <> 7 THEN paid END AS value
  FROM tx WHERE marked AND NOT unreadable AND n_out >= 1
  UNION ALL SELECT CASE WHEN q <> 20 THEN t END, 'tax', tax FROM tx WHERE marked AND NOT unreadable AND n_out = 2
)
"""
RUNS = COINS.rstrip() + f""", steps AS (
  SELECT *, CASE WHEN t - lag(t) OVER (PARTITION BY addr ORDER BY t) <= {5 * DAY} THEN 0 ELSE 1 END AS opens FROM coins WHERE t IS NOT NULL AND addr IS NOT NULL
), numbered AS (
  SELECT *, sum(opens) OVER (PARTITION BY addr ORDER BY t ROWS UNBOUNDED PRECEDING) AS run FROM steps
), runs AS (
  SELECT addr, min(t) AS start, max(t) AS last, count(*) AS n, CAST(coalesce(sum(value), 0) AS DECIMAL(38,0)) AS value_sum FROM numbered GROUP BY addr, run
)
"""

TX_PARSE = TX + """
SELECT CASE WHEN NOT unreadable THEN read_hash END AS hash, CASE WHEN NOT unreadable THEN tx_index END AS tx_index,
       CASE WHEN NOT unreadable THEN t END AS time, CASE WHEN NOT unreadable THEN size END AS size,
       CASE WHEN NOT unreadable THEN n_out END AS vout_sz
FROM tx WHERE marked
"""

BLOCK_PARSE_STRICT = BLOCKS_ONLY + """
SELECT k AS height, CAST(n AS BIGINT) AS n_tx, t AS time, nonce, true AS schema_valid FROM blocks WHERE strict_ok
"""

# Every message of the strict feed: where it goes, its text there, and why.
FEED_ROWS = BOTH + """, feed AS (
  SELECT CASE WHEN strict_ok THEN 'processed_transactions' WHEN strict_tx THEN 'invalid_transactions' ELSE 'unrouted_messages' END AS topic,
         CASE WHEN strict_ok THEN published ELSE text END AS value, strict_reason AS reason, part AS "partition", l_orderkey AS "offset"
  FROM tx
  UNION ALL
  SELECT CASE WHEN strict_ok THEN 'processed_confirmed_blocks' ELSE 'invalid_confirmed_blocks' END,
         CASE WHEN strict_ok THEN left(text, length(text) - 1) || ',"schema_valid":true}' ELSE text END,
         CASE WHEN NOT strict_ok THEN 'malformed or mistyped JSON' END, 0, k
  FROM blocks
)
"""
FEED_TEXTS = FEED_ROWS + 'SELECT topic, md5(value) AS text_md5, reason, "partition", "offset" FROM feed'
VALUE_SUM = "CAST(CASE WHEN n_out = 0 THEN 0 WHEN n_out = 1 THEN paid ELSE CAST(paid AS HUGEINT) + tax END AS DECIMAL(38,0))"
ROLLUP = TX + f"""
SELECT date_trunc('hour', l_shipdate) AS bucket, count(*) AS n, CAST(sum({VALUE_SUM}) AS DECIMAL(38,0)) AS value_sum, avg(size) AS size_avg
FROM tx WHERE strict_ok AND q NOT IN (19, 20) GROUP BY 1
"""

LOG_MESSAGES = LOGS + """
SELECT '{"timestamp":"' || stamp || '","thread":"' || thread || '","level":"' || level || '","logger":"' || logger ||
       '","message":"' || replace(message, '"', '\\"') || '"}' AS value
FROM logs WHERE event_type IN ('error', 'click', 'purchase')
UNION ALL
SELECT '{"message":"at feed.View(' || event_id || ')","log":"at feed.View(' || event_id || ')"}' FROM logs WHERE level IS NULL
"""

ORACLES: dict[str, str] = {
    "tx_parse": TX_PARSE,
    "tx_parse_strict": TX + """
SELECT read_hash AS hash, tx_index, t AS time, CAST(size AS BIGINT) AS size, CAST(n_out AS BIGINT) AS vout_sz,
       CASE WHEN q = 6 THEN 4294967295 ELSE 1 END AS ver
FROM tx WHERE strict_ok
""",
    "tx_dead_letter": TX + "SELECT part AS \"partition\", l_orderkey AS \"offset\", strict_reason AS reason FROM tx WHERE NOT strict_ok AND strict_tx",
    "tx_route_counts": BOTH + """
SELECT mode, route, count(*) AS n FROM (
  SELECT 'compat' AS mode, CASE WHEN NOT marked THEN 'unrouted' WHEN q = 13 THEN 'both' ELSE 'tx' END AS route FROM tx
  UNION ALL SELECT 'compat', 'block' FROM blocks
  UNION ALL SELECT 'strict', CASE WHEN strict_tx THEN 'tx' ELSE 'unrouted' END FROM tx
  UNION ALL SELECT 'strict', 'block' FROM blocks
) GROUP BY mode, route
""",
    "tx_outputs": TX + """
SELECT read_hash AS hash, 0 AS n, CASE WHEN q NOT IN (2, 11) THEN 's' || l_suppkey END AS addr,
       CASE WHEN q <> 7 THEN paid END AS value
FROM tx WHERE marked AND NOT unreadable AND n_out >= 1
UNION ALL
SELECT read_hash, 1, 'tax', tax FROM tx WHERE marked AND NOT unreadable AND n_out = 2
""",
    "tx_inputs": TX + """
SELECT read_hash AS hash, 4294967295 AS sequence, 'p' || l_partkey AS addr, cents + 1 AS value
FROM tx WHERE marked AND NOT unreadable
""",
    "tx_output_state": TX + """, outs AS (
  SELECT read_hash AS hash, 0 AS n, l_orderkey AS tx_index, CASE WHEN q <> 7 THEN paid END AS value FROM tx WHERE marked AND NOT unreadable AND n_out >= 1
  UNION ALL SELECT read_hash, 1, l_orderkey, tax FROM tx WHERE marked AND NOT unreadable AND n_out = 2
), spent AS (
  SELECT l_partkey AS tx_index, 0 AS n, count(*) AS spends FROM tx WHERE marked AND NOT unreadable GROUP BY l_partkey
)
SELECT hash, n, value, coalesce(spends, 0) AS spends FROM outs LEFT JOIN spent USING (tx_index, n)
""",
    "tx_top_addresses": TX + """, outs AS (
  SELECT t // 86400 AS day, 's' || l_suppkey AS addr, paid AS value FROM tx
  WHERE marked AND NOT unreadable AND n_out >= 1 AND q NOT IN (2, 7, 11, 19, 20)
  UNION ALL SELECT t // 86400, 'tax', tax FROM tx WHERE marked AND NOT unreadable AND n_out = 2 AND q NOT IN (19, 20)
)
SELECT day, CAST(row_number() OVER (PARTITION BY day ORDER BY sum(value) DESC, addr) AS INT) AS rank, addr, CAST(sum(value) AS DECIMAL(38,0)) AS value_sum
FROM outs GROUP BY day, addr QUALIFY rank <= 3
""",
    "tx_confirmations": CONFIRMED + "SELECT hash, height, delay_seconds FROM confirmed",
    "stream_confirmations": CONFIRMED + f"""
SELECT hash, height, delay_seconds FROM confirmed WHERE seen_at IS NOT NULL AND (height IS NOT NULL
  OR seen_at + {100 * DAY} < (SELECT least((SELECT max(t) FROM seen), (SELECT max(t) FROM listed)) - {36 * 3600}))
""",
    "tx_bursts": RUNS + "SELECT addr, start, last, n, value_sum FROM runs",
    "stream_bursts": RUNS + f"""
SELECT addr, start, last, n, value_sum FROM runs WHERE last + {5 * DAY} < (SELECT max(t) FROM coins WHERE addr IS NOT NULL) - {36 * 3600}
""",
    "stream_by_date": "SELECT CAST(ts AS DATE) AS event_date, event_id, event_type, value FROM events",
    "tx_addresses_by_day": COINS + """
SELECT make_timestamp(t // 86400 * 86400000000) AS bucket, count(DISTINCT addr) AS n, true AS close
FROM coins WHERE t IS NOT NULL AND addr IS NOT NULL GROUP BY 1
""",
    "tx_lost_offsets": """
WITH seen AS (
  SELECT DISTINCT CASE WHEN CAST(l_quantity AS INT) NOT IN (30, 32, 33) THEN 'unconfirmed_transactions' END AS topic,
         CAST(l_linenumber - 1 AS INT) AS "partition", l_orderkey AS "offset" FROM lineitem
)
SELECT topic, "partition", "offset" + 1 AS from_offset, following - 1 AS to_offset
FROM (SELECT *, lead("offset") OVER (PARTITION BY topic, "partition" ORDER BY "offset") AS following FROM seen) WHERE following > "offset" + 1
""",
    "stream_replay": TX + """
SELECT DISTINCT CASE WHEN q NOT IN (30, 32, 33) THEN 'unconfirmed_transactions' END AS topic, part AS "partition", l_orderkey AS "offset" FROM tx
""",
    "tx_encode_roundtrip": TX + f"SELECT read_hash AS hash, t AS time, {VALUE_SUM} AS value_sum FROM tx WHERE strict_ok",
    "tx_valid_passthrough": TX + """
SELECT 'unconfirmed_transactions' AS topic, md5(text) AS text_md5 FROM tx WHERE contract_reason IS NULL
""",
    "tx_invalid": TX + """
SELECT part AS "partition", l_orderkey AS "offset", contract_reason AS reason FROM tx WHERE contract_reason IS NOT NULL
""",
    "tx_hash_default": TX + """
SELECT CASE WHEN NOT unreadable THEN tx_index END AS tx_index,
       CASE WHEN unreadable THEN 'N/A' ELSE coalesce(read_hash, 'N/A') END AS hash_or_na
FROM tx WHERE marked
""",
    "tx_utf8": TX + """
SELECT part AS "partition", l_orderkey AS "offset", CAST(strlen(text) AS INT) AS n_bytes, trim(text) = '' AS blank FROM tx
""",
    "tx_well_formed": TX + """
SELECT part AS "partition", count(*) AS n FROM tx WHERE contract_reason IS DISTINCT FROM 'malformed JSON' GROUP BY 1
""",
    "block_parse_strict": BLOCK_PARSE_STRICT,
    "block_parse_compat": BLOCKS_ONLY + """
SELECT CASE WHEN d = '1-URGENT' THEN NULL WHEN d = '4-NOT SPECIFIED' THEN '12' ELSE 'b' || k END AS hash,
       CASE WHEN d IS NULL OR d NOT IN ('1-URGENT', '2-HIGH', '5-LOW') THEN k END AS height,
       CASE WHEN d IS DISTINCT FROM '1-URGENT' THEN n END AS n_tx,
       CASE WHEN d IS DISTINCT FROM '1-URGENT' THEN t END AS time,
       CASE WHEN d IS NULL OR d NOT IN ('1-URGENT', '3-MEDIUM') THEN CAST(o_custkey AS INT) END AS nonce,
       true AS schema_valid
FROM blocks
""",
    "block_dead_letter": BLOCKS_ONLY + """
SELECT text AS value, 'malformed or mistyped JSON' AS reason FROM blocks WHERE NOT strict_ok
""",
    "block_dead_letter_compat": TX + """
SELECT text AS value, false AS routed FROM tx WHERE trim(text) = ''
""",
    "block_extract_normalize": BLOCKS_ONLY + """
SELECT 'b' || k AS hash, k AS height, t AS time, CAST(n AS BIGINT) AS n_tx FROM blocks WHERE d IS NULL
""",
    "block_ingest_compat": BLOCKS_ONLY + """
SELECT CAST(NULL AS VARCHAR) AS hash, k AS height, CAST(NULL AS BIGINT) AS time, CAST(NULL AS INT) AS n_tx
FROM blocks WHERE d IS NULL
""",
    "block_ingest_text": BLOCKS_ONLY + """
SELECT 'confirmed_blocks' AS topic,
       '{"height":' || k || ',"id":"b' || k || '","timestamp":' || t || ',"tx_count":' || n || '}' AS value
FROM blocks WHERE d IS NULL
""",
    "block_invalid": BLOCKS_ONLY + """
SELECT k AS "offset", CASE d WHEN '1-URGENT' THEN 'malformed JSON' WHEN '2-HIGH' THEN 'height: not integer'
                             WHEN '3-MEDIUM' THEN 'tx_count: missing' ELSE 'block: missing or empty' END AS reason
FROM blocks WHERE d IS NOT NULL
""",
    "block_tx_explode": BLOCKS_ONLY + """
SELECT k AS height, 'tx' || k || '-' || i AS tx_hash
FROM (SELECT k, unnest(range(1, n + 1)) AS i FROM blocks WHERE strict_ok)
""",
    "feed_outputs": FEED_ROWS + "SELECT topic, reason, count(*) AS n FROM feed GROUP BY topic, reason",
    "feed_texts": FEED_TEXTS,
    "feed_outputs_compat": BOTH + """
SELECT topic, CAST(NULL AS VARCHAR) AS reason, count(*) AS n FROM (
  SELECT 'processed_transactions' AS topic FROM tx WHERE marked
  UNION ALL SELECT 'processed_confirmed_blocks' FROM tx WHERE q = 13
  UNION ALL SELECT 'processed_confirmed_blocks' FROM blocks
) GROUP BY topic
""",
    "feed_block_values": BLOCKS_ONLY + """
SELECT k AS height,
       md5(left(text, length(text) - 1) || ',"schema_valid":true}') AS text_md5
FROM blocks WHERE strict_ok
""",
    "events_json_props": """
SELECT event_id, CAST(props->>'k' AS INT) AS k, CAST(props->>'k' AS BIGINT) AS k_document, 'BIGINT' AS k_type,
       replace(props, ' ', '') AS compact
FROM events
""",
    "events_encode": "SELECT event_id, user_id, event_type, value FROM events",
    "events_schema_check": """
WITH judged AS (
  SELECT event_id, concat_ws('; ',
    CASE WHEN event_id IS NULL THEN 'event_id: missing' WHEN event_id < 0 THEN 'event_id: below 0' END,
    CASE WHEN user_id >= 140 THEN 'user_id: not below 140' END,
    CASE WHEN event_type IS NULL THEN 'event_type: missing' WHEN event_type = '' OR event_type LIKE 'v%' THEN 'event_type: not like ^[^v]' END,
    CASE WHEN length(event_type) > 6 THEN 'event_type: over 6 characters' END,
    CASE WHEN value IS NULL THEN 'value: missing' WHEN value BETWEEN 25 AND 50 THEN 'value: not exactly one of 2 forms' END,
    CASE WHEN CAST(props->>'$.k' AS BIGINT) < 10 THEN 'props.k: below 10' END) AS reason
  FROM events
)
SELECT event_id, reason = '' AS valid, reason FROM judged
""",
    "events_valid_filter": "SELECT event_type, count(*) AS n FROM events WHERE json_valid(props) GROUP BY event_type",
    "stream_tx_available_now": TX_PARSE,
    "stream_single_pass": FEED_TEXTS,
    "stream_fan_out": FEED_TEXTS,
    "stream_restart": TX_PARSE,
    "landed_blocks": BLOCK_PARSE_STRICT,
    "blocks_json_files": BLOCK_PARSE_STRICT,
    "stream_publish_batches": FEED_ROWS + "SELECT topic, md5(value) AS text_md5 FROM feed WHERE starts_with(topic, 'processed')",
    "stream_three_queries": FEED_ROWS + "SELECT topic, md5(value) AS text_md5, reason FROM feed WHERE topic <> 'unrouted_messages'",
    "stream_ingest": BOTH + """
SELECT CASE WHEN strict_ok THEN 'processed_transactions' ELSE 'invalid_transactions' END AS topic,
       md5(CASE WHEN strict_ok THEN published ELSE text END) AS text_md5, strict_reason AS reason
FROM tx WHERE contract_reason IS NULL
UNION ALL
SELECT 'processed_confirmed_blocks',
       md5('{"hash":"b' || k || '","time":' || t || ',"n_tx":' || n || ',"height":' || k || ',"schema_valid":true}'), NULL
FROM blocks WHERE d IS NULL
""",
    "stream_metrics": "SELECT count(*)::BIGINT AS input_rows, 0::BIGINT AS first_batch FROM lineitem",
    "stream_tx_rollup": f"""
SELECT * FROM ({ROLLUP}) WHERE bucket + INTERVAL 1 HOUR <= (SELECT max(l_shipdate) - INTERVAL 3 DAY FROM lineitem
  WHERE l_quantity NOT IN (1, 4, 5, 7, 8, 10, 14, 15, 16, 19, 20, 22, 23, 24, 25, 26, 32))
""",
    "log_parse": LOGS + """
SELECT level, CASE WHEN level IS NOT NULL THEN thread END AS thread, level IS NOT NULL AS parsed, count(*) AS n
FROM logs WHERE event_type <> 'signup' GROUP BY 1, 2, 3
""",
    "log_parse_compat": LOGS + """
SELECT stamp AS "timestamp", thread, level, logger, message, CAST(NULL AS VARCHAR) AS log
FROM logs WHERE event_type IN ('error', 'click')
UNION ALL
SELECT NULL, NULL, NULL, NULL, NULL,
       CASE event_type WHEN 'purchase' THEN stamp || ' [' || thread || '] INFO  feed.Cart - ' || message
                       WHEN 'signup' THEN stamp || ',123 - WARNING - DEBUG ' || message
                       ELSE 'at feed.View(' || event_id || ')' END
FROM logs WHERE event_type NOT IN ('error', 'click')
""",
    "log_messages": LOG_MESSAGES,
    "stream_logs": LOG_MESSAGES,
    "tx_hourly_rollup": ROLLUP,
    "tx_rollup_rejects": TX + """
SELECT CASE q WHEN 19 THEN 'time: missing' ELSE 'time: out of range' END AS reason, tx_index FROM tx WHERE strict_ok AND q IN (19, 20)
""",
    "events_hourly_rollup": """
SELECT date_trunc('hour', ts) AS bucket, event_type, count(*) AS n FROM events GROUP BY 1, 2
""",
    "log_level_rollup": LOGS + "SELECT bucket, level, count(*) AS n FROM logs WHERE level IS NOT NULL GROUP BY 1, 2",
    "events_by_date": """
SELECT CAST(ts AS DATE) AS event_date, event_type, count(*) AS n, max(value) AS value_max FROM events GROUP BY 1, 2
""",
    "events_percentiles": """
SELECT date_trunc('day', ts) AS bucket, event_type, count(*) AS n, fraction, true AS close
FROM events, (VALUES (0.5::DOUBLE), (0.95::DOUBLE), (0.99::DOUBLE)) wanted(fraction) WHERE value IS NOT NULL AND NOT isnan(value) GROUP BY 1, 2, 4
""",
}
