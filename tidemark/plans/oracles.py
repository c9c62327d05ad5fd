"""SQL twins of the registered queries, for DuckDB over the same tables.

Written from the meaning of each operator, not from its Spark plan: global windows and
row-by-row rules are fine here, as this runs on small tables only.
"""

from __future__ import annotations

import re

# Fixed value: the accepted spelling of numbers, as on the Spark side.
NUMBER = "^ *[+-]?([0-9]+([.][0-9]*)?|[.][0-9]+)([eE][+-]?[0-9]+)? *$"

INPUTS = {
    "rec": """
SELECT
  o.o_orderkey + 1 AS id,
  concat('ext-', CAST(o.o_orderkey + 1 AS VARCHAR)) AS external_id,
  c.c_name AS name,
  lower(concat(c.c_name, '.', CAST(o.o_orderkey AS VARCHAR), '@example.com')) AS email,
  c.c_mktsegment AS company,
  r.r_name AS city,
  n.n_name AS country,
  CASE o.o_orderstatus WHEN 'F' THEN 'inactive' WHEN 'O' THEN 'active' ELSE 'pending' END AS status,
  concat('{', lower(c.c_mktsegment), ',', lower(substr(o.o_orderpriority, 3)), '}') AS tags_literal,
  CASE WHEN o.o_orderkey % 97 = 5 THEN 'N/A'
       ELSE CAST(CAST(o.o_totalprice AS DECIMAL(12,2)) AS VARCHAR) END AS amount,
  CAST(1 + o.o_orderkey % 3 AS INTEGER) AS version,
  o.o_orderdate AS created_at,
  o.o_orderdate + (o.o_orderkey % 3) * INTERVAL '1' DAY AS updated_at,
  CASE WHEN o.o_orderkey % 11 = 7
       THEN o.o_orderdate + (o.o_orderkey % 3) * INTERVAL '1' DAY END AS deleted_at
FROM orders o
JOIN customer c ON c.c_custkey = o.o_custkey
JOIN nation n ON n.n_nationkey = c.c_nationkey
JOIN region r ON r.r_regionkey = n.n_regionkey""",
    "typed": f"""
SELECT *, CASE WHEN regexp_matches(amount, '{NUMBER}') AND isfinite(TRY_CAST(amount AS DOUBLE))
               THEN TRY_CAST(amount AS DOUBLE) END AS amount_value
FROM rec""",
    "docs": """
SELECT * EXCLUDE (amount), amount_value AS amount FROM typed
WHERE deleted_at IS NULL AND amount_value IS NOT NULL""",
    "feed": """
SELECT id, v AS version, updated_at + (v - version) * INTERVAL '1' DAY AS updated_at,
       CASE WHEN v = version THEN status ELSE 'pending' END AS status,
       CASE WHEN v = version THEN amount ELSE '0.00' END AS amount,
       CASE WHEN v = version THEN deleted_at END AS deleted_at,
       worker
FROM rec
CROSS JOIN (SELECT 1 AS v UNION ALL SELECT 2 UNION ALL SELECT 3) k
CROSS JOIN (SELECT 'backfill' AS worker UNION ALL SELECT 'incremental') w
WHERE v <= version""",
    "typed_feed": f"""
SELECT *, CASE WHEN regexp_matches(amount, '{NUMBER}') AND isfinite(TRY_CAST(amount AS DOUBLE))
               THEN TRY_CAST(amount AS DOUBLE) END AS amount_value
FROM feed""",
    "ev": """
SELECT event_id, user_id AS id,
  CAST(row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS INTEGER) AS version,
  CASE WHEN event_type = 'error' THEN 'deleted'
       WHEN row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) = 1 THEN 'created'
       ELSE 'updated' END AS op,
  event_type AS status, ts AS emitted_at, value
FROM events""",
    "deliveries": """
SELECT *, 1 AS delivery FROM ev
UNION ALL
SELECT *, 2 AS delivery FROM ev WHERE event_id % 2 = 0""",
    "raw_events": """
SELECT event_id, delivery, id, version, op, status, country,
  CASE WHEN value < 2 THEN concat(head, ver, oper, ',"data":{"sta')
       WHEN value < 3 THEN 'null'
       WHEN value < 4 THEN concat(head, oper, body, '}')
       WHEN value < 5 THEN concat(head, ver, oper, '}')
       ELSE concat(head, ver, oper, body, '}') END AS value,
  CASE WHEN value < 3 THEN 'malformed'
       WHEN value < 4 THEN 'missing key'
       WHEN value < 5 THEN 'missing data' END AS poison
FROM (
  SELECT *,
    concat('{"id":', id, ',"external_id":"ext-', id, '"') AS head,
    concat(',"version":', version) AS ver,
    concat(',"op":"', op, '"') AS oper,
    concat(',"data":{"status":"', status, '","country":"', country, '"}') AS body
  FROM (
    SELECT *, CASE WHEN status = 'signup' THEN '' ELSE concat('NATION_', id % 25) END AS country
    FROM deliveries
  ) c
) p""",
    "plan": """
SELECT page, min(id) AS first_id, max(id) AS last_id, count(*) AS n_rows
FROM (SELECT id, CAST(ceil(row_number() OVER (ORDER BY id) / 500.0) AS BIGINT) AS page FROM rec) p
GROUP BY page""",
    "ledger": """
SELECT 'backfill' AS mode, page, first_id, last_id, n_rows FROM plan
WHERE page <= (SELECT ceil(ceil(count(*) / 500.0) * 3 / 5) FROM rec)""",
    "incremental_ledger": """
SELECT 'incremental' AS mode, epoch_us(updated_at) AS hi_micros, max(id) AS hi_id, count(*) AS n_rows
FROM rec WHERE updated_at < TIMESTAMP '1997-01-01' GROUP BY updated_at""",
    "status_log": """
SELECT CASE WHEN event_id % 2 = 0 THEN 'backfill' ELSE 'incremental' END AS mode, event_id AS seq,
  CASE WHEN event_type IN ('error', 'signup') THEN 'operator' ELSE 'worker' END AS actor,
  CASE event_type WHEN 'error' THEN 'paused' WHEN 'click' THEN 'running'
       WHEN 'purchase' THEN 'completed' ELSE 'idle' END AS status
FROM events""",
    "mode_status": """
SELECT m.mode,
  CASE WHEN o.status = 'paused' THEN 'paused'
       WHEN w.seq > coalesce(o.seq, 0) THEN w.status ELSE 'idle' END AS status
FROM (SELECT DISTINCT mode FROM status_log) m
LEFT JOIN (SELECT * FROM status_log WHERE actor = 'operator'
           QUALIFY row_number() OVER (PARTITION BY mode ORDER BY seq DESC) = 1) o ON o.mode = m.mode
LEFT JOIN (SELECT * FROM status_log WHERE actor = 'worker'
           QUALIFY row_number() OVER (PARTITION BY mode ORDER BY seq DESC) = 1) w ON w.mode = m.mode""",
    "checkpoints": """
SELECT s.mode, s.status, coalesce(b.last_id, 0) AS last_id,
  i.hi_micros AS last_watermark_micros, coalesce(i.hi_id, 0) AS last_watermark_id,
  CAST(coalesce(b.n, j.n, 0) AS BIGINT) AS rows_processed, coalesce(b.c, j.c, 0) AS batches
FROM mode_status s
LEFT JOIN (SELECT mode, max(last_id) AS last_id, sum(n_rows) AS n, count(*) AS c
           FROM ledger GROUP BY mode) b ON b.mode = s.mode
LEFT JOIN (SELECT mode, sum(n_rows) AS n, count(*) AS c
           FROM incremental_ledger GROUP BY mode) j ON j.mode = s.mode
LEFT JOIN (SELECT * FROM incremental_ledger ORDER BY hi_micros DESC, hi_id DESC LIMIT 1) i
       ON i.mode = s.mode""",
    "failures": """
SELECT id AS source_record_id, external_id, 'search' AS sink, mode, concat(amount, '@', mode) AS payload,
       concat('mapper_parsing_exception: bad amount ', amount, ' in ', mode) AS error,
       updated_at + hrs * INTERVAL '1' HOUR AS failed_at
FROM rec
CROSS JOIN (SELECT 'backfill' AS mode, 1 AS hrs UNION ALL SELECT 'incremental', 2) w
WHERE amount = 'N/A' AND deleted_at IS NULL""",
    "dlq": """
SELECT source_record_id, sink, min(external_id) AS external_id,
  arg_max(error, failed_at) AS error, arg_max(payload, failed_at) AS payload,
  CAST(count(*) AS INTEGER) AS attempt_count, 'pending' AS status,
  min(failed_at) AS first_failed_at, max(failed_at) AS last_failed_at
FROM failures GROUP BY source_record_id, sink""",
    "repaired": """
SELECT * EXCLUDE (bad, fixed, deleted, bumped) REPLACE (
  CASE WHEN bad AND fixed THEN '1.00' ELSE amount END AS amount,
  CAST(version + CASE WHEN bumped OR deleted THEN 1 ELSE 0 END AS INTEGER) AS version,
  CASE WHEN bumped OR deleted THEN updated_at + INTERVAL '10' DAY ELSE updated_at END AS updated_at,
  CASE WHEN deleted THEN updated_at + INTERVAL '10' DAY ELSE deleted_at END AS deleted_at)
FROM (
  SELECT *, amount = 'N/A' AND deleted_at IS NULL AS bad, status = 'active' AS fixed,
    bad AND status = 'inactive' AND company <> 'MACHINERY' AS deleted,
    bad AND fixed AND company IN ('HOUSEHOLD', 'BUILDING') AS bumped
  FROM rec
) r
WHERE NOT (bad AND status = 'inactive' AND company = 'MACHINERY')""",
    "replay": """
SELECT d.source_record_id AS id, d.sink, d.last_failed_at, r.amount, r.version, r.updated_at,
  CASE WHEN r.id IS NULL THEN 'missing' WHEN r.deleted_at IS NOT NULL THEN 'tombstone'
       WHEN r.amount = 'N/A' THEN 'still_bad' ELSE 'ok' END AS outcome
FROM dlq d LEFT JOIN repaired r ON r.id = d.source_record_id""",
    "after_replay": """
SELECT d.* REPLACE (CASE r.outcome WHEN 'ok' THEN 'replayed' WHEN 'tombstone' THEN 'resolved'
                                   ELSE d.status END AS status)
FROM dlq d JOIN replay r ON r.id = d.source_record_id""",
    "sink_copy": """
SELECT id, CAST(CASE WHEN id % 53 = 1 THEN version - 1 ELSE version END AS INTEGER) AS version
FROM rec WHERE deleted_at IS NULL AND id % 47 <> 0
UNION ALL
SELECT -id AS id, CAST(1 AS INTEGER) AS version FROM rec WHERE id % 1009 = 0""",
    "source": "SELECT id, version FROM rec WHERE deleted_at IS NULL",
    "reconciled": """
SELECT coalesce(s.id, t.id) AS id, s.version AS source_version, t.version AS sink_version,
  CASE WHEN t.id IS NULL THEN 'missing' WHEN s.id IS NULL THEN 'extra'
       WHEN t.version < s.version THEN 'stale' WHEN t.version > s.version THEN 'ahead'
       ELSE 'equal' END AS verdict
FROM source s FULL JOIN sink_copy t ON s.id = t.id""",
    "sink_contents": """
SELECT k.id, k.version,
  CASE WHEN k.id % 59 = 2 THEN NULL WHEN k.id % 61 = 3 THEN 'gone' ELSE r.status END AS status,
  r.amount, r.updated_at
FROM sink_copy k LEFT JOIN (SELECT * FROM rec WHERE deleted_at IS NULL) r ON r.id = k.id""",
    "samples": """
SELECT CASE WHEN event_id % 2 = 0 THEN 'backfill' ELSE 'incremental' END AS mode,
       event_id * 4000 AS t_ms, 1 + event_id % 500 AS n
FROM events""",
    "rates": """
SELECT mode, t_ms, n_samples, total,
  CASE WHEN n_samples < 2 THEN 0.0 ELSE total / greatest(1.0, (t_ms - first_ms) / 1000) END AS rows_per_sec
FROM (
  SELECT mode, t_ms, count(*) OVER w AS n_samples, CAST(sum(n) OVER w AS BIGINT) AS total,
    CAST(min(t_ms) OVER w AS DOUBLE) AS first_ms
  FROM samples
  WINDOW w AS (PARTITION BY mode ORDER BY t_ms RANGE BETWEEN 30000 PRECEDING AND CURRENT ROW)
) x""",
    "changes": """
SELECT l_orderkey + 1 AS id, seq,
  CASE WHEN l_returnflag IN ('R', 'N') THEN 'update' WHEN l_linenumber >= 4 THEN 'delete' ELSE 'insert' END AS kind,
  TIMESTAMP '1999-01-01' + seq * INTERVAL '1' HOUR AS changed_at,
  CASE WHEN l_returnflag <> 'N' AND l_linenumber % 2 = 0 THEN 'pending' END AS status,
  CASE WHEN l_returnflag <> 'N' THEN CAST(CAST(l_quantity AS DECIMAL(12,2)) AS VARCHAR) END AS amount
FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey,
        l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate) AS seq
      FROM lineitem) l
UNION ALL
SELECT -1 - c_custkey, step, kind, TIMESTAMP '1999-01-01' + step * INTERVAL '1' HOUR, 'active',
  CAST(CAST(c_acctbal AS DECIMAL(12,2)) AS VARCHAR)
FROM customer
CROSS JOIN (SELECT 0 AS step, 'update' AS kind
            UNION ALL SELECT 1, 'insert' UNION ALL SELECT 2, 'update') s""",
    "effective": """
SELECT c.* FROM (
  SELECT h.*, min(CASE WHEN kind = 'delete' THEN seq END) OVER (PARTITION BY id) AS gone
  FROM (
    SELECT c.*, r.id IS NOT NULL AS known, r.deleted_at IS NULL AS live,
      min(CASE WHEN kind = 'insert' THEN seq END) OVER (PARTITION BY c.id) AS born
    FROM changes c LEFT JOIN rec r ON r.id = c.id
  ) h
  WHERE CASE WHEN known THEN live AND kind <> 'insert'
             WHEN kind = 'insert' THEN seq = born ELSE seq > born END
) c
WHERE gone IS NULL OR seq <= gone""",
    "unique_valid": "SELECT DISTINCT id, version, op, status, country FROM raw_events WHERE poison IS NULL",
    "totals": """
SELECT count(DISTINCT (id, version)) FILTER (poison IS NULL) AS processed_total,
  count(*) FILTER (poison IS NULL) - count(DISTINCT (id, version)) FILTER (poison IS NULL)
    AS duplicates_skipped_total,
  count(*) FILTER (poison IS NOT NULL) AS errors_total
FROM raw_events""",
}

_ENTRY = """source_record_id, sink, external_id, payload, error, attempt_count, status,
first_failed_at, last_failed_at"""
_HIT = "id, name, company, country, status, amount, version, updated_at"
_LAG = """coalesce(round(greatest(0.0, (915148800000000 - epoch_us(min(updated_at))) / 1e6), 1), 0.0)"""
_PROGRESS = "CASE WHEN m > 0 THEN round(least(100.0, CAST(l AS DOUBLE) / m * 100), 2) ELSE 0.0 END"
_STATE = """
SELECT id, email, status, tags_literal AS tags, amount, version, updated_at FROM docs"""

BODIES = {
    "keyset_page": "SELECT id, version, status, amount FROM rec WHERE id > 1000 ORDER BY id LIMIT 500",
    "watermark_page": """
SELECT id, version, updated_at FROM rec WHERE (updated_at, id) > (TIMESTAMP '1997-01-01', 5)
ORDER BY updated_at, id LIMIT 500""",
    "row_compare": "SELECT id, updated_at FROM rec WHERE (updated_at, id) > (TIMESTAMP '1997-01-01', 5)",
    "incremental_range": """
SELECT id, version, status, updated_at,
  CASE WHEN deleted_at IS NOT NULL THEN 'deleted' WHEN version > 1 THEN 'updated' ELSE 'created' END AS op
FROM rec WHERE (updated_at, id) > (TIMESTAMP '1997-01-01', 5)""",
    "incremental_initial": "SELECT id, external_id, version, updated_at FROM rec",
    "page_plan": "SELECT page, first_id, last_id, n_rows FROM plan",
    "backfill_resume": """
SELECT page, first_id, last_id, n_rows FROM plan WHERE page NOT IN (SELECT page FROM ledger)""",
    "current_by_ids": """
SELECT id, version, status, amount, updated_at FROM repaired
WHERE id IN (SELECT source_record_id FROM failures)""",
    "doc_lookup": """
SELECT k.id, d.name, d.amount, d.version, d.id IS NOT NULL AS found
FROM (SELECT l_orderkey + 1 AS id FROM lineitem UNION SELECT id FROM sink_copy) k
LEFT JOIN docs d ON d.id = k.id""",
    "checkpoint_current": "SELECT * FROM checkpoints",
    "backfill_ledger": """
SELECT mode, last_id, rows_processed, batches FROM checkpoints WHERE mode = 'backfill'""",
    "incremental_ledger": """
SELECT mode, last_watermark_micros, last_watermark_id, rows_processed, batches
FROM checkpoints WHERE mode = 'incremental'""",
    "unnest_zip": """
SELECT id, CAST(generate_subscripts(a, 1) - 1 AS INTEGER) AS pos, unnest(a) AS address_part,
  unnest(b) AS tag, unnest(c) AS name_part
FROM (
  SELECT id, list_resize(a, n) AS a, list_resize(b, n) AS b, list_resize(c, n) AS c
  FROM (
    SELECT id, regexp_split_to_array(email, '[.@]') AS a,
      string_split(substr(tags_literal, 2, length(tags_literal) - 2), ',') AS b,
      string_split(name, '#') AS c, greatest(len(a), len(b), len(c)) AS n
    FROM rec
  ) x
) y""",
    "reference_pool": """
SELECT s_name AS place, n_name AS country FROM supplier JOIN nation ON n_nationkey = s_nationkey
WHERE s_acctbal >= 3000""",
    "latest_state": """
SELECT DISTINCT id, version, updated_at, status, amount, deleted_at FROM feed
QUALIFY version = max(version) OVER (PARTITION BY id)""",
    "state_after_deletes": """
SELECT DISTINCT id, version, updated_at, status, amount FROM feed
QUALIFY version = max(version) OVER (PARTITION BY id) AND deleted_at IS NULL""",
    "typed_state": """
SELECT id, version, updated_at, status, amount FROM (
  SELECT DISTINCT id, version, updated_at, status, amount_value AS amount, deleted_at FROM typed_feed
  WHERE deleted_at IS NOT NULL OR amount_value IS NOT NULL
  QUALIFY version = max(version) OVER (PARTITION BY id)
) s WHERE deleted_at IS NULL""",
    "typed_accept": """
SELECT id, version, worker, deleted_at IS NOT NULL AS is_delete,
  CASE WHEN deleted_at IS NULL THEN amount_value END AS amount
FROM typed_feed WHERE deleted_at IS NOT NULL OR amount_value IS NOT NULL""",
    "rejects": """
SELECT id, version, worker, concat('mapper_parsing_exception: bad amount ', amount) AS reason
FROM typed_feed WHERE deleted_at IS NULL AND amount_value IS NULL""",
    "event_log": """
SELECT id, external_id, version, op, worker, concat('record.', op) AS routing_key,
  status AS data_status, country AS data_country, amount AS data_amount,
  TIMESTAMP '1999-01-01' AS emitted_at
FROM (SELECT *, CASE WHEN deleted_at IS NOT NULL THEN 'deleted' WHEN version > 1 THEN 'updated'
                     ELSE 'created' END AS op FROM rec) r
CROSS JOIN (SELECT 'backfill' AS worker UNION ALL SELECT 'incremental') w""",
    "op_classify": """
SELECT id, version,
  CASE WHEN deleted_at IS NOT NULL THEN 'deleted' WHEN version > 1 THEN 'updated' ELSE 'created' END AS op
FROM rec""",
    "doc_projection": """
SELECT id, external_id, name, email, company, city, country, status, tags_literal AS tags,
  amount_value AS amount, version, created_at, updated_at
FROM typed WHERE deleted_at IS NULL""",
    "route_fanout": """
SELECT subscriber, routing_key, count(*) AS n
FROM (SELECT concat('record.', op) AS routing_key FROM ev) e
JOIN (SELECT 'all' AS subscriber UNION ALL SELECT 'removals' UNION ALL SELECT 'any_record') s
  ON subscriber <> 'removals' OR routing_key = 'record.deleted'
GROUP BY subscriber, routing_key""",
    "apply_changes": """
SELECT coalesce(r.id, n.id) AS id, coalesce(n.status, r.status) AS status,
  coalesce(n.amount, r.amount) AS amount,
  CAST(coalesce(r.version, 0) + coalesce(n.steps, 0) AS INTEGER) AS version,
  coalesce(r.created_at, n.created_at) AS created_at,
  coalesce(n.updated_at, r.updated_at) AS updated_at,
  coalesce(r.deleted_at, n.deleted_at) AS deleted_at
FROM rec r FULL JOIN (
  SELECT id, count(*) AS steps, arg_max(status, seq) FILTER (status IS NOT NULL) AS status,
    arg_max(amount, seq) FILTER (amount IS NOT NULL) AS amount, arg_max(changed_at, seq) AS updated_at,
    min(changed_at) FILTER (kind = 'insert') AS created_at,
    max(changed_at) FILTER (kind = 'delete') AS deleted_at
  FROM effective GROUP BY id
) n ON n.id = r.id""",
    "change_counts": """
SELECT count(*) FILTER (kind = 'insert') AS inserted, count(*) FILTER (kind = 'update') AS updated,
  count(*) FILTER (kind = 'delete') AS deleted FROM effective""",
    "batch_outcomes": """
SELECT page, count(*) AS n_rows,
  count(*) FILTER (deleted_at IS NOT NULL OR amount_value IS NOT NULL) AS indexed,
  count(*) FILTER (deleted_at IS NULL AND amount_value IS NULL) AS dead_lettered,
  count(*) AS published, count(deleted_at) AS deleted
FROM (SELECT *, CAST(ceil(row_number() OVER (ORDER BY id) / 500.0) AS BIGINT) AS page FROM typed) p
GROUP BY page""",
    "dlq_upsert": f"SELECT {_ENTRY} FROM dlq",
    "dlq_attempts": """
SELECT source_record_id, sink, mode, failed_at,
  row_number() OVER (PARTITION BY source_record_id, sink ORDER BY failed_at, mode) AS attempt_no
FROM failures""",
    "dlq_list": f"""
SELECT {_ENTRY} FROM dlq ORDER BY first_failed_at DESC, source_record_id DESC LIMIT 50""",
    "dlq_latest": f"""
SELECT {_ENTRY} FROM dlq ORDER BY first_failed_at DESC, source_record_id DESC LIMIT 3""",
    "dlq_replay_plan": "SELECT id, sink, outcome, amount, version FROM replay",
    "dlq_replay_result": """
SELECT id, CASE outcome WHEN 'ok' THEN 'index' ELSE 'delete' END AS op,
  CASE outcome WHEN 'ok' THEN CAST(amount AS DOUBLE) END AS amount, version
FROM replay WHERE outcome IN ('ok', 'tombstone')""",
    "dlq_after_replay": f"SELECT {_ENTRY} FROM after_replay",
    "dlq_counts": "SELECT status, count(*) AS n FROM after_replay GROUP BY status",
    "dlq_autoresolve": """
SELECT id, sink, amount, version FROM replay WHERE outcome = 'ok' AND updated_at > last_failed_at""",
    "union_feeds": "SELECT id, version, worker, updated_at FROM feed",
    "dedupe_events": """
SELECT event_id, id, version, op, status, emitted_at, delivery FROM deliveries WHERE delivery = 1""",
    "dedupe_new_only": """
SELECT id, version, updated_at FROM feed
WHERE worker = 'incremental' AND (id, version) NOT IN (
  SELECT (id, version) FROM feed
  WHERE worker = 'backfill' AND id <= (SELECT max(last_id) FROM ledger))""",
    "overlap_rows": """
SELECT id, version FROM feed WHERE worker = 'incremental'
INTERSECT
SELECT id, version FROM feed WHERE worker = 'backfill' AND id <= (SELECT max(last_id) FROM ledger)""",
    "delivery_rank": """
SELECT event_id, id, version, delivery,
  row_number() OVER (PARTITION BY id, version ORDER BY delivery) AS delivery_rank,
  row_number() OVER (PARTITION BY id, version ORDER BY delivery) > 1 AS is_duplicate
FROM deliveries""",
    "events_by_status": "SELECT status, count(*) AS n FROM ev GROUP BY status",
    "events_by_op": "SELECT op, count(*) AS n FROM ev GROUP BY op",
    "events_by_country": "SELECT country, count(*) AS n FROM rec GROUP BY country",
    "event_counters": """
SELECT CASE WHEN grouping(status) = 0 THEN 'status' ELSE 'op' END AS dimension,
  coalesce(status, op) AS key, count(*) AS n
FROM ev GROUP BY GROUPING SETS ((status), (op))""",
    "poison_events": """
SELECT value, poison, count(*) AS n FROM raw_events WHERE poison IS NOT NULL GROUP BY value, poison""",
    "consume_stream_poison": """
SELECT value, poison, count(*) AS n FROM raw_events WHERE poison IS NOT NULL GROUP BY value, poison""",
    "consumer_totals": "SELECT * FROM totals",
    "search": f"""
SELECT {_HIT} FROM docs WHERE status = 'active' AND country = 'NATION_3'
  AND list_has_any(string_split_regex(lower(name), '[^a-z0-9]+'), ['customer', 'building'])""",
    "search_text": """
SELECT 'words' AS asked, id FROM docs
WHERE list_has_any(string_split_regex(lower(name), '[^a-z0-9]+'), ['000000042', '000000107'])
UNION ALL SELECT 'company', id FROM docs
WHERE company = 'BUILDING' OR list_contains(string_split_regex(lower(name), '[^a-z0-9]+'), 'building')
UNION ALL SELECT 'address', id FROM docs
WHERE email = 'customer#000000042.0@example.com'
  OR list_has_any(string_split_regex(lower(name), '[^a-z0-9]+'),
                  ['customer', '000000042', '0', 'example', 'com'])""",
    "search_terms": f"SELECT {_HIT} FROM docs WHERE status = 'pending' AND country = 'NATION_7'",
    "search_page": f"""
SELECT {_HIT} FROM docs WHERE status = 'active' ORDER BY updated_at DESC, id LIMIT 25 OFFSET 50""",
    "search_index_page": f"""
SELECT {_HIT} FROM docs WHERE status = 'active' ORDER BY updated_at DESC, id LIMIT 25 OFFSET 50""",
    "search_keyset": f"""
SELECT {_HIT} FROM docs WHERE status = 'active' AND (updated_at < TIMESTAMP '1997-01-01'
  OR (updated_at = TIMESTAMP '1997-01-01' AND id > 5)) ORDER BY updated_at DESC, id LIMIT 100""",
    "search_index_keyset": f"""
SELECT {_HIT} FROM docs WHERE status = 'active' AND (updated_at < TIMESTAMP '1997-01-01'
  OR (updated_at = TIMESTAMP '1997-01-01' AND id > 5)) ORDER BY updated_at DESC, id LIMIT 100""",
    "search_total": """
SELECT count(*) AS total, CAST(greatest(1, ceil(count(*) / 20.0)) AS BIGINT) AS pages
FROM docs WHERE status = 'active'""",
    "search_index_total": """
SELECT count(*) AS total, CAST(greatest(1, ceil(count(*) / 20.0)) AS BIGINT) AS pages
FROM docs WHERE status = 'active'""",
    "sample_live": """
SELECT id, version, status FROM rec WHERE deleted_at IS NULL
ORDER BY md5(concat('7:', CAST(id AS VARCHAR))), id LIMIT 20""",
    "reconcile": "SELECT * FROM reconciled",
    "reconcile_summary": "SELECT verdict, count(*) AS n FROM reconciled GROUP BY verdict",
    "reconcile_digest": """
SELECT * FROM (
  SELECT coalesce(s.id, t.id) AS id, s.version AS source_version, t.version AS sink_version,
    CASE WHEN t.id IS NULL THEN 'missing' WHEN s.id IS NULL THEN 'extra'
         WHEN t.version < s.version THEN 'stale' WHEN t.version > s.version THEN 'ahead'
         WHEN (s.status, s.amount, s.updated_at) IS DISTINCT FROM (t.status, t.amount, t.updated_at) THEN 'differs'
    END AS verdict
  FROM (SELECT * FROM rec WHERE deleted_at IS NULL) s FULL JOIN sink_contents t ON s.id = t.id)
WHERE verdict IS NOT NULL""",
    "missing_in_sink": "SELECT * FROM source WHERE id NOT IN (SELECT id FROM sink_copy)",
    "extra_in_sink": "SELECT * FROM sink_copy WHERE id NOT IN (SELECT id FROM source)",
    "duplicate_ids": "SELECT id, count(*) AS copies FROM feed GROUP BY id HAVING count(*) > 1",
    "live_count": "SELECT count(*) FILTER (deleted_at IS NULL) AS live, count(*) AS total FROM rec",
    "max_id": "SELECT coalesce(max(id), 0) AS max_id FROM rec",
    "backfill_progress": f"""
SELECT l AS last_id, m AS max_id, {_PROGRESS} AS progress_pct
FROM (SELECT max(last_id) AS l FROM ledger), (SELECT max(id) AS m FROM rec)""",
    "lag_seconds": f"""
SELECT {_LAG} AS lag_seconds FROM rec WHERE (updated_at, id) > (TIMESTAMP '1997-01-01', 5)""",
    "throughput_30s": "SELECT * FROM rates",
    "rate_sliding": """
SELECT mode, w AS window_start, CAST(sum(n) AS BIGINT) AS n_rows
FROM (SELECT mode, n, unnest([s, s - 10, s - 20]) AS w
      FROM (SELECT mode, n, CAST(floor(t_ms / 10000.0) * 10 AS BIGINT) AS s FROM samples) a) b
GROUP BY mode, w""",
    "rate_stream": """
SELECT mode, w AS window_start, CAST(sum(n) AS BIGINT) AS n_rows
FROM (SELECT mode, n, unnest([s, s - 10, s - 20]) AS w
      FROM (SELECT mode, n, CAST(floor(t_ms / 10000.0) * 10 AS BIGINT) AS s FROM samples) a) b
GROUP BY mode, w""",
    "overall_health": """
SELECT 'damaged' AS sink, count(*) = 0 AS ok,
  CASE WHEN count(*) = 0 THEN 'healthy' ELSE 'degraded' END AS overall_health
FROM reconciled WHERE verdict = 'missing'
UNION ALL SELECT 'whole', true, 'healthy'""",
    "status_report": f"""
SELECT
  (SELECT count(*) FROM source) AS total_records,
  m AS max_id,
  (SELECT status FROM checkpoints WHERE mode = 'backfill') AS backfill_status,
  l AS backfill_last_id,
  (SELECT rows_processed FROM checkpoints WHERE mode = 'backfill') AS backfill_rows_processed,
  {_PROGRESS} AS backfill_progress_pct,
  (SELECT status FROM checkpoints WHERE mode = 'incremental') AS incremental_status,
  (SELECT rows_processed FROM checkpoints WHERE mode = 'incremental') AS incremental_rows_processed,
  (SELECT {_LAG} FROM rec WHERE (updated_at, id) > (TIMESTAMP '1997-01-01', 5)) AS incremental_lag_seconds,
  (SELECT arg_max(rows_per_sec, t_ms) FROM rates WHERE mode = 'backfill') AS backfill_rows_per_sec,
  (SELECT arg_max(rows_per_sec, t_ms) FROM rates WHERE mode = 'incremental') AS incremental_rows_per_sec,
  processed_total, duplicates_skipped_total, errors_total,
  (SELECT count(*) FROM dlq WHERE status = 'pending') AS dlq_pending_count,
  (SELECT CASE WHEN count(*) = 0 THEN 'healthy' ELSE 'degraded' END
   FROM reconciled WHERE verdict = 'missing') AS overall_health
FROM (SELECT max(last_id) AS l FROM ledger), (SELECT max(id) AS m FROM rec), totals""",
    "scalar_text": """
SELECT id, left(concat('mapper: ', repeat(email, 80)), 2000) AS error,
  coalesce(nullif(regexp_replace(company, '^BUILDING$', ''), ''), 'unknown') AS company_or_unknown,
  concat_ws(':', id, version) AS change_key, lower(concat(name, '@', city)) AS address,
  array_to_string(list_filter(string_split_regex(lower(email), '[^a-z0-9]+'), lambda w: w <> ''), ' ')
    AS words
FROM rec""",
    "scalar_json": """
SELECT id, CAST(json_object('id', id, 'external_id', external_id, 'version', version, 'status', status,
                            'updated_at', strftime(updated_at, '%Y-%m-%dT%H:%M:%S.%gZ')) AS VARCHAR) AS json, external_id, version
FROM rec""",
    "scalar_array": """
SELECT id, CAST(len(t) AS BIGINT) AS n_tags, concat('{', array_to_string(t, ','), '}') AS literal,
  CASE WHEN len(t) = 2 AND t[1] = t[2] THEN concat('{', t[1], '}')
       ELSE concat('{', array_to_string(t, ','), '}') END AS distinct_literal,
  t[1] AS first_tag
FROM (SELECT id, string_split(substr(tags_literal, 2, length(tags_literal) - 2), ',') AS t FROM rec) x""",
    "scalar_num": """
SELECT id, amount_value IS NOT NULL AS numeric, coalesce(amount_value, 0.0) AS value,
  least(greatest(version, 2), 3) AS clamped, round(coalesce(amount_value, 0.0), 1) AS one_decimal,
  CAST(greatest(1, ceil(id / 20.0)) AS BIGINT) AS pages
FROM typed""",
    "scalar_time": """
SELECT event_id, epoch_us(ts) AS micros, epoch_us(date_trunc('milliseconds', ts)) AS millis_cut,
  strftime(ts, '%Y-%m-%dT%H:%M:%S.%gZ') AS iso,
  round(greatest(0.0, (1706745600000000 - epoch_us(ts)) / 1e6), 1) AS age_seconds,
  props IS NOT NULL AS has_props
FROM events""",
    "backfill_job": _STATE,
    "incremental_job": _STATE,
    "replicate_stream": _STATE,
    "dead_letter_job": """
SELECT source_record_id, sink, external_id, 'mapper_parsing_exception: bad amount N/A' AS error,
  attempt_count, status FROM dlq""",
    "subscription_backlog": """
SELECT subscriber, 'record.' || op AS routing_key, CAST(count(*) * max(times) AS BIGINT) AS n
FROM (SELECT CASE WHEN deleted_at IS NOT NULL THEN 'deleted' WHEN version > 1 THEN 'updated' ELSE 'created' END AS op FROM rec),
  (SELECT unnest(['all', 'removals', 'any_record']) AS subscriber, unnest([1, 2, 2]) AS times)
WHERE subscriber <> 'removals' OR op = 'deleted'
GROUP BY subscriber, op""",
    "store_lookup": f"{_STATE} WHERE country = 'NATION_3' AND company = 'BUILDING'",
    "run_outcomes": """
SELECT mode, CAST(1 AS BIGINT) AS batch_id, count(*) AS n_rows, count(*) FILTER (NOT bad) AS indexed,
  count(*) FILTER (bad) AS dead_lettered, count(*) AS published, count(*) FILTER (deleted_at IS NOT NULL) AS deleted
FROM (SELECT *, amount = 'N/A' AND deleted_at IS NULL AS bad FROM rec), (SELECT unnest(['backfill', 'incremental']) AS mode)
GROUP BY mode""",
    "run_samples": """
SELECT 'backfill' AS mode, count(*) AS n_rows, true AS has_rate FROM rec
UNION ALL SELECT 'incremental', count(*), false FROM rec""",
    "consume_stream": """
SELECT 'total' AS dimension, 'processed' AS key, count(*) AS n FROM unique_valid
UNION ALL SELECT 'status', status, count(*) FROM unique_valid GROUP BY status
UNION ALL SELECT 'op', op, count(*) FROM unique_valid GROUP BY op
UNION ALL SELECT 'country', coalesce(nullif(country, ''), 'unknown'), count(*)
FROM unique_valid GROUP BY 2""",
    "consume_stream_totals": "SELECT * FROM totals",
}


def _with_inputs(body: str) -> str:
    """Prefix a query with the inputs it names, in the order they are defined."""
    needed: set[str] = set()
    queue = [body]
    while queue:
        words = set(re.findall(r"\b(?:FROM|JOIN)\s+(\w+)|,\s*(totals)\b", queue.pop()))
        for name in {w for pair in words for w in pair if w in INPUTS} - needed:
            needed.add(name)
            queue.append(INPUTS[name])
    if not needed:
        return body
    ctes = [f"{name} AS ({sql})" for name, sql in INPUTS.items() if name in needed]
    return "WITH " + ",\n".join(ctes) + body if body.startswith("\n") else (
        "WITH " + ",\n".join(ctes) + "\n" + body
    )


ORACLES = {f"q_{name}": _with_inputs(body) for name, body in BODIES.items()}
