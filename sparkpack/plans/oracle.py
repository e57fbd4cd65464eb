"""The derived inputs as SQL views, and a helper that puts the views a check needs in front of its query."""
from __future__ import annotations

import re

from sparkpack.sources import fixtures as fx

H = 3_600_000_000  # microseconds per hour
THREE = ", ".join(f"({n}::BIGINT, '{e}')" for n, e in fx.THREE_SHARDS)
_LEVELS = ", ".join(f"'{x}'" for x in fx.LOG_LEVELS)
_CODES = ", ".join(f"'{x}'" for x in fx.ATTEMPT_CODES)
_METRIC = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in fx.SAMPLE_METRIC.items())


def shard_case(key: str) -> str:
    whens = " ".join(f"WHEN {key} <= '{e}' THEN {n}" for n, e in sorted(fx.THREE_SHARDS, key=lambda x: x[1]))
    return f"(CASE {whens} END)::BIGINT"


def varint(x: str) -> str:
    """Hex text of a protobuf varint below 2^28."""
    def byte(v: str) -> str:
        return f"printf('%02x', ({v})::INTEGER)"
    return (
        f"CASE WHEN {x} < 128 THEN {byte(x)} "
        f"WHEN {x} < 16384 THEN {byte(f'({x}) % 128 + 128')} || {byte(f'({x}) // 128')} "
        f"WHEN {x} < 2097152 THEN {byte(f'({x}) % 128 + 128')} || {byte(f'({x}) // 128 % 128 + 128')} || {byte(f'({x}) // 16384')} "
        f"ELSE {byte(f'({x}) % 128 + 128')} || {byte(f'({x}) // 128 % 128 + 128')} || {byte(f'({x}) // 16384 % 128 + 128')} || {byte(f'({x}) // 2097152')} END"
    )


def varlen(x: str) -> str:
    return f"(CASE WHEN {x} < 128 THEN 1 WHEN {x} < 16384 THEN 2 WHEN {x} < 2097152 THEN 3 ELSE 4 END)"


VIEWS: dict[str, str] = {
    "user_records": """
        SELECT event_id AS source_id, event_type AS stream_name, user_id::VARCHAR AS partition_key,
               CASE WHEN event_id % 10 = 0 THEN (1 + (event_id // 10) % 33)::VARCHAR || repeat('0', 30)
                    || lpad(event_id::VARCHAR, 7, '0') END AS explicit_hash_key,
               props AS data, ts AS arrival_ts
        FROM events""",
    "keyed": """
        SELECT *, CASE WHEN explicit_hash_key IS NOT NULL THEN lpad(explicit_hash_key, 39, '0')
                       ELSE lpad(md5_number(partition_key)::VARCHAR, 39, '0') END AS hash_key
        FROM user_records""",
    "routed": f"""
        SELECT *, {shard_case('hash_key')} AS shard_no,
               arrival_ts + INTERVAL 6 HOUR AS deadline_ts, arrival_ts + INTERVAL 24 HOUR AS expiration_ts
        FROM keyed""",
    "three_shards": f"SELECT * FROM (VALUES {THREE}) AS t(shard_no, end_key)",
    "dirty_records": f"""
        SELECT source_id,
               CASE WHEN source_id % 97 = 0 THEN '  ' ELSE stream_name END AS stream_name,
               CASE WHEN source_id % 97 = 0 THEN partition_key WHEN source_id % 89 = 0 THEN NULL
                    WHEN source_id % 83 = 0 THEN repeat('k', 257) ELSE partition_key END AS partition_key,
               CASE WHEN source_id % 79 = 0 THEN 'abc' WHEN source_id % 73 = 0 THEN '{2**128}'
                    ELSE explicit_hash_key END AS explicit_hash_key,
               CASE WHEN source_id % 5000 = 1 THEN repeat('x', 1048577) ELSE data END AS data, arrival_ts
        FROM user_records""",
    "validated": f"""
        SELECT *, CASE WHEN stream_name IS NULL OR trim(stream_name) = '' THEN 'stream'
                       WHEN partition_key IS NULL THEN 'key null'
                       WHEN length(partition_key) NOT BETWEEN 1 AND 256 THEN 'key length'
                       WHEN explicit_hash_key IS NOT NULL AND NOT regexp_full_match(trim(explicit_hash_key), '[0-9]+')
                            THEN 'explicit key not a number'
                       WHEN explicit_hash_key IS NOT NULL AND (length(ltrim(trim(explicit_hash_key), '0')) > 39
                            OR lpad(ltrim(trim(explicit_hash_key), '0'), 39, '0') > '{2**128 - 1}')
                            THEN 'explicit key out of range'
                       WHEN strlen(data) > 1048576 THEN 'data too large' END AS reject_reason
        FROM dirty_records""",
    "put_records": f"""
        SELECT *, {shard_case('hash_key')} AS shard_no, arrival_ts + INTERVAL 96 HOUR AS deadline_ts, arrival_ts + INTERVAL 120 HOUR AS expiration_ts
        FROM (SELECT *, CASE WHEN explicit_hash_key IS NOT NULL THEN lpad(explicit_hash_key, 39, '0')
                             ELSE lpad(md5_number(partition_key)::VARCHAR, 39, '0') END AS hash_key FROM validated WHERE reject_reason IS NULL)""",
    "put_times": """
        SELECT source_id, partition_key, epoch_us(deadline_ts) AS due, epoch_us(expiration_ts) AS expire FROM put_records""",
    "stream_shards": """
        SELECT DISTINCT event_type AS stream_name, user_id // 10 AS page_no, user_id + 1 AS shard_no,
               lpad(md5_number(user_id::VARCHAR)::VARCHAR, 39, '0') AS end_key, user_id % 7 = 0 AS closed
        FROM events
        UNION ALL
        SELECT DISTINCT event_type, -1, 0, '340282366920938463463374607431768211455', false FROM events""",
    "open_shards": """
        SELECT stream_name, shard_no, end_key FROM stream_shards
        WHERE NOT closed AND NOT (page_no % 6 = 5)""",
    "request_members": """
        SELECT event_id AS source_id, event_type AS stream_name, event_id // 2 AS entry_id, event_id // 100 AS request_id,
               (event_id // 2) % 50 AS pos, 1 + (event_id // 2) % 3 AS predicted_shard, strlen(props) AS data_bytes,
               ts AS arrival_ts, ts + INTERVAL 3 HOUR AS expiration_ts
        FROM events""",
    "requests": """
        SELECT request_id, n_entries, request_id % 31 = 0 AS transport_error,
               CASE WHEN request_id % 31 = 0 THEN NULL WHEN request_id % 29 = 0 THEN 400
                    WHEN request_id % 23 = 0 THEN 503 ELSE 200 END AS status,
               CASE WHEN request_id % 31 = 0 THEN 'connection reset by peer' END AS error_text,
               start_ts, start_ts + to_milliseconds(10 + request_id % 90) AS end_ts
        FROM (SELECT request_id, count(DISTINCT pos) AS n_entries, max(arrival_ts) + INTERVAL 1 SECOND AS start_ts
              FROM request_members GROUP BY 1)""",
    "request_entries": """
        SELECT request_id, pos, entry_id, predicted_shard, sum(data_bytes)::BIGINT AS data_bytes, count(*) AS n_members
        FROM request_members GROUP BY 1, 2, 3, 4""",
    "responses": f"""
        SELECT request_id, pos,
               CASE WHEN error_code IS NULL THEN '4957' || lpad(entry_id::VARCHAR, 52, '0') END AS sequence_number,
               CASE WHEN error_code IS NULL THEN 'shardId-' || lpad((CASE WHEN entry_id % 50 = 7 THEN 1 + (entry_id + 1) % 3
                    ELSE predicted_shard END)::VARCHAR, 12, '0') END AS shard_id,
               error_code, CASE WHEN error_code IS NOT NULL THEN 'entry ' || entry_id END AS error_message
        FROM (SELECT *, CASE entry_id % 20 WHEN 0 THEN '{fx.THROTTLED}' WHEN 1 THEN 'InternalFailure'
                        WHEN 2 THEN 'ServiceUnavailable' WHEN 3 THEN 'xx' END AS error_code FROM request_entries)
        WHERE request_id % 31 <> 0 AND request_id % 29 <> 0 AND request_id % 23 <> 0
          AND NOT (request_id % 17 = 0 AND pos = 49)""",
    "matched": """
        SELECT e.*, r.start_ts, r.end_ts, r.transport_error, r.status, r.error_text, r.n_entries, p.n_results,
               x.sequence_number, x.shard_id, x.error_code, x.error_message,
               CASE WHEN r.transport_error THEN 'retry' WHEN r.status = 200 THEN 'per_record'
                    WHEN r.status BETWEEN 500 AND 599 THEN 'retry' ELSE 'fail' END AS action,
               coalesce(r.status = 200 AND coalesce(p.n_results, 0) <> r.n_entries, false) AS mismatch
        FROM request_entries e JOIN requests r USING (request_id)
        LEFT JOIN (SELECT request_id, count(*) AS n_results FROM responses GROUP BY 1) p USING (request_id)
        LEFT JOIN responses x ON x.request_id = e.request_id AND x.pos = e.pos""",
    "entry_outcomes": f"""
        SELECT *, CASE WHEN action = 'retry' THEN 'retry' WHEN action = 'fail' OR mismatch THEN 'fail'
                       WHEN sequence_number IS NOT NULL AND predicted_shard <> -1
                            AND split_part(shard_id, '-', 2)::BIGINT <> predicted_shard THEN 'retry'
                       WHEN sequence_number IS NOT NULL THEN 'success'
                       WHEN error_code IN ('{fx.THROTTLED}', 'InternalFailure', 'ServiceUnavailable') THEN 'retry'
                       ELSE 'fail' END AS outcome,
               CASE WHEN transport_error THEN 'Transport' WHEN action <> 'per_record' THEN 'Http' || status
                    WHEN mismatch THEN 'Record Count Mismatch'
                    WHEN sequence_number IS NOT NULL AND predicted_shard <> -1
                         AND split_part(shard_id, '-', 2)::BIGINT <> predicted_shard THEN 'Wrong Shard'
                    WHEN sequence_number IS NOT NULL THEN NULL ELSE error_code END AS code,
               CASE WHEN transport_error THEN error_text WHEN action <> 'per_record' THEN NULL
                    WHEN mismatch THEN coalesce(n_results, 0) || ' received, ' || n_entries || ' sent'
                    WHEN sequence_number IS NOT NULL AND predicted_shard <> -1
                         AND split_part(shard_id, '-', 2)::BIGINT <> predicted_shard
                         THEN 'Record did not end up in expected shard.'
                    WHEN sequence_number IS NOT NULL THEN NULL ELSE error_message END AS message
        FROM matched""",
    "record_outcomes": """
        SELECT m.source_id, m.stream_name, m.arrival_ts, m.expiration_ts, m.data_bytes AS record_bytes,
               o.request_id, o.pos, o.predicted_shard,
               o.outcome, o.code, o.message, o.start_ts, o.end_ts,
               CASE WHEN o.outcome = 'success' THEN o.shard_id END AS shard_id,
               CASE WHEN o.outcome = 'success' THEN o.sequence_number END AS sequence_number
        FROM request_members m JOIN entry_outcomes o ON o.request_id = m.request_id AND o.pos = m.pos""",
    "attempts": f"""
        SELECT source_id, stream_name, shard_no, data_bytes, arrival_ts, i AS attempt_no,
               start_ts, start_ts + to_milliseconds(5 * (1 + source_id % 7)) AS end_ts, success,
               CASE WHEN NOT success THEN code END AS error_code,
               CASE WHEN NOT success THEN 'failed with ' || code END AS error_message,
               CASE WHEN success THEN 'shardId-' || lpad(shard_no::VARCHAR, 12, '0') END AS shard_id,
               CASE WHEN success THEN '4957' || lpad(source_id::VARCHAR, 52, '0') END AS sequence_number
        FROM (SELECT r.*, strlen(data) AS data_bytes, i, arrival_ts + to_milliseconds(i * 100) AS start_ts,
                     i = 1 + source_id % 3 AND source_id % 11 <> 0 AS success,
                     ([{_CODES}])[(source_id + i) % 4 + 1] AS code
              FROM (SELECT *, unnest(range(1, 2 + source_id % 3)) AS i FROM routed) r)""",
    "last_attempts": """
        SELECT * FROM attempts QUALIFY row_number() OVER (PARTITION BY source_id ORDER BY attempt_no DESC) = 1""",
    "results": """
        SELECT CASE WHEN kind = 2 THEN event_id + 10000000 ELSE event_id END AS source_id,
               event_id % 11 <> 0 AND kind = 0 AS success,
               ts + to_milliseconds((1 + event_id % 3) * 200 + CASE WHEN kind = 1 THEN 1000 ELSE 0 END) AS finished_ts,
               '4957' || lpad(event_id::VARCHAR, 52, '0') AS sequence_number
        FROM (SELECT *, unnest(list_filter([CASE WHEN event_id % 25 <> 0 THEN 0 END,
                     CASE WHEN event_id % 60 = 0 AND event_id % 25 <> 0 THEN 1 END,
                     CASE WHEN event_id % 400 = 0 THEN 2 END], lambda x: x IS NOT NULL)) AS kind FROM events)""",
    "metric_samples": f"""
        SELECT event_id AS sample_id, CASE event_type {_METRIC} END AS name,
               CASE WHEN event_type = 'error' THEN 'Code' || (user_id % 3) END AS error_code,
               'stream-' || (user_id % 4) AS stream_name,
               CASE WHEN user_id % 9 <> 0 THEN 'shardId-' || lpad((user_id % 8)::VARCHAR, 12, '0') END AS shard_id,
               value, make_timestamp(epoch_us(ts) - epoch_us(ts) % 86400000000 + (epoch_us(ts) % 86400000000) // 480) AS ts
        FROM events""",
    "samples_dims": """
        SELECT *, 'MetricName=' || name || coalesce(',ErrorCode=' || error_code, '') || ',StreamName=' || stream_name
                  || coalesce(',ShardId=' || shard_id, '') AS dims
        FROM metric_samples""",
    "metric_prefixes": """
        SELECT sample_id, value, ts, 'MetricName=' || name AS dims, 1 AS n_dims FROM metric_samples
        UNION ALL
        SELECT sample_id, value, ts, 'MetricName=' || name || ',ErrorCode=' || error_code, 2 FROM metric_samples
        WHERE error_code IS NOT NULL
        UNION ALL
        SELECT sample_id, value, ts, 'MetricName=' || name || coalesce(',ErrorCode=' || error_code, '') || ',StreamName=' || stream_name,
               CASE WHEN error_code IS NULL THEN 2 ELSE 3 END FROM metric_samples
        UNION ALL
        SELECT sample_id, value, ts, 'MetricName=' || name || coalesce(',ErrorCode=' || error_code, '') || ',StreamName=' || stream_name
               || ',ShardId=' || shard_id, CASE WHEN error_code IS NULL THEN 3 ELSE 4 END
        FROM metric_samples WHERE shard_id IS NOT NULL""",
    "count_batches": """
        SELECT *, (row_number() OVER w - 1) // 20 AS batch_no, (row_number() OVER w - 1) % 20 AS pos
        FROM routed WINDOW w AS (PARTITION BY stream_name, shard_no ORDER BY deadline_ts, arrival_ts, source_id)""",
    "batch_keys": """
        SELECT stream_name, shard_no, batch_no, partition_key, min(pos) AS first_pos, count(*) AS uses,
               row_number() OVER (PARTITION BY stream_name, shard_no, batch_no ORDER BY min(pos)) AS key_index
        FROM count_batches GROUP BY 1, 2, 3, 4""",
    "batch_ehks": """
        SELECT stream_name, shard_no, batch_no, explicit_hash_key, min(pos) AS first_pos, count(*) AS uses,
               row_number() OVER (PARTITION BY stream_name, shard_no, batch_no ORDER BY min(pos)) AS key_index
        FROM count_batches WHERE explicit_hash_key IS NOT NULL GROUP BY 1, 2, 3, 4""",
    "batch_members": f"""
        SELECT b.*, k.key_index AS pk_index, coalesce(e.key_index, 0) AS ehk_index,
               CASE WHEN strlen(data) = 0 THEN 0 ELSE 1 + {varlen('strlen(data)')} + strlen(data) END
               + 1 + {varlen('k.key_index')}
               + CASE WHEN e.key_index IS NULL THEN 0 ELSE 1 + {varlen('e.key_index')} END AS body_size
        FROM count_batches b
        JOIN batch_keys k USING (stream_name, shard_no, batch_no, partition_key)
        LEFT JOIN batch_ehks e USING (stream_name, shard_no, batch_no, explicit_hash_key)""",
    "packed": f"""
        SELECT m.stream_name, m.shard_no, m.batch_no, n, first_key, first_hash, arrival_ts, deadline_ts, expiration_ts,
               CASE WHEN n = 1 THEN first_data_hex ELSE
                 'f3899ac2' || body || md5(unhex(body)) END AS data_hex
        FROM (SELECT stream_name, shard_no, batch_no, count(*) AS n,
                     arg_min(partition_key, pos) AS first_key, arg_min(hash_key, pos) AS first_hash,
                     max(arrival_ts) AS arrival_ts, min(deadline_ts) AS deadline_ts, min(expiration_ts) AS expiration_ts,
                     arg_min(lower(hex(data)), pos) AS first_data_hex,
                     '0a0120' || any_value(k.keys) || '120120' || coalesce(any_value(e.keys), '')
                     || string_agg('1a' || {varint('body_size')} || '08' || {varint('pk_index')}
                        || CASE WHEN ehk_index > 0 THEN '10' || {varint('ehk_index')} ELSE '' END
                        || CASE WHEN strlen(data) > 0 THEN '1a' || {varint('strlen(data)')} || lower(hex(data)) ELSE '' END,
                        '' ORDER BY pos) AS body
              FROM batch_members
              JOIN (SELECT stream_name, shard_no, batch_no,
                           string_agg('0a' || {varint('strlen(partition_key)')} || lower(hex(partition_key)), '' ORDER BY key_index) AS keys
                    FROM batch_keys GROUP BY 1, 2, 3) k USING (stream_name, shard_no, batch_no)
              LEFT JOIN (SELECT stream_name, shard_no, batch_no,
                           string_agg('12' || {varint('strlen(explicit_hash_key)')} || lower(hex(explicit_hash_key)), '' ORDER BY key_index) AS keys
                    FROM batch_ehks GROUP BY 1, 2, 3) e USING (stream_name, shard_no, batch_no)
              GROUP BY 1, 2, 3) m""",
    "packed_items": """
        SELECT *, strlen(data_hex) // 2 AS data_size, CASE WHEN n = 1 THEN strlen(first_key) ELSE 1 END AS key_size,
               row_number() OVER (PARTITION BY stream_name ORDER BY deadline_ts, arrival_ts, shard_no, batch_no) AS rn
        FROM packed""",
    "request_of": """
        SELECT stream_name, rn, request_no FROM (
          WITH RECURSIVE r AS (
            SELECT stream_name, rn, 0::BIGINT AS request_no, 1::BIGINT AS n, (key_size + data_size)::BIGINT AS bytes, deadline_ts AS due
            FROM packed_items WHERE rn = 1
            UNION ALL
            SELECT p.stream_name, p.rn,
                   CASE WHEN new THEN r.request_no + 1 ELSE r.request_no END,
                   CASE WHEN new THEN 1 ELSE r.n + 1 END,
                   CASE WHEN new THEN p.key_size + p.data_size ELSE r.bytes + p.key_size + p.data_size END,
                   CASE WHEN new THEN p.deadline_ts ELSE r.due END
            FROM r JOIN packed_items p ON p.stream_name = r.stream_name AND p.rn = r.rn + 1,
            LATERAL (SELECT r.n >= 20 OR r.bytes + p.key_size + p.data_size + 30 > 5000 OR p.arrival_ts > r.due AS new)
          ) SELECT * FROM r)""",
    "control_rows": """
        SELECT DISTINCT event_type AS stream_name, date_trunc('day', ts) AS flush_ts FROM events
        UNION ALL
        SELECT DISTINCT NULL, date_trunc('day', ts) + INTERVAL 12 HOUR FROM events WHERE day(ts) IN (10, 20)""",
    "log_lines": f"""
        SELECT source, event_no * 4 + l.k AS line_no, l.line AS line
        FROM (SELECT source, event_no, unnest([
                {{'k': 0, 'line': CASE WHEN event_id % 43 <> 0 THEN '++++' END}},
                {{'k': 1, 'line': CASE WHEN event_id % 47 <> 0 THEN
                    CASE WHEN event_id % 8 = 7 THEN '' ELSE ([{_LEVELS}])[event_id % 8 + 1] || ': ' END
                    || '[Daemon:' || user_id || '] ' || props END}},
                {{'k': 2, 'line': CASE WHEN event_id % 3 = 0 AND event_id % 47 <> 0 THEN 'more ' || event_id END}},
                {{'k': 3, 'line': CASE WHEN event_id % 41 <> 0 THEN '----' END}}]) AS l
              FROM (SELECT *, CASE WHEN event_id % 2 = 0 THEN 'StdOut' ELSE 'StdErr' END AS source,
                           row_number() OVER (PARTITION BY event_id % 2 ORDER BY ts, event_id) AS event_no FROM events))
        WHERE l.line IS NOT NULL""",
}


def check(body: str) -> str:
    """Prefix a query with the views it names, in dependency order."""
    needed: list[str] = []

    def visit(text: str) -> None:
        for name in VIEWS:
            if re.search(rf"\b(?:FROM|JOIN)\s+{name}\b", text) and name not in needed:
                visit(VIEWS[name])
                if name not in needed:
                    needed.append(name)

    visit(body)
    if not needed:
        return body.strip()
    recursive = "RECURSIVE " if re.match(r"\s*WITH RECURSIVE", body) else ""
    head = ",\n".join(f"{n} AS ({VIEWS[n]})" for n in needed)
    text = body.strip()
    if re.match(r"WITH (RECURSIVE )?", text):
        text = re.sub(r"^WITH (RECURSIVE )?", "", text)
        return f"WITH {recursive}{head},\n{text}"
    return f"WITH {head}\n{text}"
