"""Queries over batching, packing, request collection and shaping."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkpack.config import PackConfig
from sparkpack.operators import batching as B
from sparkpack.operators import codec as C
from sparkpack.operators import shaping as S
from sparkpack.operators.arrivals import fold_arrivals
from sparkpack.operators.fold import NEVER, BatchRule
from sparkpack.operators.stage import materialize
from sparkpack.plans.oracle import varlen
from sparkpack.plans.registry import query
from sparkpack.sources import fixtures as fx

US = F.unix_micros
CFG = fx.SCALED
BATCH = ["stream_name", "shard_no", "batch_no"]
REQUEST_ORDER = ["deadline_ts", "arrival_ts", "shard_no", "batch_no"]


def count_batches(spark, d) -> DataFrame:
    return B.batch_by_count(fx.routed_table(spark, d), CFG.aggregation_max_count, CFG.slice_ms)


def layout(cfg: PackConfig) -> dict:
    return dict(slice_ms=cfg.slice_ms, block_cost=cfg.block_cost, block_ms=cfg.block_ms, buffered_ms=cfg.record_max_buffered_ms)


@query("batch_by_count", """
    SELECT stream_name, shard_no, batch_no, count(*) AS n_records, sum(strlen(data))::BIGINT AS bytes,
           epoch_us(min(arrival_ts)) AS first_us, epoch_us(max(arrival_ts)) AS last_us
    FROM count_batches GROUP BY 1, 2, 3""")
def batch_by_count(spark, d):
    """Batches of twenty per stream and shard."""
    return count_batches(spark, d).groupBy(*BATCH).agg(
        F.count(F.lit(1)).alias("n_records"), F.sum(F.octet_length("data")).alias("bytes"),
        US(F.min("arrival_ts")).alias("first_us"), US(F.max("arrival_ts")).alias("last_us"))


DOC_LIMIT = 5000


@query("batch_by_size", f"""
    WITH RECURSIVE docs AS (
      SELECT source AS stream_name, doc_id, strlen(text) AS size, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS rn
      FROM documents),
    r AS (
      SELECT stream_name, doc_id, rn, rn AS batch_rn, size::BIGINT AS acc FROM docs WHERE rn = 1
      UNION ALL
      SELECT n.stream_name, n.doc_id, n.rn, CASE WHEN r.acc + n.size > {DOC_LIMIT} THEN n.rn ELSE r.batch_rn END,
             CASE WHEN r.acc + n.size > {DOC_LIMIT} THEN n.size ELSE r.acc + n.size END
      FROM r JOIN docs n ON n.stream_name = r.stream_name AND n.rn = r.rn + 1)
    SELECT stream_name, doc_id, batch_rn, rn - batch_rn AS pos FROM r""")
def batch_by_size(spark, d):
    """Byte-bounded batches of whole documents; one larger than the bound travels alone."""
    docs = fx.document_records(spark, d)
    rule = BatchRule(size_limit=DOC_LIMIT, margin=0, use_deadline=False)
    out = B.fold_batches(docs, rule, size=F.octet_length("data"), keys=["stream_name"], order=["arrival_ts", "source_id"],
                         slice_ms=60_000, block_cost=50_000, block_ms=0, buffered_ms=0)
    return out.select("stream_name", F.col("id").alias("doc_id"), "batch_rn", "pos")


@query("batch_by_deadline", """
    WITH RECURSIVE o AS (
      SELECT stream_name, shard_no, source_id, epoch_us(arrival_ts) AS arr, epoch_us(deadline_ts) AS due,
             row_number() OVER (PARTITION BY stream_name, shard_no ORDER BY deadline_ts, arrival_ts, source_id) AS rn FROM routed),
    r AS (
      SELECT *, rn AS batch_rn, due AS flush_us FROM o WHERE rn = 1
      UNION ALL
      SELECT n.*, CASE WHEN n.arr > r.flush_us THEN n.rn ELSE r.batch_rn END, CASE WHEN n.arr > r.flush_us THEN n.due ELSE r.flush_us END
      FROM r JOIN o n ON n.stream_name = r.stream_name AND n.shard_no = r.shard_no AND n.rn = r.rn + 1)
    SELECT stream_name, shard_no, source_id, batch_rn, flush_us, 'deadline' AS reason FROM r""")
def batch_by_deadline(spark, d):
    """A batch closes at the earliest deadline of its members."""
    out = B.fold_batches(fx.routed_table(spark, d), BatchRule(), size=F.octet_length("data"), **layout(CFG))
    return out.select("stream_name", "shard_no", F.col("id").alias("source_id"), "batch_rn", "flush_us", "reason")


@query("batch_islands", f"""
    SELECT stream_name, shard_no, source_id, sum(opens) OVER (PARTITION BY stream_name, shard_no ORDER BY arrival_ts, source_id)::BIGINT AS island
    FROM (SELECT *, CASE WHEN epoch_us(arrival_ts) - epoch_us(lag(arrival_ts) OVER (PARTITION BY stream_name, shard_no ORDER BY arrival_ts, source_id))
                 > {fx.ISLAND_GAP_MS}000 THEN 1 ELSE 0 END AS opens FROM routed)""")
def batch_islands(spark, d):
    """Stretches of arrivals no buffer can span."""
    return B.batch_islands(fx.routed_table(spark, d), fx.ISLAND_GAP_MS).select("stream_name", "shard_no", "source_id", "island")


@query("batch_predicate", """
    SELECT stream_name, shard_no, source_id, (sum(flag) OVER w - flag)::BIGINT AS batch_no
    FROM (SELECT *, CASE WHEN source_id % 13 = 0 THEN 1 ELSE 0 END AS flag FROM routed)
    WINDOW w AS (PARTITION BY stream_name, shard_no ORDER BY deadline_ts, arrival_ts, source_id)""")
def batch_predicate(spark, d):
    """Batches ended by a caller's condition."""
    return B.batch_predicate(fx.routed_table(spark, d), F.col("source_id") % 13 == 0, CFG.slice_ms).select(
        "stream_name", "shard_no", "source_id", "batch_no")


def full_rule(cfg: PackConfig) -> BatchRule:
    return BatchRule(size_limit=cfg.aggregation_max_size, count_limit=cfg.aggregation_max_count, packed=True)


def full_batches(records: DataFrame, cfg: PackConfig = CFG, flag=None) -> DataFrame:
    return B.fold_batches(records, full_rule(cfg), size=F.octet_length("data"), flag=flag, **layout(cfg))


def full_sql(flag: str, body: str, cfg: PackConfig = CFG, records: str = "routed") -> str:
    """The full rule, flush by flush: `fold` has one row per record with its batch.

    spans holds, for every possible first record s of a buffer, the estimate and the exact size up to each record t that can
    still trigger; walk goes from flush to flush with s and the next record j to be added.
    """
    n, limit, margin = cfg.aggregation_max_count, cfg.aggregation_max_size, full_rule(cfg).margin
    key = "stream_name, shard_no"

    def text(col: str) -> str:
        return f"1 + {varlen(f'strlen({col})')} + strlen({col})"
    return f"""
    WITH RECURSIVE o AS (
      SELECT {key}, source_id, strlen(data) AS size, partition_key AS pk, explicit_hash_key AS ehk, epoch_us(arrival_ts) AS arr, epoch_us(deadline_ts) AS due,
             {flag} AS flag, row_number() OVER (PARTITION BY {key} ORDER BY deadline_ts, arrival_ts, source_id) AS rn, count(*) OVER (PARTITION BY {key}) AS n,
             max(epoch_us(arrival_ts)) OVER (PARTITION BY {key}) AS last
      FROM {records}),
    seen AS (
      SELECT *, coalesce(lag(rn) OVER (PARTITION BY {key}, pk ORDER BY rn), 0) AS pk_before,
             CASE WHEN ehk IS NOT NULL THEN coalesce(lag(rn) OVER (PARTITION BY {key}, ehk ORDER BY rn), 0) END AS ehk_before,
             lag(arr) OVER (PARTITION BY {key} ORDER BY rn) AS arr_before,
             2 + CASE WHEN ehk IS NULL THEN 0 ELSE 2 END + CASE WHEN size > 0 THEN 1 + {varlen('size')} + size ELSE 0 END AS body
      FROM o),
    steps AS (
      SELECT a.stream_name, a.shard_no, a.rn AS s, a.due, a.n, a.last, b.rn AS t, b.arr, b.arr_before, b.flag, b.size,
             b.size + 5 + CASE WHEN b.pk_before < a.rn THEN length(b.pk) + 3 ELSE 0 END + CASE WHEN b.ehk IS NULL THEN 0 ELSE 2 END
               + CASE WHEN b.ehk_before < a.rn THEN length(b.ehk) + 3 ELSE 0 END AS est,
             1 + {varlen('b.body')} + b.body + CASE WHEN b.pk_before < a.rn THEN {text('b.pk')} ELSE 0 END
               + CASE WHEN b.ehk_before < a.rn THEN {text('b.ehk')} ELSE 0 END AS exact
      FROM seen a JOIN seen b ON b.stream_name = a.stream_name AND b.shard_no = a.shard_no AND b.rn BETWEEN a.rn AND a.rn + {n - 1}),
    spans AS (
      SELECT {key}, s, due, n, last, t, arr, arr_before, flag,
             CASE WHEN t = s THEN size ELSE 12 + sum(est) OVER w END AS est, CASE WHEN t = s THEN size ELSE 26 + sum(exact) OVER w END AS exact
      FROM steps WINDOW w AS (PARTITION BY {key}, s ORDER BY t)),
    starts AS MATERIALIZED (
      SELECT {key}, s, any_value(due) AS due, any_value(n) AS n, any_value(last) AS last, coalesce(min(t) FILTER (exact + {margin} > {limit}), s + {n}) AS over,
             list({{'t': t, 'why': why, 'arr': arr, 'before': arr_before}} ORDER BY t) FILTER (why IS NOT NULL) AS hits
      FROM (SELECT *, CASE WHEN t > s AND arr > due THEN 'deadline' WHEN t + 1 - s >= {n} THEN 'count' WHEN est + {margin} >= {limit} THEN 'size'
                           WHEN flag THEN 'flag' END AS why FROM spans) GROUP BY {key}, s),
    walk AS (
      SELECT stream_name, shard_no, 0::BIGINT AS b, 0::BIGINT AS e, NULL::BIGINT AS flush_us, NULL::VARCHAR AS reason, 1::BIGINT AS s, 1::BIGINT AS j
      FROM o WHERE rn = 1
      UNION ALL
      SELECT {key}, s, least(stop, greatest(s + 1, over)), at_us, why, least(stop, greatest(s + 1, over)), next
      FROM (SELECT x.stream_name, x.shard_no, x.s, x.over, coalesce(h.why, 'deadline') AS why,
                   CASE WHEN h.t IS NULL THEN x.n + 1 WHEN h.why = 'deadline' THEN h.t ELSE h.t + 1 END AS next,
                   CASE WHEN h.t IS NULL THEN x.n + 1 WHEN h.why = 'deadline' THEN h.t ELSE h.t + 1 END AS stop,
                   CASE WHEN h.t IS NULL THEN greatest(x.due, x.last)
                        WHEN h.why = 'deadline' THEN greatest(x.due, h.before) ELSE h.arr END AS at_us
            FROM (SELECT starts.*, list_filter(coalesce(hits, []), lambda i: i.t >= j)[1] AS h
                  FROM walk JOIN starts ON starts.stream_name = walk.stream_name AND starts.shard_no = walk.shard_no AND starts.s = walk.s) x)),
    fold AS (
      SELECT o.stream_name, o.shard_no, o.source_id, w.b AS batch_rn, o.rn - w.b AS pos, w.flush_us, w.reason
      FROM walk w JOIN o ON o.stream_name = w.stream_name AND o.shard_no = w.shard_no AND o.rn >= w.b AND o.rn < w.e)
    {body}"""


def arrivals_sql(source: str, key: str, rule: BatchRule) -> str:
    """Buffers filled by arrival and flushed by deadline, event by event: `flushes` has one row per flush with what leaves (gone) and
    what stays (buf). source: key, id, size, arr, due, burst, burst_size. Plain sizes only."""
    item = "{'due': due, 'arr': arr, 'id': id, 'size': size, 'burst': burst, 'burst_size': burst_size}"
    same = " AND ".join(f"x.{k.strip()} = w.{k.strip()}" for k in key.split(","))
    own = ", ".join(f"w.{k.strip()}" for k in key.split(","))
    limit = f"{rule.size_limit} - {rule.margin}" if rule.size_limit != NEVER else str(NEVER)

    def total(rows: str) -> str:
        return f"list_sum(list_transform({rows}, lambda r: r.size))"
    return f"""
    arriving AS MATERIALIZED (
      SELECT *, {item} AS item, row_number() OVER (PARTITION BY {key} ORDER BY arr, id) AS rn FROM {source}),
    steps_of AS (
      SELECT {key}, 1::BIGINT AS j, 0::BIGINT AS clock, [item][:0] AS buf, [item][:0] AS gone, NULL::VARCHAR AS why FROM arriving WHERE rn = 1
      UNION ALL
      SELECT {key}, following, moment, CASE WHEN reason IS NULL THEN cand ELSE cand[n + 1:] END, CASE WHEN reason IS NULL THEN [] ELSE cand[:n] END, reason
      FROM (
        SELECT *, greatest(1, len(list_filter(range(1, least(len(cand), {rule.count_limit}) + 1), lambda i: {total('cand[1:i]')} <= {limit}))) AS n
        FROM (
          SELECT *, CASE WHEN timer THEN 'deadline' WHEN len(cand) >= {rule.count_limit} THEN 'count' WHEN {total('cand')} >= {limit} THEN 'size'
                         WHEN burst <> -1 AND list_sum(list_transform(cand, lambda r: CASE WHEN r.burst = burst THEN r.burst_size ELSE 0 END)) >= {rule.burst_limit}
                           THEN 'burst' END AS reason
          FROM (
            SELECT {own}, x.item.burst AS burst, timer, CASE WHEN timer THEN w.j ELSE w.j + 1 END AS following,
                   CASE WHEN timer THEN greatest(w.clock, w.buf[1].due) ELSE x.arr END AS moment,
                   CASE WHEN timer THEN w.buf ELSE list_sort(list_append(w.buf, x.item)) END AS cand
            FROM steps_of w LEFT JOIN arriving x ON {same} AND x.rn = w.j,
                 LATERAL (SELECT len(w.buf) > 0 AND (x.rn IS NULL OR w.buf[1].due < x.arr) AS timer)
            WHERE x.rn IS NOT NULL OR len(w.buf) > 0)))),
    flushes AS (SELECT {key}, clock AS flush_us, why AS reason, gone[1].id AS batch_id, gone, buf FROM steps_of WHERE why IS NOT NULL)"""


@query("batch_full", full_sql("source_id % 101 = 0", "SELECT * FROM fold"))
def batch_full(spark, d):
    """All triggers together: count, size estimate, a caller's condition, deadline."""
    out = full_batches(fx.routed_table(spark, d), flag=F.col("source_id") % 101 == 0)
    return out.select("stream_name", "shard_no", F.col("id").alias("source_id"), "batch_rn", "pos", "flush_us", "reason")


@query("flush_all", """
    SELECT stream_name, shard_no, flush_no, count(*) AS n_records, sum(strlen(data))::BIGINT AS bytes,
           epoch_us(min(arrival_ts)) AS first_us, epoch_us(max(arrival_ts)) AS last_us
    FROM (SELECT r.*, (SELECT count(*) FROM control_rows c
                       WHERE (c.stream_name = r.stream_name OR c.stream_name IS NULL) AND c.flush_ts <= r.arrival_ts) AS flush_no
          FROM routed r)
    GROUP BY 1, 2, 3""")
def flush_all(spark, d):
    """Batches cut by flush commands of one stream or of all streams."""
    return B.flush_all(fx.routed_table(spark, d), fx.control_rows(spark, d)).groupBy("stream_name", "shard_no", "flush_no").agg(
        F.count(F.lit(1)).alias("n_records"), F.sum(F.octet_length("data")).alias("bytes"),
        US(F.min("arrival_ts")).alias("first_us"), US(F.max("arrival_ts")).alias("last_us"))


@query("key_table", "SELECT stream_name, shard_no, batch_no, partition_key, first_pos, uses, key_index FROM batch_keys")
def key_table(spark, d):
    """Distinct keys of each batch in first-seen order."""
    return C.key_table(count_batches(spark, d), BATCH)


@query("estimated_size", """
    SELECT stream_name, shard_no, batch_no, source_id,
           (CASE WHEN pos = 0 THEN strlen(data) ELSE 12 + sum(strlen(data) + 5
              + CASE WHEN pk_first THEN length(partition_key) + 3 ELSE 0 END
              + CASE WHEN explicit_hash_key IS NOT NULL THEN 2 ELSE 0 END
              + CASE WHEN ehk_first THEN length(explicit_hash_key) + 3 ELSE 0 END) OVER w END)::BIGINT AS estimate
    FROM (SELECT *, row_number() OVER (PARTITION BY stream_name, shard_no, batch_no, partition_key ORDER BY pos) = 1 AS pk_first,
                 explicit_hash_key IS NOT NULL AND row_number() OVER (PARTITION BY stream_name, shard_no, batch_no, explicit_hash_key ORDER BY pos) = 1 AS ehk_first
          FROM count_batches)
    WINDOW w AS (PARTITION BY stream_name, shard_no, batch_no ORDER BY pos ROWS UNBOUNDED PRECEDING)""")
def estimated_size(spark, d):
    """Running size estimate inside each batch."""
    return C.estimated_size(count_batches(spark, d), BATCH).select(*BATCH, "source_id", "estimate")


@query("accurate_size", """
    SELECT stream_name, shard_no, batch_no, n AS n_records, strlen(data_hex) // 2 AS exact_size FROM packed""")
def accurate_size(spark, d):
    """Exact packed size of each batch without encoding it."""
    return C.accurate_size(count_batches(spark, d), BATCH)


@query("batch_deadlines", """
    SELECT stream_name, shard_no, batch_no, epoch_us(min(deadline_ts)) AS deadline_us, epoch_us(min(expiration_ts)) AS expiration_us
    FROM count_batches GROUP BY 1, 2, 3""")
def batch_deadlines(spark, d):
    """Deadline and expiration a batch inherits from its members."""
    return C.batch_deadlines(count_batches(spark, d), BATCH).select(
        *BATCH, US("deadline_ts").alias("deadline_us"), US("expiration_ts").alias("expiration_us"))


def packed(spark, d) -> DataFrame:
    return C.aggregate_records(count_batches(spark, d), BATCH)


@query("aggregate_records", """
    SELECT stream_name, shard_no, batch_no, n AS n_records, CASE WHEN n = 1 THEN first_key ELSE 'a' END AS partition_key,
           ltrim(first_hash, '0') AS explicit_hash_key, upper(data_hex) AS data_hex FROM packed""")
def aggregate_records(spark, d):
    """Packed wire bytes of each batch."""
    return packed(spark, d).select(*BATCH, "n_records", "partition_key", "explicit_hash_key", F.hex("data").alias("data_hex"))


@query("subsequence_numbers", """
    SELECT stream_name, shard_no, batch_no, source_id, row_number() OVER (PARTITION BY stream_name, shard_no, batch_no ORDER BY pos) - 1 AS sub_sequence
    FROM count_batches""")
def subsequence_numbers(spark, d):
    """Position of each record inside its packed record."""
    return packed(spark, d).select(*BATCH, F.posexplode("source_ids").alias("p", "source_id")).select(
        *BATCH, "source_id", F.col("p").cast("bigint").alias("sub_sequence"))


def damaged(packed_rows: DataFrame) -> DataFrame:
    """Some packed rows broken: wrong magic, wrong digest, too short."""
    h, k = F.hex("data"), F.col("batch_no") % 7
    last = F.when(F.right(h, F.lit(2)) == "00", "01").otherwise("00")
    bad = (
        F.when(k == 1, F.concat(F.lit("00"), F.substring(h, F.lit(3), F.length(h))))
        .when(k == 2, F.concat(F.substring(h, F.lit(1), F.length(h) - 2), last))
        .when(k == 3, F.substring(h, 1, 38)).otherwise(h)
    )
    return packed_rows.withColumn("data", F.when(F.col("is_aggregated"), F.unhex(bad)).otherwise(F.col("data")))


CONSUMER = ["stream_name", "shard_no", "batch_no", "partition_key", "explicit_hash_key", "data"]


@query("deaggregate_records", """
    SELECT stream_name, shard_no, batch_no, pos AS sub_sequence, partition_key, explicit_hash_key, hex(data) AS data_hex, true AS aggregated
    FROM count_batches JOIN (SELECT stream_name, shard_no, batch_no, n FROM packed) USING (stream_name, shard_no, batch_no)
    WHERE n > 1 AND batch_no % 7 NOT IN (1, 2, 3)
    UNION ALL
    SELECT stream_name, shard_no, batch_no, 0, CASE WHEN n = 1 THEN first_key ELSE 'a' END, NULL,
           CASE WHEN n = 1 THEN upper(data_hex) WHEN batch_no % 7 = 1 THEN '00' || upper(substr(data_hex, 3))
                WHEN batch_no % 7 = 2 THEN upper(substr(data_hex, 1, strlen(data_hex) - 2)) || CASE WHEN right(data_hex, 2) = '00' THEN '01' ELSE '00' END
                ELSE upper(substr(data_hex, 1, 38)) END, false
    FROM packed WHERE n = 1 OR batch_no % 7 IN (1, 2, 3)""")
def deaggregate_records(spark, d):
    """Packed rows back to user records; damaged rows pass through."""
    return C.deaggregate_records(damaged(packed(spark, d)).select(*CONSUMER, )).select(
        *BATCH, "sub_sequence", "partition_key", "explicit_hash_key", F.hex("data").alias("data_hex"), "aggregated")


@query("deaggregate_errors", """
    SELECT stream_name, shard_no, batch_no, n AS kept, 'key index 99 outside a table of ' || (keys + 1) AS error
    FROM packed JOIN (SELECT stream_name, shard_no, batch_no, count(*) AS keys FROM batch_keys GROUP BY 1, 2, 3)
         USING (stream_name, shard_no, batch_no)
    WHERE n > 1 AND batch_no % 5 = 0""")
def deaggregate_errors(spark, d):
    """Rows whose digest holds but whose last record points outside the key table."""
    head, tail = F.lit(5), F.octet_length("data") - 20
    message = F.concat(F.substring("data", head, tail), F.unhex(F.lit("1a020863")))
    broken = packed(spark, d).withColumn(
        "data", F.when(F.col("is_aggregated") & (F.col("batch_no") % 5 == 0), C.envelope(message)).otherwise(F.col("data")))
    return C.deaggregate_errors(broken.select(*CONSUMER)).select(*BATCH, "kept", "error")


# -- put requests --------------------------------------------------------------------------------------------

def as_items(packed_rows: DataFrame) -> DataFrame:
    """Packed rows as items of a request, with the size the service counts."""
    return packed_rows.withColumns({
        "item_id": F.concat_ws("/", "stream_name", "shard_no", "batch_no"),
        "item_size": (F.octet_length("partition_key") + F.col("exact_size")).cast("bigint")})


def collect(items: DataFrame, cfg: PackConfig = CFG) -> DataFrame:
    """Items with the put request they travel in."""
    rule = BatchRule(size_limit=cfg.collection_max_size, count_limit=cfg.collection_max_count)
    out = B.fold_batches(items, rule, size=F.col("item_size"), keys=["stream_name"], order=REQUEST_ORDER, id_col="item_id", **layout(cfg))
    return items.join(out.select(F.col("id").alias("item_id"), F.col("batch_rn").alias("request_rn"),
                                 F.col("pos").alias("entry_no"), F.col("flush_us").alias("request_us"), "reason"), "item_id")


def burst_rule(cfg: PackConfig = CFG) -> BatchRule:
    return BatchRule(size_limit=cfg.collection_max_size, count_limit=cfg.collection_max_count, burst_limit=cfg.shard_burst_size)


def collect_arriving(items: DataFrame, cfg: PackConfig = CFG) -> DataFrame:
    """Items with the put request they travel in: collected as they are sent, the most urgent first, with an extra flush when
    one shard's packed bytes fill a request. Items have stream_name, shard_no, item_id, item_size, exact_size and their times."""
    out = fold_arrivals(items, burst_rule(cfg), size=F.col("item_size"), keys=["stream_name"], id_col="item_id", slice_ms=cfg.slice_ms,
                        burst_key=F.col("shard_no"), burst_size=F.col("exact_size"))
    return items.join(out.select(F.col("id").alias("item_id"), F.col("batch_id").alias("request_id"),
                                 F.col("pos").alias("entry_no"), "flush_us", "reason"), "item_id")


@query("collect_requests", """
    SELECT p.stream_name, shard_no, batch_no, min(p.rn) OVER (PARTITION BY p.stream_name, request_no) AS request_rn,
           p.rn - min(p.rn) OVER (PARTITION BY p.stream_name, request_no) AS entry_no
    FROM packed_items p JOIN request_of q ON q.stream_name = p.stream_name AND q.rn = p.rn""")
def collect_requests(spark, d):
    """Packed records collected into put requests."""
    return collect(as_items(materialize(packed(spark, d)))).select("stream_name", "shard_no", "batch_no", "request_rn", "entry_no")


@query("shard_burst_flush", """
    WITH RECURSIVE sent AS (
      SELECT stream_name, shard_no, batch_no, stream_name || '/' || shard_no || '/' || batch_no AS id, (key_size + data_size)::BIGINT AS size,
             epoch_us(arrival_ts) AS arr, epoch_us(arrival_ts + INTERVAL 72 HOUR) AS due, shard_no AS burst, data_size::BIGINT AS burst_size FROM packed_items),"""
    + arrivals_sql("sent", "stream_name", burst_rule()) + """
    SELECT s.stream_name, s.shard_no, s.batch_no, f.batch_id AS request_id, f.pos AS entry_no, f.flush_us, f.reason
    FROM (SELECT stream_name, batch_id, flush_us, reason, unnest(gone).id AS id, unnest(range(len(gone))) AS pos FROM flushes) f
    JOIN sent s ON s.stream_name = f.stream_name AND s.id = f.id""")
def shard_burst_flush(spark, d):
    """Requests in send order, with an extra flush when one shard fills a request; a request waits for three days at most."""
    items = as_items(materialize(packed(spark, d))).withColumn("deadline_ts", F.timestamp_micros(US("arrival_ts") + 72 * fx.HOUR * 1000))
    return collect_arriving(items).select(
        "stream_name", "shard_no", "batch_no", "request_id", "entry_no", "flush_us", "reason")


@query("request_sizes", """
    SELECT p.stream_name, request_no, count(*) AS entries, sum(n)::BIGINT AS records, sum(key_size + data_size)::BIGINT AS bytes
    FROM packed_items p JOIN request_of q ON q.stream_name = p.stream_name AND q.rn = p.rn GROUP BY 1, 2""".replace(
        "request_no, count", "min(p.rn) AS request_rn, count").replace("GROUP BY 1, 2", "GROUP BY p.stream_name, request_no"))
def request_sizes(spark, d):
    """Bytes the service counts for each request."""
    return collect(as_items(materialize(packed(spark, d)))).groupBy("stream_name", "request_rn").agg(
        F.count(F.lit(1)).alias("entries"), F.sum("n_records").alias("records"), F.sum("item_size").alias("bytes"))


def put_request_rows(items: DataFrame) -> DataFrame:
    """One row per request with its entries in order; requests are bounded by the collection limits."""
    entry = F.struct("entry_no", "partition_key", "explicit_hash_key", "data", "is_aggregated")
    return items.groupBy("stream_name", "request_rn").agg(F.array_sort(F.collect_list(entry)).alias("entries"))


@query("put_entries", """
    SELECT p.stream_name, p.rn - min(p.rn) OVER (PARTITION BY p.stream_name, request_no) AS entry_no,
           min(p.rn) OVER (PARTITION BY p.stream_name, request_no) AS request_rn,
           CASE WHEN n = 1 THEN first_key ELSE 'a' END AS partition_key, ltrim(first_hash, '0') AS explicit_hash_key, md5(data_hex) AS data_md5
    FROM packed_items p JOIN request_of q ON q.stream_name = p.stream_name AND q.rn = p.rn""")
def put_entries(spark, d):
    """Sink rows of each request."""
    return put_request_rows(collect(as_items(materialize(packed(spark, d))))).select("stream_name", "request_rn", F.explode("entries").alias("e")).select(
        "stream_name", "request_rn", "e.entry_no", "e.partition_key", "e.explicit_hash_key",
        F.md5(F.lower(F.hex("e.data")).cast("binary")).alias("data_md5"))


def request_json_text(requests: DataFrame) -> DataFrame:
    """JSON body of each request, data as base64."""
    records = F.transform("entries", lambda e: F.struct(
        F.translate(F.base64(e["data"]), "\r\n", "").alias("Data"), e["partition_key"].alias("PartitionKey"), e["explicit_hash_key"].alias("ExplicitHashKey")))
    return requests.withColumn("body", F.to_json(F.struct(F.col("stream_name").alias("StreamName"), records.alias("Records"))))


@query("request_json", """
    SELECT p.stream_name, min(p.rn) AS request_rn,
           '{"StreamName":"' || p.stream_name || '","Records":[' || string_agg('{"Data":"' || base64(unhex(data_hex)) || '","PartitionKey":"'
             || CASE WHEN n = 1 THEN first_key ELSE 'a' END || '","ExplicitHashKey":"' || ltrim(first_hash, '0') || '"}', ',' ORDER BY p.rn) || ']}' AS body
    FROM packed_items p JOIN request_of q ON q.stream_name = p.stream_name AND q.rn = p.rn GROUP BY p.stream_name, request_no""")
def request_json(spark, d):
    """JSON request bodies."""
    return request_json_text(put_request_rows(collect(as_items(materialize(packed(spark, d)))))).select("stream_name", "request_rn", "body")


# -- shaping -------------------------------------------------------------------------------------------------

RECORDS = S.Bucket(fx.RECORD_CAPACITY, fx.RECORD_RATE)
SLOW_RECORDS = S.Bucket(fx.RECORD_CAPACITY, fx.EXPIRY_RATE)
BYTES = S.Bucket(fx.BYTE_CAPACITY, fx.BYTE_RATE)


def payload_size():
    return F.octet_length("data")


def _shape_sql(cost1: float, depth1: float, bytes_: bool, expiry: bool, body: str) -> str:
    """Joint simulation of the buckets, one record after the other."""
    c2, d2 = (f"size / {BYTES.rate}", BYTES.depth) if bytes_ else ("0", 0)
    send = f"greatest(n.arr, r.hold, r.t1 + {cost1} - {depth1}" + (f", r.t2 + n.{c2} - {d2})" if bytes_ else ")")
    late = f"({send} > n.expire)" if expiry else "false"
    return f"""
    WITH RECURSIVE o AS (
      SELECT stream_name, shard_no, source_id, strlen(data) AS size, (epoch_us(arrival_ts) - {S.EPOCH_S}000000) / 1000000.0::DOUBLE AS arr,
             (epoch_us(expiration_ts) - {S.EPOCH_S}000000) / 1000000.0::DOUBLE AS expire,
             row_number() OVER (PARTITION BY stream_name, shard_no ORDER BY deadline_ts, arrival_ts, source_id) AS rn FROM routed),
    r AS (
      SELECT stream_name, shard_no, source_id, size, rn, arr AS arrival, arr AS send, false AS late, -1e18::DOUBLE AS hold,
             arr + {cost1} AS t1, arr + {c2} AS t2 FROM o WHERE rn = 1
      UNION ALL
      SELECT n.stream_name, n.shard_no, n.source_id, n.size, n.rn, n.arr, {send}, {late},
             CASE WHEN {late} THEN greatest(r.hold, n.expire) ELSE r.hold END,
             CASE WHEN {late} THEN r.t1 ELSE greatest(r.t1, {send}) + {cost1} END,
             CASE WHEN {late} THEN r.t2 ELSE greatest(r.t2, {send}) + {'n.' if bytes_ else ''}{c2} END
      FROM r JOIN o n ON n.stream_name = r.stream_name AND n.shard_no = r.shard_no AND n.rn = r.rn + 1)
    {body}"""


@query("rate_limit_single", _shape_sql(1 / RECORDS.rate, RECORDS.depth, False, False, """
    SELECT stream_name, shard_no, source_id, round(send, 3) AS send_s FROM r"""))
def rate_limit_single(spark, d):
    """Send times under one record limit per shard."""
    out = S.rate_limit_single(fx.routed_table(spark, d), RECORDS, CFG.slice_ms)
    return out.select("stream_name", "shard_no", "source_id", F.round("send_s", 3).alias("send_s"))


@query("rate_limit_shard", _shape_sql(1 / RECORDS.rate, RECORDS.depth, True, False, """
    SELECT stream_name, shard_no, source_id, round(send, 3) AS send_s FROM r"""))
def rate_limit_shard(spark, d):
    """Send times under a record and a byte limit per shard."""
    out = S.rate_limit_shard(fx.routed_table(spark, d), RECORDS, BYTES, payload_size(), CFG.slice_ms)
    return out.select("stream_name", "shard_no", "source_id", F.round("send_s", 3).alias("send_s"))


@query("rate_limit_expired", _shape_sql(1 / SLOW_RECORDS.rate, SLOW_RECORDS.depth, True, True, """
    SELECT source_id, CASE WHEN NOT late THEN round(send, 3) END AS send_s, late AS expired FROM r"""))
def rate_limit_expired(spark, d):
    """Send times and expiries of an overloaded shard."""
    out = S.rate_limit_expired(fx.routed_table(spark, d), SLOW_RECORDS, BYTES, payload_size(), CFG.slice_ms)
    return out.select("source_id", F.round("send_s", 3).alias("send_s"), "expired")


@query("emit_order", """
    SELECT source_id, CASE WHEN known THEN shard_no ELSE -1 END AS shard_no,
           CASE WHEN known THEN row_number() OVER (PARTITION BY stream_name, shard_no, known ORDER BY deadline_ts, arrival_ts, source_id) END AS emit_no
    FROM (SELECT *, hash_key <= '170141183460469231731687303715884105727' AS known FROM routed)""")
def emit_order(spark, d):
    """Queue positions by deadline; records outside the shard map bypass the queue."""
    from sparkpack.operators import intake, shards
    half = shards.shard_ranges(fx.three_shards(spark).filter("shard_no <> 1"))
    records = shards.shard_lookup(fx.keyed(intake.assign_times(fx.user_records(spark, d), CFG)), half)
    return S.emit_order(records, CFG.slice_ms).select("source_id", "shard_no", "emit_no")


@query("throttle_profile", _shape_sql(1 / RECORDS.rate, RECORDS.depth, False, False, f"""
    SELECT stream_name, shard_no, floor(round(send, 3))::BIGINT AS second, count(*) AS records, sum(size)::BIGINT AS bytes,
           count(*) / {RECORDS.rate}::DOUBLE AS share FROM r GROUP BY 1, 2, 3"""))
def throttle_profile(spark, d):
    """Load per shard and second after shaping."""
    shaped = S.rate_limit_single(fx.routed_table(spark, d), RECORDS, CFG.slice_ms).withColumn("send_s", F.round("send_s", 3))
    return S.throttle_profile(shaped, RECORDS.rate, payload_size())


@query("sort_by_deadline", """
    SELECT stream_name, shard_no, batch_no, list(source_id ORDER BY deadline_ts, arrival_ts, source_id)::VARCHAR AS ids FROM count_batches GROUP BY 1, 2, 3""")
def sort_by_deadline(spark, d):
    """Records of each batch in deadline order."""
    ids = F.transform(F.array_sort(F.collect_list(F.struct("deadline_ts", "arrival_ts", "source_id"))), lambda r: r["source_id"].cast("string"))
    return count_batches(spark, d).groupBy(*BATCH).agg(F.concat(F.lit("["), F.array_join(ids, ", "), F.lit("]")).alias("ids"))


@query("earliest_deadline", """
    SELECT stream_name, shard_no, source_id, row_number() OVER w AS due_no FROM routed
    WINDOW w AS (PARTITION BY stream_name, shard_no ORDER BY deadline_ts, arrival_ts, source_id) QUALIFY due_no <= 10""")
def earliest_deadline(spark, d):
    """Next ten due records of each shard."""
    return S.earliest_deadline(fx.routed_records(spark, d), 10).select("stream_name", "shard_no", "source_id", F.col("due_no").cast("bigint").alias("due_no"))


#: Deadlines of four to 24 hours, so a record is often overtaken by later ones.
def urgent(records: DataFrame) -> DataFrame:
    return records.withColumn("deadline_ts", F.timestamp_micros(US("arrival_ts") + (F.lit(1) + F.col("source_id") % 6) * (4 * fx.HOUR * 1000)))


REMAINDER = BatchRule(size_limit=120, count_limit=12)


@query("unflushed_remainder", f"""
    WITH RECURSIVE mixed AS (
      SELECT stream_name, shard_no, source_id AS id, strlen(data)::BIGINT AS size, epoch_us(arrival_ts) AS arr,
             epoch_us(arrival_ts) + (1 + source_id % 6) * {4 * fx.HOUR}000 AS due, -1 AS burst, 0::BIGINT AS burst_size FROM routed),"""
    + arrivals_sql("mixed", "stream_name, shard_no", REMAINDER) + """,
    cut AS (SELECT stream_name, shard_no, unnest(buf).id AS id FROM flushes)
    SELECT f.stream_name, f.shard_no, f.id AS source_id, (SELECT count(*) FROM cut c WHERE c.stream_name = f.stream_name AND c.shard_no = f.shard_no AND c.id = f.id) AS cuts,
           f.batch_id, f.flush_us, f.reason
    FROM (SELECT stream_name, shard_no, batch_id, flush_us, reason, unnest(gone).id AS id FROM flushes) f
    WHERE (f.stream_name, f.shard_no, f.id) IN (SELECT (stream_name, shard_no, id) FROM cut)""")
def unflushed_remainder(spark, d):
    """Records that a flush left behind because it was full, how often, and the batch that took them at last."""
    out = fold_arrivals(urgent(fx.routed_records(spark, d)), REMAINDER, size=F.octet_length("data"), keys=["stream_name", "shard_no"], slice_ms=CFG.slice_ms)
    return out.filter("cuts > 0").select("stream_name", "shard_no", F.col("id").alias("source_id"), "cuts", "batch_id", "flush_us", "reason")
