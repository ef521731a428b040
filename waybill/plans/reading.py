"""Queries of the sources: claims, log, progress, configuration."""

from __future__ import annotations

from pyspark.sql import functions as F

from waybill.operators import checkpoints, claim, delivery, leases, progress, settled
from waybill.operators import queue_config as config
from waybill.plans import views
from waybill.plans.registry import query
from waybill.session import shared_dir
from waybill.sources import landed
from waybill.sources.envelopes import table
from waybill.sources.messages import TABLE_SCHEMA

CLAIM_COLUMNS = (
    "queueName",
    "messageIdHex",
    "correlationIdHex",
    "payloadString",
    "timestamp",
    "priority",
    "backoutCount",
    "format",
    "persistence",
    "userId",
    "position",
)
_CLAIM_SELECT = """SELECT q AS "queueName", id AS "messageIdHex", corr AS "correlationIdHex", body AS "payloadString",
  ms AS "timestampMs", priority, backout AS "backoutCount", fmt AS format, persistence, 'user' || user_id AS "userId",
  rn AS position"""
_UNREAD = views.LOG + """, unread AS (
  SELECT *, row_number() OVER (PARTITION BY q ORDER BY ms, id) AS rn FROM e
  WHERE NOT EXISTS (SELECT 1 FROM log WHERE log.q = e.q AND log.id = e.id AND outcome = 'COMMIT'))"""
CLAIM_SQL = _UNREAD + _CLAIM_SELECT + " FROM unread WHERE rn <= 1000"


@query("claim_batch", CLAIM_SQL)
def claim_batch(spark, folder):
    e = views.events(spark, folder)
    batch = claim.claim_batch(e, views.delivery_log(e), views.QUEUES)
    return views.flat(batch, *CLAIM_COLUMNS)


@query("claim_settled", CLAIM_SQL)
def claim_settled(spark, folder):
    """The same claim from a table landed in two loads, with what is committed kept as bitmaps of its rows."""
    e = views.events(spark, folder)
    path = shared_dir(spark, "settled")
    known = e.select([f.name for f in TABLE_SCHEMA if f.name in e.columns])
    for part in (0, 1):
        landed.land(known.where(F.col("event_id") % 2 == part), f"{path}/landed")
    committed = views.delivery_log(e).where("outcome = 'COMMIT'").select(*claim.KEY)
    rows = landed.read_landed(spark, f"{path}/landed").select(*claim.KEY, *settled.ADDRESS).join(committed, claim.KEY, "left_semi")
    for part in (0, 1):
        settled.settle(rows.where(F.col("landedRow") % 2 == part), f"{path}/marks")
    settled.compact(spark, f"{path}/marks")
    batch = settled.claim_landed(spark, f"{path}/landed", f"{path}/marks", views.QUEUES)
    return views.flat(batch, *CLAIM_COLUMNS)


@query(
    "leased_claim",
    views.E
    + """, o AS (SELECT q, id, row_number() OVER (PARTITION BY q ORDER BY ms, id) AS rn FROM e), l AS (
  SELECT 'first' AS owner, 1 AS fence, 'ROLLBACK' AS outcome, 0 AS returned, q, id FROM o WHERE rn <= 100
  UNION ALL SELECT 'second', 2, 'COMMIT', 0, q, id FROM o WHERE rn BETWEEN 101 AND 200
  UNION ALL SELECT 'third', 4, 'HELD', 1, q, id FROM o WHERE rn <= 100
  UNION ALL SELECT 'fourth', 5, 'HELD', 0, q, id FROM o WHERE rn BETWEEN 201 AND 300)
  SELECT owner, fence, outcome, returned, q AS "queueName", id AS "messageIdHex" FROM l""",
)
def leased_claim(spark, folder):
    """Four claimers in turn: the first lets its lease expire, the second commits, the third gets what the first had."""
    e = views.events(spark, folder)
    root = shared_dir(spark, "leases")
    ask = lambda owner, now: leases.claim(e, root, owner, views.QUEUES, now, lease_ms=1000, batch_size=100)
    ask("first", 0)
    leases.commit(spark, ask("second", 500), 900)
    ask("third", 1200)
    ask("fourth", 1300)
    return views.flat(leases.lease_log(spark, root, 1400), "owner", "fence", "outcome", "returned", *claim.KEY)


@query("browse_batch", _UNREAD + _CLAIM_SELECT + " FROM unread WHERE rn <= 100")
def browse_batch(spark, folder):
    e = views.events(spark, folder)
    batch = claim.browse_batch(e, views.delivery_log(e), views.QUEUES, batch_size=100)
    return views.flat(batch, *CLAIM_COLUMNS)


@query(
    "multi_queue_claim",
    _UNREAD + ", " + views.CONFIG + _CLAIM_SELECT + " FROM unread JOIN config USING (q) WHERE enabled AND rn <= n",
)
def multi_queue_claim(spark, folder):
    e = views.events(spark, folder)
    batch = claim.claim_configured(e, views.delivery_log(e), views.event_queue_config(spark))
    return views.flat(batch, *CLAIM_COLUMNS)


@query(
    "commit_batch",
    _UNREAD
    + """SELECT 7::BIGINT AS "batchId", q AS "queueName", id AS "messageIdHex", backout + 1 AS attempt, 'COMMIT' AS outcome
  FROM unread WHERE rn <= 1000""",
)
def commit_batch(spark, folder):
    """Claim, commit, and commit the same batch once more as a replay would; another consumer has a batch 7 too."""
    e = views.events(spark, folder)
    batch = claim.claim_batch(e, views.delivery_log(e), views.QUEUES)
    path = shared_dir(spark, "delivery-log")
    for _ in range(2):
        delivery.append_log(delivery.settle(batch, 7, "COMMIT", F.col("receivedAt")), path)
    delivery.append_log(delivery.settle(batch, 7, "COMMIT", F.col("receivedAt"), consumer="other"), path)
    written = delivery.read_log(spark, path).filter(F.col("consumer") == delivery.CONSUMER)
    return views.flat(written, "batchId", "queueName", "messageIdHex", "attempt", "outcome")


@query(
    "redelivery_count",
    views.LOG
    + """, again AS (SELECT q, id, count(*) AS n FROM log WHERE outcome = 'ROLLBACK' GROUP BY ALL)
  SELECT q AS "queueName", id AS "messageIdHex", backout + coalesce(n, 0) AS "backoutCount",
    backout + coalesce(n, 0) > 0 AS "isRedelivered" FROM e LEFT JOIN again USING (q, id)""",
)
def redelivery_count(spark, folder):
    e = views.events(spark, folder)
    counted = delivery.with_redelivery_count(e, views.delivery_log(e))
    counted = counted.withColumn("isRedelivered", F.col("backoutCount") > 0)
    return views.flat(counted, "queueName", "messageIdHex", "backoutCount", "isRedelivered")


_PROGRESS = views.E + """, b AS (
  SELECT batch, count(*) AS n, max(ms) AS last_ms FROM e GROUP BY batch), ids AS (
  SELECT batch, string_agg('"' || id || '"', ',' ORDER BY rn) AS ids FROM (
    SELECT batch, id, row_number() OVER (PARTITION BY batch ORDER BY ms, id) AS rn FROM e)
  WHERE rn <= 10 GROUP BY batch), total AS (
  SELECT batch, n, last_ms, (sum(n) OVER (ORDER BY batch))::BIGINT AS processed FROM b)"""


@query(
    "stream_progress",
    _PROGRESS
    + """SELECT batch AS "batchId", processed AS "processedCount", n AS "lastBatchCount", last_ms AS "lastBatchTimestamp",
    '{"batchId":' || batch || ',"processedCount":' || processed || ',"lastBatchCount":' || n ||
      ',"lastBatchTimestamp":' || last_ms || ',"lastMessageIds":[' || ids || ']}' AS marker
  FROM total JOIN ids USING (batch)""",
)
def stream_progress(spark, folder):
    batches = views.events(spark, folder).withColumn("batchId", views.batch_id())
    marked = progress.batch_progress(batches).withColumn("marker", progress.marker_json())
    read = marked.select(progress.marker_from_json(F.col("marker")).alias("m"), "marker")
    return read.select(
        "m.batchId", "m.processedCount", "m.lastBatchCount", "m.lastBatchTimestamp", "marker"
    )


_SUPPLIER_CONFIG = """WITH config AS (SELECT 'SUPPLIER.' || s_nationkey AS q, floor(s_acctbal / 10)::BIGINT AS n,
  (s_suppkey % 3) * 1000 AS wait, CASE WHEN s_nationkey > 0 THEN s_nationkey - 5 END AS rate FROM supplier)"""


@query(
    "queue_config_violations",
    _SUPPLIER_CONFIG
    + """SELECT q AS "queueName", 'duplicate queue names found: ' || q AS violation FROM config GROUP BY q HAVING count(*) > 1
  UNION ALL SELECT q, q || ': batchSize must be positive' FROM config WHERE n <= 0
  UNION ALL SELECT q, q || ': pollTimeoutMs must be positive' FROM config WHERE wait <= 0
  UNION ALL SELECT q, q || ': throttleMessagesPerSecond must be positive' FROM config WHERE rate <= 0""",
)
def queue_config_violations(spark, folder):
    nation = F.col("s_nationkey")
    settings = table(spark, folder, "supplier").select(
        F.concat(F.lit("SUPPLIER."), nation).alias("queueName"),
        F.floor(F.col("s_acctbal") / 10).cast("int").alias("batchSize"),
        (F.col("s_suppkey") % 3 * 1000).alias("pollTimeoutMs"),
        F.when(nation > 0, nation - 5).alias("throttleMessagesPerSecond"),
    )
    return config.config_violations(settings)


@query(
    "checkpoint_violations",
    """SELECT c_mktsegment AS "queueName", c_custkey AS "partitionId",
    c_mktsegment || ': queueManager is required' AS violation FROM customer WHERE c_acctbal < 0""",
)
def checkpoint_violations(spark, folder):
    saved = table(spark, folder, "customer").select(
        F.col("c_mktsegment").alias("queueName"),
        F.col("c_custkey").alias("partitionId"),
        F.when(F.col("c_acctbal") < 0, "").otherwise("QM1").alias("queueManager"),
    )
    return config.checkpoint_violations(saved)


# Checkpoints


_CKPT = views.E + """, part AS (SELECT *, event_id % 4 AS part FROM e), built AS (
  SELECT q, part, batch, arg_max(id, ms * 1000000 + event_id) AS last_id,
    arg_max(CASE WHEN backout > 2 THEN corr END, ms * 1000000 + event_id) FILTER (WHERE backout > 2) AS last_corr,
    max(ms) AS last_ms, count(*) AS n, sum(size)::BIGINT AS bytes FROM part GROUP BY ALL)"""
_CKPT_SELECT = """SELECT q AS "queueName", 'QM1' AS "queueManager", last_id AS "lastMessageId",
  last_corr AS "lastCorrelationId", last_ms AS "lastProcessedTimestamp", n AS "messagesProcessed",
  bytes AS "bytesProcessed", part AS "partitionId", last_ms + 1 AS "createdAt" """


def _saves(spark, folder):
    """One checkpoint per queue, partition and batch; half of the messages carry a correlation id."""
    e = views.events(spark, folder)
    batch = e.withColumns(
        {
            "partitionId": (F.col("event_id") % 4).cast("int"),
            "batchId": views.batch_id(),
            "correlationIdHex": F.when(F.col("backoutCount") > 2, F.col("correlationIdHex")).otherwise(""),
        }
    )
    built = checkpoints.build_checkpoints(batch, "QM1", F.lit(0).cast("bigint"), ("batchId",))
    return built.withColumn("createdAt", F.col("lastProcessedTimestamp") + 1)


@query("checkpoint_build", _CKPT + _CKPT_SELECT + ', batch AS "batchId" FROM built')
def checkpoint_build(spark, folder):
    return views.flat(_saves(spark, folder))


def _save_log(spark, folder):
    """The checkpoints as a save log; partition 3 of every queue is deleted at the end."""
    saves = _saves(spark, folder).withColumns({"seq": F.col("batchId"), "deleted": F.lit(False)}).drop("batchId")
    gone = saves.filter(F.col("partitionId") == 3).select(*checkpoints.KEY).distinct()
    return saves.unionByName(checkpoints.tombstones(gone, F.lit(1 << 40)).select(*saves.columns))


_LATEST = _CKPT + """, newest AS (
  SELECT *, row_number() OVER (PARTITION BY q, part ORDER BY batch DESC) AS rn FROM built)"""


@query("checkpoint_latest", _LATEST + _CKPT_SELECT + " FROM newest WHERE rn = 1 AND part <> 3")
def checkpoint_latest(spark, folder):
    return views.flat(checkpoints.latest(_save_log(spark, folder)))


@query("checkpoint_list", _LATEST + _CKPT_SELECT + " FROM newest WHERE rn = 1 AND part <> 3")
def checkpoint_list(spark, folder):
    """The current checkpoints after compacting the save log to a new version."""
    path = shared_dir(spark, "checkpoints")
    checkpoints.compact(_save_log(spark, folder), path)
    return views.flat(checkpoints.latest(spark.read.parquet(path)))


@query(
    "checkpoint_merge",
    _LATEST
    + _CKPT_SELECT
    + """FROM (SELECT *, row_number() OVER (PARTITION BY q, part ORDER BY last_ms DESC, batch) AS pick
      FROM newest) WHERE pick = 1""",
)
def checkpoint_merge(spark, folder):
    """Even batches against odd ones: each side's furthest checkpoint, then the later of the two."""
    saves = _saves(spark, folder)
    furthest = F.struct("lastProcessedTimestamp", -F.col("batchId"))
    sides = []
    for odd in (0, 1):
        best = (
            saves.filter(F.col("batchId") % 2 == odd)
            .groupBy(*checkpoints.KEY)
            .agg(F.max_by(F.struct(*[f for f in checkpoints.FIELDS if f not in checkpoints.KEY]), furthest).alias("c"))
        )
        sides.append(best.select(*checkpoints.KEY, "c.*"))
    return views.flat(checkpoints.merge(*sides))


@query(
    "checkpoint_json",
    _CKPT
    + """SELECT '{"queueName":"' || q || '","queueManager":"QM1","lastMessageId":"' || last_id ||
    '","lastCorrelationId":' || coalesce('"' || last_corr || '"', 'null') || ',"lastProcessedTimestamp":' || last_ms ||
    ',"messagesProcessed":' || n || ',"bytesProcessed":' || bytes || ',"partitionId":' || part ||
    ',"createdAt":' || (last_ms + 1) || '}' AS line, q AS "queueName", last_id AS "lastMessageId",
    last_corr AS "lastCorrelationId", n AS "messagesProcessed" FROM built""",
)
def checkpoint_json(spark, folder):
    lines = _saves(spark, folder).select(checkpoints.to_json().alias("line"))
    read = lines.select("line", checkpoints.from_json(F.col("line")).alias("c"))
    return read.select("line", "c.queueName", "c.lastMessageId", "c.lastCorrelationId", "c.messagesProcessed")
