"""Queries that run a stream over the given files to its end and return what it wrote."""

from __future__ import annotations

from pyspark.sql import functions as F

from waybill.operators import audit, checkpoints, delivery
from waybill.plans import views
from waybill.plans.flowing import _SHOWN, REFILLED, STATES, TOKENS
from waybill.plans.registry import query
from waybill.session import shared_dir
from waybill.sources import envelopes, landed
from waybill.sources.messages import TABLE_SCHEMA, stream_files
from waybill.streaming import atomic, drain, fanout, ingest, stateful, states
from waybill.streaming.seen import Seen, deduplicate_each_batch


def _event_stream(spark, folder):
    """The events file as a message stream."""
    kind = envelopes.table(spark, folder, "events").schema
    return envelopes.event_messages(stream_files(spark, folder, kind, glob="events.parquet"))


@query(
    "stream_ingest",
    views.E + """SELECT q AS "queueName", id AS "messageIdHex", ms AS "timestampMs", body AS "payloadString" FROM e""",
)
def stream_ingest(spark, folder):
    path = shared_dir(spark, "ingest")
    stream = _event_stream(spark, folder)
    ingest.run_to_end(ingest.ingest(stream, f"{path}/table", f"{path}/checkpoint"))
    table = spark.read.schema(stream.schema).parquet(f"{path}/table")
    return views.flat(table, "queueName", "messageIdHex", "timestamp", "payloadString")


@query(
    "stream_dedup",
    views.E + """SELECT q AS "queueName", id AS "messageIdHex", body AS "payloadString" FROM e""",
)
def stream_dedup(spark, folder):
    """Every event delivered twice, each kept once; the span of the feed is within the delay."""
    path = shared_dir(spark, "dedup")
    twice = _event_stream(spark, folder).unionByName(_event_stream(spark, folder))
    once = ingest.deduplicate_stream(twice, "31 days")
    ingest.run_to_end(ingest.ingest(once, f"{path}/table", f"{path}/checkpoint"))
    table = spark.read.schema(once.schema).parquet(f"{path}/table")
    return table.select("queueName", "messageIdHex", "payloadString")


@query(
    "stream_commit",
    views.E
    + """SELECT q AS "queueName", id AS "messageIdHex", backout + 1 AS attempt, 'COMMIT' AS outcome FROM e""",
)
def stream_commit(spark, folder):
    path = shared_dir(spark, "commit")
    _committed(spark, folder, path)
    return views.flat(delivery.read_log(spark, f"{path}/log"), "queueName", "messageIdHex", "attempt", "outcome")


def _committed(spark, folder, path):
    """Commit every event, with its log and its checkpoints below ``path``."""
    store = ingest.write_batch(f"{path}/out")
    stream = _event_stream(spark, folder)
    ingest.run_to_end(ingest.commit_each_batch(stream, store, f"{path}/log", f"{path}/checkpoint", f"{path}/saves", "QM1"))


@query(
    "stream_saves",
    views.E
    + """SELECT q AS "queueName", 'QM1' AS "queueManager", max_by(id, (ms, id)) AS "lastMessageId",
    max_by(corr, (ms, id)) AS "lastCorrelationId", max(ms) AS "lastProcessedTimestamp", count(*) AS "messagesProcessed",
    sum(size)::BIGINT AS "bytesProcessed" FROM e GROUP BY q""",
)
def stream_saves(spark, folder):
    """The checkpoints that the committing stream leaves."""
    path = shared_dir(spark, "saves")
    _committed(spark, folder, path)
    saves = checkpoints.latest(spark.read.parquet(f"{path}/saves/*"))
    return saves.drop("partitionId", "createdAt")


@query(
    "stream_published",
    views.E
    + """SELECT 'output' AS part, q AS "queueName", id AS "messageIdHex", backout + 1 AS attempt FROM e WHERE backout < 3
  UNION ALL SELECT 'log', q, id, backout + 1 FROM e
  UNION ALL SELECT 'checkpoint', q, max_by(id, (ms, id)), count(*) FROM e GROUP BY q""",
)
def stream_published(spark, folder):
    """Output, log and checkpoints of a stream whose batches become visible as a whole."""
    root = f"{shared_dir(spark, 'published')}/t"

    def make(batch):
        return batch.where("backoutCount < 3").select("queueName", "messageIdHex", "backoutCount")

    ingest.run_to_end(atomic.publish_each_batch(_event_stream(spark, folder), make, root, f"{root}-checkpoint", "QM1"))
    key = ["queueName", "messageIdHex"]
    out = atomic.read_published(spark, root, atomic.OUTPUT, "queueName string, messageIdHex string, backoutCount int")
    out = out.select(F.lit("output").alias("part"), *key, (F.col("backoutCount") + 1).alias("attempt"))
    log = atomic.read_log(spark, root).select(F.lit("log").alias("part"), *key, "attempt")
    saved = atomic.read_checkpoints(spark, root)
    saved = saved.select(F.lit("checkpoint").alias("part"), "queueName", "lastMessageId", "messagesProcessed")
    return views.flat(out.union(log).union(saved))


@query(
    "stream_seen",
    views.E + """SELECT q AS "queueName", id AS "messageIdHex", body AS "payloadString" FROM e""",
)
def stream_seen(spark, folder):
    """Events that all come again in a later micro-batch, each kept once without a bound on a copy's age."""
    path = shared_dir(spark, "seen")
    events = views.events(spark, folder).select("queueName", "messageIdHex", "payloadString", "timestamp")
    for part in (0, 1):
        events.write.parquet(f"{path}/in/part={part}")
    fed = stream_files(spark, f"{path}/in/*", events.schema, max_files=1)
    kept = Seen(f"{path}/ids", buckets=8)
    ingest.run_to_end(deduplicate_each_batch(fed, ingest.write_batch(f"{path}/out"), kept, f"{path}/checkpoint"))
    return spark.read.schema(events.schema).parquet(f"{path}/out/*").drop("timestamp")


@query("stream_states", STATES)
def stream_states(spark, folder):
    """Connector states from the state store; the last command moves the watermark past all others."""
    path = shared_dir(spark, "states")
    kind = envelopes.table(spark, folder, "events").schema
    fed = views.commands_of(stream_files(spark, folder, kind, glob="events.parquet"))
    ingest.run_to_end(drain.write_drains(states.state_stream(fed, "0 seconds"), f"{path}/out", f"{path}/checkpoint"))
    return spark.read.schema(states.OUTPUT).parquet(f"{path}/out/*").drop("ms")


@query(
    "stream_drain",
    views.E
    + """, log AS (SELECT q, ms AS t, event_id * 3 AS seq, 1 AS delta, NULL AS timeout FROM e
    UNION ALL SELECT q, recv_ms, event_id * 3 + 1, -1, NULL FROM e
    UNION ALL SELECT q, ms + 1000, event_id * 3 + 2, 0, event_id % 4 * 1000 FROM e WHERE event_id % 7 = 0), running AS (
  SELECT *, sum(delta) OVER (PARTITION BY q ORDER BY t, seq) AS flying FROM log), following AS (
  SELECT *, min(CASE WHEN flying = 0 THEN t END) OVER (PARTITION BY q ORDER BY t, seq
    ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS empty FROM running), decided AS (
  SELECT q, seq, t, timeout, coalesce(empty <= t + timeout, false) AS drained, empty FROM following WHERE timeout IS NOT NULL)
  SELECT q AS "queueName", seq, t AS "requestedMs", timeout AS "timeoutMs",
    CASE WHEN drained THEN 'DRAINED' ELSE 'TIMED_OUT' END AS outcome, CASE WHEN drained THEN empty ELSE t + timeout END AS "decidedMs"
  FROM decided WHERE drained OR t + timeout < (SELECT max(t) FROM log)""",
)
def stream_drain(spark, folder):
    """Drain requests that wait for what is in flight, with timeouts of up to three seconds."""
    path = shared_dir(spark, "drain")
    results = drain.drain_results(views.drain_log(_event_stream(spark, folder)), "0 seconds")
    ingest.run_to_end(drain.write_drains(results, f"{path}/out", f"{path}/checkpoint"))
    return spark.read.schema(drain.OUTPUT).parquet(f"{path}/out/*").drop("inFlight")


@query(
    "stream_bounded",
    views.E
    + """SELECT (row_number() OVER (PARTITION BY q ORDER BY ms, id) - 1) // 1000 AS batch, q AS "queueName",
    id AS "messageIdHex", body AS "payloadString" FROM e""",
)
def stream_bounded(spark, folder):
    """Events landed in one load and streamed a thousand a queue and micro-batch."""
    path = shared_dir(spark, "bounded")
    events = views.events(spark, folder)
    landed.land(events.select([f.name for f in TABLE_SCHEMA if f.name in events.columns]), f"{path}/landed")
    stream = landed.stream_landed(spark, f"{path}/landed", 1000)
    writer = stream.writeStream.foreachBatch(ingest.write_batch(f"{path}/out"))
    landed.caught_up(writer.option("checkpointLocation", f"{path}/checkpoint").start())
    got = spark.read.option("basePath", f"{path}/out").parquet(f"{path}/out/*")
    return views.flat(got.withColumn("batch", F.col("batch").cast("bigint")), "batch", "queueName", "messageIdHex", "payloadString")


@query("throttle_stream", REFILLED + _SHOWN)
def throttle_stream(spark, folder):
    path = shared_dir(spark, "throttle")
    stream = _event_stream(spark, folder).select("queueName", "messageIdHex", "timestamp")
    limits = views.limits(spark, TOKENS)
    ingest.run_to_end(stateful.throttle_stream(stream, limits, path, f"{path}/checkpoint", views.HOUR_MS))
    schema = "queueName string, messageIdHex string, granted boolean"
    return spark.read.schema(schema).parquet(f"{path}/granted/*")


@query(
    "stream_metrics",
    views.E
    + """SELECT q AS "queueName", ms // 86400000 * 86400000 AS "windowStart", count(*) AS "messagesReceived",
    sum(size)::BIGINT AS "bytesReceived" FROM e GROUP BY ALL""",
)
def stream_metrics(spark, folder):
    path = shared_dir(spark, "metrics")
    stream = _event_stream(spark, folder)
    ingest.run_to_end(stateful.write_counters(stateful.counter_stream(stream, "1 day", "31 days"), path))
    return stateful.read_counters(spark, path)


@query(
    "audit_fanout",
    views.E
    + """SELECT 'console' AS sink, '[' || regexp_replace(strftime(make_timestamp(recv_ms * 1000), '%Y-%m-%d %H:%M:%S.%g'),
      '0{1,2}$', '') || '] MessageReceived queue=' || q || ' qm=QM1 msgId=' || id AS line FROM e
  UNION ALL SELECT 'json', '{"eventType":"MESSAGE_RECEIVED","timestamp":' || recv_ms || ',"queueName":"' || q ||
    '","queueManager":"QM1","messageId":"' || id || '","correlationId":"' || corr || '","sourceId":"events","details":' ||
    '{"bytes":"' || size || '","userId":"user' || user_id || '"}}' FROM e""",
)
def audit_fanout(spark, folder):
    """Received messages to a console sink, a JSON sink, and an errors-only sink that stays empty."""
    path = shared_dir(spark, "audit")
    sink = fanout.composite_sink(
        fanout.console_sink(f"{path}/console"),
        fanout.json_sink(f"{path}/json"),
        fanout.errors_only_sink(fanout.console_sink(f"{path}/errors")),
        fanout.noop_sink(),
    )
    events = audit.received(_event_stream(spark, folder), "QM1", "events")
    ingest.run_to_end(fanout.write_audit(events, sink, f"{path}/checkpoint"))
    parts = [
        spark.read.text(f"{path}/{name}/*").select(F.lit(name).alias("sink"), F.col("value").alias("line"))
        for name in ("console", "json", "errors")
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])
